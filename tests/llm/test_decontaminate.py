import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from tallyframe.llm import decontaminate
from tallyframe.llm.fmindex import FMIndex, WaveletMatrix, suffix_array

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_report(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        for at in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[at:at + 10]), set()).add(item)
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for at in range(len(w) - n + 1):
                if (key := tuple(w[at:at + n])) in windows:
                    hit |= {*range(at, at + n)}
                    found |= windows[key]
        found = sorted(str(i) for i in found if i is not None)
        digest = hashlib.sha256(",".join(found).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=str)


def case(seed):
    random.seed(seed)
    vocabulary = ["a", "B", "c", "dé", "É", "x1", "ß", "日本"]
    text = lambda n: random.choice([" ", ", ", "\n"]).join(random.choices(vocabulary, k=n))
    items = [(i, text(random.choice([1, 4, 9, 10, 11, 30]) if i > 2 else 20)) for i in range(12)]
    items = [i for i in items if len(words(i[1])) > 3] + [(90, None), (91, "..."), (items[0][0], items[0][1]),
             (92, items[0][1]), (None, "null item here now")]
    docs = [(i, text(random.randrange(60))) for i in range(40)]
    docs += [(100 + i, f"before {t} after") for i, (_, t) in enumerate(items)]
    docs += [(200, None), (201, ""), (202, "?!"), (203, "zz " * 30_000 + (items[0][1] or "") + " yy" * 9),
             (204, (items[0][1] or "") * 3), (204, (items[0][1] or "") * 3), (None, items[1][1])]
    return docs, items


def test_report_matches_brute_force(documents, spark, monkeypatch):
    for seed, shard, block in ((1, 1 << 19, 1 << 17), (2, 64, 7)):
        monkeypatch.setattr(decontaminate, "SHARD_WORDS", shard)
        monkeypatch.setattr(decontaminate, "BLOCK_PHRASES", block)
        docs, items = case(seed)
        if block == 7:  # blocks chain a pass per block; keep the plan short
            items = items[:3]
        bench = spark.createDataFrame(items, "item_id bigint, text string")
        got = decontaminate.report(documents(docs).withColumn("found", F.lit(1)), bench).drop("spans")
        assert sorted((tuple(r) for r in got.collect()), key=str) == plain_report(docs, items)


def test_apply_and_empty_tables(documents, spark):
    docs, items = case(3)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    clean = {r[0] for r in plain_report(docs, items) if not r[5]}
    given = documents(docs).withColumn("found", F.lit(1))
    kept = decontaminate.apply(given, bench)
    assert kept.columns == given.columns
    assert {r.doc_id for r in kept.collect()} == clean
    assert decontaminate.apply(given, bench.limit(0)).count() == len(docs)
    assert decontaminate.report(documents([]), bench).count() == 0


def test_index_searches_and_locates():
    rng = np.random.default_rng(4)
    for symbols in (1, 3, 50):
        text = rng.integers(0, symbols + 1, 3000)
        text[1000:1200] = text[400:600]
        text[-1] = 0
        index = FMIndex(text, symbols)
        as_list = text.tolist()
        for length in (1, 2, 5):
            patterns = np.array([text[i:i + length] for i in rng.integers(0, 2990, 40)])
            patterns = patterns[(patterns > 0).all(axis=1)]
            low, high = index.search(patterns, np.full(len(patterns), length))
            for p, a, b in zip(patterns, low, high, strict=True):
                where = [i for i in range(3001 - length) if as_list[i:i + length] == p.tolist()]
                assert sorted(index.locate(np.arange(a, b)).tolist()) == where


def test_suffix_order_and_wavelet_matrix():
    rng = np.random.default_rng(1)
    text = rng.integers(0, 3, 400)
    text[-1] = 0
    ends = np.cumsum(text == 0)
    symbols = [(0, int(ends[i])) if s == 0 else (1, int(s)) for i, s in enumerate(text)]
    assert suffix_array(text).tolist() == sorted(range(400), key=lambda i: symbols[i:])
    values = rng.integers(0, 9, 500)
    wavelet = WaveletMatrix(values, 4)
    at = np.arange(500)
    assert wavelet.access(at).tolist() == values.tolist()
    assert wavelet.rank(values, at).tolist() == [(values[:i] == values[i]).sum() for i in at]
