import re
from collections import Counter, defaultdict

import duckdb
from pyspark.sql import functions as F

import corpus_pipeline
from tallyframe.llm import mixing, quality, simhash
from tests_support import plain_components, plain_fingerprint, plain_windows

SF = "/root/testdata/sf0.001"


def spark_mix(docs):
    return sorted(((r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken) for r in mixing.mix(docs).collect()), key=str)


def sql_mix(docs):
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    rows = con.execute(f"SELECT doc_id, size, source_size, target, taken FROM ({mixing.SQL})").fetchall()
    return sorted(((i, s, n, round(t, 6), k) for i, s, n, t, k in rows), key=str)


def test_mix_matches_sql(documents):
    rows = [(i, "w " * (i % 37), None, f"s{i % 11}" if i % 7 else None) for i in range(600)]
    rows += [(1000 + i, "x " * 4000, None, "s0") for i in range(3)] + [(2000, None, None, "empty"), (2001, " ", None, "empty")]
    rows += [(4000, "w w", None, "é"), (4000, "w w", None, "é"), (None, "a b c", None, "S1"), (3000, "y " * 90_000, None, "long")]
    docs = documents(rows).withColumn("size", F.lit("clash"))
    got = spark_mix(docs)
    assert got == sql_mix(docs) == spark_mix(docs.repartition(5))
    assert len(got) == len(rows)
    sources = defaultdict(lambda: [0, 0, 0.0])
    key = {r[0]: r[3] for r in rows}
    for doc_id, size, source_size, target, taken in got:
        assert taken <= 3 * size and target <= 3 * source_size
        sources[key[doc_id]][0] += taken
        sources[key[doc_id]][2] = target
        sources[key[doc_id]][1] = max(sources[key[doc_id]][1], size)
    assert all(abs(taken - target) <= largest for taken, largest, target in sources.values())


def test_mix_edges(documents):
    assert mixing.mix(documents([])).count() == 0
    assert mixing.apply(documents([])).count() == 0
    empty = mixing.mix(documents([(1, None), (2, "")])).collect()
    assert [(r.target, r.taken) for r in empty] == [(0.0, 0)] * 2
    one = mixing.mix(documents([(i, "a b", None, "s") for i in range(9)])).collect()
    assert all((r.target, r.taken) == (18.0, 2) for r in one)
    docs = documents([(i, "a b " * (1 + i % 5), None, f"s{i % 9}") for i in range(200)])
    taken = {r.doc_id: r.taken // r["size"] for r in mixing.mix(docs).collect()}
    rows = mixing.apply(docs.withColumn("key", F.lit(1))).collect()
    assert Counter(r.doc_id for r in rows) == {i: n for i, n in taken.items() if n}
    assert all(1 <= r.repetition <= taken[r.doc_id] and r.key == 1 for r in rows)


def test_stages_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([
        (900001, "Fresh text " + " ".join(f"w{i}" for i in range(60)), "en", "src1", 0),
        (900002, "fresh TEXT " + " ".join(f"w{i}" for i in range(60)), "en", "src2", 0),
        (900003, "", "en", "src1", 0), (900004, None, None, None, None),
    ], docs.schema)
    docs = docs.unionByName(extra)
    benchmark = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    seen = docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, seen, SF)
        if name != "mixing":
            assert out.columns == docs.columns
        before, after = seen.collect(), out.collect()
        if name == "quality":
            scored = quality.score(seen, spark.read.parquet(f"{SF}/labels.parquet"))[0]
            kept = {r.doc_id for r in scored.where("predicted = 1").collect()}
        elif name == "exact_dedup":
            last = {}
            for r in before:
                key = re.sub("[A-Z]", lambda m: m[0].lower(), r.text or "")
                last[key] = max(last.get(key, -1), r.doc_id)
            kept = set(last.values())
        elif name == "simhash":
            pairs = [(r.doc_id, r.text) for r in before]
            kept = set(plain_components(pairs, [plain_fingerprint(t) for _, t in pairs], 2).values())
        elif name == "decontamination":
            kept = {r.doc_id for r in before if not plain_windows(r.text, benchmark)}
        else:
            kept = {r.doc_id for r in mixing.mix(seen).where("taken > 0").collect()} | {
                r.doc_id for r in after if not (r.text or "").split()}
        assert {r.doc_id for r in after} == kept, name
        if name != "mixing":
            assert len(after) == len(kept)
        seen = spark.createDataFrame(after, out.schema)
    assert simhash.BITS == 64


def test_the_pipeline_of_empty_tables(spark, documents):
    out = documents([])
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, out, SF)
        assert out.count() == 0, name


def test_extra_columns_of_any_name_go_through_every_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = ["_found", "found", "_keep", "keep", "_row_key", "row_key", "_maybe", "maybe", "key", "doc", "given",
             "rid", "fp", "n", "_salt", "place", "size", "times", "repetition", "_flag", "Keep_"]
    more = docs.withColumns({c: F.concat(F.lit(f"{c} "), F.col("doc_id")) for c in extra})
    for name, stage in corpus_pipeline.STAGES:
        plain, out = stage(spark, docs, SF), stage(spark, more, SF)
        carried = [c for c in extra if name != "mixing" or c != "repetition"]
        assert [c for c in out.columns if c != "repetition"] == [c for c in more.columns if c != "repetition"], name
        got = out.collect()
        assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in plain.collect()), name
        assert got and all(r[c] == f"{c} {r.doc_id}" for r in got for c in carried), name
        if name == "mixing":
            assert all(isinstance(r.repetition, int) for r in got)
