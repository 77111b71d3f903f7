import random
from collections import defaultdict

from pyspark.sql import functions as F
from tests_support import plain_components, plain_fingerprint

from tallyframe.llm import bloom, exact_dedup, simhash

EDGE = [
    (1, "Same Text"), (2, "same text"), (3, "SAME TEXT"), (4, None), (5, ""), (6, "other"),
    (7, "É upper stays"), (8, "é upper stays"), (9, "x " * 60_000), (10, "X " * 60_000),
    (6, "other"), (None, "lonely"), (None, "lonely"), (11, "solo"),
]


def test_exact_groups_match_a_dictionary(documents):
    groups = defaultdict(list)
    for doc_id, text in EDGE:
        groups["".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")].append(doc_id)
    rows = exact_dedup.decide(documents(EDGE)).collect()
    assert len(rows) == len(EDGE)
    for members in groups.values():
        keep = max((m for m in members if m is not None), default=None)
        mine = [r for r in rows if r.doc_id in members]
        assert all(r.keep_id == keep and r.group_size == len(members) for r in mine)
        assert [r.doc_id for r in mine if r.kept] == [keep]


def test_exact_apply_keeps_columns_and_one_repeated_row(documents):
    docs = documents(EDGE).withColumn("sha", F.lit("clash")).withColumn("rid", F.lit(1))
    kept = exact_dedup.apply(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, 3, 5, 6, 7, 8, 10, 11]


def test_exact_of_nothing(documents):
    assert exact_dedup.decide(documents([])).count() == 0
    assert exact_dedup.apply(documents([])).count() == 0


def test_a_full_filter_changes_no_result(documents, monkeypatch):
    monkeypatch.setattr(bloom, "filter_bits", lambda n: bloom.SEGMENT_BYTES * 8)
    rows = [(i, f"text {i % 4000}") for i in range(6000)]
    out = exact_dedup.decide(documents(rows)).collect()
    assert sum(r.kept for r in out) == 4000
    assert all(r.group_size == (2 if r.doc_id % 4000 < 2000 else 1) for r in out)


def test_ranges_of_hashes_have_filters_of_their_own(documents, monkeypatch):
    monkeypatch.setattr(bloom, "MAX_BITS", 1 << 16)
    rows = [(i, f"text {i % 15_000}") for i in range(20_000)] + [(30_000 + i, "hot") for i in range(9_000)]
    assert bloom.range_count(len(rows)) == 8 and bloom.range_count(4096) == 1
    hashes = exact_dedup.hashes(documents(rows))
    flagged = bloom.flag_repeats(hashes, "sha", len(rows), "maybe")
    assert flagged.columns == [*hashes.columns, "maybe"]
    passed = flagged.where("maybe").count()
    assert 19_000 <= passed < 19_500  # all 10,000 repeated rows, the hot ones, and few more
    out = exact_dedup.decide(documents(rows)).collect()
    assert len(out) == len(rows) and sum(r.kept for r in out) == 15_001
    assert all(r.group_size == (9_000 if r.doc_id >= 30_000 else 2 if r.doc_id % 15_000 < 5_000 else 1) for r in out)
    assert all(r.kept == (r.doc_id == r.keep_id) for r in out)


def near_copies(seed):
    random.seed(seed)
    words = [f"w{i}" for i in range(400)]
    docs = [(0, None), (1, ""), (2, " \t\n"), (3, "one"), (4, "One two"), (5, "one TWO three"), (6, "one two three")]
    for _ in range(25):
        base = random.choices(words, k=random.choice([5, 80, 700]))
        for _ in range(6):
            changed = list(base)
            for _ in range(random.choice([0, 1, 2])):
                changed[random.randrange(len(changed))] = random.choice(words)
            docs.append((len(docs), " ".join(changed)))
    return docs


def test_simhash_components_match_all_pairs(documents):
    docs = near_copies(3)
    prints = [plain_fingerprint(t) for _, t in docs]
    expected = plain_components(docs, prints, 2)
    rows = {r.doc_id: r for r in simhash.group(documents(docs)).collect()}
    assert {i: r.component_id for i, r in rows.items()} == expected
    assert [rows[i].fp % (1 << 64) for i, _ in docs] == prints
    assert {i for i, r in rows.items() if r.kept} == set(expected.values())


def test_links_of_fingerprints_in_one_bucket_match_all_pairs(spark):
    random.seed(5)
    start = random.getrandbits(64)
    prints = {start}
    while len(prints) < 300:  # chains of one to three bits
        prints.add(random.choice(sorted(prints)) ^ (1 << random.randrange(64)) ^ (1 << random.randrange(64))
                   ^ (random.getrandbits(1) << random.randrange(64)))
    prints = sorted(prints)
    frame = spark.createDataFrame([(simhash.signed(p),) for p in prints], "fp bigint")
    from tallyframe.llm.graph import connected_components

    for radius in (1, 2):
        masks = simhash.covering_masks(radius)
        links = [(r.u % (1 << 64), r.v % (1 << 64), r.t) for r in simhash.near_links(frame, radius).collect()]
        assert links and all(0 < (u ^ v).bit_count() <= radius and not (u ^ v) & masks[t] for u, v, t in links)
        docs = [(p, "") for p in prints]
        expected = plain_components(docs, prints, radius)
        got = connected_components(simhash.near_links(frame, radius)).collect()
        groups, wanted = defaultdict(set), defaultdict(set)
        for r in got:
            groups[r.root].add(r.node % (1 << 64))
        for p, m in expected.items():
            wanted[m].add(p)
        assert {frozenset(g) for g in groups.values()} == {frozenset(g) for g in wanted.values() if len(g) > 1}


def test_every_pair_within_the_radius_shares_a_mask():
    random.seed(1)
    for radius in (1, 2):
        masks = simhash.covering_masks(radius)
        for i in range(64):
            for j in range(i, 64 if radius == 2 else i + 1):
                assert any(not m >> i & 1 and not m >> j & 1 for m in masks)


def test_simhash_apply_and_empty(documents):
    assert simhash.group(documents([])).count() == 0
    docs = documents([(1, "a b c d"), (2, "A B C D"), (3, None), (None, "z z z"), (1, "a b c d")])
    assert sorted((r.doc_id or -1) for r in simhash.apply(docs).collect()) == [-1, 1, 3]
