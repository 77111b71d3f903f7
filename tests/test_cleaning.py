import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tallyframe.functions.similarity import match_masks, score
from tallyframe.functions.text import COMPONENT_RULES, apply_rules, normalize
from tallyframe.operators import namemerge
from tallyframe.operators.pooling import canonical_components, pool_tail
from tallyframe.operators.projection import select_existing, split_by_type, split_target
from tallyframe.plans.cleaning import FINAL_COLUMNS, REPORT_COLUMNS, clean, learn


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        previous, row = row, [0]
        for j, y in enumerate(b):
            row.append(previous[j] + 1 if x == y else max(previous[j + 1], row[j]))
    return row[-1]


def ratio(a, b):
    if a is None or b is None:
        return 0
    if a == b:
        return 100
    if not a or not b:
        return 0
    return round(100 * (2 * lcs(a, b) / (len(a) + len(b))))


def test_rules(spark):
    cases = {
        "CI-build": "ci", " GitHub ": "git", "git package": "git", "report connector": "connector",
        "my-package": "package", "\t a ": "a", "tptp.x": "tptp", "Updater": "update", "xtest2": "xtest",
        "Reporting": "report", "Core": "core",
    }
    df = spark.createDataFrame([(k,) for k in cases], "name string")
    found = df.select("name", apply_rules(normalize(F.col("name")), COMPONENT_RULES).alias("c")).collect()
    assert {r["name"]: r["c"] for r in found} == cases


def test_four_reports(reports):
    assert select_existing(reports, REPORT_COLUMNS).columns == [
        c for c in REPORT_COLUMNS if c in reports.columns]
    fixed = canonical_components(reports)
    assert sorted(r[0] for r in fixed.select("component_name").collect()) == ["other", "ui", "ui", "ui"]
    pooled = pool_tail(fixed)
    assert Counter(r[0] for r in pooled.select("product_name").collect()) == {"product_other": 1, "product_69": 3}
    merged = namemerge.merge_names(pooled)
    assert Counter(r[0] for r in merged.select("assignee_name").collect()) == Counter(
        r[0] for r in reports.select("assignee_name").collect())
    cleaned = clean(reports)
    assert cleaned.columns == FINAL_COLUMNS and cleaned.count() == 4


def test_null_component_is_pooled(spark):
    df = spark.createDataFrame([(None,), ("ui",), ("ui",), ("ui",)], "component_name string")
    assert sorted(r[0] for r in canonical_components(df).collect()) == ["other", "ui", "ui", "ui"]


@pytest.mark.parametrize("names, expected", [
    (["a"] * 5, {"other": 5}),
    (["a"] * 96 + ["b"] * 4, {"other": 100}),
    (["a"] * 90 + ["b"] * 5 + ["c"] * 5, {"a": 90, "b": 5, "other": 5}),
    (["a"] * 9 + [None], {"other": 10}),
])
def test_pareto_cases(spark, names, expected):
    df = spark.createDataFrame([(n,) for n in names], "name string")
    assert Counter(r[0] for r in pool_tail(df, "name", 0.95, "other").collect()) == expected


def test_similarity_examples_and_random_pairs(spark):
    source = random.Random(1)
    pairs = [("serg.boyko2011", "sergg.boyko2011"), ("kitten", "sitting"), ("", "a"), ("", ""), (None, "a"),
             ("a", None), ("same", "same"), ("héé😀x", "hé😀xx"), ("a" * 70, "ab" * 40), ("x" * 62, "x" * 63)]
    for _ in range(150):
        n, m = source.randint(1, 75), source.randint(1, 75)
        pairs.append(tuple("".join(source.choice("abcdé") for _ in range(k)) for k in (n, m)))
    df = spark.createDataFrame(list(dict.fromkeys(pairs)), "a string, b string")
    found = df.select("a", "b", score(F.col("a"), F.col("b"), match_masks(F.col("b"))).alias("s")).collect()
    assert [(r["a"], r["b"], r["s"]) for r in found] == [(r["a"], r["b"], ratio(r["a"], r["b"])) for r in found]
    assert ratio("serg.boyko2011", "sergg.boyko2011") == 97 and ratio("kitten", "sitting") == 62


def brute_map(rows, scope="global"):
    counts = Counter((p, a) for p, a in rows if p is not None and a is not None)
    best = defaultdict(int)
    for (p, _), n in counts.items():
        best[p] = max(best[p], n)
    found = {}
    for (p, top), n in sorted(counts.items()):
        if n != best[p] or n < 2:
            continue
        for (q, a), _ in counts.items():
            if q == p and 60 < ratio(top, a) != 100:
                found[a if scope == "global" else (p, a)] = top
    return found


def as_map(df, scope="global"):
    return {(r["source"] if scope == "global" else (r["product_name"], r["source"])): r["target"]
            for r in df.collect()}


def names_table(spark, rows):
    return spark.createDataFrame(rows, "product_name string, assignee_name string")


def test_merge_cases(spark):
    rows = [("p", "serg.boyko2011")] * 3 + [("p", "sergg.boyko2011")] + [("q", "sergg.boyko2011")]
    merged = namemerge.merge_names(names_table(spark, rows))
    assert Counter(map(tuple, merged.collect())) == {("p", "serg.boyko2011"): 4, ("q", "serg.boyko2011"): 1}
    local = namemerge.merge_names(names_table(spark, rows), scope="block")
    assert Counter(map(tuple, local.collect())) == {
        ("p", "serg.boyko2011"): 4, ("q", "sergg.boyko2011"): 1}

    swap = [("p", "inbox-one")] * 2 + [("p", "inbox-two")] * 2 + [("p", None)]
    merged = namemerge.merge_names(names_table(spark, swap))
    assert Counter(r[1] for r in merged.collect()) == {"inbox-one": 2, "inbox-two": 2, None: 1}
    assert as_map(namemerge.rename_map(names_table(spark, swap), "product_name", "assignee_name")) == {
        "inbox-one": "inbox-two", "inbox-two": "inbox-one"}
    single = [("p", "inbox-one"), ("p", "inbox-onee")]
    assert namemerge.rename_map(names_table(spark, single), "product_name", "assignee_name").count() == 0


@pytest.mark.parametrize("limit", [10**8, 0])
@pytest.mark.parametrize("scope", ["global", "block"])
def test_many_tied_leaders(spark, bounds, monkeypatch, limit, scope):
    """Several rounds, and names cut into parts when leaders do not broadcast."""
    source = random.Random(5)
    rows = []
    for p in range(3):
        for _ in range(60):
            name = "".join(source.choice("abcd") for _ in range(6))
            rows += [(f"p{p}", name)] * source.choice([1, 2, 2])
    bounds(broadcastBytes=limit)
    monkeypatch.setattr(namemerge, "FIRST_ROUND", 2)
    monkeypatch.setattr(namemerge, "PAIRS_PER_TASK", 50)
    found = namemerge.rename_map(names_table(spark, rows), "product_name", "assignee_name", scope=scope)
    assert as_map(found, scope) == brute_map(rows, scope)


def test_similar_pairs_without_broadcast(spark, bounds):
    rows = [("p", "inbox-one")] * 3 + [("p", "inbox-two")] + [("q", "alpha")] * 2 + [("q", "alphabet")]
    expected = {("p", "inbox-one", "inbox-two", ratio("inbox-one", "inbox-two")),
                ("q", "alpha", "alphabet", ratio("alpha", "alphabet"))}
    for limit in (10**6, 0):
        bounds(broadcastBytes=limit)
        found = namemerge.similar_pairs(names_table(spark, rows), "product_name", "assignee_name")
        assert {(r[0], r[1], r[3], r[4]) for r in found.collect()} == {e for e in expected if e[3] > 60}


def test_job_equals_the_single_steps(spark, reports):
    more = reports.unionByName(reports.withColumn("product_name", F.lit("product_7"))).unionByName(reports)
    steps = pool_tail(namemerge.merge_names(canonical_components(more)))
    expected = Counter(map(tuple, select_existing(steps, FINAL_COLUMNS).collect()))
    assert Counter(map(tuple, clean(more).collect())) == expected
    rules = learn(more)
    assert rules.apply(more.drop("product_name")).count() == more.count()


def test_column_helpers(reports):
    text, other = split_by_type(reports, exclude=["reporter_name"])
    assert text == ["component_name", "product_name", "assignee_name"] and len(other) == 6
    assert split_target(reports, "product_name")[1] == "product_name"
    with pytest.raises(ValueError):
        split_target(reports, "absent")


def test_similarity_of_long_texts(spark):
    """Two and more words of bits, with carries across all of them."""
    source = random.Random(6)
    rows = [("a" * n, "a" * m) for n in (62, 63, 124, 125, 300) for m in (62, 63, 124, 186, 187)]
    for _ in range(60):
        n, m = source.randint(55, 200), source.randint(55, 200)
        rows.append(("".join(source.choices("abcdé", k=n)), "".join(source.choices("abcdé", k=m))))
    df = spark.createDataFrame(rows, "a string, b string")
    found = df.select("a", "b", score(F.col("a"), F.col("b"), match_masks(F.col("b"))).alias("s")).collect()
    assert all(r.s == ratio(r.a, r.b) for r in found)


def test_characters_rule_out_pairs_of_a_tied_block(spark):
    source = random.Random(9)
    names = sorted({"".join(source.sample("abcdefghijklmnopqrstuvwxyz", 10)) for _ in range(120)})
    df = spark.createDataFrame([("p", n, 2) for n in names], "block string, name string, n long")
    pairs = namemerge.counted(df, ["block", "name"], "n", "n")
    leaders = namemerge.store(namemerge.block_leaders(pairs, "block", "name").df)
    met = namemerge._meet(pairs.df.select("block", "name"), leaders, "block", "name", 100, 100)
    by_length = met.where(namemerge.can_exceed(F.col("name"), F.col("leader"), 60)).count()
    assert namemerge._candidates(met, "name", 60).count() < 0.3 * by_length == 0.3 * len(names) ** 2
    found = {(r.leader, r.name) for r in namemerge.similar_pairs(df, "block", "name", weight="n").collect()}
    assert found == {(a, b) for a in names for b in names if 60 < ratio(a, b) < 100}
