import random
from collections import Counter

from pyspark.sql import functions as F

from tallyframe.operators import heavyhitters, profiling


def plain(values, k):
    counts = Counter(v for v in values if v is not None)
    return sorted(counts.items(), key=lambda e: (-e[1], e[0]))[:k]


def test_a_sketch_lacks_no_more_than_its_error():
    random.seed(4)
    values = [str(int(random.paretovariate(0.7))) for _ in range(30_000)] + [f"u{i}" for i in range(3000)]
    random.shuffle(values)
    for entries, size in ((20, 1 << 20), (200, 1 << 20), (5000, 60)):
        found = heavyhitters.Sketch(entries, size)
        for v in values:
            found.add(v, 1)
        found.shrink()
        counts = Counter(values)
        assert len(found.counts) <= entries and sum(map(len, found.counts)) <= size
        assert all(counts[v] - found.error <= found.counts.get(v, 0) <= counts[v] for v in counts)
    whole = heavyhitters.Sketch(100_000)
    for v in values:
        whole.add(v, 1)
    assert whole.error == 0 and whole.counts == Counter(values)


def test_frequent_values_by_sketches_equal_a_full_count(spark, bounds, monkeypatch):
    monkeypatch.setattr(heavyhitters, "ENTRIES", 64)
    monkeypatch.setattr(heavyhitters.Sketch.__init__, "__defaults__", (64, heavyhitters.BYTES))
    rows = 20_000
    skewed = F.when(F.col("id") % 3 > 0, F.col("id") % 12).otherwise(F.col("id"))
    df = spark.range(rows, numPartitions=8).select(
        (F.col("id") % 7).alias("few"), skewed.alias("heavy"), F.col("id").alias("unique"),
        F.when(F.col("id") % 5 == 0, F.col("id") % 2).alias("gaps"), F.lit(None).cast("string").alias("none"),
        F.when(F.col("id") % 2 == 0, F.repeat(F.lit("long "), 500)).otherwise(F.col("id").cast("string")).alias("text"))
    given = df.toPandas()
    bounds(countedRows=0)
    got = profiling.frequent_values(df, df.columns, 5).collect()
    for c in df.columns:
        values = [None if v is None or v != v else str(int(v)) if not isinstance(v, str) else v for v in given[c]]
        mine = [(r.value, r.n) for r in sorted((r for r in got if r["column"] == c), key=lambda r: r["rank"])]
        assert mine == plain(values, 5), c
    cells = df.select(*[F.col(c).cast("string").alias(str(i)) for i, c in enumerate(df.columns)])
    counts, unproven = heavyhitters.top_counts(cells, df.columns, 5)
    assert set(unproven) == {2, 5}  # keys, and one text among keys
    held = Counter(r["column"] for r in counts.collect())
    assert held["few"] == 7 and held["heavy"] < 600 and held["unique"] == 0


def test_frequent_values_of_nothing(spark, bounds):
    bounds(countedRows=-1)
    df = spark.createDataFrame([], "a string, b int")
    assert profiling.frequent_values(df, ["a", "b"]).count() == 0
