import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from tallyframe.llm import centroids

SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
])


def plain(rows, k, rounds, dims):
    """Every distance computed, in Python integers."""
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda i: hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest()
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    middle = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), list(centroids.transform(
        np.array([r[1]], object))[0])))[:k]]
    place = lambda v: min(range(len(middle)), key=lambda c: (far(v, middle[c]), c))
    for _ in range(rounds):
        where = [place(v) for _, v in kept]
        for c in range(len(middle)):
            mine = [v for (_, v), w in zip(kept, where, strict=True) if w == c]
            if mine:
                middle[c] = [sum(col) // len(mine) for col in zip(*mine, strict=True)]
    where = [(i, place(v), far(v, middle[place(v)])) for i, v in kept]
    total = sum(d for *_, d in where)
    return sorted(((
        i, c, d, sum(e for _, b, e in where if b == c), total,
        hashlib.sha256(",".join(map(str, middle[c])).encode()).hexdigest()) for i, c, d in where), key=str)


def answer(spark, rows, **options):
    table = spark.createDataFrame(rows, SCHEMA).withColumn("cluster", F.lit("clash")).withColumn(
        "coefficients", F.lit(1))
    return sorted((tuple(r) for r in centroids.report(table, **options).collect()), key=str)


def test_transform_keeps_distances_and_can_be_undone():
    random.seed(3)
    a = np.array([[random.randrange(-999, 999) for _ in range(64)] for _ in range(20)])
    t = centroids.transform(a)
    assert (((t[0] - t[1:]) ** 2).sum(axis=1) == 64 * ((a[0] - a[1:]) ** 2).sum(axis=1)).all()
    assert all(centroids.undo(list(x)) == list(y) for x, y in zip(t, a, strict=True))
    changes = [(np.diff(np.sign(c)) != 0).sum() for c in centroids.transform(np.eye(64, dtype=np.int64)).T]
    assert changes == sorted(changes)


@pytest.mark.parametrize("seed", range(5))
def test_progressive_search_equals_full_search_with_ties(seed):
    rng = np.random.default_rng(seed)
    vectors = rng.integers(-3, 3, (300, 16))
    middle = np.concatenate([vectors[:6], vectors[2:5], rng.integers(-3, 3, (9, 16))])
    full = ((vectors[:, None] - middle[None]) ** 2).sum(axis=2)
    number, distance, work = centroids.nearest(
        centroids.transform(vectors), centroids.transform(middle))
    assert (number == full.argmin(axis=1)).all() and (distance == 16 * full.min(axis=1)).all()


def test_coarse_coefficients_rule_out_most_centroids():
    rng = np.random.default_rng(1)
    level = rng.integers(-5, 5, 300) * 100
    vectors = level[:, None] + rng.integers(-2, 2, (300, 64))
    middle = (np.arange(-5, 5) * 100)[:, None] + np.zeros((10, 64), np.int64)
    _, _, work = centroids.nearest(centroids.transform(vectors), centroids.transform(middle))
    assert work < 0.3 * 300 * 10 * 64


def test_clusters_match_brute_force(spark):
    random.seed(5)
    rows = [(i, [random.gauss(i % 5, 0.4) for _ in range(8)]) for i in range(150)]
    rows += [(i, list(rows[7][1])) for i in range(200, 260)]           # copies
    rows += [(3, list(rows[3][1])), (3, [9.0] * 8), (None, [1.5] * 8)]  # repeated and null ids
    rows += [(300, None), (301, []), (302, [1.0] * 7), (303, [1.0] * 7 + [None]),
             (304, [math.nan] * 8), (305, [math.inf] + [0.0] * 7)]
    assert answer(spark, rows, k=12, rounds=3, dims=8) == plain(rows, 12, 3, 8)


def test_more_centroids_than_vectors_and_wide_values(spark):
    rows = [(1, [1e6, -1e6]), (2, [1e6 + 1, 5.0]), (3, [2.0, 3.0]), (4, [2.0, 3.0]), (5, [2.0, 3.5])]
    assert answer(spark, rows, k=9, rounds=2, dims=2) == plain(rows, 9, 2, 2)
    assert answer(spark, rows, k=2, rounds=3, dims=2) == plain(rows, 2, 3, 2)


def test_beyond_64_bits_gives_the_largest_number(spark):
    rows = [(1, [1e300, 0.0]), (2, [-1e300, 0.0])]
    got = answer(spark, rows, k=1, rounds=1, dims=2)
    assert [r[2] for r in got] == [centroids.MOST] * 2 and got[0][4] == centroids.MOST


def test_no_vectors(spark):
    assert answer(spark, [], k=3, rounds=2, dims=4) == []
    assert answer(spark, [(1, None)], k=3, rounds=2, dims=4) == []
    with pytest.raises(ValueError):
        answer(spark, [], k=3, rounds=2, dims=6)
