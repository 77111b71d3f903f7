"""Centroid clustering of vectors by progressive search over Walsh-Hadamard coefficients.

Components become integers, floor(scale * x). The Walsh-Hadamard transform H of n components
(n a power of two) is exact on integers and keeps distances: |Hx - Hc|^2 = n |x - c|^2. Its
coefficients are ordered by the number of sign changes, coarse to fine. The squared
differences of a vector to all centroids are added up block by block. The centroid that is
ahead after a block is finished at once; any centroid whose partial sum is already greater
than that whole distance is strictly worse and leaves. The survivors are finished over all
coefficients, so that the nearest centroid, the smaller number among equals, is exact.

The transform is linear: a centroid's sum of components is the transform of its sum of
coefficients, divided by n. So the coefficients of each vector are stored once, every round
is one scan of them, and a task returns at most one row per centroid.

Defined cases. A vector with a null, infinite or NaN component, of another length, or null is
left out. A null vec_id stays; it is hashed as the empty text. Vectors of equal hash (repeated
ids) are ordered by their components. Fewer vectors than centroids: each is a centroid.
Components beyond 2^55 count as 2^55; a distance or inertia beyond 2^63 - 1 is given as that
number (comparisons and centroids use the exact one). An empty table gives an empty result.
Columns other than vec_id and embedding are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tallyframe.llm.common import save

#: Vectors that are compared with all centroids at a time.
STEP = 2048
#: Ends of the blocks of coefficients, as shares of all coefficients.
BLOCKS = (16, 8, 4, 2, 1)
#: Largest coefficient whose distances stay within 64-bit integers (up to 64 components).
NARROW = 1 << 27
WIDEST = float(1 << 55)
MOST = (1 << 63) - 1


def transform(values: np.ndarray) -> np.ndarray:
    """Coefficients of each row, ordered by sign changes; rows have a power of two of integers."""
    rows, n = values.shape
    out, half = values, 1
    while half < n:
        pairs = out.reshape(rows, n // (2 * half), 2, half)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2)
        out = out.reshape(rows, n)
        half *= 2
    return out[:, sequency(n)]


def sequency(n: int) -> np.ndarray:
    """Positions of the Hadamard rows by their number of sign changes."""
    at = np.arange(n)
    signs = np.array([[bin(i & j).count("1") & 1 for j in at] for i in at])
    return np.argsort((np.diff(signs, axis=1) != 0).sum(axis=1), kind="stable")


def undo(coefficients: list[int]) -> list[int]:
    """The components behind coefficients; exact, as the transform is its own inverse times n."""
    n = len(coefficients)
    back = np.empty((1, n), object)
    back[0, sequency(n)] = [int(v) for v in coefficients]
    again = transform(back)[0]
    natural = np.empty(n, object)
    natural[sequency(n)] = again
    return [v // n for v in natural]


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Per vector the nearest centroid and the transformed distance; also the squares taken.

    Both are arrays of coefficients, of one integer type that holds the distances.
    """
    n, work = vectors.shape[1], 0
    ends = sorted({max(1, n // b) for b in BLOCKS})
    every = np.arange(len(vectors))
    row = np.repeat(every, len(centroids))
    column = np.tile(np.arange(len(centroids)), len(vectors))
    partial = np.zeros(len(row), vectors.dtype)
    bound, begin = None, 0
    for end in ends:
        gap = vectors[row, begin:end] - centroids[column, begin:end]
        partial = partial + (gap * gap).sum(axis=1)
        work += gap.size
        if end < n:
            starts = np.searchsorted(row, every)
            least = np.minimum.reduceat(partial, starts)
            ahead = np.flatnonzero(partial == least[row])
            leader = column[ahead[np.searchsorted(row[ahead], every)]]
            rest = vectors[:, end:] - centroids[leader, end:]
            whole = least + (rest * rest).sum(axis=1)
            bound = whole if bound is None else np.minimum(bound, whole)
            stay = partial <= bound[row]
            row, column, partial = row[stay], column[stay], partial[stay]
        begin = end
    starts = np.searchsorted(row, every)
    least = np.minimum.reduceat(partial, starts)
    first = np.flatnonzero(partial == least[row])
    return column[first[np.searchsorted(row[first], every)]], least, work


def assign(vectors: np.ndarray, centroids: list[list[int]]) -> Iterator[tuple[int, int, list, list]]:
    """Yield (begin, end, clusters, distances) for slices of vectors (int64 coefficients).

    Wide values are compared as Python integers, all others in 64 bits.
    """
    n = vectors.shape[1]
    exact = np.array(centroids, object).reshape(len(centroids), n)
    centroids_narrow = max((abs(v) for c in centroids for v in c), default=0) <= NARROW
    narrow = exact.astype(np.int64) if centroids_narrow else None
    for begin in range(0, len(vectors), STEP):
        part = vectors[begin:begin + STEP]
        if centroids_narrow and n <= 64 and np.abs(part).max(initial=0) <= NARROW:
            cluster, total, _ = nearest(part, narrow)
        else:
            cluster, total, _ = nearest(part.astype(object), exact)
        yield begin, begin + len(part), cluster, total // n


def coefficient_rows(column: pa.Array, n: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.int64).reshape(-1, n)


def prepare(table: DataFrame, dims: int, scale: int) -> DataFrame:
    """Stored rows (vec_id, coefficients) of the vectors that are kept."""
    if dims < 1 or dims & (dims - 1):
        raise ValueError("dims must be a power of two")
    x = F.col("embedding").cast("array<double>")
    usable = F.col("x").isNotNull() & (F.size("x") == dims) & F.forall(
        "x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))
    kept = table.select(F.col("vec_id").cast("bigint"), x.alias("x")).where(usable)

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.asarray(batch.column(1).flatten(), np.float64).reshape(-1, dims)
            with np.errstate(over="ignore"):
                whole = np.clip(np.floor(values * scale), -WIDEST, WIDEST).astype(np.int64)
            made = transform(whole).reshape(-1)
            offsets = pa.array(np.arange(0, len(made) + 1, dims, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(made))],
                names=["vec_id", "coefficients"])

    return save(kept.mapInArrow(turn, "vec_id bigint, coefficients array<bigint>"), "coefficients")


def first_centroids(vectors: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The vectors of the k smallest hashes of `seed:vec_id`, as components."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    # equal hashes are repeated ids: at most k rows of one id can be among the first k
    top = vectors.orderBy(hashed, "coefficients").limit(k).select("coefficients").collect()
    return [undo(row[0]) for row in top]


def coefficients_of(centroids: list[list[int]], dims: int) -> list[list[int]]:
    if not centroids:
        return []
    return [list(r) for r in transform(np.array(centroids, object).reshape(len(centroids), dims))]


def recentre(vectors: DataFrame, centroids: list[list[int]], dims: int) -> list[list[int]]:
    """One round: assign all vectors, then move each non-empty centroid to its floored mean."""
    held = coefficients_of(centroids, dims)

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(held), dims), object)
        counts = np.zeros(len(held), np.int64)
        for batch in batches:
            rows = coefficient_rows(batch.column(0), dims)
            for begin, end, cluster, _ in assign(rows, held):
                part = rows[begin:end]
                # halves of 32 bits: no sum of a slice leaves 64 bits
                for number in np.unique(cluster):
                    mine = part[cluster == number]
                    low = (mine & 0xFFFFFFFF).sum(axis=0)
                    sums[number] += (mine >> 32).sum(axis=0).astype(object) * (1 << 32) + low
                    counts[number] += len(mine)
        for number in np.flatnonzero(counts):
            yield pa.RecordBatch.from_arrays([
                pa.array([int(number)], pa.int32()), pa.array([int(counts[number])], pa.int64()),
                pa.array([[Decimal(int(v)) for v in sums[number]]], pa.list_(pa.decimal128(38, 0))),
            ], names=["cluster", "n", "sums"])

    added = (
        vectors.select("coefficients")
        .mapInArrow(totals, "cluster int, n bigint, sums array<decimal(38,0)>")
        .select("cluster", "n", F.posexplode("sums").alias("at", "total"))
        .groupBy("cluster", "at").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    )
    moved = [list(c) for c in centroids]
    found: dict[int, dict[int, tuple[int, int]]] = {}
    for row in added.collect():  # k * dims rows
        found.setdefault(row.cluster, {})[row.at] = (int(row.total), row.n)
    for number, by_place in found.items():
        total = undo([by_place[at][0] for at in range(dims)])
        moved[number] = [v // by_place[0][1] for v in total]
    return moved


def cluster(
    table: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, seed: int = 2,
) -> tuple[DataFrame, list[list[int]]]:
    """Rows (vec_id, cluster, distance) of all kept vectors, stored, and the final centroids."""
    vectors = prepare(table, dims, scale)
    centroids = first_centroids(vectors, k, seed)
    for _ in range(rounds if centroids else 0):
        centroids = recentre(vectors, centroids, dims)
    held = coefficients_of(centroids, dims)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for begin, end, number, distance in assign(coefficient_rows(batch.column(1), dims), held):
                far = [Decimal(int(min(d, 10**38 - 1))) for d in distance] \
                    if distance.dtype == object else distance
                kind = pa.decimal128(38, 0)
                yield pa.RecordBatch.from_arrays([
                    ids.slice(begin, end - begin), pa.array(number.astype(np.int32)),
                    pa.array(far, kind) if distance.dtype == object else pa.array(far).cast(kind),
                ], names=["vec_id", "cluster", "distance"])

    return save(vectors.mapInArrow(place, "vec_id bigint, cluster int, distance decimal(38,0)"),
                "clusters"), centroids


def as_long(value: Column) -> Column:
    return F.least(value, F.lit(Decimal(MOST))).cast("bigint")


def report(table: DataFrame, **options) -> DataFrame:
    """Per kept vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    spark: SparkSession = table.sparkSession
    placed, centroids = cluster(table, **options)
    sums = placed.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()  # k rows
    every = sum(int(r.s) for r in sums)
    form = T.StructType([
        T.StructField("cluster", T.IntegerType()), T.StructField("cluster_inertia", T.LongType()),
        T.StructField("inertia", T.LongType()), T.StructField("centroid_sha256", T.StringType()),
    ])
    found = spark.createDataFrame([
        (r.cluster, min(int(r.s), MOST), min(every, MOST), digest(centroids[r.cluster])) for r in sums
    ], form)
    return placed.withColumn("distance", as_long(F.col("distance"))).join(
        F.broadcast(found), "cluster").select(  # one row per centroid
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def digest(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(str(v) for v in centroid).encode()).hexdigest()
