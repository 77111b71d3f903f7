"""Most frequent values by mergeable sketches, recounted exactly.

Every task counts the values of its rows in a table of bounded size. When the table is full
the smallest counts leave it, and the greatest count that left is added to the task's
error: no value of the task lacks more than that. Sketches of all tasks add up per value,
and so do the errors. A value in no sketch, or whose count plus error is below
the k-th greatest count, is not among the k most frequent; the others are counted again,
exactly, unless the error is zero. Where the error reaches the k-th count itself, as in columns of
keys, nothing is proven, and the column is counted in full.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from tallyframe.materialize import Sized, store
from tallyframe.operators.lookup import attach

#: Values that a task's table of one column holds, and their bytes.
ENTRIES = 4096
BYTES = 16 << 20


class Sketch:
    """Counts of the most frequent values; no value lacks more than `error`."""

    def __init__(self, entries: int = ENTRIES, size: int = BYTES):
        self.counts: dict[str, int] = {}
        self.error, self.bytes = 0, 0
        self.entries, self.size = entries, size

    def add(self, value: str, n: int) -> None:
        if value not in self.counts:
            self.bytes += len(value)
        self.counts[value] = self.counts.get(value, 0) + n
        if len(self.counts) > 2 * self.entries or self.bytes > 2 * self.size:
            self.shrink()

    def shrink(self) -> None:
        """Keep the greatest counts that the bounds allow."""
        ordered = sorted(self.counts.items(), key=lambda e: (-e[1], e[0]))
        kept, held = 0, 0
        for value, _ in ordered[:self.entries]:
            held += len(value)
            if held > self.size:
                break
            kept += 1
        if kept < len(ordered):
            self.error += ordered[kept][1]
            self.counts = dict(ordered[:kept])
            self.bytes = sum(map(len, self.counts))


def sketch(cells: DataFrame, columns: Sequence[str]) -> Sized:
    """Per column and value n, a lower bound of its count; and one row without a value, n its error.

    `cells` has the text columns "0", "1", ... of `columns`, which may hold nulls.
    """
    schema = pa.schema([("column", pa.int32()), ("value", pa.string()), ("n", pa.int64())])
    width = len(columns)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = [Sketch() for _ in range(width)]
        for batch in batches:
            for i, found in enumerate(made):
                for each in pc.value_counts(batch.column(i).drop_null()).to_pylist():
                    found.add(each["values"], each["counts"])
        for i, found in enumerate(made):
            found.shrink()
            yield pa.RecordBatch.from_arrays([
                pa.array([i] * (len(found.counts) + 1), pa.int32()),
                pa.array([*found.counts, None], pa.string()),
                pa.array([*found.counts.values(), found.error], pa.int64())], schema=schema)

    return store(
        cells.mapInArrow(count, "column int, value string, n bigint")
        .groupBy("column", "value").agg(F.sum("n").alias("n")))


def candidates(found: Sized, k: int) -> tuple[dict[int, int], dict[int, int]]:
    """Per column its error, and the k-th greatest lower bound, zero if there are fewer values."""
    errors = {r["column"]: r["n"] for r in found.df.where("value IS NULL").collect()}
    window = Window.partitionBy("column").orderBy(F.desc("n"))
    ranked = found.df.where("value IS NOT NULL").withColumn("rank", F.row_number().over(window))
    return errors, {r["column"]: r["n"] for r in ranked.where(F.col("rank") == k).collect()}


def top_counts(cells: DataFrame, columns: Sequence[str], k: int) -> tuple[DataFrame, list[int]]:
    """Exact counts that hold the `k` most frequent values of each proven column; and the other columns.

    The table has column, value, n; columns go by name there and by position in the list.
    """
    found = sketch(cells, columns)
    errors, kth = candidates(found, k)
    unproven = [i for i in errors if errors[i] >= max(1, kth.get(i, 0))]
    again = [i for i in errors if 0 < errors[i] and i not in unproven]
    names = F.array(*[F.lit(c) for c in columns])
    sketched = found.df.where("value IS NOT NULL")
    settled = [i for i in errors if errors[i] == 0]
    counts = sketched.where(F.col("column").isin(settled))
    if again:
        least = F.element_at(F.create_map(*[F.lit(x) for i in again for x in (i, kth[i] - errors[i])]), F.col("column"))
        asked = store(sketched.where(F.col("column").isin(again)).where(F.col("n") >= least).select("column", "value"))
        entries = F.explode(F.array(*[
            F.struct(F.lit(i).alias("column"), F.col(str(i)).alias("value")) for i in again]))
        rows = cells.select(entries.alias("e")).select("e.*").where("value IS NOT NULL")
        counts = counts.unionByName(
            attach(rows, asked, ["column", "value"], "inner").groupBy("column", "value").agg(F.count("*").alias("n")))
    return counts.select(F.get(names, F.col("column")).alias("column"), "value", "n"), unproven
