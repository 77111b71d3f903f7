"""Merge near-duplicate names inside blocks (an exact blocked fuzzy join)."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tallyframe.functions.similarity import (
    can_exceed, character_counts, counts_can_exceed, match_masks, score,
)
from tallyframe.materialize import Sized, store
from tallyframe.operators.frequency import counted, top_of_group
from tallyframe.operators.lookup import attach, map_or_self
from tallyframe.operators.ordering import rank_rows

# Comparisons per task of the scoring stage.
PAIRS_PER_TASK = 200_000
# Leaders of one block that are tried in the first round; later rounds grow.
FIRST_ROUND = 16


def block_leaders(
    pairs: DataFrame | Sized, block: str, name: str, count: str = "n", min_count: int = 2
) -> Sized:
    """Names with the greatest count of their block (all ties), if frequent enough."""
    pairs = store(pairs)
    return pairs.reduced(
        top_of_group(pairs, block, count, "top_n").where(F.col("top_n") >= min_count)
        .select(block, F.col(name).alias("leader"), "top_n")
    )


def _with_masks(leaders: DataFrame) -> DataFrame:
    leader = F.col("leader")
    return leaders.withColumns({"_masks": match_masks(leader), "_leader_counts": character_counts(leader)})


def _with_counts(names: DataFrame, name: str) -> DataFrame:
    return names.withColumn("_counts", character_counts(F.col(name)))


def _meet(
    names: DataFrame, leaders: Sized, block: str, name: str, work: int, per_name: int
) -> DataFrame:
    """Pair each name with the leaders of its block, spread over many tasks.

    `work` bounds all comparisons and `per_name` those of one name. Leaders are
    few, so they broadcast when their measured size allows it and the names are
    spread evenly beforehand. Otherwise both sides are shuffled, and a block of
    many names is cut into parts that each get a copy of its leaders.
    """
    spark = names.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(work / PAIRS_PER_TASK))
    if leaders.broadcastable:
        spread = _with_counts(names.repartition(tasks, *names.columns), name)
        return spread.join(F.broadcast(_with_masks(leaders.df)), block)

    parts = store(names.groupBy(block).agg(
        F.ceil(F.count("*") * F.lit(per_name) / F.lit(PAIRS_PER_TASK)).cast("int").alias("_parts")
    ))
    cut = attach(names, parts, [block], "inner").withColumn(
        "_part", F.pmod(F.xxhash64(*names.columns), F.col("_parts")).cast("int")
    ).drop("_parts")
    copies = attach(_with_masks(leaders.df), parts, [block], "inner").withColumn(
        "_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))
    ).drop("_parts")
    dealt = _with_counts(cut.repartition(tasks, block, "_part"), name)
    return dealt.join(copies, [block, "_part"]).drop("_part")


def _candidates(met: DataFrame, name: str, threshold: int) -> DataFrame:
    """Pairs whose lengths and characters allow a score above `threshold`."""
    a, b = F.col(name), F.col("leader")
    counts = counts_can_exceed(a, b, F.col("_counts"), F.col("_leader_counts"), threshold)
    return met.where(can_exceed(a, b, threshold)).where(counts | (a == b))


def _scored(met: DataFrame, name: str, threshold: int) -> DataFrame:
    """Pairs above `threshold` that are not (or do not round to) a full match.

    The scores are integers, so one membership test states both conditions and
    the similarity is computed once per comparison.
    """
    return (
        _candidates(met, name, threshold)
        .withColumn("score", score(F.col(name), F.col("leader"), F.col("_masks")))
        .where(F.col("score").isin(list(range(threshold + 1, 100))))
        .drop("_masks", "_counts", "_leader_counts")
    )


def similar_pairs(
    df: DataFrame | Sized, block: str, name: str, threshold: int = 60, min_count: int = 2,
    weight: str | None = None,
) -> DataFrame:
    """All (block, leader, top_n, name, score) above the threshold."""
    pairs = counted(df, [block, name], "n", weight)
    leaders = store(block_leaders(pairs, block, name, "n", min_count).df)
    names = pairs.df.select(block, name)
    work = (
        names.groupBy(block).agg(F.count("*").alias("_names"))
        .join(leaders.df.groupBy(block).agg(F.count("*").alias("_leaders")), block)
        .agg(F.sum(F.col("_names") * F.col("_leaders")), F.max("_leaders")).first()
    )
    met = _meet(names, leaders, block, name, work[0] or 0, work[1] or 1)
    return _scored(met, name, threshold).select(block, "leader", "top_n", name, "score")


def rename_map(
    df: DataFrame | Sized, block: str, name: str, threshold: int = 60, min_count: int = 2,
    weight: str | None = None, scope: str = "global",
) -> DataFrame:
    """Which name is replaced by which leader: columns `source`, `target`.

    A name that matches several leaders takes the last one in (block, leader)
    order. With `scope="global"` a rename learned in one block holds for all;
    with `scope="block"` there is one row per block and name.

    Only the greatest matching leader of a block matters, so leaders are tried
    from the greatest down, a chunk per round, and names that are settled leave.
    """
    if scope not in ("global", "block"):
        raise ValueError(f"unknown scope {scope!r}")
    pairs = counted(df, [block, name], "n", weight)
    leaders = store(rank_rows(
        block_leaders(pairs, block, name, "n", min_count), [F.desc("leader")], "_rank", [block],
    ), deepest=F.max("_rank"))
    deepest = leaders.stats["deepest"] or 0

    names = pairs.replace(pairs.df.select(block, name))
    settled, low, size = [], 0, FIRST_ROUND
    while True:
        in_round = (F.col("_rank") > low) & (F.col("_rank") <= low + size)
        chunk = leaders.reduced(leaders.df.where(in_round).drop("_rank"))
        met = _meet(names.df, chunk, block, name, names.rows * min(size, deepest), size)
        best = _scored(met, name, threshold).groupBy(block, name).agg(
            F.max("leader").alias("target")
        )
        if low + size >= deepest:
            settled.append(best)
            break
        best = store(best)
        settled.append(best.df)
        low, size = low + size, size * 4
        deeper = leaders.reduced(leaders.df.where(F.col("_rank") > low).select(block).distinct())
        unsettled = names.df.join(best.df, [block, name], "left_anti")
        names = store(attach(unsettled, deeper, [block], "inner"))

    found = reduce(lambda a, b: a.unionByName(b), settled)
    if scope == "block":
        return found.select(block, F.col(name).alias("source"), "target")
    return found.groupBy(F.col(name).alias("source")).agg(
        F.max_by("target", F.struct(block, "target")).alias("target")
    )


def merge_names(
    df: DataFrame, block: str = "product_name", name: str = "assignee_name",
    threshold: int = 60, min_count: int = 2, scope: str = "global",
) -> DataFrame:
    """Replace near-duplicates of a block's most frequent name, in one pass."""
    mapping = rename_map(df, block, name, threshold, min_count, scope=scope)
    return map_or_self(df, mapping, name, within=[block] if scope == "block" else [])
