"""Group-count features, their lookup table and its use when scoring."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from tallyframe.materialize import Sized, row_bytes, store
from tallyframe.operators.frequency import group_means
from tallyframe.operators.lookup import attach

GROUP, COMPONENT, MEMBER = "product_name", "component_name", "assignee_name"
MEASURES = ["n_components", "n_assignees", "n_un_components", "n_product_rows"]


@dataclass(frozen=True)
class GroupCounts:
    """Counts learned from a table, ready to be attached to rows.

    * `n_components`: rows with the row's (group, component)
    * `n_assignees`: rows with the row's (group, member)
    * `n_un_components`: distinct components of the group
    * `n_product_rows`: rows of the group

    A measure is null where one of its keys is null.
    """

    by_component: Sized
    by_member: Sized
    by_group: Sized
    group: str
    component: str
    member: str

    def apply(self, df: DataFrame) -> DataFrame:
        order, out = df.columns, df
        lookups = [
            (self.by_component, [self.group, self.component]),
            (self.by_member, [self.group, self.member]), (self.by_group, [self.group])]
        # Joins that move the rows come first, while these carry no counts.
        for lookup, keys in sorted(lookups, key=lambda pair: pair[0].broadcastable):
            out = attach(out, lookup, keys)
        return out.select(*order, *MEASURES)


def learn_group_counts(
    df: DataFrame, group: str = GROUP, component: str = COMPONENT, member: str = MEMBER
) -> GroupCounts:
    """Count in one pass; a group of any size is combined before the shuffle.

    Group rows and distinct components are read off the (group, component)
    counts, so no group is ever gathered in one task. Either table of counts has its own
    size, so that many members do not keep few components from being broadcast.
    """
    sets = (
        df.where(F.col(group).isNotNull())
        .groupingSets([[group, component], [group, member]], group, component, member)
        .agg(F.count("*").alias("_n"), F.grouping(member).alias("_component_set"))
    )
    is_pair = F.col("_component_set") == 1

    def size(chosen, name: str):
        width = row_bytes(sets.select(group, name, "_n").schema)
        return F.struct(F.count_if(chosen).alias("rows"), F.coalesce(
            F.sum(F.when(chosen, width)), F.lit(0)).alias("bytes"))

    counts = store(sets, pairs=size(is_pair, component), members=size(~is_pair, member))
    pairs, members = (
        Sized(counts.df.where(chosen), counts.stats[name]["rows"], counts.stats[name]["bytes"])
        for name, chosen in (("pairs", is_pair), ("members", ~is_pair)))
    return GroupCounts(
        pairs.replace(pairs.df.where(F.col(component).isNotNull()).select(
            group, component, F.col("_n").alias("n_components"))),
        members.replace(members.df.where(F.col(member).isNotNull()).select(
            group, member, F.col("_n").alias("n_assignees"))),
        pairs.reduced(pairs.df.groupBy(group).agg(
            F.count(component).alias("n_un_components"), F.sum("_n").alias("n_product_rows"))),
        group, component, member,
    )


def group_features(df: DataFrame, **names) -> DataFrame:
    """The rows with the four group counts."""
    return learn_group_counts(df, **names).apply(df)


def feature_lookup(df: DataFrame, counts: GroupCounts | None = None, **names) -> DataFrame:
    """Distinct name triples with their counts: the lookup table to save."""
    counts = counts or learn_group_counts(df, **names)
    triples = df.select(counts.component, counts.group, counts.member).distinct()
    return counts.apply(triples)


def lookup_means(
    lookup: DataFrame, component: str = COMPONENT, member: str = MEMBER
) -> DataFrame:
    """Mean counts per (component, member) over distinct count combinations."""
    distinct = lookup.select(component, member, *MEASURES).distinct()
    return group_means(distinct, [component, member], MEASURES)


def score_lookup(
    df: DataFrame, means: DataFrame | Sized, on_missing: str = "zero",
    component: str = COMPONENT, member: str = MEMBER,
) -> DataFrame:
    """Left-join mean counts to rows that carry no group column.

    Adds `lookup_hit`. An unknown pair gets 0, the mean over all known pairs,
    or raises when the row is computed, as `on_missing` says ("keep" leaves null).
    """
    means = store(means)
    known = means.replace(means.df.withColumn("lookup_hit", F.lit(True)))
    out = attach(df, known, [member, component]).withColumn(
        "lookup_hit", F.coalesce("lookup_hit", F.lit(False)))
    if on_missing == "keep":
        return out.select(*df.columns, *MEASURES, "lookup_hit")
    if on_missing == "error":
        text = F.concat(F.lit("no counts for "), F.coalesce(component, F.lit("null")),
                        F.lit(" / "), F.coalesce(member, F.lit("null")))
        filled = {
            m: F.when(F.col("lookup_hit"), F.col(m)).otherwise(F.raise_error(text).cast("double"))
            for m in MEASURES
        }
    elif on_missing == "zero":
        filled = {m: F.coalesce(m, F.lit(0.0)) for m in MEASURES}
    elif on_missing == "mean":
        row = means.df.agg(*[F.avg(m).alias(m) for m in MEASURES]).first()
        filled = {m: F.coalesce(m, F.lit(row[m])) for m in MEASURES}
    else:
        raise ValueError(f"unknown on_missing {on_missing!r}")
    return out.withColumns(filled).select(*df.columns, *MEASURES, "lookup_hit")
