"""Mixing sources to target weights by capped water-filling.

A document's size is its number of `[^\\x20\\x09-\\x0D]+` words. Sources, by code point
and null last, weigh WEIGHTS in turn and share all sizes; a target stops at MOST times
its source's size, and the excess is dealt again by weight until none is above.

A source's documents are taken floor(target / size) times, and the rest of the target
once more by a seeded order of documents (an MD5 of seed and doc_id, so repeated rows
stand together): the ones whose middle lies within the rest. The threshold of that
order is found by two rounds of histograms over digits of the digest, so no source,
of whatever size, is gathered or sorted.

Null texts and texts without words have size zero; a source without words has target
zero; an empty table gives an empty mix; other columns are ignored or, in the mix, kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyframe.llm.common import HOT_SHARE, only_columns, save
from tallyframe.materialize import store
from tallyframe.operators.ordering import rank_rows

WEIGHTS = (5, 2, 1)
MOST = 3
SEED = "mix"
#: Hex digits of the digest that order a source's documents, and those of a histogram round.
DIGITS, ROUND = 15, 3


def size_of(text: Column) -> Column:
    """Words between ASCII white space; `\\s` of the pattern is exactly x20 and x09-x0D."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def place_of(doc_id: Column, seed: str) -> Column:
    """Place in the seeded order, 60 bits."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("bigint")


def source_key(source: Column) -> Column:
    """A key that is never null; the null source comes last in its order."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source.cast("string")))


def sized(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """Per row: doc_id, key (of its source), size, place."""
    return save(only_columns(docs, "doc_id", "source", "text").select(
        "doc_id", source_key(F.col("source")).alias("key"), size_of(F.col("text")).alias("size"),
        place_of(F.col("doc_id"), seed).alias("place")), "sizes")


def fill(sources: DataFrame, most: int = MOST) -> DataFrame:
    """Add `target` to sources (key, source_size, weight).

    Each round fixes the sources above their cap and deals what is left by weight;
    it reads sums of the source table, never its rows.
    """
    size, weight = F.col("source_size"), F.col("weight")
    total, weights, count = sources.agg(F.sum(size), F.sum(weight), F.count("*")).first()
    capped_size, capped_weight, capped = 0, 0, 0
    while True:
        left, rest = (total or 0) - most * capped_size, (weights or 0) - capped_weight
        over = size * F.lit(most * rest) < F.lit(left) * weight if rest else F.lit(True)
        now = sources.where(over).agg(F.sum(size), F.sum(weight), F.count("*")).first()
        if now[2] == capped or not rest:
            break
        capped_size, capped_weight, capped = now[0] or 0, now[1] or 0, now[2]
    share = (F.lit(left) * weight).cast("double") / F.lit(float(max(1, rest)))
    return sources.withColumn(
        "target", F.when(over, (size * most).cast("double")).otherwise(share))


def targets(rows: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Per source: key, n, source_size, target."""
    sums = store(rows.groupBy("key").agg(F.count("*").alias("n"), F.sum("size").alias("source_size")))
    ranked = rank_rows(sums, [F.col("key")], "place_of_source")
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]),
                        ((F.col("place_of_source") - 1) % len(weights) + 1).cast("int"))
    weighed = save(ranked.select("key", "n", "source_size", turn.cast("bigint").alias("weight")), "sources")
    return save(fill(weighed, most).drop("weight"), "targets")


def thresholds(rows: DataFrame, goals: DataFrame) -> DataFrame:
    """Per source: key, source_size, target, whole, and `last`: places up to it are taken once more."""
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(ratio + 1e-12).cast("bigint")
    plan = goals.withColumn("whole", whole).withColumn(
        "need", F.greatest(F.lit(0.0), F.col("target") - F.col("whole") * F.col("source_size")))
    # a source in which the running total passes `need` has the threshold in one bucket
    plan = save(plan.withColumn("low", F.lit(0).cast("bigint")).withColumn("base", F.lit(0).cast("bigint")),
                "plans")
    for k in range(1, 3):
        width = 16 ** (DIGITS - ROUND * k)
        bucket = F.expr(f"place div {width}").cast("bigint")
        span = width * 16 ** ROUND
        near = _with_plan(rows, plan, "low", "need").where(F.col("need") > 0)
        if k > 1:
            near = near.where((F.col("place") >= F.col("low")) & (F.col("place") < F.col("low") + F.lit(span)))
        sums = near.groupBy("key", bucket.alias("bucket")).agg(F.sum("size").alias("held"))
        before = Window.partitionBy("key").orderBy("bucket")
        running = (
            sums.withColumn("upto", F.sum("held").over(before))  # at most 16^ROUND rows of a source
            .join(plan.select("key", "base", "need"), "key")
            .where(F.col("base") + F.col("upto") > F.col("need"))
            .groupBy("key").agg(F.min_by(F.struct("bucket", "upto", "held"), "bucket").alias("b"))
            .select("key", (F.col("b.bucket") * width).alias("new_low"),
                    (F.col("b.upto") - F.col("b.held")).alias("passed"))
        )
        # where nothing passes, the whole span is taken
        plan = save(
            plan.join(running, "key", "left").select(
                "key", "n", "source_size", "target", "whole", "need",
                # null: the total never passes `need`
                F.coalesce("new_low", F.lit(None).cast("bigint") if k == 1 else F.col("low")).alias("low"),
                (F.col("base") + F.coalesce("passed", F.lit(0))).alias("base")),
            "plans")
    width = 16 ** (DIGITS - 2 * ROUND)
    last = _with_plan(rows, plan, "low", "need", "base").where(
        (F.col("place") >= F.col("low")) & (F.col("place") < F.col("low") + F.lit(width)))
    ordered = Window.partitionBy("key").orderBy("place")
    chosen = (
        last.groupBy("key", "place", "need", "base").agg(F.sum("size").alias("held"))
        .withColumn("upto", F.col("base") + F.sum("held").over(ordered))
        .where(F.col("upto") - F.col("held") / 2 <= F.col("need"))
        .groupBy("key").agg(F.max("place").alias("chosen"))
    )
    everything = F.lit(16 ** DIGITS)
    return save(
        plan.join(chosen, "key", "left").select(
            "key", "n", "source_size", "target", "whole",
            F.when(F.col("need") <= 0, F.lit(-1)).when(F.col("low").isNull(), everything)
            .otherwise(F.coalesce("chosen", F.col("low") - 1)).cast("bigint").alias("last")),
        "thresholds")


def _with_plan(rows: DataFrame, plan: DataFrame, *columns: str) -> DataFrame:
    return with_source(rows, plan.select("key", "n", *columns)).drop("n")


def with_source(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Join rows with the row of their source; hot sources are always broadcast.

    At most 1/HOT_SHARE sources hold more than that share of the rows, and these are
    broadcast; the rows of all others, none of which can fill a task, are shuffled.
    When no such source exists, nothing shuffles.
    """
    total, hot = sources.agg(
        F.sum("n"), F.count("*")).first()
    if (hot or 0) <= 1 / HOT_SHARE:
        return rows.join(F.broadcast(sources), "key")
    floor = int((total or 0) * HOT_SHARE)
    heavy, light = sources.where(F.col("n") > floor), sources.where(F.col("n") <= floor)
    heavy_rows = rows.join(F.broadcast(heavy), "key")
    light_rows = rows.join(F.broadcast(heavy.select("key")), "key", "left_anti").join(light, "key")
    return heavy_rows.unionByName(light_rows)


def times(place: Column) -> Column:
    """How often a document is taken."""
    return F.col("whole") + F.when(place <= F.col("last"), 1).otherwise(0)


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST, seed: str = SEED) -> DataFrame:
    """Per row: doc_id, size, source_size, target, taken (words the mix takes of it)."""
    rows = sized(docs, seed)
    plan = thresholds(rows, targets(rows, weights, most))
    return with_source(rows, plan).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * times(F.col("place"))).alias("taken"))


def apply(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST, seed: str = SEED,
) -> DataFrame:
    """The mix itself: every document as often as it is taken, numbered by `repetition` from 1.

    A given column of that name is replaced; all others are kept.
    """
    rows = sized(docs, seed)
    plan = thresholds(rows, targets(rows, weights, most))
    columns = [c for c in docs.columns if c.lower() != "repetition"]
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc")).select(
        "doc", source_key(F.col("doc.source")).alias("key"))
    taken = with_source(held, plan).withColumn("times", times(place_of(F.col("doc.doc_id"), seed)))
    return taken.where("times > 0").select(
        "doc.*", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("times"))).alias("repetition"))


#: The same mix in SQL, for the weights 5, 2, 1 and the cap of 3.
SQL = """
WITH d AS (
  SELECT doc_id, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size,
         CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS key,
         ('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15))::BIGINT AS place
  FROM documents),
s AS (
  SELECT key, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY encode(key)) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM d GROUP BY key),
o AS (
  SELECT *, sum(source_size) OVER () AS total, sum(weight) OVER () AS weights,
         coalesce(sum(source_size) OVER below, 0) AS less_size,
         coalesce(sum(weight) OVER below, 0) AS less_weight
  FROM s WINDOW below AS (ORDER BY source_size / weight, key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (  -- the first source, by its cap per weight, that is not above its cap
  SELECT min_by(total - 3 * less_size, less_size * 1000 + less_weight) AS lft,
         min_by(weights - less_weight, less_size * 1000 + less_weight) AS rest
  FROM o WHERE 3 * source_size * (weights - less_weight) >= (total - 3 * less_size) * weight),
t AS (
  SELECT key, source_size,
         CASE WHEN 3 * source_size * rest < lft * weight THEN CAST(3 * source_size AS DOUBLE)
              ELSE CAST(lft * weight AS DOUBLE) / CAST(rest AS DOUBLE) END AS target
  FROM s, f),
p AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size + 1e-12) AS BIGINT) ELSE 0 END AS whole
  FROM t),
r AS (
  SELECT d.doc_id, d.size, p.source_size, p.target, p.whole,
         greatest(0.0, p.target - p.whole * p.source_size) AS need,
         sum(d.size) OVER (PARTITION BY d.key ORDER BY d.place) AS upto,
         sum(d.size) OVER (PARTITION BY d.key, d.place) AS held
  FROM d JOIN p ON d.key = p.key)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (size * (whole + CASE WHEN need > 0 AND upto - held / 2 <= need THEN 1 ELSE 0 END))::BIGINT AS taken
FROM r
"""
