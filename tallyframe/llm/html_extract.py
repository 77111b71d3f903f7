"""Main text of web pages by wrappers inferred per host.

Every page is read as a tree of tags and text slots. Pages of one host are aligned
one after the other into a union-free regular expression: text that differs becomes a
slot, tags that only some pages have become optional, equal neighbours become repeated
groups. Pages of equal shape are merged by Spark before that, and the shapes of a host
are merged in groups of at most GROUP, round by round, so that a host of any number of
pages is never gathered. The host's article region is the path that most of its text
votes for; the texts of the template that are fixed there are left out of its pages.

Pages without main elements are then read through their host's wrapper, which tells the slot of
each of their texts. A text that over half of the pages with its slot have there, and at
least SUPPORT of them, is template, also if the slot is optional or repeated. So is an element
beside the article's that is template for the most part, with what varies in it. What is left
is the article. A page of which over wrappers.COPIES would go is a copy and stays whole.

The article is the region without menus, headers, footers, sidebars, notices, adverts,
forms, scripts, styles and reader comments, known beforehand by tag or by class, id and role.
Of a page with main elements it is what these hold; inside them only a whole name counts, a
part of a class does not. A page's own region holds all of
these blocks, so its host's region takes nothing from it. Blocks are the texts between
block-level tags. Null or empty html gives an empty text; pages with a null url form a
host of their own; repeated rows are extracted each; other columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallyframe.llm import wrappers
from tallyframe.llm.common import batch_of, bounded_batches, bring_back, save, texts
from tallyframe.materialize import Sized, store

#: Shapes of a host that one task merges.
GROUP = 200
#: Distinct pages that must have a text in one slot before it counts as template.
SUPPORT = 3


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)", 1))


def shapes(pages: DataFrame) -> DataFrame:
    """Per page: host, shape (JSON), region, size (characters in it), bare (it has no main element)."""
    schema = pa.schema([("host", pa.string()), ("shape", pa.string()), ("region", pa.string()),
                        ("size", pa.int64()), ("bare", pa.bool_())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made, regions, sizes, bare = [], [], [], []
            for html in texts(batch, "html"):
                page = wrappers.Page(html.decode())
                region = page.region()
                made.append(json.dumps(wrappers.shape(page.tree), ensure_ascii=False))
                regions.append(region)
                sizes.append(len(page.article()))
                bare.append(not page.mains)
            yield batch_of(schema, {
                "host": batch.column(0), "shape": made, "region": regions, "size": sizes, "bare": bare})

    return pages.select(host_of(F.col("url")).alias("host"), "html").mapInArrow(
        read, "host string, shape string, region string, size bigint, bare boolean")


def infer(read: DataFrame) -> DataFrame:
    """Per host: n (pages), region, fixed (JSON of its fixed texts), wrapper (JSON)."""
    votes = read.groupBy("host", "region").agg(F.sum("size").alias("size"))
    regions = votes.groupBy("host").agg(
        F.max_by("region", F.struct("size", "region")).alias("region"), F.sum("size").alias("size"))
    found = save(read.groupBy("host", "shape").agg(F.count("*").alias("n")), "shapes")

    def merge(group: pa.Table) -> pa.Table:
        wrapper = None
        for text in sorted(group["shape"].to_pylist()):
            one = json.loads(text)
            wrapper = one if wrapper is None else wrappers.merge(wrapper, one)
        return pa.table({
            "host": group["host"][:1], "n": pa.array([sum(group["n"].to_pylist())]),
            "shape": pa.array([json.dumps(wrapper, ensure_ascii=False)])})

    form = "host string, n bigint, shape string"
    while True:
        per_host = found.groupBy("host").agg(F.count("*").alias("shapes"), F.sum("n").alias("pages"))
        most = per_host.agg(F.max("shapes")).first()[0] or 0
        if most <= 1:
            break
        groups = -(-most // GROUP)
        found = save(
            found.withColumn("part", F.pmod(F.xxhash64("shape"), F.lit(groups)))
            .groupBy("host", "part").applyInArrow(merge, form).select("host", "shape", "n"), "shapes")
    joined = found.join(regions, "host").select("host", "n", "region", "size", F.col("shape").alias("wrapper"))
    schema = pa.schema([("host", pa.string()), ("n", pa.int64()), ("region", pa.string()),
                        ("fixed", pa.string()), ("wrapper", pa.string())])

    def fixed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            yield batch_of(schema, {
                "host": batch.column(0), "n": batch.column(1), "region": batch.column(2),
                "fixed": [json.dumps(wrappers.fixed_texts(
                    json.loads(r["wrapper"]), r["region"], r["size"] / r["n"]), ensure_ascii=False) for r in rows],
                "wrapper": batch.column(4)})

    return save(joined.mapInArrow(
        fixed, "host string, n bigint, region string, fixed string, wrapper string"), "wrappers")


def with_host(rows: DataFrame, plans: Sized, salt_by: Column) -> DataFrame:
    """Join `rows` with what is known of their host; hosts with many rows are split."""
    if plans.broadcastable:
        return rows.join(F.broadcast(plans.df.drop("n")), "host", "left")
    return bring_back(rows, plans.df, "host", "n", salt_by).drop("n")


def templates(read: DataFrame, inferred: DataFrame) -> DataFrame:
    """Per host whose wrapper shows template in pages without main elements: host, template (JSON).

    The JSON has the wrapper, its slots that are template whatever they hold, and [slot, value]
    of further template texts. Counts are over distinct shapes and combine before the
    shuffle; a slot has at most twice as many template values as a page has texts there.
    """
    bare = save(read.where("bare").groupBy("host", "shape").agg(F.count("*").alias("n")), "bare-shapes")
    hosts = bare.groupBy("host").agg(F.count("*").alias("found")).where(F.col("found") >= SUPPORT).select("host")
    known = store(inferred.join(hosts, "host", "left_semi").select("host", "n", "wrapper"))
    schema = pa.schema([("host", pa.string()), ("slot", pa.int32()), ("value", pa.string()), ("size", pa.int64())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for host, shape, wrapper in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                tree, numbers = _numbered(wrapper)
                # per slot a row without a value, then one per distinct value
                sizes: dict[tuple[int, str | None], int] = {}
                for slot, values in wrappers.read_page(tree, json.loads(shape), numbers):
                    for value in values:
                        size = wrappers.length_of(value)
                        sizes[slot, None] = sizes.get((slot, None), 0) + size
                        sizes[slot, value] = sizes.get((slot, value), 0) + size
                yield batch_of(schema, {
                    "host": [host] * len(sizes), "slot": [k for k, _ in sizes], "value": [v for _, v in sizes],
                    "size": list(sizes.values())})

    rows = with_host(bare.select("host", "shape"), known, F.col("shape")).where("wrapper IS NOT NULL")
    counted = save(
        rows.select("host", "shape", "wrapper")
        .mapInArrow(place, "host string, slot int, value string, size bigint")
        .groupBy("host", "slot", "value").agg(F.count("*").alias("found"), F.sum("size").alias("size"))
        .where(F.col("value").isNull() | (F.col("found") >= SUPPORT)), "slot-values")
    slots = counted.where("value IS NULL").select(
        "host", "slot", F.col("found").alias("pages"), F.col("size").alias("chars"))
    shared = (
        counted.where("value IS NOT NULL").join(slots, ["host", "slot"]).where(2 * F.col("found") > F.col("pages"))
        .groupBy("host", "slot").agg(F.sum("size").alias("fixed"), F.collect_list("value").alias("values")))
    per_host = slots.join(shared, ["host", "slot"], "left").groupBy("host").agg(
        F.collect_list(F.struct("slot", "chars", "fixed", "values")).alias("slots"),
        F.count("fixed").alias("any")).where(F.col("any") > 0)
    out = pa.schema([("host", pa.string()), ("template", pa.string())])

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for wrapper, slots in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                tree = json.loads(wrapper)
                whole = wrappers.template_slots(tree, {s["slot"]: (s["chars"], s["fixed"] or 0) for s in slots})
                values = sorted([s["slot"], v] for s in slots for v in s["values"] or ())
                made.append(json.dumps([tree, whole, values], ensure_ascii=False))
            yield batch_of(out, {"host": batch.column(0), "template": made})

    return save(known.df.join(per_host, "host").select("host", "wrapper", "slots").mapInArrow(
        decide, "host string, template string"), "templates")


@lru_cache(maxsize=8)
def _numbered(wrapper: str) -> tuple[list, dict[int, int]]:
    tree = json.loads(wrapper)
    return tree, wrappers.number(tree)


@lru_cache(maxsize=8)
def _template(text: str) -> tuple[list, set, set]:
    wrapper, slots, values = json.loads(text)
    return wrapper, set(slots), {tuple(v) for v in values}


def extract(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    bounded_batches(pages.sparkSession)
    pages = pages.select("page_id", "url", "html")
    read = save(shapes(pages), "page-shapes")
    inferred = infer(read)
    plans = store(inferred.select("host", "n", "fixed").join(templates(read, inferred), "host", "left"))
    planned = with_host(pages.withColumn("host", host_of(F.col("url"))), plans, F.col("page_id"))
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, text string"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            known = zip(*(batch.column(i).to_pylist() for i in (3, 4)), strict=True)
            for html, (fixed, template) in zip(texts(batch, "html"), known, strict=True):
                page = wrappers.Page(html.decode())
                drop = {tuple(x) for x in json.loads(fixed or "[]")}
                left_out = set()
                if template and not page.mains:
                    left_out = wrappers.template_blocks(page, *_template(template))
                found.append(page.article(drop, left_out) or page.article(drop) or page.article())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.string())], names=["page_id", "url", "text"])

    done = planned.select("page_id", "url", "html", "fixed", "template").mapInArrow(cut, schema)
    return done.withColumn("n_chars", F.length("text").cast("bigint"))
