"""The prefix trie of rebuilt conversations, from composable fingerprints.

A sequence of turns x1 .. xn has the fingerprint (n, x1 + x2 B + .. + xn B^(n-1) mod p), where
x is the digest of a turn and p a Mersenne prime. Fingerprints form a monoid,
(n, s)(m, t) = (n + m, s + B^n t), and s can be taken off again from the left. So the
fingerprint of every prefix of a rebuilt conversation follows from prefixes of the original
ones: the head of the base conversation times what is left of the own prefix without its own
head. No rebuilt text is ever made; a rebuilt turn is a reference to a stored turn.

1. Turns are digested, ordered by range partitioning and scanned per slice; one row per slice
   goes to the driver, whose composed products (one per slice) complete the prefixes that
   began in an earlier slice. A conversation of any length is thus spread over many tasks.
2. Every prefix of a rebuilt conversation is a row; prefixes of equal depth and fingerprint
   are a node. Equality is verified, not assumed: the members of a node must refer to stored
   turns of one digest. As fp = parent + x B^(depth-1), members of equal fp and x also share the
   fingerprint one turn shorter, so by induction their sequences agree. Stored turns of one
   digest must have the same role and text. If a check fails, all is done again with the
   next, longer digest and modulus of `STRENGTHS`.
3. The smallest member of a node owns it. A conversation c owns its path from some depth r(c)
   on, so r(c), its parent there and its bytes up to there describe the whole trie, and sums
   over subtrees become plain sums over the members of a node: a member c adds one leaf if it
   owns its last, childless node, one child if it owns the next node on its path, and as
   saved bytes those of the turns from the node on to r(c) that others own.

Defined cases. Turns are ordered by turn number (null first), then role, then the digest of the
text; repeated turns all count. A null role or text is empty. Rows without conv_id belong to no
conversation and are left out. The base of c is c - c % 5, with the remainder's sign that of c.
An empty table has no nodes. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallyframe.llm import bloom
from tallyframe.llm.common import bounded_batches, bring_back, save

#: (bits of the turn digest, exponent of the Mersenne prime), tried in this order.
STRENGTHS = ((256, 127), (512, 521))
#: Turns of a base conversation that can head another one, and members of a family.
LONGEST_HEAD = 8
FAMILY = 5
#: Rows of a slice of the ordered turns.
SLICE_ROWS = 500_000
#: Bytes of joined ids that are packed into one row.
PACK_BYTES = 1 << 16


@dataclass(frozen=True)
class Ring:
    """Fingerprints modulo 2^exponent - 1, stored as fixed-size bytes."""

    exponent: int

    @property
    def prime(self) -> int:
        return (1 << self.exponent) - 1

    @property
    def base(self) -> int:
        return int.from_bytes(hashlib.sha512(b"turns").digest(), "big") % self.prime

    def pack(self, value: int) -> bytes:
        return value.to_bytes((self.exponent + 7) // 8, "big")

    def power(self, n: int) -> int:
        return pow(self.base, n, self.prime)

    def compose(self, first: tuple[int, int], second: tuple[int, int]) -> tuple[int, int]:
        n, s = first
        return n + second[0], (s + self.power(n) * second[1]) % self.prime

    def without_head(self, head: tuple[int, int], whole: tuple[int, int]) -> tuple[int, int]:
        """The element that composed after `head` gives `whole`."""
        n, s = head
        return whole[0] - n, (whole[1] - s) * self.power(-n) % self.prime


def digest(bits: int) -> Column:
    """Digest of role and text, each preceded by its length."""
    role, text = (F.coalesce(F.col(c), F.lit("")).cast("binary") for c in ("role", "text"))
    whole = F.concat(F.octet_length(role).cast("string").cast("binary"), F.lit(b":"), role, text)
    return F.unhex(F.sha2(whole, bits))


def digested(conversations: DataFrame, bits: int) -> DataFrame:
    return conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
        digest(bits).alias("digest"),
        F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint").alias("bytes"))


def same_texts(conversations: DataFrame, turns: DataFrame, rows: int, bits: int) -> bool:
    """Whether stored turns of one digest have one role and one text.

    Turns whose digest cannot repeat pass a Bloom filter and do not shuffle.
    """
    if bits > 256:
        turns = turns.withColumn("digest", F.substring("digest", 1, 32))
    held = bloom.build(turns, "digest", rows, repeated=True)
    whole = digested(conversations, bits).select(
        F.substring("digest", 1, 32).alias("front"), "digest", "role", "text")
    repeated = bloom.with_flag(whole, "front", held, "maybe").where("maybe")
    kinds = repeated.groupBy("digest", "role", "text").agg(F.lit(1))
    return kinds.groupBy("digest").count().where("count > 1").isEmpty()


def slice_count(df: DataFrame, rows: int, slice_rows: int) -> int:
    """Slices of an ordered table: as many as the session shuffles to, or more."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, math.ceil(rows / slice_rows))


def prefixes(turns: DataFrame, rows: int, ring: Ring, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Per turn: conv_id, pos (from 1), fp and total (of the original turns up to pos), digest."""
    form = "conv_id bigint, slice int, pos bigint, fp binary, total bigint, digest binary, bytes bigint"
    prime, base = ring.prime, ring.base

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, pos, s, weight, total = None, 0, 0, 1, 0
        for batch in batches:
            at, prints, totals = [], [], []
            for conv, turn_digest, size in zip(
                    batch.column(0).to_pylist(), batch.column(2).to_pylist(),
                    batch.column(3).to_pylist(), strict=True):
                if conv != now:
                    now, pos, s, weight, total = conv, 0, 0, 1, 0
                s = (s + int.from_bytes(turn_digest, "big") * weight) % prime
                weight = weight * base % prime
                pos, total = pos + 1, total + size
                at.append(pos)
                prints.append(ring.pack(s))
                totals.append(total)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(at, pa.int64()),
                 pa.array(prints, pa.binary()), pa.array(totals, pa.int64()), batch.column(2),
                 batch.column(3)],
                names=["conv_id", "slice", "pos", "fp", "total", "digest", "bytes"])

    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "digest"]
    slices = save(
        turns.repartitionByRange(slice_count(turns, rows, slice_rows), *order)
        .sortWithinPartitions(*order)
        .select("conv_id", F.spark_partition_id().alias("slice"), "digest", "bytes")
        .mapInArrow(scan, form),
        "turn-slices",
    )
    # One row per slice: where it begins and ends, and the product of its last conversation.
    ends = slices.groupBy("slice").agg(
        F.min("conv_id").alias("first"),
        F.max_by(F.struct("conv_id", "pos", "fp", "total"), F.struct("conv_id", "pos")).alias("last"))
    carried, open_conv, element, total = {}, None, (0, 0), 0
    for row in sorted(ends.collect(), key=lambda r: r.slice):
        if row.first == open_conv:
            carried[row.slice] = (open_conv, element, total)
        else:
            element, total = (0, 0), 0
        last = (row.last.pos, int.from_bytes(row.last.fp, "big"))
        if row.last.conv_id == row.first:
            element, total = ring.compose(element, last), total + row.last.total
        else:
            element, total = last, row.last.total
        open_conv = row.last.conv_id
    if not carried:
        return slices.drop("slice")
    held = slices.sparkSession.sparkContext.broadcast(carried)  # one entry per slice at most

    def complete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {name: batch.column(i).to_pylist() for i, name in enumerate(batch.schema.names)}
            for i, (conv, part) in enumerate(zip(columns["conv_id"], columns["slice"], strict=True)):
                found = held.value.get(part)
                if found and found[0] == conv:
                    own = (columns["pos"][i], int.from_bytes(columns["fp"][i], "big"))
                    pos, s = ring.compose(found[1], own)
                    columns["pos"][i], columns["fp"][i] = pos, ring.pack(s)
                    columns["total"][i] += found[2]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[f.name], f.type) for f in batch.schema], schema=batch.schema)

    return save(slices.mapInArrow(complete, form).drop("slice"), "turn-prefixes")


def families(prefix: DataFrame) -> DataFrame:
    """Per conversation: n, h (its own head's length), own (its first turns), head (of its base).

    `own` and `head` hold at most LONGEST_HEAD elements of (pos, fp, total, digest, bytes).
    """
    element = F.struct("pos", "fp", "total", "digest", "bytes")
    each = prefix.groupBy("conv_id").agg(
        F.max("pos").alias("n"), F.max("total").alias("total"),
        F.sort_array(F.collect_list(F.when(F.col("pos") <= LONGEST_HEAD, element))).alias("own"))
    each = each.withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY).withColumn(
        "h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (LONGEST_HEAD + 1)).cast("int"))
    each = save(each, "conversation-heads")
    bases = each.where(F.col("conv_id") == F.col("base")).select("base", F.col("own").alias("lead"))
    head = F.slice(F.coalesce("lead", F.array().cast("array<struct<pos:bigint,fp:binary,total:bigint,"
                                                     "digest:binary,bytes:bigint>>")), 1, F.col("h"))
    joined = each.join(bases, "base", "left").withColumn("head", head)
    taken = F.size("head")
    return save(joined.select(
        "conv_id", "n", "h", "head",
        (taken + F.greatest(F.col("n") - F.col("h"), F.lit(0))).cast("bigint").alias("length"),
        F.when((F.col("h") > 0) & (F.col("n") > F.col("h")),
               F.try_element_at("own", F.col("h"))).alias("cut"),
        F.when(taken > 0, F.try_element_at("head", taken)).alias("end"), "total",
    ).withColumn(
        "all_bytes", F.coalesce("end.total", F.lit(0)) + F.when(
            F.col("n") > F.col("h"), F.col("total") - F.coalesce("cut.total", F.lit(0))).otherwise(0),
    ).drop("total"), "families")


def rebuilt_prefixes(prefix: DataFrame, family: DataFrame, ring: Ring) -> DataFrame:
    """Per prefix of a rebuilt conversation: conv_id, length, depth, fp, parent, digest, total, bytes.

    parent is the fingerprint one turn shorter; total are the bytes of the texts up to here.
    """
    zero = ring.pack(0)
    roots = family.select(
        "conv_id", "length", F.lit(0).cast("bigint").alias("depth"), F.lit(zero).alias("fp"),
        F.lit(zero).alias("parent"), F.lit(b"").alias("digest"), F.lit(0).cast("bigint").alias("total"),
        F.lit(0).cast("bigint").alias("bytes"))
    before = F.when(F.col("at") > 0, F.expr("head[at - 1].fp")).otherwise(F.lit(zero))
    heads = family.select("conv_id", "length", "head", F.posexplode("head").alias("at", "turn")).select(
        "conv_id", "length", F.col("turn.pos").alias("depth"), "turn.fp", before.alias("parent"),
        "turn.digest", "turn.total", "turn.bytes")

    # The rest of a conversation, with the constants of its head; long ones are split.
    rest = bring_back(
        prefix,
        family.where("n > h").select(
            "conv_id", "n", "length", "h", F.col("cut.fp").alias("cut_fp"),
            F.coalesce("cut.total", F.lit(0)).alias("cut_total"),
            F.size("head").alias("taken"), F.col("end.fp").alias("end_fp"),
            F.coalesce("end.total", F.lit(0)).alias("end_total")),
        "conv_id", "n", F.col("pos"), "inner").where("pos > h")
    schema = "conv_id bigint, length bigint, depth bigint, fp binary, parent binary, digest binary, " \
             "total bigint, bytes bigint"

    def join_heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prime, weights = ring.prime, [ring.power(n) for n in range(LONGEST_HEAD + 1)]
        inverse = [ring.power(-n) for n in range(LONGEST_HEAD + 1)]
        for batch in batches:
            col = {name: batch.column(i).to_pylist() for i, name in enumerate(batch.schema.names)}
            depth, prints, parents, totals = [], [], [], []
            for conv, pos, h, taken, fp, cut, end, turn in zip(*[
                    col[c] for c in ("conv_id", "pos", "h", "taken", "fp", "cut_fp", "end_fp", "digest")],
                    strict=True):
                head = int.from_bytes(end or b"", "big")
                own = (int.from_bytes(fp, "big") - int.from_bytes(cut or b"", "big")) * inverse[h]
                now = (head + weights[taken] * own) % prime
                d = taken + pos - h
                # the last turn off again, from the right: fp = parent + B^(d-1) x
                last = int.from_bytes(turn, "big") * pow(ring.base, d - 1, prime)
                depth.append(d)
                prints.append(ring.pack(now))
                parents.append(ring.pack((now - last) % prime))
            totals = [e + t - c for e, t, c in zip(
                col["end_total"], col["total"], col["cut_total"], strict=True)]
            yield pa.RecordBatch.from_arrays([
                pa.array(col["conv_id"], pa.int64()), pa.array(col["length"], pa.int64()),
                pa.array(depth, pa.int64()), pa.array(prints, pa.binary()),
                pa.array(parents, pa.binary()), pa.array(col["digest"], pa.binary()),
                pa.array(totals, pa.int64()), pa.array(col["bytes"], pa.int64()),
            ], names=["conv_id", "length", "depth", "fp", "parent", "digest", "total", "bytes"])

    return save(
        roots.unionByName(heads).unionByName(rest.mapInArrow(join_heads, schema)), "rebuilt-prefixes")


def find_nodes(members: DataFrame) -> tuple[DataFrame, bool]:
    """The nodes, and whether the members of each refer to equal turns."""
    nodes = save(members.groupBy("depth", "fp").agg(
        F.min("conv_id").alias("owner"), F.count("*").alias("n_convs"),
        F.max("length").alias("deepest"), F.min("total").alias("total"),
        F.min("parent").alias("parent"),
        (F.min("digest") == F.max("digest")).alias("equal"),
    ), "trie-nodes")
    return nodes, nodes.where("NOT equal").isEmpty()


def chains(nodes: DataFrame, family: DataFrame) -> DataFrame:
    """Per conversation: from_depth r, its parent's owner there, bytes shared, and whether it ends in a leaf."""
    owned = save(nodes.groupBy("owner").agg(
        F.min(F.struct("depth", "parent")).alias("top"),
        F.max((F.col("deepest") == F.col("depth")).cast("int")).alias("leaf"),
    ).select(
        "owner", F.col("top.depth").alias("from_depth"), "leaf",
        F.struct((F.col("top.depth") - 1).alias("depth"), F.col("top.parent").alias("fp")).alias("above"),
    ), "trie-chains")
    tops = bring_back(
        owned.where("from_depth > 0"),
        nodes.select(F.struct("depth", "fp").alias("above"), "n_convs",
                     F.col("owner").alias("above_owner"), F.col("total").alias("shared")),
        "above", "n_convs", F.col("owner"), "left").select("owner", "above_owner", "shared")
    whole = owned.join(tops, "owner", "left").select(
        F.col("owner").alias("conv_id"), "from_depth", "above_owner", "shared", "leaf")
    # A conversation that owns no node is a copy of a smaller one, or all of it begins one.
    return family.join(whole, "conv_id", "left").select(
        "conv_id", "length", "above_owner", (F.col("length") + 1).alias("n_prefixes"),
        F.coalesce("from_depth", F.col("length") + 1).alias("from_depth"),
        F.when(F.col("from_depth").isNull(), F.col("all_bytes"))
        .otherwise(F.coalesce("shared", F.lit(0))).alias("shared"),
        F.coalesce("leaf", F.lit(0)).alias("leaf"))


def end_digests(members: DataFrame, rows: int, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Per node with whole conversations: the SHA-256 of their ids, ascending and comma-joined.

    A slice of the ordered ids is packed into rows of PACK_BYTES; the digest of a node reads
    its packs in order, one at a time.
    """
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, first, held, size = None, 0, [], 0

        def row():
            return pa.RecordBatch.from_arrays([
                pa.array([node[0]], pa.int64()), pa.array([node[1]], pa.binary()),
                pa.array([first], pa.int64()), pa.array([",".join(held)], pa.string()),
            ], names=["depth", "fp", "first", "ids"])

        for batch in batches:
            for depth, fp, conv in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                if (depth, fp) != node or size > PACK_BYTES:
                    if held:
                        yield row()
                    node, first, held, size = (depth, fp), conv, [], 0
                held.append(str(conv))
                size += len(held[-1]) + 1
        if held:
            yield row()

    def hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None

        def rows(done):
            return pa.RecordBatch.from_arrays([
                pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.binary()),
                pa.array([d[2] for d in done], pa.string())], names=["depth", "fp", "ends_sha256"])

        for batch in batches:
            done = []
            for depth, fp, ids in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                if (depth, fp) != node:
                    if node:
                        done.append((*node, state.hexdigest()))
                    node, state = (depth, fp), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield rows(done)
        if node:
            yield rows([(*node, state.hexdigest())])

    bounded_batches(members.sparkSession)
    order = ["depth", "fp", "conv_id"]
    packs = (
        members.where("depth = length").select(*order)
        .repartitionByRange(slice_count(members, rows, slice_rows), *order)
        .sortWithinPartitions(*order)
        .mapInArrow(pack, "depth bigint, fp binary, first bigint, ids string")
    )
    return (
        packs.repartition("depth", "fp").sortWithinPartitions("depth", "fp", "first")
        .select("depth", "fp", "ids").mapInArrow(hash_ids, "depth bigint, fp binary, ends_sha256 string")
    )


@dataclass(frozen=True)
class Trie:
    """members: one row per prefix of a rebuilt conversation; nodes and chains of the trie."""

    members: DataFrame
    nodes: DataFrame
    chains: DataFrame
    attempts: int


def build(conversations: DataFrame, strengths=STRENGTHS) -> Trie:
    for attempt, (bits, exponent) in enumerate(strengths, 1):
        ring = Ring(exponent)
        turns = save(digested(conversations, bits).drop("text"), "turns")
        rows = turns.count()
        prefix = prefixes(turns, rows, ring)
        family = families(prefix)
        members = rebuilt_prefixes(prefix, family, ring)
        nodes, equal = find_nodes(members)
        if equal and same_texts(conversations, turns, rows, bits):
            return Trie(members, nodes, save(chains(nodes, family), "trie-paths"), attempt)
    raise RuntimeError("different turns share a fingerprint at every strength")


def report(conversations: DataFrame, strengths=STRENGTHS) -> DataFrame:
    """Per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    trie = build(conversations, strengths)
    each = bring_back(trie.members, trie.chains.drop("length"), "conv_id", "n_prefixes",
                      F.col("depth"), "inner")
    d, r = F.col("depth"), F.col("from_depth")
    owns_next = (r <= d + 1) & (d + 1 <= F.col("length"))
    # the bytes from this node's own turn on, up to where the member owns its path
    saved = F.when(r > d, F.col("shared") - F.col("total") + F.col("bytes")).otherwise(0)
    above = F.when(d == r, F.col("above_owner")).when(d > r, F.col("conv_id"))
    found = each.groupBy("depth", "fp").agg(
        F.min(F.struct("conv_id", above.alias("above"))).alias("top"), F.count("*").alias("n_convs"),
        F.sum(owns_next.cast("bigint")).alias("n_children"),
        F.sum(F.col("leaf").cast("bigint")).alias("n_leaves"),
        F.sum(saved.cast("bigint")).alias("saved_tokens"))
    ends = end_digests(trie.members, trie.chains.count())
    return found.join(ends, ["depth", "fp"], "left").select(
        F.col("top.conv_id").alias("conv_id"), "depth", F.col("top.above").alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
