"""Benchmark decontamination with an FM-index per training shard.

Words are runs of `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]` after lower-casing A-Z. A window
is WINDOW consecutive words of an item; an item of fewer words, but not none, is one
window. The distinct windows are the phrases. A task gathers documents into shards of
a bounded number of words, indexes each, searches all phrases backwards at once,
locates their occurrences and merges them into spans. Words in no phrase, and
stretches shorter than any phrase, cannot be part of an occurrence: in the index they
are terminators. Long documents are cut with an overlap, so a shard stays bounded.

The benchmark is a stated query set: its phrases reach the tasks in blocks of bounded
size, one after the other over the same rows. Documents never shuffle.

Null texts and texts without words have no hits; a null item_id marks hits but is not
listed; repeated items count once; an empty benchmark hits nothing. Repeated rows have a
row each; empty documents give an empty result; other columns are kept, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tallyframe.llm.common import bounded_batches, free_name, save, texts
from tallyframe.llm.fmindex import FMIndex

WINDOW = 10
#: Words of documents per shard, and phrases per block.
SHARD_WORDS = 1 << 19
BLOCK_PHRASES = 1 << 17

#: Word bytes stay, A-Z become small, anything else is a space.
_WORD_BYTES = bytes(
    b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80
    else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)
ADDED = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
    T.StructField("items", T.ArrayType(T.LongType())),
])


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORD_BYTES).split()


def phrases(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(phrase, item_ids): the distinct windows, words joined by a space, with their items."""
    bounded_batches(benchmark.sparkSession)
    schema = pa.schema([("item_id", pa.int64()), ("phrase", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found = [], []
            for item, text in zip(batch.column(0).to_pylist(), texts(batch), strict=True):
                words = words_of(text)
                for at in range(max(1, len(words) - window + 1) if words else 0):
                    ids.append(item)
                    found.append(b" ".join(words[at:at + window]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(found, pa.binary())], schema=schema)

    cut_up = benchmark.select(F.col("item_id").cast("bigint"), "text").mapInArrow(
        cut, "item_id bigint, phrase binary")
    return cut_up.groupBy("phrase").agg(F.collect_set("item_id").alias("item_ids"))


class Block:
    """Phrases, given with their items, as arrays of symbols, and the number of every word in them."""

    def __init__(self, rows: list[tuple[bytes, list]]):
        split = [phrase.split(b" ") for phrase, _ in rows]
        self.symbol: dict[bytes, int] = {}
        for words in split:
            for word in words:
                self.symbol.setdefault(word, len(self.symbol) + 1)
        self.lengths = np.array([len(w) for w in split], np.int64)
        self.shortest, self.longest = int(self.lengths.min()), int(self.lengths.max())
        self.patterns = np.zeros((len(split), self.longest), np.int64)
        for row, words in zip(self.patterns, split, strict=True):
            row[self.longest - len(words):] = [self.symbol[w] for w in words]
        self.items = [items for _, items in rows]


class Shard:
    """Symbol sequences of documents, to be indexed together."""

    def __init__(self, block: Block, n: int):
        self.block, self.words = block, 0
        self.doc, self.first, self.runs = [], [], []
        self.hits: list[list] = [[] for _ in range(n)]

    def add(self, doc: int, symbols: np.ndarray, offset: int) -> None:
        """The stretches of `symbols` long enough for a phrase; offset: its first word."""
        if len(symbols) < self.block.shortest:
            return
        edges = np.flatnonzero(np.diff(np.r_[False, symbols > 0, False]))
        starts, ends = edges[::2], edges[1::2]
        for a, b in zip(starts, ends, strict=True):
            if b - a >= self.block.shortest:
                self.doc.append(doc)
                self.first.append(offset + a)
                self.runs.append(symbols[a:b])
                self.words += int(b - a)

    def flush(self) -> None:
        """Search all phrases and note (start, end, phrase) in `hits` of their documents."""
        if not self.runs:
            return
        block, lengths = self.block, np.array([len(r) + 1 for r in self.runs])
        begin = np.cumsum(lengths) - lengths
        text = np.zeros(int(lengths.sum()), np.int64)
        for at, run in zip(begin, self.runs, strict=True):
            text[at:at + len(run)] = run
        index = FMIndex(text, len(block.symbol))
        low, high = index.search(block.patterns, block.lengths)
        count = high - low
        rows = np.repeat(low - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
        phrase = np.repeat(np.arange(len(count)), count)
        at = index.locate(rows)
        run = np.searchsorted(begin, at, side="right") - 1
        start = np.array(self.first)[run] + at - begin[run]
        doc = np.array(self.doc)[run]
        by = np.argsort(doc, kind="stable")
        cuts = np.flatnonzero(np.diff(doc[by])) + 1
        for part in np.split(by, cuts):
            if len(part):
                self.hits[doc[part[0]]].append((start[part], phrase[part]))
        self.doc, self.first, self.runs, self.words = [], [], [], 0


def merged(starts: np.ndarray, ends: np.ndarray) -> list[list[int]]:
    """Union of [start, end) spans, in order; spans that touch become one."""
    if not len(starts):
        return []
    by = np.argsort(starts, kind="stable")
    starts, ends = starts[by], np.maximum.accumulate(ends[by])
    new = np.r_[True, starts[1:] > ends[:-1]]
    last = np.r_[np.flatnonzero(new)[1:] - 1, len(starts) - 1]
    return np.stack([starts[new], ends[last]], axis=1).tolist()


def search_batch(raw: list[bytes], block: Block) -> list[tuple[int, list, list]]:
    """(n_words, spans, items) of each text."""
    shard, sizes = Shard(block, len(raw)), []
    for doc, text in enumerate(raw):
        words = words_of(text)
        sizes.append(len(words))
        get = block.symbol.get
        for at in range(0, max(1, len(words)), SHARD_WORDS):
            part = words[at:at + SHARD_WORDS + block.longest - 1]
            shard.add(doc, np.fromiter((get(w, 0) for w in part), np.int64, len(part)), at)
            if shard.words >= SHARD_WORDS:
                shard.flush()
    shard.flush()
    out = []
    for size, hits in zip(sizes, shard.hits, strict=True):
        if hits:
            starts, found = np.concatenate([h[0] for h in hits]), np.concatenate([h[1] for h in hits])
            items = {i for p in np.unique(found) for i in block.items[p]}
            out.append((size, merged(starts, starts + block.lengths[found]), sorted(items)))
        else:
            out.append((size, [], []))
    return out


def find(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, out: str = "found") -> DataFrame:
    """The rows of `docs` with a struct `out`: n_words, spans (first word, word past the end), items."""
    spark = docs.sparkSession
    bounded_batches(spark)
    listed = save(phrases(benchmark, window), "phrases")
    columns = docs.columns
    schema = T.StructType([*docs.schema.fields, T.StructField(out, ADDED)])
    at = columns.index("text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(len(words_of(t)), [], []) for t in texts(batch)]
            yield with_found(batch, found)

    def with_found(batch: pa.RecordBatch, found: list) -> pa.RecordBatch:
        names = [f.name for f in ADDED.fields]
        kind = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(pa.list_(pa.int64()))),
                          ("items", pa.list_(pa.int64()))])
        made = pa.array([dict(zip(names, f, strict=True)) for f in found], kind)
        return pa.RecordBatch.from_arrays([*batch.columns, made], names=[*columns, out])

    def searcher(held):
        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = Block(held.value)
            for group in _gather(batches):
                sizes = [b.num_rows for b in group]
                raw = [t for b in group for t in texts(b)]
                results = search_batch(raw, block)
                done = 0
                for batch, n in zip(group, sizes, strict=True):
                    found = results[done:done + n]
                    done += n
                    if len(batch.columns) > len(columns):  # after an earlier block
                        before = batch.column(len(columns)).to_pylist()
                        found = [_join(a, b) for a, b in zip(before, found, strict=True)]
                    yield with_found(pa.RecordBatch.from_arrays(
                        batch.columns[:len(columns)], names=columns), found)
        return search

    def _join(before: dict, found: tuple) -> tuple:
        spans = np.array(before["spans"] + found[1], np.int64).reshape(-1, 2)
        return (found[0], merged(spans[:, 0], spans[:, 1]),
                sorted({*before["items"], *found[2]}))

    total = listed.count()
    blocks = -(-total // BLOCK_PHRASES)
    result = docs.select(*[F.col(f"`{c}`") for c in columns])
    if not blocks:
        return result.mapInArrow(count, schema)
    for k in range(blocks):
        part = listed if blocks == 1 else listed.where(
            F.pmod(F.xxhash64("phrase"), F.lit(blocks)) == k)
        rows = [(bytes(r.phrase), list(r.item_ids)) for r in part.collect()]
        if rows:
            held = spark.sparkContext.broadcast(rows)
            result = result.mapInArrow(searcher(held), schema)
    return result


def _gather(batches: Iterator[pa.RecordBatch], most: int = 32 << 20) -> Iterator[list]:
    """Batches together that hold about `most` bytes: the documents of some shards."""
    group, held = [], 0
    for batch in batches:
        group.append(batch)
        held += batch.nbytes
        if held >= most:
            yield group
            group, held = [], 0
    if group:
        yield group


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans."""
    found = find(docs.select("doc_id", "text"), benchmark).select("doc_id", "found.*")
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s[1] - s[0])
    listed = F.array_join(F.sort_array(F.col("items").cast("array<string>")), ",")
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(listed, 256).alias("items_sha256"), (hit > 0).alias("contaminated"), "spans")


def apply(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any benchmark window, with all their columns."""
    out = free_name(docs, "found")
    return find(docs, benchmark, out=out).where(F.size(F.col(out).getField("spans")) == 0).drop(out)
