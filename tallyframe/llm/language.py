"""Language identification with language-bitmask n-gram filters.

Texts become letters, lower-cased one by one, with one blank for any run of other
characters; n-grams of several orders are hashed. The filter has one row per bit
position and one bit per language in it (a bit-sliced Bloom filter): the AND of an
n-gram's rows is the set of languages that hold it. Per document and language the
n-grams held are counted, each count is corrected for the filter's false positives,
and the largest decides; its share is the score.

Learning: of every language the n-grams are counted over a sample of SAMPLE training
documents at most (all, where it has fewer; the least hashes of doc_id are taken). A
language holds an n-gram whose relative frequency there is at least FLOOR and at least
RATIO of that in the language where it is most frequent. Counts are summed by Spark.

Rows with crc32(doc_id) mod FOLDS = HELD_OUT or a null lang teach nothing. A null text,
or one without letters, is `und` with score 0; so is every text if nothing was learned.
Ties go to the language first in code point order. Repeated rows count each. An empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tallyframe.llm.common import batch_of, bounded_batches, save, texts
from tallyframe.llm.quality import in_fold

FOLDS, HELD_OUT = 5, 0
SAMPLE = 10_000
ORDERS = (2, 3, 4, 5)
HASHES = 2
#: Rows of the filter for up to 64 languages; more languages take further slices.
ROWS = 1 << 20
FLOOR, RATIO = 2e-6, 0.2
#: Letters of a text that are handled at once.
CHUNK = 1 << 16
NONE = "und"
_MIX = np.uint64(0x9E3779B97F4A7C15)


def letter_table() -> np.ndarray:
    """For every code point: its lower-case letter, or a blank if it is no letter."""
    table = np.full(0x110000, 32, np.uint32)
    for code in range(0x110000):
        c = chr(code)
        if c.isalpha():
            low = c.lower()
            table[code] = ord(low) if len(low) == 1 else code
    return table


def letters_of(text: bytes, letters: np.ndarray) -> np.ndarray:
    """Letters and single blanks, with a blank at either end; empty if there is no letter."""
    codes = letters[np.frombuffer(text.decode().encode("utf-32-le"), np.uint32)]
    blank = codes == 32
    if blank.all():
        return np.zeros(0, np.uint32)
    keep = ~(blank & np.r_[True, blank[:-1]])
    end = [] if blank[-1] else [np.uint32(32)]
    return np.r_[np.uint32(32), codes[keep], end].astype(np.uint32)


def grams(codes: np.ndarray) -> Iterator[np.ndarray]:
    """64-bit hashes of the n-grams of each order, in chunks of bounded size."""
    for at in range(0, len(codes), CHUNK):
        part = codes[at:at + CHUNK + max(ORDERS) - 1].astype(np.uint64)
        value = part.copy()
        for n in range(2, max(ORDERS) + 1):
            if len(part) < n:
                break
            # 21 bits a letter; longer grams mix what overflows
            value = (value[:-1] * _MIX) ^ (value[:-1] >> np.uint64(29)) ^ part[n - 1:]
            if n in ORDERS:
                own = value[:min(len(value), CHUNK)]
                mixed = (own ^ np.uint64(n)) * _MIX
                yield mixed ^ (mixed >> np.uint64(32))


def spots(hashes: np.ndarray, rows: int, k: int) -> np.ndarray:
    return ((hashes * np.uint64(2 * k + 1)) >> np.uint64(7 + 17 * k)) & np.uint64(rows - 1)


def learned_counts(docs: DataFrame, letters) -> DataFrame:
    """(lang, gram, n) over the training sample of each language; `letters` is a broadcast."""
    training = docs.where(F.col("lang").isNotNull() & ~in_fold(FOLDS, HELD_OUT))
    sizes = training.groupBy("lang").agg(F.count("*").alias("docs"))
    # a hash below the sampling rate: about SAMPLE documents of a larger language
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / (1 << 20)
    sample = training.join(F.broadcast(sizes), "lang").where(place < F.lit(SAMPLE) / F.col("docs")).select("lang", "text")
    schema = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])

    def out(lang: str, held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        found, n = np.unique(np.concatenate(held), return_counts=True)
        for at in range(0, len(found), 100_000):
            part = found[at:at + 100_000]
            yield batch_of(schema, {
                "lang": pa.array([lang] * len(part)), "gram": pa.array(part.view(np.int64)),
                "n": pa.array(n[at:at + 100_000].astype(np.int64))})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}
        size: dict[str, int] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), texts(batch), strict=True):
                for hashes in grams(letters_of(text, letters.value)):
                    held.setdefault(lang, []).append(hashes)
                    size[lang] = size.get(lang, 0) + len(hashes)
                    if size[lang] >= 4_000_000:
                        yield from out(lang, held.pop(lang))
                        size[lang] = 0
        for lang, parts in held.items():
            yield from out(lang, parts)

    return sample.mapInArrow(count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(
        F.sum("n").alias("n"))


class Filter:
    """Bit-sliced Bloom filters of all languages."""

    def __init__(self, letters: np.ndarray, langs: list[str], table: np.ndarray):
        """table: (slices, ROWS) of uint64; language i is bit i % 64 of slice i // 64."""
        self.letters, self.langs, self.table = letters, langs, table
        filled = np.array([
            ((table[i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() for i in range(len(langs))])
        self.false = filled ** HASHES

    def score(self, text: bytes) -> tuple[str, float]:
        codes = letters_of(text, self.letters)
        if not len(codes) or not self.langs:
            return NONE, 0.0
        total, held = 0, np.zeros(len(self.langs))
        for hashes in grams(codes):
            total += len(hashes)
            rows = [spots(hashes, self.table.shape[1], k).astype(np.int64) for k in range(HASHES)]
            for s, slice_ in enumerate(self.table):
                masks = slice_[rows[0]]
                for r in rows[1:]:
                    masks = masks & slice_[r]
                for bit in range(min(64, len(self.langs) - 64 * s)):
                    held[64 * s + bit] += np.count_nonzero(masks & np.uint64(1 << bit))
        real = np.clip((held - self.false * total) / np.maximum(1 - self.false, 1e-9), 0, None)
        best = int(np.argmax(real))
        return self.langs[best], float(real[best] / real.sum()) if real.sum() else 0.0


def learn(docs: DataFrame, letters) -> tuple[list[str], np.ndarray]:
    """The languages, in code point order, and the table of the filter."""
    counts = save(learned_counts(docs, letters), "gram-counts")
    totals = {r.lang: r.n for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    langs = sorted(totals)
    slices = max(1, -(-len(langs) // 64))
    table = np.zeros((slices, ROWS), np.uint64)
    if not langs:
        return langs, table
    number = counts.sparkSession.createDataFrame(
        [(lang, i, float(totals[lang])) for i, lang in enumerate(langs)], "lang string, i int, total double")
    share = counts.join(F.broadcast(number), "lang").select("gram", "i", (F.col("n") / F.col("total")).alias("share"))
    best = Window.partitionBy("gram")  # a gram has at most one row per language
    held = share.withColumn("best", F.max("share").over(best)).where(
        (F.col("share") >= FLOOR) & (F.col("share") >= RATIO * F.col("best"))).select("gram", "i")
    schema = pa.schema([("slice", pa.int32()), ("row", pa.int32()), ("mask", pa.int64())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gram = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            i = batch.column(1).to_numpy(zero_copy_only=False)
            mask = (np.uint64(1) << (i % 64).astype(np.uint64)).view(np.int64)
            for k in range(HASHES):
                yield batch_of(schema, {
                    "slice": pa.array((i // 64).astype(np.int32)),
                    "row": pa.array(spots(gram, ROWS, k).astype(np.int32)), "mask": pa.array(mask)})

    rows = held.mapInArrow(place, "slice int, row int, mask bigint").groupBy("slice", "row").agg(
        F.bit_or("mask").alias("mask")).toArrow()  # at most slices * ROWS rows
    at = rows["slice"].to_numpy(), rows["row"].to_numpy()
    table[at] = rows["mask"].to_numpy().view(np.uint64)
    return langs, table


def predict(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score."""
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = docs.select(F.col("doc_id").cast("bigint"), "text", "lang")
    letters = spark.sparkContext.broadcast(letter_table())
    learned = spark.sparkContext.broadcast(learn(docs, letters))
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()),
                        ("lang_pred", pa.string()), ("score", pa.float64())])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Filter(letters.value, *learned.value)
        for batch in batches:
            found = [model.score(t) for t in texts(batch)]
            yield batch_of(schema, {
                "doc_id": batch.column(0), "held_out": batch.column(1),
                "lang_pred": [f[0] for f in found], "score": [f[1] for f in found]})

    return docs.select("doc_id", in_fold(FOLDS, HELD_OUT).alias("held_out"), "text").mapInArrow(
        judge, "doc_id bigint, held_out boolean, lang_pred string, score double")
