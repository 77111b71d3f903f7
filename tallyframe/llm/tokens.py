"""Token counts of whole texts without token ids.

A piece of the vocabulary never has a space mark after another character, and never
holds a line feed beside anything else (both are checked when the model is loaded).
So the merges of a text happen inside its pre-tokens: a run of spaces with the word
behind it, the first word of a further line, and the line feed itself, one token.
Pieces are counted once per distinct pre-token and joined to the frequencies per
document. The most frequent pre-tokens, of a fixed number, go to the tasks as a
table; any other one is too rare to fill a task of the join.

Null texts are empty and have no tokens. Repeated rows stay apart. An empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from tallyframe.llm.common import batch_of, bounded_batches, save, texts

#: Pre-tokens whose counts are broadcast: the most frequent ones, a few MiB.
FREQUENT = 1 << 19
#: And of their bytes: scripts without blanks have pre-tokens of whole paragraphs.
FREQUENT_BYTES = 32 << 20
#: Distinct pre-tokens a task holds before it hands their counts on.
HELD = 400_000
SPACE = "▁"


def pre_tokens(text: str) -> tuple[list[str], int]:
    """The pre-tokens of a text, and its line feeds.

    A pre-token is written without its first space mark; one that starts a further
    line has no mark and is written behind a line feed. A lone mark is "".
    """
    if not text:
        return [], 0
    if SPACE in text:
        text = text.replace(SPACE, " ")
    first, *further = text.split("\n")
    found = _after_space(first.split(" "))
    for line in further:
        if not line:
            continue
        head, *rest = line.split(" ")
        if head:
            found.append("\n" + head)
        if rest:
            found += _after_space(rest)
    return found, len(further)


def _after_space(words: list[str]) -> list[str]:
    """Words that each follow one space; empty ones are further spaces of the next word."""
    if "" not in words:
        return words
    found, spaces = [], 0
    for word in words[:-1]:
        if word:
            found.append(" " * spaces + word)
            spaces = 0
        else:
            spaces += 1
    return [*found, " " * spaces + words[-1]]


class Pieces:
    """Counts the pieces of pre-tokens with a SentencePiece model."""

    def __init__(self, model_file: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.marked_feed = len(self.model.encode("\n"))
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            if SPACE in piece.lstrip(SPACE) or "\n" in piece:
                raise ValueError(f"piece {piece!r} crosses the pre-tokens")

    def count(self, words: list[str]) -> list[int]:
        numbers = [len(ids) for ids in self.model.encode(words, num_threads=1)]
        return [
            1 if not word else n - self.marked_feed if word[0] == "\n" else n
            for word, n in zip(words, numbers, strict=True)
        ]


def frequencies(docs: DataFrame) -> DataFrame:
    """(word, n) of every pre-token of all texts."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def out(held: Counter) -> Iterator[pa.RecordBatch]:
        words, numbers = list(held), list(held.values())
        for at in range(0, len(words), 50_000):
            yield batch_of(schema, {"word": words[at:at + 50_000], "n": numbers[at:at + 50_000]})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for text in texts(batch):
                held.update(pre_tokens(text.decode())[0])
            if len(held) > HELD:
                yield from out(held)
                held = Counter()
        yield from out(held)

    return docs.select("text").mapInArrow(count, "word string, n bigint").groupBy("word").agg(
        F.sum("n").alias("n"))


def piece_counts(words: DataFrame, model_file: str) -> DataFrame:
    """(word, n, pieces): the pieces of each distinct pre-token."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64()), ("pieces", pa.int32())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(model_file)
        for batch in batches:
            found = pieces.count(batch.column(0).to_pylist())
            yield batch_of(schema, {"word": batch.column(0), "n": batch.column(1), "pieces": found})

    return words.mapInArrow(count, "word string, n bigint, pieces int")


def least_count(vocabulary: DataFrame) -> int:
    """The count from which on pre-tokens are at most FREQUENT, and their bytes at most FREQUENT_BYTES.

    Read off a histogram of the counts, eight bins to a power of two, so that no task
    sorts or merges the vocabulary.
    """
    bins = vocabulary.groupBy(F.floor(F.log2("n") * 8).alias("bin")).agg(
        F.count("*").alias("words"), F.min("n").alias("least"),
        F.sum(F.octet_length("word")).alias("bytes")).orderBy(F.desc("bin")).collect()
    held, size, least = 0, 0, 1 << 62
    for r in bins:
        held += r.words
        size += r.bytes
        if held > FREQUENT or size > FREQUENT_BYTES:
            break
        least = r.least
    return least


def count_tokens(docs: DataFrame, model_file: str) -> DataFrame:
    """Per row: doc_id, n_bytes (of UTF-8) and n_tokens of the whole text."""
    spark = docs.sparkSession
    bounded_batches(spark)
    Pieces(model_file)  # a model that cannot be split is refused here
    vocabulary = save(piece_counts(frequencies(docs), model_file), "pre-tokens")
    top = vocabulary.where(F.col("n") >= least_count(vocabulary)).select("word", "pieces").toArrow()
    frequent = spark.sparkContext.broadcast(
        dict(zip(top["word"].to_pylist(), top["pieces"].to_pylist(), strict=True)))
    del top
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n", pa.int64()),
        ("words", pa.list_(pa.string())), ("times", pa.list_(pa.int64())),
    ])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = frequent.value
        for batch in batches:
            sizes, sums, words, times = [], [], [], []
            for text in texts(batch):
                found, total = pre_tokens(text.decode())
                rare: dict[str, int] = {}
                for word in found:
                    n = known.get(word)
                    if n is None:
                        rare[word] = rare.get(word, 0) + 1
                    else:
                        total += n
                sizes.append(len(text))
                sums.append(total)
                words.append(list(rare))
                times.append(list(rare.values()))
            yield batch_of(schema, {"doc_id": batch.column(0), "n_bytes": sizes, "n": sums,
                                    "words": words, "times": times})

    rows = save(
        docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
            count, "doc_id bigint, n_bytes bigint, n bigint, words array<string>, times array<bigint>")
        .withColumn("rid", F.monotonically_increasing_id()), "document-pre-tokens")
    rare = rows.select("rid", F.explode(F.arrays_zip("words", "times")).alias("w")).select(
        "rid", F.col("w.words").alias("word"), F.col("w.times").alias("times"))
    joined = rare.join(vocabulary.select("word", "pieces"), "word").select(
        "rid", F.lit(None).cast("bigint").alias("doc_id"), F.lit(0).cast("bigint").alias("n_bytes"),
        (F.col("pieces") * F.col("times")).alias("n"))
    return (
        rows.select("rid", "doc_id", "n_bytes", "n").unionByName(joined).groupBy("rid")
        .agg(F.max("doc_id").alias("doc_id"), F.sum("n_bytes").alias("n_bytes"),
             F.sum("n").alias("n_tokens")).drop("rid")
    )
