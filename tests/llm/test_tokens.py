import random

import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

from tallyframe.llm import tokens

MODEL = public_tokenizers.path("piece_bpe_32k.model")
EDGE = [
    "", None, " ", "  ", "a", " a", "a ", "a  b", "▁", "\n", "\n\n", "a\nb", "a \n b", " \n", "\n a",
    "<s>", "</s> <unk>", "<0x0A>", "\x00", "a\x00b", "\r\n", "\t", "　x", "é é", "ﬁ ①", "日本語 テスト",
    "🙂🙂", "word " * 30_000, "x" * 50_000, "▁▁ ▁x", "  \n  \n  end  ",
]


def test_pre_tokens_add_up():
    pieces = tokens.Pieces(MODEL)
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    random.seed(2)
    alphabet = " \n▁\tabcABCthe.,'é0123\r日\x00"
    made = ["".join(random.choices(alphabet, k=random.randrange(60))) for _ in range(5000)]
    for text in [t for t in EDGE if t is not None] + made:
        words, feeds = tokens.pre_tokens(text)
        assert feeds + sum(pieces.count(words) if words else []) == len(model.encode(text)), repr(text[:60])


def test_counts_match_the_library(documents, spark, monkeypatch):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [(1000 + i, t) for i, t in enumerate(EDGE)] + [(1, "again"), (1, "again"), (None, "no id")]
    docs = given.unionByName(documents(rows).select("doc_id", "text")).withColumn("word", F.lit("x"))
    expected = sorted(
        (r.doc_id or -1, len((r.text or "").encode()), len(model.encode(r.text or ""))) for r in docs.collect())
    for frequent in (tokens.FREQUENT, 100):  # with few frequent ones the join does the work
        monkeypatch.setattr(tokens, "FREQUENT", frequent)
        got = tokens.count_tokens(docs, MODEL).collect()
        assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in got) == expected
    assert tokens.count_tokens(documents([]), MODEL).count() == 0


def test_frequent_words_are_bounded_by_bytes(documents, monkeypatch):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    long = "日本語" * 500
    rows = [(i, f"{long} the of {i}") for i in range(50)]
    monkeypatch.setattr(tokens, "FREQUENT_BYTES", 1000)  # the paragraph alone passes it
    got = tokens.count_tokens(documents(rows), MODEL).collect()
    assert {r.doc_id: r.n_tokens for r in got} == {i: len(model.encode(t)) for i, t in rows}
