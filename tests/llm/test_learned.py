import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe.llm import language, quality

SF = "/root/testdata/sf0.01"


def crc(doc_id, folds):
    return zlib.crc32(str(doc_id).encode()) % folds


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_quality_on_held_out_labels(given):
    docs, labels = given
    # labels of bad documents must not matter, nor anything of the held-out fold
    scored, model = quality.score(docs.withColumn("x", F.lit("clash")), labels)
    truth = {r.doc_id: r.quality for r in labels.collect()}
    rows = scored.collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (crc(r.doc_id, 4) == 2) and 0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == int(r.score >= 0.7) for r in rows)
    test = [r for r in rows if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in test]) > 0.95
    share = np.mean([v for k, v in truth.items() if crc(k, 4) != 2])
    assert abs(model.prior - share) < 0.1


def test_quality_learns_from_trusted_positives_alone(given):
    docs, labels = given
    some = docs.where("doc_id < 300")
    held_out = quality.in_fold(quality.FOLDS, quality.HELD_OUT)
    scored = quality.score(some, labels)[0].collect()
    fewer = labels.where("quality = 1").where(~held_out)
    again = quality.score(some, fewer)[0].collect()
    assert {r.doc_id: round(r.score, 6) for r in scored} == {r.doc_id: round(r.score, 6) for r in again}


def test_quality_edges(documents, given):
    labels = given[1]
    docs = documents([(1, None), (2, ""), (3, "word " * 40_000), (4, "plain"), (4, "plain"), (None, "no id")])
    rows = quality.score(docs, labels)[0].collect()
    assert len(rows) == 6 and all(0 <= r.score <= 1 for r in rows)
    by_id = {r.doc_id: r.score for r in rows}
    assert by_id[1] == by_id[2]
    assert quality.score(docs, labels.limit(0))[0].count() == 6
    assert quality.score(documents([]), labels)[0].count() == 0
    kept = quality.apply(docs.withColumn("_keep2", F.lit(1)), labels)
    assert kept.columns == [*docs.columns, "_keep2"]


def test_risk_falls_and_the_prior_is_found(spark):
    rng = np.random.default_rng(0)
    d = len(quality.FEATURES) + quality.HASHED
    n, prior = 4000, 0.7
    good = rng.random(n) < prior
    x = np.zeros((n, d), np.float32)
    x[:, 0] = np.where(good, 1.0, -1.0) + rng.normal(0, 0.3, n)
    positive = good & (rng.random(n) < 0.3)
    rows = spark.createDataFrame(
        [(bool(p), v.tolist()) for p, v in zip(positive, x, strict=True)], "positive boolean, x array<float>")
    first = quality.fit_weights(rows, quality.PRIOR_GUESS, quality.FIRST_STEPS, np.zeros(d + 1))
    estimate = quality.estimate_prior(rows, first)
    assert abs(estimate - prior) < 0.05
    model = quality.Model(quality.fit_weights(rows, estimate, quality.STEPS, first), estimate)
    assert np.mean((model.score(np.c_[x, np.ones(n)]) >= 0.5) == good) > 0.97


def test_language_on_held_out_documents(given):
    docs, _ = given
    rows = language.predict(docs.withColumn("gram", F.lit("clash"))).collect()
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    assert len(rows) == len(truth)
    assert all(r.held_out == (crc(r.doc_id, 5) == 0) and 0 <= r.score <= 1 for r in rows)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in rows if r.held_out]) > 0.97


def test_language_edges(documents):
    train = [(i, "the quick dog ran home", "en") for i in range(1, 9)] + [
        (i, "der schnelle Hund läuft", "de") for i in range(11, 19)]
    docs = documents([*train, (30, None, "en"), (31, "", None), (32, "123 +-!", "en"), (33, "THE DOG", None),
                      (34, "der Hund", None), (35, "the " * 50_000, None), (33, "THE DOG", None), (None, "läuft", None)])
    rows = language.predict(docs).collect()
    found = {r.doc_id: r.lang_pred for r in rows}
    assert len(rows) == len(train) + 8
    assert [found[i] for i in (30, 31, 32)] == ["und"] * 3
    assert (found[33], found[34], found[35], found[None]) == ("en", "de", "en", "de")
    assert language.predict(documents([])).count() == 0
    assert {r.lang_pred for r in language.predict(documents([(1, "no labels", None)])).collect()} == {"und"}


def test_grams_ignore_chunks_and_masks_hold_every_learned_gram(monkeypatch):
    letters = language.letter_table()
    codes = language.letters_of("  Éa1b--Straße ".encode(), letters)
    assert "".join(map(chr, codes)) == " éa b straße "
    whole = np.sort(np.concatenate(list(language.grams(codes))))
    monkeypatch.setattr(language, "CHUNK", 4)
    assert (np.sort(np.concatenate(list(language.grams(codes)))) == whole).all()
    assert len(whole) == sum(len(codes) - n + 1 for n in language.ORDERS)


def test_more_languages_than_one_slice(documents, monkeypatch):
    monkeypatch.setattr(language, "ROWS", 1 << 14)
    alphabet = "bcdfghjklmnpqrstvwxz"
    names = [a + b for a in alphabet[:10] for b in alphabet[10:17]]
    docs = documents([(i * 70 + k, f"{n}a{n}o {n}i{n}u", n) for i in range(6) for k, n in enumerate(names)])
    rows = language.predict(docs).collect()
    truth = {r.doc_id: r.lang for r in docs.collect()}
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in rows]) > 0.95
