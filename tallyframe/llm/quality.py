"""Quality classifier by positive-unlabelled learning.

A linear model over features of a text's form is fitted by minimising the
non-negative unbiased risk
    prior * R_pos(+) + max(0, R_unl(-) - prior * R_pos(-))
with the logistic loss: trusted positives are documents labelled good, the unlabelled
text is every document outside the held-out fold. Labels of bad documents are not
used. The class prior is estimated from the scores of a first fit: the least ratio of
the unlabelled to the positive share above a threshold (best bin).

All statistics are sums over all training rows: each Newton step is one aggregation
of (features x features) numbers per task. Rows with crc32(doc_id) mod FOLDS equal to
HELD_OUT teach nothing. A null text is scored as an empty one; repeated rows count
each; with no positives at all every score is the same, PRIOR_GUESS. An empty table gives an
empty result; other columns are ignored by `score` and kept by `apply`, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tallyframe.llm.common import batch_of, bounded_batches, bring_back, free_name, save, texts

FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.7
PRIOR_GUESS = 0.5
STEPS, FIRST_STEPS = 25, 10
RIDGE = 1e-3
BINS = 1000
#: Buckets of the hashed character pairs, beside the features of form.
HASHED = 32

FEATURES = [
    "letters", "upper", "digits", "spaces", "marks", "symbols", "bars", "not_ascii",
    "word_length", "long_words", "capital_words", "upper_words", "symbol_ends", "mark_ends", "stops",
    "alone_marks", "repeats_next", "distinct", "top_word", "repeated_trigrams", "lines_repeated",
    "line_length", "size", "empty",
]

_CLASS = np.zeros((6, 256), bool)
_CLASS[0, [*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_CLASS[1, 65:91] = True
_CLASS[2, 48:58] = True
_CLASS[3, [*range(9, 14), 32]] = True
_CLASS[4, list(b".,;:!?'\"()-")] = True
_CLASS[5, list(b"#$%&*+/<=>@[\\]^_`{|}~")] = True
_MARKS, _SYMBOLS = b".,;:!?'\"()-", b"#$%&*+/<=>@[\\]^_`{|}~"


def features(text: bytes) -> np.ndarray:
    """Numbers between about -1 and 1 that describe the form of a text, not its length."""
    out = np.zeros(len(FEATURES) + HASHED)
    words = text.split()
    if not words:
        out[FEATURES.index("empty")] = 1
        return out
    codes = np.frombuffer(text, np.uint8)
    counts = np.bincount(codes, minlength=256)
    n, w = len(codes), len(words)
    out[:6] = _CLASS @ counts / n
    out[6] = counts[ord("|")] / n
    out[7] = counts[128:].sum() / n
    out[8] = min(2.0, (n - w + 1) / w / 10)
    seen = Counter(words)
    last = Counter(word[-1] for word in words)
    first = Counter(word[0] for word in words)
    out[9] = sum(len(word) > 14 for word in words) / w
    out[10] = sum(first[c] for c in range(65, 91)) / w
    out[11] = sum(word.isupper() for word in words) / w
    out[12] = sum(last[c] for c in _SYMBOLS) / w
    out[13] = sum(last[c] for c in b"!?") / w
    out[14] = sum(last[c] for c in b".,;:") / w
    out[15] = sum(k for word, k in seen.items() if len(word) == 1 and word in b"|*-#=~_+.") / w
    out[16] = sum(a == b for a, b in zip(words, words[1:])) / w
    if w >= 20:  # shorter texts repeat little by nature
        out[17] = 1 - len(seen) / w
        out[18] = seen.most_common(1)[0][1] / w
        out[19] = 1 - len(set(zip(words, words[1:], words[2:]))) / (w - 2)
    lines = [line for line in text.split(b"\n") if line.strip()]
    out[20] = 1 - len(set(lines)) / len(lines)
    out[21] = min(1.0, n / len(lines) / 2000)
    out[22] = np.log10(n) / 6
    # pairs of neighbouring byte classes: letters, digits, spaces, single signs
    kinds = np.where(codes >= 128, 1, codes).astype(np.int64)
    kinds = np.where(((codes > 96) & (codes < 123)), 97, kinds)
    kinds = np.where(((codes > 64) & (codes < 91)), 65, kinds)
    pairs = (kinds[:-1] * 131 + kinds[1:]) * 2654435761 >> 7
    if len(pairs):
        hashed = np.bincount(pairs % HASHED, minlength=HASHED)
        out[len(FEATURES):] = np.sqrt(hashed / len(pairs))
    return out


def in_fold(folds: int, fold: int) -> Column:
    """Whether a row is in the fold; a null doc_id counts as the text ''."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")),
                  F.lit(folds)) == fold


def described(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, x (its features)."""
    bounded_batches(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("x", pa.list_(pa.float32()))])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(t).astype(np.float32) for t in texts(batch)]
            flat = np.concatenate(rows) if rows else np.zeros(0, np.float32)
            offsets = np.arange(len(rows) + 1, dtype=np.int32) * (len(FEATURES) + HASHED)
            yield batch_of(schema, {"doc_id": batch.column(0), "x": pa.ListArray.from_arrays(
                pa.array(offsets), pa.array(flat))})

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(make, "doc_id bigint, x array<float>")


def matrix(batch: pa.RecordBatch) -> np.ndarray:
    """The features of a batch, scaled by nothing, with a constant column."""
    x = batch.column(batch.schema.get_field_index("x"))
    flat = x.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.c_[flat.reshape(batch.num_rows, -1), np.ones(batch.num_rows)]


@dataclass(frozen=True)
class Model:
    """Linear weights, the last one for the constant, and the class prior."""

    weights: np.ndarray
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))


def _summed(rows: DataFrame, per_batch, length: int) -> np.ndarray:
    """The sum over all batches of `per_batch(x, positive)`, an array of fixed length."""
    schema = pa.schema([("part", pa.int32()), ("s", pa.list_(pa.float64()))])

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(length)
        for batch in batches:
            if batch.num_rows:
                total += per_batch(matrix(batch), batch.column(0).to_numpy(zero_copy_only=False))
        yield pa.RecordBatch.from_arrays(
            [pa.array([hash(total.tobytes()) % 64], pa.int32()), pa.array([total.tolist()])], schema=schema)

    def add(part: pa.Table) -> pa.Table:
        total = np.sum([np.array(v.as_py()) for v in part["s"]], axis=0)
        return pa.table({"part": part["part"][:1], "s": pa.array([total.tolist()])})

    sums = rows.select("positive", "x").mapInArrow(local, "part int, s array<double>")
    sums = sums.groupBy("part").applyInArrow(add, "part int, s array<double>")
    return np.sum([r.s for r in sums.collect()] or [np.zeros(length)], axis=0)


def fit_weights(rows: DataFrame, prior: float, steps: int, start: np.ndarray) -> np.ndarray:
    """Newton steps on the non-negative risk; rows have `positive` and `x`.

    Every row is an unlabelled one; the positive ones count as positives besides.
    The loss of a positive as negative minus that as positive is linear, so the risk
    is convex; where its negative part falls below zero, the step follows the
    positive part alone, as the correction asks.
    """
    d, weights = len(start), start

    def sums(x: np.ndarray, positive: np.ndarray, w: np.ndarray) -> np.ndarray:
        z = np.clip(x @ w, -30, 30)
        p = 1 / (1 + np.exp(-z))
        y = positive.astype(bool)
        curve = p * (1 - p)
        return np.concatenate([
            [len(x), y.sum(), np.logaddexp(0, z).sum(), np.logaddexp(0, z[y]).sum()],
            x.T @ p, x[y].T @ p[y], x[y].sum(axis=0),
            ((x * curve[:, None]).T @ x).ravel(), ((x[y] * curve[y][:, None]).T @ x[y]).ravel(),
        ])

    for _ in range(steps):
        now = weights
        s = _summed(rows, lambda x, y, now=now: sums(x, y, now), 4 + 3 * d + 2 * d * d)
        n, m, loss, pos_loss = s[:4]
        if not m:
            return weights
        grad_u, grad_p, sum_p = s[4:4 + 3 * d].reshape(3, d)
        curve_u, curve_p = s[4 + 3 * d:].reshape(2, d, d)
        negative_risk = loss / n - prior * pos_loss / m
        if negative_risk >= 0:  # prior * R_pos(+) + R_unl(-) - prior * R_pos(-)
            grad, curve = grad_u / n - prior * sum_p / m, curve_u / n
        else:
            grad, curve = prior * (grad_p - sum_p) / m, prior * curve_p / m
        step = np.linalg.solve(curve + RIDGE * np.eye(d), grad + RIDGE * weights)
        size = np.abs(step).max()
        weights = weights - step * min(1.0, 5.0 / max(size, 1e-12))
        if size < 1e-3:
            break
    return weights


def estimate_prior(rows: DataFrame, weights: np.ndarray) -> float:
    """The least, over thresholds, of share(unlabelled above) / share(positives above).

    Above a threshold that only good texts pass, the unlabelled share is the prior
    times the positive one; elsewhere it is more. Thresholds that too few positives
    pass are left out, and each ratio has a margin for chance.
    """
    def histogram(x: np.ndarray, positive: np.ndarray) -> np.ndarray:
        score = Model(weights, 0.5).score(x)
        at = np.minimum((score * BINS).astype(int), BINS - 1)
        return np.concatenate([
            np.bincount(at, minlength=BINS), np.bincount(at[positive.astype(bool)], minlength=BINS)])

    counts = _summed(rows, histogram, 2 * BINS)
    above_u, above_p = (np.cumsum(c[::-1])[::-1] for c in (counts[:BINS], counts[BINS:]))
    n, m = above_u[0], above_p[0]
    if not m:
        return PRIOR_GUESS
    share_u, share_p = above_u / n, above_p / m
    margin = np.sqrt(np.log(2 * BINS) / 2 / n) + np.sqrt(np.log(2 * BINS) / 2 / m)
    usable = share_p > 0.1
    bound = (share_u[usable] + margin) / share_p[usable]
    best = np.argmin(bound)
    return float(np.clip(share_u[usable][best] / share_p[usable][best], 0.01, 0.99))


def fit(rows: DataFrame, labels: DataFrame) -> Model:
    """Fit on `rows` (doc_id, x, held_out) and the good ones among `labels`."""
    good = save(
        labels.select(F.col("doc_id").cast("bigint"), "quality").where("quality = 1")
        .groupBy("doc_id").agg(F.count("*").alias("n")).select("doc_id", F.lit(1).cast("bigint").alias("n")),
        "good-labels")
    learn = rows.where("NOT held_out").select("doc_id", "x")
    marked = save(
        bring_back(learn, good, "doc_id", "n", F.col("doc_id")).select(
            F.col("n").isNotNull().alias("positive"), "x"), "training-rows")
    d = len(FEATURES) + HASHED + 1
    first = fit_weights(marked, PRIOR_GUESS, FIRST_STEPS, np.zeros(d))
    prior = estimate_prior(marked, first)
    return Model(fit_weights(marked, prior, STEPS, first), prior)


def score(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, Model]:
    """Per row: doc_id, held_out, score, predicted; and the model."""
    rows = save(
        described(docs.select("doc_id", "text")).withColumn("held_out", in_fold(FOLDS, HELD_OUT)),
        "text-features")
    model = fit(rows, labels)
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64())])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch_of(schema, {"doc_id": batch.column(0), "held_out": batch.column(1),
                                    "score": model.score(matrix(batch))})

    scored = rows.select("doc_id", "held_out", "x").mapInArrow(
        judge, "doc_id bigint, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")), model


def apply(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents predicted good, with all their columns; no row shuffles for it."""
    model = fit(
        save(described(docs.select("doc_id", "text")).withColumn("held_out", in_fold(FOLDS, HELD_OUT)),
             "text-features"), labels)
    flag = free_name(docs, "keep")
    schema = T.StructType([*docs.schema.fields, T.StructField(flag, T.BooleanType())])
    names = [*docs.columns, flag]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t) for t in texts(batch)], np.float32).reshape(batch.num_rows, -1)
            keep = model.score(np.c_[x.astype(np.float64), np.ones(batch.num_rows)]) >= THRESHOLD
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keep)], names=names)

    return docs.mapInArrow(judge, schema).where(F.col(flag)).drop(flag)
