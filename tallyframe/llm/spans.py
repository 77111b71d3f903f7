"""Spans found in whole texts, as rows of the span operators.

Null texts are empty; repeated rows have a row each; an empty table gives an empty
result; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyframe.llm.common import batch_of, bounded_batches, texts

Span = tuple[str, int, int]


class Covered:
    """Spans, asked whether one of them holds another span."""

    def __init__(self, spans: Iterable[tuple[int, int]]):
        held = sorted(spans)
        self.starts = [a for a, _ in held]
        self.reach = list(accumulate((b for _, b in held), max))

    def holds(self, start: int, end: int) -> bool:
        at = bisect_right(self.starts, start)
        return at > 0 and self.reach[at - 1] >= end


def listed(spans: Sequence[Span], kinds: Sequence[str]) -> str:
    """kind:start:end by start, then kind as in `kinds`, comma-joined."""
    ordered = sorted(spans, key=lambda s: (s[1], kinds.index(s[0]), s[2]))
    return ",".join(f"{k}:{a}:{b}" for k, a, b in ordered)


def span_rows(
    docs: DataFrame, find: Callable[[str], tuple[list[Span], list[Span]]], kinds: Sequence[str],
) -> DataFrame:
    """Per row: doc_id, a count n_<kind> of base spans per kind, base_sha256, spans.

    `find` gives a text's base spans and those that the method adds to them; a null
    text is an empty one. Rows never shuffle.
    """
    bounded_batches(docs.sparkSession)
    base_kinds = [k for k in kinds if not k.startswith("+")]
    order = [k.lstrip("+") for k in kinds]
    schema = pa.schema([
        ("doc_id", pa.int64()), *[(f"n_{k}", pa.int64()) for k in base_kinds],
        ("base_sha256", pa.string()), ("spans", pa.string()), ("n_added", pa.int64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, list[int]] = {k: [] for k in base_kinds}
            digests, joined, added = [], [], []
            for text in texts(batch):
                base, more = find(text.decode())
                for k in base_kinds:
                    counts[k].append(sum(s[0] == k for s in base))
                digests.append(hashlib.sha256(listed(base, order).encode()).hexdigest())
                joined.append(listed(base + more, order))
                added.append(len(more))
            yield batch_of(schema, {
                "doc_id": batch.column(0), **{f"n_{k}": v for k, v in counts.items()},
                "base_sha256": digests, "spans": joined, "n_added": added})

    form = ", ".join(["doc_id bigint", *[f"n_{k} bigint" for k in base_kinds],
                      "base_sha256 string", "spans string", "n_added bigint"])
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(scan, form)
