"""Rows that Python makes from Arrow batches: read one at a time and sent on a few at a time, so that a worker holds few of them."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa

#: Rows, and characters of their texts, after which a batch is sent on.
BATCH_ROWS = 1_000
BATCH_CHARS = 1 << 20


def each(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple]:
    """The values of `columns`, row by row."""
    for batch in batches:
        held = [batch.column(c) for c in columns]
        for i in range(batch.num_rows):
            yield tuple(c[i].as_py() for c in held)


def _chars(value: object) -> int:
    if isinstance(value, str):
        return len(value)
    return sum(map(_chars, value.values() if isinstance(value, dict) else value)) if isinstance(value, dict | list) else 0


def batched(rows: Iterable[dict], schema: pa.Schema, most: int = BATCH_ROWS, chars: int = BATCH_CHARS) -> Iterator[pa.RecordBatch]:
    """The rows in batches of at most `most` rows, each sent on as its texts reach `chars`."""
    some, held = [], 0
    for row in rows:
        some.append(row)
        held += _chars(row)
        if len(some) >= most or held >= chars:
            yield pa.RecordBatch.from_pylist(some, schema)
            some, held = [], 0
    if some:
        yield pa.RecordBatch.from_pylist(some, schema)
