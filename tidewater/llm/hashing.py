"""Vectorised word hashing over Arrow string buffers.

Words are hashed straight from the UTF-8 bytes of an Arrow batch with prefix sums of a polynomial over the ring of 64-bit
integers, so the cost is a few nanoseconds a byte and no Python string is ever made.  A word's hash depends on its bytes only,
not on its place, its document or its batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
P = 0x9E3779B97F4A7C15 | 1
P_INV = pow(P, -1, 1 << 64)
BLOCK = 1 << 19

#: One 64-bit value for each byte.
BYTE_VALUES = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)

#: Words are runs of ASCII letters and digits and of bytes beyond ASCII.
WORD_BYTE = np.zeros(256, np.bool_)
WORD_BYTE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: every input bit reaches every output bit."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class _Powers:
    def __init__(self) -> None:
        self.grow(BLOCK + 2)

    def grow(self, n: int) -> None:
        with np.errstate(over="ignore"):
            for name, base in (("up", P), ("down", P_INV)):
                p = np.full(n, base, U)
                p[0] = 1
                setattr(self, name, np.cumprod(p, dtype=U))
        self.n = n


_powers: _Powers | None = None


def _block_hashes(data: np.ndarray, table: np.ndarray, single: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each word in a block that cuts no word."""
    global _powers
    if _powers is None:
        _powers = _Powers()
    n = len(data)
    if n + 1 >= _powers.n:
        _powers.grow(n + 2)
    inside = table[data]
    edge = np.empty(n + 1, np.bool_)
    edge[1:n] = inside[1:] != inside[:-1]
    edge[0], edge[n] = n > 0 and inside[0], n > 0 and inside[-1]
    cuts = np.flatnonzero(edge)
    starts, ends = cuts[0::2], cuts[1::2]
    total = np.empty(n + 1, U)
    total[0] = 0
    np.cumsum(BYTE_VALUES[data] * _powers.up[:n], out=total[1:])
    hashes = (total[ends] - total[starts]) * _powers.down[starts]
    if single is not None:
        at = np.flatnonzero(single[data])
        if len(at):
            order = np.argsort(np.concatenate([starts, at]), kind="stable")
            hashes = np.concatenate([hashes, BYTE_VALUES[data[at]] * U(3)])[order]
            starts = np.concatenate([starts, at])[order]
    return mix(hashes), starts


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than there are rows) of a string or binary column; a null is an empty run."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if large else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def word_hashes(column: pa.Array, table: np.ndarray = WORD_BYTE, single: np.ndarray | None = None, block: int = BLOCK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yields (first row, end row, word hashes, where each row's hashes begin and the last end).

    `table` says which bytes are part of words, `single` which are a word each.  Rows come in groups of about `block` bytes; a
    longer row is hashed in pieces cut between words and is yielded alone.
    """
    data, at = buffers(column)
    n = len(at) - 1
    row = 0
    with np.errstate(over="ignore"):
        while row < n:
            end = max(row + 1, int(np.searchsorted(at, at[row] + block, side="right")) - 1)
            piece = data[at[row] : at[end]]
            if end == row + 1 and len(piece) > block:
                parts, i = [], 0
                while i < len(piece):
                    j = min(i + block, len(piece))
                    while j < len(piece):
                        out = np.flatnonzero(~table[piece[j : j + block]])
                        if len(out):
                            j += int(out[0])
                            break
                        j = min(j + block, len(piece))
                    parts.append(_block_hashes(piece[i:j], table, single)[0])
                    i = j
                hashes = np.concatenate(parts)
                yield row, end, hashes, np.array([0, len(hashes)])
            else:
                # A row may end in the middle of a run of word bytes: a separator between rows keeps words apart.
                lengths = np.diff(at[row : end + 1])
                spaced = np.full(len(piece) + end - row, 32, np.uint8)
                keep = np.ones(len(spaced), np.bool_)
                keep[np.cumsum(lengths + 1) - 1] = False
                spaced[keep] = piece
                hashes, starts = _block_hashes(spaced, table, single)
                yield row, end, hashes, np.searchsorted(starts, np.concatenate([[0], np.cumsum(lengths + 1)]))
            row = end


def ngrams(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams of one document; a shorter document is one n-gram of all its words."""
    if not len(words):
        return words
    with np.errstate(over="ignore"):
        k = min(n, len(words))
        out = np.zeros(len(words) - k + 1, U)
        for i in range(k):
            out = out * U(0xD1342543DE82EF95) + words[i : len(words) - k + 1 + i]
        return np.unique(mix(out + U(k)))
