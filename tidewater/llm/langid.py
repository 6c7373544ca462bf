"""Language identification by a bidirectional gated recurrent network over bytes.

A document is read in windows of at most WINDOW bytes, cut between characters, with up to CONTEXT bytes on either side.  Two gated
recurrent layers of HIDDEN units read each window, white space included, from either end, and a softmax over both states labels every byte
with a language or with NOISE (digits, codes, symbols).  The probabilities of all positions of a document that are no white space are
averaged.  Training is backpropagation through time in numpy, on a bounded sample of labelled documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import fresh, modest, tidy
from tidewater.llm.hashing import buffers

#: Hidden units of each direction; bytes that are labelled at once, and those before and behind that are read along.
HIDDEN = 8
WINDOW = 112
CONTEXT = 8
#: The sample: documents that are read for training at most, windows drawn for each language and their bytes, steps, windows in a step,
#: the first step size.
TRAIN_DOCS = 2_000
TRAIN_WINDOWS = 6_000
TRAIN_BYTES = 48
STEPS = 400
BATCH = 256
RATE = 0.02
#: The label of bytes that belong to no language, and the mean probability of it at which a document is rejected.
NOISE = "und"
REJECTED = 0.6
#: The code that fills windows up: it leaves a layer in its first state.
PAD = 256
#: Windows that the network reads side by side.
SIDE = 2048
SPACE = np.zeros(PAD + 1, np.bool_)
SPACE[[9, 10, 11, 12, 13, 32, PAD]] = True

RESULT = "doc_id long, lang string, prob double, positions long, own long, keep boolean"


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + np.float32(0.5)


class Layer:
    """One direction.  `inputs` (3H, PAD + 1) holds what each byte adds to the gates, bias included; `back` (3H, H) what the state adds."""

    def __init__(self, inputs: np.ndarray, back: np.ndarray) -> None:
        self.inputs, self.back = inputs, back

    def run(self, codes: np.ndarray, keep: list | None = None) -> list[np.ndarray]:
        """States (H, B) after each of the codes (L, B); `keep` gets what the way back needs."""
        h = np.zeros((self.back.shape[1], codes.shape[1]), np.float32)
        n_h, out = len(h), []
        for row in codes:
            a, u = np.take(self.inputs, row, axis=1), self.back @ h
            gates = _sigmoid(a[: 2 * n_h] + u[: 2 * n_h])
            z, r = gates[:n_h], gates[n_h:]
            n = np.tanh(a[2 * n_h :] + r * u[2 * n_h :])
            if keep is not None:
                keep.append((row, h, z, r, n, u[2 * n_h :]))
            h = n + z * (h - n)
            out.append(h)
        return out

    def gradients(self, kept: list, outer: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Backpropagation through time: the gradients of `inputs` and `back` from those of the states."""
        inputs, back = np.zeros_like(self.inputs.T), np.zeros_like(self.back)
        later = np.zeros_like(outer[0])
        for (row, h, z, r, n, un), dh in zip(reversed(kept), reversed(outer), strict=True):
            dh = dh + later
            dn = dh * (1 - z) * (1 - n * n)
            dz = dh * (h - n) * z * (1 - z)
            dr = dn * un * r * (1 - r)
            du = np.concatenate([dz, dr, dn * r])
            back += du @ h.T
            later = dh * z + self.back.T @ du
            np.add.at(inputs, row, np.concatenate([dz, dr, dn]).T)
        return inputs.T, back


class Model:
    def __init__(self, labels: list[str], forth: Layer, back: Layer, out: np.ndarray, bias: np.ndarray) -> None:
        self.labels, self.forth, self.back, self.out, self.bias = labels, forth, back, out, bias

    def logits(self, codes: np.ndarray, kept: tuple[list, list] | None = None) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """For each place, both directions' states (2H, B) and the logits (C, B)."""
        a = self.forth.run(codes, kept[0] if kept else None)
        b = self.back.run(codes[::-1], kept[1] if kept else None)[::-1]
        states = [np.concatenate(s) for s in zip(a, b, strict=True)]
        return states, [self.out @ s + self.bias for s in states]

    def positions(self, codes: np.ndarray) -> list[np.ndarray]:
        """Probabilities (C, B) of each place."""
        out = []
        for x in self.logits(codes)[1]:
            e = np.exp(x - x.max(axis=0))
            out.append(e / e.sum(axis=0))
        return out

    def label(self, text: str) -> list[str]:
        """The label of every byte of a text in lower case."""
        data = np.frombuffer(text.lower().encode(), np.uint8)
        out: list[str] = []
        for low, start, end, high in zip(*(x.tolist() for x in windows(data, np.array([0, len(data)]))[1:]), strict=True):
            p = self.positions(data[low:high, None].astype(np.int64))
            out += [self.labels[int(p[i][:, 0].argmax())] for i in range(start - low, end - low)]
        return out

    def loss(self, codes: np.ndarray, own: np.ndarray) -> float:
        """The mean over all positions of what the right label lacks."""
        return -float(np.mean([np.log(p[own, np.arange(len(own))]) for p in self.positions(codes)]))

    def gradients(self, codes: np.ndarray, own: np.ndarray) -> list[np.ndarray]:
        """Those of the loss, by backpropagation through time: of both layers, the weights of the labels and their bias."""
        h, kept = self.forth.back.shape[1], ([], [])
        states, logits = self.logits(codes, kept)
        out, bias, outer = np.zeros_like(self.out), np.zeros_like(self.bias), []
        for s, x in zip(states, logits, strict=True):
            e = np.exp(x - x.max(axis=0))
            p = e / e.sum(axis=0)
            p[own, np.arange(len(own))] -= 1
            p /= np.float32(len(own) * len(codes))
            out += p @ s.T
            bias += p.sum(axis=1, keepdims=True)
            outer.append(self.out.T @ p)
        return [*self.forth.gradients(kept[0], [o[:h] for o in outer]), *self.back.gradients(kept[1], [o[h:] for o in outer[::-1]]), out, bias]

    def sums(self, data: np.ndarray, low: np.ndarray, start: np.ndarray, end: np.ndarray, high: np.ndarray) -> np.ndarray:
        """For each window of `data`, read from low to high, the sums over its bytes from start to end that are no white space of the
        probabilities and of the labels as one-hot rows: (N, 2C)."""
        c = len(self.labels)
        out = np.zeros((len(low), 2 * c), np.float32)
        order = np.argsort(high - low, kind="stable")
        for first in range(0, len(order), SIDE):
            some = order[first : first + SIDE]
            place = low[some] + np.arange(int((high - low)[some].max()))[:, None]
            codes = np.where(place < high[some], data[np.minimum(place, len(data) - 1)].astype(np.int64), PAD)
            counts = ((place >= start[some]) & (place < end[some]) & ~SPACE[codes]).astype(np.float32)
            total, column = np.zeros((2 * c, len(some)), np.float32), np.arange(len(some))
            for p, one in zip(self.positions(codes), counts, strict=True):
                total[:c] += p * one
                total[c + p.argmax(axis=0), column] += one
            out[some] = total.T
        return out


def windows(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The windows of texts that begin at `at` (and the last ends): the text, and where reading, labelling, labelling's end and reading's
    end are.  A text's windows have about equal lengths; none begins within a character."""
    sizes = np.diff(at)
    many = -(-sizes // WINDOW)
    text = np.repeat(np.arange(len(sizes)), many)
    k = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)

    def whole(place: np.ndarray) -> np.ndarray:
        for _ in range(3):
            inside = (place > at[text]) & (place < at[text + 1])
            inside[inside] = data[place[inside]] & 0xC0 == 0x80
            place = place - inside
        return place

    start, end = (whole(at[text] + sizes[text] * j // many[text]) for j in (k, k + 1))
    return text, whole(np.maximum(start - CONTEXT, at[text])), start, end, whole(np.minimum(end + CONTEXT, at[text + 1]))


def _noise(rng: np.random.Generator, n: int) -> bytes:
    """Bytes that belong to no language: digits, hexadecimal and base-64 codes, symbols, any bytes, one byte again and again, in short and long
    runs with white space between."""
    sets = [np.frombuffer(x, np.uint8) for x in (b"0123456789", b"0123456789abcdef", b"0123456789abcdefghijklmnopqrstuvwxyz+/", b"!#$%&*+-./:;<=>?@^_~|()[]{}", bytes(range(33, 256)))]
    out, size = [], 0
    while size < n:
        kind = sets[rng.integers(0, len(sets))]
        kind = kind[rng.integers(0, len(kind))][None] if rng.random() < 0.2 else kind
        out.append(rng.choice(kind, rng.integers(1, 25 if rng.random() < 0.5 else 7)).tobytes())
        size += len(out[-1]) + 1
    return b" ".join(out)


def train(texts: list[str], langs: list[str], seed: int = 7, steps: int = STEPS) -> Model:
    """A model from labelled texts; the labels are their languages in order, and NOISE."""
    rng = np.random.default_rng(seed)
    labels = [*sorted(set(langs) - {NOISE}), NOISE]
    codes, own = [], []
    for k, lang in enumerate(labels):
        whole = [" ".join(t for t, x in zip(texts, langs, strict=True) if x == lang).lower().encode()] if lang in langs else []
        for raw in [*whole, _noise(rng, TRAIN_WINDOWS * TRAIN_BYTES // 4)] if lang == NOISE else whole:
            data = np.frombuffer(raw + b" " * TRAIN_BYTES, np.uint8)
            begin = rng.integers(0, max(1, len(raw) - TRAIN_BYTES), TRAIN_WINDOWS)
            codes.append(data[begin[:, None] + np.arange(TRAIN_BYTES)])
            own.append(np.full(TRAIN_WINDOWS, k))
    data, label = np.concatenate(codes), np.concatenate(own)

    h, c = HIDDEN, len(labels)
    one = lambda *shape: rng.normal(0, 0.3, shape).astype(np.float32)
    params = [one(3 * h, PAD + 1), one(3 * h, h), one(3 * h, PAD + 1), one(3 * h, h), one(c, 2 * h), np.zeros((c, 1), np.float32)]
    for i in (0, 2):
        # Both gates shut: the state is the new value, which is nothing.
        params[i][:, PAD] = np.repeat(np.array([-1e4, -1e4, 0], np.float32), h)
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(steps):
        pick = rng.integers(0, len(label), BATCH)
        codes, own = np.ascontiguousarray(data[pick].T.astype(np.int64)), label[pick]
        model = Model(labels, Layer(params[0], params[1]), Layer(params[2], params[3]), params[4], params[5])
        grads = model.gradients(codes, own)
        rate = RATE * (1 - step / steps) + 1e-4
        for i, g in enumerate(grads):
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.99 * second[i] + 0.01 * g * g
            params[i] = params[i] - np.float32(rate) * (first[i] / (1 - 0.9 ** (step + 1))) / (np.sqrt(second[i] / (1 - 0.99 ** (step + 1))) + np.float32(1e-8))
    return Model(labels, Layer(params[0], params[1]), Layer(params[2], params[3]), params[4], params[5])


def fit(labelled: DataFrame, docs: int = TRAIN_DOCS) -> Model | None:
    """A model from at most `docs` rows of (doc_id, text, lang), those of the least hashes; None where no row has all three."""
    rows = labelled.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").where("doc_id is not null and lang is not null")
    # The share of the hashes that holds about `docs` rows, so that no task sends the driver more than its part of them.
    share = min(1.0, 1.2 * docs / max(1, rows.count()))
    near = rows.where(F.xxhash64("doc_id") <= F.lit(int(min(2.0**63 - 1025, -(2.0**63) + share * 2.0**64)))).where("trim(text) <> ''")
    some = near.orderBy(F.xxhash64("doc_id"), "doc_id", "text", "lang").limit(docs).collect()
    return train([r["text"] for r in some], [r["lang"] for r in some]) if some else None


def _labeller(model: Model):
    c = len(model.labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = np.zeros((len(batch), 2 * c))
            # Few rows at a time, so that few windows are open at once.
            for first in range(0, len(batch), 256):
                data, at = buffers(batch.column("raw").slice(first, 256))
                text, *places = windows(data, at)
                # A very long text's windows come in parts.
                for k in range(0, len(text), 8 * SIDE):
                    sums = model.sums(data, *(p[k : k + 8 * SIDE] for p in places))
                    np.add.at(total, first + text[k : k + 8 * SIDE], sums)
            sizes = np.round(total[:, c:].sum(axis=1)).astype(np.int64)
            some = sizes > 0
            best = np.where(total[:, c - 1] >= REJECTED * sizes, c - 1, total[:, : c - 1].argmax(axis=1) if c > 1 else 0)
            langs = [model.labels[k] if s else None for k, s in zip(best, some, strict=True)]
            prob = np.round(total[np.arange(len(best)), best] / np.maximum(sizes, 1), 4)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(prob, mask=~some), pa.array(sizes), pa.array(np.round(total[np.arange(len(best)), c + best]).astype(np.int64)), pa.array(some & (best < c - 1))],
                ["doc_id", "lang", "prob", "positions", "own", "keep"],
            )

    return run


def identified(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang, prob, positions, own and keep for every row of `docs`.

    lang is the language of the highest mean probability over all positions (bytes that are no white space), or NOISE where that has a
    mean of REJECTED or more; prob is the mean, own the positions that bear the label themselves.  keep is false where the label is
    NOISE or there is no position: a null or empty text, or white space alone, has a null lang and prob.  Of equal means the first
    language in order counts.  Without a model every lang is null and every row is kept.  Texts may have any length.  Rows are judged
    one by one, so repeated rows and null ids give a row each; other columns are ignored.
    """
    rows = modest(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.lower("text").cast("binary").alias("raw"))
    if model is None:
        return rows.select("doc_id", F.lit(None).cast("string").alias("lang"), F.lit(None).cast("double").alias("prob"), F.lit(0).cast("long").alias("positions"), F.lit(0).cast("long").alias("own"), F.lit(True).alias("keep"))
    return rows.mapInArrow(tidy(_labeller(model)), RESULT)


def languages_kept(docs: DataFrame, model: Model | None) -> DataFrame:
    """`docs` without the rows that `identified` rejects, columns as they came.  The texts pass through the labeller as they are, so no
    join on ids is needed and rows that share an id are judged each by its own text."""
    if model is None:
        return docs
    label = _labeller(model)

    raw = fresh(docs, "raw")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def texts() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                held.append(batch)
                yield pa.RecordBatch.from_arrays([pa.nulls(len(batch), pa.int64()), batch.column(raw)], ["doc_id", "raw"])

        for verdict in label(texts()):
            yield held.pop().drop_columns([raw]).filter(verdict.column("keep"))

    return modest(docs).withColumn(raw, F.lower("text").cast("binary")).mapInArrow(tidy(run), docs.schema)


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`identified` for all documents, by a model of a sample of them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return identified(docs, fit(docs))
