from __future__ import annotations

import random
import zlib

import numpy as np
import regex

from tidewater.llm import bpe


def powers(n):
    with np.errstate(over="ignore"):
        out = []
        for base in (bpe.P, bpe.P_INV):
            p = np.full(n, base, bpe.U)
            p[0] = 1
            out.append(np.cumprod(p, dtype=bpe.U))
    return out


def test_words_are_those_of_the_pattern_and_hashes_tell_them_apart():
    table, find, rng, known = np.frombuffer(zlib.decompress(bpe.classes()), np.uint8), regex.compile(bpe.PATTERN).findall, random.Random(3), {}
    parts = ["'", "s", "t", "re", "ve", "ll", "m", "d", "l", " ", "  ", "\n", "\t", " \n", "a", "é", "1", "٣", "中", ".", "!", "''", '"', "́", " ", " ", "\U0001f600", "S", "don't"]
    for k in range(1500):
        texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(0, 300 if k % 50 == 0 else 30))) for _ in range(rng.randrange(1, 6))]
        whole, hashes, start, stop, counts = bpe._words(texts, table, *powers(64))
        got = [whole[a:b] for a, b in zip(start.tolist(), stop.tolist(), strict=True)]
        assert got == [w for t in texts for w in find(t)] and counts.tolist() == [len(find(t)) for t in texts]
        assert all(known.setdefault(w, h) == h for w, h in zip(got, hashes.tolist(), strict=True))
    assert len(set(known.values())) == len(known)


def test_pieces_of_long_texts_have_the_words_of_the_whole():
    rng = random.Random(4)
    text = "".join(rng.choice(["word", " ", "\n", "a1", "'s ", "中 "]) for _ in range(1_500_000))
    parts, find = list(bpe._pieces(text)), regex.compile(bpe.PATTERN).findall
    assert len(parts) > 1 and "".join(parts) == text and [w for p in parts for w in find(p)] == find(text)
    assert list(bpe._pieces("x" * 3_000_000)) == ["x" * 3_000_000]


def test_long_words_are_spliced_from_windows():
    pieces = bpe.vocabulary()
    ids, sizes, rng, half, lost = {p: i for i, p in enumerate(pieces)}, [len(p) for p in pieces], random.Random(5), bpe.WINDOW // 2, 0
    for k in range(400):
        n = rng.randrange(65, 700)
        word = [bytes(rng.randrange(256) for _ in range(n)), "".join(rng.choice("abcdefghij") for _ in range(n)).encode(), "".join(rng.choice(["the", "ing", "tion", "er"]) for _ in range(n)).encode(), b"x" * n, b"-=" * n][k % 5]
        got = bpe.spliced([bpe.heap_merged(word[a : a + bpe.WINDOW], ids) for a in range(0, len(word) - half, half)], sizes)
        lost += got is None
        assert got is None or got == bpe.heap_merged(word, ids)
    assert lost < 40
