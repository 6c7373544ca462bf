from __future__ import annotations

import itertools
import random

import numpy as np

from tidewater.llm import jaccard
from tidewater.llm.hashing import U, mix

from .cases import awkward, documents, empty
from .test_dedup import grams, words


def brute(docs, threshold=jaccard.THRESHOLD):
    """doc_id, class and links of (doc_id, text) rows by comparing all versions."""
    versions = sorted({(d, frozenset(grams(t))) for d, t in docs}, key=lambda v: (v[0], len(v[1])))
    near = [[i for i, (_, b) in enumerate(versions) if i != k and a and b and len(a & b) / len(a | b) >= threshold] for k, (_, a) in enumerate(versions)]
    out = []
    for k, (d, _) in enumerate(versions):
        seen, left = {k}, [k]
        while left:
            for i in near[left.pop()]:
                if i not in seen:
                    seen.add(i)
                    left.append(i)
        out.append((d, min(versions[i][0] for i in seen), len(near[k])))
    return sorted(out)


def rows(df):
    return sorted((r["doc_id"], r["class_id"], r["links"]) for r in df.collect())


def test_copies_are_linked_with_each_other_and_with_near_copies(spark):
    rng = random.Random(8)
    base = [words(rng, 80) for _ in range(4)]
    near = [" ".join([*b[:40], "other", *b[41:]]) for b in base]
    texts = [" ".join(b) for b in base] * 3 + near * 2
    assert rows(jaccard.linked(documents(spark, texts))) == brute(list(enumerate(texts))) == [(i, i % 4, 4) for i in range(20)]


def test_no_link_is_missed_in_any_band(spark):
    """Pairs at and around the threshold, by edits and by one set inside the other, with many documents that share common words."""
    rng = random.Random(3)
    texts = []
    for size in (1, 2, 3, 5, 9, 15, 17, 40, 62, 66, 90, 150, 250, 270, 400, 700, 1100):
        base = [rng.choice("the of and a in".split()) if rng.random() < 0.3 else f"w{rng.randrange(4000)}" for _ in range(size)]
        texts.append(" ".join(base))
        for k in (0.7, 0.71, 0.75, 0.9):
            texts += [" ".join(base[: int(size * k) + 1]), " ".join(base[: int(size * k)])]
        for rate in (0.05, 0.08, 0.09, 0.1, 0.15):
            texts.append(" ".join(w if rng.random() > rate else f"v{rng.randrange(4000)}" for w in base))
    docs = list(enumerate(texts))
    want = brute(docs)
    assert sum(n for *_, n in want) > 400
    table = documents(spark, texts)
    assert rows(jaccard.linked(table)) == want
    true = {(a, b) for (a, x), (b, y) in itertools.combinations(docs, 2) if grams(x) != grams(y) and len(grams(x) & grams(y)) / len(grams(x) | grams(y)) >= jaccard.THRESHOLD}
    first = {}
    for i, t in docs:
        first.setdefault(frozenset(grams(t)), i)
    got = {(r["doc_a"], r["doc_b"]) for r in jaccard.jaccard_join(table).where("jaccard < 1").collect()}
    assert got == {(a, b) for a, b in true if a == first[frozenset(grams(texts[a]))] and b == first[frozenset(grams(texts[b]))]}


def test_tiles_and_small_buckets_give_the_same_pairs(spark):
    rng = random.Random(5)
    base = words(rng, 60)
    texts = [" ".join(w if rng.random() > 0.04 else "x" + str(rng.randrange(99)) for w in base) for _ in range(40)]
    one, two = (jaccard.set_pairs(documents(spark, texts), **more)[1].collect() for more in ({}, {"bucket": 50, "tile": 5}))
    assert sorted(map(tuple, one)) == sorted(map(tuple, two)) and len(one) > 100


def test_first_segments_of_a_pair_meet():
    """The pigeonhole by itself: of two sets at most D apart, the first common segment is among the D + 1 first of both."""
    rng, some = np.random.default_rng(4), np.random.default_rng(5).integers(0, 5, jaccard.SLOTS)
    with np.errstate(over="ignore"):
        for n in (4, 13, 63, 64, 91, 255, 300, 1023, 1500, 5000):
            for _ in range(20):
                a = np.unique(mix(rng.integers(0, 1 << 63, n).astype(U)))
                k = int(0.3 * len(a))
                for b in (a[: len(a) - k], np.union1d(a[: len(a) - len(a) * 3 // 17], mix(rng.integers(0, 1 << 63, len(a) * 3 // 17).astype(U)))):
                    if len(np.intersect1d(a, b)) / len(np.union1d(a, b)) < 0.7:
                        continue
                    x, y = ({s: set(w.tolist()) for s, w, _ in jaccard.keys(g, 0.7, some)} for g in (a, b))
                    assert any(x[s] & y[s] for s in x.keys() & y.keys()), n


def test_versions_of_a_document_count_by_themselves(spark):
    rng = random.Random(6)
    one, two = words(rng, 60), words(rng, 60)
    docs = [(0, " ".join(one)), (2, " ".join(one)), (2, " ".join(two)), (1, " ".join([*two[:-1], "else"])), (2, " ".join(two)), (3, None), (3, "")]
    assert rows(jaccard.linked(documents(spark, docs))) == brute(docs) == [(0, 0, 1), (1, 1, 1), (2, 0, 1), (2, 1, 1), (3, 3, 0)]


def test_op9_takes_every_document_of_the_table(spark, tmp_path):
    text = " ".join(words(random.Random(9), 60))
    spark.createDataFrame([(50, text), (100, text), (200, text + " more"), (300, text), (301, "far away")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert rows(jaccard.op9_jaccard(spark, str(tmp_path))) == [(50, 50, 3), (100, 50, 3), (200, 50, 3), (300, 50, 3), (301, 301, 0)]


def test_links_of_awkward_rows_and_none(spark):
    docs = awkward(spark)
    got = rows(jaccard.linked(docs))
    assert got == brute([(r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] is not None]) and (6, 1, 1) in got
    assert jaccard.linked(empty(spark)).collect() == []
