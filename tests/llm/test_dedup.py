from __future__ import annotations

import itertools
import random
import re

import numpy as np
import pytest

from tidewater.llm import decontaminate, exact, jaccard
from tidewater.llm.hashing import U

from .cases import LONG, awkward, documents, empty


def words(rng, n):
    return [rng.choice(["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "theta", "iota", "kappa", "mu", "nu"]) + str(rng.randrange(30)) for _ in range(n)]


def grams(text, n=jaccard.NGRAM):
    w = re.findall(r"(?:[a-z0-9]|[^\x00-\x7f])+", (text or "").lower())
    return {tuple(w[i : i + min(n, len(w))]) for i in range(len(w) - min(n, len(w)) + 1)} if w else set()


def test_minimal_perfect_hash_is_perfect_and_turns_strangers_away():
    rng = np.random.default_rng(1)
    digests = rng.integers(0, 1 << 63, (5000, 4)).astype(U)
    sizes, bits, slots, winners = exact.build(digests, np.arange(5000))
    assert sorted(winners.tolist()) == list(range(5000)) and len(slots) == 5000
    assert (exact.lookup(sizes, bits, slots, winners, digests) == np.arange(5000)).all()
    assert (exact.lookup(sizes, bits, slots, winners, rng.integers(0, 1 << 63, (500, 4)).astype(U)) == -1).all()


def test_exact_dedup_on_awkward_rows(spark):
    got = sorted({tuple(r) for r in exact.exact_dedup(awkward(spark)).collect()}, key=str)
    by = {(d, w): r for d, w, r in got}
    assert by[(1, 1)] is False and by[(6, 1)] is True and by[(2, 2)] is False and by[(3, 3)] is False and by[(5, 5)] is False
    assert (None, None) in by or any(d is None for d, _ in by)


def test_exact_dedup_against_history(spark):
    history = documents(spark, ["old", "older", "old"], first=100)
    got = {r["doc_id"]: (r["winner_id"], r["repeat"]) for r in exact.exact_dedup(documents(spark, ["old", "new", "new", "older"]), history).collect()}
    assert got == {0: (100, True), 1: (1, False), 2: (1, True), 3: (101, True)}


def test_repeats_removed_keeps_one_of_each_text(spark):
    docs = awkward(spark)
    out = exact.repeats_removed(docs)
    assert out.columns == docs.columns
    left = [(r["doc_id"], r["text"]) for r in out.collect()]
    texts = [t for _, t in left if t is not None]
    assert len(texts) == len(set(texts)) == len({r["text"] for r in docs.collect()} - {None}) and (2, None) in left and (6, texts[0]) not in left


def test_exact_dedup_of_nothing(spark):
    assert exact.exact_dedup(empty(spark)).collect() == [] and exact.repeats_removed(empty(spark)).collect() == []


def test_minwise_bits_agree_as_the_coefficient_says():
    rng, agreed = np.random.default_rng(2), []
    with np.errstate(over="ignore"):
        for _ in range(200):
            a = rng.integers(0, 1 << 63, 340).astype(U) * U(2)
            b = np.concatenate([a[60:], rng.integers(0, 1 << 63, 60).astype(U) * U(2)])
            agreed.append(jaccard.BITS - int(np.bitwise_count(jaccard.minwise(a) ^ jaccard.minwise(b)).sum()))
    assert abs(np.mean(agreed) / jaccard.BITS - 0.85) < 0.01 and min(agreed) > jaccard.agreement(0.7)


def test_jaccard_join_against_brute_force(spark):
    rng = random.Random(3)
    texts = []
    for size in (3, 8, 20, 60, 150, 400):
        for _ in range(12):
            base = words(rng, size)
            texts.append(" ".join(base))
            for rate in (0.02, 0.05, 0.1, 0.15):
                texts.append(" ".join(w if rng.random() > rate else rng.choice(words(rng, 3)) for w in base))
    texts += [texts[0], texts[5], texts[5]]
    sets = [grams(t) for t in texts]
    rep = {}
    for i, s in enumerate(sets):
        rep.setdefault(frozenset(s), i)
    heads = sorted(rep.values())
    true = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a, b in itertools.combinations(heads, 2)}
    true = {p: j for p, j in true.items() if j >= jaccard.THRESHOLD}
    same = {(rep[frozenset(s)], i) for i, s in enumerate(sets) if rep[frozenset(s)] != i}
    got = {(r["doc_a"], r["doc_b"]): r["jaccard"] for r in jaccard.jaccard_join(documents(spark, texts)).collect()}
    found = set(got) - same
    assert same <= set(got) and found <= set(true)
    assert len(true) > 100 and found == set(true)
    assert all(abs(got[p] - true[p]) < 1e-9 for p in found)


def test_jaccard_on_awkward_rows_and_none(spark):
    got = {(r["doc_a"], r["doc_b"]) for r in jaccard.jaccard_join(awkward(spark)).collect()}
    assert (1, 6) in got and all(a is not None and a < b for a, b in got)
    assert jaccard.jaccard_join(empty(spark)).collect() == []


def test_near_duplicates_leave_the_lowest_of_each_group(spark):
    rng = random.Random(4)
    base = words(rng, 100)
    near = [" ".join(base)] + [" ".join(base[:k] + ["other"] + base[k + 1 :]) for k in (10, 50, 90)]
    docs = documents(spark, [*near, " ".join(words(rng, 100)), None, ""])
    out = jaccard.near_duplicates_removed(docs)
    assert out.columns == docs.columns and sorted(r["doc_id"] for r in out.collect()) == [0, 4, 5, 6]


def test_components_of_a_chain_and_a_star(spark):
    pairs = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 20)] + [(100, 101)]
    got = {r["doc_id"]: r["head"] for r in jaccard.components(spark.createDataFrame(pairs, "doc_a long, doc_b long")).collect()}
    assert got == {i: 0 for i in range(31)} | {100 + i: 100 for i in range(20)}


def distance(item, text):
    """Least edits of `item` to any substring of `text`, by the plain table."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def test_myers_is_the_edit_distance():
    rng = random.Random(5)
    for _ in range(200):
        item = "".join(rng.choice("abc ") for _ in range(rng.randrange(1, 90)))
        text = "".join(rng.choice("abc ") for _ in range(rng.randrange(0, 120)))
        assert decontaminate.Pattern(item).distance(text) == min(len(item), distance(item, text))


def test_leaks_against_brute_force(spark):
    rng = random.Random(6)
    items = [" ".join(words(rng, n)) for n in (6, 12, 25)] + ["short", None, ""]
    texts = []
    for item in items[:3]:
        for edits in (0, 1, 3, 5, 8, 14, 20):
            own = list(item)
            for _ in range(edits):
                k = rng.randrange(len(own))
                own[k : k + 1] = rng.choice([[], [rng.choice("xyz")], [own[k], "q"]])
            texts.append(" ".join(words(rng, 20)) + " " + "".join(own).upper() + "!! " + " ".join(words(rng, 20)))
    texts += [" ".join(words(rng, 300)), None, "", LONG]
    benchmark = spark.createDataFrame([(i, t, "more") for i, t in enumerate(items)], "item_id long, text string, doc_id string")
    got = {(r["doc_id"], r["item_id"]): r["edits"] for r in decontaminate.leaks(documents(spark, texts), benchmark).collect()}
    want = {}
    for d, t in enumerate(texts[:-1]):
        for i, item in enumerate(items[:3]):
            m = decontaminate.normal(item)
            k = distance(m, decontaminate.normal(t or ""))
            if k <= decontaminate.budget(len(m)):
                want[(d, i)] = k
    assert got == want and len(want) >= 9


@pytest.mark.parametrize("limit", [1, 1 << 20])
def test_items_in_groups_and_decontamination(spark, limit):
    item = "this is the one question that every model must never have seen before"
    groups = list(decontaminate.item_groups(spark.createDataFrame([(1, item), (2, item + " again"), (3, "x")], "item_id long, text string"), limit))
    assert sum(map(len, groups)) == 3 and len(groups) == (3 if limit == 1 else 1)
    docs = documents(spark, ["before. " + item.upper() + " after", "nothing of the kind", None, ""])
    out = decontaminate.decontaminated(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert out.columns == docs.columns and sorted(r["doc_id"] for r in out.collect()) == [1, 2, 3]


def test_no_items_and_no_documents(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.leaks(awkward(spark), none).collect() == []
    assert decontaminate.leaks(empty(spark), spark.createDataFrame([(1, "a benchmark item that is long enough to count")], "item_id long, text string")).collect() == []
