from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import tiktoken

from tidewater.llm import bpe, langid, quality, tokencount
from tidewater.llm.hashing import word_hashes

from .cases import awkward, documents, empty


def plain():
    pieces = bpe.vocabulary()
    return tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks={p: i for i, p in enumerate(pieces)}, special_tokens={})


def odd_texts():
    rng = random.Random(1)
    texts = ["", " ", "\n\n  x", "don't they'll 's", "a" * 500, "é" * 300, "ab " * 50 + "zzzz" * 40, "中文字 \U0001f600\U0001f600 ½ ²", "<|endoftext|>", "\x00\x1c\x85   tab\t\r\n"]
    return texts + ["".join(rng.choice("abcdefgh éü.,'!09\n") for _ in range(rng.randrange(1, 400))) for _ in range(150)]


def test_bpe_is_that_of_the_library_and_decodes(spark):
    texts, encode = odd_texts(), plain().encode_ordinary
    got = {r["doc_id"]: r for r in bpe.round_trip(documents(spark, texts)).collect()}
    for i, t in enumerate(texts):
        assert got[i]["ids"] == encode(t) and got[i]["text"] == t and got[i]["n_tokens"] == len(encode(t)), t


def test_small_blocks_give_the_same(spark):
    texts = odd_texts()
    docs = documents(spark, texts)
    assert sorted(map(tuple, bpe.encoded(docs, block=50).collect())) == sorted(map(tuple, bpe.encoded(docs).collect()))


def test_bpe_on_awkward_rows(spark):
    rows = bpe.round_trip(awkward(spark)).collect()
    assert len(rows) == 11
    by = {r["doc_id"]: r for r in rows}
    assert by[2]["ids"] is None and by[2]["text"] is None and by[3]["ids"] == [] and by[3]["text"] == "" and by[None]["text"].startswith("a text")
    assert bpe.round_trip(empty(spark)).collect() == []


def test_heap_merges_like_the_library():
    ids, encode = {p: i for i, p in enumerate(bpe.vocabulary())}, plain().encode_ordinary
    rng = random.Random(2)
    for _ in range(100):
        word = "".join(rng.choice("abcdeth") for _ in range(rng.randrange(1, 300)))
        assert bpe.heap_merged(word.encode(), ids) == encode(word)


def test_decoding_unknown_ids_is_null(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([([0, 1],), ([10**6],), ([None],), ([],), (None,)], "ids array<int>").select(bpe.decoded(F.col("ids")).alias("t")).collect()
    pieces = bpe.vocabulary()
    assert [r["t"] for r in rows] == [bytearray(pieces[0] + pieces[1]), None, None, bytearray(), None]


def test_token_counts_of_huge_texts(spark):
    rng = random.Random(3)
    texts = odd_texts() + ["".join(rng.choice("abcdefgh  é.,'!09\n") for _ in range(5000)) for _ in range(8)] + ["x" * 4000, "é" * 2000 + " ab", " " * 3000, "word " * 900]
    encode = plain().encode_ordinary
    got = {r["doc_id"]: r for r in tokencount.token_counts(documents(spark, texts), chunk=500, overlap=40).collect()}
    assert {i: got[i]["n_tokens"] for i in got} == {i: len(encode(t)) for i, t in enumerate(texts)}
    assert any(r["n_chunks"] > 5 for r in got.values()) and any(r["overlap"] > 40 for r in got.values())


def test_token_counts_on_awkward_rows(spark):
    rows = tokencount.token_counts(awkward(spark), chunk=1000, overlap=64).collect()
    by = {r["doc_id"]: r["n_tokens"] for r in rows}
    assert len(rows) == 11 and by[2] is None and by[3] == 0 and by[5] == len(plain().encode_ordinary(awkward(spark).where("doc_id = 5").first()["text"])) and sum(r["doc_id"] == 5 for r in rows) == 2
    assert tokencount.token_counts(empty(spark)).collect() == []


SAMPLES = {"en": "the and of to that with for this was from".split(), "de": "der die und ist nicht mit ein auch sich von".split(), "fr": "le la les des est que dans pour une avec".split()}


def labelled(n, seed):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(sorted(SAMPLES))
        out.append((i, " ".join(rng.choice(SAMPLES[lang]) + rng.choice(["", "", "a", "en", "t"]) for _ in range(rng.randrange(5, 40))), lang))
    return out


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(1)
    layer = langid.Layer(rng.normal(0, 0.3, (9, 256)), rng.normal(0, 0.3, (9, 3)))
    codes, aim = rng.integers(0, 4, (5, 6)), [rng.normal(size=(3, 6)) for _ in range(5)]
    loss = lambda: sum(float((h * a).sum()) for h, a in zip(layer.run(codes), aim, strict=True))
    kept = []
    layer.run(codes, kept)
    for name, g in zip(("inputs", "back"), layer.gradients(kept, aim), strict=True):
        p = getattr(layer, name)
        for at in [(0, 1), (4, 2), (8, 0), (3, 2)]:
            p[at] += 1e-3
            up = loss()
            p[at] -= 2e-3
            down = loss()
            p[at] += 1e-3
            assert abs((up - down) / 2e-3 - g[at]) < 2e-3 * max(1, abs(g[at]))


def test_language_accuracy_on_held_out_texts_and_rejection(spark):
    train = labelled(300, 1)
    model = langid.train([t for _, t, _ in train], [x for _, _, x in train], steps=150)
    held = labelled(200, 2)
    rows = {r["doc_id"]: r for r in langid.identified(documents(spark, [(i, t) for i, t, _ in held]), model).collect()}
    assert np.mean([rows[i]["lang"] == x for i, _, x in held]) >= 0.95 and all(r["keep"] for r in rows.values())
    noise = langid.identified(documents(spark, ["93842 1039 $$$$ #### 77f3a9c0 ++--", "", None, " \n"]), model).collect()
    assert not any(r["keep"] for r in noise) and [r["lang"] for r in sorted(noise, key=lambda r: r["doc_id"])][1:] == [None] * 3
    assert len(model.label("thé und 123")) == 12 and model.label("") == []


def test_languages_kept_on_awkward_rows(spark):
    train = labelled(120, 3)
    model = langid.train([t for _, t, _ in train], [x for _, _, x in train], steps=80)
    docs = awkward(spark)
    out = langid.languages_kept(docs, model)
    verdict = langid.identified(docs, model).where("keep").count()
    assert out.columns == docs.columns and out.count() == verdict and langid.languages_kept(docs, None).count() == 11
    assert langid.languages_kept(empty(spark), model).collect() == [] and langid.identified(empty(spark), model).collect() == []


def test_fit_is_bounded_and_needs_labels(spark):
    docs = spark.createDataFrame(labelled(100, 4), "doc_id long, text string, lang string")
    assert langid.fit(docs.where("false")) is None
    model = langid.fit(docs, docs=40)
    assert model.labels == ["de", "en", "fr", "und"]


def test_features_are_those_of_each_row_alone():
    texts = ["good words here, and more", None, "", "a", "bad !! %%% bad", "x" * 2000 + " y"]
    whole = {}
    for start, end, flat, at in quality.features(pa.array(texts)):
        for i in range(end - start):
            whole[start + i] = flat[at[i] : at[i + 1]].tolist()
    for i, t in enumerate(texts):
        alone = [x for _, _, flat, _ in quality.features(pa.array([t], pa.string())) for x in flat.tolist()]
        assert whole[i] == alone
    (_, _, words, _), *_ = word_hashes(pa.array(["bad !! %%% bad"]), single=quality.SYMBOL)
    assert len(whole[4]) == 2 * len(words) - 1 == 13


def test_quality_on_held_out_texts(spark):
    rng = random.Random(5)

    def text(good):
        ws = [rng.choice(["tree", "house", "river", "sun", "walk", "read"]) + rng.choice(["", "s", "er"]) for _ in range(30)]
        return " ".join(ws) + "." if good else " ".join(w.upper() + rng.choice(["!!", "%%%", "$$$"]) for w in ws)

    rows = [(i, text(i % 3 > 0)) for i in range(300)]
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(200)] + [(None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    weights = quality.fit(docs, labels)
    got = {r["doc_id"]: r for r in quality.scored(docs, weights).collect()}
    assert np.mean([got[i]["keep"] == (i % 3 > 0) for i in range(200, 300)]) >= 0.95
    odd = {r["doc_id"]: r for r in quality.scored(awkward(spark), weights).collect()}
    assert odd[2]["quality"] is None and not odd[3]["keep"] and odd[1]["quality"] is not None
    assert quality.fit(docs, labels.where("false")) is None and quality.scored(awkward(spark), None).where("keep").count() == 11
    assert quality.scored(empty(spark), weights).collect() == []


def test_leader_weights_follow_the_closed_form():
    learner = quality.Learner(4)
    rng = np.random.default_rng(3)
    for _ in range(200):
        at = np.unique(rng.integers(0, 16, 4))
        learner.learn(at, np.ones(len(at)), int(3 in at))
    w = learner.weights()
    assert w[3] > 0 and w[3] == w.max()
