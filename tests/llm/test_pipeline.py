from __future__ import annotations

import random

import corpus_pipeline
from tidewater.llm import bpe, langid, queries

SD = "/root/testdata/sf0.001"


def test_queries_have_one_of_each_operator():
    names = list(queries.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 11)) and "pipeline" in names and set(queries.oracle_sql()) <= set(names)


def test_stages_against_brute_force(spark, tmp_path):
    rng = random.Random(1)
    vocabulary = {"en": "the and of to that with for this was from", "de": "der die und ist nicht mit ein auch sich von"}

    def text(lang, n=60):
        return " ".join(rng.choice(vocabulary[lang].split()) + rng.choice("abcdefgh") + rng.choice("stuvw") for _ in range(n))

    clean = [(i, text("en" if i % 2 else "de"), "en" if i % 2 else "de") for i in range(60)]
    item = text("en", 30)
    near = clean[4][1].split()
    near[10] = "changed"
    extra = [(100, clean[3][1], "en"), (101, " ".join(near), "de"), (102, text("en") + " " + item + " " + text("en"), "en"), (103, "839 #### 2034 $$$$ 9a7f 0x33 ++ -- 4455", "en"), (104, "", "en"), (105, None, "en")]
    rows = [(d, t, lang, "src", len(t or "")) for d, t, lang in clean + extra]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    left = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        left[name] = {r["doc_id"] for r in docs.select("doc_id").collect()}
    everything = {d for d, *_ in clean}
    assert [left[n] - everything for n, _ in corpus_pipeline.STAGES] == [{100, 101, 102}, {101, 102}, {102}, set(), set()]
    assert all(everything <= x for x in left.values())
    final = {r["doc_id"]: r for r in docs.collect()}
    whole = {r["doc_id"]: r["ids"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert whole == {d: r["ids"] for d, r in final.items()} and all(final[d]["text"] == t for d, t, _ in clean)
    assert bpe.VOCABULARY.endswith(".tiktoken") and langid.NOISE == "und"


def test_stages_take_empty_documents(spark):
    docs = spark.read.parquet(f"{SD}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SD)
        assert out.count() == 0
