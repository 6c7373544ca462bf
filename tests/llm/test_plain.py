"""The models and scans against plain versions of themselves, and cases that caps used to lose."""

from __future__ import annotations

import math
import random
import time

import numpy as np
import pyarrow as pa
import pytest

from tidewater.llm import chat, decontaminate, exact, html, langid, quality, secrets

from .cases import documents
from .test_text import labelled


def plain_positions(model, raw):
    """Probabilities of each byte of one window, one number at a time."""
    h = len(model.forth.back[0])
    squash = lambda x: 1 / (1 + math.exp(-x))

    def states(layer, codes):
        s, out = [0.0] * h, []
        for code in codes:
            a = [float(x) for x in layer.inputs[:, code]]
            u = [sum(float(layer.back[i, k]) * s[k] for k in range(h)) for i in range(3 * h)]
            z, r = [squash(a[i] + u[i]) for i in range(h)], [squash(a[h + i] + u[h + i]) for i in range(h)]
            n = [math.tanh(a[2 * h + i] + r[i] * u[2 * h + i]) for i in range(h)]
            s = [n[i] + z[i] * (s[i] - n[i]) for i in range(h)]
            out.append(s)
        return out

    both = [x + y for x, y in zip(states(model.forth, raw), states(model.back, raw[::-1])[::-1], strict=True)]
    logits = [[sum(float(w) * x for w, x in zip(model.out[c], s, strict=True)) + float(model.bias[c, 0]) for c in range(len(model.labels))] for s in both]
    return [[math.exp(x) / sum(map(math.exp, row)) for x in row] for row in logits]


def plain_windows(raw):
    """(read from, label from, label to, read to) of one text."""
    back = lambda i: i if i in (0, len(raw)) or raw[i] & 0xC0 != 0x80 else back(i - 1)
    n = -(-len(raw) // langid.WINDOW)
    for k in range(n):
        a, b = back(len(raw) * k // n), back(len(raw) * (k + 1) // n)
        yield back(max(0, a - langid.CONTEXT)), a, b, back(min(len(raw), b + langid.CONTEXT))


def test_languages_are_those_of_a_plain_pass_over_each_document(spark):
    some = labelled(60, 9)
    model = langid.train([t for _, t, _ in some], [x for _, _, x in some], steps=30)
    texts = [t for _, t, _ in some[:6]] + ["中文" * 90 + " Ünïcödé", "a", "", None, "12 34 $$ the house", "x" * 400, "one\n\ttwo  three"]
    got = {r["doc_id"]: r for r in langid.identified(documents(spark, texts), model).collect()}
    for i, t in enumerate(texts):
        raw, total, labels = (t or "").lower().encode(), np.zeros(len(model.labels)), []
        for low, a, b, high in plain_windows(raw):
            p = plain_positions(model, raw[low:high])[a - low : b - low]
            labels += [int(np.argmax(x)) for x in p]
            total += sum((np.array(x) for x, c in zip(p, raw[a:b], strict=True) if c not in b"\t\n\x0b\x0c\r "), np.zeros(len(total)))
        n = sum(c not in b"\t\n\x0b\x0c\r " for c in raw)
        assert len(labels) == len(raw) and got[i]["positions"] == n
        if not n:
            assert got[i]["lang"] is None and not got[i]["keep"]
            continue
        best = len(total) - 1 if total[-1] >= langid.REJECTED * n else int(total[:-1].argmax())
        assert got[i]["lang"] == model.labels[best] and abs(got[i]["prob"] - total[best] / n) < 1e-3 and got[i]["keep"] == (best < len(total) - 1)
        assert [model.labels[k] for k in labels] == model.label(t)


def test_the_label_of_a_word_depends_on_its_neighbours():
    rng, texts = random.Random(3), []
    for k in range(300):
        texts.append((("aa " if k % 2 else "bb ") + " ".join(["mid"] * rng.randrange(1, 3)) + " ") * 3)
    model = langid.train(texts, ["x" if k % 2 else "y" for k in range(300)], steps=200)
    assert model.label("aa mid aa")[3:6] == ["x"] * 3 and model.label("bb mid bb")[3:6] == ["y"] * 3


def test_gradients_of_the_whole_model():
    rng = np.random.default_rng(2)
    one = lambda *s: rng.normal(0, 0.3, s)
    model = langid.Model(["a", "b", "und"], langid.Layer(one(9, 257), one(9, 3)), langid.Layer(one(9, 257), one(9, 3)), one(3, 6), one(3, 1))
    codes, own = rng.integers(0, 4, (5, 6)), rng.integers(0, 3, 6)
    for p, g in zip([model.forth.inputs, model.forth.back, model.back.inputs, model.back.back, model.out, model.bias], model.gradients(codes, own), strict=True):
        for at in [(0, 0), (2, 0), (1, min(2, p.shape[1] - 1))]:
            p[at] += 1e-3
            up = model.loss(codes, own)
            p[at] -= 2e-3
            down = model.loss(codes, own)
            p[at] += 1e-3
            assert abs((up - down) / 2e-3 - g[at]) < 1e-4


def test_quality_is_that_of_a_plain_learner(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["good", "bad", "word", "!!", "x1"]) for _ in range(rng.randrange(1, 30))) for _ in range(60)]
    labels = [int("bad" not in t) for t in texts]
    vectors = []
    for t in texts:
        counts: dict[int, int] = {}
        for _, _, flat, _ in quality.features(pa.array([t])):
            for b in flat.tolist():
                counts[b] = counts.get(b, 0) + 1
        total = sum(counts.values())
        vectors.append({b: n / math.sqrt(max(1, total)) for b, n in counts.items()})
    z: dict[int, float] = {}
    n: dict[int, float] = {}

    def weight(b):
        x = z.get(b, 0.0)
        return 0.0 if abs(x) <= quality.L1 else (math.copysign(quality.L1, x) - x) / ((quality.BETA + math.sqrt(n.get(b, 0.0))) / quality.ALPHA + quality.L2)

    order = np.random.default_rng(11)
    for _ in range(quality.PASSES):
        for i in order.permutation(len(texts)).tolist():
            w = {b: weight(b) for b in vectors[i]}
            p = 1 / (1 + math.exp(-sum(w[b] * x for b, x in vectors[i].items())))
            for b, x in vectors[i].items():
                g, old = (p - labels[i]) * x, n.get(b, 0.0)
                z[b] = z.get(b, 0.0) + g - (math.sqrt(old + g * g) - math.sqrt(old)) / quality.ALPHA * w[b]
                n[b] = old + g * g
    got = {r["doc_id"]: r["quality"] for r in quality.scored(documents(spark, texts), quality.train(texts, labels)).collect()}
    for i, v in enumerate(vectors):
        assert abs(got[i] - 1 / (1 + math.exp(-sum(weight(b) * x for b, x in v.items())))) < 1e-4


def test_short_items_are_found_as_whole_words(spark):
    benchmark = spark.createDataFrame([(1, "A-b c"), (2, "hi"), (3, "!!"), (4, "q" * 17)], "item_id long, text string")
    docs = documents(spark, ["so a B, C it is", "xa b c", "hi", "this", "oh, hi!", "!!", "q" * 16, "a b cd"])
    assert sorted(map(tuple, decontaminate.leaks(docs, benchmark).collect())) == [(0, 1, 0), (2, 2, 0), (4, 2, 0), (6, 4, 1)]


def test_many_automata_in_one_pass_find_the_same(spark, monkeypatch):
    items = [(i, f"item number {i} has some words of its own {i * 7919}") for i in range(30)]
    benchmark, docs = spark.createDataFrame(items, "item_id long, text string"), documents(spark, [f"before {t} after" for _, t in items[::2]])
    want = sorted(map(tuple, decontaminate.leaks(docs, benchmark).collect()))
    monkeypatch.setattr(decontaminate, "item_groups", lambda b, real=decontaminate.item_groups: real(b, 100))
    assert sorted(map(tuple, decontaminate.leaks(docs, benchmark).collect())) == want and len(want) >= 15


def test_secrets_of_any_length_are_whole():
    rng = random.Random(7)
    code = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(n))
    for text, rule in ((f"secret = '{(one := code(1000))}'", "assigned_secret"), (f"sk_live_{(one := code(300))}", "stripe_key"), (f"xoxb-{(one := code(200))}", "slack_token")):
        one = text.split("'")[1] if rule == "assigned_secret" else text
        assert (rule, one.encode()) in {(r, s) for r, _, s, _ in secrets.scan(text.encode(), secrets._automaton(secrets.RULES))}


def test_names_that_clash_and_ids_that_repeat(spark):
    schema = "doc_id long, text string, _digest string, _odd int, _row int, _d int, _winner int, _gone int, _late int, _raw string, __raw string"
    rows = [(d, t, "x", 1, 2, 3, 4, 5, 6, "y", "z") for d, t in [(1, "a"), (1, "b"), (1, "a"), (2, "a"), (None, "b"), (None, "c"), (None, "c"), (3, None), (3, None), (4, "")]]
    docs = spark.createDataFrame(rows, schema)
    out = exact.repeats_removed(docs)
    assert out.columns == docs.columns and sorted((r["doc_id"] or 0, "-" if r["text"] is None else r["text"]) for r in out.collect()) == [(0, "c"), (1, "a"), (1, "b"), (3, "-"), (3, "-"), (4, "")]


def plain_scores(page):
    """Scores by path of pages whose tags are all closed: each block's own text, in a recursive reading."""
    import re

    out: dict[str, float] = {}

    def walk(at, path, holders, linked):
        """Reads until the end tag; returns where, and the text of its own that stands in no inner block."""
        plain = 0
        while at < len(page):
            m = re.compile(r"<(/?)(\w+)(?: class=\"([^\"]*)\")?>").match(page, at)
            if not m:
                end = page.find("<", at)
                end = len(page) if end < 0 else end
                plain += (-1 if linked else 1) * len(re.sub(r"\s+", " ", page[at:end]).strip())
                at = end
                continue
            at = m.end()
            if m[1]:
                return at, plain
            step = ".".join([m[2], *sorted({re.sub(r"\d+", "#", c) for c in (m[3] or "").split()})])
            inner, here = f"{path}/{step}", holders
            if m[2] in ("html", "body", "div", "article"):
                here = [*holders, inner]
            at, own = walk(at, inner, here, linked or m[2] == "a")
            if m[2] in ("a", "b"):
                plain += own
            elif own > 0:
                gain = own * own / (own + html.HALF)
                chain = here[::-1]
                if chain:
                    out[chain[0]] = out.get(chain[0], 0) + gain
                if len(chain) > 1:
                    out[chain[1]] = out.get(chain[1], 0) + html.ABOVE * gain
        return at, plain

    walk(0, "", [], False)
    return out


def test_scores_are_those_of_a_plain_reading():
    rng = random.Random(8)

    def block(depth):
        kind = rng.choice(["p", "p", "div", "article"]) if depth < 4 else "p"
        words = lambda: " ".join(rng.choice(["some", "words", "here"]) for _ in range(rng.randrange(1, 14)))
        if kind == "p":
            return "<p>" + words() + rng.choice(["", f"<b>{words()}</b>", f"<a>{words()}</a>"]) + "</p>"
        return f'<{kind} class="{rng.choice(["x1 y", "main", "side 22"])}">' + "".join(block(depth + 1) for _ in range(rng.randrange(1, 4))) + f"</{kind}>"

    for _ in range(60):
        page = "<html><body>" + "".join(block(0) for _ in range(4)) + "</body></html>"
        got: dict[str, float] = {}
        for x in html.scored(html.tree(page)):
            got[x.path] = got.get(x.path, 0) + x.score
        want = plain_scores(page)
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in got), page


def test_deep_pages_take_linear_time_and_short_lines_count(spark):
    began = time.process_time()
    assert html.extract("<div>" * 200_000 + "deep down", None)[2] == "deep down"
    assert html.extract("".join(f"<div>text {i}" for i in range(20_000)) + "</b>" * 20_000, None)[2].startswith("text")
    assert time.process_time() - began < 15
    path, _, text = html.extract("<body><div class='menu'><a>home</a></div><div class='poem'><p>so short</p><p>a line</p></div></body>", None)
    assert path == "/body/div.poem" and text == "so short\na line"
    deep = "<div>" * 80 + "<p>words that are deep down in this page</p>"
    pages = spark.createDataFrame([(i, "http://h.org/", deep) for i in range(3)], "page_id long, url string, html string")
    assert all(r["consensus"] and r["text"].startswith("words") and "~80." in r["path"] for r in html.extracted(pages).collect())


def test_misused_filters_are_template_errors(spark):
    for source in ("{{ 5 | length }}", "{{ 'a' | replace('x') }}", "{{ 5 % 0 }}"):
        with pytest.raises(chat.TemplateError):
            chat.compiled(source)
    rows = spark.createDataFrame([(1, 0, "user", "hi"), (2, 3, "user", "hi")], "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r["text"] for r in chat.formatted(rows, "{% for m in messages %}{{ m.turn | length }}{% endfor %}").collect()}
    assert got == {1: None, 2: None}
