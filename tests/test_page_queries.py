"""The page queries that SQL can't express, against plain versions over pages of simple links."""

from __future__ import annotations

import random
import re

import pytest

from tidewater.plans import pages

WORDS = ["the", "and", "die", "que", "other", "thesis", "nation", "lab"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng, path, rows = random.Random(2), str(tmp_path_factory.mktemp("pages")), []
    for i in range(40):
        links = [(" ".join(rng.choice(WORDS) for _ in range(rng.randrange(1, 3))), f"http://{rng.choice('ab')}.org/{'/'.join(rng.choice(WORDS) for _ in range(rng.randrange(1, 3)))}") for _ in range(rng.randrange(0, 9))]
        rows.append((i, "http://a.org/", "<body>" + " ".join(f'<p><a href="{u}">{a.title()}</a></p>' for a, u in links) + "</body>"))
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{path}/pages.parquet")
    plain = {i: [(k, a, u) for k, (u, a) in enumerate(re.findall(r'<a href="([^"]*)">([^<]*)</a>', h))] for i, _, h in rows}
    return path, plain


def strength(text, token):
    words = re.sub(r"[^a-z0-9]+", " ", text.lower()).strip()
    return 1.0 if words == token else 0.9 if token in words.split() else 0.75 if token in text.lower() else 0.0


def test_every_link_of_every_page(spark, folder):
    path, plain = folder
    got = {(r["page_id"], r["pos"]): (r["anchor"], r["url"]) for r in pages.page_links(spark, path).collect()}
    assert got == {(i, k): (a, u) for i, links in plain.items() for k, a, u in links}


def test_repeated_links_of_every_page(spark, folder):
    path, plain = folder
    got = {r["page_id"]: (r["links"], r["kept"], r["dropped"]) for r in pages.link_dedup_counts(spark, path).collect()}
    want = {i: (len(x), len({(u, a.lower()) for _, a, u in x})) for i, x in plain.items() if x}
    assert got == {i: (n, k, n - k) for i, (n, k) in want.items()}


def test_best_link_of_every_slot(spark, folder):
    path, plain = folder
    want = {}
    for i, links in plain.items():
        for slot in {s for s, _, _ in pages.SLOTS}:
            best = None
            for k, a, u in links:
                where = u.split(".org", 1)[1]
                x = max([strength(a, t) for s, t, kind in pages.SLOTS if (s, kind) == (slot, "anchor")], default=0.0)
                y = max([strength(where, t) for s, t, kind in pages.SLOTS if (s, kind) == (slot, "path")], default=0.0)
                if (x or y) and a.lower() == where.strip("/").split("/")[-1]:
                    x = min(1.0, x + 0.05)
                score = round(0.65 * x + 0.35 * y, 4)
                if score >= 0.35 and (best is None or score > best[1] + 1e-9):
                    best = (k, score)
            if best:
                want[i, slot] = best
    got = {(r["page_id"], r["slot"]): (r["pos"], r["score"]) for r in pages.link_slot_classification(spark, path).collect()}
    assert got.keys() == want.keys() and all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 2e-4 for k in want) and len(want) > 30

