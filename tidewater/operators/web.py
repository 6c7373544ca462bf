"""Page operators: links and page facts by a tokenizer over Arrow batches, and scores over them as column expressions.

Rules are parameters: lists of (label, ...) in order of precedence, which become case expressions or broadcast joins.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.text import bare_host, collapsed, path, url_key
from tidewater.operators.batches import batched, each

SKIPPED = frozenset(("script", "style", "noscript", "template"))
SIDE = frozenset(("nav", "header", "footer", "aside"))
_LINK = pa.struct([("pos", pa.int32()), ("anchor", pa.string()), ("href", pa.string()), ("url", pa.string()), ("context", pa.string()), ("side", pa.bool_())])
FACTS = "title string, text string, meta_refresh string, canonical string, links array<struct<pos:int,anchor:string,href:string,url:string,context:string,side:boolean>>"


class _Reader(HTMLParser):
    """Title, visible text, links with their context, and the head's pointers to other addresses, in one pass."""

    def __init__(self, url: str | None) -> None:
        super().__init__(convert_charrefs=True)
        self.base = url or ""
        self.skip = self.side = 0
        self.in_title = False
        self.title: list[str] = []
        self.texts: list[str] = []
        self.links: list[dict] = []
        self.open: tuple[str, list[str]] | None = None
        self.refresh: str | None = None
        self.canonical: str | None = None

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        given = {k: v or "" for k, v in attrs}
        if tag in SKIPPED:
            self.skip += 1
        elif tag in SIDE:
            self.side += 1
        elif tag == "title":
            self.in_title = True
        elif tag == "base" and given.get("href"):
            self.base = self._joined(given["href"]) or self.base
        elif tag == "meta" and given.get("http-equiv", "").lower() == "refresh" and "url=" in given.get("content", "").lower():
            content = given["content"]
            self.refresh = self._joined(content[content.lower().index("url=") + 4 :].strip(" '\""))
        elif tag == "link" and "canonical" in given.get("rel", "").lower().split() and given.get("href"):
            self.canonical = self._joined(given["href"])
        elif tag == "a":
            self._close()
            self.open = (given.get("href", ""), [])

    def handle_endtag(self, tag: str) -> None:
        if tag in SKIPPED:
            self.skip = max(0, self.skip - 1)
        elif tag in SIDE:
            self.side = max(0, self.side - 1)
        elif tag == "title":
            self.in_title = False
        elif tag == "a":
            self._close()

    def handle_data(self, data: str) -> None:
        if self.in_title:
            self.title.append(data)
        elif not self.skip and (said := " ".join(data.split())):
            self.texts.append(said)
            if self.open:
                self.open[1].append(said)

    def _joined(self, href: str) -> str | None:
        try:
            url = urljoin(self.base, href.strip())
            return url if urlsplit(url).scheme in ("http", "https") and urlsplit(url).netloc else None
        except ValueError:
            return None

    def _close(self) -> None:
        if self.open is None:
            return
        href, said = self.open
        self.open = None
        plain = href.strip().lower()
        if not plain or plain.startswith(("#", "mailto:", "javascript:", "tel:", "data:")):
            return
        url = self._joined(href)
        if url:
            self.links.append({"pos": len(self.links), "anchor": " ".join(said), "href": href, "url": url, "context": " ".join(self.texts[-6:]), "side": self.side > 0})


def facts_of(html: str, url: str | None) -> dict:
    reader = _Reader(url)
    reader.feed(html)
    reader.close()
    reader._close()
    return {"title": " ".join("".join(reader.title).split()), "text": " ".join(reader.texts), "meta_refresh": reader.refresh, "canonical": reader.canonical, "links": reader.links}


def _pages(pages: DataFrame, key: str) -> DataFrame:
    return pages.select(F.col(key).cast("long").alias(key), "url", "html").where("html is not null")


def parsed(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """key, url and the facts of each page; a null page has no facts."""
    kinds = pa.schema([(key, pa.int64()), ("url", pa.string()), *((c, pa.string()) for c in ("title", "text", "meta_refresh", "canonical")), ("links", pa.list_(_LINK))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return batched(({key: k, "url": u} | facts_of(h, u) for k, u, h in each(batches, [key, "url", "html"])), kinds)

    return _pages(pages, key).mapInArrow(run, f"{key} long, url string, {FACTS}")


def links(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """A row for each link: key, page_url, pos, anchor, href, url, context, side."""
    kinds = pa.schema([(key, pa.int64()), ("page_url", pa.string()), *_LINK])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return batched(({key: k, "page_url": u} | link for k, u, h in each(batches, [key, "url", "html"]) for link in facts_of(h, u)["links"]), kinds)

    return _pages(pages, key).mapInArrow(run, f"{key} long, page_url string, pos int, anchor string, href string, url string, context string, side boolean")


def distinct_links(rows: DataFrame, key: str = "page_id") -> DataFrame:
    """The first link of each (absolute url, anchor in lower case) of a page."""
    w = Window.partitionBy(key, "url", F.lower("anchor")).orderBy("pos")
    return rows.withColumn("_rk", F.row_number().over(w)).where("_rk = 1").drop("_rk")


def strength(c: Column, token: Column) -> Column:
    """1 where a text is the token, .9 where it has it as a word, .75 where it has it at all, else 0."""
    padded = F.concat(F.lit(" "), F.regexp_replace(F.lower(c), "[^a-z0-9]+", " "), F.lit(" "))
    return F.when(F.trim(padded) == token, 1.0).when(F.contains(padded, F.concat(F.lit(" "), token, F.lit(" "))), 0.9).when(F.contains(F.lower(c), token), 0.75).otherwise(0.0)


def slots(rows: DataFrame, rules: list[tuple[str, str, str]], key: str = "page_id", least: float = 0.35) -> DataFrame:
    """The best link of each page for each slot: .65 of the anchor's strength (.05 more, up to 1, where the anchor
    is the last part of the path and either has a strength) and .35 of the path's, at least `least`; of equals the first.  The rules are (slot, token, kind) with kind anchor or path;
    they are expressions of the plan, so no join is needed."""
    last = F.regexp_extract(F.regexp_replace(F.lower(path(F.col("url"))), "^/+|/+$", ""), "([^/]*)$", 1)
    scored = []
    for slot in dict.fromkeys(s for s, _, _ in rules):
        by_anchor = F.greatest(F.lit(0.0), F.lit(0.0), *[strength(F.col("anchor"), F.lit(t)) for s, t, kind in rules if (s, kind) == (slot, "anchor")])
        by_path = F.greatest(F.lit(0.0), F.lit(0.0), *[strength(path(F.col("url")), F.lit(t)) for s, t, kind in rules if (s, kind) == (slot, "path")])
        by_anchor = F.when(((by_anchor > 0) | (by_path > 0)) & (F.lower("anchor") == last), F.least(F.lit(1.0), by_anchor + 0.05)).otherwise(by_anchor)
        scored.append(F.struct(F.lit(slot).alias("slot"), F.bround(0.65 * by_anchor + 0.35 * by_path, 4).alias("score")))
    each = rows.select(key, "pos", "anchor", "url", F.explode(F.filter(F.array(*scored), lambda x: x["score"] >= least)).alias("_s")).select(key, "pos", "anchor", "url", "_s.slot", "_s.score")
    w = Window.partitionBy(key, "slot").orderBy(F.desc("score"), "pos")
    return each.withColumn("_rk", F.row_number().over(w)).where("_rk = 1").select(key, "slot", "pos", "anchor", "url", "score")


def recovered(facts: DataFrame, key: str = "page_id", moved: str = "(?i)(has|have) moved|new (home ?page|address|site)") -> DataFrame:
    """Where a page says it went: a redirect .95, a refresh .92, a canonical address .88, a link in a text about moving .85; the surest.
    `facts` has final_url, null where the fetch was not redirected."""
    other = lambda c: F.col(c).isNotNull() & ~url_key(F.col(c)).eqNullSafe(url_key(F.col("url")))
    said = F.when(F.col("text").rlike(moved), F.element_at(F.filter("links", lambda link: ~url_key(link["url"]).eqNullSafe(url_key(F.col("url")))), 1)["url"])
    signal = lambda name, sure, value: F.when(value.isNotNull(), F.struct(F.lit(sure).alias("confidence"), F.lit(name).alias("method"), value.alias("to")))
    found = F.array_compact(
        F.array(
            signal("redirect", 0.95, F.when(other("final_url"), F.col("final_url"))), signal("meta_refresh", 0.92, F.when(other("meta_refresh"), F.col("meta_refresh"))),
            signal("canonical", 0.88, F.when(other("canonical"), F.col("canonical"))), signal("moved", 0.85, said),
        )
    )
    return facts.withColumn("_f", F.when(F.size(found) > 0, F.array_max(found))).where("_f is not null").select(key, "url", "_f.to", "_f.method", "_f.confidence")


def nearby_pages(rows: DataFrame, hints: list[str], key: str = "page_id", top: int = 5, off_host: bool = False) -> DataFrame:
    """Links of the page's own host whose path or anchor has a hint: path hints first, then anchor hints, then by place; `top` of a page."""
    pattern = "|".join(hints)
    by = F.when(path(F.col("url")).rlike(f"(?i)({pattern})"), 0).when(F.col("anchor").rlike(f"(?i)({pattern})"), 1)
    kept = rows.withColumn("by", by).where(F.col("by").isNotNull() & (F.lit(off_host) | (bare_host(F.col("url")) == bare_host(F.col("page_url")))))
    first = kept.withColumn("_d", F.row_number().over(Window.partitionBy(key, url_key(F.col("url"))).orderBy("by", "pos"))).where("_d = 1")
    return first.withColumn("rk", F.row_number().over(Window.partitionBy(key).orderBy("by", "pos"))).where(F.col("rk") <= top).drop("_d")


def labs(rows: DataFrame, words: list[str], key: str = "page_id", least: float = 0.7, top: int = 8) -> DataFrame:
    """Links that lead to laboratories, by the surest of anchor (.9), navigation label (.85), address (.8) and surrounding text (.7)."""
    pattern = rf"(?i)\b({'|'.join(words)})\b"
    sure = F.greatest(F.when(F.col("anchor").rlike(pattern), F.when(F.col("side"), 0.85).otherwise(0.9)).otherwise(0.0), F.when(F.regexp_replace("url", "[-_/.]", " ").rlike(pattern), 0.8).otherwise(0.0), F.when(F.col("context").rlike(pattern), 0.7).otherwise(0.0))
    kept = rows.withColumn("confidence", sure).where(F.col("confidence") >= least)
    best = kept.withColumn("_d", F.row_number().over(Window.partitionBy(key, url_key(F.col("url"))).orderBy(F.desc("confidence"), "pos"))).where("_d = 1").drop("_d")
    return best.withColumn("rk", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("confidence"), "pos"))).where(F.col("rk") <= top)


def penalty(c: Column, guards: list[tuple[str, float]]) -> Column:
    """The penalty of the first guard (pattern, penalty) that a text matches."""
    out = F.lit(0.0)
    for pattern, cost in reversed(guards):
        out = F.when(c.rlike(pattern), cost).otherwise(out)
    return out


def candidate_score(kind: Column, ownership: Column, evidence: Column, bonus: Column, graph: Column, guard: Column, directory: Column) -> Column:
    """Type, ownership, member evidence (up to .35), address bonus (up to .35) and a tenth of the graph's confidence, less the guard and .25
    for a directory, between 0 and 1."""
    raw = kind + ownership + F.least(evidence, F.lit(0.35)) + F.least(bonus, F.lit(0.35)) + 0.1 * graph - guard - F.when(directory, 0.25).otherwise(0.0)
    return F.bround(F.greatest(F.lit(0.0), F.least(F.lit(1.0), raw)), 4)


def candidates(rows: DataFrame, kinds: list[tuple[str, str, float]], guards: list[tuple[str, float]], key: str = "page_id", least: float = 0.3, top: int = 5) -> DataFrame:
    """Scored candidate pages of each page: kinds are (label, pattern over anchor and path, score), in order."""
    said = collapsed(F.concat_ws(" ", "anchor", F.regexp_replace(path(F.col("url")), "[-_/.]", " ")))
    label, base = F.lit(None).cast("string"), F.lit(0.0)
    for name, pattern, points in reversed(kinds):
        label, base = F.when(said.rlike(pattern), name).otherwise(label), F.when(said.rlike(pattern), points).otherwise(base)
    own = F.when(bare_host(F.col("url")) == bare_host(F.col("page_url")), 0.1).otherwise(0.0)
    score = candidate_score(base, own, F.lit(0.0), F.when(F.col("side"), 0.05).otherwise(0.1), F.lit(0.5), penalty(said, guards), F.lit(False))
    kept = distinct_links(rows, key).withColumns({"kind": label, "score": score}).where(F.col("kind").isNotNull() & (F.col("score") >= least))
    w = Window.partitionBy(key).orderBy(F.desc("score"), "pos")
    return kept.withColumn("rk", F.row_number().over(w)).where(F.col("rk") <= top).select(key, "rk", "kind", "anchor", "url", "score")


def classified(text: Column, url: Column, title: Column, types: list[tuple[str, list[tuple[str, float]]]], least: float = 0.4) -> tuple[Column, Column]:
    """(type, score): for each type the sum of its (pattern, points) over text, url and title; the highest, of equals the first; "unknown"
    below `least`."""
    whole = collapsed(F.concat_ws(" ", title, F.regexp_replace(url, "[-_/.?=&]", " "), text))
    scores = [(name, F.least(F.lit(1.0), sum((F.when(whole.rlike(p), x).otherwise(0.0) for p, x in rules), F.lit(0.0)))) for name, rules in types]
    best = F.greatest(*[s for _, s in scores], F.lit(0.0))
    name = F.lit("unknown")
    for label, s in reversed(scores):
        name = F.when((s == best) & (best >= least), label).otherwise(name)
    return name, F.bround(best, 4)


def steps(value: Column, ladder: list[tuple[int, float]]) -> Column:
    """The points of the first step (at least so many) that a value reaches; steps go down."""
    out = F.lit(0.0)
    for least, points in reversed(ladder):
        out = F.when(value >= least, points).otherwise(out)
    return out


def department_scope(url_points: Column, title_points: Column, entries: Column, faculty: Column, profiles: Column, group_url: Column) -> tuple[Column, Column]:
    """(is a department's page, confidence): points of the url and the title, of more than 100, 50 or 30 entries, of 20, 10 or 5 faculty
    roles, of 30 or 15 profiles; halved where a group's address has at most 25 entries and two faculty roles.  It is one from .55 with
    points of the url or title, else from .75."""
    total = url_points + title_points + steps(entries, [(101, 0.35), (51, 0.2), (31, 0.1)]) + steps(faculty, [(20, 0.3), (10, 0.2), (5, 0.1)]) + steps(profiles, [(30, 0.15), (15, 0.1)])
    total = F.when((entries <= 25) & (faculty <= 2) & group_url, total * 0.5).otherwise(total)
    sure = F.bround(F.least(F.lit(1.0), total), 3)
    return (sure >= 0.55) & ((url_points > 0) | (title_points > 0) | (sure >= 0.75)), sure


def member_cap(department: Column, confidence: Column, found: Column) -> Column:
    """How many members of a page are kept: 20 or 30 of a department's, at most 60 of others; null for no cap."""
    return F.when(department & (confidence >= 0.7), 20).when(department & (confidence >= 0.4), 30).when(department, 20).when(found > 60, 60)


def person_score(name: Column, in_section: Column, section: Column, role: Column, own_url: Column, url: Column, email: Column, rejected: Column) -> Column:
    """Name .25 (.1 for a loose one), member section .25, role .2 (.1 for a hint), own address .25 (.08 for any, .15 at least with an
    e-mail), and .05 for a named section.  0 for a rejected row, one that is no name, one outside a member section, and one with neither own
    address, e-mail nor role.  name, role: 0 none, 1 loose, 2 full."""
    by_url = F.greatest(F.when(own_url, 0.25).when(url, 0.08).otherwise(0.0), F.when(email, 0.15).otherwise(0.0))
    total = F.when(name == 2, 0.25).otherwise(0.1) + F.lit(0.25) + F.when(role == 2, 0.2).when(role == 1, 0.1).otherwise(0.0) + by_url + F.when(section, 0.05).otherwise(0.0)
    out = rejected | (name == 0) | ~in_section | ~(own_url | email | (role > 0))
    return F.when(out, 0.0).otherwise(F.bround(F.least(total, F.lit(1.0)), 4))


def extraction_confidence(valid: Column, url: Column, role: Column, hint: Column, name: Column) -> Column:
    """.6 of validity, .2 for a url, .15 for a role, .05 for a hint and .05 for a name."""
    return F.bround(F.least(F.lit(1.0), 0.6 * valid + F.when(url, 0.2).otherwise(0.0) + F.when(role, 0.15).otherwise(0.0) + F.when(hint, 0.05).otherwise(0.0) + F.when(name, 0.05).otherwise(0.0)), 4)


def talent_confidence(confidence: Column, identities: Column, role: Column) -> Column:
    return F.bround(F.least(F.lit(1.0), confidence + F.least(F.lit(0.3), 0.08 * identities) + F.when(role, 0.1).otherwise(0.0)), 4)


def identity_state(exported: Column, invalid: Column, homepage: Column, accepted: Column, external: Column, affiliated: Column, placed: Column) -> tuple[Column, Column]:
    """(state, confidence): VERIFIED (1) for what was exported, whatever else holds; INVALID (0) for no person's name, alumni, professors,
    administrators and rows outside member sections; RESOLVABLE with a homepage and acceptance (.85) or with an identity elsewhere or a
    strong affiliation (.75); PARTIAL (.55) with a section, hint or role; else INVALID."""
    strong, known = homepage & accepted, external | affiliated
    state = F.when(exported, "VERIFIED").when(invalid, "INVALID").when(strong | known, "RESOLVABLE").when(placed, "PARTIAL").otherwise("INVALID")
    return state, F.when(exported, 1.0).when(invalid, 0.0).when(strong, 0.85).when(known, 0.75).when(placed, 0.55).otherwise(0.0)


def identity_kind(url: Column) -> Column:
    """What an address identifies: github (a profile: one part of path), scholar, linkedin, orcid, dblp, twitter or homepage."""
    h, p = bare_host(url), F.regexp_replace(path(url), "^/+|/+$", "")
    return F.when(h.isNull(), None).when(h == "github.com", F.when(p.rlike("^[^/]+$"), "github").otherwise("repository")).when(h.rlike("^scholar[.]google[.]"), "scholar").when(h.rlike("(^|[.])linkedin[.]com$"), "linkedin").when(h == "orcid.org", "orcid").when(h.rlike("^dblp[.]"), "dblp").when(h.isin("twitter.com", "x.com"), "twitter").otherwise("homepage")
