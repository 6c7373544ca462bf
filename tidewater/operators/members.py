"""Member entries of group pages: sections from headings, and entries of lists, tables, heading cards, paragraphs and definition lists.

One tokenizer turns a page into a flat list of blocks (kind, text, links, section); the layouts are then rules over blocks.  A section is
what the last heading, or a short label before a list, says: current members, former ones, or something else.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.text import collapsed
from tidewater.operators.batches import batched, each

SCHEMA = "page_id long, pos int, name string, text string, url string, email string, role string, section string, status string, layout string"

FORMER = re.compile(r"\b(alumni|alumnae|former|past|previous|graduated|graduates)\b", re.I)
CURRENT = re.compile(r"\b(members?|people|team|students?|postdocs?|postdoctoral|researchers?|staff|faculty|group|interns?|visitors?|phd|master'?s?|undergraduates?)\b", re.I)
OTHER = re.compile(r"\b(publications?|papers|teaching|courses?|news|projects?|software|contact|awards?|funding|links|talks|events|openings|sponsors?)\b", re.I)
ROLE = re.compile(r"\b(ph\.?d\.?(?: student| candidate)?|postdoc(?:toral)?(?: researcher| fellow)?|master'?s? student|undergraduate|research(?:er| scientist| engineer| assistant| associate)|professor|intern|visiting (?:scholar|student|researcher)|staff|student|engineer|alumnus|alumna)\b", re.I)
EMAIL = re.compile(r"[\w.+-]+@[\w-]+\.[\w.-]+")
NAME = re.compile(r"^[^\W\d_][\w'’.-]*(?: [^\W\d_][\w'’.-]*){1,4}$")
PAPER = re.compile(r"\b(proceedings|in proc|journal|arxiv|doi|vol\.|pp\.|et al|conference on)\b|\b(19|20)\d\d\b.*\b(19|20)\d\d\b", re.I)

_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
_BLOCKS = _HEADINGS | frozenset("p li tr dt dd div section article td th ul ol dl table figure figcaption".split())
_SKIP = frozenset(("script", "style", "noscript", "nav", "header", "footer", "aside"))


class _Blocks(HTMLParser):
    def __init__(self, url: str) -> None:
        super().__init__(convert_charrefs=True)
        self.url, self.skip, self.stack = url, 0, []
        self.out: list[dict] = []
        self.text: list[str] = []
        self.links: list[tuple[str, str]] = []
        self.anchor: tuple[str, list[str]] | None = None
        self.bold = 0
        self.plain = 0

    def flush(self) -> None:
        said = " ".join(" ".join(self.text).split())
        if said:
            kind = next((t for t in reversed(self.stack) if t in _BLOCKS), "div")
            self.out.append({"kind": kind, "text": said, "links": list(self.links), "bold": self.plain == 0})
        self.text, self.links, self.plain = [], [], 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in _SKIP:
            self.flush()
            self.skip += 1
        elif not self.skip:
            if tag in _BLOCKS and not (tag in ("td", "th") and "tr" in self.stack):
                self.flush()
                if tag in ("p", "li", "dt", "dd", "tr") and self.stack and self.stack[-1] == tag:
                    self.stack.pop()
                self.stack.append(tag)
            elif tag in ("td", "th"):
                self.text.append(" | " if self.text else "")
            elif tag in ("b", "strong"):
                self.bold += 1
            elif tag == "br":
                self.text.append(" ")
            elif tag == "a":
                self.anchor = (dict(attrs).get("href") or "", [])
            elif tag == "img" and (alt := dict(attrs).get("alt")):
                self.text.append(alt)

    def handle_endtag(self, tag: str) -> None:
        if tag in _SKIP:
            self.skip = max(0, self.skip - 1)
        elif not self.skip:
            if tag in _BLOCKS and tag in self.stack:
                self.flush()
                while self.stack and self.stack.pop() != tag:
                    pass
            elif tag in ("b", "strong"):
                self.bold = max(0, self.bold - 1)
            elif tag == "a" and self.anchor:
                href, said = self.anchor
                self.links.append((" ".join(" ".join(said).split()), urljoin(self.url, href) if href else ""))
                self.anchor = None

    def handle_data(self, data: str) -> None:
        if self.skip or not data.strip():
            return
        self.text.append(data)
        if not self.bold:
            self.plain += 1
        if self.anchor:
            self.anchor[1].append(data)


def section_of(label: str) -> str | None:
    """current, former or other, as a heading says; None where it says nothing."""
    if FORMER.search(label):
        return "former"
    if OTHER.search(label):
        return "other"
    return "current" if CURRENT.search(label) else None


_DEGREE = r"(ph[.]?d[.]?|doctoral|graduate)"
#: What a label says, in order: (pattern over lower case with single spaces, role, status).  Current ones come first, so that "former PhD
#: students" counts as current, as do all labels that name a degree.
SECTION_ROLES = [
    (rf"\b(current ((ph[.]?d[.]?|doctoral|graduate|master) )?students?|{_DEGREE} students?)\b", "phd_student", "current"),
    (r"\bmaster('?s)? students?\b", "master_student", "current"),
    (r"\bpostdoc(toral)?( ?(researcher|fellow|associate|member)s?)?\b", "postdoc", "current"),
    (r"\b(current ((lab|group|research) )?|(lab|group|team) )members?\b", "unknown", "current"),
    (r"\bresearch (staff|team)\b", "research_staff", "current"),
    (r"\bour team\b|^(current )?people ?:? ?$", "unknown", "current"),
    (r"^(current )?students? ?:? ?$", "phd_student", "current"),
    (r"^researchers? ?:? ?$", "unknown", "current"),
    (r"^postdocs? ?:? ?$", "postdoc", "current"),
    (r"^collaborators? ?:? ?$", "unknown", "current"),
    (r"^(former members?|alumni) ?:? ?$", "alumni", "alumni"),
    (r"\b(people|student) directory\b", "unknown", "current"),
    (r"\baffiliated students?\b", "phd_student", "current"),
    (r"\bvisitors?\b", "visitor", "current"),
    (r"^(current )?faculty ?:? ?$", "professor", "current"),
    (r"\bgradu(ated?|al) (ph[.]?d[.]? )?students?\b|\b(past|former) (member|student|postdoc|researcher)s?\b|\balumni?\b|\bprevious (member|student)s?\b", "alumni", "alumni"),
]
#: Labels are short; a longer text is no label.
LABEL = 350


def section_role(label: Column) -> tuple[Column, Column]:
    """(role, status) that a label of a section says; both null where it says nothing or is too long to be one."""
    said = collapsed(label)
    role, status = F.lit(None).cast("string"), F.lit(None).cast("string")
    for pattern, r, s in reversed(SECTION_ROLES):
        role, status = F.when(said.rlike(pattern), r).otherwise(role), F.when(said.rlike(pattern), s).otherwise(status)
    short = F.length(label) <= LABEL
    return F.when(short, role), F.when(short, status)


def looks_like_name(text: str) -> bool:
    return 4 <= len(text) <= 50 and bool(NAME.match(text)) and not text.isupper() and sum(w[:1].isupper() for w in text.split()) >= 2 and not (CURRENT.search(text) or OTHER.search(text) or FORMER.search(text))


def leading_name(block: dict) -> str | None:
    """The name that a block begins with: its first link's text, or what stands before a separator."""
    for anchor, _ in block["links"][:1]:
        if looks_like_name(anchor) and block["text"].startswith(anchor):
            return anchor
    head = re.split(r"\s*(?:\||,|;|\(|:|–|—| - |\s@)\s*", block["text"], maxsplit=1)[0].strip()
    head = re.sub(r"^(?:dr|prof|mr|ms|mrs)\.? ", "", head, flags=re.I)
    return head if looks_like_name(head) else None


def entries(html: str, url: str | None) -> list[dict]:
    """The member entries of a page, each name once: where two layouts find it the first counts."""
    reader = _Blocks(url or "")
    reader.feed(html)
    reader.close()
    reader.flush()
    blocks, found, loose, seen = reader.out, [], {"heading": [], "paragraph": []}, set()
    section, label = None, None

    def entry(block: dict, name: str, layout: str, text: str | None = None) -> dict:
        said = text or block["text"]
        mail, role = EMAIL.search(said), ROLE.search(said)
        link = next((u for a, u in block["links"] if u.startswith("http") and (a == name or a in said)), None)
        return {"name": name, "text": said[:500], "url": link, "email": mail[0] if mail else None, "role": role[0].lower() if role else None, "section": label, "status": section if section in ("current", "former") else None, "layout": layout}

    for i, block in enumerate(blocks):
        kind, text = block["kind"], block["text"]
        name = leading_name(block)
        following = blocks[i + 1] if i + 1 < len(blocks) else None
        if kind in _HEADINGS and not name:
            section, label = section_of(text), text[:120]
        elif kind in ("p", "div") and len(text) <= 60 and not name and following and following["kind"] in ("li", "tr", "dt") and section_of(text):
            section, label = section_of(text), text[:120]
        elif not name or PAPER.search(text):
            continue
        elif kind in _HEADINGS:
            more = following["text"] if following and following["kind"] not in _HEADINGS else ""
            both = {"links": block["links"] + (following["links"] if more else []), "text": f"{text} {more}"}
            (found if section in ("current", "former") else loose["heading"]).append(entry(both, name, "heading"))
        elif kind in ("li", "tr", "dt"):
            if section in ("current", "former"):
                found.append(entry(block, name, {"li": "list", "tr": "table", "dt": "definition"}[kind]))
        elif len(text) <= 250 and ROLE.search(text):
            (found if section in ("current", "former") else loose["paragraph"]).append(entry(block, name, "paragraph"))
    # Without a section, layouts count from three entries, of which most must show a link or a role.
    for own in loose.values():
        if len(own) >= 3 and sum(bool(e["url"] or e["role"]) for e in own) >= 0.6 * len(own):
            found += own
    return [e for e in found if not (e["name"].lower() in seen or seen.add(e["name"].lower()))]


def members(pages: DataFrame) -> DataFrame:
    """A row for each member entry of each page (page_id, url, html); a null page has none."""

    kinds = pa.schema([("page_id", pa.int64()), ("pos", pa.int32()), *((c, pa.string()) for c in ("name", "text", "url", "email", "role", "section", "status", "layout"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return batched(({"page_id": p, "pos": i} | e for p, u, h in each(batches, ["page_id", "url", "html"]) for i, e in enumerate(entries(h, u))), kinds)

    return pages.selectExpr("cast(page_id as long) as page_id", "url", "html").where("html is not null").mapInArrow(run, SCHEMA)


def has_members(pages: DataFrame) -> DataFrame:
    """Pages that list three members or more."""
    return members(pages).groupBy("page_id").count().where("count >= 3").select("page_id")
