"""HTML extraction by consensus paths of hosts.

Every page is read once into a tree of containers, each with a score: the text of the paragraphs inside it, less that of links, long
paragraphs counting for more.  A
container's path is its chain of tags with their classes, generalised (digits become #, classes are sorted, ids dropped).  The pages of
a host vote on paths in Spark, each with the share of its score that a path has; the path with most votes wins.  Every page is then
read again and the containers at its host's winning path give the text.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import checkpointed, sized, tidy

#: Characters at which a paragraph counts half of its length (shorter ones count less, longer ones more), the part of a paragraph's score
#: for the container above its own, and steps that are written out in a path; of deeper ones it has a digest.
HALF = 25
ABOVE = 0.5
DEEP = 64

RESULT = "page_id long, host string, path string, consensus boolean, text string"

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset(("script", "style", "textarea", "title", "noscript", "template", "svg", "iframe"))
_CONTAINERS = frozenset("html body div main article section td center form li dd blockquote".split())
_BLOCKS = frozenset("p pre h1 h2 h3 h4 h5 h6 ul ol dl dt dd li table tr td th blockquote div main article section figure figcaption header footer nav aside form body html address hr".split())
_DROPPED = frozenset("nav footer aside form button select head".split())
_CLOSES_P = _BLOCKS - {"li", "dt", "dd", "tr", "td", "th", "body", "html"}
_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*>?|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>?", re.S)
_CLASS = re.compile(r"""\bclass\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HOST = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)")
_GAPS = re.compile(r"\s+")


def host_of(url: str | None) -> str | None:
    m = _HOST.match(url.strip()) if url else None
    return m[1].lower() if m else None


class Node:
    __slots__ = ("above", "depth", "dropped", "key", "kids", "linked", "named", "score", "step", "tag", "top", "up")

    def __init__(self, tag: str, step: str, above: Node | None, dropped: bool, linked: bool) -> None:
        self.tag, self.step, self.above, self.dropped, self.linked = tag, step, above, dropped, linked
        self.kids: list[Node | str] = []
        self.score = 0.0
        self.named: str | None = None
        self.depth = above.depth + 1 if above else 0
        #: The nearest container above, and the ancestor (or self) whose path is written out.
        self.up: Node | None = (above if above.tag in _CONTAINERS else above.up) if above else None
        self.top: Node = above.top if above and self.depth > DEEP else self
        self.key = hashlib.blake2b(above.key + step.encode(), digest_size=8).digest() if above and self.depth > DEEP else b""

    @property
    def path(self) -> str:
        """The chain of steps; it is put together only where it is asked for, since it is long where a page is deep."""
        if self.named is None:
            if self.depth > DEEP:
                self.named = f"{self.top.path}/~{self.depth}.{self.key.hex()}"
            else:
                self.named = f"{self.above.path}/{self.step}" if self.above else ""
        return self.named


def _step(tag: str, attributes: str) -> str:
    m = _CLASS.search(attributes) if attributes else None
    names = sorted({re.sub(r"\d+", "#", c) for c in (m[1] or m[2] or m[3] or "").split()}) if m else []
    return ".".join([tag, *names])


def tree(page: str) -> Node:
    """The elements of a page.  Elements that miss their end tags are closed where HTML implies it, or with what they are in."""
    root = node = Node("", "", None, False, False)
    at, n = 0, len(page)
    open_tags: Counter[str] = Counter()

    def leave(last: Node) -> None:
        """Closes all up to `last`."""
        nonlocal node
        while node is not last.above:
            open_tags[node.tag] -= 1
            node = node.above

    def text(raw: str) -> None:
        if raw and not raw.isspace():
            node.kids.append(raw)

    while at < n:
        m = _TOKEN.search(page, at)
        if not m:
            text(page[at:])
            break
        if m.start() > at:
            text(page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if open_tags[tag]:
                x = node
                while x.tag != tag:
                    x = x.above
                leave(x)
            continue
        if tag in _RAW:
            end = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, at)
            at = end.end() if end else n
            continue
        if tag in _CLOSES_P and open_tags["p"]:
            x = node
            while x is not root and x.tag not in _CONTAINERS and x.tag != "p":
                x = x.above
            if x.tag == "p":
                leave(x)
        elif tag in ("li", "dt", "dd", "tr", "td", "th") and node.tag == tag:
            leave(node)
        if tag in _VOID:
            if tag in ("br", "hr"):
                node.kids.append("\n" if tag == "hr" else " ")
            continue
        new = Node(tag, _step(tag, m[3]), node, node.dropped or tag in _DROPPED, node.linked or tag == "a")
        node.kids.append(new)
        if not m[3].endswith("/"):
            node = new
            open_tags[tag] += 1
    return root


def _size(raw: str) -> int:
    return len(_GAPS.sub(" ", raw).strip())


def scored(root: Node) -> list[Node]:
    """The containers that have a score, in the order of the page."""
    out: list[Node] = []
    stack: list[tuple[Node, Node | None]] = [(root, None)]
    while stack:
        node, holder = stack.pop()
        if node.dropped:
            continue
        own = node if node.tag in _CONTAINERS else holder
        if node.tag in _CONTAINERS:
            out.append(node)
        plain, linked = 0, 0
        inner: list[Node] = []
        block = node.tag in _BLOCKS
        if block:
            flat: list[Node] = [node]
            while flat:
                x = flat.pop()
                for kid in x.kids:
                    if isinstance(kid, str):
                        if x.linked:
                            linked += _size(kid)
                        else:
                            plain += _size(kid)
                    elif kid.tag in _BLOCKS:
                        inner.append(kid)
                    elif not kid.dropped:
                        flat.append(kid)
            stack += [(k, own) for k in reversed(inner)]
            target = holder if node.tag in ("p", "pre", "td", "blockquote", "li", "dd") and holder is not None else own
            if target is not None and plain > linked:
                gain = (plain - linked) * (plain - linked) / (plain - linked + HALF)
                target.score += gain
                if target.up is not None:
                    target.up.score += ABOVE * gain
        else:
            stack += [(k, own) for k in reversed(node.kids) if isinstance(k, Node)]
    return [x for x in out if x.score > 0]


def body(nodes: list[Node]) -> str:
    """The text of containers: a line for each block, without navigation."""
    lines: list[str] = []
    line: list[str] = []

    def close() -> None:
        said = _GAPS.sub(" ", html.unescape("".join(line))).strip()
        if said:
            lines.append(said)
        line.clear()

    chosen = set(nodes)
    stack: list[Node | str | None] = list(reversed(nodes))
    while stack:
        x = stack.pop()
        if x is None:
            close()
        elif isinstance(x, str):
            line.append(x)
        elif not (x.dropped and x not in chosen):
            block = x.tag in _BLOCKS or x.tag == ""
            if block:
                close()
                stack.append(None)
            stack += reversed(x.kids)
    close()
    return "\n".join(lines)


def best(containers: list[Node]) -> Node | None:
    return max(containers, key=lambda x: x.score, default=None)


def extract(page: str, path: str | None) -> tuple[str | None, bool, str]:
    """The path that was used, whether it is the one given, and the text."""
    root = tree(page)
    found: list[Node] = []
    if path is not None:
        stack = [root]
        while stack:
            x = stack.pop()
            if x.path == path:
                found.append(x)
            elif x.depth > DEEP or path.startswith(x.path):
                stack += [k for k in reversed(x.kids) if isinstance(k, Node)]
    text = body(found) if found else ""
    if text:
        return path, True, text
    own = best(scored(root))
    return (own.path, False, body([own])) if own else (None, False, body([root]))


def _voter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hosts, paths, shares = [], [], []
        for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            by: dict[str, float] = {}
            for x in scored(tree(page)):
                by[x.path] = by.get(x.path, 0.0) + x.score
            total = sum(by.values())
            for path, score in by.items():
                hosts.append(host), paths.append(path), shares.append(round(1e6 * score / total))
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(shares, pa.int64())], ["host", "path", "share"])


def _extractor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [(None, None, None) if page is None else extract(page, path) for page, path in zip(batch.column("html").to_pylist(), batch.column("path").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("host"), pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.bool_()), pa.array([x[2] for x in out], pa.string())], ["page_id", "host", "path", "consensus", "text"]
        )


def _hosted(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract(F.trim("url"), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.when(host != "", host).alias("host"), "html")


def winners(pages: DataFrame) -> DataFrame:
    """host and path: the path with most votes of each host; of equals the longer one, then the one of the greatest hash."""
    votes = _hosted(pages).where("host is not null and html is not null").select("host", "html").mapInArrow(tidy(_voter), "host string, path string, share long")
    counted = votes.groupBy("host", "path").agg(F.sum("share").alias("votes"))
    order = F.struct(F.col("votes"), F.length("path").alias("deep"), F.xxhash64("path").alias("tie"))
    return counted.groupBy("host").agg(F.max_by("path", order).alias("path"))


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, host, path, consensus and text for every row of `pages`.

    consensus says that the text comes from the host's winning path.  A page where that path is missing or has no text, or whose url is
    null or has no host, uses the best container of its own; one without any scored container gives the text of the whole page with a
    null path.  A null html has a null text, an empty one an empty text.  Rows that repeat, and null ids, give a row each and vote each.
    Pages may have any length and depth.  Other columns are ignored.
    """
    won = checkpointed(winners(pages).withColumnRenamed("host", "_host"))
    longest = won.agg(F.max(F.octet_length("_host") + F.octet_length("path"))).first()[0] or 0
    rows = _hosted(pages)
    return rows.join(sized(won, longest + 64), F.col("host") == F.col("_host"), "left").select("page_id", "host", "html", "path").mapInArrow(tidy(_extractor), RESULT)


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`extracted` for all pages."""
    return extracted(spark.read.parquet(f"{sf_dir}/pages.parquet"))
