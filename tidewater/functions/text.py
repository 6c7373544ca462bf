"""Scalar functions as column expressions: names, affiliations, venues, urls and pages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANK = "[ \t\r\n]+"


def collapsed(c: Column) -> Column:
    """Lower case with single spaces."""
    return F.trim(F.regexp_replace(F.lower(c), BLANK, " "))


def without_disambiguator(c: Column) -> Column:
    """A name without the four digits that tell namesakes apart."""
    return F.regexp_replace(c, "[ \t\r\n]+[0-9]{4}$", "")


def affiliation_key(c: Column) -> Column:
    """An affiliation in lower case without full stops and commas."""
    return F.trim(F.regexp_replace(F.translate(F.lower(c), ".,", ""), BLANK, " "))


def name_key(c: Column, dropped: tuple[str, ...] = ("jr", "sr", "ii", "iii", "iv", "phd", "md", "msc", "bsc", "dr", "prof")) -> Column:
    """A name in lower case without degrees and suffixes."""
    words = F.filter(F.split(F.translate(collapsed(c), ".,", ""), " "), lambda w: ~w.isin(*dropped) & (w != ""))
    return F.array_join(words, " ")


def fetchable(url: Column) -> Column:
    """A url with https:// before it where it has no scheme; null for an empty one."""
    u = F.trim(url)
    return F.when(u == "", None).when(F.lower(u).rlike("^https?://"), u).otherwise(F.concat(F.lit("https://"), u))


def host(url: Column) -> Column:
    """The host without its port, in lower case."""
    found = F.lower(F.regexp_extract(url, "^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(found != "", found)


def bare_host(url: Column) -> Column:
    return F.regexp_replace(host(url), r"^www\.", "")


def path(url: Column) -> Column:
    return F.regexp_extract(url, "^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def url_key(url: Column) -> Column:
    """A url's canonical key: host and path in lower case, no fragment, single slashes, no index page nor last slash, the query kept."""
    query = F.regexp_extract(url, "^[^?#]*([?][^#]*)", 1)
    p = F.regexp_replace(F.lower(path(url)), "/+", "/")
    p = F.regexp_replace(F.regexp_replace(p, "/(index|default|home)[.](html?|php|aspx?)$", "/"), "/$", "")
    return F.when(host(url).isNotNull(), F.concat(F.lower(F.regexp_extract(url, "^([a-zA-Z][a-zA-Z0-9+.-]*)://", 1)), F.lit("://"), host(url), p, query))


def digest_id(c: Column, size: int = 16) -> Column:
    return F.substring(F.sha2(c, 256), 1, size)


def title(html: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_extract(html, "(?is)<title[^>]*>(.*?)</title>", 1), BLANK, " "))


def visible(html: Column) -> Column:
    """A page's text by patterns: without scripts, styles, comments and tags, in lower case with single spaces."""
    bare = F.regexp_replace(html, "(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->", " ")
    return collapsed(F.regexp_replace(bare, "(?s)<[^>]*>", " "))


def person_like(c: Column) -> Column:
    """Whether a text looks like the name of a person: 4 to 50 characters, 2 to 5 capitalised words, no digits, not all capitals."""
    return F.length(c).between(4, 50) & ~c.rlike("[0-9]") & (F.upper(c) != c) & c.rlike(r"^\p{Lu}[\p{L}'.-]*([ ]\p{Lu}[\p{L}'.-]*){1,4}$")


def first_rule(c: Column, rules: list[tuple[str, str]], default: str | None = None) -> Column:
    """The label of the first rule (label, pattern) that a text matches."""
    out = F.lit(None).cast("string") if default is None else F.lit(default)
    for label, pattern in reversed(rules):
        out = F.when(c.rlike(pattern), F.lit(label)).otherwise(out)
    return out


def banded(c: Column, bounds: list[tuple[str, int]], rest: str) -> Column:
    """The label of the first bound (label, largest value) that a number does not exceed."""
    out = F.lit(rest)
    for label, top in reversed(bounds):
        out = F.when(c <= top, F.lit(label)).otherwise(out)
    return out


def rate(part: Column, whole: Column, digits: int = 4) -> Column:
    """part / whole, 0 where whole is 0."""
    return F.round(part.cast("double") / F.greatest(whole, F.lit(1)).cast("double"), digits)
