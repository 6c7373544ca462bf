"""Rosters and link graphs: roles, address predicates, sources in priority, footprints and navigation figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.text import bare_host, collapsed, path, url_key

#: Hosts and endings of addresses that lead to no page of a person or group.
SOCIAL = ("facebook.com", "twitter.com", "x.com", "instagram.com", "youtube.com", "linkedin.com")
DOCUMENTS = ("pdf", "doc", "docx", "ppt", "pptx", "zip", "gz", "ps")


def any_of(c: Column, words: tuple[str, ...] | list[str]) -> Column:
    """Whether a text contains any of the words, in any case."""
    low = F.lower(F.coalesce(c, F.lit("")))
    out = F.lit(False)
    for w in words:
        out = out | low.contains(w)
    return out


def ignorable(url: Column) -> Column:
    """Links that are never followed: mail, scripts, telephones, fragments, social hosts and documents."""
    u, h = F.lower(F.trim(F.coalesce(url, F.lit("")))), F.coalesce(bare_host(url), F.lit(""))
    social = F.lit(False)
    for s in SOCIAL:
        social = social | (h == s) | h.endswith("." + s)
    return (u == "") | u.rlike("^(#|mailto:|javascript:|tel:)") | social | path(u).rlike(rf"[.]({'|'.join(DOCUMENTS)})$")


def plausible_move(url: Column, own: Column) -> Column:
    """Whether a link may lead to where a page has moved: it can be followed and isn't the page itself."""
    return ~ignorable(url) & bare_host(url).isNotNull() & ~url_key(url).eqNullSafe(url_key(own))


def page_kind(url: Column) -> Column:
    """What an address looks like: personal (a tilde or a people's path), group, faculty, department or unknown."""
    p = F.lower(path(url))
    return (
        F.when(p.contains("~") | p.rlike("/(people|person|profile|user|users|home)/[^/]+/?$"), "personal").when(p.rlike("(^|[/_-])(lab|labs|group|groups|team)([/_-]|$)"), "group")
        .when(p.rlike("(^|/)(faculty|staff)(/|$)"), "faculty").when(p.rlike("(^|/)(dept|department|departments|school)(/|$)"), "department").otherwise("unknown")
    )


def role_of(text: Column, rules: list[tuple[str, tuple[str, ...]]], other: str = "unknown") -> Column:
    """The first role of which a word stands in the text."""
    out = F.lit(other)
    for role, words in reversed(rules):
        out = F.when(any_of(text, words), role).otherwise(out)
    return out


def surrounded(text: Column, word: str, hint: str, reach: int = 120) -> Column:
    """Whether a pattern stands within `reach` characters on either side of the first place of a word; false if the word isn't there."""
    at = F.locate(word, text)
    begin = F.greatest(at - reach, F.lit(1))
    window = F.substr(text, begin, at + len(word) + reach - begin)
    return F.coalesce((at > 0) & window.rlike(hint), F.lit(False))


def foreign_title(title: Column, target: Column, other_words: tuple[str, ...]) -> Column:
    """Whether a title looks like another person's name: 2 to 4 capitalised words of letters, at most 60 characters, none of
    `other_words`, and no word of more than two letters in common with the target's name."""
    words = F.filter(F.split(F.trim(title), "[ \t]+"), lambda w: w != "")
    named = (F.length(title) <= 60) & F.size(words).between(2, 4) & F.forall(words, lambda w: w.rlike("^[A-Z][A-Za-z]*$")) & ~any_of(title, other_words)
    long = lambda c: F.filter(F.split(collapsed(c), " "), lambda w: F.length(w) > 2)
    return F.coalesce(named & ~F.arrays_overlap(long(title), long(target)), F.lit(False))


def united(sources: list[DataFrame], key: list[str], url: str = "url") -> DataFrame:
    """Rows of several sources, in order of priority: of rows of one key and one canonical address the first source's stays.  Sources have
    the same columns; `src_ord` says which it was.  Ties within a source go to the address that is first in order."""
    every = None
    for i, s in enumerate(sources):
        rows = s.withColumn("src_ord", F.lit(i))
        every = rows if every is None else every.unionByName(rows)
    w = Window.partitionBy(*key, F.coalesce(url_key(F.col(url)), F.col(url))).orderBy("src_ord", url)
    return every.withColumn("_rk", F.row_number().over(w)).where("_rk = 1").drop("_rk")


def alias_match(venue: Column, aliases: list[tuple[str, list[str]]]) -> Column:
    """The canonical venue: an equal name or alias first; else, in order, an alias of up to four characters that is the whole text or a
    longer one that contains the text or is contained in it; null where none fits."""
    said = collapsed(venue)
    exact, loose = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, others in reversed(aliases):
        low = [x.lower() for x in [name, *others]]
        exact = F.when(said.isin(*low), name).otherwise(exact)
        fits = F.lit(False)
        for x in low:
            fits = fits | ((said == x) if len(x) <= 4 else (said.contains(x) | ((F.length(said) > 4) & F.lit(x).contains(said))))
        loose = F.when(fits, name).otherwise(loose)
    return F.coalesce(exact, loose)


def alias_enriched(rows: DataFrame, extra: DataFrame, name: str, names: str, value: str) -> DataFrame:
    """`rows` with `value` of the entry of `extra` one of whose names equals theirs in lower case; of several the least value."""
    each = extra.select(F.explode(names).alias("_n"), F.col(value)).where("_n is not null").groupBy(collapsed(F.col("_n")).alias("_k")).agg(F.min(value).alias(value))
    return rows.withColumn("_q", collapsed(F.col(name))).join(each, F.col("_q") == F.col("_k"), "left").drop("_q", "_k")


def member_links(members: DataFrame, links: DataFrame, key: str) -> DataFrame:
    """Members (key, name, profile) with the address of a link of their page: the one whose anchor is their name, else the one that is their
    profile; of several the first in order."""
    by_name = links.groupBy(key, collapsed(F.col("anchor")).alias("_a")).agg(F.min("url").alias("by_name"))
    by_url = links.where(url_key(F.col("url")).isNotNull()).groupBy(key, url_key(F.col("url")).alias("_u")).agg(F.min("url").alias("by_url"))
    m = members.withColumns({"_n": collapsed(F.col("name")), "_p": url_key(F.col("profile"))})
    out = m.join(by_name.withColumnRenamed("_a", "_n"), [key, "_n"], "left").join(by_url.withColumnRenamed("_u", "_p"), [key, "_p"], "left")
    return out.withColumn("link", F.coalesce("by_name", "by_url")).drop("_n", "_p", "by_name", "by_url")


def verified(candidates: DataFrame, exported: DataFrame, reasons: DataFrame, name: str) -> DataFrame:
    """Candidates with `state` VERIFIED where their name, in lower case, was exported, else as it was; and why they were rejected."""
    e = exported.select(collapsed(F.col(name)).alias("_e")).distinct()
    r = reasons.groupBy(collapsed(F.col(name)).alias("_r")).agg(F.min("reason").alias("reason"))
    out = candidates.withColumn("_n", collapsed(F.col(name))).join(e, F.col("_n") == F.col("_e"), "left").join(r, F.col("_n") == F.col("_r"), "left")
    return out.withColumn("state", F.when(F.col("_e").isNotNull(), "VERIFIED").otherwise(F.col("state"))).drop("_n", "_e", "_r")


def others_only(rows: DataFrame, name: str, target: str) -> DataFrame:
    """Rows but those whose name is the target's own, in any case."""
    return rows.where(~collapsed(F.col(name)).eqNullSafe(collapsed(F.col(target))))


def journey(*steps: Column) -> Column:
    """The addresses of a way, without nulls and without one that repeats the one before."""
    every = F.array_compact(F.array(*steps))
    return F.filter(every, lambda x, i: (i == 0) | (x != F.get(every, i - 1)))


def edge_label(anchor: Column, url: Column) -> Column:
    return F.when(F.trim(anchor) != "", F.concat(F.lit("anchor:"), F.trim(anchor))).otherwise(F.concat(F.lit("url:"), url))


def frequencies(rows: DataFrame, value: Column, n: int | None = None, name: str = "value") -> DataFrame:
    """How often each value occurs, most first, then by name; the first `n` of them if it is given (a top-n report)."""
    out = rows.select(value.alias(name)).where(F.col(name).isNotNull()).groupBy(name).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), name)
    return out if n is None else out.limit(n)


def spread(value: Column, places: int = 1) -> list[Column]:
    """count, mean, least and most of a value that is there."""
    return [F.count(value).alias("count"), F.bround(F.avg(value), places).alias("mean"), F.min(value).alias("least"), F.max(value).alias("most")]


def metric_deltas(old: DataFrame, new: DataFrame, key: str, metrics: list[str]) -> DataFrame:
    """(key, metric, old, new, delta): the figures of two runs side by side, the difference with its sign; a run without the key counts 0."""
    stack = ", ".join(f"'{m}', {m}" for m in metrics)
    long = lambda d: d.select(key, F.expr(f"stack({len(metrics)}, {stack}) as (metric, v)"))
    both = long(old).withColumnRenamed("v", "old").join(long(new).withColumnRenamed("v", "new"), [key, "metric"], "full_outer").fillna(0, ["old", "new"])
    diff = F.col("new") - F.col("old")
    return both.withColumn("delta", F.concat(F.when(diff >= 0, "+").otherwise("-"), F.abs(diff).cast("string")))
