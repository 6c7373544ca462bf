"""Readers of bibliography dumps: XML publication and person records, the repair of their entities, and a Parquet landing."""

from __future__ import annotations

import gzip
import re
from collections.abc import Iterable, Iterator
from html.entities import html5
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PAPER = (
    "_key string, author array<struct<_VALUE:string,_pid:string>>, title string, booktitle string, journal string, year string, pages string, ee array<string>, url string"
)
PERSON = "_key string, author array<string>, note array<struct<_VALUE:string,_type:string>>, url array<string>"

#: The longest entity that is looked at; a longer run after & is no entity.
ENTITY = 128
_KEPT = frozenset(("amp", "lt", "gt", "quot", "apos"))
_PARTS = re.compile(r"&(?:(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);)?|(<[^<>]*>)|>")


def _repaired(m: re.Match[str]) -> str:
    if m[2]:
        return m[2]
    if m[0] == ">":
        return "&gt;"
    name = m[1]
    if name is None:
        return "&amp;"
    if name.startswith("#") or name in _KEPT:
        return m[0]
    plain = html5.get(f"{name};")
    return plain.replace("&", "&amp;").replace("<", "&lt;") if plain else f"&amp;{name};"


def repaired(chunks: Iterable[str]) -> Iterator[str]:
    """Text in which every entity is one that XML knows: named HTML entities become characters, a bare & or > is escaped.  Chunks may be
    cut anywhere; an unfinished tag or entity is carried over, a stray one let go after ENTITY characters."""
    tail = ""
    for chunk in chunks:
        text = tail + chunk
        cut = len(text)
        amp, tag = text.rfind("&"), text.rfind("<")
        if amp >= 0 and ";" not in text[amp:] and len(text) - amp <= ENTITY:
            cut = amp
        if tag >= 0 and ">" not in text[tag:] and len(text) - tag <= 32 * ENTITY:
            cut = min(cut, tag)
        yield _PARTS.sub(_repaired, text[:cut])
        tail = text[cut:]
    if tail:
        yield _PARTS.sub(_repaired, tail)


def repair_file(source: str, target: str, chunk: int = 1 << 20) -> str:
    """A repaired copy of a (gzipped) file, made once: an existing target is left as it is."""
    if not Path(target).exists():
        opened = gzip.open(source, "rt", encoding="utf-8") if source.endswith(".gz") else open(source, encoding="utf-8")  # noqa: SIM115
        with opened as lines, open(f"{target}.part", "w", encoding="utf-8") as out:
            out.writelines(repaired(iter(lambda: lines.read(chunk), "")))
        Path(f"{target}.part").rename(target)
    return target


def papers(spark: SparkSession, path: str, row: str = "inproceedings", partitions: int | None = None) -> DataFrame:
    """(dblp_key, title, authors, venue, year, pages, ee_url, dblp_url) of each publication; rows without a venue or a year are dropped.
    A gzipped file is read by one task, so give `partitions` to spread what follows."""
    raw = spark.read.format("xml").option("rowTag", row).schema(PAPER).load(path)
    out = raw.select(
        F.col("_key").alias("dblp_key"), F.trim(F.regexp_extract(F.coalesce("title", F.lit("")), "^[^<]*", 0)).alias("title"),
        F.transform(F.coalesce("author", F.array().cast("array<struct<_VALUE:string,_pid:string>>")), lambda a: F.struct(a["_pid"].alias("pid"), F.trim(a["_VALUE"]).alias("name"))).alias("authors"),
        F.trim(F.coalesce("booktitle", "journal")).alias("venue"), F.expr("try_cast(trim(year) as int)").alias("year"), F.coalesce("pages", F.lit("")).alias("pages"), F.get("ee", F.lit(0)).alias("ee_url"), F.col("url").alias("dblp_url"),
    ).where("venue <> '' and year is not null")
    return out.repartition(partitions) if partitions else out


def people(spark: SparkSession, path: str, denied: list[str], prefix: str = "homepages/", row: str = "www") -> DataFrame:
    """(key, name, aliases, homepage, orcid, affiliations) of each person: the homepage is the first address whose host isn't denied."""
    raw = spark.read.format("xml").option("rowTag", row).schema(PERSON).load(path).where(F.col("_key").startswith(prefix))
    host = lambda u: F.lower(F.regexp_extract(u, "^[a-zA-Z]+://(?:www[.])?([^/?#:]+)", 1))
    urls, notes = F.coalesce("url", F.array().cast("array<string>")), F.coalesce("note", F.array().cast("array<struct<_VALUE:string,_type:string>>"))
    allowed = F.filter(urls, lambda u: ~host(u).isin(*denied) & (host(u) != "")) if denied else F.filter(urls, lambda u: host(u) != "")
    return raw.select(
        F.col("_key").alias("key"), F.get("author", F.lit(0)).alias("name"), F.coalesce("author", F.array().cast("array<string>")).alias("aliases"), F.get(allowed, F.lit(0)).alias("homepage"),
        F.get(F.filter(urls, lambda u: F.contains(u, F.lit("orcid.org"))), F.lit(0)).alias("orcid"), F.transform(F.filter(notes, lambda n: n["_type"] == "affiliation"), lambda n: n["_VALUE"]).alias("affiliations"),
    )


def targets(records: DataFrame, names: DataFrame) -> DataFrame:
    """The records that a name (a column `name`) matches by any alias, whatever the case, with the first alias that does."""
    each = records.select("*", F.posexplode("aliases").alias("_pos", "_alias")).withColumn("_on", F.lower("_alias"))
    met = each.join(names.select(F.lower("name").alias("_on")).distinct(), "_on", "left_semi")
    return met.groupBy(*records.columns).agg(F.min_by("_alias", "_pos").alias("matched_alias"))


def landed(df: DataFrame, path: str) -> DataFrame:
    """`df` as Parquet at `path`, written once."""
    df.write.mode("ignore").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def resource(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSON resource (gazetteer, denylist, taxonomy), one document with an array or a line for each row; missing fields are null."""
    return spark.read.schema(schema).option("multiLine", True).json(path)
