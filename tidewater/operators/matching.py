"""Joins and matching: aliases, gazetteers, denylists, cohorts, tokens and names."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.text import affiliation_key, collapsed
from tidewater.storage import blocks


def rewritten(rows: DataFrame, column: str, aliases: dict[str, str]) -> DataFrame:
    """`column` with its aliases replaced by canonical values; the aliases are a literal of the plan."""
    table = F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair])
    return rows.withColumn(column, F.coalesce(table[F.col(column)], F.col(column)))


def gazetteer_match(rows: DataFrame, gazetteer: DataFrame, key: str, raw: str) -> DataFrame:
    """(key, raw, canonical, country, confidence) by tiers: a comma segment equals a canonical name (1.0), an alias (.85), a name of five
    letters or more stands anywhere in the text (.6), nothing does (0).  The gazetteer is (canonical, aliases, country, ord).  Within a tier
    the first segment wins, then the first entry."""
    text = rows.select(F.col(key), F.col(raw), affiliation_key(F.col(raw)).alias("_full"))
    segments = text.select(key, F.posexplode(F.array_union(F.array(affiliation_key(F.col(raw))), F.transform(F.split(F.coalesce(raw, F.lit("")), ","), affiliation_key))).alias("_pos", "_segment")).where("_segment <> ''")
    names = gazetteer.select("canonical", "country", "ord", affiliation_key(F.col("canonical")).alias("_name"), F.lit(0).alias("_alias"))
    others = gazetteer.select("canonical", "country", "ord", F.explode("aliases").alias("_a")).select("canonical", "country", "ord", affiliation_key(F.col("_a")).alias("_name"), F.lit(1).alias("_alias"))
    every = names.unionByName(others).where("_name <> ''")
    equal = segments.join(every, F.col("_segment") == F.col("_name")).select(key, "canonical", "country", F.struct(F.col("_alias").alias("tier"), F.col("_pos").alias("pos"), "ord").alias("_o"), F.when(F.col("_alias") == 0, 1.0).otherwise(0.85).alias("confidence"))
    within = [text.join(some, F.col("_full").contains(F.col("_name"))) for some in blocks(every.where(F.length("_name") >= 5), 512)]
    inside = reduce(DataFrame.unionByName, within).select(key, "canonical", "country", F.struct((F.col("_alias") + 2).alias("tier"), F.lit(0).alias("pos"), "ord").alias("_o"), F.lit(0.6).alias("confidence"))
    won = equal.unionByName(inside).groupBy(key).agg(F.min_by(F.struct("canonical", "country", "confidence"), "_o").alias("_m"))
    return text.drop("_full").join(won, key, "left").select(key, raw, F.col("_m.canonical").alias("canonical"), F.col("_m.country").alias("country"), F.coalesce("_m.confidence", F.lit(0.0)).alias("confidence"))


def first_allowed(rows: DataFrame, denied: DataFrame, key: str, host: str, position: str, value: str) -> DataFrame:
    """The first value of each key whose host isn't denied."""
    kept = rows.join(denied, host, "left_anti")
    return kept.groupBy(key).agg(F.min_by(value, position).alias(value))


def enriched(rows: DataFrame, extra: DataFrame, key: Column, fields: dict[str, Column]) -> DataFrame:
    """`rows` with fields filled, where empty, from the matching row of `extra`, and whether one matched.  `extra` has a column _key."""
    joined = rows.withColumn("_k", key).join(extra, F.col("_k") == F.col("_key"), "left")
    return joined.withColumns({name: F.coalesce(F.col(name), value) for name, value in fields.items()} | {"matched": F.col("_key").isNotNull()}).drop("_k", "_key")


def compared(old: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """Both runs side by side: old and new values, delta and status (added, removed, improved, regressed, unchanged)."""
    both = old.select(key, F.col(value).alias("old")).join(new.select(key, F.col(value).alias("new")), key, "full_outer")
    delta = F.coalesce("new", F.lit(0)) - F.coalesce("old", F.lit(0))
    status = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").when(delta > 0, "improved").when(delta < 0, "regressed").otherwise("unchanged")
    return both.withColumns({"delta": delta, "status": status})


def tokens(c: Column) -> Column:
    return F.array_distinct(F.filter(F.split(collapsed(c), " "), lambda w: w != ""))


def subset_pairs(rows: DataFrame, key: str, name: str, block: str | None = None) -> DataFrame:
    """Pairs of names of which one's tokens, two or more, all occur in the other.  They are found over the shorter name's rarest token (of
    equals the first in order), so that a token which many names have brings few together."""
    t = rows.select(F.col(key), F.col(name), tokens(F.col(name)).alias("_t"), *([F.col(block)] if block else [])).where(F.size("_t") >= 2)
    often = t.select(F.explode("_t").alias("_on")).groupBy("_on").agg(F.count(F.lit(1)).alias("_n"))
    each = t.select(F.col(key).alias("key_a"), F.col(name).alias("name_a"), F.col("_t").alias("_a"), F.explode("_t").alias("_on"), *([F.col(block)] if block else [])).join(often, "_on")
    mine = ["key_a", "name_a", "_a", *([block] if block else [])]
    a = each.groupBy(*mine).agg(F.min_by("_on", F.struct("_n", "_on")).alias("_on"))
    b = t.select(F.col(key).alias("key_b"), F.col(name).alias("name_b"), F.col("_t").alias("_b"), F.explode("_t").alias("_on"), *([F.col(block)] if block else []))
    met = a.join(b, ["_on", block] if block else ["_on"])
    return met.where((F.col("key_a") != F.col("key_b")) & (F.size(F.array_except("_a", "_b")) == 0)).select("key_a", "name_a", "key_b", "name_b")


def _same(a: set[str], b: set[str]) -> bool:
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    return a == b or (len(small) >= 2 and small <= large)


def greedy_merge(rows: DataFrame, block: str, name: str, position: str) -> DataFrame:
    """(block, leader, n, names): names of a block merged in order, each into the first group whose leader has the same tokens or, with two
    or more, tokens that include them or that they include.  The order decides, so a block goes to one task, as a group of its own."""

    def run(table: pd.DataFrame) -> pd.DataFrame:
        groups: list[tuple[str, set[str], list[str]]] = []
        for text in table.sort_values([position, name])[name]:
            own = set((text or "").lower().split())
            for group in groups:
                if _same(own, group[1]):
                    group[2].append(text)
                    break
            else:
                groups.append((text, own, [text]))
        return pd.DataFrame({block: [table[block].iloc[0]] * len(groups), "leader": [g[0] for g in groups], "n": [len(g[2]) for g in groups], "names": [g[2] for g in groups]})

    kind = rows.schema[block].dataType.simpleString()
    return rows.select(block, name, position).groupBy(block).applyInPandas(run, f"{block} {kind}, leader string, n long, names array<string>")


def best_record(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the order of precedence."""
    return rows.withColumn("_rk", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rk = 1").drop("_rk")
