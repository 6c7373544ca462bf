"""Operators over ordered rows: runs, rolling context, carried headings, first and last picks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def runs(rows: DataFrame, group: str, order: list[str], value: str) -> DataFrame:
    """Islands of equal neighbouring values: (group, run, value, n, first and last position)."""
    w = Window.partitionBy(group).orderBy(*order)
    marked = rows.withColumn("_new", F.when(F.lag(value).over(w).eqNullSafe(F.col(value)) & (F.row_number().over(w) > 1), 0).otherwise(1))
    numbered = marked.withColumn("run", F.sum("_new").over(w))
    return numbered.groupBy(group, "run", value).agg(F.count(F.lit(1)).alias("n"), F.min(order[0]).alias("first"), F.max(order[0]).alias("last"))


def rolling(rows: DataFrame, group: str, order: list[str], text: str, size: int = 6) -> DataFrame:
    """How many rows, and characters of text, the last `size` rows up to each hold."""
    w = Window.partitionBy(group).orderBy(*order).rowsBetween(1 - size, 0)
    return rows.withColumns({"in_window": F.count(F.lit(1)).over(w), "window_chars": F.sum(F.length(text)).over(w)})


def carried(rows: DataFrame, group: str, order: list[str], heading: Column, name: str = "section") -> DataFrame:
    """`name`: the last heading (a column that is null elsewhere) at or before each row."""
    return rows.withColumn(name, F.last(heading, ignorenulls=True).over(Window.partitionBy(group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))


def top_per_group(rows: DataFrame, group: list[str], order: list[Column], n: int, name: str = "rk") -> DataFrame:
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col(name) <= n)


def upper_median(value: str) -> Column:
    """The element in the middle of a column or SQL expression, of two the upper one: the first half from above.  A task counts a group's
    distinct values."""
    return F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY {value} DESC)")
