"""Every query of the library by name, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewater.plans import pages, ranking, reports, rosters


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return ranking.QUERIES | reports.QUERIES | pages.QUERIES | rosters.QUERIES


def oracle_sql() -> dict[str, str]:
    return ranking.SQL | reports.SQL | pages.SQL | rosters.SQL
