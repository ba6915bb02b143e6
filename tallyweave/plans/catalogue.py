"""All queries outside the optional subpackage, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyweave.plans import details, ledgers, measures, places


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return ledgers.QUERIES | places.QUERIES | measures.QUERIES | details.QUERIES


def oracle_sql() -> dict[str, str]:
    return ledgers.SQL | places.SQL | measures.SQL | details.SQL
