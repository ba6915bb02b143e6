"""Reviews by people, held against what they speak of."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stale_source_reviews(reviews: DataFrame, reports: DataFrame) -> DataFrame:
    """Reviews of sources that are not unresolved now: reviewed sources must be, or the review no longer applies.

    reviews: source. reports: source, status.
    """
    return reviews.join(reports.where("status = 'unresolved'").select("source").distinct(), "source", "left_anti")


def scoped_reviews(reviews: DataFrame, records: DataFrame, scope: list[str]) -> DataFrame:
    """Reviews whose whole scope is that of a record of this run; nulls in a scope are equal."""
    known = records.select(*[F.col(c).alias(f"_{c}") for c in scope]).distinct()
    on = F.lit(True)
    for c in scope:
        on = on & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return reviews.join(known, on, "left_semi")
