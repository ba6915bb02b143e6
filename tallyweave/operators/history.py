"""Append-only histories: the latest valid value of each key, next revisions, appends, and a spending ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_valid(entries: DataFrame, value: str = "value") -> DataFrame:
    """key, revision, value: of each key's valid entry with the highest revision."""
    best = entries.where("valid").groupBy("key").agg(F.max_by(F.struct("revision", value), "revision").alias("best"))
    return best.select("key", "best.revision", f"best.{value}")


def next_revisions(entries: DataFrame) -> DataFrame:
    """key, next_revision: one above the highest revision, valid or not."""
    return entries.groupBy("key").agg((F.max("revision") + 1).alias("next_revision"))


def changed_entries(found: DataFrame, entries: DataFrame, value: str = "value") -> DataFrame:
    """Entries to append: found (key, value) that differ from the latest valid value, with their new revisions."""
    now = latest_valid(entries, value).select("key", F.col(value).alias("_now"))
    new = found.join(now, "key", "left").where(~F.col(value).eqNullSafe(F.col("_now")) | F.col("_now").isNull())
    return new.join(next_revisions(entries), "key", "left").select("key", F.coalesce("next_revision", F.lit(1)).alias("revision"), value)


def append_entries(entries: DataFrame, new: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(entries to append, conflicts): equal re-appends are dropped; an existing (key, revision) with another value conflicts."""
    held = entries.select("key", "revision", F.col(value).alias("_held"), F.lit(True).alias("_there"))
    met = new.join(held, ["key", "revision"], "left")
    fresh = met.where("_there is null").drop("_held", "_there")
    return fresh, met.where(F.col("_there") & ~F.col(value).eqNullSafe(F.col("_held"))).drop("_held", "_there")


def append_ledger(ledger: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(entries to append, refused): an entry_id has one entry of each kind, so one that is there, or comes twice, is refused."""
    keys = ["entry_id", "kind"]
    once = new.groupBy(*keys).count().where("count = 1").select(*keys)
    fresh = new.join(once, keys, "left_semi").join(ledger.select(*keys).distinct(), keys, "left_anti")
    refused = new.select(*keys).distinct().join(fresh.select(*keys), keys, "left_anti")
    return fresh, refused


def remembered_headers(found: DataFrame, entries: DataFrame) -> DataFrame:
    """Header mappings to append to a history: only verified ones (no problem) that begin below their headers and differ from the latest value.

    found: key, value, problem, header_rows, data_start. entries: key, revision, valid, value.
    """
    sound = found.where(F.col("problem").isNull() & (F.col("data_start") > F.coalesce(F.array_max("header_rows"), F.lit(0))))
    return changed_entries(sound.select("key", "value"), entries)


def committed(ledger: DataFrame) -> DataFrame:
    """One row `committed`: prior usage, settlements, and reservations without a settlement; null without prior usage.

    ledger: entry_id, kind (prior_usage, reservation, settlement), amount.
    """
    settled = ledger.where("kind = 'settlement'").select("entry_id").distinct()
    open_ = ledger.where("kind = 'reservation'").join(settled, "entry_id", "left_anti")
    spent = ledger.where("kind in ('prior_usage', 'settlement')").select("kind", "amount").union(open_.select("kind", "amount"))
    return spent.agg(F.when(F.count_if(F.col("kind") == "prior_usage") > 0, F.sum("amount")).alias("committed"))


def reusable(requests: DataFrame, previous: DataFrame, retry_failed: bool) -> DataFrame:
    """requests (lookup_key) with the previous decision where it may be reused: successes, and failures unless they are retried."""
    held = previous.where("status = 'success'") if retry_failed else previous
    return requests.join(held.withColumn("reused", F.lit(True)), "lookup_key", "left").withColumn("reused", F.coalesce("reused", F.lit(False)))


def part_problems(parts: DataFrame) -> DataFrame:
    """Names whose numbered parts (name, part) have gaps or repeats."""
    found = parts.groupBy("name").agg(F.count("*").alias("n"), F.count_distinct("part").alias("distinct"), F.min("part").alias("low"), F.max("part").alias("high"))
    return found.where("n <> distinct or low <> 1 or high <> n").select("name")


def in_order(entries: DataFrame) -> DataFrame:
    return entries.orderBy("key", "revision")


def last_rows(rows: DataFrame, keys: list[str], count: int, order: list[str]) -> DataFrame:
    """The last `count` rows of each key."""
    turn = F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order]))
    return rows.withColumn("_turn", turn).where(F.col("_turn") <= count).drop("_turn")
