"""Helpers that the operators of this package share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.tables import Successive, cut_lineage, quoted, shared_folder, spare_names, with_facts

__all__ = ["Successive", "cut_lineage", "quoted", "shared_folder", "spare_names", "with_facts"]

#: What `bytes.split()` splits at: space and the control characters 9 to 13.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def columns_without(df: DataFrame, *names: str) -> list[Column]:
    """The columns of `df`, whatever their names, less those that an operator is about to add (case-insensitive)."""
    taken = {n.lower() for n in names}
    return [quoted(c) for c in df.columns if c.lower() not in taken]


def without(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*columns_without(df, *names))


def crc_mod(column: str, n: int) -> Column:
    """crc32 of a value's text, modulo n; a null value counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % n


_worker_held: dict = {}


def worker_cache(key: object, make: Callable[[], object]) -> object:
    """A cache of this Python worker, for all tasks that it runs with the same key. One is held at a time, to bound memory."""
    if key not in _worker_held:
        _worker_held.clear()
        _worker_held[key] = make()
    return _worker_held[key]
