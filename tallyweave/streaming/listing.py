"""Incremental collection: a stream of listing rows into an append-only ledger.

Rows of a listing arrive as files of a directory, or as pages of boards whose offsets are pages. Of a post's rows in a batch the
first by page and position counts; posts that were collected before are known by keyed state, so a batch costs what is new
and not what the ledger holds. Each batch is written under its number, so a batch that runs again overwrites itself.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

LISTING = "post_id STRING, page INT, position INT, title STRING, posted DATE, has_file BOOLEAN"


def visited_posts(collected: DataFrame, gone: DataFrame) -> DataFrame:
    """post_id of all posts that need no visit: those collected, and those whose files are gone."""
    return collected.select("post_id").union(gone.select("post_id")).distinct()


def new_posts(batch: DataFrame, known: DataFrame) -> DataFrame:
    """The first row of each post that is not known; then only those with a file."""
    columns = [c for c in batch.columns if c != "post_id"]
    first = batch.groupBy("post_id").agg(F.min_by(F.struct(*columns), F.struct("page", "position")).alias("row")).select("post_id", "row.*")
    return first.join(known.select("post_id").distinct(), "post_id", "left_anti").where("has_file")


def _first_of_post(columns: list[str]) -> Callable[[tuple, Iterator[pd.DataFrame], GroupState], Iterator[pd.DataFrame]]:
    """A post's rows of a batch -> its first row by page and position, if that has a file and the post was not given out before."""

    def chosen(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        first = None
        for part in parts:
            least = part.sort_values(["page", "position"], kind="stable").head(1)
            if first is None or tuple(least.iloc[0][["page", "position"]]) < tuple(first.iloc[0][["page", "position"]]):
                first = least
        if first is not None and not state.exists and bool(first.iloc[0]["has_file"]):
            state.update((True,))
            yield first[columns]

    return chosen


def new_posts_of_stream(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of a stream that `new_posts` would choose in each batch: posts given out are known by their state, a flag for each
    key in the stream's checkpoint, and the ledger is not read.
    """
    chosen = _first_of_post(rows.columns)
    return rows.groupBy(*keys).applyInPandasWithState(chosen, rows.schema, "seen boolean", "append", GroupStateTimeout.NoTimeout)


def _into_ledger(found: DataFrame, ledger: str, checkpoint: str) -> StreamingQuery:
    """Each batch is written under its number, so one that runs again after a failure overwrites itself."""

    def append(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{ledger}/batch={number}")

    return found.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def collect_listing(spark: SparkSession, listing: str, ledger: str, checkpoint: str) -> StreamingQuery:
    """Runs over all files there are now, and ends. ledger: a folder of Parquet, partitioned by batch."""
    rows = spark.readStream.schema(LISTING).json(listing)
    return _into_ledger(new_posts_of_stream(rows, ["post_id"]), ledger, checkpoint)


def collect_boards(spark: SparkSession, options: dict[str, str], post: Callable[[DataFrame], DataFrame], ledger: str, checkpoint: str) -> StreamingQuery:
    """Reads the pages of boards that are new or have changed since the last run, and ends. options: as of the source `board`.

    post: rows of pages (organization, board, page, position, cells) -> the same less `cells`, with post_id, title, posted and has_file.
    """
    from tallyweave.sources.boards import BoardSource

    spark.dataSource.register(BoardSource)
    rows = post(spark.readStream.format("board").options(**options).load())
    return _into_ledger(new_posts_of_stream(rows, ["organization", "board", "post_id"]), ledger, checkpoint)


def event_windows(events: DataFrame, late: str = "10 minutes", size: str = "1 hour") -> DataFrame:
    """Counts and sums by event type and window; works on streams (with a watermark) and on tables alike."""
    # a watermark needs an instant
    rows = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late) if events.isStreaming else events
    out = rows.groupBy(F.window("ts", size), "event_type").agg(F.count("*").alias("events"), F.sum("value").alias("total"))
    return out.select(F.col("window.start").alias("start"), "event_type", "events", "total")
