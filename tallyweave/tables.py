"""Tables in the folder that driver and executors share: they cut lineage, and survive lost executors."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_PREFIX = "tallyweave-"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: `spark.checkpoint.dir`, or the context's checkpoint directory.

    Where neither is set, a local session gets a temporary folder as its checkpoint directory; a cluster, whose machines
    could not see that, is refused.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    held = spark.sparkContext._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get()
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    folder = tempfile.mkdtemp(prefix=_PREFIX)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{_PREFIX}{spark.sparkContext.applicationId}"


def _delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def fresh_path(spark: SparkSession) -> str:
    """A path of this application's own in the shared folder, not used before."""
    return f"{_own_folder(spark)}/{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, path: str | None = None) -> DataFrame:
    """`df` as Parquet in the shared folder: survives lost executors and is computed once."""
    spark = df.sparkSession
    path = path or fresh_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Successive:
    """A table that is written again and again, each from the one before, which is then deleted."""

    def __init__(self) -> None:
        self.path: str | None = None

    def __call__(self, df: DataFrame) -> DataFrame:
        spark, old = df.sparkSession, self.path
        self.path = fresh_path(spark)
        out = cut_lineage(df, self.path)
        if old:
            _delete(spark, old)
        return out


def clear_tables(spark: SparkSession) -> None:
    """Deletes all tables that this application has written by cut_lineage; for when its results are stored."""
    _delete(spark, _own_folder(spark))


def quoted(name: str):
    return F.col("`" + name.replace("`", "``") + "`")


def spare_names(columns: list[str], *wanted: str) -> list[str]:
    """Names like those wanted that no column has (whatever its case) and that differ from one another."""
    taken, out = {c.lower() for c in columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def numbered(df: DataFrame, order: list, name: str) -> DataFrame:
    """`df` with column `name`: each row's number, from 1, in the order given.

    Rows are dealt into ranges of the order, which are written once: were the plan run twice, sampled bounds could
    differ. Each range counts from the sum of the ranges before it, so no task numbers all rows.
    """
    from pyspark.sql import Window

    part, base = spare_names([*df.columns, name], "_part", "_base")
    dealt = in_ranges(df, order, part)
    sizes = dealt.groupBy(part).agg(F.count("*").alias("n"))  # one row for each range
    before = sizes.select(part, (F.sum("n").over(Window.orderBy(part)) - F.col("n")).alias(base))
    at = F.row_number().over(Window.partitionBy(part).orderBy(*order))
    return dealt.withColumn(name, at).join(F.broadcast(before), part).withColumn(name, F.col(name) + F.col(base)).drop(part, base)


def in_ranges(df: DataFrame, order: list, part: str) -> DataFrame:
    """`df` with column `part`: its range of the order, from 0. The ranges are written, so all uses see the same ones."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut_lineage(df.repartitionByRange(parts, *order).withColumn(part, F.spark_partition_id()))


#: A key is hot if it has more than one in HOT_SHARE of all rows, and more than HOT_ROWS.
HOT_SHARE, HOT_ROWS = 1000, 100_000


def with_facts(rows: DataFrame, facts: DataFrame, key: str, n: str) -> DataFrame:
    """`rows` with the columns of `facts`, one row for each key (null among them), of which column `n` counts the rows.

    There are fewer than HOT_SHARE hot keys, so their facts are broadcast, and no task gets all rows of one. All other rows
    are dealt by their key. Rows without facts go. Where a key is hot both inputs are read twice, so they should be cheap
    to compute, as written tables are.
    """
    held, ours = spare_names([*rows.columns, *facts.columns], "_key", "_own")
    total, most = facts.agg(F.sum(n), F.max(n)).first()
    asked = facts.withColumnRenamed(key, held)
    same = F.col(held).eqNullSafe(F.col(ours))
    mine = rows.withColumn(ours, quoted(key))
    bound = max((total or 0) // HOT_SHARE, HOT_ROWS)
    if (most or 0) <= bound:
        return mine.join(asked, same).drop(held, ours)
    hot = asked.where(F.col(n) > bound)
    first = mine.join(F.broadcast(hot), same)
    rest = mine.join(F.broadcast(hot.select(held)), same, "left_anti").join(asked.where(F.col(n) <= bound), same)
    return first.unionByName(rest).drop(held, ours)
