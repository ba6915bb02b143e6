"""Measurements: attempts and their verdicts, frame statistics, event pairing, containment and attribution of long tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.functions.amounts import half_up
from tallyweave.operators.scans import paired, rows_before, upper_medians
from tallyweave.tables import spare_names

# Milliseconds of a frame, of a stutter, of a freeze, and of a long task.
FRAME_MS, STUTTER_MS, FREEZE_MS, LONG_MS = 16.67, 33.3, 100.0, 50.0
LONG_TASK = r"(?i)^(?:LongTask|RunTask|Task)$"
# End of fixed values.


def judge_attempts(attempts: DataFrame, target: float, required: int) -> DataFrame:
    """scenario, n, second, slowest, verdict. attempts: scenario, duration (null or not finite: not measured).

    The second-slowest decides: unmeasured below the required number, else pass up to the target, else fail. Only the two
    greatest of each scenario are kept while counting.
    """
    good = attempts.where(F.col("duration").isNotNull() & ~F.isnan("duration") & (F.abs("duration") != float("inf")))
    top = F.row_number().over(Window.partitionBy("scenario").orderBy(F.desc("duration")))
    two = good.withColumn("_turn", top).where("_turn <= 2").groupBy("scenario").agg(F.max("duration").alias("slowest"), F.min(F.when(F.col("_turn") == 2, F.col("duration"))).alias("second"))
    rows = good.groupBy("scenario").agg(F.count("*").alias("n")).join(two, "scenario")
    verdict = F.when(F.col("n") < required, "unmeasured").when(F.coalesce("second", "slowest") <= target, "pass").otherwise("fail")
    return rows.select("scenario", "n", F.coalesce("second", "slowest").alias("second"), "slowest", verdict.alias("verdict"))


def frame_intervals(frames: DataFrame) -> DataFrame:
    """trace, ts, gap: milliseconds since the trace's frame before. frames: trace, ts (ms)."""
    return rows_before(frames, ["trace"], ["ts"], "ts", "_before").withColumn("gap", F.col("ts") - F.col("_before")).where("gap is not null").drop("_before")


def dropped_frames(gap: Column) -> Column:
    return F.greatest(F.lit(0), half_up(gap / FRAME_MS) - 1)


def upper_median(values: DataFrame, keys: list[str], column: str) -> DataFrame:
    """keys, median: the value at place floor(n / 2) of the sorted values."""
    return upper_medians(values, keys, column)


def frame_stats(intervals: DataFrame) -> DataFrame:
    """trace, n, median (upper), longest, dropped. intervals: trace, gap."""
    sums = intervals.groupBy("trace").agg(F.count("*").alias("n"), F.max("gap").alias("longest"), F.sum(dropped_frames(F.col("gap"))).cast("long").alias("dropped"))
    return sums.join(upper_median(intervals, ["trace"], "gap"), "trace").select("trace", "n", "median", "longest", "dropped")


def is_long_task(name: Column) -> Column:
    """Whether an event's name is that of a task of the main thread."""
    return F.coalesce(name.rlike(LONG_TASK), F.lit(False))


def pair_events(events: DataFrame, keys: list[str]) -> DataFrame:
    """keys, began, ended: each end with the last open begin of its key; unmatched ends are ignored, unmatched begins dropped.

    events: keys, phase (`b` or `e`), ts, seq.
    """
    rows = events.where(F.col("phase").isin("b", "e")).select(*keys, "ts", "seq", F.when(F.col("phase") == "b", 1).otherwise(-1).alias("_step"))
    return paired(rows, keys, ["ts", "seq"], "_step", "ts")


#: Leaves that the longest interval is cut into where bounds are no whole numbers; whole numbers are leaves themselves.
LEAVES = 1 << 32
_WHOLE = ("tinyint", "smallint", "int", "bigint")


def _shifted(value: Column, level: Column) -> Column:
    return F.call_function("shiftright", value, level)


def dyadic_nodes(low: Column, high: Column) -> Column:
    """Array of (level, node): the fewest nodes of a binary tree over whole numbers that cover those from low to high, each once.

    Node n of level k covers the 2^k numbers from n * 2^k on. An interval has at most two nodes of a level, and none of a
    level above the logarithm of its length.
    """
    size = high - low + 1

    def of_level(k: Column) -> Column:
        # nodes of the level that lie whole within the interval: from first to behind; those whose parent does not are taken
        first = -_shifted(-low, k)
        behind = _shifted(high + 1, k)
        node = lambda n, taken: F.when(taken & (first < behind), F.struct(k.alias("level"), n.alias("node")))
        return F.array(node(first, first.bitwiseAND(1) == 1), node(behind - 1, behind.bitwiseAND(1) == 1))

    levels = F.sequence(F.lit(0), F.length(F.bin(size)) - 1)
    return F.when(size > 0, F.filter(F.flatten(F.transform(levels, of_level)), lambda x: x.isNotNull()))


def contained(children: DataFrame, parents: DataFrame, keys: list[str]) -> DataFrame:
    """Child-parent pairs of a key where the parent's interval contains the child's (both have start and stop, and an id).

    Starts do not lie behind stops; rows with a null bound have no pairs. A parent stands at the nodes of a binary tree that
    cover its interval, a child looks at all nodes above its start: an equi-join in which a pair meets once. Both sides make
    at most a row or two for each level, whatever the intervals' lengths.
    """
    names = ["parent", "parent_start", "parent_stop"]
    low_leaf, high_leaf, level, node, at = spare_names([*children.columns, *names, *[f"_{k}" for k in keys]], "_low", "_high", "_level", "_node", "_at")
    whole = all(t in _WHOLE for df in (children, parents) for c, t in df.dtypes if c in ("start", "stop"))
    length = F.col("stop") - F.col("start")
    finite = F.coalesce(length.cast("double") < float("inf"), F.lit(False))
    longest, endless = parents.agg(F.max(F.when(finite, length)), F.max(~finite & length.isNotNull())).first()
    unit = float(longest or 0) / LEAVES or 1.0
    broken = lambda c: F.floor(F.greatest(F.lit(-(2.0**61)), F.least(F.lit(2.0**61), F.col(c).cast("double") / unit)))
    leaf = lambda c: F.col(c).cast("long") if whole else F.when(F.col(c).isNotNull(), broken(c))
    p = parents.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("id").alias("parent"), F.col("start").alias("parent_start"), F.col("stop").alias("parent_stop"))
    p = p.withColumn(at, F.explode(dyadic_nodes(leaf("parent_start"), leaf("parent_stop")))).select("*", F.col(f"{at}.level").alias(level), F.col(f"{at}.node").alias(node)).drop(at)
    top = 63 if endless else (int(longest or 0) if whole else LEAVES).bit_length()
    c = children.withColumn(low_leaf, leaf("start")).withColumn(high_leaf, F.explode(F.sequence(F.lit(0), F.lit(top))))
    on = (F.col(high_leaf) == F.col(level)) & (_shifted(F.col(low_leaf), F.col(high_leaf)) == F.col(node)) & (F.col("start") >= F.col("parent_start")) & (F.col("stop") <= F.col("parent_stop"))
    for k in keys:
        on = on & (F.col(k) == F.col(f"_{k}"))
    return c.join(p, on).select(*children.columns, *names)


def not_contained(children: DataFrame, parents: DataFrame, keys: list[str]) -> DataFrame:
    """Children that no parent contains."""
    return children.join(contained(children, parents, keys).select("id").distinct(), "id", "left_anti")


def between_markers(events: DataFrame, markers: DataFrame, keys: list[str]) -> DataFrame:
    """Events from a key's first marker time to its last; all events of a key without both.

    markers: keys, low, high (null if missing).
    """
    rows = events.join(markers, keys, "left")
    return rows.where(F.col("low").isNull() | F.col("high").isNull() | F.col("ts").between(F.col("low"), F.col("high"))).select(*events.columns)


def source_attribution(tasks: DataFrame, least: float = LONG_MS) -> tuple[DataFrame, DataFrame]:
    """(trace, origin, n, total, longest), (trace, dominant): by origin the tasks of at least so many ms; `mixed` if the largest total is tied."""
    sums = tasks.where(F.col("duration") >= least).groupBy("trace", "origin").agg(F.count("*").alias("n"), F.sum("duration").alias("total"), F.max("duration").alias("longest"))
    most = sums.groupBy("trace").agg(F.max("total").alias("most"))
    top = sums.join(most, "trace").where("total = most").groupBy("trace").agg(F.count("*").alias("ties"), F.min("origin").alias("origin"))
    return sums, top.select("trace", F.when(F.col("ties") > 1, "mixed").otherwise(F.col("origin")).alias("dominant"))


def nested_origin(pairs: DataFrame) -> DataFrame:
    """parent, origin: the most frequent origin of the children of a parent; of equals that of the first child.

    pairs: parent, origin, start.
    """
    counts = pairs.groupBy("parent", "origin").agg(F.count("*").alias("n"), F.min("start").alias("first"))
    return counts.groupBy("parent").agg(F.min_by("origin", F.struct(-F.col("n"), F.col("first"))).alias("origin"))


def origin_of_url(url: Column, own_host: str) -> Column:
    """`own` for this host, the host for others, `unknown` without one."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)", 1))
    return F.when(F.coalesce(host, F.lit("")) == "", "unknown").when(host == own_host, "own").otherwise(host)


def judge_runs(runs: DataFrame, required: int) -> DataFrame:
    """gesture, runs, stutter_runs, freeze_runs, verdict: pass only without stutters and freezes. runs: gesture, longest (ms)."""
    out = runs.groupBy("gesture").agg(F.count("*").alias("runs"), F.count_if(F.col("longest") >= STUTTER_MS).alias("stutter_runs"), F.count_if(F.col("longest") >= FREEZE_MS).alias("freeze_runs"))
    verdict = F.when(F.col("runs") < required, "unmeasured").when((F.col("stutter_runs") == 0) & (F.col("freeze_runs") == 0), "pass").otherwise("fail")
    return out.withColumn("verdict", verdict)


def merge_blocks(blocks: DataFrame, keys: list[str], same: list[str], value: str, order: str) -> DataFrame:
    """keys, values joined by commas in order, agree: whether the columns `same` are equal in all blocks of a key."""
    agree = [F.count_distinct(c) <= 1 for c in same]
    both = agree[0] if agree else F.lit(True)
    for a in agree[1:]:
        both = both & a
    values = F.transform(F.array_sort(F.collect_list(F.struct(order, value))), lambda x: x[value].cast("string"))
    return blocks.groupBy(*keys).agg(F.array_join(values, ",").alias("values"), both.alias("agree"))


def busy_percent(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row busy_percent: 100 less the idle share of what counters (core, idle, total) gained."""
    met = after.alias("y").join(before.alias("x"), "core")
    gained = lambda c: F.sum(F.col(f"y.{c}") - F.col(f"x.{c}")).cast("double")
    idle, total = gained("idle"), gained("total")
    return met.agg(F.when(total > 0, 100.0 * (1 - idle / total)).alias("busy_percent"))


def presented_frames(events: DataFrame) -> DataFrame:
    """trace, ts: distinct frame times of each trace's preferred kind; of the fallback kind where it has none. events: trace, ts, kind."""
    has = events.where("kind = 'presented'").select("trace").distinct().withColumn("_has", F.lit(True))
    rows = events.where("kind in ('presented', 'drawn')").join(has, "trace", "left")
    return rows.where((F.col("kind") == "presented") | F.col("_has").isNull()).select("trace", "ts").distinct()


def summarize_traces(frames: DataFrame, tasks: DataFrame) -> DataFrame:
    """trace, longest gap, stutters, freezes, outer long tasks: tasks inside another long task are not counted twice."""
    gaps = frame_intervals(frames).groupBy("trace").agg(F.max("gap").alias("longest"), F.count_if(F.col("gap") >= STUTTER_MS).alias("stutters"), F.count_if(F.col("gap") >= FREEZE_MS).alias("freezes"))
    long_ = tasks.where(F.col("stop") - F.col("start") >= LONG_MS)
    pairs = contained(long_, long_, ["trace"]).where(F.col("id") != F.col("parent")).where("not (start = parent_start and stop = parent_stop and id < parent)")
    outer = long_.join(pairs.select("id").distinct(), "id", "left_anti").groupBy("trace").agg(F.count("*").alias("long_tasks"))
    return gaps.join(outer, "trace", "left").withColumn("long_tasks", F.coalesce("long_tasks", F.lit(0)))
