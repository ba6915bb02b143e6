"""Order statistics, neighbours and running sums of keys of any size: no task holds a key's rows.

Rows of a key that is small enough go through a built-in aggregate or window. For larger keys, places are found by
histograms that are refined (counts by bin, then by bin of the bin that holds the place), and running values by a parallel
scan: rows are dealt into ranges of their order, each range is summarised on its own, the few summaries of a key are
put together, and each range is run through again from what came before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.tables import Successive, cut_lineage, in_ranges, quoted, spare_names, with_facts

#: Rows up to which one task may hold a key; bins of a histogram.
KEY_ROWS, BINS = 1_000_000, 1024


def _node(keys: list[str]) -> Column:
    return F.struct(*[quoted(k).alias(f"k{j}") for j, k in enumerate(keys)])


def upper_medians(values: DataFrame, keys: list[str], column: str) -> DataFrame:
    """keys, median: the value at place floor(n / 2) of the sorted values of each key; nulls are left out."""
    rows = values.where(quoted(column).isNotNull())
    most = rows.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    # the upper median is the first of the upper half, counted from above
    median = F.expr(f"percentile_disc(0.5) within group (order by `{column}` desc)").cast(values.schema[column].dataType)
    if most <= KEY_ROWS:
        return rows.groupBy(*keys).agg(median.alias("median"))
    sizes = cut_lineage(rows.groupBy(*keys).agg(F.count("*").alias("_n")))
    (of,) = spare_names([*values.columns, "_n"], "_of")
    keyed = rows.select(*keys, column).withColumn(of, _node(keys))
    small = with_facts(keyed, cut_lineage(sizes.where(F.col("_n") <= KEY_ROWS).select(_node(keys).alias(of), "_n")), of, "_n")
    large = cut_lineage(with_facts(keyed, cut_lineage(sizes.where(F.col("_n") > KEY_ROWS).select(_node(keys).alias(of), "_n")), of, "_n").drop("_n", of))
    placed = at_places(large, keys, column, sizes.where(F.col("_n") > KEY_ROWS).select(*keys, F.floor(F.col("_n") / 2).alias("place")))
    return small.groupBy(*keys).agg(median.alias("median")).unionByName(placed.withColumnRenamed("value", "median"))


def _magnitude(x: Column) -> Column:
    """Ascends with a double, by its sign and logarithm: values of all sizes lie about evenly."""
    return F.when(x > 0, 750 + F.log(x)).when(x < 0, -750 - F.log(-x)).otherwise(0.0)


def at_places(values: DataFrame, keys: list[str], column: str, places: DataFrame) -> DataFrame:
    """keys, value: the value at `place` (from 0) of the sorted values of each key. places: keys, place. values: a written table.

    Each round counts the rows left by bin, in a single pass, and goes on with the rows of the bin that holds the place, between its
    own least and greatest value; bins are of equal width and of equal ratio in turn, so a few rounds do for values of any size.
    """
    kind = values.schema[column].dataType
    value = quoted(column)
    rows = values.select(_node(keys).alias("of"), value.alias("v"))
    first = rows.groupBy("of").agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count("*").alias("n"))
    written = Successive()
    state = written(first.join(places.select(_node(keys).alias("of"), "place"), "of"))
    turn = 0
    while not state.where("low < high").isEmpty():
        low, high, v = (F.col(c).cast("double") for c in ("low", "high", "v"))
        if turn % 2:
            low, high, v = _magnitude(low), _magnitude(high), _magnitude(v)
        share = (v - low) / F.greatest(high - low, F.lit(5e-324))
        inner = 1 + F.least(F.lit(BINS - 3), F.greatest(F.lit(0), F.floor(share * (BINS - 2))))
        bin_ = F.when(F.col("v") == F.col("low"), 0).when(F.col("v") == F.col("high"), BINS - 1).otherwise(inner).alias("bin")
        open_ = state.where("low < high")
        met = with_facts(rows, open_, "of", "n").where("v between low and high")
        counts = met.groupBy("of", bin_, "place").agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        upto = F.sum("n").over(Window.partitionBy("of").orderBy("bin"))  # at most BINS rows a key
        found = counts.withColumn("before", upto - F.col("n")).where("before <= place and place < before + n")
        state = written(state.where("low >= high").unionByName(found.select("of", "low", "high", "n", (F.col("place") - F.col("before")).alias("place"))))
        turn += 1
    return state.select(*[F.col(f"of.k{j}").alias(k) for j, k in enumerate(keys)], F.col("low").cast(kind).alias("value"))


def _largest(rows: DataFrame, keys: list[str]) -> int:
    return rows.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0


def _last_before(dealt: DataFrame, part: str, keys: list[str], order: list[str], what: Column, name: str) -> DataFrame:
    """`dealt` with `name`: `what` of the row before in the order of its keys, whichever range that lies in; null for the first."""
    mine, lasts = spare_names([*dealt.columns, name], "_mine", "_lasts")
    held = dealt.withColumn(mine, what)
    local = F.lag(mine).over(Window.partitionBy(part, *keys).orderBy(*order))
    last = held.groupBy(part, *keys).agg(F.max_by(mine, F.struct(*order)).alias(lasts))  # one row for each range and key
    carried = last.select(part, *keys, F.lag(lasts).over(Window.partitionBy(*keys).orderBy(part)).alias(lasts)).where(F.col(lasts).isNotNull())
    names = spare_names([*held.columns, name, lasts], *[f"_{k}" for k in keys], "_range")
    carried = carried.select(*[F.col(k).alias(n) for k, n in zip([*keys, part], names, strict=True)], lasts)
    on = F.col(part) == F.col(names[-1])
    for k, n in zip(keys, names, strict=False):
        on = on & F.col(k).eqNullSafe(F.col(n))
    return held.withColumn(name, local).join(carried, on, "left").withColumn(name, F.coalesce(name, lasts)).drop(lasts, mine, *names)


def rows_before(rows: DataFrame, keys: list[str], order: list[str], what: str, name: str) -> DataFrame:
    """`rows` with `name`: column `what` of the row before of the same keys; null for a key's first row."""
    if _largest(rows, keys) <= KEY_ROWS:
        return rows.withColumn(name, F.lag(what).over(Window.partitionBy(*keys).orderBy(*order)))
    (part, value) = spare_names([*rows.columns, name], "_part", "_value")
    dealt = in_ranges(rows, [F.col(c) for c in [*keys, *order]], part)
    # a struct, so that a null of the row before is told from no row
    found = _last_before(dealt, part, keys, order, F.struct(F.col(what).alias("x")), value)
    return found.withColumn(name, F.col(f"{value}.x")).drop(part, value)


def paired(rows: DataFrame, keys: list[str], order: list[str], step: str, ts: str) -> DataFrame:
    """keys, began, ended: each end (step -1) with the last open begin (step +1) of its key; unmatched ones are left out.

    The number of open begins is the running sum of the steps less its least value so far; a begin and the end that closes it are
    neighbours among the rows of their key and level. A range is summarised by its sum and its least running sum; sums of the ranges
    before, and the last row of each level before, are carried into a range.
    """
    part, base, least, sum_, low, level, before = spare_names([*rows.columns, "began", "ended"], "_part", "_base", "_least", "_sum", "_low", "_level", "_before")
    whole = _largest(rows, keys) <= KEY_ROWS
    dealt = rows.withColumn(part, F.lit(0)) if whole else in_ranges(rows, [F.col(c) for c in [*keys, *order]], part)
    at = Window.partitionBy(*([] if whole else [part]), *keys).orderBy(*order)
    upto = at.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = dealt.withColumn(sum_, F.sum(step).over(upto)).withColumn(low, F.least(F.lit(0), F.min(sum_).over(upto)))
    if not whole:
        ends = run.groupBy(part, *keys).agg(F.sum(step).alias("_s"), F.min(low).alias("_m"))  # one row for each range and key
        ranges = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
        ends = ends.withColumn(base, F.coalesce(F.sum("_s").over(ranges), F.lit(0)))
        ends = ends.withColumn(least, F.least(F.lit(0), F.min(F.col(base) + F.col("_m")).over(ranges)))
        names = spare_names([*run.columns, base, least], *[f"_{k}" for k in keys], "_range")
        ends = ends.select(*[F.col(k).alias(n) for k, n in zip([*keys, part], names, strict=True)], base, F.coalesce(least, F.lit(0)).alias(least))
        on = F.col(part) == F.col(names[-1])
        for k, n in zip(keys, names, strict=False):
            on = on & F.col(k).eqNullSafe(F.col(n))
        run = run.join(ends, on).drop(*names)
        run = run.withColumn(low, F.least(least, F.col(base) + F.col(low))).withColumn(sum_, F.col(base) + F.col(sum_))
    # a begin's level is the number open after it, an end's that before it; an end that nothing is open for adds to the low
    opened = F.col(sum_) - F.col(low)
    was_low = F.col(sum_) == F.col(low)
    run = run.withColumn(level, F.when(F.col(step) > 0, opened).otherwise(opened + 1))
    alone = (F.col(step) < 0) & was_low & F.col("_fell")
    fell = F.lag(low).over(at)
    if whole:
        run = run.withColumn("_fell", F.col(low) < F.coalesce(fell, F.lit(0)))
    else:
        run = run.withColumn("_fell", F.col(low) < F.coalesce(fell, F.col(least)))
    run = run.where(~alone).select(*keys, *order, *([] if ts in order else [ts]), step, level, part)
    if whole:
        run = run.withColumn(before, F.struct(F.lag(ts).over(Window.partitionBy(*keys, level).orderBy(*order)).alias("x")))
    else:
        run = _last_before(cut_lineage(run), part, [*keys, level], order, F.struct(F.col(ts).alias("x")), before)
    return run.where(F.col(step) < 0).select(*keys, F.col(f"{before}.x").alias("began"), F.col(ts).alias("ended"))
