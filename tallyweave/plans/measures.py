"""Queries on measurements, over the events table, with the same rows in SQL. A user's events are a trace."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.operators import traces
from tallyweave.plans.ledgers import table
from tallyweave.streaming.listing import event_windows

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


@query("""WITH t AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value DESC) AS p, count(*) OVER (PARTITION BY event_type) AS n FROM events WHERE value IS NOT NULL)
SELECT event_type AS scenario, CAST(max(n) AS BIGINT) AS n, coalesce(max(CASE WHEN p = 2 THEN value END), max(value)) AS second, max(value) AS slowest, CASE WHEN max(n) < 20 THEN 'unmeasured' WHEN coalesce(max(CASE WHEN p = 2 THEN value END), max(value)) <= 150 THEN 'pass' ELSE 'fail' END AS verdict FROM t GROUP BY event_type""")
def second_slowest(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("event_type").alias("scenario"), F.col("value").alias("duration"))
    return traces.judge_attempts(e, 150.0, 20)


# Frames: a user's event times in minutes, as if they were milliseconds.
_FRAMES = "f AS (SELECT user_id AS trace, event_id, CAST(floor(epoch_us(ts) / 60000000) AS BIGINT) AS ts FROM events), g AS (SELECT trace, ts - lag(ts) OVER (PARTITION BY trace ORDER BY ts) AS gap FROM f), i AS (SELECT trace, CAST(gap AS DOUBLE) AS gap FROM g WHERE gap IS NOT NULL)"


def _frames(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("trace"), F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 60_000_000).alias("ts"))


def _intervals(spark, sf_dir) -> DataFrame:
    return traces.frame_intervals(_frames(spark, sf_dir)).select("trace", F.col("gap").cast("double").alias("gap"))


@query(f"WITH {_FRAMES} SELECT trace, gap, CAST(count(*) AS BIGINT) AS n FROM i GROUP BY 1, 2")
def frame_gaps(spark, sf_dir):
    return _intervals(spark, sf_dir).groupBy("trace", "gap").agg(F.count("*").alias("n"))


@query(f"WITH {_FRAMES} SELECT trace, CAST(sum(greatest(0, floor(gap / 16.67e0 + 0.5) - 1)) AS BIGINT) AS dropped FROM i GROUP BY 1")
def dropped_frames(spark, sf_dir):
    return _intervals(spark, sf_dir).groupBy("trace").agg(F.sum(traces.dropped_frames(F.col("gap"))).cast("long").alias("dropped"))


@query(f"WITH {_FRAMES}, p AS (SELECT trace, gap, row_number() OVER (PARTITION BY trace ORDER BY gap) - 1 AS k, count(*) OVER (PARTITION BY trace) AS n FROM i) SELECT trace, CAST(max(n) AS BIGINT) AS n, max(CASE WHEN k = floor(n / 2) THEN gap END) AS median, max(gap) AS longest, CAST(sum(greatest(0, floor(gap / 16.67e0 + 0.5) - 1)) AS BIGINT) AS dropped FROM p GROUP BY 1")
def upper_median(spark, sf_dir):
    return traces.frame_stats(_intervals(spark, sf_dir))


@query("""WITH s AS (SELECT user_id AS trace, event_type AS origin, count(*) AS n, sum(CAST(round(value, 2) AS DECIMAL(18,2))) AS total FROM events WHERE value >= 50 GROUP BY 1, 2), m AS (SELECT trace, max(total) AS most FROM s GROUP BY 1)
SELECT s.trace, CASE WHEN count(*) > 1 THEN 'mixed' ELSE min(origin) END AS dominant FROM s JOIN m ON s.trace = m.trace AND s.total = m.most GROUP BY 1""")
def source_attribution(spark, sf_dir):
    tasks = table(spark, sf_dir, "events").where("value >= 50").select(F.col("user_id").alias("trace"), F.col("event_type").alias("origin"), F.round("value", 2).cast("decimal(18,2)").alias("duration"))
    return traces.source_attribution(tasks)[1]


@query("""WITH e AS (SELECT user_id, ts, event_id, CASE WHEN event_type = 'signup' THEN 1 ELSE -1 END AS step, event_type FROM events WHERE event_type IN ('signup', 'error')),
s AS (SELECT *, CAST(sum(step) OVER w AS BIGINT) AS s FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), o AS (SELECT *, s - least(0, min(s) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS d FROM s),
l AS (SELECT *, CASE WHEN step = 1 THEN d ELSE coalesce(lag(d) OVER (PARTITION BY user_id ORDER BY ts, event_id), 0) END AS level FROM o), p AS (SELECT *, lag(ts) OVER (PARTITION BY user_id, level ORDER BY ts, event_id) AS began FROM l WHERE level > 0)
SELECT user_id, epoch_us(began) AS began, epoch_us(ts) AS ended FROM p WHERE step = -1""")
def pair_begin_end(spark, sf_dir):
    phase = F.when(F.col("event_type") == "signup", "b").when(F.col("event_type") == "error", "e")
    e = table(spark, sf_dir, "events").select("user_id", phase.alias("phase"), F.unix_micros(F.col("ts").cast("timestamp")).alias("ts"), F.col("event_id").alias("seq")).where("phase is not null")
    return traces.pair_events(e, ["user_id"])


# Intervals: an event from its minute on, as long as its value in minutes; purchases are the parents, errors the children.
_SPANS = "x AS (SELECT user_id, event_id AS id, event_type, CAST(floor(epoch_us(ts) / 60000000) AS BIGINT) AS start, CAST(floor(epoch_us(ts) / 60000000) AS BIGINT) + CAST(floor(abs(value)) AS BIGINT) * CASE WHEN event_type = 'purchase' THEN 20 ELSE 1 END AS stop FROM events WHERE value IS NOT NULL)"


def _spans(spark, sf_dir, kind: str) -> DataFrame:
    start = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 60_000_000)
    e = table(spark, sf_dir, "events").where((F.col("event_type") == kind) & F.col("value").isNotNull())
    return e.select("user_id", F.col("event_id").alias("id"), start.alias("start"), (start + F.floor(F.abs("value")) * (20 if kind == "purchase" else 1)).alias("stop"))


@query(f"WITH {_SPANS} SELECT c.id AS child, p.id AS parent FROM x c JOIN x p ON c.user_id = p.user_id AND c.event_type = 'error' AND p.event_type = 'purchase' AND c.start >= p.start AND c.stop <= p.stop")
def nested_intervals(spark, sf_dir):
    return traces.contained(_spans(spark, sf_dir, "error"), _spans(spark, sf_dir, "purchase"), ["user_id"]).select(F.col("id").alias("child"), "parent")


@query(f"WITH {_SPANS} SELECT c.id AS child FROM x c WHERE c.event_type = 'error' AND NOT EXISTS (SELECT 1 FROM x p WHERE c.user_id = p.user_id AND p.event_type = 'purchase' AND c.start >= p.start AND c.stop <= p.stop)")
def outside_intervals(spark, sf_dir):
    return traces.not_contained(_spans(spark, sf_dir, "error"), _spans(spark, sf_dir, "purchase"), ["user_id"]).select(F.col("id").alias("child"))


@query("""WITH m AS (SELECT user_id, min(CASE WHEN event_type = 'signup' THEN ts END) AS low, max(CASE WHEN event_type = 'purchase' THEN ts END) AS high FROM events GROUP BY 1)
SELECT e.event_id FROM events e JOIN m ON e.user_id = m.user_id WHERE m.low IS NULL OR m.high IS NULL OR e.ts BETWEEN m.low AND m.high""")
def marker_window(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    time = lambda kind: F.when(F.col("event_type") == kind, F.col("ts"))
    markers = e.groupBy("user_id").agg(F.min(time("signup")).alias("low"), F.max(time("purchase")).alias("high"))
    return traces.between_markers(e, markers, ["user_id"]).select("event_id")


@query(f"WITH {_FRAMES}, r AS (SELECT trace % 5 AS gesture, trace, max(gap) AS longest FROM i GROUP BY 1, 2) SELECT gesture, CAST(count(*) AS BIGINT) AS runs, CAST(count(*) FILTER (longest >= 33.3e0) AS BIGINT) AS stutter_runs, CAST(count(*) FILTER (longest >= 100e0) AS BIGINT) AS freeze_runs, CASE WHEN count(*) < 20 THEN 'unmeasured' WHEN count(*) FILTER (longest >= 33.3e0) = 0 THEN 'pass' ELSE 'fail' END AS verdict FROM r GROUP BY 1")
def judge_runs(spark, sf_dir):
    runs = _intervals(spark, sf_dir).groupBy((F.col("trace") % 5).alias("gesture"), "trace").agg(F.max("gap").alias("longest"))
    return traces.judge_runs(runs, 20)


@query("""SELECT user_id, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS values, count(DISTINCT event_type) <= 1 AS agree FROM events GROUP BY user_id""")
def block_merge(spark, sf_dir):
    return traces.merge_blocks(table(spark, sf_dir, "events").withColumn("at", F.col("event_id")), ["user_id"], ["event_type"], "event_id", "at")


@query("""SELECT time_bucket(INTERVAL '1 hour', ts) AS start, event_type, CAST(count(*) AS BIGINT) AS events, CAST(round(sum(CAST(round(value, 2) AS DECIMAL(18,2))), 2) AS DOUBLE) AS total FROM events GROUP BY 1, 2""")
def hourly_windows(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("value", F.round("value", 2).cast("decimal(18,2)"))
    return event_windows(e).withColumn("total", F.col("total").cast("double"))
