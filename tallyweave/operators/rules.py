"""Rules that people write: wildcard scopes, the most specific rule, conflicts, agreement, and precedence of sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.tables import spare_names


def rule_matches(records: DataFrame, rules: DataFrame, key: str, wildcards: list[str]) -> DataFrame:
    """Record-rule pairs: `key` is equal, and each wildcard column of the rule is null or equal.

    Rules are told apart by the set of columns that they declare; of the sets that occur (at most 2 to the power of the
    wildcards) a record asks each for its own values: one equi-join, in which a record meets only rules that apply to it.
    """
    own = spare_names([*records.columns, *[f"rule_{c}" for c in rules.columns]], "_declares", "_asked")
    declared = lambda row: F.concat(*[F.when(row(c).isNotNull(), "1").otherwise("0") for c in wildcards]) if wildcards else F.lit("")
    sets = [r["s"] for r in rules.select(declared(F.col).alias("s")).distinct().collect()]
    r = rules.select(*[F.col(c).alias(f"rule_{c}") for c in rules.columns]).withColumn(own[0], declared(lambda c: F.col(f"rule_{c}")))
    asking = records.withColumn(own[1], F.explode(F.array(*[F.lit(s) for s in sets]) if sets else F.array().cast("array<string>")))
    on = (asking[key] == r[f"rule_{key}"]) & (asking[own[1]] == r[own[0]])
    for k, c in enumerate(wildcards, 1):
        on = on & F.when(F.substring(asking[own[1]], k, 1) == "1", asking[c]).eqNullSafe(r[f"rule_{c}"])
    return asking.join(r, on).drop(*own)


def specificity(columns: list[str], weights: dict[str, int] | None = None) -> Column:
    """Declared (non-null) columns of a rule, by weight (1 if none is given)."""
    return sum((F.when(F.col(f"rule_{c}").isNotNull(), (weights or {}).get(c, 1)).otherwise(0) for c in columns), F.lit(0))


def most_specific(matches: DataFrame, record: str, value: str, wildcards: list[str], weights: dict[str, int] | None = None) -> DataFrame:
    """record, value, conflict: of the most specific rules of each record; conflict if they differ in value (value is then null)."""
    rated = matches.withColumn("_weight", specificity(wildcards, weights))
    top = rated.withColumn("_top", F.max("_weight").over(Window.partitionBy(record))).where("_weight = _top")
    found = top.groupBy(record).agg(F.min(value).alias("low"), F.max(value).alias("high"))
    return found.select(record, F.when(F.col("low") == F.col("high"), F.col("low")).alias(value), (F.col("low") != F.col("high")).alias("conflict"))


def narrowest(matches: DataFrame, record: str, value: str, wildcards: list[str]) -> DataFrame:
    """As most_specific, but the narrowest rule must declare all that the others of its record declare; else conflict."""
    names = F.array_compact(F.array(*[F.when(F.col(f"rule_{c}").isNotNull(), F.lit(c)) for c in wildcards]))
    rated = matches.withColumn("_declared", names).groupBy(record).agg(F.collect_list(F.struct(F.size("_declared").alias("n"), F.col("_declared").alias("declared"), F.col(value).alias("value"))).alias("rules"))
    best = F.array_max(F.transform("rules", lambda r: F.struct(r["n"].alias("n"), r["declared"].alias("declared"), r["value"].alias("value"))))
    rated = rated.withColumn("best", best)
    strict = F.forall("rules", lambda r: (r["value"] == F.col("best.value")) | ((F.size(F.array_except(r["declared"], F.col("best.declared"))) == 0) & (r["n"] < F.col("best.n"))))
    return rated.select(record, F.when(strict, F.col("best.value")).alias(value), (~strict).alias("conflict"))


def disagreements(left: DataFrame, right: DataFrame, key: str, left_value: str, right_value: str) -> DataFrame:
    """Keys of both sides whose values differ."""
    return left.join(right, key).where(F.col(left_value) != F.col(right_value)).select(key, left_value, right_value)


def precedence(records: DataFrame, key: str, layers: list[tuple[str, DataFrame]], pending: str = "pending") -> DataFrame:
    """records with status and evidence (the layer's name): of the first layer that has the key; else pending.

    layers: (name, (key, status)), from the strongest on. A key that a layer has several times counts once there, with the
    least of its statuses (`layer_conflicts` lists those that differ), so records are never multiplied.
    """
    out = records
    for name, layer in layers:
        once = layer.where(F.col(key).isNotNull()).groupBy(F.col(key).alias(f"_{name}")).agg(F.min("status").alias(f"_status_{name}"))
        out = out.join(once, F.col(key) == F.col(f"_{name}"), "left")
    status = F.coalesce(*[F.col(f"_status_{n}") for n, _ in layers], F.lit(pending))
    evidence = F.coalesce(*[F.when(F.col(f"_status_{n}").isNotNull(), F.lit(n)) for n, _ in layers], F.lit("none"))
    return out.select(*records.columns, status.alias("status"), evidence.alias("evidence"))


def layer_conflicts(layer: DataFrame, key: str) -> DataFrame:
    """Keys to which a layer gives different statuses."""
    return layer.groupBy(key).agg(F.min("status").alias("low"), F.max("status").alias("high")).where("low <> high").select(key)


def applies_to(column: str, value: str) -> Column:
    """A row without a scope applies to every one."""
    return F.col(column).isNull() | (F.col(column) == value)


def scope_problems(reviews: DataFrame, scope: list[str], city: str) -> DataFrame:
    """Reviews of another city, and scopes that are reviewed twice."""
    other = reviews.where(F.col("city") != city).select(*scope, F.lit("city").alias("problem"))
    twice = reviews.groupBy(*scope).count().where("count > 1").select(*scope, F.lit("duplicate").alias("problem"))
    return other.union(twice)


def verified_batches(asked: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Verdicts of batches whose answers list the asked names in the asked order, no more and no less.

    asked: batch, index, name. verdicts: batch, index, name, status.
    """
    met = asked.select("batch", "index", "name").join(verdicts.select("batch", "index", F.col("name").alias("said"), "status"), ["batch", "index"], "full")
    good = met.groupBy("batch").agg(F.bool_and(F.coalesce(F.col("name") == F.col("said"), F.lit(False))).alias("ok")).where("ok")
    return met.join(good, "batch", "left_semi").select("batch", "index", "name", "status")


def settled_mapping(answers: DataFrame) -> DataFrame:
    """Answers (source, sheet, layout, header_rows, data_start, columns: array of (column, role), unit, width) as mappings with a problem.

    Roles must be unique and columns within the sheet's width; the unit scales amounts by 1 or 1000.
    """
    roles = F.transform("columns", lambda c: c["role"])
    problem = (
        F.when(F.size(F.array_distinct(roles)) != F.size("columns"), "duplicate role")
        .when(F.exists("columns", lambda c: (c["column"] < 0) | (c["column"] >= F.col("width"))), "column out of bounds")
        .when(F.col("data_start") <= F.coalesce(F.array_max("header_rows"), F.lit(0)), "data start before header")
    )
    mapped = F.map_from_arrays(F.when(problem.isNull(), roles), F.when(problem.isNull(), F.transform("columns", lambda c: c["column"])))
    return answers.select("source", "sheet", "layout", "header_rows", "data_start", mapped.alias("columns"), F.when(F.col("unit") == "thousand", 1000).otherwise(1).alias("multiplier"), problem.alias("problem"))
