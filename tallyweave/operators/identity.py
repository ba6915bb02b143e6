"""Entity resolution: a record's place, by a ladder of decisions over facts and candidates.

lookup rows: record, merchant (the name to confirm, normalized), status, facts: array of (merchant, branch, address, source),
candidates: array of (provider, reference, merchant, branch, address, latitude, longitude). All names are normalized before;
a null branch or address is unknown, an empty branch is none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.functions.keys import business_id
from tallyweave.tables import numbered


def place(x: Column) -> Column:
    """(merchant, branch, address), or null if branch or address is unknown."""
    return F.when(x["branch"].isNotNull() & x["address"].isNotNull(), F.struct(x["merchant"].alias("m"), x["branch"].alias("b"), x["address"].alias("a")))


def decide_identity(lookups: DataFrame) -> DataFrame:
    """Adds status, reason, business_id, latitude, longitude, providers.

    With columns confirmed_source (provider, reference) and confirmed_place (m, b, a), a confirmed record takes the
    confirmed candidate in place of the facts. The first reason that holds decides.
    """
    confirmed = F.lit(False)
    if "confirmed_place" in lookups.columns:
        confirmed = F.col("confirmed_place").isNotNull()
    references = F.transform("candidates", lambda c: c["reference"])
    identities = F.array_distinct(F.transform("facts", place))
    # facts without a branch or address are caught before an identity is asked for
    rows = lookups.withColumns({"_refs": references, "_ids": identities, "_confirmed": confirmed})
    expected = F.try_element_at("_ids", F.lit(1))
    by_fact = F.filter("candidates", lambda c: place(c) == expected)
    if "confirmed_place" in lookups.columns:
        same = lambda c: (c["provider"] == F.col("confirmed_source.provider")) & (c["reference"] == F.col("confirmed_source.reference")) & (place(c) == F.col("confirmed_place"))
        by_fact = F.when(F.col("_confirmed"), F.filter("candidates", same)).otherwise(by_fact)
    rows = rows.withColumn("_matches", F.coalesce(by_fact, F.array().cast(lookups.schema["candidates"].dataType)))
    rows = rows.withColumn("_coordinates", F.array_distinct(F.transform(F.filter("_matches", lambda c: c["latitude"].isNotNull() & c["longitude"].isNotNull()), lambda c: F.struct(c["latitude"].alias("lat"), c["longitude"].alias("lon")))))
    providers = F.transform("_matches", lambda c: c["provider"])
    from_facts = ~F.col("_confirmed")
    reason = (
        F.when(F.col("status") == "error", "lookup_error")
        .when(F.size("candidates") == 0, "no_candidates")
        .when(from_facts & ((F.size("facts") == 0) | F.exists("facts", lambda f: f["address"].isNull())), "missing_address")
        .when(from_facts & F.forall("facts", lambda f: F.array_contains(F.col("_refs"), f["source"])), "insufficient_evidence")
        .when(from_facts & F.exists("facts", lambda f: f["branch"].isNull()), "unknown_branch")
        .when(from_facts & (F.size("_ids") != 1), "conflicting_evidence")
        .when(from_facts & (expected["m"] != F.col("merchant")), "unconfirmed_name")
        .when(F.size("_matches") == 0, "no_match")
        .when(F.size(F.array_distinct(providers)) != F.size("_matches"), "ambiguous")
        .when(F.size("_coordinates") > 1, "conflicting_evidence")
        .when(F.size("_coordinates") == 0, "missing_coordinates")
        .when(F.col("_confirmed"), "human_confirmed")
        .otherwise("matched")
    )
    rows = rows.withColumns({"reason": reason, "providers": F.array_join(F.array_sort(providers), "+")})
    ok = F.col("reason").isin("matched", "human_confirmed")
    first, at = F.try_element_at("_matches", F.lit(1)), F.try_element_at("_coordinates", F.lit(1))
    rows = rows.withColumns({
        "outcome": F.when(ok, "success").otherwise("failed"), "business_id": F.when(ok, business_id(first["merchant"], first["branch"], first["address"])),
        "latitude": F.when(ok, at["lat"]), "longitude": F.when(ok, at["lon"]), "providers": F.when(ok, F.col("providers")),
    })
    return rows.drop("_refs", "_ids", "_confirmed", "_matches", "_coordinates")


def reconcile_coordinates(results: DataFrame) -> DataFrame:
    """Results of a business with several coordinates become failures for conflicting evidence, without business or place.

    A business's rows are not gathered: least and greatest coordinates are compared.
    """
    both = results.where("business_id is not null").groupBy("business_id").agg(F.min(F.struct("latitude", "longitude")).alias("low"), F.max(F.struct("latitude", "longitude")).alias("high"))
    conflicts = both.where("low <> high").select("business_id", F.lit(True).alias("_conflict"))
    rows = results.join(conflicts, "business_id", "left")
    hit = F.coalesce("_conflict", F.lit(False))
    changes = {"outcome": F.when(hit, "failed").otherwise(F.col("outcome")), "reason": F.when(hit, "conflicting_evidence").otherwise(F.col("reason"))}
    changes |= {c: F.when(~hit, F.col(c)) for c in ("latitude", "longitude", "business_id")}
    return rows.withColumns(changes).drop("_conflict")


def coordinate_origin(candidates: Column, latitude: Column, longitude: Column) -> Column:
    """(provider, address) of the least candidate with an address at the coordinates; null if none."""
    here = F.filter(candidates, lambda c: (c["latitude"] == latitude) & (c["longitude"] == longitude) & c["address"].isNotNull())
    return F.array_min(F.transform(here, lambda c: F.struct(c["provider"].alias("provider"), c["address"].alias("address"))))


def merged_lookups(providers: DataFrame) -> DataFrame:
    """record, status, candidates: all candidates of a record's providers; the first provider's error (by number) is the status.

    providers: record, number, status, candidates.
    """
    error = F.min_by("status", F.when(F.col("status") != "ok", F.col("number")))
    parts = F.array_sort(F.collect_list(F.struct("number", "candidates")))
    return providers.groupBy("record").agg(F.coalesce(error, F.lit("ok")).alias("status"), F.flatten(F.transform(parts, lambda p: p["candidates"])).alias("candidates"))


def with_default_lookup(records: DataFrame, supplied: DataFrame) -> DataFrame:
    """Every record with its supplied lookup; status `error` and error `not_supplied` where there is none."""
    rows = records.join(supplied, "record", "left")
    return rows.withColumns({"error": F.when(F.col("status").isNull(), "not_supplied").otherwise(F.col("error") if "error" in supplied.columns else F.lit(None)), "status": F.coalesce("status", F.lit("error"))})


def comparable(results: DataFrame) -> DataFrame:
    """Failures that a restored name could mend: unconfirmed names and lookups without a match, with neither restoration nor confirmation."""
    return results.where((F.col("outcome") == "failed") & F.col("reason").isin("unconfirmed_name", "no_match") & F.col("restoration").isNull() & F.col("confirmation").isNull())


def display_names(records: DataFrame, restorations: DataFrame) -> DataFrame:
    """record, name: the restored name where there is one, else the merchant as recorded. restorations: record (once each), restored."""
    rows = records.select("record", "merchant").join(restorations.select("record", "restored"), "record", "left")
    return rows.select("record", F.coalesce("restored", "merchant").alias("name"))


def pending_names(names: DataFrame, cached: DataFrame) -> DataFrame:
    """Names (key) without a cached verdict."""
    return names.join(cached.select("key").distinct(), "key", "left_anti")


def geocode_inputs(records: DataFrame, lookups: DataFrame, confirmations: DataFrame, restorations: DataFrame, previous: DataFrame) -> DataFrame:
    """Every record with all that its place is decided from: lookup (status `error` where none was supplied), confirmed place, restored name, and the previous decision under the same key.

    records: record, merchant, lookup_key. lookups: record, status, candidates. confirmations: record, confirmed_place.
    restorations: record, restored. previous: lookup_key (once each), decision.
    """
    rows = with_default_lookup(records, lookups).join(confirmations, "record", "left").join(restorations, "record", "left").join(previous, "lookup_key", "left")
    return rows.withColumn("name", F.coalesce("restored", "merchant"))


def comparison_candidates(designations: DataFrame, records: DataFrame, results: DataFrame, lookups: DataFrame) -> DataFrame:
    """Designated records that can be compared: recorded, failed in a way that a restored name could mend, with a lookup that gave candidates.

    A designation that lacks any of these is skipped. All by record; results as in `comparable`.
    """
    met = designations.select("record").distinct().join(records, "record").join(comparable(results).select("record", "reason"), "record")
    return met.join(lookups.where("status = 'ok' and size(candidates) > 0").select("record", "candidates"), "record")


def confirmed_places(matches: DataFrame) -> DataFrame:
    """record, place, conflict: confirmations that apply to a record (as of `rules.rule_matches`, rule_place, a text); null and a conflict if they name different places."""
    found = matches.groupBy("record").agg(F.min("rule_place").alias("low"), F.max("rule_place").alias("high"))
    return found.select("record", F.when(F.col("low") == F.col("high"), F.col("low")).alias("place"), (F.col("low") != F.col("high")).alias("conflict"))


def first_spellings(names: DataFrame) -> DataFrame:
    """key, name, position: the first spelling of each normalized key, by position."""
    return names.groupBy("key").agg(F.min_by("name", "position").alias("name"), F.min("position").alias("position"))


def number_batches(keys: DataFrame, size: int = 40) -> DataFrame:
    """keys (key, distinct) in order, with batch and index; numbered by ranges of keys, whose counts give the offsets."""
    at = F.col("_at") - 1
    return numbered(keys.select("key"), [F.col("key")], "_at").select("key", F.floor(at / size).alias("batch"), (at % size).alias("index"))
