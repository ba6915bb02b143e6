"""Ledgers, reviews, histories and provider replies: readers and writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.functions.geo import belt_to_degrees, is_believed, scaled_degrees
from tallyweave.functions.text import branch_of, collapse, merchant_of, plain
from tallyweave.sources.parts import LIMIT, write_parts

# Fixed value: the columns of a ledger file, in order.
LEDGER = "record_id STRING, spent_on STRING, organization STRING, department STRING, merchant STRING, purpose STRING, amount_krw STRING, source_hash STRING, source_location STRING, repeats STRING"

#: Columns that a record must have.
REQUIRED = ("record_id", "spent_on", "organization", "merchant", "amount_krw", "source_hash", "source_location")


def load_repeats(text: Column) -> Column:
    """`hash:location` words as an array of (source_hash, location), cut at the first colon."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), " "), lambda w: w != "")
    return F.transform(words, lambda w: F.struct(F.substring_index(w, ":", 1).alias("source_hash"), F.regexp_replace(w, "^[^:]*:", "").alias("location")))


def dump_repeats(repeats: Column) -> Column:
    return F.array_join(F.transform(repeats, lambda r: F.concat(r["source_hash"], F.lit(":"), r["location"])), " ")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """A ledger CSV with exactly the expected header; another header, or a date that is not yyyy-mm-dd, is an error."""
    rows = spark.read.csv(path, schema=LEDGER, header=True, enforceSchema=False, mode="FAILFAST", multiLine=True, escape='"')
    good = F.col("spent_on").rlike(r"^\d{4}-\d{2}-\d{2}$")
    day = F.when(good, F.col("spent_on").cast("date")).otherwise(F.raise_error(F.concat(F.lit("not a date: "), F.coalesce("spent_on", F.lit("")))).cast("date"))
    # absent texts are empty, not unknown
    blank = {c: F.coalesce(F.col(c), F.lit("")) for c in ("department", "purpose")}
    return rows.withColumns(blank | {"spent_on": day, "amount_krw": F.col("amount_krw").cast("decimal(38,6)"), "repeats": load_repeats(F.col("repeats"))})


def write_ledger(records: DataFrame, path: str, limit: int = LIMIT) -> None:
    """A ledger as CSV parts of at most `limit` bytes, all moved into place at once. A record without one of its REQUIRED values, or
    larger than a part, is an error, and then nothing changes.
    """
    names = [c.split()[0] for c in LEDGER.split(", ")]
    plain_amount = F.regexp_replace(F.col("amount_krw").cast("string"), r"(\.\d*?)0+$", "$1")
    rows = records.withColumns({"repeats": dump_repeats(F.col("repeats")), "amount_krw": F.regexp_replace(plain_amount, r"\.$", "")})
    texts = rows.select(*[F.col(n).cast("string") for n in names])
    lacks = F.array_join(F.filter(F.array(*[F.when(F.coalesce(F.col(n), F.lit("")) == "", F.lit(n)) for n in REQUIRED]), lambda n: n.isNotNull()), ", ")
    line = F.to_csv(F.struct(*names), {"escape": '"', "emptyValue": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"})
    checked = F.when(lacks == "", line).otherwise(F.raise_error(F.concat(F.lit("no record, it lacks "), lacks)).cast("string"))
    write_parts(texts.select(checked.alias("line")), path, ",".join(names), ".csv", limit)


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def read_reviews(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines of reviews; none if the file is missing. A malformed line is an error."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.json(path, schema=schema, mode="FAILFAST")


def read_numbered_ledger(spark: SparkSession, path: str, schema: str, key: str) -> DataFrame:
    """JSON lines with a column `line`: malformed lines are skipped, and the last line of each key wins."""
    rows = spark.read.json(path, schema=f"{schema}, line LONG", mode="DROPMALFORMED").where(f"{key} is not null")
    columns = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*columns), "line").alias("row")).select(key, "row.*").drop("line")


PLACE_ITEM = "array<struct<title:string,link:string,category:string,address:string,roadAddress:string,mapx:string,mapy:string>>"


def place_candidates(replies: DataFrame, body: str = "body") -> DataFrame:
    """Candidates of place-search replies: merchant, branch, address, latitude, longitude; position within the reply.

    Titles lose markup and split off their branch. The road address comes first. Coordinates are integers of 1e-7 degrees;
    those outside the believed box are null.
    """
    items = F.from_json(body, f"struct<items:{PLACE_ITEM}>")["items"]
    rows = replies.select(*[c for c in replies.columns if c != body], F.posexplode(items).alias("position", "item"))
    name = plain(F.col("item.title"))
    lat, lon = scaled_degrees(F.col("item.mapy")), scaled_degrees(F.col("item.mapx"))
    address = F.coalesce(*[F.when(collapse(F.col(f"item.{c}")) != "", collapse(F.col(f"item.{c}"))) for c in ("roadAddress", "address")])
    rows = rows.withColumns({"_name": name, "_lat": lat, "_lon": lon})
    ok = is_believed(F.col("_lat"), F.col("_lon"))
    return rows.withColumns({"merchant": merchant_of(F.col("_name")), "branch": branch_of(F.col("_name")), "address": address, "latitude": F.when(ok, F.col("_lat")), "longitude": F.when(ok, F.col("_lon"))}).drop("_name", "_lat", "_lon", "item")


def license_candidates(replies: DataFrame, body: str = "body") -> DataFrame:
    """Candidates of business-license replies, whose `items` may be "", null, one object or a list.

    merchant, branch, address, open, latitude, longitude. Coordinates are central-belt metres.
    """
    items = F.get_json_object(body, "$.response.body.items.item")
    as_list = F.when(F.substring(F.trim(items), 1, 1) == "[", items).when(F.substring(F.trim(items), 1, 1) == "{", F.concat(F.lit("["), items, F.lit("]")))
    item = "array<struct<MNG_NO:string,BPLC_NM:string,ROAD_NM_ADDR:string,LOTNO_ADDR:string,SALS_STTS_NM:string,CLSBIZ_YMD:string,CRD_INFO_X:string,CRD_INFO_Y:string>>"
    rows = replies.select(*[c for c in replies.columns if c != body], F.posexplode(F.from_json(as_list, item)).alias("position", "item"))
    x, y = (F.col(f"item.CRD_INFO_{a}").try_cast("double") for a in "XY")
    rows = rows.withColumns({"_name": collapse(F.col("item.BPLC_NM")), "_at": belt_to_degrees(x, y)})
    ok = is_believed(F.col("_at.latitude"), F.col("_at.longitude"))
    address = F.coalesce(*[F.when(collapse(F.col(f"item.{c}")) != "", collapse(F.col(f"item.{c}"))) for c in ("ROAD_NM_ADDR", "LOTNO_ADDR")])
    return rows.withColumns({
        "reference": F.col("item.MNG_NO"), "merchant": merchant_of(F.col("_name")), "branch": branch_of(F.col("_name")), "address": address,
        "open": F.coalesce(F.trim("item.CLSBIZ_YMD"), F.lit("")) == "", "latitude": F.when(ok, F.col("_at.latitude")), "longitude": F.when(ok, F.col("_at.longitude")),
    }).drop("_name", "_at", "item")


def model_answers(replies: DataFrame, body: str = "body") -> DataFrame:
    """answer, error, input_tokens, output_tokens of model replies; an error unless the reply stopped by itself with a text."""
    shape = "struct<candidates:array<struct<content:struct<parts:array<struct<text:string>>>,finishReason:string>>,usageMetadata:struct<promptTokenCount:int,candidatesTokenCount:int,thoughtsTokenCount:int>>"
    rows = replies.withColumn("_r", F.from_json(body, shape))
    first = F.try_element_at(F.col("_r.candidates"), F.lit(1))
    text = F.array_join(F.transform(first["content"]["parts"], lambda p: p["text"]), "")
    error = F.when(F.col("_r").isNull() | first.isNull(), "unreadable").when(first["finishReason"] != "STOP", F.lower(first["finishReason"])).when(F.coalesce(text, F.lit("")) == "", "empty")
    use = F.col("_r.usageMetadata")
    rows = rows.withColumns({"error": error, "answer": F.when(error.isNull(), text), "input_tokens": use["promptTokenCount"], "output_tokens": F.coalesce(use["candidatesTokenCount"], F.lit(0)) + F.coalesce(use["thoughtsTokenCount"], F.lit(0))})
    return rows.drop("_r", body)
