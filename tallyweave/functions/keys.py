"""Keys: content digests and identifiers made of them."""

from __future__ import annotations

import hashlib
import json

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Fixed value: the version prefix of business ids.
BUSINESS_VERSION = "business-1"


def list_digest(*values: Column) -> Column:
    """SHA-256 of the values as a compact JSON list of strings."""
    return F.sha2(F.to_json(F.array(*values)), 256)


def business_id(merchant: Column, branch: Column, address: Column) -> Column:
    """Digest of normalized merchant, branch and address; null if branch or address is unknown."""
    return F.when(branch.isNotNull() & address.isNotNull(), list_digest(F.lit(BUSINESS_VERSION), merchant, branch, address))


def record_id(source_hash: Column, table: Column, row: Column) -> Column:
    return F.concat(F.substring(source_hash, 1, 16), F.lit("-"), table, F.lit("-R"), row.cast("string"))


@F.arrow_udf(StringType())
def _canonical_digest(values: pa.Array) -> pa.Array:
    compact = lambda v: json.dumps(json.loads(v), ensure_ascii=False, sort_keys=True, separators=(",", ":"))
    return pa.array([None if v is None else hashlib.sha256(compact(v).encode()).hexdigest() for v in values.to_pylist()], pa.string())


def object_digest(json_text: Column) -> Column:
    """SHA-256 of a JSON text's canonical form: sorted keys, no spaces. Python's number texts: an Arrow UDF."""
    return _canonical_digest(json_text)


def _texts(values: list) -> Column:
    """Values as an array of texts, unknown ones as a mark of their own (no text begins with U+0000)."""
    return F.array(*[F.coalesce(v.cast("string"), F.lit("\u0000null")) for v in values])


def policy_key(versions: dict[str, str]) -> Column:
    """A key of policy versions alone: what upstream files hold does not change it."""
    return list_digest(F.lit("policy-1"), *[F.lit(x) for k in sorted(versions) for x in (k, versions[k])])


def decision_key(policy: Column, record: list, lookup: Column, confirmation: Column, restoration: Column) -> Column:
    """A key of all that a decision rests on: the policy, the record's fields used, its lookup, confirmation and restoration (JSON texts or null)."""
    return F.sha2(F.to_json(F.concat(F.array(F.lit("decision-1")), _texts([policy, *record, lookup, confirmation, restoration]))), 256)


def request_key(service: Column, *asked: Column) -> Column:
    """A key of a question to a service (a provider and query; a model, designation and prompt; an answer's table)."""
    return F.sha2(F.to_json(F.concat(F.array(F.lit("request-1")), _texts([service, *asked]))), 256)


def header_key(rows: Column) -> Column:
    """A key of header rows (array of arrays of cells) that white space does not change."""
    tight = F.transform(rows, lambda r: F.transform(r, lambda c: F.regexp_replace(c, r"(?U)\s+", "")))
    return F.sha2(F.to_json(tight), 256)
