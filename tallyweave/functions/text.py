"""Text functions: normal forms, personal-data scrubbing, tags and branches."""

from __future__ import annotations

import html
import unicodedata
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Patterns whose matches define the results.
RESIDENT_NUMBER = r"\d{6}\s*-\s*[1-4]\d{6}"
PHONE = r"(?<!\d)0\d{1,2}[-. )]\d{3,4}[-. ]\d{4}(?!\d)"
EMAIL = r"[\w.+-]+@[\w-]+(\.[\w-]+)+"
PERSONAL_EVENT = r"(?:(?<![가-힣])|(?<=직원|경사|애사|소속))(축의|부의|조의|축부의|경조사|애경사|별세|빙모|빙부|모친상|부친상|장인상|장모상|장례|근조|순직)|故"
MASKED_NAME = r"[가-힣](\s*[*＊○◯ㅇ]){1,2}(?:\s*[가-힣](?![가-힣]))?"
PERSON_NAME = r"[가-힣]{2,4}"
GENERIC_PAYEES = ("직원", "소속직원", "개인", "축의금", "부의금", "조의금", "경조사", "화환", "집무실")
REDACTED_PAYEE = "개인(성명 비공개)"
BRANCH_WORD = r"\S*[가-힣A-Za-z0-9]점"
# End of fixed values.

_UNICODE = "(?U)"


def strip(value: Column) -> Column:
    """White space (of Unicode) off both ends."""
    return F.regexp_replace(value, _UNICODE + r"^\s+|\s+$", "")


def collapse(value: Column) -> Column:
    """Runs of white space become one space; none at the ends."""
    return F.trim(F.regexp_replace(value, _UNICODE + r"\s+", " "))


def _mapped(convert) -> object:
    @F.arrow_udf(StringType())
    def run(values: pa.Array) -> pa.Array:
        return pa.array([None if v is None else convert(v) for v in values.to_pylist()], pa.string())

    return run


_normalized = _mapped(lambda v: " ".join(unicodedata.normalize("NFC", v).split()).casefold())
_compact = _mapped(lambda v: "".join(unicodedata.normalize("NFC", v).split()))
_searchable = _mapped(lambda v: searchable_form(v))
_unescaped = _mapped(html.unescape)


def normalized(value: Column) -> Column:
    """NFC, white space collapsed, case folded. Spark has no NFC: an Arrow UDF, to be kept in a column before joins."""
    return _normalized(value)


def compact(value: Column) -> Column:
    """NFC without any white space."""
    return _compact(value)


def searchable_form(value: str) -> str:
    return unicodedata.normalize("NFKC", value).strip().lower()


def searchable(value: Column) -> Column:
    """NFKC, stripped, lower case."""
    return _searchable(value)


def plain(value: Column) -> Column:
    """Markup removed, character references resolved, white space collapsed."""
    return collapse(_unescaped(F.regexp_replace(value, "<[^>]*>", "")))


def is_identifier(value: Column) -> Column:
    """ASCII letters and digits only."""
    return F.coalesce(value.rlike("^[A-Za-z0-9]+$"), F.lit(False))


def branch_of(name: Column) -> Column:
    """The last word of a name of several, if it names a branch; else empty."""
    return F.regexp_extract(name, f"^.+ ({BRANCH_WORD})$", 1)


def merchant_of(name: Column) -> Column:
    """A name without its branch."""
    without = F.regexp_extract(name, f"^(.+) {BRANCH_WORD}$", 1)
    return F.when(without != "", without).otherwise(name)


#: A character that all masked names have, and one that all names of personal events have (故 is no Hangul): texts
#: without it need no further look.
_HANGUL = "[가-힣]"
_EVENT_SIGN = "[가-힣故]"


def mentions_personal_event(value: Column) -> Column:
    return value.rlike(_EVENT_SIGN) & value.rlike(_UNICODE + PERSONAL_EVENT)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _blanked(text: Column, pattern: str, sign: str) -> Column:
    """Matches of the pattern as spaces; only texts with the sign that all matches have are searched."""
    return F.when(F.contains(text, F.lit(sign)), F.regexp_replace(text, _UNICODE + pattern, " ")).otherwise(text)


def scrub_purpose(purpose: Column) -> Column:
    """A purpose without resident numbers, phones, e-mails and masked names; without brackets if of a personal event."""

    def bare(text: Column) -> Column:
        return F.when(mentions_personal_event(text), F.regexp_replace(text, r"\([^)]*\)", " ")).otherwise(text)

    def names(text: Column) -> Column:
        return F.when(text.rlike(_HANGUL), F.regexp_replace(text, _UNICODE + MASKED_NAME, " ")).otherwise(text)

    steps = [lambda t: _blanked(t, RESIDENT_NUMBER, "-"), lambda t: _blanked(t, PHONE, "0"), lambda t: _blanked(t, EMAIL, "@"), bare, names]
    text = purpose
    for step in steps:
        text = _let(text, step)
    return collapse(text)


def scrub_merchant(merchant: Column, purpose: Column) -> Column:
    """A fixed mark for masked names, and for person names if the purpose is a personal event."""
    tight = F.regexp_replace(merchant, _UNICODE + r"\s+", "")
    masked = f"{_UNICODE}^(?:{MASKED_NAME})$"
    named = tight.rlike(f"^{PERSON_NAME}$") & ~tight.isin(*GENERIC_PAYEES) & mentions_personal_event(purpose)
    return F.when(strip(merchant).rlike(masked) | tight.rlike(masked) | named, REDACTED_PAYEE).otherwise(merchant)


def suffix_of(filename: Column) -> Column:
    """Lower-case extension of a file name with its dot; empty if none."""
    return F.lower(F.regexp_extract(filename, r"[^./\\](\.[^./\\]+)$", 1))


def file_suffix(*names: Column) -> Column:
    """Extension of the first name that is not blank."""
    return suffix_of(F.coalesce(*[F.when(F.length(strip(n)) > 0, n) for n in names]))


def cell_text(kind: Column, string: Column, number: Column, moment: Column) -> Column:
    """Text of a sheet cell: moments to the minute, whole numbers without a fraction, white space collapsed."""
    whole = F.when(number == F.floor(number), number.cast("decimal(38,0)").cast("string")).otherwise(number.cast("string"))
    return F.coalesce(F.when(kind == "datetime", F.date_format(moment, "yyyy-MM-dd HH:mm")).when(kind == "double", whole).otherwise(collapse(string)), F.lit(""))
