"""Reporting periods, periods declared in titles, and dates in common notations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The reporting period, the century of short years, and the day numbers of spreadsheets.
PERIOD_START, PERIOD_END = dt.date(2026, 1, 1), dt.date(2026, 6, 30)
CENTURY = 2000
FIRST_SERIAL, LAST_SERIAL = 36526, 73051
SERIAL_EPOCH = dt.date(1899, 12, 30)
_RANGE = r"\s*[~\-–∼,]\s*"
#: Groups: year, quarter of `q/4`, first and last quarter, quarter, first and last month, month, half.
DECLARED_PERIOD = (
    r"(?<!\d)(\d{4}|\d{2})\s*(?:년도|년|\.)\s*"
    rf"(?:([1-4])\s*/\s*4\s*분기|([1-4]){_RANGE}([1-4])\s*분기|([1-4])\s*분기"
    rf"|(1[0-2]|[1-9])\s*월?{_RANGE}(1[0-2]|[1-9])\s*월|(1[0-2]|[1-9])\s*월|([상하])\s*반기)?"
)
#: Full, tight and short notation, in this order; groups of year, month and day.
_NOTATIONS = (
    r"(?Us)^['‘’`]*(?:(\d{4})\s*[-./년]\s*(\d{1,2})\s*[-./월]\s*(\d{1,2})(?!\d)|(20\d{2})(\d{2})(\d{2})(?!\d)"
    r"|(\d{2})\s*[-./]\s*(\d{1,2})\s*[-./]\s*(\d{1,2})(?!\d)).*$"
)
# End of fixed values.


def in_period(day: Column, start: dt.date = PERIOD_START, end: dt.date = PERIOD_END) -> Column:
    return day.between(F.lit(start), F.lit(end))


def overlaps(start: Column, end: Column, other_start: Column, other_end: Column) -> Column:
    return (start <= other_end) & (other_start <= end)


def declared_period(title: Column) -> Column:
    """Struct (start, end) of the first period that a title declares; null if none, or if its months run backwards."""
    text = F.coalesce(title, F.lit(""))
    group = [F.regexp_extract(text, DECLARED_PERIOD, k) for k in range(10)]
    number = [F.when(g != "", g.cast("int")) if 1 <= k <= 8 else None for k, g in enumerate(group)]
    year = F.when(number[1] < 100, number[1] + CENTURY).otherwise(number[1])
    first = F.coalesce(*[3 * number[k] - 2 for k in (2, 3, 5)], number[6], number[8], F.when(group[9] == "하", 7), F.lit(1))
    last = F.coalesce(*[3 * number[k] for k in (2, 4, 5)], number[7], number[8], F.when(group[9] == "상", 6), F.lit(12))
    start = F.try_to_date(F.format_string("%04d-%02d-01", year, first))
    end = F.last_day(F.try_to_date(F.format_string("%04d-%02d-01", year, last)))
    return F.when((group[0] != "") & (first <= last) & start.isNotNull(), F.struct(start.alias("start"), end.alias("end")))


def exclusion_reason(posted: Column, title: Column, start: dt.date = PERIOD_START, end: dt.date = PERIOD_END) -> Column:
    """Why a posting is no target; null if it is one. A posting with neither date nor title can't be told and is one."""
    span = declared_period(title)
    outside = posted.isNull() | ~F.year(posted).between(start.year, end.year)
    return (
        F.when(posted.isNull() & title.isNull(), F.lit(None).cast("string"))
        .when(outside, "posted_out_of_range")
        .when(span.isNull(), "undeclared_in_year")
        .when(~overlaps(span["start"], span["end"], F.lit(start), F.lit(end)), "declared_out_of_range")
    )


def _made(year: Column, month: Column, day: Column) -> Column:
    """A date, or null if there is none."""
    return F.try_to_date(F.format_string("%04d-%02d-%02d", year, month, day), "yyyy-MM-dd")


def _parts(text: Column, pattern: str, n: int) -> list[Column]:
    found = [F.regexp_extract(text, "(?U)" + pattern, k + 1) for k in range(n)]
    return [F.when(x != "", x.cast("int")) for x in found]


def parse_date_text(text: Column, year_hint: Column | None = None) -> Column:
    """Date of a text: `2026.3.4`, `2026년 3월 4일`, `20260304`, `26-3-4`; `3.4` with a year hint. The first notation that fits decides."""
    # one replacement finds all notations, as this is computed for every row: what fits becomes =year-month-day
    said = F.regexp_replace(text, _NOTATIONS, "=$1$4$7-$2$5$8-$3$6$9")
    day = F.concat(F.when(F.substring(said, 4, 1) == "-", str(CENTURY // 100)).otherwise(""), F.substring(said, 2, 10)).try_cast("date")
    out = F.when(said != text, day)
    if year_hint is not None:
        partial = _parts(F.regexp_replace(text, "^['‘’`]+", ""), r"^(\d{1,2})\s*[-./월]\s*(\d{1,2})(?!\d)", 2)
        out = out.when(year_hint.isNotNull() & partial[0].isNotNull(), _made(year_hint, *partial))
    return out


def parse_date_number(number: Column) -> Column:
    """Date of a number: a spreadsheet's day number, or yyyymmdd."""
    whole = F.when(number == F.floor(number), F.floor(number).cast("int"))
    serial = F.date_add(F.lit(SERIAL_EPOCH), whole)
    digits = _made(F.floor(whole / 10000).cast("int"), F.floor(whole / 100).cast("int") % 100, whole % 100)
    return F.when(whole.between(FIRST_SERIAL, LAST_SERIAL), serial).when(whole.between(20000101, 20991231), digits)


def parse_date(kind: Column, string: Column, number: Column, moment: Column, year_hint: Column | None = None) -> Column:
    """Date of a sheet cell by its kind (`datetime`, `double`, `string`)."""
    return F.when(kind == "datetime", F.to_date(moment)).when(kind == "double", parse_date_number(number)).otherwise(parse_date_text(string, year_hint))


def month_day(month: Column, day: Column, year_hint: Column) -> Column:
    """Date of month and day texts (`3`, `3월`, `14일`) with a year hint."""
    m, d = (_parts(x, r"^(\d{1,2})\s*[월일]?$", 1)[0] for x in (month, day))
    return F.when(year_hint.isNotNull() & m.isNotNull() & d.isNotNull(), _made(year_hint, m, d))


def quarter_months(first: Column, last: Column) -> Column:
    return F.struct((3 * first - 2).alias("first"), (3 * last).alias("last"))


def parse_moment_with_offset(text: Column) -> Column:
    """Timestamp of an ISO-8601 text that names its offset; else null."""
    shaped = text.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:\d{2})$")
    return F.when(shaped, F.try_to_timestamp(text))
