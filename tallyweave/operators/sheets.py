"""Sheets to ledger rows: row kinds, sections, total checks, and all-or-nothing acceptance.

A cell relation has a row for each sheet row: `source`, `sheet`, `row` and `cells` (array of texts). A mapping has, for
each sheet, `header_rows`, `data_start`, `columns` (role -> index from 0), `multiplier`, `layout`.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.functions.amounts import count_in, parse_amount
from tallyweave.functions.dates import PERIOD_END, PERIOD_START, in_period, month_day, parse_date_text
from tallyweave.functions.text import collapse
from tallyweave.tables import cut_lineage

# Labels of rows that are no expense; cells are compared without white space.
_PERIOD = r"(\d{1,2}(~\d{1,2})?월|\d(~\d)?분기|\d{4}년)"
TOTAL = "합계|총계|총합계|계"
UNCLEAR_TOTAL = rf"{_PERIOD}?누계|{_PERIOD}(합계|총계|계)"
SUBTOTAL = ".{0,6}소계"
TERMINATOR = r"(이하)?(빈칸|여백|없음)\.?"
# End of fixed values.


def _any(cells: Column, pattern: str) -> Column:
    return F.exists(cells, lambda c: c.rlike(f"^(?:{pattern})$"))


def _cell(cells: Column, columns: Column, role: str) -> Column:
    """Text of a role's cell; empty if the row is short, null if the role is not mapped."""
    at = F.try_element_at(columns, F.lit(role))
    return F.when(at.isNotNull(), F.coalesce(F.get(cells, at), F.lit("")))


def tight_cells(cells: Column) -> Column:
    """Cells without white space."""
    return F.transform(cells, lambda c: F.regexp_replace(c, r"(?U)\s+", ""))


def row_kind(cells: Column, columns: Column, headers: Column, line: Column, joined: Column) -> Column:
    """blank, header, subtotal, unclear_total, total, note or candidate; the first that fits.

    headers: array of header rows, each its tight cells joined by U+0001. line, joined: columns of the row's own tight cells
    joined so, and without a mark, so that they are computed once. Single cells are tightened only where they may be labels.
    """
    tight = tight_cells(cells)
    # all labels of totals have this letter, which few rows hold
    summed = joined.contains("계")
    empty = lambda *roles: F.array_size(F.filter(F.array(*[_cell(cells, columns, r) for r in roles]), lambda c: c.isNotNull() & (c != ""))) == 0
    identity = ("spent_on", "month", "day", "merchant")
    return (
        F.when(~joined.rlike("[0-9A-Za-z가-힣]") | joined.rlike(f"^(?:{TERMINATOR})$"), "blank")
        .when(F.array_contains(headers, line), "header")
        .when(summed & _any(tight, SUBTOTAL), "subtotal")
        .when(summed & _any(tight, UNCLEAR_TOTAL), "unclear_total")
        .when((joined.contains("건") & count_in(cells).isNotNull() & empty(*identity)) | (summed & _any(tight, TOTAL)), "total")
        .when(empty(*identity, "amount_krw"), "note")
        .otherwise("candidate")
    )


def classify_rows(rows: DataFrame, mappings: DataFrame) -> DataFrame:
    """Sheet rows below the last header row, with kind and section (0, and one more at each repeated header from data_start on).

    Rows above data_start are of section 0; an expense there fails its sheet (kind `early_candidate`).
    """
    base = rows.join(mappings.where("layout = 'table'"), ["source", "sheet"])
    base = base.withColumn("_line", F.regexp_replace(F.array_join("cells", "\u0001"), r"(?U)\s+", "")).withColumn("_joined", F.replace("_line", F.lit("\u0001"), F.lit("")))
    # rows meet their mapping by (source, sheet); both windows keep that dealing and one sort
    sheet = Window.partitionBy("source", "sheet").orderBy("row")
    whole = sheet.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    own = F.when(F.array_contains("header_rows", F.col("row")), F.col("_line"))
    base = base.withColumn("headers", F.collect_set(own).over(whole)).where(F.col("row") > F.coalesce(F.array_max("header_rows"), F.lit(0)))
    kind = row_kind(F.col("cells"), F.col("columns"), F.col("headers"), F.col("_line"), F.col("_joined"))
    base = base.withColumn("kind", kind).withColumn("kind", F.when((F.col("row") < F.col("data_start")) & (F.col("kind") == "candidate"), "early_candidate").otherwise(F.col("kind")))
    starts = ((F.col("kind") == "header") & (F.col("row") >= F.col("data_start"))).cast("int")
    return base.withColumn("section", F.sum(starts).over(sheet)).drop("headers", "_line", "_joined")


def typed_rows(classified: DataFrame) -> DataFrame:
    """Classified rows with spent_on, merchant and amount (scaled), and `problem`: what is wrong with an expense."""
    role = lambda r: _cell(F.col("cells"), F.col("columns"), r)
    amount = parse_amount(role("amount_krw")) * F.col("multiplier")
    day = parse_date_text(role("spent_on"), F.col("year_hint") if "year_hint" in classified.columns else None)
    if "year_hint" in classified.columns:
        day = F.coalesce(day, month_day(role("month"), role("day"), F.col("year_hint")))
    rows = classified.withColumns({"spent_on": day, "amount": amount.cast("decimal(38,6)"), "merchant": collapse(role("merchant"))})
    unread = F.when(F.col("spent_on").isNull(), "spent_on").when(F.col("amount").isNull(), "amount_krw").when(F.coalesce("merchant", F.lit("")) == "", "merchant")
    return rows.withColumn("problem", F.when(F.col("kind") == "early_candidate", "expense before data start").when(F.col("kind") == "candidate", unread))


def total_check(sections: Column, whole: Column) -> Column:
    """matched, absent, ambiguous or mismatch. sections: array of (amount, totals, unread, unclear).

    A total matches its own section's sum or the whole sheet's.
    """
    zero = F.lit(0).cast("decimal(38,6)")
    off = F.exists(sections, lambda s: F.exists(s["totals"], lambda t: (t != F.coalesce(s["amount"], zero)) & (t != F.coalesce(whole, zero))))
    some = F.exists(sections, lambda s: (F.size(s["totals"]) > 0) | s["unread"])
    vague = F.exists(sections, lambda s: s["unread"] | s["unclear"])
    return F.when(off, "mismatch").when(vague, "ambiguous").when(some, "matched").otherwise("absent")


def extract_sheets(rows: DataFrame, mappings: DataFrame, start: dt.date = PERIOD_START, end: dt.date = PERIOD_END) -> tuple[DataFrame, DataFrame]:
    """(records, sheets). records: typed expenses in the period. sheets: counts, total_check and the first problem of each.

    One pass over the rows: sums by section, then by sheet. Typed rows are written once and read for both results.
    """
    typed = typed_rows(classify_rows(rows, mappings)).select("source", "sheet", "row", "section", "kind", "spent_on", "merchant", "amount", "problem")
    typed = cut_lineage(typed)
    is_ = lambda kind: F.col("kind") == kind
    sections = typed.groupBy("source", "sheet", "section").agg(
        F.sum(F.when(is_("candidate"), F.col("amount"))).alias("amount"), F.collect_list(F.when(is_("total"), F.col("amount"))).alias("totals"),
        F.bool_or(is_("total") & F.col("amount").isNull()).alias("unread"), F.bool_or(is_("unclear_total")).alias("unclear"),
        F.count_if(is_("candidate")).alias("candidates"), F.count_if(is_("candidate") & ~in_period(F.col("spent_on"), start, end)).alias("out_of_range"),
        F.min(F.when(F.col("problem").isNotNull(), F.struct("row", "problem"))).alias("problem"),
    )
    folded = sections.groupBy("source", "sheet").agg(F.sum("candidates").alias("candidates"), F.sum("out_of_range").alias("out_of_range"), F.sum("amount").alias("whole"), F.min("problem").alias("first"), F.collect_list(F.struct("amount", "totals", "unread", "unclear")).alias("sections"))
    roles = F.map_keys("columns")
    dated = F.array_contains(roles, "spent_on") | (F.array_contains(roles, "month") & F.array_contains(roles, "day"))
    lacking = ~(dated & F.array_contains(roles, "merchant") & F.array_contains(roles, "amount_krw"))
    sheets = mappings.join(folded, ["source", "sheet"], "left").withColumn("total_check", total_check(F.coalesce("sections", F.array().cast(folded.schema["sections"].dataType)), F.col("whole")))
    found = F.when(F.col("first").isNotNull(), F.concat(F.lit("R"), F.col("first.row").cast("string"), F.lit(" "), F.col("first.problem"))).when(F.col("total_check") == "mismatch", "total amount mismatch")
    problem = F.when((F.col("layout") == "table") & lacking, "missing required roles").when(~F.col("layout").isin("table", "none"), "unsupported layout").otherwise(found)
    sheets = sheets.select("source", "sheet", F.coalesce("candidates", F.lit(0)).alias("candidates"), F.coalesce("out_of_range", F.lit(0)).alias("out_of_range"), "total_check", problem.alias("problem"))
    records = typed.where(is_("candidate") & in_period(F.col("spent_on"), start, end)).select("source", "sheet", "row", "section", "spent_on", "merchant", "amount")
    return records, sheets


def excluded_rows(classified: DataFrame) -> DataFrame:
    """source, sheet, row, kind of the rows from data_start on that are no expense."""
    return classified.where((F.col("row") >= F.col("data_start")) & (F.col("kind") != "candidate")).select("source", "sheet", "row", "kind")


def review_flags(records: DataFrame) -> DataFrame:
    """Records whose amount is not positive: kept, and to be looked at."""
    return records.where(F.col("amount") <= 0).select("source", "sheet", "row", F.lit("non_positive_amount").alias("flag"))


def accept_sources(records: DataFrame, sheets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept records, reports). A source is parsed only if no sheet has a problem and there is a candidate; else none of its records stays."""
    folded = sheets.groupBy("source").agg(
        F.sum("candidates").alias("candidates"), F.sum("out_of_range").alias("out_of_range"), F.min_by("problem", F.when(F.col("problem").isNotNull(), F.col("sheet"))).alias("problem"),
        F.bool_and(F.when(F.col("candidates") > 0, F.col("total_check") == "matched")).alias("matched"), F.bool_or(F.when(F.col("candidates") > 0, F.col("total_check") == "ambiguous")).alias("ambiguous"),
    )
    reason = F.when(F.col("problem").isNotNull(), "validation_failed").when(F.col("candidates") == 0, "no_candidates")
    check = F.when(F.coalesce("matched", F.lit(False)), "matched").when(F.coalesce("ambiguous", F.lit(False)), "ambiguous").otherwise("absent")
    reports = folded.select("source", F.when(reason.isNull(), "parsed").otherwise("unresolved").alias("status"), reason.alias("reason"), "candidates", "out_of_range", check.alias("total_check"), "problem")
    return records.join(reports.where("status = 'parsed'").select("source"), "source", "left_semi"), reports


def unresolved_denominators(sheets: DataFrame) -> DataFrame:
    """source, candidates: their sum; null (unknown, not zero) if any sheet lacks a mapping or has no candidates.

    sheets: source, candidates (null without a mapping).
    """
    known = F.bool_and(F.coalesce(F.col("candidates") > 0, F.lit(False)))
    return sheets.groupBy("source").agg(F.when(known, F.sum("candidates")).alias("candidates"))


def resolve_headers(rows: DataFrame, tables: DataFrame, variants: DataFrame, start: dt.date = PERIOD_START, end: dt.date = PERIOD_END) -> DataFrame:
    """source, sheet, revision, verified: the newest known mapping of a table's header under which its extraction has no problem.

    Where none has, the newest one (not verified), which still tells how many rows there are to account for. Tables without a
    known mapping are left out. tables: source, sheet, signature. variants: signature, revision, layout, header_rows,
    data_start, columns, multiplier. Each table is extracted under each variant of its signature, as a sheet of its own.
    """
    met = tables.join(variants, "signature").withColumn("_trial", F.concat_ws("#", "sheet", "revision"))
    trial = met.select("source", F.col("_trial").alias("sheet"), "layout", "header_rows", "data_start", "columns", "multiplier")
    copies = rows.join(met.select("source", "sheet", "_trial"), ["source", "sheet"]).select("source", F.col("_trial").alias("sheet"), "row", "cells")
    _, found = extract_sheets(copies, trial, start, end)
    tried = met.select("source", "sheet", "revision", "_trial").join(found.select("source", F.col("sheet").alias("_trial"), "problem", "candidates"), ["source", "_trial"])
    sound = F.col("problem").isNull() & (F.col("candidates") > 0)
    best = F.max(F.struct(sound.alias("verified"), F.col("revision")))
    return tried.groupBy("source", "sheet").agg(best.alias("b")).select("source", "sheet", F.col("b.revision").alias("revision"), F.col("b.verified").alias("verified"))
