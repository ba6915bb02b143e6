"""Amounts: parsing, formatting, and model costs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

AMOUNT = "decimal(38,6)"


def parse_amount(text: Column) -> Column:
    """Decimal of an amount text: commas, spaces and 원 are dropped, △ and ▲ mean minus; null unless plainly numeric."""
    raw = F.translate(F.regexp_replace(text, r"(?U)[\s,원]", ""), "△▲", "--")
    return F.when(raw.rlike(r"^-?[0-9]+(\.[0-9]+)?$"), raw.try_cast(AMOUNT))


def parse_amount_cell(kind: Column, string: Column, number: Column) -> Column:
    """Decimal of a sheet cell; null for moments."""
    return F.when(kind == "double", number.try_cast(AMOUNT)).when(kind == "string", parse_amount(string))


def count_in(cells: Column) -> Column:
    """The number of the first cell that is a count (`12건`); null if none."""
    counts = F.filter(cells, lambda c: c.rlike(r"(?U)^\d+\s*건$"))
    return F.regexp_extract(F.try_element_at(counts, F.lit(1)), r"^(\d+)", 1).try_cast("int")


def format_won(amount: Column) -> Column:
    return F.concat(F.format_number(amount, 0), F.lit("원"))


def token_cost(input_tokens: Column, output_tokens: Column, input_price: str, output_price: str) -> Column:
    """USD of a call at prices for a million tokens."""
    price = lambda p: F.lit(p).cast("decimal(18,9)")
    return ((input_tokens * price(input_price) + output_tokens * price(output_price)) / F.lit(1_000_000)).cast("decimal(18,9)")


def token_ceiling(prompt: Column, most_output: int, input_price: str, output_price: str) -> Column:
    """The most that a call can cost: a prompt has at most a token for each character, an answer its limit."""
    return token_cost(F.length(prompt), F.lit(most_output), input_price, output_price)


def half_up(value: Column) -> Column:
    """Rounding half up towards infinity."""
    return F.floor(value + 0.5)
