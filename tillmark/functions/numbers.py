"""Decimal parsing and number display."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillmark.functions import exact
from tillmark.functions.text import stripped

PRICE = "decimal(18,4)"
AMOUNT = "decimal(20,4)"


def parse_number(value: Column) -> Column:
    """The number in any cell, of any length, as :mod:`tillmark.functions.exact` has it; NULL when blank or none."""
    return exact.number(stripped(value))


def without_fraction(number: Column) -> Column:
    """The whole part as bigint, NULL where it does not fit."""
    def whole(x: Column) -> Column:
        place = F.greatest(F.least(x["place"], F.lit(20)), F.lit(0)).cast("int")
        digits = F.when(place == 0, "0").otherwise(F.rpad(F.left(x["digits"], place), place, "0"))
        return F.concat(F.when(x["sign"] < 0, "-").otherwise(""), digits).try_cast("bigint")

    return exact.once(number, whole)


def quantity_value(number: Column) -> Column:
    """A whole quantity."""
    return F.when(exact.is_whole(number), without_fraction(number))


def quantity_issue(number: Column) -> Column:
    """Reject code for a parsed quantity; NULL when it is a whole number."""
    return quantity_code(without_fraction(number), exact.is_whole(number))


def quantity_code(whole_part: Column, is_whole: Column) -> Column:
    return F.when(whole_part.isNull(), "quantity_invalid").when(~is_whole, "quantity_not_integral")


def unit_price_issue(number: Column) -> Column:
    """Reject code for a parsed price; NULL when it is zero or more."""
    return unit_price_code(rounded_price(number), number["sign"])


def unit_price_code(price: Column, sign: Column) -> Column:
    return F.when(price.isNull(), "unit_price_invalid").when(sign < 0, "unit_price_negative")


def rounded_price(number: Column) -> Column:
    """Two decimals, ties to even."""
    return F.try_multiply(exact.half_even(number, 2), F.lit(Decimal("0.01"))).try_cast(PRICE)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division in double; NULL when the denominator is zero or NULL."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def relative_change(current: Column, base: Column) -> Column:
    """(current - base) / base; NULL without a usable base."""
    return ratio(current - base, base)


def decimal_text(number: Column, null_as: str | None = None) -> Column:
    """Fixed-point text without trailing zeros but with two decimals at least."""
    plain = number.cast("string")
    shape = r"^(-?[0-9]+)(?:[.]([0-9]*?)0*)?$"
    whole, fraction = F.regexp_extract(plain, shape, 1), F.regexp_extract(plain, shape, 2)
    padded = F.when(F.length(fraction) < 2, F.rpad(fraction, 2, "0")).otherwise(fraction)
    text = F.concat(whole, F.lit("."), padded)
    return text if null_as is None else F.coalesce(text, F.lit(null_as))


def money_display(number: Column) -> Column:
    """Pounds with thousands separators; the sign goes before the symbol."""
    return F.concat(F.when(number < 0, "-").otherwise(""), F.lit("£"), F.format_number(F.abs(number), 2))


def count_display(number: Column) -> Column:
    return number.cast("bigint").cast("string")


def percent_display(number: Column) -> Column:
    """Percent with two decimals, no thousands separator."""
    return F.when(number.isNotNull(), F.concat(F.format_string("%.2f", number * 100), F.lit("%")))


def blank_display(text: Column) -> Column:
    """What a report shows for a comparison that does not exist."""
    return F.coalesce(text, F.lit("--"))
