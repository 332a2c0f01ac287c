"""Money, rounding and the texts that show amounts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PRICE = "decimal(10,2)"
# Wide enough for a ticket that holds a large share of all lines.
AMOUNT = "decimal(20,2)"
METRIC_SCALE = 6


def parse_price(value: Column) -> Column:
    """Text or number to two-decimal money, half up; NULL when it is no price.

    Dollar signs, thousands commas and blanks around the number are ignored.
    """
    cleaned = F.regexp_replace(value.cast("string"), r"[$,]|^\s+|\s+$", "")
    return F.round(cleaned.try_cast("decimal(38,18)"), 2).try_cast(PRICE)


def line_total(unit_price: Column, quantity: Column) -> Column:
    """Unit price times quantity, half up to cents."""
    exact = unit_price.cast("decimal(14,4)") * quantity.cast("decimal(12,0)")
    return F.round(exact, 2).cast(PRICE)


def metric(value: Column) -> Column:
    """A ratio as it is stored: rounded to six decimals before anything reads it."""
    return F.round(value, METRIC_SCALE)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Floating division that gives NULL for a zero denominator."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def cents_text(value: Column) -> Column:
    """Amount as text with exactly two decimals."""
    return F.round(value, 2).cast("decimal(20,2)").cast("string")


# Fixed texts: readers of the result tables match on these words.
TICKET_PREFIX = "Ticket con valor "
TICKET_MIDDLE = " vs promedio "
BUYERS_PREFIX = "Clientes que compran "
BUYERS_MIDDLE = " también compran "


def ticket_message(total: Column, average: Column) -> Column:
    return F.concat(F.lit(TICKET_PREFIX), cents_text(total), F.lit(TICKET_MIDDLE), cents_text(average))


def buyers_message(trigger: Column, recommended: Column) -> Column:
    return F.concat(F.lit(BUYERS_PREFIX), trigger, F.lit(BUYERS_MIDDLE), recommended)
