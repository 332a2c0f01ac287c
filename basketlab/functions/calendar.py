"""Calendar columns of a date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month, day and season names of the calendar dimension.
MONTH_NAMES = [
    "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio",
    "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre",
]
DAY_NAMES = ["Domingo", "Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado"]
SEASON_BY_QUARTER = ["Invierno", "Primavera", "Verano", "Otoño"]


def _pick(names: list[str], position: Column) -> Column:
    """Entry of a fixed list, counted from one."""
    return F.element_at(F.array(*[F.lit(n) for n in names]), position.cast("int"))


def date_key(date: Column) -> Column:
    """Whole number yyyymmdd."""
    return (F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)).cast("int")


def month_name(date: Column) -> Column:
    return _pick(MONTH_NAMES, F.month(date))


def day_name(date: Column) -> Column:
    """Day name; the week is counted from Sunday."""
    return _pick(DAY_NAMES, F.dayofweek(date))


def season(date: Column) -> Column:
    """Season by three-month groups that begin in December."""
    return _pick(SEASON_BY_QUARTER, F.floor(F.pmod(F.month(date), F.lit(12)) / 3) + 1)


def period(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM")


def is_weekend(date: Column) -> Column:
    return F.dayofweek(date).isin(1, 7).cast("int")


def monday_week(date: Column) -> Column:
    """Week number 0-53 with Monday weeks.

    Week 1 is the first week with four or more days in the year; earlier days are
    week 0, unlike the ISO week that gives them to the year before.
    """
    first = F.weekday(F.trunc(date, "YEAR"))
    shift = F.when(first >= 4, first - 7).otherwise(first)
    return (F.floor((F.dayofyear(date) - 1 + shift) / 7) + 1).cast("int")
