"""Date keys, calendar parts and bounded date arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bazaarlake.contract import DAY_NAMES, MONTH_NAMES


def date_key(day: Column) -> Column:
    """YYYYMMDD as an int, by arithmetic."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def month_of_key(key: Column) -> Column:
    """YYYYMM of a YYYYMMDD key."""
    return F.floor(key / F.lit(100)).cast("int")


def weekday_number(day: Column, monday_zero: bool = False) -> Column:
    """1 = Sunday .. 7 = Saturday, or 0 = Monday .. 6 = Sunday."""
    return F.weekday(day) if monday_zero else F.dayofweek(day)


def _pick(names: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), index)


def day_name(day: Column, locale: str = "en") -> Column:
    return _pick(DAY_NAMES[locale], F.weekday(day) + 1)


def month_name(day: Column, locale: str = "en") -> Column:
    return _pick(MONTH_NAMES[locale], F.month(day))


def half_year(day: Column) -> Column:
    return F.when(F.month(day) <= 6, 1).otherwise(2)


def is_weekend(day: Column) -> Column:
    return F.weekday(day) >= 5


def is_holiday(day: Column, holidays: list[str]) -> Column:
    if not holidays:
        return F.lit(False)
    return day.isin(*[F.lit(h).cast("date") for h in holidays])


def is_working_day(day: Column, holidays: list[str]) -> Column:
    return ~is_weekend(day) & ~is_holiday(day, holidays)


def capped_date(day: Column, days: Column | int, latest: Column | str) -> Column:
    """``day`` plus ``days``, no later than ``latest``."""
    limit = F.lit(latest).cast("date") if isinstance(latest, str) else latest
    return F.least(F.date_add(day, days), limit)


def expected_delivery(ordered: Column, lead_days: Column) -> Column:
    return F.date_add(ordered, lead_days)
