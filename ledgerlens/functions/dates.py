"""Date recipes with the reference's (SQL Server) semantics.

All return built-in Column expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ts_ntz(text: str) -> Column:
    """A timestamp_ntz literal (the test tables store zone-less timestamps)."""
    return F.expr(f"TIMESTAMP_NTZ'{text} 00:00:00'" if len(text) == 10 else f"TIMESTAMP_NTZ'{text}'")


def date_lit(text: str) -> Column:
    return F.expr(f"DATE'{text}'")


def month_index(ts) -> Column:
    """Months since year 0: year*12 + month - 1. Monotone in ``ts``."""
    ts = _c(ts)
    return F.year(ts) * 12 + F.month(ts) - 1


def month_boundaries(start, end) -> Column:
    """``DATEDIFF(month, start, end)``: month boundaries crossed, not elapsed months.

    Jan 31 -> Feb 1 is 1; Spark's ``months_between`` would give a fraction.
    """
    return month_index(end) - month_index(start)


def day_boundaries(start, end) -> Column:
    """``DATEDIFF(day, start, end)``: midnights crossed."""
    return F.date_diff(_c(end).cast("date"), _c(start).cast("date"))


def us_week(d) -> Column:
    """``DATEPART(week, d)`` with the US default: week 1 holds Jan 1, weeks start Sunday.

    Differs from ISO ``weekofyear`` (Jan 1 2022 is ISO week 52, US week 1) and
    can reach 54 (2000-12-31).
    """
    d = _c(d).cast("date")
    jan1 = F.trunc(d, "year")
    # dayofweek: Sunday = 1 .. Saturday = 7
    return F.floor((F.dayofyear(d) + F.dayofweek(jan1) - 2) / 7).cast("int") + 1


def mm_yy(ts) -> Column:
    """Month and year as a label of five characters, two digits each: '03/97'."""
    return F.date_format(_c(ts), "MM/yy")


def literal_day_text(ts) -> Column:
    """``FORMAT(ts, 'yy.mm.dd')``: in .NET patterns ``mm`` is MINUTES, kept as written."""
    return F.date_format(_c(ts), "yy.mm.dd")
