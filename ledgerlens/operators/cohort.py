"""Cohort retention by acquisition month.

The reference computes the first month per customer with a window over every
fact row (``MIN(ts) OVER (PARTITION BY customer)``): one task must hold all rows
of a customer, and one customer may hold a third of all rows.

Here each customer's active months are folded into a bit mask with
``bit_or`` -- a partial (map-side) aggregate, so a hot customer shrinks to one
row per map task before the single shuffle by customer. The first month is
the lowest set bit; each set bit is one (cohort, offset) cell. The mask needs
the span of months to be known and at most 63 (the reference uses one year).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.dates import month_index
from ..functions.numeric import pct_text


def cohort_cells(facts: DataFrame, user: str, ts: str, first_year: int, periods: int = 12,
                 null_users: str = "cohort") -> DataFrame:
    """(acquisition_index, subsequent_month, retained_users) where
    acquisition_index = months after January of ``first_year`` (0-based) of the
    customer's first active month, subsequent_month = month boundaries between
    the first month and an active month, retained_users = distinct customers.

    Rows without a customer count for no one, but can still make a cell, as in
    the reference's two formulations:

    - ``"cohort"`` (``MIN(ts) OVER (PARTITION BY customer)``): they form one
      group with its own first month, so their months appear as cells with 0
      customers when no real customer has them;
    - ``"join"`` (first month by GROUP BY, then a LEFT JOIN on the customer):
      their join never matches, giving one (NULL, NULL, 0) cell.
    """
    if not 1 <= periods <= 63:
        raise ValueError("periods must be within 1..63")
    if null_users not in ("cohort", "join"):
        raise ValueError("null_users must be 'cohort' or 'join'")
    start = first_year * 12
    mi = month_index(ts) - F.lit(start)
    checked = F.when((mi < 0) | (mi >= periods),
                     F.raise_error(F.lit(f"activity outside the {periods} months from {first_year}-01"))).otherwise(mi)
    masks = (facts.select(user, checked.cast("int").alias("_mi"))
             .groupBy(user).agg(F.expr("bit_or(shiftleft(1L, _mi))").alias("_mask")))
    first = F.expr("bit_count((_mask & -_mask) - 1)")
    months = F.expr(f"filter(sequence(0, {periods - 1}), i -> (_mask & shiftleft(1L, i)) != 0)")
    if null_users == "join":
        no_user = F.col(user).isNull()
        first = F.when(~no_user, first)
        months = F.when(no_user, F.array(F.lit(None).cast("int"))).otherwise(months)
    cells = masks.select(user, first.alias("acquisition_index"), F.explode(months).alias("_m"))
    return (cells.groupBy("acquisition_index", (F.col("_m") - F.col("acquisition_index")).alias("subsequent_month"))
            .agg(F.count(user).alias("retained_users")))


def cohort_with_base(cells: DataFrame, cohort: str = "acquisition_month") -> DataFrame:
    """Add ``original_users`` (FIRST_VALUE of the cohort's cells by offset: the
    offset-0 cell, as every first month is active) and ``pct_retained``.

    Taken with a window over the cells of the cohort (at most ``periods`` rows
    each), so the facts are aggregated once: joining the cells to a filtered
    copy of themselves would plan the whole fact pipeline a second time.
    """
    w = Window.partitionBy(cohort).orderBy(F.col("subsequent_month").asc_nulls_first())
    out = cells.withColumn("original_users", F.first("retained_users").over(w))
    return out.withColumn("pct_retained", pct_text("retained_users", "original_users"))


def retention_matrix(cells_pct: DataFrame, cohort: str = "acquisition_month", periods: int = 12,
                     value: str = "pct_retained") -> DataFrame:
    """Cohort x offset matrix: one column per offset ``"0"``..``"periods-1"``,
    NULL where a cohort has no customer in that month (``PIVOT(MIN(..))``)."""
    return (cells_pct.groupBy(cohort, "original_users")
            .pivot("subsequent_month", list(range(periods))).agg(F.min(value)))
