"""Time-series reports over one row per period (month or week).

Inputs here are already aggregated to one row per period, so a window without
PARTITION BY (one task) holds at most a few hundred rows: the number of
periods, not the number of facts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.numeric import decimal_text_pct, pct_text


def index_to_base(df: DataFrame, value: str, base_filter: Column, base_out: str, pct_out: str) -> DataFrame:
    """Value of the base period and the percent change from it.

    Scalar-subquery semantics (NULL when no row matches, an error when more
    than one does), computed with a window over the per-period rows rather
    than a subquery: a subquery would plan the whole aggregation again.
    """
    everything = Window.partitionBy()          # one row per period: bounded
    hits = F.count(F.when(base_filter, F.lit(1))).over(everything)
    base = F.max(F.when(base_filter, F.col(value))).over(everything)
    out = df.withColumn(base_out, F.when(hits > 1, F.raise_error(
        F.lit("more than one row as the base of index_to_base"))).otherwise(base).cast(df.schema[value].dataType))
    out = out.withColumn("_delta", F.col(value) - F.col(base_out))
    return out.withColumn(pct_out, decimal_text_pct("_delta", base_out)).drop("_delta")


def running_total(df: DataFrame, partition: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """``SUM(value) OVER (PARTITION BY .. ORDER BY ..)``: default frame RANGE
    UNBOUNDED PRECEDING .. CURRENT ROW (peers share the value)."""
    w = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn(out, F.sum(value).over(w))


def moving_average(df: DataFrame, order: list[str], value: str, rows: int,
                   avg_out: str, count_out: str | None = None, integer: bool = True) -> DataFrame:
    """Integer AVG (SQL Server on an int column; a fraction with ``integer=False``) and COUNT over the current row
    and the ``rows - 1`` rows before it."""
    w = Window.orderBy(*order).rowsBetween(-(rows - 1), 0)
    s, c = F.sum(value).over(w), F.count(value).over(w)
    out = df.withColumn("_s", s).withColumn("_c", c).withColumn(avg_out, F.expr("_s div _c") if integer else F.col("_s") / F.col("_c"))
    if count_out:
        out = out.withColumn(count_out, F.col("_c"))
    return out.drop("_s", "_c")


def period_over_period(df: DataFrame, order: list[str], value: str, lag: int,
                       lag_out: str, pct_out: str) -> DataFrame:
    """``LAG(value, lag, value)``: the value ``lag`` rows back, the row's own
    value when that row does not exist (not when it is NULL), and the ratio
    as percent text. Pairs by row position, so a missing period shifts the
    pairing exactly as in the reference."""
    w = Window.orderBy(*order)
    q = "`" + value + "`"
    out = df.withColumn(lag_out, F.expr(f"lag({q}, {lag}, {q})").over(w))
    return out.withColumn(pct_out, pct_text(value, lag_out))


def first_value_of(df: DataFrame, value: str, order: list, out: str, partition: list[str] | None = None) -> DataFrame:
    """``FIRST_VALUE(value) OVER ([PARTITION BY ..] ORDER BY ..)``."""
    w = Window.partitionBy(*partition).orderBy(*order) if partition else Window.orderBy(*order)
    return df.withColumn(out, F.first(value).over(w))
