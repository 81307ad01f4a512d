"""Grouped reports: shares of a total, binning, histograms, metric summaries, pivots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import int_avg, pct_text, ratio


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def plain_label(lo: int, hi: int | None) -> str:
    return f"> {lo}" if hi is None else f"{lo}-{hi}"


def thousands_label(lo: int, hi: int | None) -> str:
    """'0K-25K', ..., '> 250K' (the reference's amount bins read '0M-1M' .. '> 10M')."""
    def k(v: int) -> str:
        return f"{v // 1000}K" if v % 1000 == 0 else str(v)
    return f"> {k(lo)}" if hi is None else f"{k(lo)}-{k(hi)}"


def bin_by_width(value, width: int, bins: int, label=plain_label) -> Column:
    """Label of the bin holding ``value``: everything below ``width`` in the first
    bin (negatives too), ``[i*width, (i+1)*width)`` after it, ``>= bins*width``
    in the open last bin; NULL stays NULL (CASE without ELSE)."""
    v = _c(value)
    idx = F.least(F.greatest(F.floor(v / F.lit(width)), F.lit(0)), F.lit(bins)).cast("int")
    labels = [label(i * width, (i + 1) * width) for i in range(bins)] + [label(bins * width, None)]
    arr = F.array(*[F.lit(s) for s in labels])
    return F.when(v.isNotNull(), F.element_at(arr, idx + 1))


def bin_exact(value, n: int) -> Column:
    """``CASE WHEN v = 1 THEN 1 ... WHEN v = n THEN n END``."""
    v = _c(value)
    return F.when(v.between(1, n), v)


def histogram(df: DataFrame, bin_col: str, key: str, out: str = "number_customers") -> DataFrame:
    """Rows per bin (``COUNT(key)``), the NULL bin kept."""
    return df.groupBy(bin_col).agg(F.count(key).alias(out))


def share_of_total(df: DataFrame, part: str, total: str, out: str = "percentage", scale: int = 6) -> DataFrame:
    """``part*100.0/total`` rounded half away from zero to ``scale`` digits."""
    return df.withColumn(out, ratio(part, total, scale=scale, percent=True))


def metric_summary(df: DataFrame, metrics: list[tuple[str, str, str]]) -> DataFrame:
    """One row per metric: (metric, min_value, max_value, avg_value).

    ``metrics`` = [(label, column, "int" | "exact")]: "int" is SQL Server's
    integer AVG, "exact" the mean of ``1.0*column`` (6 decimals). All
    aggregates come from ONE pass over ``df``; the rows are then produced by
    ``stack`` (the reference reads its CTE four times through a UNION).
    """
    aggs = []
    for i, (_, col, kind) in enumerate(metrics):
        aggs += [F.min(col).alias(f"_mn{i}"), F.max(col).alias(f"_mx{i}")]
        if kind == "int":
            aggs.append(int_avg(col).cast("double").alias(f"_a{i}"))
        else:
            aggs += [F.sum(col).alias(f"_s{i}"), F.count(col).alias(f"_c{i}")]
    one = df.agg(*aggs)
    exact = [ratio(f"_s{i}", f"_c{i}", scale=6).alias(f"_a{i}")
             for i, (_, _, kind) in enumerate(metrics) if kind != "int"]
    one = one.select("*", *exact)
    parts = ", ".join(
        f"'{label}', cast(_mn{i} as bigint), cast(_mx{i} as bigint), _a{i}"
        for i, (label, _, _) in enumerate(metrics))
    return one.selectExpr(f"stack({len(metrics)}, {parts}) as (metric, min_value, max_value, avg_value)")


def pivot_count(df: DataFrame, rows: list[str], on: str, values: list, id_col: str,
                names: list[str] | None = None, equals=None) -> DataFrame:
    """``PIVOT (COUNT(id) FOR on IN (values))``, grouped by ``rows``.

    One conditional count per value in a single aggregation (partial
    aggregation, one shuffle); ``groupBy().pivot()`` would aggregate twice and
    leave NULL where SQL Server's PIVOT COUNT gives 0. Groups whose rows have
    none of the values are kept with zeros, as PIVOT keeps them. ``equals``
    (column, value) -> predicate compares under a collation (default: exact)."""
    names = names or [str(v) for v in values]
    eq = equals or (lambda c, v: F.col(c) == F.lit(v))
    return df.groupBy(*rows).agg(*[
        F.count(F.when(eq(on, v), F.col(id_col))).alias(n) for v, n in zip(values, names)])


def row_shares(df: DataFrame, cols: list[str], total: str) -> DataFrame:
    """Row total of ``cols`` and each column's share as percent text."""
    out = df.withColumn(total, sum((F.col(c) for c in cols[1:]), F.col(cols[0])))
    return out.select("*", *[pct_text(c, total).alias(f"{c}_pct") for c in cols])


__all__ = [
    "bin_by_width", "bin_exact", "histogram", "share_of_total", "metric_summary",
    "pivot_count", "row_shares", "plain_label", "thousands_label",
]
