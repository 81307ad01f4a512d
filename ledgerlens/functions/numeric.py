"""Numeric recipes: integer averages, integer casts, exact ratio rounding, percent text.

Ratios are rounded with exact integer arithmetic (half away from zero, like
SQL Server's ROUND and .NET number formatting) so the result does not depend on
how an engine rounds a binary double. Inputs to the ratio helpers are column
NAMES of integral columns; they build Spark SQL's integral ``div``.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def int_avg(col: str) -> Column:
    """``AVG(int_col)`` in SQL Server: integer division of the sum by the count,
    truncated toward zero -- as Spark's ``div`` does. Spark's ``avg`` would
    return a double."""
    return F.expr(f"sum({_q(col)}) div count({_q(col)})")


def int_part(col) -> Column:
    """``CAST(x AS INT)`` of a numeric value: truncation toward zero."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c >= 0, F.floor(c)).otherwise(F.ceil(c)).cast("long")


def int_part_equals(col, n: int, round_money: bool = False) -> Column:
    """``CAST(x AS INT) = n`` as a range on the column itself, which reaches the parquet scan;
    with ``round_money`` the cast rounds half away from zero, as SQL Server does for MONEY."""
    c = F.col(col) if isinstance(col, str) else col
    if round_money:
        return (c > n - 0.5) & (c < n + 0.5) if n == 0 else (c >= n - 0.5) & (c < n + 0.5) if n > 0 else (c > n - 0.5) & (c <= n + 0.5)
    return (c > -1) & (c < 1) if n == 0 else (c >= n) & (c < n + 1) if n > 0 else (c > n - 1) & (c <= n)


def scaled_ratio_expr(num: str, den: str, scale: int) -> str:
    """SQL text for round_half_away(num * 10^scale / den) as an exact integer.

    Magnitudes are computed on DECIMAL(38,0), so large sums do not overflow;
    NULL when ``den`` is 0 or either side is NULL (SQL Server would raise on
    a zero divisor; see README).
    """
    k = 10 ** scale
    n, d = f"cast({_q(num)} as decimal(38,0))", f"cast({_q(den)} as decimal(38,0))"
    mag = f"((abs({n}) * {2 * k} + abs({d})) div (2 * abs({d})))"
    return (
        f"CASE WHEN {d} = 0 OR {d} IS NULL OR {n} IS NULL THEN NULL "
        f"WHEN ({n} < 0) <> ({d} < 0) THEN -{mag} ELSE {mag} END"
    )


def ratio(num: str, den: str, scale: int = 6, percent: bool = False) -> Column:
    """num/den (x100 if ``percent``) rounded half away from zero to ``scale`` digits, as double."""
    extra = 2 if percent else 0
    return F.expr(f"({scaled_ratio_expr(num, den, scale + extra)}) / {10 ** scale}D")


def pct_text(num: str, den: str) -> Column:
    """``FORMAT(1.0*num/den, 'p')``: percent with two decimals, thousands
    separators and no blank before '%' (en-US), e.g. '1,234.50%'."""
    h = scaled_ratio_expr(num, den, 4)  # hundredths of a percent
    return F.expr(
        f"CASE WHEN ({h}) IS NULL THEN NULL ELSE concat("
        f"CASE WHEN ({h}) < 0 THEN '-' ELSE '' END, "
        f"format_number(abs({h}) div 100, 0), '.', lpad(cast(abs({h}) % 100 as string), 2, '0'), '%') END"
    )


def decimal_text_pct(num: str, den: str) -> Column:
    """``LEFT(CAST(ROUND(100.0*num/den, 2) AS nvarchar), CHARINDEX('.', ..)+2) + '%'``:
    the rounded decimal printed with two decimals, no separators, e.g. '-5.00%'."""
    h = scaled_ratio_expr(num, den, 4)
    return F.expr(
        f"CASE WHEN ({h}) IS NULL THEN NULL ELSE concat("
        f"CASE WHEN ({h}) < 0 THEN '-' ELSE '' END, "
        f"cast(abs({h}) div 100 as string), '.', lpad(cast(abs({h}) % 100 as string), 2, '0'), '%') END"
    )
