"""RFM (recency, frequency, monetary) customer segmentation."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.dates import date_lit, day_boundaries, literal_day_text
from ..functions.text import concat_text, like

# --- fixed values: segment rules, first match wins (order matters) ----------
# (segment, pattern on the three-digit code r_score f_score m_score)
SEGMENT_RULES = (
    ("Best Customers", "111"),
    ("Lost Bad Customers", "[3-4][3-4][1-4]"),
    ("Lost Customers", "[3-4]2[1-4]"),
    ("Almost Lost", "21[1-4]"),
    ("Loyal Customers", "11[2-4]"),
    ("Big Spenders", "[1-2][1-3]1"),
    ("New Customers", "[1-2]4[1-4]"),
    ("Hibernating", "[3-4]1[1-4]"),
    ("Potential Loyalists", "[1-2][2-3][2-4]"),
)
OTHER_SEGMENT = "unknown"
SCORE_CUTS = (0.75, 0.5, 0.25)   # strict '>' -> scores 4, 3, 2; else 1
SCORE_SHARES = (Fraction(1, 4), Fraction(1, 2), Fraction(3, 4))


def rfm_metrics(facts: DataFrame, user: str, ts: str, amount: str, as_of: str, calendar: bool = False) -> DataFrame:
    """Per customer: days from the last activity to ``as_of``, distinct
    'yy.mm.dd' texts (``mm`` = minutes, as the reference writes it; calendar
    days with ``calendar``), and the amount total."""
    return facts.groupBy(user).agg(
        day_boundaries(F.max(ts), date_lit(as_of)).alias("recency"),
        F.count_distinct(F.to_date(ts) if calendar else literal_day_text(F.col(ts))).alias("frequency"),
        F.sum(amount).alias("monetary"),
    )


def percent_ranks(df: DataFrame, specs: list[tuple[str, bool, str]]) -> DataFrame:
    """Add ``PERCENT_RANK() OVER (ORDER BY col [DESC])`` for each (col, desc, out): the whole table
    in one task, for tables that fit one. Scores of large ones come from ``cuts.cut_values``."""
    for col, desc, name in specs:
        df = df.withColumn(name, F.percent_rank().over(Window.orderBy(F.col(col).desc() if desc else F.col(col).asc())))
    return df


def quartile_score(pr) -> Column:
    c = F.col(pr) if isinstance(pr, str) else pr
    a, b, d = SCORE_CUTS
    return F.when(c > a, 4).when(c > b, 3).when(c > d, 2).otherwise(1)


def rfm_segment(r, f, m) -> Column:
    """Segment label of the code CONCAT(r, f, m), rules in order."""
    code = concat_text(r, f, m)
    expr = None
    for name, pattern in SEGMENT_RULES:
        cond = like(code, pattern, case_insensitive=False)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(OTHER_SEGMENT))
