"""Cohort retention of year A's successful customers.

The reference writes each report two ways (per-row window with DATEDIFF, or
first month by GROUP BY + join). On one calendar year both give the same
cells: the first active month of a customer is both MIN(MONTH(ts)) and
MONTH(MIN(ts)), and DATEDIFF(month, first, ts) is the month-number difference.
All six reports build on one operator (``cohort_cells``), which folds each
customer's active months into a bit mask in a single partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.numeric import pct_text
from ..functions.text import ci_in
from ..operators.cohort import cohort_cells, cohort_with_base
from ..operators.cohort import retention_matrix as pivot_matrix
from ..operators.timeseries import first_value_of
from ..sources import mapping as M
from ..sources import star

PERIODS = 12


def _cells(spark: SparkSession, src: str, null_users: str = "cohort",
           sub_categories=M.COHORT_SUB_CATEGORIES) -> DataFrame:
    """Cohort cells; ``null_users`` follows the formulation being rebuilt
    ("cohort" = per-row window, "join" = GROUP BY + LEFT JOIN). Only scenarios of the
    given sub-categories count, all with None."""
    f = star.fact_transactions(spark, src, (M.YEAR_A,)).where(F.col("status_id") == 1)
    s = star.dim_scenario(spark, src)
    if sub_categories is not None:
        s = s.where(ci_in("sub_category", sub_categories))
    facts = star.join_scenario(f, s)
    c = cohort_cells(facts, "customer_id", "transaction_time", M.YEAR_A, PERIODS, null_users=null_users)
    return c.select((F.col("acquisition_index") + 1).alias("acquisition_month"), "subsequent_month", "retained_users")


def retention_first_cohort(spark: SparkSession, src: str, cohort_month: int = 1,
                           sub_categories=M.COHORT_SUB_CATEGORIES) -> DataFrame:
    """Customers whose first month is January: distinct customers per month offset."""
    c = _cells(spark, src, sub_categories=sub_categories)
    return (c.where(F.col("acquisition_month") == cohort_month)
            .select("subsequent_month", "retained_users").orderBy("subsequent_month"))


def retention_first_cohort_pct(spark: SparkSession, src: str, cohort_month: int = 1,
                               sub_categories=M.COHORT_SUB_CATEGORIES) -> DataFrame:
    """Q32 plus the cohort size (FIRST_VALUE by offset) and the retained percent."""
    r = retention_first_cohort(spark, src, cohort_month, sub_categories)
    r = first_value_of(r, "retained_users", ["subsequent_month"], "original_users")
    return r.withColumn("pct_retained_users", pct_text("retained_users", "original_users"))


def retention_all_cohorts_join(spark: SparkSession, src: str, sub_categories=M.COHORT_SUB_CATEGORIES) -> DataFrame:
    """All cohorts; ``FIRST_VALUE(..) OVER (ORDER BY acquisition_month)`` without
    PARTITION BY, as written: every cell is divided by ONE value, the first
    cohort's offset-0 cell (offset breaks the reference's tie)."""
    cells = _cells(spark, src, "join", sub_categories)
    c = first_value_of(cells, "retained_users", [F.col("acquisition_month").asc_nulls_first(),
                                                  F.col("subsequent_month").asc_nulls_first()], "original_users")
    return c.withColumn("pct_retained", pct_text("retained_users", "original_users"))


def retention_all_cohorts(spark: SparkSession, src: str, sub_categories=M.COHORT_SUB_CATEGORIES) -> DataFrame:
    """All cohorts, each divided by its own offset-0 size."""
    c = cohort_with_base(_cells(spark, src, sub_categories=sub_categories))
    return c.withColumnRenamed("pct_retained", "pct_retained_users").select(
        "acquisition_month", "subsequent_month", "retained_users", "original_users", "pct_retained_users")


def retention_matrix_join(spark: SparkSession, src: str, sub_categories=M.COHORT_SUB_CATEGORIES) -> DataFrame:
    """Cohort x offset 0..11 matrix of retained percents (the reference's
    twelve LEFT JOINs of one CTE, here one pivot of the same cells)."""
    return pivot_matrix(cohort_with_base(_cells(spark, src, "join", sub_categories)), periods=PERIODS)


def retention_matrix(spark: SparkSession, src: str, sub_categories=M.COHORT_SUB_CATEGORIES) -> DataFrame:
    """The same matrix written with PIVOT (MIN(pct) FOR offset IN (0..11))."""
    c = cohort_with_base(_cells(spark, src, sub_categories=sub_categories))
    return (c.groupBy("acquisition_month", "original_users")
            .pivot("subsequent_month", list(range(PERIODS))).agg(F.min("pct_retained")))
