"""Time series: monthly trend, pivots, share of total, index, rolling windows, year over year."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.dates import mm_yy, us_week
from ..functions.text import ci_eq, ci_in, ci_key, concat_text, spelling
from ..operators.activity import active_periods, users_per_period
from ..operators.aggregate import pivot_count, row_shares
from ..operators.timeseries import index_to_base, moving_average, period_over_period, running_total
from ..sources import mapping as M
from ..sources import star



def _month():
    return F.month("transaction_time").alias("month")


def _year():
    return F.year("transaction_time").alias("year")


def _billing(spark: SparkSession, src: str, category: str | None = M.CATEGORY, subs=None) -> DataFrame:
    """UNION of both yearly facts, successful (status 1), joined to the
    scenario, filtered to a category and/or sub-categories."""
    f = star.fact_union(spark, src).where(F.col("status_id") == 1)
    s = star.dim_scenario(spark, src)
    if category is not None:
        s = s.where(ci_eq("category", category))
    if subs is not None:
        s = s.where(ci_in("sub_category", subs))
    return star.join_scenario(f, s)


def monthly_trend(spark: SparkSession, src: str) -> DataFrame:
    """Successful transactions of one category per month, both years (UNION of the facts)."""
    return (_billing(spark, src).groupBy(_month(), _year())
            .agg(F.count("transaction_id").alias("number_trans")).orderBy("year", "month"))


def monthly_trend_by_sub(spark: SparkSession, src: str) -> DataFrame:
    """The monthly trend per sub-category."""
    return _by_sub(spark, src).orderBy("year", "month")


def _by_sub(spark: SparkSession, src: str) -> DataFrame:
    """Transactions per month and sub-category, whose case variants are one."""
    return (_billing(spark, src).groupBy(_month(), _year(), ci_key("sub_category").alias("_sub"))
            .agg(spelling("sub_category").alias("sub_category"), F.count("transaction_id").alias("number_trans")).drop("_sub"))


def _pivot_source(spark: SparkSession, src: str) -> DataFrame:
    # GROUP BY month, year, sub_category, transaction_id without aggregates = DISTINCT
    return _billing(spark, src).select(_month(), _year(), ci_key("sub_category").alias("sub_category"), "transaction_id").distinct()


def monthly_pivot(spark: SparkSession, src: str, subs=M.SUB_CATEGORIES, names=M.SUB_CATEGORY_COLUMNS) -> DataFrame:
    """PIVOT (COUNT(transaction_id) FOR sub_category IN (..)): 0 for empty cells."""
    return pivot_count(_pivot_source(spark, src), ["month", "year"], "sub_category", list(subs),
                       "transaction_id", list(names), equals=ci_eq).select("month", "year", *names)


def monthly_pivot_case(spark: SparkSession, src: str, subs=M.SUB_CATEGORIES, names=M.SUB_CATEGORY_COLUMNS) -> DataFrame:
    """The same table by conditional sums over the per-sub-category counts:
    NULL (not 0) for empty cells, as ``SUM(CASE .. END)`` gives."""
    return _by_sub(spark, src).groupBy("month", "year").agg(*[
        F.sum(F.when(ci_eq("sub_category", s), F.col("number_trans"))).alias(n) for s, n in zip(subs, names)])


def monthly_share(spark: SparkSession, src: str) -> DataFrame:
    """Q23's pivot plus the row total and each column's percent of it."""
    p = monthly_pivot(spark, src)
    return row_shares(p, list(M.SUB_CATEGORY_COLUMNS), "total_trans_month")


def _periods(rows: DataFrame, index, each_year: int, out: str) -> DataFrame:
    """(year, _n, ``out``): distinct customers of each period of a year, ``index`` from 0 to ``each_year`` - 1."""
    n = (M.YEAR_B - M.YEAR_A + 1) * each_year
    active = active_periods(rows, "customer_id", (F.year("transaction_time") - M.YEAR_A) * each_year + index, n)
    t = users_per_period(active, "customer_id", n, out)
    return t.select(F.expr(f"cast({M.YEAR_A} + _period div {each_year} as int)").alias("year"),
                    F.expr(f"cast(_period % {each_year} + 1 as int)").alias("_n"), out)


def _monthly_customers(rows: DataFrame, out: str) -> DataFrame:
    return _periods(rows, F.month("transaction_time") - 1, 12, out).withColumnRenamed("_n", "month")


def index_to_first_month(spark: SparkSession, src: str, base_month: int = 1, base_year: int = M.YEAR_A) -> DataFrame:
    """Distinct customers per month (three sub-categories, no category filter),
    the base month's value and the percent change from it."""
    t = _monthly_customers(_billing(spark, src, category=None, subs=M.SUB_CATEGORIES), "number_trans").select("month", "year", "number_trans")
    return index_to_base(t, "number_trans", (F.col("month") == base_month) & (F.col("year") == base_year),
                         "starting_point", "pct_from_starting_point")


def month_year_labels(spark: SparkSession, src: str) -> DataFrame:
    """Distinct 'MM/yy' labels of year A's transactions, sorted as text."""
    f = star.fact_transactions(spark, src, (M.YEAR_A,))
    return f.select(mm_yy("transaction_time").alias("month_year")).distinct().orderBy("month_year")


def _weekly(spark: SparkSession, src: str) -> DataFrame:
    b = _billing(spark, src, category=M.CATEGORY, subs=M.SUB_CATEGORIES)
    weeks = _periods(b, us_week("transaction_time") - 1, 54, "number_customer").withColumnRenamed("_n", "week_number")
    return weeks.select("year", "week_number", concat_text("year", "week_number").alias("calendar"), "number_customer")


def weekly_running_customers(spark: SparkSession, src: str) -> DataFrame:
    """Distinct customers per (year, US week) and the running sum within the year."""
    w = running_total(_weekly(spark, src), ["year"], ["week_number"], "number_customer", "rolling_number")
    return w.orderBy("year", "week_number")


def weekly_moving_average(spark: SparkSession, src: str, rows: int = 4, value: str = "rolling_number") -> DataFrame:
    """Q29 plus the integer average of ``value`` (the RUNNING SUM, as written, or
    ``number_customer``) over the last 4 rows and the number of rows that average saw."""
    w = running_total(_weekly(spark, src), ["year"], ["week_number"], "number_customer", "rolling_number")
    return moving_average(w, ["year", "week_number"], value, rows, "moving_avg", "count_row")


def year_over_year(spark: SparkSession, src: str, lag: int = 12) -> DataFrame:
    """Distinct customers per month, the value 12 rows back (own value when
    there is no such row) and the ratio as percent text."""
    b = _billing(spark, src, category=M.CATEGORY, subs=M.SUB_CATEGORIES)
    t = _monthly_customers(b, "number_customer").select("year", "month", concat_text("year", "month").alias("calendar"), "number_customer")
    return period_over_period(t, ["year", "month"], "number_customer", lag, "last_period", "MOM").orderBy("year", "month")
