"""Transaction reports: star joins with date, type, channel and platform filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import ci_eq, ci_ne
from ..operators.relational import bloom_filter, semi_join
from ..sources import mapping as M
from ..sources import star

REPORT_COLUMNS = ("customer_id", "transaction_id", "scenario_id", "transaction_type", "sub_category", "category")


def transactions_not_type(spark: SparkSession, src: str, month: int = 1,
                          type_literal: str = M.TYPE_LITERAL_CAPITALISED) -> DataFrame:
    """Fact rows of one month whose type is not the given one (NULL types drop)."""
    f = star.fact_transactions(spark, src, (M.YEAR_A,), months=(month,))
    s = star.dim_scenario(spark, src)
    return star.join_scenario(f, s).where(ci_ne("transaction_type", type_literal)).select(*REPORT_COLUMNS)


def transactions_by_channel(spark: SparkSession, src: str, months=(1, 6), category: str = M.CATEGORY,
                            method: str = M.PAYMENT_METHOD) -> DataFrame:
    """Months ``BETWEEN`` the bounds, one category, one payment method."""
    f = star.fact_transactions(spark, src, (M.YEAR_A,), months=tuple(range(months[0], months[1] + 1)))
    s = star.dim_scenario(spark, src).where(ci_eq("category", category))
    pc = star.dim_payment_channel(spark, src, (M.YEAR_A,), tuple(range(months[0], months[1] + 1))).where(ci_eq("payment_method", method))
    return star.join_scenario(f, s).join(pc, "payment_channel_id").select(*REPORT_COLUMNS)


def transactions_two_januaries(spark: SparkSession, src: str, platform: str = M.PLATFORM) -> DataFrame:
    """January of both years (UNION of the yearly facts), one platform."""
    f = star.fact_union(spark, src, (M.YEAR_A, M.YEAR_B), months=(1,))
    s = star.dim_scenario(spark, src)
    p = star.dim_platform(spark).where(ci_eq("payment_platform", platform))
    return star.join_scenario(f, s).join(p, "platform_id").select(*REPORT_COLUMNS)


def returning_customer_transactions(spark: SparkSession, src: str, platform: str = M.PLATFORM) -> DataFrame:
    """January rows of year A on a platform, for customers also active in
    January of year B (``customer_id IN (subquery)`` = left semi join).

    Both Januaries are read by one scan and folded by customer, scenario and transaction
    into two counts: rows of the earlier January on the platform, rows of the later one.
    This is exchanged once and read by both sides; a customer with very many rows is
    spread by transaction. The later customers' Bloom filter thins the earlier rows
    before the join; a row that occurs n times comes out n times."""
    f = star.fact_transactions(spark, src, (M.YEAR_A, M.YEAR_B), months=(1,))
    on = star.dim_platform(spark).select("platform_id", ci_eq("payment_platform", platform).alias("_on"))
    keys = [c for c in ("customer_id", "scenario_id", "transaction_id", "salt") if c in f.columns]
    earlier = F.year("transaction_time") == M.YEAR_A
    held = f.join(on, "platform_id", "left").groupBy(*keys).agg(
        F.count_if(earlier & F.col("_on")).alias("_rows"), F.count_if(~earlier).alias("_later"))
    # Keys are taken with a count: the joins' IS NOT NULL then stays above the aggregate, which both sides share.
    rows = held.where((F.col("_rows") > 0) & (F.col("_later") >= 0)).select(
        *[F.when(F.col("_rows") > 0, F.col(c)).alias(c) for c in keys], "_rows")
    later = held.where((F.col("_later") > 0) & (F.col("_rows") >= 0)).select(
        F.when(F.col("_later") > 0, F.col("customer_id")).alias("customer_id")).distinct()
    rows = bloom_filter(rows, later, "customer_id", "customer_id")
    j = star.join_scenario(semi_join(rows, later, "customer_id"), star.dim_scenario(spark, src))
    return j.withColumn("_one", F.explode(F.expr("array_repeat(0, cast(_rows as int))"))).select(*REPORT_COLUMNS)
