"""Payment behaviour: share of total, per-customer metrics, metric summary, histograms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions.numeric import ratio
from ..functions.text import ci_eq, ci_key, spelling
from ..operators.aggregate import (bin_by_width, bin_exact, histogram, metric_summary,
                                   plain_label, share_of_total, thousands_label)
from ..sources import mapping as M
from ..sources import star


def _successful(spark: SparkSession, src: str, type_literal: str | None = None) -> DataFrame:
    """Year-A facts LEFT JOIN scenario, LEFT JOIN status, WHERE status is success
    [AND type = literal]. The status predicate makes its join inner (Catalyst
    rewrites it too); the scenario join stays outer unless the type is tested,
    so a fact without a scenario keeps a NULL type group."""
    f = star.fact_transactions(spark, src, (M.YEAR_A,))
    s = star.dim_scenario(spark, src)
    st = star.dim_status(spark).where(ci_eq("status_description", M.STATUS_SUCCESS))
    j = star.join_scenario(f, s, "left").join(st, "status_id", "inner")
    if type_literal is not None:
        j = j.where(ci_eq("transaction_type", type_literal))
    return j


def share_by_type_top5(spark: SparkSession, src: str, top: int = 5, denom: str = "all") -> DataFrame:
    """Per type: distinct successful transactions and their percent of the year's
    fact rows; top 5. ``denom="all"`` counts rows of any status, as the reference's
    scalar subquery does, ``denom="successful"`` only the successful ones, as its
    comment says. One aggregate of the facts by scenario and transaction, which a hot
    scenario cannot skew, serves both: it is exchanged once, the rows are counted from it
    before any join (a scenario that occurs twice doesn't change the share), and the
    status is a count in it rather than a filter, which would go below it and split the scan.
    """
    if denom not in ("all", "successful"):
        raise ValueError("denom is 'all' or 'successful'")
    status = star.dim_status(spark).select("status_id", ci_eq("status_description", M.STATUS_SUCCESS).alias("_ok"))
    f = star.fact_transactions(spark, src, (M.YEAR_A,)).join(status, "status_id", "left")
    keys = [c for c in ("scenario_id", "transaction_id", "salt") if c in f.columns]
    held = f.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), F.count_if("_ok").alias("_good"))
    total = held.agg(F.struct(F.sum("_rows").alias("all"), F.sum("_good").alias("successful"))).scalar()
    good = held.where((F.col("_good") > 0) & (F.col("_rows") > 0))      # both counts, so that the exchange is the same
    g = (star.join_scenario(good, star.dim_scenario(spark, src), "left").groupBy(ci_key("transaction_type").alias("_type"), "transaction_id")
         .agg(spelling("transaction_type").alias("transaction_type")))       # one row for each distinct id of a type
    g = (g.groupBy("_type").agg(spelling("transaction_type").alias("transaction_type"), F.count("transaction_id").alias("num_of_trans"))
         .withColumn("_total", total.getField(denom)))
    g = g.select("transaction_type", "num_of_trans",
                 ratio("num_of_trans", "_total", scale=6, percent=True).alias("percentage"))
    return g.orderBy(F.col("percentage").desc(), F.col("transaction_type").asc_nulls_first()).limit(top)


def share_of_category_in_type(spark: SparkSession, src: str) -> DataFrame:
    """Per (type, category): count, the type's count, percent. The type totals
    are summed from the (type, category) counts -- one pass over the facts
    where the reference aggregates them twice; a NULL type finds no total
    (its LEFT JOIN key never matches), as in the reference."""
    tc = (_successful(spark, src).groupBy(ci_key("transaction_type").alias("_type"), ci_key("category"))
          .agg(spelling("transaction_type").alias("transaction_type"), spelling("category").alias("category"),
               F.count(F.lit(1)).alias("num_of_trans")))
    # type totals by a window over the (type, category) counts -- a handful of
    # rows per type -- instead of joining the counts to an aggregate of
    # themselves, which would run the fact pipeline twice
    total = F.sum("num_of_trans").over(Window.partitionBy("_type"))
    j = tc.withColumn("total_count", F.when(F.col("transaction_type").isNotNull(), total))
    return share_of_total(j, "num_of_trans", "total_count", "percentage").select(
        "transaction_type", "category", "num_of_trans", "total_count", "percentage")


def _customer_metrics(spark: SparkSession, src: str) -> DataFrame:
    """Rows collapse to one per (customer, scenario, type, category) before the distinct counts,
    which then expand far fewer rows."""
    j = _successful(spark, src, M.TYPE_LITERAL_LOWER).groupBy(
        "customer_id", "scenario_id", ci_key("transaction_type").alias("transaction_type"), ci_key("category").alias("category")).agg(
        F.count("transaction_id").alias("_n"), F.sum("charged_amount").alias("_amount"))
    return j.groupBy("customer_id").agg(
        F.sum("_n").alias("number_trans"),
        F.count_distinct("scenario_id").alias("number_scenarios"),
        F.count_distinct("transaction_type").alias("number_types"),
        F.count_distinct("category").alias("number_categories"),
        F.sum("_amount").alias("total_amount"),
    )


def top_customers_metrics(spark: SparkSession, src: str, top: int = 10) -> DataFrame:
    """Per customer: count, three distinct counts, amount; top 10 by count
    (customer id breaks ties)."""
    return _customer_metrics(spark, src).orderBy(F.col("number_trans").desc(), F.col("customer_id").asc()).limit(top)


def metric_summary_report(spark: SparkSession, src: str) -> DataFrame:
    """min / max / average of four per-customer metrics, one row each."""
    # fixed values: the labels of the report
    return metric_summary(_customer_metrics(spark, src), [
        ("The number of transactions", "number_trans", "int"),
        ("The number of payment scenarios", "number_scenarios", "int"),
        ("The number of payment categories", "number_categories", "int"),
        ("The total charge amount", "total_amount", "exact"),
    ])


def _per_customer(spark: SparkSession, src: str, measure) -> DataFrame:
    return _successful(spark, src, M.TYPE_LITERAL_LOWER).groupBy("customer_id").agg(measure)


def hist_amount(spark: SparkSession, src: str, width: int = M.AMOUNT_BIN_WIDTH, bins: int = M.BIN_COUNT) -> DataFrame:
    """Customers per total-amount bin (ten bins of fixed width, then an open last bin)."""
    t = _per_customer(spark, src, F.sum("charged_amount").alias("total_amount"))
    t = t.withColumn("charge_amount_range", bin_by_width("total_amount", width, bins, thousands_label))
    return histogram(t, "charge_amount_range", "customer_id")


def hist_trans(spark: SparkSession, src: str, width: int = M.COUNT_BIN_WIDTH, bins: int = M.BIN_COUNT) -> DataFrame:
    """Customers per transaction-count bin (ten bins of fixed width, then an open last bin)."""
    t = _per_customer(spark, src, F.count("transaction_id").alias("number_trans"))
    t = t.withColumn("number_trans_range", bin_by_width("number_trans", width, bins, plain_label))
    return histogram(t, "number_trans_range", "customer_id")


def hist_categories(spark: SparkSession, src: str, n: int = M.CATEGORY_BINS, distinct: bool = False) -> DataFrame:
    """COUNT(category) (not distinct, as written, unless asked for) binned 1..n, else NULL."""
    count = F.count_distinct if distinct else F.count
    t = _per_customer(spark, src, count("category").alias("number_categories"))
    t = t.withColumn("number_categories_range", bin_exact("number_categories", n))
    return histogram(t, "number_categories_range", "customer_id")


def hist_scenarios(spark: SparkSession, src: str, n: int = M.SCENARIO_BINS, distinct: bool = False) -> DataFrame:
    """COUNT(scenario_id) per customer (distinct if asked for) binned 1..n, else NULL; customers per bin."""
    count = F.count_distinct if distinct else F.count
    t = _per_customer(spark, src, count("scenario_id").alias("number_scenarios"))
    t = t.withColumn("number_scenarios_range", bin_exact("number_scenarios", n))
    return histogram(t, "number_scenarios_range", "customer_id")
