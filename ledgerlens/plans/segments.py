"""RFM segmentation of successful customers over both years."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions.numeric import pct_text
from ..functions.text import ci_in
from ..operators.cuts import ascending, cut_values, score
from ..operators.rfm import SCORE_SHARES, percent_ranks, quartile_score, rfm_metrics, rfm_segment
from ..sources import mapping as M
from ..sources import star


def rfm_table(spark: SparkSession, src: str, sub_categories=M.COHORT_SUB_CATEGORIES,
              as_of: str = M.RFM_AS_OF, calendar: bool = False) -> DataFrame:
    """Recency, frequency, monetary per customer over the UNION of both years'
    successful rows that have a scenario. DISTINCT commutes with the semi join
    on the scenario, so the UNION's whole-row DISTINCT runs before the join."""
    f = star.fact_union(spark, src).where(F.col("status_id") == 1)
    s = star.dim_scenario(spark, src)
    if sub_categories is not None:
        s = s.where(ci_in("sub_category", sub_categories))
    facts = star.join_scenario(f, s, "left_semi")
    return rfm_metrics(facts, "customer_id", "transaction_time", "charged_amount", as_of, calendar)


def rfm_scores(spark: SparkSession, src: str, scaled: bool = True, **options) -> DataFrame:
    """The RFM table with scores and segment. The scores come from exact cut values, or with
    ``scaled=False`` from ``PERCENT_RANK`` over the whole table in one task, as the reference has it."""
    t = rfm_table(spark, src, **options)
    keys = {"recency": ascending("recency"), "frequency": ascending("frequency", True), "monetary": ascending("monetary", True)}
    if scaled:
        t = t.withColumn("_cuts", cut_values(t, keys, SCORE_SHARES))
        scores = [score(key, F.col(f"_cuts.{c}"), len(SCORE_SHARES)) for c, key in keys.items()]
    else:
        t = percent_ranks(t, [(c, c != "recency", f"_{c}") for c in keys])
        scores = [quartile_score(f"_{c}") for c in keys]
    t = t.select("customer_id", *keys, *[s.alias(f"{c[0]}_score") for c, s in zip(keys, scores)])
    return t.withColumn("segment", rfm_segment("r_score", "f_score", "m_score"))


def rfm_segments(spark: SparkSession, src: str, scaled: bool = True, **options) -> DataFrame:
    """Users per segment and their percent of all users; ``options`` as of ``rfm_table``
    (sub_categories, as_of, calendar)."""
    seg = rfm_scores(spark, src, scaled, **options).groupBy("segment").agg(F.count("customer_id").alias("number_users"))
    seg = seg.withColumn("_total", F.sum("number_users").over(Window.partitionBy()))  # <= 10 rows
    return (seg.withColumn("pct", pct_text("number_users", "_total")).drop("_total")
            .orderBy(F.col("number_users").desc(), F.col("segment").asc()))
