"""Scores by cut values and top-k equal Spark's single-task forms on random
data with ties, a hot value and NULLs (property-based)."""

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from ledgerlens.operators import ranking
from ledgerlens.operators.cuts import ascending, cut_values, score
from ledgerlens.operators.rfm import SCORE_SHARES, percent_ranks, quartile_score

values = st.lists(st.one_of(st.none(), st.integers(-3, 12), st.just(5)), min_size=1, max_size=60)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(vals=values, desc=st.booleans())
def test_scores_property(spark, vals, desc):
    df = spark.createDataFrame(list(enumerate(vals)), "id long, v long")
    key = ascending("v", desc)
    got = {r.id: r.s for r in df.withColumn("_cuts", cut_values(df, {"v": key}, SCORE_SHARES)).withColumn("s", score(key, F.col("_cuts.v"), 3)).collect()}
    want = {r.id: r.s for r in percent_ranks(df, [("v", desc, "pr")]).withColumn("s", quartile_score("pr")).collect()}
    assert got == want


@SETTINGS
@given(vals=values, k=st.integers(0, 70), desc=st.booleans())
def test_top_k_property(spark, vals, k, desc):
    df = spark.createDataFrame(list(enumerate(vals)), "id long, v long")
    got = sorted(r.id for r in ranking.top_k(df, [("v", desc), ("id", False)], k, buckets=3).collect())
    vcol = F.col("v").desc_nulls_last() if desc else F.col("v").asc_nulls_first()
    want = sorted(r.id for r in df.orderBy(vcol, "id").limit(k).collect())
    assert got == want
