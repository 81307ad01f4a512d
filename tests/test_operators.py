"""Operators on small inline fixtures, checked against brute force."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import Window, functions as F

from ledgerlens.operators import ranking
from ledgerlens.operators.aggregate import (bin_by_width, bin_exact, metric_summary, pivot_count, plain_label,
                                            thousands_label)
from ledgerlens.operators.cohort import cohort_cells
from ledgerlens.operators.relational import not_in, semi_join, union_distinct
from ledgerlens.operators.activity import active_periods, users_per_period
from ledgerlens.operators.cuts import ascending, cut_values, score
from ledgerlens.operators.rfm import SCORE_SHARES, SEGMENT_RULES, percent_ranks, quartile_score, rfm_segment
from ledgerlens.operators.timeseries import index_to_base, moving_average, period_over_period, running_total


# ------------------------------------------------------------------ binning
def test_bin_by_width_edges(spark):
    df = spark.createDataFrame([(-5,), (0,), (24999,), (25000,), (249999,), (250000,), (10 ** 9,), (None,)], "v long")
    got = [r[0] for r in df.select(bin_by_width("v", 25000, 10, thousands_label)).collect()]
    assert got == ["0K-25K", "0K-25K", "0K-25K", "25K-50K", "225K-250K", "> 250K", "> 250K", None]


def test_bin_by_width_plain(spark):
    df = spark.createDataFrame([(0,), (9,), (10,), (99,), (100,)], "v long")
    got = [r[0] for r in df.select(bin_by_width("v", 10, 10, plain_label)).collect()]
    assert got == ["0-10", "0-10", "10-20", "90-100", "> 100"]


def test_bin_exact(spark):
    df = spark.createDataFrame([(0,), (1,), (7,), (8,), (None,)], "v long")
    assert [r[0] for r in df.select(bin_exact("v", 7)).collect()] == [None, 1, 7, None, None]


# ------------------------------------------------------------------ summaries and pivots
def test_metric_summary_int_and_exact(spark):
    df = spark.createDataFrame([(1, 10), (2, 11), (4, 12)], "a long, b long")
    rows = {r.metric: r for r in metric_summary(df, [("A", "a", "int"), ("B", "b", "exact")]).collect()}
    assert (rows["A"].min_value, rows["A"].max_value, rows["A"].avg_value) == (1, 4, 2.0)   # 7/3 -> 2
    assert rows["B"].avg_value == 11.0


def test_pivot_count_fills_zero(spark):
    df = spark.createDataFrame([(1, "x", 10), (1, "x", 11), (2, "y", 12), (3, "z", 13)], "m int, c string, id long")
    got = {r.m: (r.X, r.Y) for r in pivot_count(df, ["m"], "c", ["x", "y"], "id", ["X", "Y"]).collect()}
    assert got == {1: (2, 0), 2: (0, 1), 3: (0, 0)}      # month 3 kept with zeros, as PIVOT does


# ------------------------------------------------------------------ set ops and subqueries
def test_union_distinct_removes_duplicates(spark):
    a = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string")
    b = spark.createDataFrame([(2, "b"), (3, "c")], "k int, v string")
    assert sorted(tuple(r) for r in union_distinct(a, b).collect()) == [(1, "a"), (2, "b"), (3, "c")]


def test_not_in_null_rules(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    sub = spark.createDataFrame([(2,)], "k int")
    assert sorted(r.k for r in not_in(left, sub, "k").collect()) == [1]
    with_null = spark.createDataFrame([(2,), (None,)], "k int")
    assert not_in(left, with_null, "k").count() == 0
    empty = spark.createDataFrame([], "k int")
    assert not_in(left, empty, "k").count() == 3


def test_semi_join_no_duplicates(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    sub = spark.createDataFrame([(1,), (1,), (3,)], "k int")
    assert [r.k for r in semi_join(left, sub, "k").collect()] == [1]


# ------------------------------------------------------------------ distributed ranking
def _data(n=600, seed=7, nulls=True):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        v = rnd.choice([None] * (3 if nulls else 0) + [42] * 200 + list(range(300)))   # one hot value
        rows.append((i, v, f"n{rnd.randint(0, 40):02d}"))
    return rows


@pytest.mark.parametrize("desc", [False, True])
def test_scores_by_cut_values_match_percent_rank(spark, desc):
    """A value with a third of the rows, nulls, and numbers that doubles cannot tell apart."""
    rows = _data() + [(1000 + i, None, "x") for i in range(5)]
    df = spark.createDataFrame([(i, v, None if v is None else 2 ** 60 + v) for i, v, _ in rows], "id long, v long, big long")
    keys = {"v": ascending("v", desc), "big": ascending("big", desc)}
    got = df.withColumn("_cuts", cut_values(df, keys, SCORE_SHARES)).select(
        "id", *[score(k, F.col(f"_cuts.{c}"), 3).alias(c) for c, k in keys.items()])
    want = percent_ranks(df, [("v", desc, "pv"), ("big", desc, "pb")]).select("id", quartile_score("pv").alias("v"), quartile_score("pb").alias("big"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert {r.v for r in want.collect()} >= {1, 4}


def test_cut_values_of_no_rows(spark):
    df = spark.createDataFrame([], "v long")
    assert df.withColumn("_cuts", cut_values(df, {"v": ascending("v")}, SCORE_SHARES)).collect() == []


@pytest.mark.parametrize("k", [0, 1, 37, 200, 599, 600, 700])
def test_top_k_matches_sort(spark, k):
    df = spark.createDataFrame(_data(), "id long, v long, name string")
    order = [("v", True), ("name", False), ("id", False)]
    got = sorted(r.id for r in ranking.top_k(df, order, k, buckets=4).collect())
    want = sorted(r.id for r in df.orderBy(F.col("v").desc_nulls_last(), "name", "id").limit(k).collect())
    assert got == want


def test_top_k_ties_cut_to_exactly_k(spark):
    df = spark.createDataFrame([(i, 1) for i in range(10)], "id long, v long")
    assert ranking.top_k(df, [("v", True)], 4).count() == 4


def test_top_k_of_equal_rows_and_of_no_rows(spark, monkeypatch):
    """A row that stands for a third of the table is a count until the end."""
    monkeypatch.setattr(ranking, "COPIES", 7)
    df = spark.createDataFrame([(1, None)] * 5 + [(2, "hot")] * 40 + [(3, "x")] * 60, "v long, s string")
    for k in (3, 20, 45, 46):
        got = sorted(r.v for r in ranking.top_k(df, [("v", False)], k, buckets=5).collect())
        assert got == sorted([1] * 5 + [2] * 40 + [3] * 60)[:k]
    assert ranking.top_k(df.where("v > 9"), [("v", True)], 4).collect() == []
    with pytest.raises(TypeError):
        ranking.top_k(df, [("s", True)], 1)


def test_top_k_starts_no_job_while_it_is_built(spark):
    df = spark.range(100).withColumn("v", F.expr("raise_error('a job ran')").cast("long"))
    ranking.top_percent(df, 10, [("v", True), ("id", False)])


def test_top_percent_rounds_up(spark):
    df = spark.createDataFrame([(i, i) for i in range(21)], "id long, w long")
    got = sorted(r.w for r in ranking.top_percent(df, 10, [("w", True), ("id", False)]).collect())
    assert got == [18, 19, 20]          # ceil(2.1) = 3 rows


# ------------------------------------------------------------------ time series
def test_running_and_moving(spark):
    df = spark.createDataFrame([(2019, w, w * 10) for w in range(1, 7)], "year int, week int, n long")
    r = running_total(df, ["year"], ["week"], "n", "run")
    m = moving_average(r, ["year", "week"], "run", 4, "avg", "cnt").orderBy("week").collect()
    assert [x.run for x in m] == [10, 30, 60, 100, 150, 210]
    assert [x.avg for x in m] == [10, 20, 33, 50, 85, 130]      # integer average of the running sum
    assert [x.cnt for x in m] == [1, 2, 3, 4, 4, 4]


def test_period_over_period_default_is_own_value(spark):
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate([10, None, 30])], "y int, m int, v long")
    got = period_over_period(df, ["y", "m"], "v", 1, "prev", "pct").orderBy("m").collect()
    assert [x.prev for x in got] == [10, 10, None]       # LAG default only where no row exists
    assert [x.pct for x in got] == ["100.00%", None, None]


def test_index_to_base_missing_base_is_null(spark):
    df = spark.createDataFrame([(2, 1997, 5)], "month int, year int, n long")
    r = index_to_base(df, "n", (F.col("month") == 1) & (F.col("year") == 1997), "base", "pct").first()
    assert r.base is None and r.pct is None


# ------------------------------------------------------------------ cohorts
def test_cohort_cells_match_window_form(spark):
    rnd = random.Random(3)
    rows = [(rnd.randint(1, 40), dt.datetime(1997, rnd.randint(1, 12), rnd.randint(1, 28))) for _ in range(800)]
    rows += [(7, dt.datetime(1997, 5, 1))] * 300           # a hot customer
    rows += [(None, dt.datetime(1997, 11, 3)), (None, dt.datetime(1997, 12, 9))]   # rows without a customer
    df = spark.createDataFrame(rows, "c long, t timestamp_ntz")
    got = {(r.acquisition_index, r.subsequent_month): r.retained_users
           for r in cohort_cells(df, "c", "t", 1997).collect()}
    w = Window.partitionBy("c")
    brute = (df.withColumn("first", F.min("t").over(w))
             .withColumn("sub", (F.year("t") * 12 + F.month("t")) - (F.year("first") * 12 + F.month("first")))
             .groupBy((F.month("first") - 1).alias("a"), "sub").agg(F.count_distinct("c").alias("n")))
    assert got == {(r.a, r.sub): r.n for r in brute.collect()}


def test_cohort_cells_reject_out_of_span(spark):
    df = spark.createDataFrame([(1, dt.datetime(1998, 1, 1))], "c long, t timestamp_ntz")
    with pytest.raises(Exception):
        cohort_cells(df, "c", "t", 1997).collect()


# ------------------------------------------------------------------ RFM
def test_segments_all_64_codes(spark):
    codes = list(itertools.product([1, 2, 3, 4], repeat=3))
    df = spark.createDataFrame(codes, "r int, f int, m int")
    got = {}
    for r in df.select(rfm_segment("r", "f", "m").alias("s")).collect():
        got[r.s] = got.get(r.s, 0) + 1
    # codes won per rule, first match wins
    want = {"Best Customers": 1, "Lost Bad Customers": 16, "Lost Customers": 8, "Almost Lost": 4,
            "Loyal Customers": 3, "Big Spenders": 4, "New Customers": 8, "Hibernating": 8,
            "Potential Loyalists": 12}
    assert got == want and len(SEGMENT_RULES) == 9


def test_quartile_score_strict(spark):
    df = spark.createDataFrame([(0.0,), (0.25,), (0.2500001,), (0.5,), (0.75,), (0.76,), (1.0,)], "p double")
    assert [r[0] for r in df.select(quartile_score("p")).collect()] == [1, 1, 2, 2, 3, 4, 4]


def test_index_to_base_two_base_rows_is_an_error(spark):
    df = spark.createDataFrame([(1, 1997, 5), (1, 1997, 6)], "month int, year int, n long")
    with pytest.raises(Exception):
        index_to_base(df, "n", (F.col("month") == 1) & (F.col("year") == 1997), "base", "pct").collect()


def test_not_in_is_lazy_and_follows_null_rules(spark):
    from ledgerlens.operators.relational import not_in
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    rows = lambda keys: sorted(r.k if r.k is not None else -1 for r in not_in(
        df, spark.createDataFrame([(k,) for k in keys], "k int"), "k").collect())
    assert rows([]) == [-1, 1, 2] and rows([1]) == [2] and rows([1, None]) == [] and rows([5, 5]) == [1, 2]


@pytest.mark.parametrize("descending", [True, False])
def test_top_k_orders_nan_and_null_as_spark(spark, descending):
    from pyspark.sql import functions as F
    from ledgerlens.operators.ranking import top_k
    values = [float("nan")] * 10 + [None] * 5 + [float(i % 7) for i in range(15)]
    df = spark.createDataFrame(list(enumerate(values)), "id int, v double")
    order = [F.col("v").desc_nulls_last() if descending else F.col("v").asc_nulls_first(), F.col("id").asc()]
    want = [r.id for r in df.orderBy(*order).limit(12).collect()]
    got = top_k(df, [("v", descending), ("id", False)], 12)
    assert sorted(r.id for r in got.collect()) == sorted(want)


def test_integer_price_range_equals_the_cast(spark):
    from pyspark.sql import functions as F
    from ledgerlens.functions.numeric import int_part, int_part_equals
    df = spark.range(-400, 400).select((F.col("id") / 100).alias("x"))
    for n in (-2, 0, 3):
        assert df.where(int_part_equals("x", n)).count() == df.where(int_part("x") == n).count()
        assert df.where(int_part_equals("x", n, round_money=True)).count() == df.where(F.round(F.col("x").cast("decimal(9,2)")) == n).count()


def test_bloom_filter_keeps_every_partner(spark):
    from ledgerlens.operators.relational import bloom_filter
    df = spark.range(-300, 300).selectExpr("IF(id % 50 = 0, NULL, id) k", "id")
    keys = spark.createDataFrame([(-7,), (13,), (13,), (None,), (2 ** 40,)], "c long")
    kept = {r.k for r in bloom_filter(df, keys, "k", "c").collect()}
    assert {-7, 13} <= kept and len(kept) < 10 and None not in kept
    assert bloom_filter(df, keys.limit(0), "k", "c").count() == 0


def test_distinct_users_by_bit_sets(spark):
    """Negative and missing users, more than one word of bits, and coarser periods from the same table."""
    rnd = random.Random(3)
    rows = [(rnd.choice([None, -5, -5, 0, 7, 2 ** 62] + list(range(40))), rnd.randrange(130)) for _ in range(900)] + [(None, 131)]
    df = spark.createDataFrame(rows, "u long, p int")
    active = active_periods(df, "u", F.col("p"), 132)
    for span in (1, 12):
        want = {}
        for u, p in rows:
            want.setdefault(p // span, set()).update([] if u is None else [u])
        assert {r._period: r.n for r in users_per_period(active, "u", 132, "n", span).collect()} == {p: len(v) for p, v in want.items()}
    with pytest.raises(Exception):
        active_periods(df, "u", F.col("p"), 131).collect()
