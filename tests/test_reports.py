"""Every registered report against its DuckDB oracle, plus the reference's
built-in cross-checks (the same table written two ways)."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from ledgerlens.plans import behaviour, cohorts, segments, trends
from ledgerlens.plans.oracles import ORACLES
from ledgerlens.plans.registry import QUERIES
from oracle_compare import compare, duck_connection

from conftest import SF001, SF01

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SF01)


def test_every_report_has_an_oracle():
    assert set(ORACLES) == set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_report_matches_oracle(spark, duck, name):
    ok, msg = compare(spark, name, E.queries()[name], E.oracle_sql()[name], SF01, duck)
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["transaction_type", "num_of_trans", "percentage"]
    assert 0 < len(rows) <= 5


def test_pivot_two_ways_agree(spark):
    # Q23 (PIVOT over DISTINCT ids, 0 for holes) and Q24 (SUM(CASE) of row
    # counts, NULL for holes): same months; the two agree where ids are
    # unique, and the mapped transaction_id repeats, so distinct <= rows.
    a = {(r.month, r.year): tuple(r)[2:] for r in trends.monthly_pivot(spark, SF01).collect()}
    b = {(r.month, r.year): tuple(x or 0 for x in tuple(r)[2:]) for r in trends.monthly_pivot_case(spark, SF01).collect()}
    assert a.keys() == b.keys()
    assert all(x <= y for k in a for x, y in zip(a[k], b[k]))
    assert sum(x == y for k in a for x, y in zip(a[k], b[k])) > len(a)   # most cells equal


def test_matrix_two_ways_agree(spark):
    a = sorted(map(tuple, cohorts.retention_matrix_join(spark, SF01).collect()))
    b = sorted(map(tuple, cohorts.retention_matrix(spark, SF01).collect()))
    assert a == b and len(a) == 12


def test_cohort_counts_two_ways_agree(spark):
    cols = ["acquisition_month", "subsequent_month", "retained_users"]
    a = sorted(map(tuple, cohorts.retention_all_cohorts_join(spark, SF01).select(cols).collect()))
    b = sorted(map(tuple, cohorts.retention_all_cohorts(spark, SF01).select(cols).collect()))
    assert a == b


def test_rfm_scaled_equals_window(spark):
    from ledgerlens.plans import segments
    a = sorted(map(tuple, segments.rfm_segments(spark, SF001, scaled=True).collect()))
    b = sorted(map(tuple, segments.rfm_segments(spark, SF001, scaled=False).collect()))
    assert a == b


def test_stated_choices(spark):
    """The documented other reading of a report is an argument, with its own result."""
    rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    few = {r.transaction_type: r for r in behaviour.share_by_type_top5(spark, SF01, denom="successful").collect()}
    for r in behaviour.share_by_type_top5(spark, SF01).collect():
        assert r.transaction_type not in few or few[r.transaction_type].percentage > r.percentage
    for report in (behaviour.hist_categories, behaviour.hist_scenarios):
        once, every = rows(report(spark, SF01, distinct=True)), rows(report(spark, SF01))
        assert sum(x[1] for x in once) == sum(x[1] for x in every)
    plain = trends.weekly_moving_average(spark, SF01, value="number_customer").orderBy("year", "week_number").collect()
    assert [r.moving_avg for r in plain[:2]] == [plain[0].number_customer, (plain[0].number_customer + plain[1].number_customer) // 2]
    literal, calendar = (sum(r.frequency for r in segments.rfm_table(spark, SF01, calendar=c).collect()) for c in (False, True))
    assert calendar >= literal
    every = {r.subsequent_month: r.retained_users for r in cohorts.retention_first_cohort(spark, SF01, sub_categories=None).collect()}
    some = {r.subsequent_month: r.retained_users for r in cohorts.retention_first_cohort(spark, SF01).collect()}
    assert 0 < some[0] < every[0]


def test_case_variants_are_one_group(spark, tmp_path):
    """'BLUE' and 'blue ' are one group, shown under its least spelling in binary order."""
    import edge_fixture
    from ledgerlens.functions.text import ci_key, spelling
    df = spark.createDataFrame([("blue",), ("BLUE",), ("Blue  ",), ("red",), (None,)], "c string")
    got = df.groupBy(ci_key("c").alias("k")).agg(spelling("c").alias("c"), F.count(F.lit(1)).alias("n")).select("c", "n")
    assert sorted(map(tuple, got.collect()), key=repr) == [("BLUE", 3), ("red", 1), (None, 1)]
    src = edge_fixture.build(str(tmp_path))
    assert {"STANDARD", "standard"} <= {r.p_type for r in spark.read.parquet(f"{src}/part.parquet").collect()}
    for report, column in ((behaviour.share_by_type_top5, "transaction_type"), (trends.monthly_trend_by_sub, "sub_category")):
        shown = {r[column] for r in report(spark, src).collect() if r[column]}
        assert len({s.lower().rstrip() for s in shown}) == len(shown) or column == "sub_category"
    types = [r.transaction_type for r in behaviour.share_by_type_top5(spark, src).collect()]
    assert "STANDARD" in types and "standard" not in types
