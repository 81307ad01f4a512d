"""Physical plan shapes that matter at scale."""

import os

import pytest

from ledgerlens.plans.registry import QUERIES
from ledgerlens.sources import star

from conftest import SF01
from plan_walk import nodes, scans


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_fact_scan_gets_date_range_and_narrow_schema(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    p = plan(star.fact_transactions(spark, SF01, (1997,), months=(1,)))
    assert "GreaterThanOrEqual(o_orderdate,1997-01-01T00:00)" in p
    assert "LessThan(o_orderdate,1997-02-01T00:00)" in p
    assert "l_shipdate" not in p and "l_quantity" not in p     # unused columns are not read


ONE_SCAN = {      # reports that use a table twice, and what they scan
    "share_by_type_top5": {"lineitem": 1, "orders": 1, "part": 1},
    "returning_customer_transactions": {"lineitem": 1, "orders": 1, "part": 1},
    "products_never_ordered": {"lineitem": 1, "part": 1},
    "product_name_prefix": {"part": 1},
    "rfm_segments": {"lineitem": 1, "orders": 1, "part": 1},
}


@pytest.fixture
def large(spark):
    """Plans as for tables too big to broadcast."""
    conf = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in conf}
    for k in conf:
        spark.conf.set(k, "-1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


@pytest.mark.parametrize("name", ONE_SCAN)
def test_both_sides_read_one_exchange(spark, large, name):
    from ledgerlens.plans.registry import QUERIES
    df = QUERIES[name](spark, SF01)
    df.collect()
    assert scans(df) == ONE_SCAN[name]


@pytest.mark.parametrize("name", ["index_to_first_month", "weekly_running_customers", "year_over_year"])
def test_distinct_customers_without_a_distinct_shuffle(spark, large, name):
    """One exchange by customer alone; none by (period, customer), no Expand."""
    df = QUERIES[name](spark, SF01)
    df.collect()
    found = nodes(df)
    assert not any(kind == "ExpandExec" for kind, _ in found)
    by_customer = [n.toString().split("\n")[0] for kind, n in found if kind == "ShuffleExchangeExec" and "customer_id" in n.outputPartitioning().toString()]
    keyed = [x for x in by_customer if "transaction_id" not in x]       # not the UNION's DISTINCT of whole rows
    assert len(keyed) == 1 and "hashpartitioning(customer_id" in keyed[0]


def test_repeated_scenarios_do_not_change_the_share(spark, tmp_path):
    """The share's denominator is counted before the join that repeats rows."""
    import shutil
    from ledgerlens.plans.behaviour import share_by_type_top5
    for t in ("orders", "lineitem"):
        shutil.copytree(f"{SF01}/{t}.parquet", tmp_path / f"{t}.parquet") if os.path.isdir(f"{SF01}/{t}.parquet") else shutil.copy(f"{SF01}/{t}.parquet", tmp_path)
    part = spark.read.parquet(f"{SF01}/part.parquet")
    part.unionAll(part.where("p_partkey % 3 = 0")).write.parquet(str(tmp_path / "part.parquet"))
    for denom in ("all", "successful"):
        assert share_by_type_top5(spark, str(tmp_path), denom=denom).collect() == share_by_type_top5(spark, SF01, denom=denom).collect()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    return star.store_star(spark, SF01, "stored_star", str(tmp_path_factory.mktemp("star")), buckets=4, salts=3)


STAR_REPORTS = [n for n, f in QUERIES.items() if not f.__module__.endswith(".sales")]


@pytest.mark.parametrize("name", STAR_REPORTS)
def test_reports_on_a_stored_star(spark, stored, name):
    """The same rows as from the tables."""
    assert sorted(map(tuple, QUERIES[name](spark, stored).collect()), key=repr) == sorted(
        map(tuple, QUERIES[name](spark, SF01).collect()), key=repr)


@pytest.mark.parametrize("name", ["monthly_trend", "top_customers_metrics", "hist_amount", "retention_all_cohorts",
                                  "share_of_category_in_type", "transactions_two_januaries", "year_over_year", "rfm_segments"])
def test_no_exchange_below_the_scenario_join(spark, large, stored, name):
    """Stored facts meet the scenarios, after the UNION's DISTINCT, without a shuffle of either."""
    df = QUERIES[name](spark, stored)
    df.collect()
    joins = [n for kind, n in nodes(df) if kind in ("SortMergeJoinExec", "ShuffledHashJoinExec") and "scenario_id" in n.toString().split("\n")[0]]
    assert joins
    for join in joins:
        assert "Exchange" not in join.toString()


def test_stored_star_is_checked_and_found_again(spark, stored, tmp_path):
    with pytest.raises(ValueError, match="lacks the months"):
        star.fact_transactions(spark, stored, (1996,))
    folder = str(tmp_path / "star")
    a = star.store_star(spark, SF01, "star_a", folder, (1997,), (1,), buckets=2, salts=2)
    b = star.open_star(spark, "star_b", folder)       # as another session, which knows no tables
    assert a.months == b.months == (199701,) and b.source == SF01
    rows = lambda src: sorted(map(tuple, star.fact_transactions(spark, src, (1997,), (1,)).drop("salt").collect()))
    assert rows(a) == rows(b) == rows(SF01)


def test_reports_read_the_facts_once(spark):
    from ledgerlens.plans.registry import QUERIES
    for name in ("retention_all_cohorts", "retention_matrix", "retention_matrix_join",
                 "share_of_category_in_type", "index_to_first_month"):
        p = plan(QUERIES[name](spark, SF01))
        assert p.count("lineitem.parquet") == 1, name


def test_stored_facts_are_pruned_and_checked(spark, tmp_path):
    out = str(tmp_path / "facts")
    star.write_facts(spark, SF01, out, (1997,), months=(1, 2))
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    got = star.read_facts(spark, out, SF01, (1997,), months=(1,))
    assert "PartitionFilters: [isnotnull(year" in plan(got)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, star.fact_transactions(spark, SF01, (1997,), (1,)).collect()))
    with pytest.raises(ValueError, match="lack the months"):
        star.read_facts(spark, out, SF01, (1997,))
    with pytest.raises(ValueError, match="not made from"):
        star.read_facts(spark, out, SF01 + "x", (1997,), (1,))


def test_reports_start_no_job_when_built(spark, monkeypatch):
    """All but the one that searches its cut-off values (README): a parquet footer for each table
    that is opened, and nothing else, is read while a report is built."""
    from pyspark.sql import DataFrameReader
    from ledgerlens.plans.registry import QUERIES
    opened = []
    read = DataFrameReader.parquet
    monkeypatch.setattr(DataFrameReader, "parquet", lambda self, *a, **k: opened.append(a) or read(self, *a, **k))
    sc = spark.sparkContext
    for name, fn in QUERIES.items():
        if name != "heaviest_products":
            opened.clear()
            sc.setJobGroup(f"build-{name}", name)
            fn(spark, SF01)
            assert len(sc.statusTracker().getJobIdsForGroup(f"build-{name}")) <= len(opened), name
    sc.setLocalProperty("spark.jobGroup.id", None)


def test_filtered_orders_can_prune_lineitem_before_the_join(spark):
    """With lineitem above Spark's scan-size bar (10 GB by default; lowered
    here), the year/month-filtered orders side feeds a runtime bloom filter
    into the lineitem scan, so only matching lines are shuffled to the join."""
    from ledgerlens.plans.registry import QUERIES
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "64KB"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = QUERIES["transactions_not_type"](spark, SF01)
        assert "might_contain" in df._jdf.queryExecution().optimizedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_write_facts_layout(spark, tmp_path):
    """Facts are written partitioned by year and month, every row once, each
    month over a few write tasks."""
    import os
    out = str(tmp_path / "facts")
    star.write_facts(spark, SF01, out, tasks_per_month=4)
    months = sorted(d for d in os.listdir(os.path.join(out, "year=1997")) if d.startswith("month="))
    assert len(months) == 12
    files = [f for f in os.listdir(os.path.join(out, "year=1997", "month=1")) if f.endswith(".parquet")]
    assert 1 <= len(files) <= 4
    assert spark.read.parquet(out).count() == star.fact_transactions(spark, SF01, (1997, 1998)).count()
