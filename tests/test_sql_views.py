"""The reference's table names as Spark SQL views: statements run as written
(apart from dialect), with the same results as the DataFrame reports."""

from ledgerlens.sources.sales import register_sales
from ledgerlens.sources.star import fact_transactions, register_star

from conftest import SF001


def test_sales_views(spark):
    register_sales(spark, SF001)
    got = spark.sql("""SELECT CountryRegion, count(*) AS n, count(AddressLine2) AS second_lines
                       FROM CustomerAddress JOIN Address USING (AddressID) GROUP BY CountryRegion""")
    rows = {r.CountryRegion: (r.n, r.second_lines) for r in got.collect()}
    assert sum(n for n, _ in rows.values()) == spark.read.parquet(f"{SF001}/customer.parquet").count()
    assert rows["ASIA"][1] == 0 and rows["EUROPE"][0] == rows["EUROPE"][1]


def test_star_views(spark):
    register_star(spark, SF001)
    got = spark.sql("""SELECT payment_platform, sum(charged_amount) AS amount FROM fact_transaction_2020
                       JOIN dim_platform USING (platform_id) GROUP BY payment_platform""")
    want = fact_transactions(spark, SF001, (1998,)).groupBy().sum("charged_amount").first()[0]
    rows = got.collect()
    assert {r.payment_platform for r in rows} == {"ios", "android", "website"} and sum(r.amount for r in rows) == want


def test_cli_lists_every_report(capsys):
    from ledgerlens.__main__ import main
    from ledgerlens.plans.registry import QUERIES
    assert main(["list"]) == 0
    out = capsys.readouterr().out
    assert all(name in out for name in QUERIES)


def test_source_folder_as_path_or_with_slash(spark):
    import pathlib
    from ledgerlens.plans.registry import QUERIES
    a = QUERIES["customer_orders"](spark, pathlib.Path(SF001)).count()
    b = QUERIES["customer_orders"](spark, SF001 + "/").count()
    assert a == b > 0


def test_cli_runs_a_report_to_csv(spark, tmp_path):
    from ledgerlens.__main__ import main
    from ledgerlens.plans import trends
    out = str(tmp_path / "trend")
    assert main(["run", "monthly_trend", "--src", SF001, "--out", out, "--format", "csv"]) == 0
    got = spark.read.option("header", "true").option("inferSchema", "true").csv(out)
    want = trends.monthly_trend(spark, SF001)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_raw_table_views(spark):
    from ledgerlens.sources.tables import register_views
    register_views(spark, SF001, names=("orders", "lineitem"))
    n = spark.sql("SELECT count(*) FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey").first()[0]
    assert n == spark.read.parquet(f"{SF001}/lineitem.parquet").count()


def test_cli_materialise(spark, tmp_path):
    from ledgerlens.__main__ import main
    from ledgerlens.sources import star
    facts = str(tmp_path / "facts")
    assert main(["materialise", "--src", SF001, "--out", facts, "--tasks-per-month", "2"]) == 0
    got = star.read_facts(spark, facts, SF001, (1997, 1998))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, star.fact_transactions(spark, SF001, (1997, 1998)).collect()))
