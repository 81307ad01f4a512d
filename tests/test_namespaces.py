"""Two databases, names with and without the database, and the switch."""

import pytest

from ledgerlens.plans import payments, sales
from ledgerlens.sources import namespaces as N

from conftest import SF001, SF01

rows = lambda df: sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def databases(spark):
    N.create_database(spark, "adventure", N.SALES, SF01)
    N.create_database(spark, "pay", N.PAYMENTS, SF01)
    N.create_database(spark, "pay_small", N.PAYMENTS, SF001)


def test_names_with_the_database(spark, databases):
    got = spark.sql("""SELECT c.CompanyName, oh.SalesOrderID, oh.TotalDue FROM adventure.Customer c
                       JOIN adventure.SalesOrderHeader oh ON oh.CustomerID = c.CustomerID""")
    assert rows(got) == rows(sales.customer_orders(spark, SF01))
    got = spark.sql("""SELECT ft.customer_id, ft.transaction_id, ft.scenario_id, ds.transaction_type, ds.sub_category, ds.category
                       FROM pay.fact_transaction_2019 ft JOIN pay.dim_scenario ds ON ds.scenario_id = ft.scenario_id
                       WHERE month(ft.transaction_time) = 1 AND lower(ds.transaction_type) <> 'standard'""")
    assert rows(got) == rows(payments.transactions_not_type(spark, SF01))


def test_one_text_in_two_databases(spark, databases):
    text = "SELECT year(transaction_time) AS y, count(*) AS n, sum(charged_amount) AS amount FROM fact_transaction_2019 GROUP BY 1"
    before = spark.catalog.currentDatabase()
    found = {}
    for name in ("pay", "pay_small", "pay"):
        with N.switched(spark, name) as session:
            found.setdefault(name, []).append(rows(session.sql(text)))
        assert spark.catalog.currentDatabase() == before
    assert found["pay"][0] == found["pay"][1] != found["pay_small"][0]
    with pytest.raises(Exception):
        spark.sql(text).collect()           # the caller's database has no such table


def test_an_error_inside_leaves_the_caller_alone(spark, databases):
    before = spark.catalog.currentDatabase()
    with pytest.raises(RuntimeError), N.switched(spark, "adventure") as session:
        assert session.catalog.currentDatabase() == "adventure"
        raise RuntimeError
    assert spark.catalog.currentDatabase() == before
    with pytest.raises(Exception), N.switched(spark, "no_such_database"):
        pass


def test_made_again_over_another_folder(spark):
    for folder in (SF01, SF001):
        N.create_database(spark, "again", N.SALES | N.PAYMENTS, folder)
        n = spark.sql("SELECT count(*) FROM again.SalesOrderDetail").first()[0]
        assert n == spark.read.parquet(f"{folder}/lineitem.parquet").count()
    with N.switched(spark, "again") as session:      # tables of both databases at once
        got = session.sql("SELECT DISTINCT p.Name FROM Product p JOIN fact_transaction_2020 f ON f.scenario_id = p.ProductID")
        assert got.count() > 0
