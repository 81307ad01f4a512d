"""The reference's two databases as Spark databases, and a switch between such databases.

A statement names its tables either by the database (``sales.Address``) or plainly, after a switch.
The tables are views kept in the catalog: SQL over the source folder, so that every session of the
catalog reads them. ``switched`` runs statements in a child session, which shares the catalog
but has a current database of its own: the caller's stays as it was, whatever happens inside.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from . import mapping as M
from .sales import NULL_LINE2_REGION
from .tables import table_path

WORD = "split_part(p_name, ' ', {})"


def _case(column: str, pairs, other: int) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{v}' THEN {k}" for v, k in pairs) + f" ELSE {other} END"


def _rows(pairs, names: tuple[str, str]) -> str:
    return f"SELECT * FROM VALUES {', '.join(f'({int(k)}, {v!r})' for k, v in pairs)} AS t({', '.join(names)})"


def _fact(year: int) -> str:
    return f"""SELECT l_orderkey * 10 + l_linenumber AS transaction_id, o_custkey AS customer_id, l_partkey AS scenario_id,
        CAST(left(o_orderpriority, 1) AS INT) AS payment_channel_id, {_case('l_returnflag', M.RETURN_FLAG_PLATFORM, 3)} AS platform_id,
        {_case('o_orderstatus', M.ORDER_STATUS_ID, 3)} AS status_id, o_orderdate AS transaction_time,
        CAST(floor(l_extendedprice) AS BIGINT) AS charged_amount
    FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey
    WHERE o_orderdate >= TIMESTAMP_NTZ'{year}-01-01' AND o_orderdate < TIMESTAMP_NTZ'{year + 1}-01-01'"""


# The tables of each database: name -> SQL over the source tables, in braces.
SALES = {
    "Address": f"""SELECT CAST(n_nationkey AS BIGINT) AS AddressID, n_name AS AddressLine1, nullif(r_name, '{NULL_LINE2_REGION}') AS AddressLine2,
        n_name AS City, r_name AS StateProvince, r_name AS CountryRegion, CAST(n_nationkey AS STRING) AS PostalCode
        FROM {{nation}} JOIN {{region}} ON n_regionkey = r_regionkey""",
    "ProductCategory": "SELECT p_type AS Name, min(p_partkey) AS ProductCategoryID FROM {part} GROUP BY p_type",
    "ProductModel": f"SELECT {WORD.format(2)} AS Name, min(p_partkey) AS ProductModelID FROM {{part}} GROUP BY {WORD.format(2)}",
    "Product": f"""SELECT p_partkey AS ProductID, p_brand AS ProductNumber, p_name AS Name, {WORD.format(1)} AS Color, p_size AS Size,
        p_size AS Weight, p_retailprice AS ListPrice, ProductCategoryID, ProductModelID
        FROM {{part}} JOIN {{ProductCategory}} c ON c.Name = p_type JOIN {{ProductModel}} m ON m.Name = {WORD.format(2)}""",
    "SalesOrderDetail": "SELECT l_partkey AS ProductID FROM {lineitem}",
    "Customer": "SELECT c_custkey AS CustomerID, c_name AS CompanyName FROM {customer}",
    "SalesOrderHeader": "SELECT o_orderkey AS SalesOrderID, o_custkey AS CustomerID, o_totalprice AS TotalDue FROM {orders}",
    "CustomerAddress": "SELECT c_custkey AS CustomerID, CAST(c_nationkey AS BIGINT) AS AddressID, c_mktsegment AS AddressType FROM {customer}",
}
PAYMENTS = {
    "fact_transaction_2019": _fact(M.YEAR_A),
    "fact_transaction_2020": _fact(M.YEAR_B),
    "dim_scenario": f"SELECT p_partkey AS scenario_id, p_type AS transaction_type, {WORD.format(2)} AS category, {WORD.format(1)} AS sub_category FROM {{part}}",
    "dim_payment_channel": """SELECT DISTINCT CAST(left(o_orderpriority, 1) AS INT) AS payment_channel_id,
        substr(o_orderpriority, instr(o_orderpriority, '-') + 1) AS payment_method FROM {orders}""",
    "dim_platform": _rows(M.PLATFORMS, ("platform_id", "payment_platform")),
    "dim_status": _rows(M.STATUSES, ("status_id", "status_description")),
}
SOURCES = ("region", "nation", "customer", "part", "orders", "lineitem")


def create_database(spark: SparkSession, database: str, tables: dict[str, str], src: str) -> None:
    """A database of the catalog with ``tables`` (``SALES``, ``PAYMENTS`` or both) over a source folder.
    It may be made again over another folder; its views are replaced."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    names = {t: f"parquet.`{table_path(src, t)}`" for t in SOURCES} | {t: f"`{database}`.`{t}`" for t in tables}
    for name, text in tables.items():
        spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{name}` AS {text.format(**names)}")


@contextmanager
def switched(spark: SparkSession, database: str) -> Iterator[SparkSession]:
    """A session whose current database is ``database``; raises where there is none of that name.
    Settings are the caller's, temporary views are not shared, the caller's session is left alone."""
    child = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled", "spark.sql.shuffle.partitions"):
        child.conf.set(key, spark.conf.get(key))
    child.sql(f"USE DATABASE `{database}`")
    yield child
