"""Sales reports: projections, predicates, top-k, anti/semi joins, star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions.numeric import int_part_equals
from ..functions.text import ci_eq, ci_in, ci_key, like, nvl_text, prefix_before, spelling
from ..operators.ranking import top_percent
from ..operators.relational import not_in
from ..sources import mapping as M
from ..sources import sales as S


def distinct_places(spark: SparkSession, src: str) -> DataFrame:
    """Distinct (City, StateProvince), case variants merged; state ascending, city descending."""
    a = S.address(spark, src)
    return (a.groupBy(ci_key("City"), ci_key("StateProvince"))
            .agg(spelling("City").alias("City"), spelling("StateProvince").alias("StateProvince")).select("City", "StateProvince")
            .orderBy(F.col("StateProvince").asc(), F.col("City").desc()))


def heaviest_products(spark: SparkSession, src: str, percent: float = 10) -> DataFrame:
    """``TOP 10 PERCENT Name, Weight ORDER BY Weight DESC``; ties broken by
    name then product id so the cut is deterministic."""
    p = S.product(spark, src).select("ProductID", "Name", "Weight")
    top = top_percent(p, percent, [("Weight", True), ("Name", False), ("ProductID", False)])
    return top.select("Name", "Weight")


def _color_or_size(colors, sizes):
    return ci_in("Color", colors) | F.col("Size").isin(list(sizes))


def products_by_color_or_size(spark: SparkSession, src: str, colors=M.COLORS, sizes=M.SIZES) -> DataFrame:
    """Product number and name for listed colors OR listed sizes."""
    p = S.product(spark, src)
    return p.where(_color_or_size(colors, sizes)).select("ProductNumber", "Name")


def products_by_number_pattern(spark: SparkSession, src: str, pattern: str = M.PRODUCT_NUMBER_PATTERN,
                               colors=M.COLORS, sizes=M.SIZES) -> DataFrame:
    """Q03's filter AND ProductNumber LIKE a pattern with character classes."""
    p = S.product(spark, src)
    return (p.where(like("ProductNumber", pattern) & _color_or_size(colors, sizes))
            .select("ProductID", "ProductNumber", "Name"))


def products_never_ordered(spark: SparkSession, src: str, words=M.NAME_WORDS,
                           number_pattern: str = M.MIN_NUMBER_PATTERN) -> DataFrame:
    """Name contains either word, number at least 8 long, id NOT IN the order lines."""
    p = S.product(spark, src)
    name_ok = like("Name", f"%{words[0]}%") | like("Name", f"%{words[1]}%")
    cand = p.where(name_ok & like("ProductNumber", number_pattern))
    return not_in(cand, S.sales_order_detail(spark, src), "ProductID").select(
        "ProductID", "ProductNumber", "Name", "ListPrice")


def customer_orders(spark: SparkSession, src: str) -> DataFrame:
    """Company name, sales order id and total due per order."""
    c, oh = S.customer(spark, src), S.sales_order_header(spark, src)
    return c.join(oh, "CustomerID").select("CompanyName", "SalesOrderID", "TotalDue")


def customer_orders_main_address(spark: SparkSession, src: str, address_type: str = M.MAIN_OFFICE) -> DataFrame:
    """Customer orders with the customer's main-office address (bridge table)."""
    c = S.customer(spark, src)
    ca = S.customer_address(spark, src).where(ci_eq("AddressType", address_type))
    a = S.address(spark, src)
    oh = S.sales_order_header(spark, src)
    # the three CustomerID joins first (one hash partitioning serves them all),
    # the address (one row per nation) last
    j = c.join(ca, "CustomerID").join(oh, "CustomerID").join(a, "AddressID")
    return j.select("CompanyName", "AddressLine1", nvl_text("AddressLine2").alias("AddressLine2"),
                    "City", "StateProvince", "PostalCode", "CountryRegion", "SalesOrderID", "TotalDue")


def product_name_prefix(spark: SparkSession, src: str, category_pattern: str = M.CATEGORY_NAME_PATTERN,
                        model_pattern: str = M.MODEL_NAME_PATTERN, price: int = M.LIST_PRICE_INT,
                        round_money: bool = False) -> DataFrame:
    """Product name up to the first '-', for a category, a model and an
    integer list price (``CAST(ListPrice AS INT)`` = truncation, or rounding as a
    MONEY column would with ``round_money``)."""
    part = S.part_names(spark, src).where(like("CategoryName", category_pattern))
    wanted = like("ModelName", model_pattern) & int_part_equals("ListPrice", price, round_money)
    # One read: what is not wanted collapses to one row a category on the map side, there for the category's least key.
    held = part.groupBy("CategoryName", F.when(wanted, F.struct(prefix_before("Name", "-").alias("ProductName"))).alias("_found")).agg(
        F.min("ProductID").alias("_key"), F.count(F.lit(1)).alias("_rows"))
    held = held.withColumn("ProductCategoryID", F.min("_key").over(Window.partitionBy("CategoryName"))).where("_found IS NOT NULL")
    return held.withColumn("_one", F.explode(F.expr("array_repeat(0, cast(_rows as int))"))).select(
        "_found.ProductName", "ProductCategoryID", F.col("CategoryName").alias("Name"))
