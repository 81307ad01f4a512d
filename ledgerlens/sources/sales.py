"""The sales sample database of the reference, derived from the test tables.

| reference table   | built from                                                      |
| ----------------- | --------------------------------------------------------------- |
| Address           | nation join region (AddressLine2 NULL for one region)            |
| Product           | part                                                             |
| ProductCategory   | distinct p_type, id = smallest part key of the type              |
| ProductModel      | distinct second word of p_name, id = smallest part key          |
| SalesOrderDetail  | lineitem                                                        |
| Customer          | customer                                                         |
| SalesOrderHeader  | orders                                                           |
| CustomerAddress   | customer (its nation is the address, its segment the type)      |
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .tables import read_table

NULL_LINE2_REGION = "ASIA"


def address(spark: SparkSession, src: str) -> DataFrame:
    nation = read_table(spark, src, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    region = read_table(spark, src, "region", ["r_regionkey", "r_name"])
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").cast("long").alias("AddressID"),
        F.col("n_name").alias("AddressLine1"),
        F.expr(f"nullif(r_name, '{NULL_LINE2_REGION}')").alias("AddressLine2"),
        F.col("n_name").alias("City"),
        F.col("r_name").alias("StateProvince"),
        F.col("r_name").alias("CountryRegion"),
        F.col("n_nationkey").cast("string").alias("PostalCode"),
    )


def _first_key_by(part: DataFrame, name_col, id_alias: str) -> DataFrame:
    return part.groupBy(name_col.alias("Name")).agg(F.min("p_partkey").alias(id_alias))


def product_category(spark: SparkSession, src: str) -> DataFrame:
    part = read_table(spark, src, "part", ["p_partkey", "p_type"])
    return _first_key_by(part, F.col("p_type"), "ProductCategoryID")


def product_model(spark: SparkSession, src: str) -> DataFrame:
    part = read_table(spark, src, "part", ["p_partkey", "p_name"])
    return _first_key_by(part, F.split_part("p_name", F.lit(" "), F.lit(2)), "ProductModelID")


def product(spark: SparkSession, src: str, name_with_brand: bool = False,
            with_category_model: bool = False) -> DataFrame:
    part = read_table(spark, src, "part", ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"])
    name = F.concat_ws(" - ", "p_name", "p_brand") if name_with_brand else F.col("p_name")
    df = part.select(
        F.col("p_partkey").alias("ProductID"),
        F.col("p_brand").alias("ProductNumber"),
        name.alias("Name"),
        F.split_part("p_name", F.lit(" "), F.lit(1)).alias("Color"),
        F.col("p_size").alias("Size"),
        F.col("p_size").alias("Weight"),
        F.col("p_retailprice").alias("ListPrice"),
        F.col("p_type").alias("_type"),
        F.split_part("p_name", F.lit(" "), F.lit(2)).alias("_model"),
    )
    if with_category_model:
        # Both lookups have one row per distinct type / model name: small
        # aggregates, broadcast by AQE once their measured size is known.
        cat = product_category(spark, src).withColumnRenamed("Name", "_type")
        mod = product_model(spark, src).withColumnRenamed("Name", "_model")
        df = df.join(cat, "_type").join(mod, "_model")
    return df.drop("_type", "_model")


def part_names(spark: SparkSession, src: str) -> DataFrame:
    """Products with the names of their category and model in place of the ids."""
    part = read_table(spark, src, "part", ["p_partkey", "p_name", "p_brand", "p_type", "p_retailprice"])
    return part.select(F.col("p_partkey").alias("ProductID"), F.concat_ws(" - ", "p_name", "p_brand").alias("Name"),
                       F.col("p_type").alias("CategoryName"), F.split_part("p_name", F.lit(" "), F.lit(2)).alias("ModelName"),
                       F.col("p_retailprice").alias("ListPrice"))


def sales_order_detail(spark: SparkSession, src: str) -> DataFrame:
    return read_table(spark, src, "lineitem", ["l_partkey"]).select(F.col("l_partkey").alias("ProductID"))


def customer(spark: SparkSession, src: str) -> DataFrame:
    return read_table(spark, src, "customer", ["c_custkey", "c_name"]).select(
        F.col("c_custkey").alias("CustomerID"), F.col("c_name").alias("CompanyName"))


def sales_order_header(spark: SparkSession, src: str) -> DataFrame:
    return read_table(spark, src, "orders", ["o_orderkey", "o_custkey", "o_totalprice"]).select(
        F.col("o_orderkey").alias("SalesOrderID"), F.col("o_custkey").alias("CustomerID"),
        F.col("o_totalprice").alias("TotalDue"))


def customer_address(spark: SparkSession, src: str) -> DataFrame:
    return read_table(spark, src, "customer", ["c_custkey", "c_nationkey", "c_mktsegment"]).select(
        F.col("c_custkey").alias("CustomerID"), F.col("c_nationkey").cast("long").alias("AddressID"),
        F.col("c_mktsegment").alias("AddressType"))


def register_sales(spark: SparkSession, src: str) -> None:
    """Temp views under the reference's table names, for Spark SQL users
    (``SELECT ... FROM Address`` etc.)."""
    views = {
        "Address": address(spark, src), "Product": product(spark, src, with_category_model=True),
        "ProductCategory": product_category(spark, src), "ProductModel": product_model(spark, src),
        "SalesOrderDetail": sales_order_detail(spark, src), "Customer": customer(spark, src),
        "SalesOrderHeader": sales_order_header(spark, src), "CustomerAddress": customer_address(spark, src),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
