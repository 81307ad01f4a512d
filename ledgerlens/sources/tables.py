"""Reading the raw parquet tables.

Every reader selects only the columns the caller names, so the parquet scan
shows a narrow ``ReadSchema`` and Catalyst can push filters into it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table_path(src: str, name: str) -> str:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return f"{str(src).rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, src: str, name: str, columns: list[str] | tuple[str, ...] | None = None) -> DataFrame:
    df = spark.read.parquet(table_path(src, name))
    return df.select(*columns) if columns else df


def register_views(spark: SparkSession, src: str, names=TABLES) -> None:
    """Register the raw tables as temp views (for Spark SQL users)."""
    for name in names:
        spark.read.parquet(table_path(src, name)).createOrReplaceTempView(name)
