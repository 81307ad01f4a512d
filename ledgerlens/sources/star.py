"""The payments star of the reference, derived by Spark from the test tables.

Fact for year Y = ``lineitem`` join ``orders`` on the order key, orders of year
Y only. The reference keeps one fact table per year and unions them; here one
join covers any set of years, with the year (and month) choice turned into a
range on ``o_orderdate`` that reaches the parquet scan as pushed filters.

Dimensions: ``dim_scenario`` from ``part`` (one row per part key, sized like
the part table, so it is never broadcast by hint -- AQE broadcasts it only if
the filtered side measures small at run time), ``dim_payment_channel`` from
the distinct order priorities, ``dim_platform`` and ``dim_status`` from three
literal rows each (fixed size, safe to broadcast).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.dates import ts_ntz
from . import mapping as M
from .tables import read_table

FACT_COLUMNS = (
    "transaction_id", "customer_id", "scenario_id", "payment_channel_id",
    "platform_id", "status_id", "transaction_time", "charged_amount",
)
FACT_SCHEMA = ("transaction_id bigint, customer_id bigint, scenario_id bigint, payment_channel_id int, "
               "platform_id int, status_id int, transaction_time timestamp_ntz, charged_amount bigint")


def _code(col: Column, pairs, other: int) -> Column:
    expr = None
    for value, code in pairs:
        expr = (F.when(col == value, F.lit(code)) if expr is None else expr.when(col == value, F.lit(code)))
    return expr.otherwise(F.lit(other))


def _month_runs(months) -> list[tuple[int, int]]:
    ms = sorted(set(months))
    runs, start, prev = [], ms[0], ms[0]
    for m in ms[1:]:
        if m != prev + 1:
            runs.append((start, prev))
            start = m
        prev = m
    runs.append((start, prev))
    return runs


def period_filter(col: str, years, months=None) -> Column:
    """``year(col) IN years [AND month(col) IN months]`` as OR-ed half-open
    ranges on ``col`` -- the sargable form parquet min/max statistics can use."""
    spans: list[list[str]] = []
    for y in sorted(set(years)):
        for lo, hi in _month_runs(months) if months else [(1, 12)]:
            start = f"{y:04d}-{lo:02d}-01"
            end = f"{y + 1:04d}-01-01" if hi == 12 else f"{y:04d}-{hi + 1:02d}-01"
            if spans and spans[-1][1] == start:   # adjacent: extend the last range
                spans[-1][1] = end
            else:
                spans.append([start, end])
    return reduce(lambda a, b: a | b,
                  [(F.col(col) >= ts_ntz(s)) & (F.col(col) < ts_ntz(e)) for s, e in spans])


def _months(years, months) -> list[int]:
    return sorted(y * 100 + m for y in set(years) for m in (months or range(1, 13)))


@dataclass(frozen=True)
class StoredStar:
    """Facts and scenarios that ``store_star`` wrote as bucketed tables of a database. Every report
    takes one in place of the source folder.

    A fact's bucket comes from its scenario and a salt of its transaction, a scenario is held once for
    each salt: the two join bucket by bucket without a shuffle, a scenario with a third of all
    facts lies in as many buckets as there are salts, and equal facts share a bucket, so the UNION's
    DISTINCT needs no shuffle either."""
    database: str
    source: str
    months: tuple[int, ...]

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.table(f"`{self.database}`.`{name}`")

    def transactions(self, spark: SparkSession, years, months=None) -> DataFrame:
        self.check(years, months)
        cond = F.col("year").isin(sorted(set(years)))
        if months:
            cond = cond & F.col("month").isin(sorted(set(months)))
        return self.table(spark, "fact_transactions").where(cond).select(*FACT_COLUMNS, "salt")

    def check(self, years, months=None) -> None:
        lacking = set(_months(years, months)) - set(self.months)
        if lacking:
            raise ValueError(f"the stored star {self.database} lacks the months {sorted(lacking)}")


def store_star(spark: SparkSession, src: str, database: str, folder: str, years=(M.YEAR_A, M.YEAR_B), months=None,
               buckets: int = 64, salts: int = 4) -> StoredStar:
    """Shuffle lineitem and orders once and for all: facts by year and month, each in ``buckets`` files
    by (scenario, salt), the scenarios in the same buckets, the payment channels of each month, and
    a manifest of the source and the months. The tables lie in ``folder``, so that a metastore
    is not needed to keep them (``open_star`` registers them again)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    salt = F.pmod(F.xxhash64("transaction_id"), F.lit(salts)).cast("int")
    facts = (fact_transactions(spark, src, years, months).withColumn("salt", salt)
             .withColumn("year", F.year("transaction_time")).withColumn("month", F.month("transaction_time")))
    scenarios = dim_scenario(spark, src).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    for name, df, by in (("fact_transactions", facts, ["year", "month"]), ("dim_scenario", scenarios, [])):
        writer = (df.repartition(buckets, "scenario_id", "salt").write.mode("overwrite").format("parquet")
                  .bucketBy(buckets, "scenario_id", "salt").sortBy("scenario_id", "salt").option("path", f"{folder}/{name}"))
        (writer.partitionBy(*by) if by else writer).saveAsTable(f"`{database}`.`{name}`")
    priorities = read_table(spark, src, "orders", ["o_orderpriority", "o_orderdate"]).where(period_filter("o_orderdate", years, months))
    month = F.year("o_orderdate") * 100 + F.month("o_orderdate")
    (_channels(priorities.select("o_orderpriority", month.alias("held")).distinct(), "held").coalesce(1)
     .write.mode("overwrite").format("parquet").option("path", f"{folder}/dim_payment_channel").saveAsTable(f"`{database}`.`dim_payment_channel`"))
    held = ", ".join(f"({m})" for m in _months(years, months))
    (spark.sql(f"SELECT * FROM VALUES {held} AS t(held)")
     .select("held", F.lit(str(src).rstrip("/")).alias("source"), F.lit(buckets).alias("buckets"))
     .coalesce(1).write.mode("overwrite").parquet(f"{folder}/manifest"))
    return open_star(spark, database, folder)


def open_star(spark: SparkSession, database: str, folder: str) -> StoredStar:
    """The star that ``store_star`` wrote to ``folder``, its tables registered in ``database`` where
    the catalog does not know them (another session without a metastore)."""
    held = spark.read.parquet(f"{folder}/manifest").collect()       # a row for each month
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    buckets = f"CLUSTERED BY (scenario_id, salt) SORTED BY (scenario_id, salt) INTO {held[0]['buckets']} BUCKETS"
    for name, columns, layout in (
            ("fact_transactions", FACT_SCHEMA + ", salt int, year int, month int", f"PARTITIONED BY (year, month) {buckets}"),
            ("dim_scenario", "scenario_id bigint, transaction_type string, category string, sub_category string, salt int", buckets),
            ("dim_payment_channel", "held int, payment_channel_id int, payment_method string", "")):
        if not spark.catalog.tableExists(f"`{database}`.`{name}`"):
            spark.sql(f"CREATE TABLE `{database}`.`{name}` ({columns}) USING parquet {layout} LOCATION '{folder}/{name}'")
            if "PARTITIONED" in layout:
                spark.sql(f"ALTER TABLE `{database}`.`{name}` RECOVER PARTITIONS")
    return StoredStar(database, held[0]["source"], tuple(sorted(r["held"] for r in held)))


def join_scenario(facts: DataFrame, scenarios: DataFrame, how: str = "inner") -> DataFrame:
    """Facts joined to their scenarios, bucket by bucket if both are of a stored star."""
    on = [c for c in ("scenario_id", "salt") if c in facts.columns and c in scenarios.columns]
    joined = facts.join(scenarios, on, how)
    return joined.drop("salt") if "salt" in on else joined


def fact_transactions(spark: SparkSession, src: str | StoredStar, years=(M.YEAR_A,), months=None) -> DataFrame:
    """Rows of ``fact_transaction_<year>`` for the given years (and months)."""
    if isinstance(src, StoredStar):
        return src.transactions(spark, years, months)
    orders = (read_table(spark, src, "orders",
                         ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"])
              .where(period_filter("o_orderdate", years, months)))
    lines = read_table(spark, src, "lineitem",
                       ["l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_extendedprice"])
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey, "inner")
    return joined.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("transaction_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("scenario_id"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("payment_channel_id"),
        _code(F.col("l_returnflag"), M.RETURN_FLAG_PLATFORM, 3).alias("platform_id"),
        _code(F.col("o_orderstatus"), M.ORDER_STATUS_ID, 3).alias("status_id"),
        F.col("o_orderdate").alias("transaction_time"),
        F.floor("l_extendedprice").cast("long").alias("charged_amount"),
    )


def fact_union(spark: SparkSession, src: str | StoredStar, years=(M.YEAR_A, M.YEAR_B), months=None,
               distinct: bool = True) -> DataFrame:
    """``SELECT * FROM fact_<y1> UNION SELECT * FROM fact_<y2>``.

    The yearly tables hold disjoint years, so the union of the two equals one
    scan of both years followed by one whole-row DISTINCT. ``distinct=False``
    is ``UNION ALL``: equal only when the caller knows the fact rows are
    unique (the reports keep the DISTINCT, as the SQL says).
    """
    f = fact_transactions(spark, src, years, months)
    return f.distinct() if distinct else f


def dim_scenario(spark: SparkSession, src: str | StoredStar) -> DataFrame:
    if isinstance(src, StoredStar):
        return src.table(spark, "dim_scenario")
    part = read_table(spark, src, "part", ["p_partkey", "p_name", "p_type"])
    return part.select(
        F.col("p_partkey").alias("scenario_id"),
        F.col("p_type").alias("transaction_type"),
        F.split_part("p_name", F.lit(" "), F.lit(2)).alias("category"),
        F.split_part("p_name", F.lit(" "), F.lit(1)).alias("sub_category"),
    )


def _channels(priorities: DataFrame, *others: str) -> DataFrame:
    return priorities.select(
        *others, F.substring("o_orderpriority", 1, 1).cast("int").alias("payment_channel_id"),
        F.expr("substr(o_orderpriority, instr(o_orderpriority, '-') + 1)").alias("payment_method"))


def dim_payment_channel(spark: SparkSession, src: str | StoredStar, years=None, months=None) -> DataFrame:
    """The distinct order priorities; of the given period's orders only, if one is named (its
    facts hold no others), so that the scan gets the same date ranges as theirs."""
    if isinstance(src, StoredStar):
        held = src.table(spark, "dim_payment_channel")
        if years:
            src.check(years, months)
            held = held.where(F.col("held").isin(_months(years, months)))
        return held.select("payment_channel_id", "payment_method").distinct()
    pr = read_table(spark, src, "orders", ["o_orderpriority", "o_orderdate"] if years else ["o_orderpriority"])
    if years:
        pr = pr.where(period_filter("o_orderdate", years, months)).select("o_orderpriority")
    return _channels(pr.distinct())


def _literal_rows(spark: SparkSession, rows, names: tuple[str, str]) -> DataFrame:
    """A small literal table as a SQL VALUES relation (cheaper to build than
    a DataFrame from Python rows); fixed size, so broadcast by hint."""
    values = ", ".join(f"({int(k)}, '{v}')" for k, v in rows)
    return F.broadcast(spark.sql(f"SELECT * FROM VALUES {values} AS t({names[0]}, {names[1]})"))


def dim_platform(spark: SparkSession) -> DataFrame:
    return _literal_rows(spark, M.PLATFORMS, ("platform_id", "payment_platform"))


def dim_status(spark: SparkSession) -> DataFrame:
    return _literal_rows(spark, M.STATUSES, ("status_id", "status_description"))


def write_facts(spark: SparkSession, src: str, out: str, years=(M.YEAR_A, M.YEAR_B), months=None,
                mode: str = "overwrite", tasks_per_month: int = 1) -> None:
    """Materialise fact rows as parquet partitioned by year and month, with a manifest beside them
    (``<out>.manifest``) that names the source folder and the months held. A month is written by
    ``tasks_per_month`` tasks, a file each; a hash of the row deals its rows to them."""
    f = fact_transactions(spark, src, years, months)
    salt = F.pmod(F.xxhash64(*FACT_COLUMNS), F.lit(tasks_per_month))
    n = len(_months(years, months)) * tasks_per_month
    (f.withColumn("year", F.year("transaction_time")).withColumn("month", F.month("transaction_time"))
     .repartition(n, "year", "month", salt)
     .write.mode(mode).partitionBy("year", "month").parquet(out))
    held = ", ".join(f"({m})" for m in _months(years, months))
    (spark.sql(f"SELECT * FROM VALUES {held} AS t(month)").withColumn("source", F.lit(str(src).rstrip("/")))
     .coalesce(1).write.mode(mode).parquet(f"{out.rstrip('/')}.manifest"))


def read_facts(spark: SparkSession, path: str, src: str, years=(M.YEAR_A,), months=None) -> DataFrame:
    """Facts that ``write_facts`` stored, with partition pruning. Raises if they were made from
    another source folder or lack one of the months asked for."""
    held = spark.read.parquet(f"{path.rstrip('/')}.manifest").collect()     # a row for each month
    if {r["source"] for r in held} != {str(src).rstrip("/")}:
        raise ValueError(f"the facts in {path} were not made from {src}")
    lacking = set(_months(years, months)) - {r["month"] for r in held}
    if lacking:
        raise ValueError(f"the facts in {path} lack the months {sorted(lacking)}")
    cond = F.col("year").isin(list(years))
    if months:
        cond = cond & F.col("month").isin(list(months))
    return spark.read.parquet(path).where(cond).select(*FACT_COLUMNS)


def register_star(spark: SparkSession, src: str) -> None:
    """Temp views under the reference's names, for Spark SQL users."""
    fact_transactions(spark, src, (M.YEAR_A,)).createOrReplaceTempView("fact_transaction_2019")
    fact_transactions(spark, src, (M.YEAR_B,)).createOrReplaceTempView("fact_transaction_2020")
    dim_scenario(spark, src).createOrReplaceTempView("dim_scenario")
    dim_payment_channel(spark, src).createOrReplaceTempView("dim_payment_channel")
    dim_platform(spark).createOrReplaceTempView("dim_platform")
    dim_status(spark).createOrReplaceTempView("dim_status")
