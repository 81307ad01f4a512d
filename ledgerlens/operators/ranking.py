"""``TOP n`` and ``TOP n PERCENT`` without a single-partition sort, as one lazy plan.

``orderBy(x).limit(k)`` with a large k moves every row into one task. Here Spark's range
partitioning deals the rows over the whole order, one grouped count gives each range its least and
greatest key and its rows, and a running sum over the ranges names the range that holds the k-th
row. Rows before that range are kept by comparing, and only the range itself is cut.

The cut is made by values, not by partition ids, so nothing depends on a layout being reproduced
when a task is recomputed after executor loss. No job runs while a report is built.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

COPIES = 100_000        # equal rows written by one array; more of them take more arrays


def _ascending(df: DataFrame, name: str, descending: bool) -> Column:
    """``name`` as a key whose ascending order is the wanted one: NULLs low, NaN above all numbers.
    Descending keys must be numbers, dates, timestamps or booleans, which can be turned round."""
    key, kind = F.col(f"`{name}`"), df.schema[name].dataType
    if not descending:
        return key
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.struct(key.isNull(), ~F.isnan(key), -key)
    if isinstance(kind, T.DecimalType):
        return F.struct(key.isNull(), -key)
    if isinstance(kind, T.TimestampType):
        key = F.unix_micros(key)
    elif isinstance(kind, T.DateType):
        key = F.unix_date(key)
    elif isinstance(kind, T.BooleanType):
        key = key.cast("int")
    elif not isinstance(kind, T.IntegralType):
        raise TypeError(f"no descending order over {kind.simpleString()}")
    return F.struct(key.isNull(), F.bitwise_not(key))


def _first(df: DataFrame, order: list[tuple[str, bool]], wanted: str, buckets: int | None) -> DataFrame:
    """The first rows in ``order``, as many as ``wanted`` (SQL over the row count ``total``) says."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    # Ties on all keys go by a hash of the row, so that only equal rows tie.
    key = F.struct(*[_ascending(df, c, d) for c, d in order], F.xxhash64(*columns))
    rows = df.select(key.alias("_key"), F.struct(*columns).alias("_row"))
    keys = rows.select("_key")
    ranged = keys.repartitionByRange("_key") if buckets is None else keys.repartitionByRange(buckets, "_key")
    ranges = ranged.groupBy(F.spark_partition_id().alias("_part")).agg(
        F.min("_key").alias("low"), F.max("_key").alias("high"), F.count(F.lit(1)).alias("n"))
    # As many rows as there are ranges.
    ranges = ranges.select("low", "high", "n", F.sum("n").over(Window.orderBy("low")).alias("upto"),
                           F.sum("n").over(Window.partitionBy()).alias("total")).withColumn("k", F.expr(f"least({wanted}, total)"))
    cut = ranges.where("upto - n < k AND k <= upto").select(
        F.struct("low", "high", (F.col("k") - F.col("upto") + F.col("n")).alias("need"))).scalar()
    rows = rows.withColumn("_cut", cut)
    whole = rows.where("_key < _cut.low").select("_row.*")
    # The range of the k-th row: equal rows are one row with a count.
    within = (rows.where("_key >= _cut.low AND _key <= _cut.high")
              .groupBy("_key", "_row", F.col("_cut.need").alias("need")).agg(F.count(F.lit(1)).alias("n")))
    within = within.withColumn("before", F.sum("n").over(Window.orderBy("_key")) - F.col("n")).where("before < need")
    within = within.withColumn("n", F.expr("least(n, need - before)"))
    within = within.withColumn("_from", F.explode(F.expr(f"sequence(0L, n - 1, {COPIES}L)")))
    within = within.select("_row", F.explode(F.expr(f"array_repeat(0, cast(least(n - _from, {COPIES}) as int))")))
    return whole.unionByName(within.select("_row.*"))


def top_k(df: DataFrame, order: list[tuple[str, bool]], k: int, buckets: int | None = None) -> DataFrame:
    """The first ``k`` rows of ``df`` in ``ORDER BY order`` (exactly k, or all
    rows if fewer), without sorting the table into one task. ``order`` =
    [(column, descending), ...], NULLs low (first ascending, last descending).
    Rows that tie on every key past the k-th are cut by a hash of the row. ``buckets`` = number of
    ranges; by default Spark sizes them by bytes."""
    return _first(df, order, f"{max(0, int(k))}L", buckets)


def top_percent(df: DataFrame, percent, order: list[tuple[str, bool]], buckets: int | None = None) -> DataFrame:
    """``SELECT TOP n PERCENT ... ORDER BY``: ceil(n% of the rows)."""
    share = Fraction(str(percent)) / 100
    return _first(df, order, f"((total * {share.numerator} + {share.denominator - 1}) div {share.denominator})", buckets)
