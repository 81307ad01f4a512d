"""Column recipes against the SQL Server behaviour they stand for (traps T01-T14)."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import (concat_text, day_boundaries, decimal_text_pct, int_part, like, like_to_regex,
                                  literal_day_text, mm_yy, month_boundaries, nvl_text, pct_text, prefix_before,
                                  ratio, us_week)
from ledgerlens.functions.numeric import int_avg


def one(spark, col, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(col).collect()]


@pytest.mark.parametrize("day,week", [
    ("2019-12-31", 53), ("2000-12-31", 54), ("2022-01-01", 1), ("2022-01-02", 2),
    ("2022-04-20", 17), ("2023-01-01", 1), ("2021-01-02", 1), ("2021-01-03", 2),
])
def test_us_week(spark, day, week):
    # SELECT DATEPART(week, '2022-04-20') -> 17 (the reference's probe)
    assert one(spark, us_week(F.col("d")), [(dt.date.fromisoformat(day),)], "d date") == [week]


def test_month_and_day_boundaries(spark):
    rows = [(dt.datetime(2019, 1, 31, 23), dt.datetime(2019, 2, 1, 0)),
            (dt.datetime(2019, 12, 1), dt.datetime(2020, 1, 31)),
            (dt.datetime(2019, 3, 5), dt.datetime(2019, 3, 28))]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    got = df.select(month_boundaries("a", "b").alias("m"), day_boundaries("a", "b").alias("d")).collect()
    assert [(r.m, r.d) for r in got] == [(1, 1), (1, 61), (0, 23)]


@pytest.mark.parametrize("pattern,text,hit", [
    ("BK-[^T]%-[0-9][0-9]", "BK-R93R-48", True),
    ("BK-[^T]%-[0-9][0-9]", "BK-T79U-46", False),
    ("BK-[^T]%-[0-9][0-9]", "BK-R93R-4", False),
    ("[3-4][3-4][1-4]", "342", True),
    ("[3-4][3-4][1-4]", "241", False),
    ("________%", "1234567", False),
    ("________%", "12345678", True),
    ("%HL%", "a hl b", True),      # case-insensitive collation
    ("a.b", "axb", False),          # regex metacharacters are literal
])
def test_like_classes(spark, pattern, text, hit):
    assert one(spark, like(F.col("s"), pattern), [(text,)], "s string") == [hit]


def test_like_to_regex_anchored():
    rx = like_to_regex("ab%")
    assert rx.startswith("(?s)^") and rx.endswith("\\z")
    assert re.fullmatch(like_to_regex("[^T]_").replace("\\z", "$").replace("(?s)", ""), "Ax")


def test_prefix_before(spark):
    data = [("HL Road Frame - Black, 58",), ("no dash",), ("-lead",), (None,)]
    assert one(spark, prefix_before(F.col("s")), data, "s string") == ["HL Road Frame ", "", "", None]


def test_int_part_truncates(spark):
    data = [(2442.50,), (2443.99,), (-1.5,)]
    assert one(spark, int_part(F.col("x")), data, "x double") == [2442, 2443, -1]


def test_int_avg(spark):
    df = spark.createDataFrame([(1,), (2,), (4,)], "x long")
    assert df.select(int_avg("x")).first()[0] == 2        # 7/3 -> 2, not 2.33


def test_ratio_and_percent_texts(spark):
    df = spark.createDataFrame([(12345, 100000), (12345, 1000), (1, 8), (-1, 8), (5, 0), (2, 3)], "n long, d long")
    got = df.select(ratio("n", "d", 6, percent=True).alias("r"), pct_text("n", "d").alias("p"),
                    decimal_text_pct("n", "d").alias("t")).collect()
    assert [r.p for r in got] == ["12.35%", "1,234.50%", "12.50%", "-12.50%", None, "66.67%"]
    assert [r.t for r in got] == ["12.35%", "1234.50%", "12.50%", "-12.50%", None, "66.67%"]
    assert [r.r for r in got] == [12.345, 1234.5, 12.5, -12.5, None, 66.666667]


def test_concat_and_nvl(spark):
    df = spark.createDataFrame([(1, None, 3)], "a int, b int, c int")
    assert df.select(concat_text("a", "b", "c")).first()[0] == "13"       # CONCAT skips NULL
    df2 = spark.createDataFrame([(None,), ("x",)], "s string")
    assert [r[0] for r in df2.select(nvl_text("s")).collect()] == ["", "x"]


def test_literal_minutes_and_mm_yy(spark):
    df = spark.createDataFrame([(dt.datetime(2019, 3, 7, 10, 45),)], "t timestamp_ntz")
    r = df.select(literal_day_text("t").alias("a"), mm_yy("t").alias("b")).first()
    assert (r.a, r.b) == ("19.45.07", "03/19")       # 'mm' is minutes in the reference's pattern


def test_minutes_pattern_on_events_matches_duckdb(spark):
    """'yy.mm.dd' counts (year, MINUTE, day) -- checked on the events table,
    whose timestamps carry real minutes (the mapped facts are all midnight)."""
    import duckdb
    from ledgerlens.sources.tables import read_table
    src = "/root/testdata/sf0.01"
    ev = read_table(spark, src, "events", ["user_id", "ts"])
    got = {(r.user_id, r.n) for r in ev.groupBy("user_id").agg(
        F.count_distinct(literal_day_text(F.col("ts"))).alias("n")).collect()}
    want = set(duckdb.sql(f"SELECT user_id, count(DISTINCT strftime(ts, '%y.%M.%d')) FROM '{src}/events.parquet' "
                          "GROUP BY user_id").fetchall())
    assert got == want and len(got) > 100
    calendar = dict(duckdb.sql(f"SELECT user_id, count(DISTINCT CAST(ts AS DATE)) FROM '{src}/events.parquet' "
                               "GROUP BY user_id").fetchall())
    assert any(n != calendar[u] for u, n in got)      # the minutes pattern is not the calendar day
