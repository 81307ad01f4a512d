"""Set operations and subquery joins with SQL semantics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def union_distinct(*frames: DataFrame, by_name: bool = False) -> DataFrame:
    """``SELECT .. UNION SELECT ..``: bag union, then whole-row DISTINCT.

    Columns pair up by position (SQL); ``by_name`` pairs them by name.
    """
    if not frames:
        raise ValueError("union_distinct needs at least one frame")
    u = reduce((lambda a, b: a.unionByName(b)) if by_name else (lambda a, b: a.union(b)), frames)
    return u.distinct()


def semi_join(df: DataFrame, sub: DataFrame, left: str, right: str | None = None) -> DataFrame:
    """``left IN (SELECT right FROM sub)``: a left semi join (no duplicates from ``sub``).

    The keys are de-duplicated first: a partial aggregate collapses a hot key
    map-side, so the semi join's build side cannot be skewed (AQE can split a
    skewed left side of a semi join, not its right side)."""
    right = right or left
    keys = sub.select(F.col(right).alias("_k")).distinct()
    return df.join(keys, df[left] == keys["_k"], "left_semi")


BLOOM_BITS = 1 << 25        # of the filter below: 4 MB at most, whatever the number of keys


def bloom_filter(df: DataFrame, keys: DataFrame, left: str, key: str) -> DataFrame:
    """Rows of ``df`` whose ``left`` may be among ``keys``, tested against one bit for each hash of
    a key. The filter is at most 1024 bitmaps of 4 KB, which is what is broadcast; it never drops a
    row that has a partner, and lets more of the others through as it fills."""
    def place(c: str):
        return F.pmod(F.xxhash64(c), F.lit(BLOOM_BITS))

    span = 1 << 15                                  # bits of one bitmap
    at = keys.where(F.col(key).isNotNull()).select(place(key).alias("_at"))
    bitmaps = at.groupBy(F.expr(f"_at div {span}").alias("_part")).agg(F.bitmap_construct_agg(F.col("_at") % span).alias("_bits"))
    held = df.withColumn("_at", F.when(F.col(left).isNotNull(), place(left)))
    held = held.join(F.broadcast(bitmaps), F.expr(f"_at div {span}") == F.col("_part"))
    bit = F.expr(f"cast(conv(hex(substring(_bits, cast((_at % {span}) div 8 as int) + 1, 1)), 16, 10) as int) & shiftleft(1, cast(_at % 8 as int))")
    return held.where(bit != 0).drop("_at", "_part", "_bits")


def not_in(df: DataFrame, sub: DataFrame, left: str, right: str | None = None) -> DataFrame:
    """``left NOT IN (SELECT right FROM sub)`` with its NULL rules.

    - ``sub`` empty: every row qualifies, a NULL ``left`` too;
    - ``sub`` holds a NULL: no row qualifies;
    - otherwise rows with a non-NULL ``left`` absent from ``sub``.

    Spark plans SQL ``NOT IN`` as a null-aware anti join only when ``sub`` can
    be broadcast, and as a nested-loop join otherwise. Here the keys are reduced
    to distinct ones (partial aggregate, so a hot key cannot skew the join's
    build side), of which one scalar says whether there are any and whether one
    is NULL; the rest is a plain ``left_anti`` join. It is one lazy plan, and the
    scalar and the join read one exchange: the join key is written with the keys'
    counts, so that the join's ``IS NOT NULL`` stays above the aggregate and both
    branches have the same scan.
    """
    right = right or left
    keys = sub.groupBy(F.col(right).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    state = keys.agg(F.coalesce(F.max(F.when(F.col("_k").isNull(), 2).when(F.col("_n") > 0, 1)), F.lit(0))).scalar()  # 0 empty, 2 NULL
    out = df.withColumn("_state", state)
    out = out.where((F.col("_state") == 0) | ((F.col("_state") == 1) & F.col(left).isNotNull()))
    present = keys.select(F.when(F.col("_n") > 0, F.col("_k")).alias("_k"))
    return out.join(present, F.col(left) == present["_k"], "left_anti").drop("_state")
