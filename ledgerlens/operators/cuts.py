"""Exact order statistics as one lazy plan, and scores by them.

``PERCENT_RANK()`` puts a whole table in one task. A score by fixed cuts needs no ranks, only the values
at which they change: ``percent_rank > q`` holds exactly for the values above the m-th smallest one,
m = floor(q (n - 1)) + 1, as then m rows lie before them. So each cut is found once and every
row is scored by comparing.

A cut is found in two grouped aggregates with mergeable partial sums. Quantile summaries give a
bracket that holds the m-th value for certain (their error is bounded by ``1 / ACCURACY`` of the rows).
Then the rows below the bracket are counted and the values inside it are counted by value, so that a
value which a third of all rows share is one row after the map side; the running sum over the values
of a bracket, at most about ``12 / ACCURACY`` of the rows, reaches m at the cut. All of it is
scalar subqueries over the caller's plan, whose exchanges are reused.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window, functions as F

ACCURACY = 100_000
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1


def ascending(col, descending: bool = False) -> Column:
    """An integer column as a key in ascending order, nulls where SQL Server has them: first in
    ascending, last in descending order."""
    c = (F.col(col) if isinstance(col, str) else col).cast("long")
    return F.coalesce(-c, F.lit(HIGHEST)) if descending else F.coalesce(c, F.lit(LOWEST))


def cut_values(df: DataFrame, keys: dict[str, Column], shares: tuple[Fraction, ...]) -> Column:
    """A scalar: a struct that holds, for each named integer key without nulls, an array of the values
    ``x`` with ``percent_rank > share`` exactly where ``key > x``, one for each of ``shares``."""
    rows = df.select(*[k.alias(name) for name, k in keys.items()])
    margin = Fraction(5, ACCURACY)
    grid = sorted({Fraction(0), Fraction(1)} | {min(max(s + d, Fraction(0)), Fraction(1)) for s in shares for d in (-margin, margin)})
    points = "array(" + ", ".join(f"{float(p)!r}D" for p in grid) + ")"
    summary = rows.agg(F.count(F.lit(1)).alias("n"), *[
        F.expr(f"percentile_approx(cast({name} as double), {points}, {ACCURACY})").alias(f"_{name}") for name in keys])
    # The summaries' points next to the m-th row on both sides, two rows and the summaries' error away.
    bounds = []
    for name in keys:
        for share in shares:
            m = f"(({share.numerator} * (n - 1)) div {share.denominator} + 1)"
            low = f"size(filter({points}, p -> p <= ({m} - 2) / n - {2 / ACCURACY}D))"
            high = f"size(filter({points}, p -> p < ({m} + 2) / n + {2 / ACCURACY}D)) + 1"
            bounds.append(F.expr(f"named_struct('m', {m}, 'low', if({low} > 0, element_at(_{name}, {low}), double('-infinity')), "
                                 f"'high', if({high} <= {len(grid)}, element_at(_{name}, {high}), double('infinity')))"))
    bounds = summary.where("n > 0").select(F.array(*bounds).alias("b")).scalar()

    targets = [(name, share) for name in keys for share in shares]
    near = rows.withColumn("_b", bounds)
    entries = F.array(*[F.when(F.col(name).cast("double") <= F.col("_b")[j]["high"], F.struct(
        F.lit(j).alias("j"), F.col("_b")[j]["m"].alias("m"),
        F.when(F.col(name).cast("double") >= F.col("_b")[j]["low"], F.col(name)).alias("v"))) for j, (name, _) in enumerate(targets)])
    counted = (near.select(F.explode(F.filter(entries, lambda e: e.isNotNull())).alias("e"))
               .groupBy("e.j", "e.m", "e.v").agg(F.count(F.lit(1)).alias("n")))
    reached = F.sum("n").over(Window.partitionBy("j").orderBy(F.col("v").asc_nulls_first()))
    counted = counted.withColumn("reached", reached).where("reached >= m")
    value = F.when(F.bool_or(F.col("v").isNull()), F.raise_error(F.lit("a bracket missed its order statistic"))).otherwise(F.min("v"))
    found = counted.groupBy("j").agg(value.cast("long").alias("v"))
    return found.agg(F.struct(*[
        F.array(*[F.max(F.when(F.col("j") == j, F.col("v"))) for j, (t, _) in enumerate(targets) if t == name]).alias(name)
        for name in keys])).scalar()


def score(key: Column, cuts: Column, n: int) -> Column:
    """1 and one more for each of the ``n`` ascending cuts that ``key`` is above."""
    out = F.lit(1)
    for i in range(n):
        out = out + (key > cuts[i]).cast("int")
    return out
