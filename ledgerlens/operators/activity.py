"""Distinct users per period from one bit set for each user.

``COUNT(DISTINCT user) GROUP BY period`` shuffles a row for every (period, user). Here a user's active
periods are folded with ``bit_or`` into words of 63 bits -- a partial (map-side) aggregate, so a user
with a third of all rows is one row a map task -- and the single shuffle by user carries one row for
each user. The bit sets merge: the months of a quarter or the weeks of a year are the union of their bits,
so coarser counts come from the same table without another pass over the facts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

WORD = 63


def active_periods(facts: DataFrame, user: str, period: Column, periods: int) -> DataFrame:
    """(user, _active): an array of words with a bit for each period, 0 .. ``periods`` - 1, in which the
    user has a row. Rows without a user are a user of their own; a period out of range is an error."""
    words = -(-periods // WORD)
    at = F.when((period < 0) | (period >= periods), F.raise_error(F.lit(f"a period outside 0 to {periods - 1}"))).otherwise(period)
    bits = facts.select(user, at.cast("int").alias("_at"))
    return bits.groupBy(user).agg(F.array(*[
        F.expr(f"bit_or(IF(_at div {WORD} = {w}, shiftleft(1L, _at % {WORD}), 0L))") for w in range(words)]).alias("_active"))


def users_per_period(active: DataFrame, user: str, periods: int, out: str, span: int = 1) -> DataFrame:
    """(_period, ``out``): distinct users of each group of ``span`` consecutive periods that has a row.
    Rows without a user make their periods appear but count for no one."""
    seen = (f"array_distinct(transform(filter(sequence(0, {periods - 1}), i -> "
            f"(_active[i div {WORD}] & shiftleft(1L, i % {WORD})) != 0), i -> i div {span}))")
    return (active.select(user, F.explode(F.expr(seen)).alias("_period"))
            .groupBy("_period").agg(F.count(user).alias(out)))
