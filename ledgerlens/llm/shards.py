"""Rows dealt to shards by a keyed permutation of their global row numbers.

Rows are numbered in a total order of their content, so the numbers hang on the rows and not on
files, partitions or cluster size. A balanced Feistel network permutes the least even number of
bits that holds all numbers; a result outside the table is permuted again until it falls inside
(cycle walking), which is a permutation of exactly the table's numbers. Number ``x`` goes to shard
``p(x) mod shards``, slot ``p(x) div shards``: counts differ by one at most, slots have no gap, and
either way is computed without the table (``locate``, ``row_at``).

Cases: rows that are equal in every column are told apart by their number only; they are counted
before any shuffle and spread again in blocks, so a row that makes up a third of the table is no
hot key. Null ids sort first, null texts count as empty (8 bytes, checksum 0). An empty table gives
no rows. Columns beside the two named ones only enter the hash that tells rows apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from .common import shared, ship

SHARDS = 24
SEED = 20240229
ROUNDS = 6
BLOCK = 1 << 16             # equal rows that one task spreads at a time


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Permutation:
    """A keyed permutation of 0 .. n - 1 and its inverse, on arrays."""

    def __init__(self, n: int, seed: int = SEED):
        if not 0 < n <= 1 << 62:
            raise ValueError("n is from 1 to 2 ** 62")
        self.n = n
        self.half = max(1, ((n - 1).bit_length() + 1) // 2)
        with np.errstate(over="ignore"):
            steps = np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            self.keys = _mix(np.uint64(seed % (1 << 64)) + steps)

    def _pass(self, x: np.ndarray, keys: np.ndarray, back: bool) -> np.ndarray:
        half, mask = np.uint64(self.half), np.uint64((1 << self.half) - 1)
        left, right = x >> half, x & mask
        for k in keys:
            if back:
                left, right = right ^ (_mix(left ^ k) & mask), left
            else:
                left, right = right, left ^ (_mix(right ^ k) & mask)
        return (left << half) | right

    def _walk(self, x, back: bool) -> np.ndarray:
        keys = self.keys[::-1] if back else self.keys
        with np.errstate(over="ignore"):
            out = self._pass(np.asarray(x, dtype=np.uint64), keys, back)
            outside = np.flatnonzero(out >= self.n)
            while len(outside):         # fewer than four numbers in all for each one inside
                out[outside] = self._pass(out[outside], keys, back)
                outside = outside[out[outside] >= self.n]
        return out.astype(np.int64)

    def forward(self, x) -> np.ndarray:
        return self._walk(x, False)

    def inverse(self, y) -> np.ndarray:
        return self._walk(y, True)


def locate(row, n: int, shards: int = SHARDS, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Shard and slot of each row number of a table of ``n`` rows."""
    at = Permutation(n, seed).forward(np.atleast_1d(row))
    return at % shards, at // shards


def row_at(shard, slot, n: int, shards: int = SHARDS, seed: int = SEED) -> np.ndarray:
    """The row number that lies in each (shard, slot); raises for a slot that is past the shard's last."""
    at = np.atleast_1d(slot) * shards + np.atleast_1d(shard)
    if (at >= n).any() or (at < 0).any() or (np.atleast_1d(shard) >= shards).any():
        raise ValueError("no such shard and slot")
    return Permutation(n, seed).inverse(at)


def _row_hash(docs: DataFrame) -> Column:
    """A hash of all columns; a map, which has no order, by its JSON."""
    return F.xxhash64(*[F.to_json(docs[f"`{f.name}`"]) if "map<" in f.dataType.simpleString() else docs[f"`{f.name}`"]
                        for f in docs.schema.fields])


def numbered(rows: DataFrame) -> tuple[DataFrame, int]:
    """``rows`` with ``row_number`` from 0 in the order of their columns (nulls first), and their
    count. Equal rows are counted on the map side; the distinct ones are sorted by range and
    written once, and each partition's start comes from the partitions' totals."""
    spark, names = rows.sparkSession, rows.columns
    ship(spark)
    order = [F.col(f"`{c}`").asc_nulls_first() for c in names]
    counted = rows.groupBy(*[F.col(f"`{c}`") for c in names]).agg(F.count(F.lit(1)).alias("__n"))
    counted = shared(counted.repartitionByRange(*order).sortWithinPartitions(*order))
    totals = counted.groupBy(F.spark_partition_id().alias("p")).agg(F.sum("__n").alias("n")).collect()  # a row a partition
    starts, total = {}, 0
    for p, n in sorted(map(tuple, totals)):
        starts[p], total = total, total + n

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = starts.get(TaskContext.get().partitionId(), 0)
        for batch in batches:
            n = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
            ends = at + np.cumsum(n)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ends - n, pa.int64())], names=[*batch.schema.names, "__first"])
            at = int(ends[-1]) if len(ends) else at

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in counted.schema.fields) + ", __first long"
    runs = counted.mapInArrow(start, schema)
    few, many = runs.where(F.col("__n") <= BLOCK), runs.where(F.col("__n") > BLOCK)
    many = (many.withColumn("__b", F.explode(F.expr(f"sequence(0L, (__n - 1) div {BLOCK})")))
            .select(*[F.col(f"`{c}`") for c in names], F.expr(f"least(__n - __b * {BLOCK}, {BLOCK}L)").alias("__n"),
                    F.expr(f"__first + __b * {BLOCK}").alias("__first"))
            .repartition("__first"))
    spread = few.unionByName(many)
    return spread.select(*[F.col(f"`{c}`") for c in names],
                         F.explode(F.expr("sequence(__first, __first + __n - 1)")).alias("row_number")), total


def placements(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Per row: ``id``, ``size`` (bytes of the text and 8), ``text_crc32``, ``row_hash``, ``row_number``,
    ``shard`` and ``slot``. Texts are reduced to these numbers before anything is shuffled."""
    text = F.coalesce(docs[f"`{text_col}`"], F.lit("")).cast("binary")
    narrow = docs.select(docs[f"`{id_col}`"].alias("id"), (F.octet_length(text) + 8).cast("long").alias("size"),
                         F.crc32(text).alias("text_crc32"), _row_hash(docs).alias("row_hash"))
    rows, total = numbered(narrow)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields) + ", shard int, slot long"

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = Permutation(total, seed)
        for batch in batches:
            at = p.forward(batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array((at % shards).astype(np.int32), pa.int32()), pa.array(at // shards, pa.int64())],
                names=[*batch.schema.names, "shard", "slot"])

    return rows.mapInArrow(deal, schema)


def write_shards(docs: DataFrame, out: str, shards: int = SHARDS, seed: int = SEED, id_col: str = "doc_id",
                 text_col: str = "text") -> None:
    """The whole rows as Parquet, a folder ``shard=k`` for each shard, its rows in the order of
    ``slot``: a shard's files in the order of their names hold ascending ranges of slots."""
    placed = placements(docs, shards, seed, id_col, text_col).select(
        F.col("id").alias("__id"), F.col("row_hash").alias("__hash"), "shard", "slot")
    taken = {c.lower() for c in docs.columns} & {"shard", "slot", "__id", "__hash"}
    if taken:
        raise ValueError(f"columns {sorted(taken)} are the shards' own")
    whole = docs.withColumn("__hash", _row_hash(docs)).withColumn("__id", F.col(f"`{id_col}`")).dropDuplicates(["__id", "__hash"])
    rows = placed.join(whole, placed["__id"].eqNullSafe(whole["__id"]) & (placed["__hash"] == whole["__hash"]))
    rows = rows.select(*[whole[f"`{c}`"] for c in docs.columns], placed["shard"], placed["slot"])
    (rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.mode("overwrite").partitionBy("shard").parquet(out))
