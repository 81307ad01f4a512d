"""Prefix trie of conversations, its subtree totals by time-forward processing.

A node is a distinct sequence of turns from the start of a conversation. Turns become 128-bit
digests before any shuffle, and a node's name is a chained digest of its turns, made in one stream
over sorted conversations; texts never move. Totals go up the trie by time-forward processing:
nodes are sorted externally in reverse level order and every node sends its totals to its parent
through a priority queue that spills, so one pass over the sorted nodes does all levels.

Shards: a node with more than ``t`` members, ``t`` the root of the number of (conversation, depth)
rows, is heavy; there are fewer than ``t`` of these, and they are upward closed. A light node below
a heavy one is a shard root; its subtree has at most ``t`` members. Shards are worked on their own,
then the totals of the shard roots, added up by parent, are the messages to the heavy nodes, which
are worked in one task. A first turn that a third of all conversations share is a heavy node and
its continuations are shards of their own.

Cases: turns in ascending order, null first, then by digest of role and text (ties); repeated rows
are turns of their own; null role or text counts as empty; rows without a conversation id belong to
no conversation and are left out. An empty table has no nodes, not even a root. Other columns are
not read. One conversation is a stream of one task, however long; nothing of it is held.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import shared, ship

ROOT = bytes(16)
FEWEST = 50                 # members that make a node heavy, at least
QUEUED = 200_000            # messages of a task held in memory; more are spilled in sorted runs
ID_BITS = 16                # member ids are listed in blocks of 2 ** 16 consecutive numbers
EMPTY = hashlib.sha256(b"").hexdigest()


class SpillingQueue:
    """A priority queue of tuples. Beyond ``limit`` entries it writes them as a sorted run to a file
    of the task's own, which ends with the task, and merges the runs while they are read."""

    def __init__(self, limit: int = QUEUED):
        self.limit, self.heap, self.runs, self.spilled = limit, [], [], 0

    def push(self, item: tuple) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.limit:
            run = self._written(sorted(self.heap))
            self.heap = []
            self.spilled += 1
            heapq.heappush(self.runs, (next(run), self.spilled, run))

    @staticmethod
    def _written(items: list) -> Iterator[tuple]:
        f = tempfile.TemporaryFile()
        for at in range(0, len(items), 1000):
            pickle.dump(items[at:at + 1000], f)
        n = (len(items) + 999) // 1000
        del items
        f.seek(0)

        def read() -> Iterator[tuple]:
            with f:
                for _ in range(n):
                    yield from pickle.load(f)
        return read()

    def least(self) -> tuple | None:
        if self.runs and (not self.heap or self.runs[0][0] < self.heap[0]):
            return self.runs[0][0]
        return self.heap[0] if self.heap else None

    def pop(self) -> tuple:
        if self.runs and (not self.heap or self.runs[0][0] < self.heap[0]):
            item, k, run = self.runs[0]
            following = next(run, None)
            if following is None:
                heapq.heappop(self.runs)
            else:
                heapq.heapreplace(self.runs, (following, k, run))
            return item
        return heapq.heappop(self.heap)


def rebuilt_turns(conversations: DataFrame, period: int = 5, shared_turns: int = 9) -> DataFrame:
    """(conv, kind, pos, digest, bytes): each conversation c as the first h turns of conversation
    c - c % period (kind 1), then its own after its first h (kind 2), h = crc32(decimal c) %
    shared_turns; kind 0 marks that c exists. Kind 1 rows without a mark are of no conversation."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    said = F.unhex(F.left(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), F.lit(32)))
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", said.alias("digest"), F.octet_length(text).cast("long").alias("bytes"))
    turns = turns.withColumn("pos", F.expr(
        "row_number() OVER (PARTITION BY conv_id ORDER BY turn ASC NULLS FIRST, digest) - 1").cast("long"))

    def h(c: str) -> str:
        return f"crc32(CAST(CAST({c} AS STRING) AS BINARY)) % {shared_turns}"

    near = f"filter(transform(sequence({1 - period}L, {period - 1}L), i -> try_add(conv_id, i)), c -> c IS NOT NULL AND c - c % {period} = conv_id AND pos < {h('c')})"
    copies = F.expr(f"""concat(
        IF(pos = 0, array(named_struct('conv', conv_id, 'kind', 0)), array()),
        IF(conv_id % {period} = 0 AND pos < {shared_turns - 1},
           transform({near}, c -> named_struct('conv', c, 'kind', 1)), array()),
        IF(pos >= {h('conv_id')}, array(named_struct('conv', conv_id, 'kind', 2)), array()))""")
    return (turns.withColumn("to", F.explode(copies))
            .select("to.conv", "to.kind", "pos", "digest", "bytes"))


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of sorted conversations -> a row for every (conversation, depth), the root's included."""
    conv, node, depth, waiting = None, ROOT, 0, None
    for batch in batches:
        out = []
        for c, kind, _, digest, size in zip(*(x.to_pylist() for x in batch.columns)):
            if kind == 0:
                if waiting:
                    out.append((*waiting, True))
                conv, node, depth, waiting = c, ROOT, 0, (c, ROOT, None, 0, 0)
            elif c == conv:
                out.append((*waiting, False))
                parent, depth = node, depth + 1
                node = hashlib.blake2b(parent + digest, digest_size=16).digest()
                waiting = (c, node, parent, depth, size)
        yield _rows(out, ROW)
    if waiting:
        yield _rows([(*waiting, True)], ROW)


ROW = pa.schema([("conv", pa.int64()), ("node", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()),
                 ("bytes", pa.int64()), ("ends", pa.bool_())])
TOTALS = pa.schema([("shard", pa.binary()), ("node", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("conv", pa.int64()),
                    ("n_convs", pa.int64()), ("parent_conv", pa.int64()), ("n_children", pa.int64()),
                    ("n_leaves", pa.int64()), ("saved", pa.int64())])


def _rows(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {'binary' if f.type == pa.binary() else 'boolean' if f.type == pa.bool_() else 'long'}" for f in schema)


def _time_forward(heavy, limit: int = QUEUED):
    """A stream of nodes in reverse level order -> the same nodes with their subtrees' totals. A
    node takes all messages to it from the queue's top and sends its own totals to its parent,
    which comes later; the messages of shard roots, whose parents are heavy, are their rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue, tops = SpillingQueue(limit), heavy.value
        for batch in batches:
            out = []
            for shard, node, parent, depth, conv, members, size, children, leaves, saved in zip(*(x.to_pylist() for x in batch.columns)):
                while (top := queue.least()) and top[0] == -depth and top[1] == node:
                    _, _, a, b = queue.pop()
                    children, leaves, saved = children + 1, leaves + a, saved + b
                leaves, saved = leaves or 1, saved + (members - 1) * size
                if parent is not None and (shard is None or node != shard):
                    queue.push((1 - depth, parent, leaves, saved))
                out.append((shard, node, parent, depth, conv, members, tops.get(parent), children, leaves, saved))
            yield _rows(out, TOTALS)
    return run


def _shards(heavy):
    """Streams of (conversation, depth) rows -> each with its shard: the first light node of the
    conversation, null for heavy nodes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops, shard = heavy.value, None
        for batch in batches:
            found = []
            for node, parent in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if node in tops:
                    shard = None
                elif parent is None or parent in tops:
                    shard = node
                found.append(shard)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary())], names=[*batch.schema.names, "shard"])
    return run


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (node, block, list text) -> (node, digest of its lists joined by commas)."""
    node, state = None, None
    for batch in batches:
        out = []
        for v, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if v != node:
                if node is not None:
                    out.append((node, state.hexdigest()))
                node, state = v, hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.binary()), pa.array([r[1] for r in out], pa.string())],
                                         names=["node", "ends_sha256"])
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([state.hexdigest()], pa.string())],
                                         names=["node", "ends_sha256"])


def id_list_digests(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) of the ascending, comma-joined ids of rows (node, conv). Ids are listed
    in blocks of consecutive numbers and the digest is a stream over the blocks: no list of all."""
    blocks = (ends.groupBy("node", F.shiftright("conv", ID_BITS).alias("block"))
              .agg(F.sort_array(F.collect_list("conv")).alias("ids"))
              .select("node", "block", F.concat_ws(",", F.transform("ids", lambda x: x.cast("string"))).alias("text")))
    blocks = blocks.repartition("node").sortWithinPartitions("node", "block")
    return blocks.mapInArrow(_digests, "node binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame, turns: DataFrame | None = None, queued: int = QUEUED,
                fewest: int = FEWEST) -> DataFrame:
    """Every node of the trie of ``turns`` (as ``rebuilt_turns`` gives them, by default those of
    ``conversations``): conv_id (least member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens (bytes that a cache of prefixes saves in the subtree), ends_sha256."""
    spark = conversations.sparkSession
    ship(spark)
    turns = rebuilt_turns(conversations) if turns is None else turns
    rows = shared(turns.repartition("conv").sortWithinPartitions("conv", "kind", "pos").mapInArrow(_chain, _ddl(ROW)))
    limit = max(fewest, math.isqrt(rows.count()))
    # Each heavy node has more than ``limit`` of the rows: fewer than their root of them exist.
    found = rows.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("conv")).where(F.col("n") > limit)
    heavy = spark.sparkContext.broadcast({bytes(r["node"]): r["conv"] for r in found.collect()})

    dealt = rows.mapInArrow(_shards(heavy), _ddl(ROW) + ", shard binary")
    nodes = shared(dealt.groupBy("shard", "node").agg(
        F.min("parent").alias("parent"), F.min("depth").alias("depth"), F.min("conv").alias("conv"),
        F.count(F.lit(1)).alias("n_convs"), F.max("bytes").alias("bytes")))
    order = [F.col("depth").desc(), F.col("node")]
    columns = ["shard", "node", "parent", "depth", "conv", "n_convs", "bytes"]
    zero = F.lit(0).cast("long")
    light = (nodes.where("shard IS NOT NULL").select(*columns, zero.alias("children"), zero.alias("leaves"), zero.alias("saved"))
             .repartition("shard").sortWithinPartitions(*order).mapInArrow(_time_forward(heavy, queued), _ddl(TOTALS)))
    light = shared(light)
    sent = (light.where("node = shard AND parent IS NOT NULL").groupBy(F.col("parent").alias("to"))
            .agg(F.count(F.lit(1)).alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved").alias("saved")))
    crown = nodes.where("shard IS NULL").join(sent, F.col("node") == F.col("to"), "left").select(
        *columns, *[F.coalesce(F.col(c), zero).alias(c) for c in ("children", "leaves", "saved")])
    crown = crown.repartition(1).sortWithinPartitions(*order).mapInArrow(_time_forward(heavy, queued), _ddl(TOTALS))

    # A light parent is in its child's shard and has few children; a heavy one's member came by broadcast.
    above = nodes.where("shard IS NOT NULL").select(F.col("shard").alias("s"), F.col("node").alias("p"), F.col("conv").alias("above"))
    light = light.join(above, (F.col("shard") == F.col("s")) & (F.col("parent") == F.col("p")), "left")
    light = light.withColumn("parent_conv", F.coalesce("parent_conv", "above")).drop("s", "p", "above")
    ends = id_list_digests(rows.where("ends").select("node", "conv"))
    return (light.unionByName(crown).join(ends, "node", "left")
            .select(F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs", "n_children",
                    "n_leaves", F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256")))
