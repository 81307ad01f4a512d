"""Near-duplicate documents through SetSketch registers.

A document's set is its distinct 5-word shingles (64-bit hashes). Its sketch has ``REGISTERS``
registers; register i holds ``floor(1 - log_BASE h_i)`` for the least exponential variate h_i of
the set, clipped to 16 bits: exponentially spaced, truncated minima. Sketches of parts merge by
the greater register. Equal registers are about as likely as the Jaccard likeness J, so bands of
``ROWS`` registers collide with chance J**ROWS each; at J = 0.75 a pair misses all bands with
chance (1 - 0.42)**32 = 2.4e-8.

1. Equal sets collapse to one class, named by a 128-bit hash; only classes go on.
2. In every band bucket each member meets the least member (one pair a member, never all pairs).
   The sketches' joint likelihood drops pairs that are surely below the threshold, the full sets
   confirm the rest, and confirmed pairs are joined into components.
3. A bucket whose members still lie in several components may hide a link between two members
   that are both not its least one. In buckets of few members those pairs, across components, are
   estimated and confirmed too; crowded buckets are dealt into blocks, and any two blocks are
   tested exactly in one task that returns only links that join components. Then the components
   are joined again. Pairs inside one component can't change it.

Cases: null or blank text has an empty set and is linked with nothing. Fewer words than five are
one shingle. Rows that repeat a doc_id are judged by their own text: links,
components and labels are those of sets, never of ids; equal rows have equal results. A null doc_id has a null
component and is kept. Columns other than the two named ones are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.relational import bloom_filter
from .common import give_back, parts, shared, ship, written
from .graph import components

WORDS = 5               # words of a shingle
LIKENESS = 75           # least percentage: 100 * intersection >= LIKENESS * union
ROWS, BANDS = 3, 32
REGISTERS = ROWS * BANDS
BASE, RATE, TOP = 1.001, 20.0, 65534    # spacing, rate and greatest value of the registers
DOUBT = 20.0            # a pair goes when its best likelihood beats any at the threshold by exp(DOUBT)

FEW = 8                 # members of a bucket up to which its pairs are rows
CROWD, COLUMNS = 500, 4096      # members of a block in a crowded bucket; shingles multiplied at a time
PAIRS = 1000            # pairs whose likelihoods are worked out at a time

U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (shifts and odd multipliers)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_SEEDS = _mix(np.arange(1, 2 * REGISTERS + 1, dtype=np.uint64) * U(0x9E3779B97F4A7C15))
_TIMES, _PLUS = _SEEDS[:REGISTERS] | U(1), _SEEDS[REGISTERS:]
_PLACE = [int(x) | 1 for x in _mix(np.arange(101, 101 + WORDS, dtype=np.uint64) * U(0x9E3779B97F4A7C15))]


class WordHashes(dict):
    """Word -> 64-bit hash, remembered up to a number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        h = xxhash.xxh64_intdigest(word)
        if len(word) < 64:
            self[word] = h
        return h


_HASHES = WordHashes()


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; words are runs of non-white-space
    (space, tab, line feed, vertical tab, form feed, carriage return), A-Z in lower case."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if not n:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(_HASHES.__getitem__, words), dtype=np.uint64, count=n)
    k = min(WORDS, n)
    total = np.full(n - k + 1, n if n < WORDS else 0, dtype=np.uint64)
    for i in range(k):
        total += h[i:n - k + 1 + i] * U(_PLACE[i])
    return np.unique(_mix(total))


def registers(hashes: np.ndarray) -> np.ndarray:
    """SetSketch registers of a set; the greater of two sketches' registers is the union's."""
    if not len(hashes):
        return np.zeros(REGISTERS, dtype="<u2")
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(hashes), 512):
        np.minimum(least, (hashes[at:at + 512, None] * _TIMES + _PLUS).min(axis=0), out=least)
    share = (least.astype(np.float64) + 0.5) / 2.0 ** 64
    variate = -np.log1p(-np.minimum(share, 1 - 1e-16)) / RATE
    level = np.floor(1 - np.log(variate) / np.log(BASE))
    return np.clip(level, 0, TOP).astype("<u2")


def joint_support(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per pair of sketches: the likeness of greatest joint likelihood and by how much (log)
    that likelihood beats the best one at the threshold or above (0 if it is there itself).

    The counts of greater, lesser and equal registers are multinomial given J and the sizes.
    """
    a, b = a.astype(np.int32), b.astype(np.int32)
    more, less = (a > b).sum(1)[:, None], (a < b).sum(1)[:, None]
    same = a.shape[1] - more - less
    u = (n_a / (n_a + n_b))[:, None]
    v = 1 - u
    grid = np.arange(0, 101)[None, :] / 100.0
    possible = grid <= np.minimum(u / v, v / u) + 1e-9

    def p(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 1e-12, 1) * (BASE - 1) / BASE) / np.log(BASE)

    up, down = np.clip(p(u - v * grid), 1e-9, 1), np.clip(p(v - u * grid), 1e-9, 1)
    log = more * np.log(up) + less * np.log(down) + same * np.log(np.clip(1 - up - down, 1e-9, 1))
    log = np.where(possible, log, -np.inf)
    best = log.max(1)
    at_least = log[:, LIKENESS:].max(1)
    return log.argmax(1) / 100.0, best - np.maximum(at_least, -1e9)


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_shingles, set_key (128-bit hash of the set, null if empty), sketch (binary)."""
    ship(docs.sparkSession)
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = src.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for b in batches for p in parts(b)):
            sets = [shingles(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([_key(s) if len(s) else None for s in sets], pa.binary()),
                pa.array([registers(s).tobytes() if len(s) else None for s in sets], pa.binary())],
                names=["id", "n_shingles", "set_key", "sketch"])
        _HASHES.clear()
        give_back()

    return src.mapInArrow(run, f"id {kind}, n_shingles long, set_key binary, sketch binary")


def _likely() -> Column:
    """Pandas UDF over (sketch, sketch, size, size): may the pair reach the threshold?"""
    @F.pandas_udf("boolean")
    def likely(a, b, n, m):
        import pandas as pd
        if not len(a):
            return pd.Series([], dtype=bool)
        x = np.frombuffer(b"".join(a), dtype="<u2").reshape(len(a), REGISTERS)
        y = np.frombuffer(b"".join(b), dtype="<u2").reshape(len(b), REGISTERS)
        n, m = n.to_numpy(float), m.to_numpy(float)
        some = [slice(i, i + PAIRS) for i in range(0, len(n), PAIRS)]
        return pd.Series(np.concatenate([joint_support(x[s], y[s], n[s], m[s])[1] <= DOUBT for s in some]))
    return likely


def _linked() -> Column:
    """Pandas UDF over two full sets: the stated test on intersection and union sizes."""
    @F.pandas_udf("boolean")
    def linked(a, b):
        import pandas as pd
        out = []
        for x, y in zip(a, b):
            x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            out.append(100 * both >= LIKENESS * (len(x) + len(y) - both))
        return pd.Series(out, dtype=bool)
    return linked


def _key(full: np.ndarray) -> bytes:
    """The class of a set: a 128-bit hash of its sorted shingles."""
    return hashlib.blake2b(full.tobytes(), digest_size=16).digest()


def _sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(key, full) of the wanted classes, rows (id, key): the full sets as sorted 64-bit hashes. Only
    the texts of the ids are dealt out, thinned by a Bloom filter of bounded size before that; an
    id that several texts have gives the wanted ones of them."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    ids = wanted.select("id").distinct()
    src = bloom_filter(src, ids, "id", "id").join(ids, "id", "left_semi").select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for b in batches for p in parts(b, column=0)):
            sets = [shingles(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([_key(s) for s in sets], pa.binary()),
                                              pa.array([s.tobytes() for s in sets], pa.binary())], names=["key", "full"])
        _HASHES.clear()
        give_back()

    found = src.mapInArrow(run, "key binary, full binary").where(F.length("full") > 0)
    return found.join(wanted.select("key").distinct(), "key", "left_semi").dropDuplicates(["key"])


def _confirmed(pairs: DataFrame, reps: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The pairs (a, b) of classes that stand on full sets: first the sketches' joint likelihood, then the sets."""
    s = reps.select("key", "n_shingles", "sketch")
    near = (pairs.join(s.select(F.col("key").alias("a"), F.col("n_shingles").alias("na"), F.col("sketch").alias("sa")), "a")
            .join(s.select(F.col("key").alias("b"), F.col("n_shingles").alias("nb"), F.col("sketch").alias("sb")), "b")
            .where(F.lit(100) * F.least("na", "nb") >= F.lit(LIKENESS) * F.greatest("na", "nb"))
            .where(_likely()("sa", "sb", "na", "nb")).select("a", "b"))
    near = written(near)
    wanted = written(reps.select("id", "key").join(near.select(F.explode(F.array("a", "b")).alias("key")).distinct(), "key", "left_semi"))
    sets = _sets(docs, wanted, id_col, text_col)
    return (near.join(sets.select(F.col("key").alias("a"), F.col("full").alias("fa")), "a")
            .join(sets.select(F.col("key").alias("b"), F.col("full").alias("fb")), "b")
            .where(_linked()("fa", "fb")).select("a", "b").distinct())


def forest(full: list[np.ndarray], component: list) -> list[tuple[int, int]]:
    """Links (positions) that join all linked sets of different components: the exact test on all
    pairs by products of incidence matrices, of which only joining ones are returned."""
    sizes = np.array([len(x) for x in full])
    every = np.concatenate(full)
    owner = np.repeat(np.arange(len(full)), sizes)
    _, column, count = np.unique(every, return_inverse=True, return_counts=True)
    often = count > 1
    place = np.cumsum(often) - 1
    keep = often[column]
    column, owner = place[column[keep]], owner[keep]
    both = np.zeros((len(full), len(full)), dtype=np.float32)
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    for lo in range(0, int(often.sum()), COLUMNS):
        x, y = np.searchsorted(column, [lo, lo + COLUMNS])
        part = np.zeros((len(full), COLUMNS), dtype=np.float32)
        part[owner[x:y], column[x:y] - lo] = 1
        both += part @ part.T
    label = np.unique(component, return_inverse=True)[1]
    links = 100 * both >= LIKENESS * (sizes[:, None] + sizes[None, :] - both)
    a, b = np.nonzero(np.triu(links, 1) & (label[:, None] != label[None, :]))
    parent: dict = {}

    def root(x):
        while parent.get(x, x) != x:
            parent[x] = parent.get(parent[x], parent[x])
            x = parent[x]
        return x

    out = []
    for i, j in zip(a.tolist(), b.tolist()):
        x, y = root(component[i]), root(component[j])
        if x != y:
            parent[max(x, y)] = min(x, y)
            out.append((i, j))
    return out


def _crowded_links(rest: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Links across components among the members of crowded buckets: a bucket is dealt into
    blocks of about ``CROWD`` members, two blocks meet in one task, and only links that join
    components leave it. A component of ``CROWD`` members and more is a lot of its own, whose
    blocks needn't meet each other; the rest of a bucket is one lot (null). No pairs are made as
    rows, and no task holds more than two blocks."""
    lots = (rest.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("bucket", F.when(F.col("n") >= CROWD, F.col("component")).alias("lot")).agg(F.sum("n").alias("n"))
            .groupBy("bucket").agg(F.collect_list(F.struct("lot", F.ceil(F.col("n") / CROWD).cast("int").alias("blocks"))).alias("lots")))
    met = rest.join(lots, "bucket").withColumn("lot", F.when(F.exists("lots", lambda x: x["lot"] == F.col("component")), F.col("component")))
    blocks = F.element_at(F.filter("lots", lambda x: x["lot"].eqNullSafe(F.col("lot"))), 1)["blocks"]
    own = F.struct("lot", F.pmod(F.xxhash64("key"), blocks).cast("int").alias("k"))
    others = F.filter("lots", lambda x: x["lot"].isNull() | ~x["lot"].eqNullSafe(F.col("lot")))
    others = F.flatten(F.transform(others, lambda x: F.transform(
        F.sequence(F.lit(0), x["blocks"] - 1), lambda k: F.struct(x["lot"].alias("lot"), k.alias("k")))))
    met = met.select("bucket", "key", "component", own.alias("own"), F.explode(others).alias("with"))
    met = met.select("bucket", F.xxhash64(F.least("own", "with")).alias("i"), F.xxhash64(F.greatest("own", "with")).alias("j"), "key", "component")
    sets = _sets(docs, rest.select("id", "key").distinct(), id_col, text_col)
    met = met.join(sets, "key").repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    src = met.select("bucket", "i", "j", "key", "component", "full")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, members = None, []

        def done() -> list[tuple]:
            if len({m[1] for m in members}) < 2:
                return []
            return [(members[x][0], members[y][0]) for x, y in
                    forest([np.frombuffer(m[2], dtype=np.uint64) for m in members], [m[1] for m in members])]

        def made(links: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"a": min(x), "b": max(x)} for x in links], schema=pa.schema([("a", pa.binary()), ("b", pa.binary())]))

        for batch in batches:
            links = []
            for *key, i, c, full in zip(*(batch.column(k).to_pylist() for k in range(6))):
                if key != group:
                    links += done()
                    group, members = key, []
                members.append((i, c, full))
            yield made(links)
        yield made(done())
        give_back()

    return src.mapInArrow(run, "a binary, b binary").where("a <> b").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, n_shingles, component_id (least id reachable) and kept (it is its own)."""
    return classed(docs, id_col, text_col).drop("set_key", "group")


def set_key(text) -> Column:
    """The class of a text's set as a column (null for an empty set)."""
    @F.pandas_udf("binary")
    def keys(texts):
        import pandas as pd
        sets = [shingles(t) for t in texts]
        return pd.Series([_key(s) if len(s) else None for s in sets], dtype=object)
    return keys(text)


def classed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``near_duplicates`` with the rows' classes (set_key) and the components' keys (group). All work is on classes of equal sets: an id that
    several different texts have stands in several classes, each with its own component."""
    rows = written(sketches(docs, id_col, text_col))
    real = rows.where("id IS NOT NULL AND set_key IS NOT NULL")
    reps = written(real.groupBy(F.col("set_key").alias("key")).agg(
        F.min("id").alias("id"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch")))
    step = 2 * ROWS
    bands = reps.select("id", "key", F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda i: F.xxhash64(i, F.substring(F.col("sketch"), i * step + 1, F.lit(step))))).alias("bucket"))
    stars = bands.groupBy("bucket").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("members")).where("members > 1")
    met = written(bands.join(stars, "bucket"))
    pairs = met.where("key <> first").select(F.col("first").alias("a"), F.col("key").alias("b")).distinct()
    links = shared(_confirmed(pairs, reps, docs, id_col, text_col))
    labels = written(components(links))

    # Buckets of three and more members that still hold several components.
    named = (met.where("members > 2").join(labels.withColumnRenamed("node", "key"), "key", "left")
             .withColumn("component", F.coalesce("component", "key")))
    mixed = (named.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
             .where("lo < hi").select("bucket"))
    rest = named.where("key <> first").join(mixed, "bucket", "left_semi").select("bucket", "id", "key", "component")
    size = rest.groupBy("bucket").agg(F.count(F.lit(1)).alias("left"))
    rest = written(rest.join(size, "bucket"))
    few = rest.where(F.col("left") <= FEW)
    other = few.select("bucket", F.col("key").alias("b"), F.col("component").alias("cb"))
    more = (few.select("bucket", F.col("key").alias("a"), "component").join(other, "bucket").where("a < b AND component <> cb")
            .select("a", "b").distinct())
    crowded = _crowded_links(rest.where(F.col("left") > FEW), docs, id_col, text_col)
    links = shared(links.union(_confirmed(more, reps, docs, id_col, text_col)).union(crowded))
    labels = written(components(links))

    # The least id of a component's classes; a class without links is a component of its own.
    placed = reps.select("key", "id").join(labels.withColumnRenamed("node", "key"), "key", "left").withColumn("component", F.coalesce("component", "key"))
    least = placed.groupBy("component").agg(F.min("id").alias("least"))
    named = placed.join(least, "component").select(F.col("key").alias("set_key"), F.col("component").alias("group"), "least")
    out = rows.join(named, "set_key", "left")
    own = F.when(F.col("id").isNotNull(), F.coalesce("least", "id"))
    return out.select(F.col("id").alias(id_col), "n_shingles", own.alias("component_id"),
                      F.coalesce(F.col("id") == own, F.lit(True)).alias("kept"), "set_key", "group")
