"""Two tokenizers' tokens of the same bytes, aligned, with corpus-wide link counts.

A group is a run of bytes between two neighbouring offsets at which a token of A and one of B both
end. Texts are cut before single spaces, where both vocabularies always end a token, so a cut
piece is tokenized alone and recurring pieces are looked up.

Fragments: the tokens that end in a byte range form (open prefix, closed groups, open suffix): the
tokens up to the first common end, the groups after it, the tokens after the last one. Two
neighbours compose by closing (left suffix + right prefix) as a group; this is associative, with
the empty fragment as its unit. A text of more than ``RANGE`` bytes is tokenized in pieces by many
tasks, every byte range gives a fragment, and a tree reduction composes their open ends, ``FAN``
at a time; closed groups stay where they are as runs, in byte order.

Counts: documents are worked off in blocks of bounded size. A block writes its distinct groups, its
linked id pairs with the number of its documents that hold them, and its documents as indexes into
the groups. Pair counts are summed over the corpus, each block gets those of its own pairs, and a
second pass reads a block's counts before its documents: nothing of the corpus's size is broadcast.

Cases: null and empty texts, and texts whose joined token bytes differ from space + text, have no
tokens: zeros and ''. Repeated rows are documents of their own, each counted. Null ids are kept.
Equal counts of an A id's pairs are all its highest. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import accumulate
from operator import mul
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import give_back, parts, ship, written

RANGE = 1 << 15             # bytes of a fragment; longer texts are dealt over tasks
FAN = 16                    # fragments composed at a time
MARKS = ",.;:!?"            # marks that often end a word
KNOWN = 600_000             # cut pieces remembered in a task; beyond, the memory starts anew
BLOCK_GROUPS = 120_000      # distinct groups that end a block
BLOCK_BYTES = 1 << 25       # bytes of group text that end a block

CUT = re.compile(r"(?<=[^ ])(?= \S)")
# The same in bytes, a little stricter: what follows is ASCII or cannot begin a white-space code point.
CUT_BYTES = re.compile(rb"(?<=[^ ]) (?=[!-~\xc3-\xe0\xe4-\xf4])")


class Fragment(NamedTuple):
    """Tokens of a byte range; ``cut`` says whether it has a common end (else all is in the prefix).
    ``closed`` holds the groups between the first and the last common end."""
    cut: bool = False
    prefix_a: tuple = ()
    prefix_b: tuple = ()
    closed: tuple = ()
    suffix_a: tuple = ()
    suffix_b: tuple = ()

    def __add__(self, right: Fragment) -> Fragment:
        if not self.cut:
            return right._replace(prefix_a=self.prefix_a + right.prefix_a, prefix_b=self.prefix_b + right.prefix_b)
        if not right.cut:
            return self._replace(suffix_a=self.suffix_a + right.prefix_a, suffix_b=self.suffix_b + right.prefix_b)
        bridge = (group_text(self.suffix_a + right.prefix_a, self.suffix_b + right.prefix_b),)
        return Fragment(True, self.prefix_a, self.prefix_b, self.closed + bridge + right.closed, right.suffix_a, right.suffix_b)

    def groups(self) -> tuple:
        """All groups of a whole text, which both tokenizers end at its last byte."""
        if not self.cut:
            return ()
        if self.suffix_a or self.suffix_b:
            raise ValueError("an open end is left")
        return (group_text(self.prefix_a, self.prefix_b), *self.closed)


def group_text(a: Iterable[int], b: Iterable[int]) -> str:
    return f"{','.join(map(str, a))}|{','.join(map(str, b))}"


def grouped(a: list[int], b: list[int], size_a: list[int], size_b: list[int]) -> str | None:
    """``a1,a2|b1;...`` of two tokenizations of the same bytes; sizes are bytes by id."""
    ends_a = list(accumulate([size_a[x] for x in a]))
    ends_b = list(accumulate([size_b[x] for x in b]))
    if not a or not b or ends_a[-1] != ends_b[-1]:
        return None
    if len(a) == 1 or len(b) == 1:
        return group_text(a, b)
    place = dict(zip(ends_b, range(1, len(b) + 1)))
    out, from_a, from_b = [], 0, 0
    for to_a, e in enumerate(ends_a, 1):
        to_b = place.get(e)
        if to_b:
            out.append(group_text(a[from_a:to_a], b[from_b:to_b]))
            from_a, from_b = to_a, to_b
    return ";".join(out)


def sides(group: str) -> tuple[list[int], list[int]]:
    a, b = group.split("|")
    return [int(x) for x in a.split(",")], [int(x) for x in b.split(",")]


class GroupBytes(dict):
    """Group -> its bytes, remembered up to a number of groups."""

    def __init__(self, size_a: list[int]):
        super().__init__()
        self.size_a = size_a

    def __missing__(self, group: str) -> int:
        if len(self) > 200_000:
            self.clear()
        n = self[group] = sum([self.size_a[x] for x in sides(group)[0]])
        return n


def fragments(groups: list[str], start: int, size_a: list[int], size_b: list[int], span: int = RANGE,
              size: GroupBytes | None = None) -> list[tuple[int, Fragment]]:
    """The groups of a piece that begins at byte ``start``, as one fragment for each byte range
    (of ``span`` bytes) in which tokens end: (first byte of the fragment, fragment)."""
    size = GroupBytes(size_a) if size is None else size
    ends = list(accumulate(map(size.__getitem__, groups), initial=start))
    out: dict[int, list] = {}       # range -> [cut, pa, pb, closed, sa, sb]
    i = 0
    while i < len(groups):
        k = (ends[i + 1] - 1) // span
        if ends[i] // span == k:    # all groups that lie in this range
            to = bisect_right(ends, (k + 1) * span, i + 1) - 1
            f = out.setdefault(k, [False, [], [], [], [], []])
            if not f[0]:
                x, y = sides(groups[i])
                f[0] = True
                f[1].extend(x)
                f[2].extend(y)
                i += 1
            f[3].extend(groups[i:to])
            i = to
            continue
        mine: dict[int, tuple[list, list]] = {}         # a group over several ranges, token by token
        for ids, sizes, side in zip(sides(groups[i]), (size_a, size_b), (0, 1)):
            for x, e in zip(ids, accumulate([sizes[t] for t in ids])):
                mine.setdefault((ends[i] + e - 1) // span, ([], []))[side].append(x)
        for at in sorted(mine):
            f = out.setdefault(at, [False, [], [], [], [], []])
            x, y = mine[at]
            if at == k and f[0]:
                f[3].append(group_text(x, y))
                continue
            (f[4] if f[0] else f[1]).extend(x)
            (f[5] if f[0] else f[2]).extend(y)
            f[0] = f[0] or at == k          # the common end
        i += 1
    return [(max(start, k * span), Fragment(f[0], *map(tuple, f[1:]))) for k, f in sorted(out.items())]


class Tokenizers:
    """A and B, their tokens' bytes, and a memory of cut pieces."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer
        from .bpe import byte_symbols
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        to_byte = byte_symbols()
        vocab = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes_a[i] = bytes(to_byte[c] for c in token) if all(c in to_byte for c in token) else token.encode()
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(map(self.b.id_to_piece, range(self.b.vocab_size())))]
        self.size_a, self.size_b = [len(x) for x in self.bytes_a], [len(x) for x in self.bytes_b]
        self.known: dict[str, str | None] = {}      # piece -> its groups, None if bytes differ
        self.cut = self._mark_cuts()
        self.group_bytes = GroupBytes(self.size_a)

    def _mark_cuts(self) -> re.Pattern:
        """Where a piece is cut: before a single space that a non-space follows, and between a letter
        and a mark that no token of B holds side by side (A never joins the two)."""
        letters = "a-zA-Z"
        held = {m for i in range(self.b.vocab_size()) for m in re.findall(f"(?<=[{letters}])[{re.escape(MARKS)}]", self.b.id_to_piece(i))}
        free = "".join(m for m in MARKS if m not in held)
        return re.compile(CUT.pattern + (rf"|(?<=[{letters}])(?=[{re.escape(free)}])" if free else ""))

    def learn(self, pieces: list[str]) -> None:
        """B puts a space before what it is given: for pieces that begin with one that is theirs, the
        others followed a letter and are given to it behind one."""
        coded = self.a.encode_batch_fast(pieces, add_special_tokens=False)
        seen = self.b.encode([p[1:] if p[0] == " " else "a" + p for p in pieces], num_threads=1)
        token_b = self.bytes_b.__getitem__
        for p, found, b in zip(pieces, coded, seen):
            if p[0] != " ":
                b = b[1:]
            same = b"".join(map(token_b, b)) == p.encode()
            self.known[p] = grouped(found.ids, b, self.size_a, self.size_b) if same else None

    def groups(self, texts: list[str]) -> list[str | None]:
        """Each text's groups as ``a1,a2|b1;...``; None without tokens (empty, or bytes that differ)."""
        if len(self.known) > KNOWN:
            self.known.clear()
        cut = [self.cut.split(" " + t) for t in texts]
        fresh = list(set().union(*cut).difference(self.known)) if cut else []
        if fresh:
            self.learn(fresh)
        out, look = [], self.known.__getitem__
        for t, pieces in zip(texts, cut):
            found = list(map(look, pieces))
            out.append(";".join(found) if t and None not in found else None)
        for p in fresh:             # long strings don't recur
            if len(p) > 100:
                del self.known[p]
        return out


@lru_cache(maxsize=1)
def tokenizers(path_a: str, path_b: str) -> Tokenizers:
    return Tokenizers(path_a, path_b)


def _ids(group: str) -> tuple[tuple[tuple[int, int], ...], int, int]:
    """The linked id pairs of a group (A id << 32 | B id) with their occurrences; tokens of A, of B."""
    a, b = sides(group)
    if len(a) == 1 == len(b):
        return ((a[0] << 32 | b[0], 1),), 1, 1
    count_a, count_b = Counter(a), Counter(b)
    return tuple((x << 32 | y, n * m) for x, n in count_a.items() for y, m in count_b.items()), len(a), len(b)


# What a block writes. kind 0: a pair and how many of the block's documents hold it; kind 1: a group
# and its index; kind 2: a document (or a run of a long one) as indexes and occurrences; kind 3: a
# pair of a long document, counted once for it;
def _block_schema(id_type: pa.DataType) -> pa.Schema:
    return pa.schema([("kind", pa.int32()), ("block", pa.int64()), ("n", pa.int64()), ("pair", pa.int64()), ("text", pa.string()),
                      ("id", id_type), ("row", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                      ("n_links", pa.int64()), ("sha", pa.string()), ("which", pa.binary()), ("times", pa.binary())])


class _Block:
    """Collects documents until it is large enough, then gives its rows."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.seq = schema, 0
        self.task = TaskContext.get().partitionId() if TaskContext.get() else 0
        self._new()

    def _new(self) -> None:
        self.index: dict[str, int] = {}
        self.links: list[tuple] = []        # by index: the group's pairs
        self.sizes: list[tuple] = []        # by index: tokens of A, of B, links
        self.pairs: Counter = Counter()
        self.long_pairs: dict[int, set] = {}
        self.docs: list[tuple] = []
        self.size = 0

    def add(self, id_, row: int | None, groups: str | None) -> None:
        """A document (``row`` None), or a run of a long document, whose pairs are counted elsewhere."""
        if not groups:
            self.docs.append((id_, row, 0, 0, 0, 0, "", None, None))
            return
        listed = groups.split(";")
        times = Counter(listed)
        index = self.index
        for g in [g for g in times if g not in index]:      # a difference of key views would walk the whole index
            index[g] = len(index)
            pairs, a, b = _ids(g)
            self.links.append([p for p, _ in pairs])
            self.sizes.append((a, b, a * b))
            self.size += len(g)
        which = list(map(index.__getitem__, times))
        many = list(times.values())
        held = set().union(*map(self.links.__getitem__, which))
        n_a, n_b, links = (sum(map(mul, many, column)) for column in zip(*map(self.sizes.__getitem__, which)))
        self.size += 8 * len(times)
        if row is None:
            self.pairs.update(held)
        else:
            self.long_pairs.setdefault(row, set()).update(held)
        sha = hashlib.sha256(groups.encode()).hexdigest() if row is None else ""
        self.docs.append((id_, row, n_a, n_b, len(listed), links, sha, np.array(which, np.uint32).tobytes(),
                          np.array(many, np.uint32).tobytes()))

    def full(self) -> bool:
        return len(self.index) > BLOCK_GROUPS or self.size > BLOCK_BYTES

    def _batch(self, n: int, /, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type)
                                           for f in self.schema], schema=self.schema)

    def rows(self) -> Iterator[pa.RecordBatch]:
        if not self.docs:
            return
        block = (self.task << 24) + self.seq
        self.seq += 1
        pairs = dict(self.pairs)
        for held in self.long_pairs.values():
            for p in held:
                pairs.setdefault(p, 0)
        n = len(pairs)
        yield self._batch(n, kind=[0] * n, block=[block] * n, pair=list(pairs), n=list(pairs.values()))
        n = len(self.index)
        yield self._batch(n, kind=[1] * n, block=[block] * n, n=list(self.index.values()), text=list(self.index))
        for at in range(0, len(self.docs), 1000):
            some = list(zip(*self.docs[at:at + 1000]))
            n = len(some[0])
            yield self._batch(n, kind=[2] * n, block=[block] * n, **dict(zip(
                ("id", "row", "n_a", "n_b", "n_groups", "n_links", "sha", "which", "times"), some)))
        for row, held in self.long_pairs.items():
            n = len(held)
            yield self._batch(n, kind=[3] * n, block=[block] * n, row=[row] * n, pair=list(held))
        self._new()


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of blocks: pairs with their corpus-wide counts, groups, documents -> documents
    with n_best and count_sum."""
    block, sums, best = None, [], []
    counts: dict[int, tuple[int, bool]] = {}
    for batch in batches:
        b, kind, n, top, pair, text = (batch.column(k).to_pylist() for k in range(6))
        first = len(kind)
        if any(k == 2 for k in kind):
            which, times = batch.column(6).to_pylist(), batch.column(7).to_pylist()
        out: list[tuple] = []
        for i in range(first):
            if b[i] != block:
                block, counts, sums, best, made = b[i], {}, [], [], None
            if kind[i] == 0:
                counts[pair[i]] = (n[i], top[i])
            elif kind[i] == 1:      # in the order of their indexes
                total = highest = 0
                for p, times_p in _ids(text[i])[0]:
                    c, is_top = counts[p]
                    total += times_p * c
                    highest += times_p * is_top
                sums.append(total)
                best.append(highest)
                made = None
            else:
                if made is None:
                    made = np.array(sums, np.int64), np.array(best, np.int64)
                if which[i] is None:
                    out.append((i, 0, 0))
                else:
                    w, t = np.frombuffer(which[i], np.uint32), np.frombuffer(times[i], np.uint32).astype(np.int64)
                    out.append((i, int(t @ made[1][w]), int(t @ made[0][w])))
        if out:
            rows, n_best, count_sum = zip(*out)
            kept = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([*kept.columns[8:], pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64())],
                                             names=[*batch.schema.names[8:], "n_best", "count_sum"])
    give_back()


def _ddl(schema: pa.Schema, id_type: str) -> str:
    names = {pa.int32(): "int", pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}
    return ", ".join(f"{f.name} {id_type if f.name == 'id' else names[f.type]}" for f in schema)


EDGE = "row long, pos long, first long, cut boolean, pa array<int>, pb array<int>, sa array<int>, sb array<int>, run string"
EDGE_ROWS = pa.schema([("row", pa.int64()), ("pos", pa.int64()), ("first", pa.int64()), ("cut", pa.bool_())]
                      + [(c, pa.list_(pa.int32())) for c in ("pa", "pb", "sa", "sb")] + [("run", pa.string())])


def _edge_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in EDGE_ROWS]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, EDGE_ROWS)], schema=EDGE_ROWS)


def _run(row: int, at: int, groups) -> tuple:
    """Closed groups of a long text as a row; ``at`` orders the runs of a text."""
    return (row, at, None, None, None, None, None, None, ";".join(groups))


def _compose(column: str, whole: bool):
    """Sorted open ends -> one fragment for each (row, ``column``), and the groups that closed on the
    way as runs. With ``whole`` the text's own ends close the rest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, acc, place = None, Fragment(), (0, None)

        def done(out: list[tuple]) -> None:
            if key is None:
                return
            if whole:
                out.append(_run(key[0], 2 * place[1], acc._replace(closed=()).groups()))
            else:
                out.append((key[0], place[0], place[1], acc.cut, acc.prefix_a, acc.prefix_b, acc.suffix_a, acc.suffix_b, None))

        for batch in batches:
            out: list[tuple] = []
            names = batch.schema.names
            for r in batch.to_pylist():
                mine = (r["row"], r[column] if column in names else None)
                f = Fragment(r["cut"], tuple(r["pa"]), tuple(r["pb"]), (), tuple(r["sa"]), tuple(r["sb"]))
                if mine != key:
                    done(out)
                    key, acc, place = mine, f, (r["pos"], r["first"])
                    continue
                acc = acc + f
                if acc.closed:          # the group that both ends made, in its place
                    out.append(_run(mine[0], 2 * r["first"], acc.closed))
                    acc = acc._replace(closed=())
                place = (place[0], place[1] if place[1] is not None else r["first"])
            yield _edge_batch(out)
        out = []
        done(out)
        yield _edge_batch(out)
    return run


def _long_runs(texts: DataFrame, paths: tuple[str, str], span: int, fan: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Long texts dealt over tasks: (rows with their ids, runs of closed groups in byte order, rows without tokens)."""
    id_type = texts.schema["id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for part in parts(batch):
                rows, starts, ids, pieces = [], [], [], []
                for id_, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    raw, begin, goal = text.encode(), 0, span
                    while begin is not None:
                        m = CUT_BYTES.search(raw, max(goal, begin))
                        to = m.start() if m else len(raw)
                        rows.append(row)
                        starts.append(begin)
                        ids.append(id_)
                        pieces.append(raw[begin:to].decode())
                        begin = to + 1 if m else None       # past the space, which the piece has before it
                        goal = (to // span + 1) * span
                    row += 1
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(starts, pa.int64()),
                                                  pa.array(ids, part.column(0).type), pa.array(pieces, pa.string())],
                                                 names=["row", "start", "id", "piece"])

    pieces = written(texts.mapInArrow(cut, f"row long, start long, id {id_type}, piece string"))

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizers(*paths)
        for batch in batches:
            for part in parts(batch, column=2):
                out: list[tuple] = []
                found = t.groups(part.column(2).to_pylist())
                for row, start, groups in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), found):
                    if groups is None:
                        out.append((row, -1, None, None, None, None, None, None, None))
                        continue
                    for pos, f in fragments(groups.split(";"), start, t.size_a, t.size_b, span, t.group_bytes):
                        out.append((row, pos, pos if f.cut else None, f.cut, f.prefix_a, f.prefix_b, f.suffix_a, f.suffix_b, None))
                        if f.closed:
                            out.append(_run(row, 2 * pos + 1, f.closed))
                yield _edge_batch(out)
        give_back()

    leaves = written(pieces.select("row", "start", "piece").repartition("row", "start").mapInArrow(align, EDGE))
    bad = leaves.where("pos = -1").select("row").distinct()
    runs = leaves.where("run IS NOT NULL")
    ends = leaves.where("run IS NULL AND pos >= 0")
    last = ends.agg(F.max("pos")).first()[0] or 0
    width = span
    while width * fan <= last:
        width *= fan
        folded = ends.withColumn("part", F.expr(f"pos div {width}")).repartition("row", "part").sortWithinPartitions("row", "part", "pos")
        folded = written(folded.mapInArrow(_compose("part", False), EDGE))
        runs = runs.unionByName(folded.where("run IS NOT NULL"))
        ends = folded.where("run IS NULL")
    ends = ends.join(bad, "row", "left_anti").repartition("row").sortWithinPartitions("row", "pos")
    folded = written(ends.mapInArrow(_compose("part", True), EDGE))
    runs = runs.join(bad, "row", "left_anti").unionByName(folded)
    return pieces.where("start = 0").select("row", "id"), runs.select("row", F.col("pos").alias("at"), "run"), bad


def _run_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted runs -> the digest of each text's groups."""
    row, state = None, None

    def batch_of(found: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.string())],
                                          names=["row", "sha"])
    for batch in batches:
        found = []
        for r, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if r != row:
                if row is not None:
                    found.append((row, state.hexdigest()))
                row, state = r, hashlib.sha256(text.encode())
            else:
                state.update(b";" + text.encode())
        yield batch_of(found)
    if row is not None:
        yield batch_of([(row, state.hexdigest())])


def align_documents(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
                    span: int = RANGE, fan: int = FAN) -> DataFrame:
    """Per row: the id column, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    ship(docs.sparkSession)
    paths = (path_a, path_b)
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    id_type = texts.schema["id"].dataType.simpleString()

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, block = tokenizers(*paths), None
        for batch in batches:
            block = block or _Block(_block_schema(batch.column(0).type))
            for part in parts(batch):
                for id_, groups in zip(part.column(0).to_pylist(), t.groups([x or "" for x in part.column(1).to_pylist()])):
                    block.add(id_, None, groups)
                    if block.full():
                        yield from block.rows()
        if block:
            yield from block.rows()
        give_back()

    def long(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = None
        for batch in batches:
            block = block or _Block(_block_schema(pa.int64()))
            for row, run in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                block.add(None, row, run)
                if block.full():
                    yield from block.rows()
        if block:
            yield from block.rows()
        give_back()

    size = F.octet_length("text")
    ddl = _ddl(_block_schema(pa.int64()), id_type)
    near = written(texts.where(size.isNull() | (size <= span)).mapInArrow(short, ddl))
    rows, runs, bad = _long_runs(texts.where(size > span), paths, span, fan)
    far = written(runs.repartition("row", "at").mapInArrow(long, _ddl(_block_schema(pa.int64()), "long"))).withColumn("block", -1 - F.col("block"))

    # Documents that hold each pair: the blocks' own counts, and one for each long document.
    held = (near.where("kind = 0").select("pair", "n").groupBy("pair").agg(F.sum("n").alias("n"))
            .unionByName(far.where("kind = 3").select("row", "pair").distinct().groupBy("pair").agg(F.count(F.lit(1)).alias("n"))))
    held = held.groupBy("pair").agg(F.sum("n").alias("n"))
    # An A id has at most as many pairs as B has ids.
    held = held.withColumn("top", F.expr("n = max(n) OVER (PARTITION BY shiftright(pair, 32))"))
    wanted = near.select("kind", "block", "pair").unionByName(far.select("kind", "block", "pair")).where("kind = 0")
    wanted = wanted.select("block", "pair").join(held, "pair")
    stream = ["block", "kind", "n", "top", "pair", "text", "which", "times", "id", "row", "n_a", "n_b", "n_groups", "n_links", "sha"]
    types = {f.name: f.dataType for f in near.schema.fields} | {"top": held.schema["top"].dataType}

    def laid(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(types[c]).alias(c) for c in stream])

    told = (laid(wanted.withColumn("kind", F.lit(0))).unionByName(laid(near.where("kind IN (1, 2)")))
            .unionByName(laid(far.drop("id").where("kind IN (1, 2)"))))
    told = told.repartition("block").sortWithinPartitions("block", "kind", "n")
    told = told.mapInArrow(_totals, f"id {id_type}, row long, n_a long, n_b long, n_groups long, n_links long, sha string, n_best long, count_sum long")
    told = written(told)
    sums = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    digests = runs.repartition("row").sortWithinPartitions("row", "at").mapInArrow(_run_digests, "row long, sha string")
    whole = (rows.join(told.where("row IS NOT NULL").groupBy("row").agg(*[F.sum(c).alias(c) for c in sums]), "row", "left")
             .join(digests, "row", "left")
             .select("id", *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in sums], F.coalesce("sha", F.lit("")).alias("sha")))
    out = told.where("row IS NULL").select("id", *sums, "sha").unionByName(whole)
    return out.select(F.col("id").alias(id_col), *sums, F.col("sha").alias("groups_sha256"))
