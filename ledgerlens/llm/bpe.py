"""Byte-pair encoding and decoding with a pair occurrence index.

Words (pre-tokens) are taken per Arrow batch. The distinct new words of a batch lie in symbol
arrays of bounded size; an index maps each adjacent pair that has a merge rank to all its positions. Active ranks
are applied in ascending order: every listed position is merged from left to right, and the two
neighbouring pairs of each merge enter the lists of their own ranks. Words share no pairs, so
this equals merging each word alone.

The vocabulary file is a parameter and is opened by every executor; it is never copied.

Cases: null text counts as empty; empty text has no ids and decodes to ''. Repeated rows give
repeated rows. Special-token strings inside a text become their ids, as the vocabulary's library
does by default. Columns other than the two named ones are never read.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import itertools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from .common import give_back, parts, ship

# The pre-token pattern of the byte-level vocabulary. White space is Unicode's
# White_Space property (Python's own \s has four control characters more).
WORD = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")

DOUBLE_SPACE = regex.compile(r" (?:\s|$)")
CUT = regex.compile(r" (?=\S)")

WIDE = 1 << 20              # more than any id: one number for a pair of ids
CACHED_WORDS = 700_000      # strings a task remembers; beyond, the older half goes
MERGED_CHARS = 400_000      # characters of new words that lie in one index (a longer word has its own)
PART_BYTES = 1_500_000      # bytes of text encoded at a time (a longer text is a part of its own)


def byte_symbols() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies, by its rule: printable
    Latin-1 bytes stand for themselves, the others for code points from 256 on, in order."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, extra = {}, 256
    for b in range(256):
        if b in plain:
            out[chr(b)] = b
        else:
            out[chr(extra)] = b
            extra += 1
    return out


def slices(words: list[str], limit: int) -> Iterator[list[str]]:
    """``words`` in consecutive lists of at most ``limit`` characters, or one longer word."""
    held, size = [], 0
    for w in words:
        if held and size + len(w) > limit:
            yield held
            held, size = [], 0
        held.append(w)
        size += len(w)
    if held:
        yield held


class Codec:
    """A byte-level BPE vocabulary: ``encode`` many texts at a time, ``decode`` ids."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab: dict[str, int] = spec["model"]["vocab"]
        to_byte = byte_symbols()
        size = max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        self.token = [b""] * size
        for text, i in vocab.items():
            self.token[i] = bytes(to_byte[c] for c in text)
        self.byte_id = [0] * 256
        for c, b in to_byte.items():
            self.byte_id[b] = vocab[c]
        self.rank: dict[int, int] = {}          # left * WIDE + right -> rank
        self.pair: list[tuple[int, int]] = []
        self.made: list[int] = []
        for merge in spec["model"]["merges"]:
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            self.rank[vocab[left] * WIDE + vocab[right]] = len(self.pair)
            self.pair.append((vocab[left], vocab[right]))
            self.made.append(vocab[left + right])
        ids = np.array(self.byte_id, dtype=np.int64)
        self.byte_array = ids
        self.byte_rank = np.array([[self.rank.get(int(x) * WIDE + int(y), -1) for y in ids] for x in ids], dtype=np.int32)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for text, i in self.special.items():
            self.token[i] = text.encode()
        marks = sorted(self.special, key=len, reverse=True)
        self.split = regex.compile("(" + "|".join(map(regex.escape, marks)) + ")") if marks else None
        self.known: dict[str, bytes] = {}   # chunk or pre-token -> packed ids

    def merge_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word, as little-endian unsigned 32-bit integers."""
        coded = [w.encode() for w in words]
        flat = np.frombuffer(b"".join(coded), dtype=np.uint8)
        n = len(flat)
        ends = np.cumsum([len(w) for w in coded], dtype=np.int64)
        starts = np.concatenate([[0], ends[:-1]])[: len(words)].astype(np.int64)
        symbol = self.byte_array[flat].tolist()
        link = np.arange(1, n + 1)
        link[ends[ends > 0] - 1] = -1
        after = link.tolist()
        link = np.arange(-1, n - 1)
        link[starts[starts < n]] = -1
        before = link.tolist()
        rank, made, pair = self.rank, self.made, self.pair
        # The index of the first pairs: positions sorted by rank, one list for each rank.
        first = self.byte_rank[flat[:-1], flat[1:]] if n > 1 else np.zeros(0, np.int32)
        inside = np.ones(len(first), bool)
        inside[ends[(ends > 0) & (ends < n)] - 1] = False
        spots = np.flatnonzero((first >= 0) & inside)
        spots = spots[np.argsort(first[spots], kind="stable")]
        ranks, cut = np.unique(first[spots], return_index=True)
        bounds = [*cut.tolist(), len(spots)]
        listed = spots.tolist()
        at = {r: listed[x:y] for r, x, y in zip(ranks.tolist(), bounds, bounds[1:])}
        active = list(at)
        heapq.heapify(active)
        while active:
            r = heapq.heappop(active)
            a, b = pair[r]
            new = made[r]
            for p in sorted(at.pop(r)):
                q = after[p]
                if symbol[p] != a or q < 0 or symbol[q] != b:
                    continue    # a merge of a lower rank took one side
                nxt = after[q]
                symbol[p], symbol[q], after[p] = new, -1, nxt
                if nxt >= 0:
                    before[nxt] = p
                    x = rank.get(new * WIDE + symbol[nxt])
                    if x is not None:
                        if x in at:
                            at[x].append(p)
                        else:
                            at[x] = [p]
                            heapq.heappush(active, x)
                prv = before[p]
                if prv >= 0:
                    x = rank.get(symbol[prv] * WIDE + new)
                    if x is not None:
                        if x in at:
                            at[x].append(prv)
                        else:
                            at[x] = [prv]
                            heapq.heappush(active, x)
        left = np.array(symbol, dtype=np.int64)
        alive = left >= 0
        packed = left[alive].astype("<u4").tobytes()
        place = 4 * np.concatenate([[0], np.cumsum(alive)])
        return [packed[x:y] for x, y in zip(place[starts].tolist(), place[ends].tolist())]

    def chunks(self, text: str) -> list[str]:
        """``text`` cut before every space that a non-space follows. Such a space always starts a
        pre-token and none spans it, so chunks are encoded alone; they recur far more than texts."""
        found = text.split(" ")
        if DOUBLE_SPACE.search(text):
            found = CUT.split(text)
        return [found[0], *[" " + x for x in found[1:]]]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text."""
        chunked: list[list[str]] = []
        parts_of: list[list[str]] = []
        for t in texts:
            parts = self.split.split(t) if self.split and any(m in t for m in self.special) else [t]
            parts_of.append(parts)
            chunked += [self.chunks(p) for p in parts if p not in self.special]
        if len(self.known) > CACHED_WORDS:
            self.known = dict(itertools.islice(self.known.items(), len(self.known) // 2, None))
        known = self.known
        fresh = set().union(*chunked).difference(known) if chunked else set()
        cut = {x: WORD.findall(x) for x in fresh}
        new = list({w for ws in cut.values() for w in ws}.difference(known))
        for some in slices(new, MERGED_CHARS):
            known.update(zip(some, self.merge_words(some)))
        known.update((x, b"".join([known[w] for w in ws])) for x, ws in cut.items() if len(ws) != 1)    # one word is the chunk itself
        look, done, out = known.__getitem__, iter(chunked), []
        for parts in parts_of:
            out.append(b"".join([self.special[p].to_bytes(4, "little") if p in self.special else
                                 b"".join(map(look, next(done))) for p in parts]))
        for x in [x for x in {*fresh, *new} if len(x) > 200]:     # long strings don't recur
            del known[x]
        return out

    def decode(self, packed: bytes) -> str:
        ids = np.frombuffer(packed, dtype="<u4").tolist()
        return b"".join(map(self.token.__getitem__, ids)).decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def encode_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                     with_ids: bool = True) -> DataFrame:
    """Per row: the id column, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` and, if asked
    for, ``ids`` (binary, little-endian unsigned 32-bit). A pass over the rows, without a shuffle.
    """
    ship(docs.sparkSession)
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocabulary)
        for batch in batches:
            for part in parts(batch, limit=PART_BYTES):
                packed = c.encode([t or "" for t in part.column(1).to_pylist()])
                cols = [part.column(0),
                        pa.array([len(p) // 4 for p in packed], pa.int64()),
                        pa.array([hashlib.sha256(p).hexdigest() for p in packed], pa.string()),
                        pa.array([hashlib.sha256(c.decode(p).encode()).hexdigest() for p in packed], pa.string())]
                if with_ids:
                    cols.append(pa.array(packed, pa.binary()))
                yield pa.RecordBatch.from_arrays(cols, names=names)
        c.known.clear()
        give_back()

    return src.mapInArrow(run, schema).withColumnRenamed("id", id_col)
