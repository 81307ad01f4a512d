"""Benchmark decontamination: BM25 over test items, searched by every training passage.

The test items' inverted index (terms, postings in item order, in blocks of ``BLOCK`` items, or
more so that there are at most ``BLOCKS``, with each term's greatest weight per block) is built
from a broadcast of at most about ``INDEX_ITEMS`` items; more items are further passes over the
documents, so the index a task holds is bounded; document frequencies, the mean length and the
passage window are those of all items in each. Weights are divided by the item's own score, so a threshold means the same for each.

Passages are word windows of twice the longest item (at least ``WINDOW``), half overlapping: any
run of an item's length lies wholly in one. A passage's distinct index terms are its query.
Search is block-max WAND, for all passages of a batch together: a passage whose summed greatest
weights stay below the threshold is skipped; the summed block maxima then leave only blocks that
may hold an item above it; just those blocks' postings are scored. Bounds never lie below scores,
so every item above the threshold is found.

An item's question is its words up to the answer: the text after a last "Answer:" or "?" if there
is one, else its last quarter. A candidate stands if its ``RUN``-word runs (the whole item, if
shorter) cover at least ``COVER`` of the item's words in the document, or the whole question or
the whole answer, less its label ("Question:", "Answer:"), of ``PIECE`` and more words. Questions
and answers have an index of their own for that: one that a passage holds wholly scores 1 there.
The cover of question and answer is reported for each.

Cases: null or empty text has no passages; an item without words matches nothing; repeated items
or rows are reported each; an empty benchmark or table gives no rows. Only the id and text
columns are read.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import give_back, parts, shared, ship

INDEX_ITEMS = 20_000    # items of an index block, and so the bound of a broadcast
WINDOW, BLOCK, RUN = 64, 8, 5
BLOCKS = 128            # blocks of an index, at most: a term's row of block maxima
BOUNDS = 500_000        # block bounds summed at a time
SCORED = 250_000        # (term, block) pairs whose postings are scored at a time
THRESHOLD, COVER = 0.4, 0.5
PIECE = 8               # words of a question or answer that counts by itself, at least
PIECE_SCORE = 0.99      # one held wholly scores 1
LABELS = frozenset(("question", "answer", "q", "a"))
K1, B = 1.2, 0.75

WORD = re.compile(r"\w+")
TOKENS = 200_000          # tokens remembered
BATCH_WORDS = 200_000     # words of a batch of texts, or one longer text


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def answer_at(text: str) -> int:
    """How many of the item's words belong to its question."""
    n = len(words_of(text))
    marks = [m.end() for m in re.finditer(r"(?i)\banswer\s*:|\?", text)]
    for at in reversed(marks):
        tail = len(words_of(text[at:]))
        if 0 < tail < n:
            return n - tail
    return n - max(1, n // 4)


class Whole:
    """What an index block takes from all items: their number, mean and greatest length, and the
    document frequencies of (at least) the block's words."""

    def __init__(self, n: int, mean: float, longest: int, df: dict[str, int]):
        self.n, self.mean, self.longest, self.df = n, mean, longest, df


def whole_of(items: list[list[str]]) -> Whole:
    df: dict[str, int] = {}
    for words in items:
        for w in set(words):
            df[w] = df.get(w, 0) + 1
    return Whole(len(items), sum(map(len, items)) / max(len(items), 1), max(map(len, items), default=0), df)


class Postings:
    """BM25 postings of word lists with block maxima, each list's weights divided by its own score."""

    def __init__(self, lists: list[list[str]], terms: dict[str, int], whole: Whole):
        n = len(lists)
        post: list[list[tuple[int, int]]] = [[] for _ in terms]
        for item, words in enumerate(lists):
            count: dict[str, int] = {}
            for w in words:
                count[w] = count.get(w, 0) + 1
            for w, c in count.items():
                post[terms[w]].append((item, c))
        idf = [np.log(1 + (whole.n - whole.df[w] + 0.5) / (whole.df[w] + 0.5)) for w in terms]
        own = np.zeros(n)
        rows, cols, weights = [], [], []
        for t, entries in enumerate(post):
            for item, c in entries:
                w = idf[t] * c * (K1 + 1) / (c + K1 * (1 - B + B * len(lists[item]) / whole.mean))
                own[item] += w
                rows.append(t)
                cols.append(item)
                weights.append(w)
        self.item = np.array(cols, dtype=np.int32)
        self.weight = (np.array(weights) / own[self.item]).astype(np.float32) if weights else np.zeros(0, np.float32)
        self.start = np.searchsorted(np.array(rows), np.arange(len(post) + 1)) if post else np.zeros(1, int)
        self.block = max(BLOCK, -(-n // BLOCKS))
        self.blocks = -(-n // self.block)
        # Block maxima, and the greatest weight of each term.
        self.block_max = np.zeros((len(post), max(self.blocks, 1)), dtype=np.float32)
        np.maximum.at(self.block_max, (np.array(rows, dtype=int), self.item // self.block), self.weight)
        self.most = self.block_max.max(1) if len(post) else np.zeros(0, np.float32)
        # Postings cut by block: where each (term, block) begins.
        key = np.array(rows, dtype=np.int64) * max(self.blocks, 1) + self.item // self.block     # ascending, as built
        self.cut = np.searchsorted(key, np.arange(len(post) * max(self.blocks, 1) + 1))

    def search(self, passage: np.ndarray, term: np.ndarray, threshold: float) -> list[tuple[int, int, float]]:
        """(passage, item, score) at or above the threshold; the input is sorted, distinct pairs."""
        if not len(passage):
            return []
        first = np.flatnonzero(np.r_[True, passage[1:] != passage[:-1]])
        sums = np.add.reduceat(self.most[term], first)
        size = np.diff(np.r_[first, len(passage)])
        live = np.repeat(sums >= threshold - 1e-4, size)
        if not live.any():
            return []
        passage, term = passage[live], term[live]
        first = np.flatnonzero(np.r_[True, passage[1:] != passage[:-1]])
        # Whole passages at a time, of about BOUNDS block bounds.
        starts = first[np.flatnonzero(np.r_[True, np.diff(first * self.blocks // BOUNDS) > 0])]
        out = []
        for lo, hi in zip(starts, np.r_[starts[1:], len(passage)]):
            out += self._above(passage[lo:hi], term[lo:hi], threshold)
        return out

    def _above(self, passage: np.ndarray, term: np.ndarray, threshold: float) -> list[tuple[int, int, float]]:
        """``search`` by block bounds, of passages whose greatest weights reach the threshold."""
        first = np.flatnonzero(np.r_[True, passage[1:] != passage[:-1]])
        bounds = np.add.reduceat(self.block_max[term], first, axis=0)
        size = np.diff(np.r_[first, len(passage)])
        p, block = np.nonzero(bounds >= threshold - 1e-4)
        out = []
        for some in np.array_split(np.arange(len(p)), max(1, int(size[p].sum()) // SCORED + 1)):
            out += self._scored(passage, term, first, size, p[some], block[some], threshold)
        return out

    def _scored(self, passage, term, first, size, p, block, threshold) -> list[tuple[int, int, float]]:
        """Exact scores of the items of the given (passage, block) pairs, from their postings."""
        n = size[p]
        pair = np.repeat(np.arange(len(p)), n)
        spot = np.repeat(first[p] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum()) if len(p) else np.zeros(0, int)
        at = term[spot] * self.blocks + block[pair]
        lo, hi = self.cut[at], self.cut[at + 1]
        some = hi > lo
        lo, n, pair = lo[some], (hi - lo)[some], pair[some]
        spot = np.repeat(lo - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum()) if len(n) else np.zeros(0, int)
        pair = np.repeat(pair, n)
        b = self.block
        scores = np.bincount(pair * b + self.item[spot] % b, self.weight[spot], len(p) * b)
        return [(int(passage[first[p[k // b]]]), int(block[k // b] * b + k % b), float(scores[k]))
                for k in np.flatnonzero(scores >= threshold)]


class Index(Postings):
    """The test items' index, and one of their questions and answers over the same terms."""

    def __init__(self, items: list[tuple[int, str]], whole: Whole | None = None):
        items = [(i, t or "") for i, t in items]
        words = [words_of(t) for _, t in items]
        keep = [k for k, w in enumerate(words) if w]
        self.ids = [items[k][0] for k in keep]
        self.question = [answer_at(items[k][1]) for k in keep]
        self.words = [words[k] for k in keep]
        whole = whole or whole_of(self.words)
        self.window = max(WINDOW, whole.longest)
        self.terms: dict[str, int] = {}
        for w in itertools.chain.from_iterable(self.words):
            self.terms.setdefault(w, len(self.terms))
        super().__init__(self.words, self.terms, whole)
        self.piece: list[tuple[int, list[str]]] = []        # item and words
        for item, (own, q) in enumerate(zip(self.words, self.question)):
            for lo, hi in ((0, q), (q, len(own))):
                lo += lo < hi and own[lo] in LABELS
                hi -= lo < hi and own[hi - 1] in LABELS
                if hi - lo >= PIECE:
                    self.piece.append((item, own[lo:hi]))
        self.pieces = Postings([x for _, x in self.piece], self.terms, whole)

    def holds(self, words: list[str], piece: int) -> bool:
        """Whether every word of a question or answer lies in a run shared with ``words``."""
        own = self.piece[piece][1]
        there = set(zip(*(words[i:] for i in range(RUN))))
        at = [i for i, run in enumerate(zip(*(own[j:] for j in range(RUN)))) if run in there]
        return bool(at) and at[0] == 0 and at[-1] == len(own) - RUN and all(b - a <= RUN for a, b in zip(at, at[1:]))

    def cover(self, words: list[str], item: int) -> tuple[float, float, float]:
        """Shares of the item's words, of its question's and of its answer's, that lie in runs
        shared with ``words``."""
        own = self.words[item]
        k = min(RUN, len(own))
        there = set(zip(*(words[i:] for i in range(k))))
        hit = np.zeros(len(own), bool)
        for i, run in enumerate(zip(*(own[j:] for j in range(k)))):
            if run in there:
                hit[i:i + k] = True
        q = self.question[item]
        return float(hit.mean()), float(hit[:q].mean()) if q else 0.0, float(hit[q:].mean()) if q < len(own) else 0.0


class TermIds(dict):
    """White-space token -> its index term (-1: not in the index, -2: several words, -3: none)."""

    def __init__(self, terms: dict[str, int]):
        super().__init__()
        self.terms = terms

    def __missing__(self, token: str) -> int:
        if len(self) > TOKENS:
            self.clear()
        words = WORD.findall(token)
        out = self.terms.get(words[0], -1) if len(words) == 1 else -2 if words else -3
        if len(token) < 64:
            self[token] = out
        return out


def _term_ids(index: Index, known: TermIds, text: str | None) -> np.ndarray:
    """The index term of each of the text's words, -1 for others."""
    tokens = (text or "").lower().split()
    ids = np.fromiter(map(known.__getitem__, tokens), dtype=np.int64, count=len(tokens))
    least = ids.min() if len(ids) else 0
    if least == -2 or (least == -3 and (ids == -2).any()):
        words = words_of(text)
        return np.fromiter((index.terms.get(w, -1) for w in words), dtype=np.int64, count=len(words))
    return ids[ids != -3] if least == -3 else ids


def _passages(index: Index, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct (passage, index term) pairs of a batch, and each passage's text."""
    step = index.window
    size = np.array([len(x) for x in texts], dtype=np.int64)
    windows = np.where(size > 0, np.maximum(1, -(-size // step) - 1), 0)       # of two steps each
    base = np.r_[0, np.cumsum(windows)[:-1]] if len(size) else windows
    ids = np.concatenate(texts) if texts else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(size)), size)
    half = (np.arange(len(ids)) - np.repeat(np.r_[0, np.cumsum(size)[:-1]] if len(size) else size, size)) // step
    there = ids >= 0
    ids, owner, half = ids[there], owner[there], half[there]
    wide = max(len(index.terms), 1)
    keys = []
    for shift in (0, 1):    # a word lies in the window of its own half and in the one before
        p = half - shift
        ok = (p >= 0) & (p < windows[owner])
        keys.append((base[owner[ok]] + p[ok]) * wide + ids[ok])
    key = np.sort(np.concatenate(keys))
    if len(key):
        key = key[np.r_[True, key[1:] != key[:-1]]]
    return key // wide, key % wide, np.repeat(np.arange(len(size)), windows)


def found(index: Index, texts: list[str | None], threshold: float = THRESHOLD, known: TermIds | None = None
          ) -> list[tuple[int, int, float, float, float, float]]:
    """(text, item, score, cover, question cover, answer cover) of the contaminated texts."""
    known = TermIds(index.terms) if known is None else known
    out = []
    at = 0
    while at < len(texts):
        batch, held = [], 0
        while at + len(batch) < len(texts) and (not batch or held < BATCH_WORDS):
            batch.append(_term_ids(index, known, texts[at + len(batch)]))
            held += len(batch[-1])
        passage, term, owner = _passages(index, batch)
        best: dict[tuple[int, int], float] = {}
        for p, item, score in index.search(passage, term, threshold):
            key = (int(owner[p]), item)
            best[key] = max(best.get(key, 0.0), score)
        near: dict[tuple[int, int], float] = {}
        part: dict[tuple[int, int], set[int]] = {}
        for p, piece, score in index.pieces.search(passage, term, PIECE_SCORE):
            key = (int(owner[p]), index.piece[piece][0])
            near[key] = max(near.get(key, 0.0), score)
            part.setdefault(key, set()).add(piece)
        for (d, item), score in sorted((near | best).items()):      # an item's own score goes before its part's
            words = words_of(texts[at + d])
            cover, question, answer = index.cover(words, item)
            if cover >= COVER or any(index.holds(words, x) for x in part.get((d, item), ())):
                out.append((at + d, item, score, cover, question, answer))
        at += len(batch)
    return out


def _words(items: DataFrame) -> DataFrame:
    """(word) of every item: each distinct word once an item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(sorted(set(words_of(text))), pa.string())], names=["word"])

    return items.select("text").mapInArrow(run, "word string")


def _whole(items: DataFrame) -> tuple[tuple[int, float, int], DataFrame]:
    """Number, mean and greatest length of the items with words, and (word, df) over all items."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(words_of(t)) for t in batch.column(0).to_pylist()], pa.int64())], names=["n"])

    row = items.select("text").mapInArrow(run, "n long").where("n > 0").agg(F.count("n"), F.avg("n"), F.max("n")).first()
    counts = _words(items).groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    return (row[0], row[1] or 0.0, row[2] or 0), shared(counts)


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, score, cover, question_cover, answer_cover) of each contaminated document
    and test item. A pass over the documents for each index block; no shuffle of them."""
    spark = docs.sparkSession
    ship(spark)
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text")
    blocks = max(1, -(-items.count() // INDEX_ITEMS))
    src = docs.select(F.col("doc_id").cast("bigint").alias("id"), F.col("text"))
    schema = "doc_id long, item_id long, score double, cover double, question_cover double, answer_cover double"
    out = None
    lengths, counts = _whole(items) if blocks > 1 else (None, None)
    for k in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        rows = [(r.item_id, r.text) for r in mine.collect()]     # about INDEX_ITEMS
        whole = None
        if blocks > 1:
            df = _words(mine).distinct().join(counts, "word")     # the block's words
            whole = Whole(*lengths, {r.word: r.df for r in df.toLocalIterator()})
        rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
        sent = spark.sparkContext.broadcast((rows, whole))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = Index(*sent.value)
            known = TermIds(index.terms)
            for batch in (p for b in batches for p in parts(b)):
                ids = batch.column(0).to_pylist()
                hits = found(index, batch.column(1).to_pylist(), threshold, known) if index.ids else []
                yield pa.RecordBatch.from_pylist(
                    [{"doc_id": ids[d], "item_id": index.ids[i], "score": s, "cover": c, "question_cover": q, "answer_cover": a}
                     for d, i, s, c, q, a in hits],
                    schema=pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), *((x, pa.float64()) for x in
                                      ("score", "cover", "question_cover", "answer_cover"))]))
            give_back()

        part = src.mapInArrow(run, schema)
        out = part if out is None else out.union(part)
    return out
