"""Language identification as multilingual mixture inference.

Model: per learned language, the log probabilities of hashed character n-grams (1 to 3 letters of
a word with its ends marked), counted by a grouped aggregation over at most ``FIT_ROWS`` labelled
documents, or ``LANG_ROWS`` of each language if that is more, so rare languages are learned too. A word's likelihood under a language comes from its n-grams; words are looked up in
a per-worker memory, as they recur.

Prediction: a document is a mixture of languages. Expectation-maximisation over its words
estimates the proportions; the set of languages is chosen by penalised likelihood: starting from
all, the languages are taken in order of their proportions, and the set of the first k whose
log likelihood less ``PENALTY`` * k * log(words) is greatest stands. ``lang_pred`` is its greatest
proportion, ``score`` that proportion. Only the text is an input of a prediction.

Cases: null text or text without a letter is ``und`` with score 0; ties go to the smaller
language name; with no labelled text every document is ``und``; repeated rows are judged each.
Only the id, text and (for learning) language columns are read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from .common import hash_share, ship

FIT_ROWS = 20_000       # documents the n-grams are counted on, an equal part for each language
LANG_ROWS = 1000        # at least so many of a language, if it has them
FEATURES = 1 << 15      # hashed n-grams
PENALTY = 4.0           # per language, times the log of the number of words
STEPS = 8               # EM steps
TEMPER = 0.5            # overlapping n-grams count for less than independent ones

WORD = re.compile(r"[^\W\d_]+")     # letters, and a few numerals that are no digits
LETTERS = regex.compile(r"\p{L}+")


def words_of(text: str | None) -> list[str]:
    """The runs of letters of a text, in lower case."""
    text = (text or "").lower()
    found = WORD.findall(text)
    return found if all(map(str.isalpha, found)) else LETTERS.findall(text)


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of lower-case words, all at once, and the word each belongs to."""
    code = np.frombuffer("".join([f" {w} " for w in words]).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), [len(w) + 2 for w in words])
    ids, owners = [], []
    total = np.zeros(len(code), dtype=np.uint64)
    for n, factor in enumerate((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)):
        total = total[:len(code) - n] + code[n:] * np.uint64(factor)
        inside = owner[n:] == owner[:len(code) - n]
        mixed = (total[inside] + np.uint64(n)) * np.uint64(0xFF51AFD7ED558CCD)
        ids.append((mixed >> np.uint64(40)) % np.uint64(FEATURES))
        owners.append(owner[n:][inside])
    return np.concatenate(ids).astype(np.int64), np.concatenate(owners)


def _counts(docs: DataFrame, id_col: str, text_col: str, lang_col: str, fit_rows: int) -> DataFrame:
    """(lang, gram, n) over the sampled labelled documents: a row per task, language and n-gram."""
    known = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")
                        ).where("text IS NOT NULL AND lang IS NOT NULL")
    totals = {r.lang: r["count"] for r in known.groupBy("lang").count().collect()}
    each = max(fit_rows // max(len(totals), 1), LANG_ROWS)
    large = {k: n for k, n in totals.items() if n > each}       # the others are taken whole
    chosen = ~F.col("lang").isin(list(large))
    for k, n in large.items():
        chosen = chosen | ((F.col("lang") == k) & hash_share(each, n, "id"))
    src = known.where(chosen).select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            words: dict[str, Counter] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words.setdefault(lang, Counter()).update(words_of(text))
            for lang, own in words.items():
                ids, owner = grams(list(own))
                n = np.bincount(ids, np.array(list(own.values()), dtype=float)[owner], FEATURES) if own else np.zeros(FEATURES)
                total[lang] = total.get(lang, 0) + n.astype(np.int64)
        for lang, own in total.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at), pa.array(own[at])], names=["lang", "gram", "n"])

    return src.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          fit_rows: int = FIT_ROWS) -> tuple[list[str], np.ndarray]:
    """The languages and their n-gram log probabilities: FEATURES rows a language at most."""
    ship(docs.sparkSession)
    rows = _counts(docs, id_col, text_col, lang_col, fit_rows).collect()
    langs = sorted({r.lang for r in rows})
    n = np.full((len(langs), FEATURES), 0.2)
    for r in rows:
        n[langs.index(r.lang), r.gram] += r.n
    return langs, np.log(n / n.sum(1, keepdims=True)).astype(np.float32) if langs else n


class WordLikelihoods(dict):
    """Word -> row of a growing table of likelihoods, relative to the word's best language."""

    def __init__(self, table: np.ndarray):
        super().__init__()
        self.table = table
        self.like = np.zeros((0, table.shape[0]), dtype=np.float32)

    def add(self, words: list[str]) -> None:
        """Make every one of ``words`` known; a full memory is emptied first."""
        if len(self) > 400_000:
            self.clear()
            self.like = self.like[:0]
        new = list(dict.fromkeys(w for w in words if w not in self))
        if new:
            ids, owner = grams(new)
            value = TEMPER * np.stack([np.bincount(owner, t[ids], len(new)) for t in self.table], axis=1)
            self.update(zip(new, range(len(self), len(self) + len(new))))
            self.like = np.concatenate([self.like, np.exp(np.maximum(value - value.max(1, keepdims=True), -60.0)).astype(np.float32)])


def mixtures(like: np.ndarray, first: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """EM for many documents at once. ``like``: words x languages, ``first``: each document's
    first word, ``allowed``: documents x languages. Returns proportions and log likelihoods."""
    size = np.diff(np.r_[first, len(like)])
    owner = np.repeat(np.arange(len(first)), size)
    pi = (allowed / allowed.sum(1, keepdims=True)).astype(like.dtype)
    many = allowed.sum(1).max() > 1     # one language alone has nothing to estimate
    for _ in range(STEPS if many else 0):
        part = like * pi[owner]
        part /= part.sum(1, keepdims=True) + 1e-30
        pi = np.add.reduceat(part, first, axis=0) / size[:, None].astype(like.dtype)
    total = np.log((like * pi[owner]).sum(1) + 1e-30).astype(np.float64)
    return pi, np.add.reduceat(total, first)


def chosen(like: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The best language and its proportion per document, by penalised likelihood."""
    docs, langs = len(first), like.shape[1]
    size = np.diff(np.r_[first, len(like)])
    price = PENALTY * np.log(size + 1)
    pi, most = mixtures(like, first, np.ones((docs, langs)))
    order = np.argsort(-np.round(pi, 6), axis=1, kind="stable")
    rank = np.argsort(order, axis=1, kind="stable")
    best = np.full(docs, -np.inf)
    out = np.zeros(docs, dtype=int)
    score = np.zeros(docs)
    open_ = np.arange(docs)     # documents whose next language may still pay
    for k in range(1, langs + 1):
        whole = len(open_) == docs
        words = slice(None) if whole else np.concatenate([np.arange(first[d], first[d] + size[d]) for d in open_])
        starts = np.r_[0, np.cumsum(size[open_])[:-1]]
        p, log = mixtures(like[words], starts, (rank[open_] < k).astype(float))
        value = log - k * price[open_]
        better = value > best[open_]
        at = open_[better]
        best[at] = value[better]
        out[at], score[at] = p[better].argmax(1), p[better].max(1)
        # No set does better than all languages; one more of them must still pay its price.
        open_ = open_[most[open_] + 1 - (k + 1) * price[open_] > best[open_]]
        if not len(open_):
            break
    return out, score


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every row. No shuffle."""
    ship(docs.sparkSession)
    langs, table = model
    sent = docs.sparkSession.sparkContext.broadcast(table)
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = src.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = WordLikelihoods(sent.value)
        for batch in batches:
            names, scores = [], []
            texts = batch.column(1).to_pylist()
            at = 0
            while at < len(texts):
                said, held = [], 0
                while at + len(said) < len(texts) and (not said or held < 300_000):
                    said.append(words_of(texts[at + len(said)]) if langs else [])
                    held += len(said[-1])
                memory.add([w for x in said for w in set(x)])
                rows = [np.fromiter(map(memory.__getitem__, x), dtype=np.int64, count=len(x)) for x in said]
                full = [i for i, r in enumerate(rows) if len(r)]
                lang, score = ["und"] * len(rows), [0.0] * len(rows)
                if full:
                    like = memory.like[np.concatenate([rows[i] for i in full])]
                    first = np.r_[0, np.cumsum([len(rows[i]) for i in full])[:-1]]
                    for i, l, s in zip(full, *chosen(like, first)):
                        lang[i], score[i] = langs[l], float(min(s, 1.0))
                names += lang
                scores += score
                at += len(rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                             names=["id", "lang_pred", "score"])

    return src.mapInArrow(run, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)
