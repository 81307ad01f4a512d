"""Quality by hierarchical empirical Bayes: a document's own evidence and its site's record.

1. A logistic classifier over form features of the text (``features``) is fitted on at most
   ``FIT_ROWS`` labelled documents, chosen by a hash; a second one joins its log-odds and the text's
   wording: the summed log ratios, learned from the labels, of the text's hashed words, word pairs and character
   4-grams (``grams``). For the fit, each half of the sample is scored by the ratios of the other
   half, so it counts for what it tells of unseen documents. The log-odds less those of the fitted
   sample are the document's evidence, a log likelihood ratio.
2. Grouped aggregation over all documents gives every path (host and first path segment of the
   source) its expected number of good documents. Host rates shrink toward the global rate and
   path rates toward their host's, each by the strength that the spread between sites implies
   (moments of the beta-binomial): sparse sites hardly move from their prior.
3. A document's posterior joins its evidence to its path's rate; ``kept`` means at least one half.

A hot source is one group of a sum that is aggregated on the map side first. The table of sites
is broadcast when a count shows that it is small, else joined by a shuffle.

Cases: null or blank text has evidence 0 and follows its site; a null source is a site of its
own; without usable labels of both kinds the evidence is 0; an empty table gives no rows;
repeated rows count each. Only the id, text and source columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import hash_share, shared, ship, unused, written

FIT_ROWS = 10_000           # labelled documents the classifier is fitted on, at most
SMALL_SITES = 20_000        # sites that may be broadcast
EVIDENCE_MOST = 30.0
GRAMS = 1 << 16             # hashed words, word pairs and character 4-grams
GRAM_BYTES = 1 << 20        # bytes of a text that are hashed at a time
SMOOTH = 2.0                # documents of the pooled rate that join each class's

IS_MARK = np.isin(np.arange(256), [ord(c) for c in "#%$*&!@~^_=<>{}[]|\\"])


def features(text: str) -> list[float]:
    """Form of a non-blank text: shares of letters, capitals, digits, marks and bars, runs of
    marks, word lengths, repeats of the word before, and distinct words."""
    words = text.split()
    n, chars = len(words), len(text)
    raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    mark = IS_MARK[raw]
    pairs = mark[1:] & mark[:-1]
    runs = int(pairs.sum()) - int((pairs[1:] & pairs[:-1]).sum())
    bars = text.count("|")
    capitals = sum(map(str.isupper, words))
    digits = int(((raw >= 48) & (raw <= 57)).sum())
    repeats = sum(map(str.__eq__, words, words[1:]))
    return [math.log1p(n), chars / n, capitals / n, digits / chars, int(mark.sum()) / chars, bars / n, runs / n,
            repeats / n, len(set(words)) / n, math.sqrt(repeats / n), math.sqrt(bars / n), math.sqrt(runs / n), math.sqrt(capitals / n)]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(32)
    return ((x * np.uint64(0xC4CEB9FE1A85EC53)) >> np.uint64(48)).astype(np.int64) % GRAMS


POWERS = np.cumprod(np.full(64, 0x9E3779B97F4A7C15, np.uint64))
IS_WORD = np.array([chr(c).isalnum() or c >= 128 for c in range(128)] + [True] * 128)


def grams(text: str) -> np.ndarray:
    """The distinct hashed words, word pairs and character 4-grams of the whole text, in lower case.
    Long texts are hashed in parts: a word's hash is summed over the parts that it lies in, and
    4-grams are taken across their ends."""
    there = np.zeros(GRAMS, bool)
    raw = np.frombuffer(text.lower().encode("utf-8", "replace"), dtype=np.uint8)
    word = IS_WORD[raw]
    starts = np.flatnonzero(word & np.r_[True, ~word[:-1]])
    own = np.zeros(len(starts), np.uint64)
    for at in range(0, len(raw), GRAM_BYTES):
        code = raw[at:at + GRAM_BYTES + 3].astype(np.uint64)
        if len(code) > 3:
            there[_mixed(code[:-3] | code[1:-2] << np.uint64(8) | code[2:-1] << np.uint64(16) | code[3:] << np.uint64(24))] = True
        code = code[:GRAM_BYTES]
        first, last = max(int(np.searchsorted(starts, at, "right")) - 1, 0), int(np.searchsorted(starts, at + len(code)))
        if first == last:
            continue
        begins = starts[first:last]                 # of the words that lie in this part; the first may begin before it
        inner = np.maximum(begins - at, 0)
        code = code[inner[0]:]
        place = np.arange(at + inner[0], at + inner[0] + len(code)) - np.repeat(begins, np.diff(np.r_[inner, inner[0] + len(code)]))
        sums = (code + np.uint64(1)) * POWERS[place % 64] * word[at + inner[0]:at + inner[0] + len(code)]
        own[first:last] += np.add.reduceat(sums, inner - inner[0])
    there[_mixed(own + np.uint64(1))] = True
    there[_mixed(own[:-1] * np.uint64(31) + own[1:] + np.uint64(2))] = True
    return np.flatnonzero(there)


def wording(text: str, ratios: np.ndarray) -> float:
    ids = grams(text)
    return float(ratios[ids].sum() / math.sqrt(max(len(ids), 1)))


def gram_ratios(there: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Log ratios of good against bad of every gram: ``there`` and ``total`` are the documents with
    it and all documents, bad and good."""
    pooled = (there.sum(0) + 0.5) / (total.sum() + 1)
    rate = (there + SMOOTH * pooled) / (total[:, None] + SMOOTH)
    return np.log(rate[1] / rate[0]).astype(np.float32)


def _learned(sample: DataFrame) -> np.ndarray:
    """Log ratios of the grams, by the sample's halves: those of half 0, of half 1 and of both."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((4, GRAMS + 1), np.int64)      # the last is the number of documents
        for batch in batches:
            for half, good, text in zip(*(c.to_pylist() for c in batch.columns)):
                count[2 * half + good, grams(text)] += 1
                count[2 * half + good, GRAMS] += 1
        cell, gram = np.nonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(gram), pa.array(count[cell, gram])], names=["cell", "gram", "n"])

    rows = sample.select("half", "good", "text").mapInArrow(run, "cell long, gram long, n long").groupBy("cell", "gram").agg(F.sum("n").alias("n")).toArrow()
    count = np.zeros((4, GRAMS + 1))
    cell, gram, n = (rows.column(c).to_numpy() for c in ("cell", "gram", "n"))
    count[cell, gram] = n
    first, second = count[:2], count[2:]
    return np.stack([gram_ratios(x[:, :GRAMS], x[:, GRAMS]) for x in (first, second, first + second)])


def fitted(rows: list[tuple[list[float], int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Mean, spread and weights (bias last) of a ridge-penalised logistic regression, by Newton
    steps, and the log-odds of the sample's good share."""
    x = np.array([r[0] for r in rows], float)
    y = np.array([r[1] for r in rows], float)
    mean, spread = x.mean(0), x.std(0) + 1e-6
    z = np.hstack([(x - mean) / spread, np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    penalty = np.diag([1.0] * (len(w) - 1) + [1e-3])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + penalty, z.T @ (y - p) - penalty @ w)
        w += step
        if abs(step).max() < 1e-6:
            break
    return mean, spread, w, math.log(y.mean() / (1 - y.mean()))


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS):
    """The classifier, or None if the sample lacks good or bad documents. The chosen labels are
    ``fit_rows`` at most in expectation, so they may be broadcast; repeated rows of a document or
    label are one."""
    known = labels.select(F.col("doc_id").alias("id"), F.col("quality").cast("int").alias("good")).where("id IS NOT NULL AND good IN (0, 1)").distinct()
    picked = known.where(hash_share(fit_rows, known.count(), "id"))

    half = F.pmod(F.xxhash64(F.lit("half"), "id"), F.lit(2)).cast("int")
    sample = shared(docs.select(F.col("doc_id").alias("id"), "text").join(F.broadcast(picked), "id")
                    .where(F.col("text").rlike(r"\S")).groupBy("id", "good").agg(F.min("text").alias("text"))
                    .withColumn("half", half))
    ratios = _learned(sample)

    @F.pandas_udf("array<double>")
    def shape(text: pd.Series, half: pd.Series) -> pd.Series:
        return pd.Series([[*features(t), wording(t, ratios[1 - h])] for t, h in zip(text, half)])     # of the other half

    rows = sample.select(shape("text", "half").alias("x"), "good").collect()
    if len({r.good for r in rows}) < 2:
        return None
    mean, spread, w, base = fitted([(r.x[:-1], r.good) for r in rows])
    form = (np.array([r.x[:-1] for r in rows]) - mean) / spread @ w[:-1] + w[-1]
    joined = fitted([([f, r.x[-1]], r.good) for f, r in zip(form, rows)])
    return mean, spread, w, base, joined[:3], ratios[2]


def evidence(model) -> Column:
    """Pandas UDF: text -> log likelihood ratio of good against bad."""
    @F.pandas_udf("double")
    def ratio(text: pd.Series) -> pd.Series:
        if model is None:
            return pd.Series([0.0] * len(text))
        mean, spread, w, base, joined, ratios = model
        real = [bool(t and not t.isspace()) for t in text]
        out = np.zeros(len(text))
        if any(real):
            some = [t for t, r in zip(text, real) if r]
            form = (np.array([features(t) for t in some]) - mean) / spread @ w[:-1] + w[-1]
            x = (np.stack([form, [wording(t, ratios) for t in some]], axis=1) - joined[0]) / joined[1]
            out[np.array(real)] = np.clip(x @ joined[2][:-1] + joined[2][-1] - base, -EVIDENCE_MOST, EVIDENCE_MOST)
        return pd.Series(out)
    return ratio


def site_of(source: Column) -> tuple[Column, Column]:
    """Host and path (host and first segment) of a source or URL."""
    bare = F.regexp_replace(F.coalesce(source, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://", "")
    bare = F.regexp_replace(bare, r"[?#].*$", "")
    host = F.lower(F.split_part(bare, F.lit("/"), F.lit(1)))
    return host, F.concat_ws("/", host, F.split_part(bare, F.lit("/"), F.lit(2)))


def _strength(groups: DataFrame, total: str, good: str, prior: Column) -> float:
    """How many documents the prior counts for: from the spread of the groups' rates around it,
    less what chance alone makes."""
    rate = F.col(good) / F.col(total)
    row = groups.select(F.col(total).alias("n"), ((rate - prior) ** 2).alias("d"), (prior * (1 - prior)).alias("v")).agg(
        F.sum(F.col("n") * F.col("d")), F.sum("v"), F.sum(F.col("n") * F.col("v")), F.sum("n")).first()
    if not row[3]:
        return 1.0
    between = max((row[0] - row[1]) / row[3], 1e-6)
    return min(max(row[2] / row[3] / between - 1, 1.0), 1e4)


def sites(scored: DataFrame, start: float) -> DataFrame:
    """(path, prior): the shrunk good rate of every path. ``scored`` has host, path, evidence;
    ``start`` is the log-odds of the good share among labels."""
    p = 1 / (1 + F.exp(-(F.col("evidence") + F.lit(start))))
    paths = shared(scored.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum(p).alias("good")))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("good").alias("host_good"))
    whole = hosts.agg(F.sum("host_n"), F.sum("host_good")).first()
    mean = min(max((whole[1] or 0.5) / (whole[0] or 1), 0.01), 0.99)
    k = _strength(hosts, "host_n", "host_good", F.lit(mean))
    hosts = hosts.withColumn("host_rate", (F.col("host_good") + k * mean) / (F.col("host_n") + k))
    both = shared(paths.join(hosts.select("host", "host_rate"), "host"))
    k = _strength(both, "n", "good", F.col("host_rate"))
    return both.select("path", ((F.col("good") + k * F.col("host_rate")) / (F.col("n") + k)).alias("prior"))


def judged(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, columns: list[str] | None = None) -> DataFrame:
    """All rows of ``docs`` with ``__evidence``, ``__prior`` and ``__posterior`` (good); a column of
    ``docs`` that has one of these names keeps it, and the new one is named by ``unused``. With
    ``columns`` just those of ``docs`` are carried. The evidence is computed once, beside the carried
    columns in a written table, which the sites and the posteriors read."""
    ship(docs.sparkSession)
    model = fit(docs, labels, fit_rows)
    own_host, own_path, own_prior, own_evidence, own_posterior = (
        unused(docs, c) for c in ("__host", "__path", "__prior", "__evidence", "__posterior"))
    host, path = site_of(F.col("source"))
    carried = [F.col(f"`{c}`") for c in (docs.columns if columns is None else columns)]
    rows = written(docs.select(*carried, host.alias(own_host), path.alias(own_path), evidence(model)("text").alias(own_evidence)))
    scored = rows.select(F.col(own_host).alias("host"), F.col(own_path).alias("path"), F.col(own_evidence).alias("evidence"))
    table = shared(sites(scored, model[3] if model else 0.0))
    table = table.select(F.col("path").alias(own_path), F.col("prior").alias(own_prior))
    if table.count() <= SMALL_SITES:
        table = F.broadcast(table)
    rows = rows.join(table, own_path)
    logit = F.col(own_evidence) + F.log(F.col(own_prior) / (1 - F.col(own_prior)))
    return rows.withColumn(own_posterior, 1 / (1 + F.exp(-logit))).drop(own_host, own_path)
