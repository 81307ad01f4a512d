"""I-Match document fingerprints, in DataFrame expressions only.

The lexicon holds the terms whose inverse document frequency lies in a band. With the band given
as document frequencies ``LEAST`` to ``MOST`` of all documents, the lexicon has at most
(mean distinct terms of a document) / ``LEAST`` terms however large the corpus, since every term
in it takes that share of all (document, term) pairs. So it is small enough for a constant of the
plan; it comes from a grouped aggregation over all documents. It is a table of ``SLOTS`` slots,
each a list of term hashes, so a look-up reads one slot.

``SUBSETS`` randomised lexicon subsets: a term makes two hashed choices among them and is in the
subsets it chose, so every term of the lexicon takes part, and a subset holds about 2 / SUBSETS of
the lexicon. A text's distinct terms in a subset are sorted and hashed; the fingerprint is the row
of these hashes (8 hexadecimal digits each, zeros for a subset without terms). A text without a
term of the lexicon is hashed by all its terms. The likeness of two fingerprints is the share of
equal hashes among the subsets that hold a term of either.

Terms are runs of letters and digits in lower case, stood for by their 64-bit hash.

Cases: null counts as empty; empty texts share one fingerprint; equal texts have equal ones.
The next document follows by doc_id, then the text's hash, then text (ties and repeated rows are in
a stated order);
null doc_ids come first; the last is followed by the first, a single one by itself. Only the two
named columns are read.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window, functions as F

LEAST, MOST = 0.001, 0.2
SUBSETS, SLOTS = 128, 1 << 14     # at most 256 subsets: two hexadecimal digits
CHOICES = SUBSETS     # no choice lies outside the subsets
RANGES, RANGE_ROWS = 40_000, 5000
EMPTY = "0" * 8     # stands for a subset without terms


def term_hashes(text: Column) -> Column:
    """Distinct 64-bit hashes of a text's terms."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))


def _slot(h: Column) -> Column:
    return F.pmod(h, F.lit(SLOTS)).cast("int")


def lexicon(docs: DataFrame, text: str = "text", least: float = LEAST, most: float = MOST) -> Column:
    """The slots of the terms in the band as a constant column, counted over all documents. Each
    document sends a term once, and counts are summed before the shuffle."""
    total = docs.count()
    df = docs.select(F.explode(term_hashes(F.col(text))).alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("df"))
    band = df.where((F.col("df") >= least * total) & (F.col("df") <= most * total))
    slots: list[list[int]] = [[] for _ in range(SLOTS)]
    for row in band.select("h").toLocalIterator():      # at most mean distinct terms / least
        slots[row.h % SLOTS].append(row.h)
    return F.from_json(F.lit(json.dumps([sorted(x) for x in slots])), F.lit("array<array<bigint>>"))


def fingerprint(hashes: Column, slots: Column) -> Column:
    """The fingerprint of a set of term hashes under a lexicon."""
    def member(k: Column, h: Column) -> Column:
        return F.concat(F.lpad(F.hex(k), 2, "0"), F.lpad(F.hex(h), 16, "0"))

    def row(x: Column) -> Column:
        # Each subset has a mark before its terms, so the sorted members are SUBSETS runs of a prefix.
        marks = F.array(*[F.lit(f"{k:02X}" + "-" * 16) for k in range(SUBSETS)])
        members = F.sort_array(F.concat(marks, F.transform(x["own"], lambda h: member(_pick(h, 1), h)),
                                        F.transform(x["own"], lambda h: member(_pick(h, 2), h))))
        runs = F.regexp_extract_all(F.array_join(members, ""), F.lit(r"(..).{16}(?:\1.{16})*+"), F.lit(0))
        return F.when(F.size(x["own"]) > 0, F.array_join(F.transform(
            runs, lambda r: F.when(F.length(r) == 18, F.lit(EMPTY)).otherwise(_short(r))), "")
        ).otherwise(F.repeat(_short(F.sort_array(x["all"])), SUBSETS))

    taken = F.filter(hashes, lambda h: F.array_contains(F.element_at(slots, _slot(h) + 1), h))
    return F.element_at(F.transform(F.array(F.struct(taken.alias("own"), hashes.alias("all"))), row), 1)


def _pick(h: Column, seed: int) -> Column:
    """The subset that takes a term by its ``seed``-th choice."""
    return F.pmod(F.shiftright(h, 16 * seed), F.lit(CHOICES))


def _short(hashes: Column) -> Column:
    """Eight hexadecimal digits, never those of ``EMPTY``."""
    return F.lpad(F.lower(F.hex(F.greatest(F.xxhash64(hashes).bitwiseAND(F.lit(0xFFFFFFFF)), F.lit(1)))), 8, "0")


def subset_hashes(fp: Column) -> Column:
    """A fingerprint's hashes, one for each subset."""
    return F.regexp_extract_all(fp, F.lit(".{8}"), F.lit(0))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal hashes among the subsets in which either text has a term (1 if none has), from
    two rows of ``subset_hashes``. One fold: equal ones count in the high half, told ones in the low."""
    seen = F.zip_with(a, b, lambda x, y: F.when(x != y, F.lit(1)).when(x == EMPTY, F.lit(0)).otherwise(F.lit((1 << 16) + 1)))
    one = F.transform(F.array(F.aggregate(seen, F.lit(0), lambda n, x: n + x)), lambda n: F.when(n == 0, F.lit(1.0)).otherwise(
        F.shiftright(n, 16) / F.greatest(n.bitwiseAND(F.lit(0xFFFF)), F.lit(1))))
    return F.element_at(one, 1).cast("double")


def ranges(docs: DataFrame, id_col: str = "id", text_col: str = "text") -> Column:
    """The number of a row's range in the order of ids: approximate quantiles cut the ids into ranges
    of about ``RANGE_ROWS`` rows. An id that is a cut has ranges of its own, by its texts' hashes, so
    that ids which are null or repeat very often are not one range. The cuts lie in chunks: a row
    looks through their ends and one chunk."""
    total = docs.count()
    n = min(RANGES, -(-total // RANGE_ROWS))
    place = F.coalesce(F.col(id_col), F.lit(-(1 << 63)))
    found = (docs.agg(F.percentile_approx(place, [i / n for i in range(1, n)], 10 * n)).first()[0] or []) if n > 1 else []
    cuts = sorted(set(found))
    if not cuts:
        return F.lit(0).cast("bigint")
    wide = math.isqrt(len(cuts) - 1) + 1
    chunks = [cuts[i:i + wide] for i in range(0, len(cuts), wide)]
    ends = F.from_json(F.lit(json.dumps([c[-1] for c in chunks])), F.lit("array<bigint>"))
    nested = F.from_json(F.lit(json.dumps([*chunks, []])), F.lit("array<array<bigint>>"))

    def number(i: Column) -> Column:
        chunk = F.element_at(nested, i + 1)
        own = F.when(F.array_contains(chunk, place), F.shiftright(F.xxhash64(text_col), 58) + 33).otherwise(0)     # 1 to 64
        return ((i * wide + F.size(F.filter(chunk, lambda c: c < place))) * 128 + own).cast("bigint")

    return F.element_at(F.transform(F.array(F.size(F.filter(ends, lambda c: c < place))), number), 1)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has the last floor(n_chars / 2) code points replaced by the first as many (or
    all) of the next document. Ranges of ids are ordered each in its own task; the last row of a
    range gets the first row of the next range by a join on the range number.
    """
    src = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    slots = lexicon(src)
    place = ranges(src)
    own = src.withColumn("range", place)
    marked = own.withColumn("fp", F.unhex(fingerprint(term_hashes(F.col("text")), slots)))     # half the digits' bytes to deal out
    order = Window.partitionBy("range").orderBy(F.col("id").asc_nulls_first(), F.xxhash64("text"), F.col("text"))
    led = marked.withColumn("next", F.lead(F.struct("text", "fp")).over(order))

    firsts = own.groupBy("range").agg(F.min(F.struct("id", F.xxhash64("text").alias("h"), "text")).alias("first"))     # a row for each range
    line = Window.orderBy("range")
    whole = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    turn = firsts.select("range", F.coalesce(F.lead("first.text").over(line), F.first("first.text").over(whole)).alias("text"))
    turn = turn.select("range", F.struct("text", F.unhex(fingerprint(term_hashes(F.col("text")), slots)).alias("fp")).alias("turn"))

    both = led.join(turn, "range").select("id", "text", "fp", F.coalesce("next", "turn").alias("next"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), n - half), F.substr(F.col("next.text"), F.lit(1), half))
    both = both.select("id", F.lower(F.hex("fp")).alias("fp"), n.cast("bigint").alias("n_chars"), edited.alias("edited"),
                       F.lower(F.hex("next.fp")).alias("next_fp"))
    both = both.withColumn("edited_fp", fingerprint(term_hashes(F.col("edited")), slots))
    both = both.select("*", *[subset_hashes(F.col(c)).alias(f"{c}_row") for c in ("fp", "edited_fp", "next_fp")])
    return both.select(F.col("id").alias(id_col), "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                       F.col("fp").alias("fingerprint"), F.col("edited_fp").alias("edited_fingerprint"),
                       likeness(F.col("fp_row"), F.col("edited_fp_row")).alias("near_edited"),
                       likeness(F.col("fp_row"), F.col("next_fp_row")).alias("near_next"))
