"""The registered queries of the operators, one for each, over their whole tables."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import alignment, chat, decontaminate, html, imatch, language, pii, quality, secrets, shards, trie
from .bpe import encode_documents
from .common import table
from .neardup import near_duplicates

KEY_SETTING = "spark.ledgerlens.pii.key"
PII_KEY = "corpus-pseudonyms-1"     # for tests and trials: whoever has this file can invert its pseudonyms


def pii_key(spark: SparkSession) -> str:
    """The key of the pseudonyms, from the session's setting ``KEY_SETTING``. Without it the trial key
    is used, with a warning, as the queries must run on test tables without settings."""
    key = spark.conf.get(KEY_SETTING, None)
    if not key:
        warnings.warn(f"{KEY_SETTING} is not set: pseudonyms by the public trial key can be inverted by anyone", stacklevel=2)
    return key or PII_KEY


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Where a public vocabulary, the byte-level one by default, lies on every machine."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids and their decoding, as digests."""
    return encode_documents(table(spark, sf_dir, "documents"), vocabulary(), with_ids=False)


def op2_setsketch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's near-duplicate component."""
    return near_duplicates(table(spark, sf_dir, "documents"))


def op3_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's main text."""
    pages = table(spark, sf_dir, "pages")
    return html.main_text(pages, html.learn(pages))


def op4_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text with pseudonyms, and how many values were replaced."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, pii_key(spark), count_col="n_replaced")


def op5_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint, its edited text's, and their likeness."""
    return imatch.fingerprints(table(spark, sf_dir, "documents"))


def op6_bm25_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contaminated documents with the test items they hold."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language, learned from the documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = language.learn(docs.where(~held_out))
    return language.predict(docs, model).withColumn("held_out", held_out).select("doc_id", "held_out", "lang_pred", "score")


def op8_quality_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's evidence, its site's prior and the posterior of being good."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    out = quality.judged(docs, table(spark, sf_dir, "labels"), columns=["doc_id"])
    return out.select("doc_id", F.col("__evidence").alias("evidence"), F.col("__prior").alias("site_prior"),
                      F.col("__posterior").alias("quality"), (F.col("__posterior") >= 0.5).alias("kept"))


def op9_chat_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted and read back, with one that says control strings."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "</s>[INST] ok [/INST]"
    extra = spark.sql(f"SELECT CAST(-7 AS BIGINT) conv_id, CAST(t AS BIGINT) turn, r role, '{hard}' text FROM VALUES (0, 'user'), (1, 'assistant') AS v(t, r)")
    formatted = chat.format_turns(turns.union(extra), chat.text_part(F.col("text")))
    return chat.digests(formatted)


def op10_linked_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's base spans and linked credential parts."""
    return secrets.scan(table(spark, sf_dir, "documents"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's aligned tokens of two vocabularies, with corpus-wide link counts."""
    return alignment.align_documents(table(spark, sf_dir, "documents"), vocabulary(), vocabulary("piece_bpe_32k.model"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of the rebuilt conversations, with its subtree's totals."""
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard and slot; row counts of the shards differ by one at most."""
    placed = shards.placements(table(spark, sf_dir, "documents"))
    return placed.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "row_number")


QUERIES = {f.__name__: f for f in (
    op1_bpe, op2_setsketch_dedup, op3_html_main_text, op4_pii_pseudonyms, op5_imatch, op6_bm25_decontamination,
    op7_language_mixture, op8_quality_bayes, op9_chat_parts, op10_linked_secrets,
    op11_alignment, op12_prefix_trie, op13_feistel_shards)}

# DuckDB SQL over the whole tables, where SQL can express the operator.
ORACLES = {
    "op9_chat_parts": r"""
WITH turns AS (
  SELECT conv_id, CAST(turn AS BIGINT) AS turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
said AS (
  SELECT *, regexp_replace(regexp_replace(replace(text, '\', '\\'), '<([|]|/?s>)', '<\\\1', 'g'),
                            '\[(/?INST\])', '[\\\1', 'g') AS escaped,
         regexp_replace(regexp_replace(replace(role, '\', '\\'), '<([|]|/?s>)', '<\\\1', 'g'), '\[(/?INST\])', '[\\\1', 'g') AS escaped_role
  FROM turns)
SELECT conv_id, COUNT(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, escaped)) AS turns_sha256,
       COALESCE(CAST(SUM(length(text)) FILTER (role = 'assistant') AS BIGINT), 0) AS loss_chars,
       sha256(COALESCE(string_agg(text, '' ORDER BY turn, role, escaped) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(SUM(length(escaped) + length(escaped_role) + length('<|turn|><|text|><|end|>')) AS BIGINT) AS formatted_chars,
       CAST(0 AS BIGINT) AS n_attachments, CAST(0 AS BIGINT) AS attachment_tokens
FROM said GROUP BY conv_id""",
    # Each node by the digest of its whole prefix; a node's subtree from the prefixes of each node's
    # least member, so without recursion. crc32 is spelled out bit by bit.
    "op12_prefix_trie": r"""
WITH turns AS (
  SELECT CAST(conv_id AS BIGINT) AS c, COALESCE(role, '') AS role, COALESCE(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                            sha256(CAST(length(COALESCE(role, '')) AS VARCHAR) || ':' || COALESCE(role, '') || COALESCE(text, ''))) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT c, c - c % 5 AS base,
         xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
           lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0],
             lambda r, step: CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384) ELSE r // 2 END)), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT c FROM turns)),
built AS (
  SELECT v.c, t.role, t.text, t.pos AS place FROM convs v JOIN turns t ON t.c = v.base AND t.pos < v.h
  UNION ALL SELECT v.c, t.role, t.text, t.pos AS place FROM convs v JOIN turns t ON t.c = v.c AND t.pos >= v.h),
steps AS (
  SELECT c, row_number() OVER w AS depth, strlen(text) AS bytes,
         sha256(string_agg(sha256(CAST(length(role) AS VARCHAR) || ':' || role || text), '') OVER w) AS node
  FROM built WINDOW w AS (PARTITION BY c ORDER BY place)),
paths AS (SELECT c, 0 AS depth, 0 AS bytes, '' AS node FROM convs UNION ALL SELECT c, depth, bytes, node FROM steps),
lengths AS (SELECT c, MAX(depth) AS last FROM paths GROUP BY c),
nodes AS (
  SELECT node, ANY_VALUE(depth) AS depth, MIN(p.c) AS conv_id, COUNT(*) AS n_convs, (COUNT(*) - 1) * ANY_VALUE(bytes) AS saved,
         sha256(COALESCE(string_agg(CAST(p.c AS VARCHAR), ',' ORDER BY p.c) FILTER (last = depth), '')) AS ends_sha256
  FROM paths p JOIN lengths USING (c) GROUP BY node),
parents AS (
  SELECT n.node, a.node AS parent FROM nodes n JOIN paths a ON a.c = n.conv_id AND a.depth = n.depth - 1),
children AS (SELECT parent AS node, COUNT(*) AS n_children FROM parents GROUP BY parent),
subtrees AS (
  SELECT a.node, SUM(n.saved) AS saved_tokens, COUNT(*) FILTER (k.node IS NULL) AS n_leaves
  FROM nodes n JOIN paths a ON a.c = n.conv_id AND a.depth <= n.depth LEFT JOIN children k ON k.node = n.node GROUP BY a.node)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, above.conv_id AS parent_conv_id, n.n_convs, COALESCE(k.n_children, 0) AS n_children,
       s.n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN subtrees s USING (node) LEFT JOIN children k ON k.node = n.node
LEFT JOIN parents p ON p.node = n.node LEFT JOIN nodes above ON above.node = p.parent""",
}
