"""The corpus pipeline: documents -> good, distinct, uncontaminated, pseudonymised, encoded documents.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's ``docs``. Every stage works on all rows its predecessor kept; all but
the last return the columns of ``docs`` as they came. Rows are taken out by an anti-join against
the ids found, so a row without an id, which nothing can name, stays. Repeated rows and rows that
share an id: the quality and PII stages judge each by itself, near-dedup keeps one row of a
component (equal ones by a hash of the row, so ties are the same row or an equal one), and
decontamination takes out every row of an id that holds a test item.

Stages that run Python set the session's Arrow batches to a few MB (``small_batches``), for an
executor keeps its JVM's and its workers' memory from stage to stage.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlens.llm import decontaminate, neardup, pii, quality
from ledgerlens.llm.bpe import encode_documents
from ledgerlens.llm.common import shared, small_batches, table, unused, written
from ledgerlens.llm.queries import pii_key, vocabulary
from ledgerlens.operators.relational import bloom_filter


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` without the rows of the given ids (a column ``__id``)."""
    ids = shared(ids.where("__id IS NOT NULL").distinct())
    return docs.join(ids, docs["doc_id"] == ids["__id"], "left_anti")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose posterior of being good is at least one half."""
    small_batches(spark)
    out = quality.judged(docs, table(spark, sf_dir, "labels"))
    out = out.where(F.col(unused(docs, "__posterior")) >= 0.5)
    return out.select(*(out[f"`{c}`"] for c in docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every near-duplicate component, of its least id: rows are judged by their own
    text, also where an id stands on several rows. Rows without an id or without words stay."""
    small_batches(spark)
    found = written(neardup.classed(docs))
    ids = written(found.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and("kept").alias("kept")).where("n > 1 OR NOT kept").withColumnRenamed("doc_id", "__id"))
    # Ids on several rows: their rows by the class of their text, one row for each component.
    several = ids.where("n > 1").select("__id")
    rows = bloom_filter(docs, several, "doc_id", "__id")
    rows = rows.join(several, rows["doc_id"] == several["__id"], "left_semi")
    rows = rows.select(F.struct(*(rows[f"`{c}`"] for c in docs.columns)).alias("row"), neardup.set_key(rows["text"]).alias("key"))
    kept = found.where("kept AND set_key IS NOT NULL").select(
        F.col("doc_id").alias("__id"), F.col("set_key").alias("__key"), F.col("group").alias("__group")).distinct()
    hashed = F.xxhash64(*[F.to_json(F.col(f"row.`{f.name}`")) if "map<" in f.dataType.simpleString() else F.col(f"row.`{f.name}`")
                          for f in docs.schema.fields])
    one = (rows.join(kept, (F.col("row.doc_id") == F.col("__id")) & (F.col("key") == F.col("__key")))
           .groupBy("__group").agg(F.min_by("row", hashed).alias("row")).select("row"))
    one = one.unionByName(rows.where("key IS NULL").select("row"))
    return _without(docs, ids.select("__id")).unionByName(one.select("row.*"))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item."""
    small_batches(spark)
    hits = decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark"))
    return _without(docs, hits.select(F.col("doc_id").alias("__id")))


def pii_pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by pseudonyms in the text. ``n_chars`` follows it."""
    out = pii.pseudonymise(docs, pii_key(spark))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(
            F.length("text")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256 and the ids themselves."""
    small_batches(spark)
    return encode_documents(docs, vocabulary())


STAGES = [
    ("quality classifier", quality_classifier),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("PII", pii_pseudonyms),
    ("BPE encoding and decoding", bpe_encoding),
]

# No single SQL statement: the classifier's fit and the components are not SQL. tests/llm checks
# the stages against brute force instead.
ORACLE_SQL = None


def _folder(spark: SparkSession) -> str:
    """A new folder in the shared one that spark.checkpoint.dir names."""
    sc = spark.sparkContext
    shared_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not shared_dir:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared_dir = tempfile.mkdtemp(prefix="ledgerlens-pipeline-")
    return f"{shared_dir.rstrip('/')}/pipeline-{uuid.uuid4().hex}"


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    folder = _folder(spark)
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{k}.parquet"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
