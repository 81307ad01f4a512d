"""The pipeline's stages, one by one, against brute force and on odd rows."""

import corpus_pipeline as P
import pyarrow as pa
from ledgerlens.llm import decontaminate, pii, quality
from ledgerlens.llm.bpe import codec
from ledgerlens.llm.common import table
from ledgerlens.llm.queries import vocabulary
from pyspark.sql import functions as F

from llm_fixtures import SF001, odd  # noqa: F401
from test_llm_operators import brute_components


def test_stages_take_effect(spark, tmp_path):
    docs = table(spark, SF001, "documents")
    columns = docs.columns
    kept = {}
    for k, (name, stage) in enumerate(P.STAGES):
        before = {r.doc_id: r for r in docs.collect()}
        out = stage(spark, docs, SF001)
        if k < len(P.STAGES) - 1:
            assert out.columns == columns
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        kept[name] = (before, {r.doc_id: r for r in docs.collect()})
    before, after = kept["quality classifier"]
    good = {r.doc_id for r in quality.judged(table(spark, SF001, "documents"), table(spark, SF001, "labels")).where("__posterior >= 0.5").collect()}
    assert set(after) == good and 0 < len(after) < len(before)
    before, after = kept["MinHash near-dedup"]
    assert set(after) == {c for _, c in brute_components([(i, r.text) for i, r in before.items()]).values()}
    before, after = kept["benchmark decontamination"]
    index = decontaminate.Index([(r.item_id, r.text) for r in table(spark, SF001, "benchmark").collect()])
    held = {i for i, r in before.items() if any(index.cover(decontaminate.words_of(r.text), k)[0] >= decontaminate.COVER for k in range(len(index.ids)))}
    assert held and set(after) == set(before) - held
    before, after = kept["PII"]
    assert set(after) == set(before) and all(len(after[i].text) == after[i].n_chars for i in after)
    before, after = kept["BPE encoding and decoding"]
    assert set(after) == set(before) and all(len(r.ids) == 4 * r.n_tokens for r in after.values())


def test_stages_keep_odd_columns(spark, odd):
    for _, stage in P.STAGES[:-1]:
        out = stage(spark, odd, SF001)
        assert out.columns == odd.columns
        assert out.where(F.col("doc_id") == 4).count() == 1
        assert stage(spark, odd.limit(0), SF001).count() == 0


def test_stages_send_python_small_batches(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    docs = spark.createDataFrame([(1, "some text of five words and more", "a")], "doc_id long, text string, source string")
    wide = spark.range(0, 20_000, 1, 1).select(F.repeat(F.lit("x"), 2000).alias("text"))

    def rows(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows])], names=["n"])

    try:
        for name, stage in P.STAGES:
            spark.conf.unset(key)
            stage(spark, docs, SF001).count()
            if name != "PII":
                assert wide.mapInArrow(rows, "n long").agg(F.max("n")).first()[0] <= 3000, name
        spark.conf.set(key, "1m")
        P.bpe_encoding(spark, docs, SF001)
        assert spark.conf.get(key) == "1m"          # the user's own value stays
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def test_encoder_forgets_at_the_end_of_a_task(spark):
    """Workers go on to other tasks: what an encoder remembers doesn't stay in them."""
    path = vocabulary()
    words = spark.range(0, 400, 1, 8).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("word"), F.hex("id"), F.lit("text")).alias("text"))
    assert P.bpe_encoding(spark, words, SF001).where("n_tokens > 0").count() == 400

    def held(batches):
        for _ in batches:
            pass
        yield pa.RecordBatch.from_arrays([pa.array([len(codec(path).known)])], names=["n"])

    assert spark.range(0, 8, 1, 8).mapInArrow(held, "n long").agg(F.sum("n")).first()[0] == 0


def test_near_dedup_keeps_one_row_of_a_component(spark):
    """Exact repeats under one id are removed; an unrelated text that shares an id with a copy is not lost."""
    text = lambda k: " ".join(f"w{k}x{j}" for j in range(40))
    rows = [(900003, text(1), "a"), (900005, text(1).replace("w1x39", "other"), "b"), (900005, text(2), "c"),
            (900006, text(3), "d"), (900006, text(3), "d"), (900007, "", "e"), (900007, "", "e"), (None, text(1), "f"),
            (900008, text(4), "g"), (900008, text(4).replace("w4x0 ", "new "), "h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = P.near_dedup(spark, docs, SF001)
    got = sorted(out.select("source").toPandas()["source"])
    assert out.columns == docs.columns
    assert got in (["a", "c", "d", "e", "e", "f", x] for x in "gh")
