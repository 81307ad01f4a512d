"""Spark session settings used by the library, the tests and the bench.

The library itself never creates a cluster session: query functions take the
caller's ``SparkSession``. ``local_session`` is for tests and ``bench.py``.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every query relies on (semantics, not tuning): UTC wall clock so
# timestamp_ntz arithmetic matches the oracle, ANSI on (Spark 4 default).
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Runtime re-planning: coalesce small shuffle partitions, split skewed join
# partitions, and turn a shuffle join into a broadcast join only when the
# measured (not estimated) size of one side is below the threshold.
ADAPTIVE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
}

def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "ledgerlens", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench. UI off, no ports beyond Spark's own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in {**SEMANTIC_CONF, **ADAPTIVE_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_semantics(spark: SparkSession) -> None:
    """Pin the settings whose values change query results, on a session of one's own
    (the command line's); the reports themselves never change the caller's settings."""
    for k, v in SEMANTIC_CONF.items():
        spark.conf.set(k, v)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared (distributed) folder and is used
    as given. Only a ``local[..]`` master, as in tests, may run without it (a scratch folder).
    """
    try:
        sc = spark.sparkContext
    except Exception:   # Spark Connect: the server's spark.checkpoint.dir applies
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="ledgerlens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(current)
    return current


def pin(df):
    """Write ``df`` once into the shared checkpoint folder and return a
    DataFrame reading it: later jobs reuse it instead of recomputing the
    lineage, and a lost executor costs a re-read, not a recomputation."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
