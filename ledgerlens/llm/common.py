"""What the operators share: table readers, the shared folder, a way to send this package to executors."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

_SHIPPED = "_ledgerlens_shipped"
_ARROW_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
ARROW_BYTES = "4m"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, through Spark's reader (any store Spark knows)."""
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Make this package importable in the executors' Python, once per context.

    The zip is Spark's to distribute (``addPyFile``), as ``--py-files`` would do.
    """
    sc = spark.sparkContext
    if getattr(sc, _SHIPPED, False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = os.path.join(tempfile.mkdtemp(prefix="ledgerlens-"), "ledgerlens_code.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(package):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(out)
    setattr(sc, _SHIPPED, True)


def small_batches(spark: SparkSession) -> None:
    """The session sends Python about ``ARROW_BYTES`` of rows at a time, unless it was set otherwise.

    Spark's default, 10,000 rows of up to 64 MB, is held several times over for each running task:
    as Arrow vectors and a send buffer beside the heap, and as the batch in the Python worker.
    """
    if spark.conf.get(_ARROW_LIMIT, None) is None:
        spark.conf.set(_ARROW_LIMIT, ARROW_BYTES)


def shared(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder in ``spark.checkpoint.dir`` and read from there.

    A lost executor then costs a read, not the lineage. Only a ``local[..]`` master, as in
    tests, may run without the setting; it gets a scratch folder.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    folder = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="ledgerlens-shared-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """``df`` as Parquet in the shared folder, read from there: as ``shared``, but compressed and with
    only the columns a later step selects being read. Order and partitions may change."""
    spark = df.sparkSession
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="ledgerlens-shared-")
        sc.setCheckpointDir(folder)
    path = f"{folder.rstrip('/')}/written-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def parts(batch: pa.RecordBatch, column: int = 1, limit: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """``batch`` in consecutive parts of about ``limit`` bytes of text, or one longer text, so that
    what a task makes of the texts is held for a part and not for the batch."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = size[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(size, before + limit, "right")))
        yield batch.slice(at, to - at)
        at = to


def give_back() -> None:
    """At the end of a task: unused memory goes back to the machine, since Python workers go on
    to other tasks and lie idle between them."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)     # where the C library has it
    if trim:
        trim(0)


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it while ``df`` has a column of that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def hash_share(rows: int, total: int, *keys: str) -> Column:
    """A condition that holds for about ``rows`` of ``total`` rows, chosen by a hash of ``keys``
    (for every row if there are no more): a bounded sample that no executor loss changes."""
    if total <= rows:
        return F.lit(True)
    grain = 1 << 30
    return F.pmod(F.xxhash64(F.lit("sample"), *keys), F.lit(grain)) < F.lit(int(grain * rows / total))
