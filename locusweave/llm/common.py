"""Helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Python turns an Arrow batch into strings in slices of this many code units of text, so that a batch of long texts stays small.
SLICE_CHARS = 1 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see.

    It is read from ``spark.checkpoint.dir``. Only where the session has none (local tests) a folder of
    this machine is taken, which is right there because driver and executors are one process.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="spark-shared-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it again, which cuts the lineage."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


@contextmanager
def cleaned(spark: SparkSession) -> Iterator[None]:
    """Within, Spark removes a job's shuffle files when the job ends. Else they stay until the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder, for small tables inside loops."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Bytes of an Arrow batch that goes to a Python worker.
BATCH_BYTES = 8 << 20


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, after bounding its session's Arrow batches by bytes, so that long texts don't make large batches. A smaller bound stays."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    now = conf.get(key, None) or ""
    if not (now.isdigit() and 0 < int(now) <= BATCH_BYTES):
        conf.set(key, str(BATCH_BYTES))
    return df


def whole_text(column: str | Column = "text") -> Column:
    """The text, null taken as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """True where crc32 of the id's decimal text leaves 1 when divided by 3; a null id counts as held out."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 3 == 1, F.lit(True))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batch: pa.RecordBatch, text: str = "text") -> Iterator[pa.RecordBatch]:
    """Parts of a batch that hold at most ``SLICE_CHARS`` of text, or one row."""
    sizes = [n or 0 for n in pc.binary_length(batch.column(text)).to_pylist()]
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > SLICE_CHARS:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield batch.slice(start)
