"""A folder that the driver and all executors see."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below ``spark.checkpoint.dir`` that isn't used yet; without that setting, in local mode, below a temporary folder of this machine."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="spark-shared-")
        spark.sparkContext.setCheckpointDir(found)
    return f"{found.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, *partitions: str) -> DataFrame:
    """``df`` written as Parquet into the shared folder and read again, so that what is built on it doesn't compute it anew."""
    path = new_folder(df.sparkSession, name)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*partitions) if partitions else writer).parquet(path)
    return df.sparkSession.read.parquet(path)


def write_file(lines: DataFrame, path: str, codec: str = "none") -> None:
    """A text file of one given name, from lines that belong into one file (column value), in their order."""
    parts = new_folder(lines.sparkSession, "parts")
    lines.coalesce(1).write.option("compression", codec).text(parts)
    jvm = lines.sparkSession.sparkContext._jvm
    source, target = (jvm.org.apache.hadoop.fs.Path(p) for p in (parts, path))
    fs = source.getFileSystem(lines.sparkSession.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(target.getParent())
    part = next(f.getPath() for f in fs.listStatus(source) if f.getPath().getName().startswith("part-"))
    if not fs.rename(part, target):
        raise OSError(f"{path} can't be written")
