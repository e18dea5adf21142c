"""Deliveries of planned files: what came, what is empty, unreadable or absent, and the retry of what failed.

A file is a folder or file right below the inbox, known by its name. The log has one row per planned file and attempt, from what the scan of the attempt saw.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusweave.sources.shared import stored
from locusweave.streaming.incremental import write_version

MAGIC = b"PAR1"


def _name(path: str, inbox: str) -> F.Column:
    """First part of a path below the inbox."""
    root = inbox.rstrip("/").rsplit("/", 1)[-1]
    return F.regexp_extract(F.url_decode(path), rf"/\Q{root}\E/([^/]+)", 1)


def tolerant(spark: SparkSession, inbox: str, schema: str, names: list[str] | None = None) -> DataFrame:
    """Rows of the inbox (or of the files ``names`` alone) with the name of their file; unreadable files give none."""
    reader = spark.read.schema(schema).options(ignoreCorruptFiles=True, recursiveFileLookup=True)
    return reader.parquet(*([inbox] if names is None else [f"{inbox}/{n}" for n in names])).withColumn("file", _name("_metadata.file_path", inbox))


def states(spark: SparkSession, planned: DataFrame, inbox: str, schema: str) -> DataFrame:
    """Planned files with n_rows and state: ``ok``, ``empty`` (readable, no row), ``failed`` (unreadable) or ``absent``.

    One pass counts rows by file. Only of files that gave no row are the contents looked at: one that doesn't begin and end as Parquet does is unreadable. Their names come to the driver,
    as they are what is to be read.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(inbox).select("path", _name("path", inbox).alias("file"))
    value = schema.split(",")[-1].split()[0]
    counts = tolerant(spark, inbox, schema).groupBy("file").agg(F.count(F.lit(1)).alias("n_rows"), F.count(value).alias("__read"))
    seen = stored(listed.join(counts.select("file", "n_rows"), "file", "left"), "listed")
    quiet = [r[0] for r in seen.where("n_rows IS NULL").join(planned.select("file"), "file", "left_semi").select("path").distinct().collect()]
    present = seen.groupBy("file").agg(F.coalesce(F.max("n_rows"), F.lit(0)).alias("n_rows"))
    if quiet:
        bytes_ = spark.read.format("binaryFile").load([p.replace(" ", "%20") for p in quiet]).select(_name("path", inbox).alias("file"), "content")
        broken = (F.length("content") < 12) | (F.substring("content", 1, 4) != F.lit(MAGIC)) | (F.substring("content", -4, 4) != F.lit(MAGIC))
        bad = bytes_.groupBy("file").agg(F.bool_or(broken).alias("broken"))
        present = present.join(bad, "file", "left")
    else:
        present = present.withColumn("broken", F.lit(False))
    state = F.when(F.isnull("n_rows"), "absent").when(F.col("n_rows") > 0, "ok").when(F.coalesce("broken", F.lit(False)), "failed").otherwise("empty")
    return planned.join(present, "file", "left").select(*planned.columns, F.coalesce("n_rows", F.lit(0)).alias("n_rows"), state.alias("state"))


def attempt(spark: SparkSession, planned: DataFrame, inbox: str, schema: str, store: str, number: int) -> DataFrame:
    """Read the planned files, write the rows of those that are in order as version ``number`` of the store, and give back the log of the attempt, stored."""
    log = stored(states(spark, planned, inbox, schema).withColumn("attempt", F.lit(number)), "log")
    names = [r[0] for r in log.where("state = 'ok'").select("file").collect()]
    if names:
        write_version(tolerant(spark, inbox, schema, sorted(names)).drop("file"), store, number)
    return log


def retry(spark: SparkSession, log: DataFrame, inbox: str, schema: str, store: str, number: int) -> DataFrame:
    """Another attempt at the files that weren't in order; no other is read. What still isn't is in the log that comes back."""
    again = log.where("state <> 'ok'").drop("n_rows", "state", "attempt")
    return attempt(spark, again, inbox, schema, store, number)
