"""Files that arrive over time: process what is new and keep the results in a store of versions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def upsert(store: str, keys: list[str], value: str = "dosage") -> Callable[[DataFrame, int], None]:
    """A batch function that adds each batch to a Parquet store as a version of its own, so a batch costs what it holds and not what the store holds.

    A version has one row per key. A batch that is run again after a failure writes the same version anew, and readers only see finished ones.
    """

    def add(batch: DataFrame, number: int) -> None:
        write_version(batch.groupBy(*keys).agg(F.max(value).alias(value)), store, number)

    return add


def write_version(rows: DataFrame, store: str, number: int) -> None:
    """One version of the store. It counts once it is entered among the finished ones, which comes last."""
    rows.write.mode("overwrite").parquet(f"{store}/version={number}")
    rows.sparkSession.range(1).select(F.lit(number).alias("version")).write.mode("overwrite").json(f"{store}/finished/{number}")


def versions(spark: SparkSession, store: str) -> list[int]:
    """Numbers of the finished versions."""
    try:
        done = spark.read.schema("version int").option("recursiveFileLookup", True).json(f"{store}/finished").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted({r.version for r in done})


def latest(spark: SparkSession, store: str, keys: list[str], value: str = "dosage") -> DataFrame | None:
    """The merged store: by key the newest value that isn't null. None if there is no version."""
    found = versions(spark, store)
    if not found:
        return None
    rows = spark.read.option("basePath", store).parquet(*(f"{store}/version={n}" for n in found))
    return rows.groupBy(*keys).agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.col("version"))).alias(value))


def compact(spark: SparkSession, store: str, new_store: str, keys: list[str], value: str = "dosage") -> None:
    """A new store whose one version holds what the old one's versions come to; the old one may be removed after that."""
    found = versions(spark, store)
    if found:
        write_version(latest(spark, store, keys, value), new_store, found[-1])


def follow(spark: SparkSession, folder: str, schema: str, store: str, checkpoint: str, keys: list[str], process: Callable[[DataFrame], DataFrame] = lambda df: df) -> StreamingQuery:
    """Process all files of a folder that haven't been yet, and stop."""
    files = spark.readStream.schema(schema).parquet(folder)
    return process(files).writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(upsert(store, keys)).start()


def settled(spark: SparkSession, store: str, new_store: str, keys: list[str], most: int = 20, value: str = "dosage") -> str:
    """The store to go on with: the same one while it has ``most`` versions at most, else a new one whose one version is what they come to. Later batches have higher numbers than it."""
    if len(versions(spark, store)) <= most:
        return store
    compact(spark, store, new_store, keys, value)
    return new_store
