"""Tables stored in buckets of a key, so that later joins and aggregates on it need no exchange."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locusweave.sources.shared import new_folder


def store(df: DataFrame, name: str, buckets: int, *keys: str) -> DataFrame:
    """``df`` as a table of ``buckets`` files, each sorted by the keys: it is shuffled once, here. Tables of one number of buckets are co-partitioned."""
    table = f"{name}_{uuid.uuid4().hex}"
    path = new_folder(df.sparkSession, name)
    df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


def keep(df: DataFrame, path: str, key: str, *partitions: str) -> DataFrame:
    """``df``, whose rows are dealt by ``key`` already, as a table in buckets of it below ``path``, as many as Spark's shuffles have partitions: what is built on it by this key needs no exchange."""
    spark = df.sparkSession
    writer = df.write.mode("overwrite").format("parquet").option("compression", "zstd").bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), key)
    (writer.partitionBy(*partitions) if partitions else writer).option("path", path).saveAsTable(table_of(path))
    return spark.table(table_of(path))


def table_of(path: str) -> str:
    """The name in the catalog of the table that is kept below a path."""
    return f"kept_{hashlib.sha256(path.encode()).hexdigest()[:32]}"


def kept(spark: SparkSession, path: str) -> DataFrame:
    """The table below ``path``; where this session's catalog doesn't know it, its files, whose rows later steps then deal anew."""
    return spark.table(table_of(path)) if spark.catalog.tableExists(table_of(path)) else spark.read.parquet(path)


def outer_merge(rows: DataFrame, key: str, part: str, parts: list[str], value: Column) -> DataFrame:
    """The tables of all ``parts`` side by side by ``key``: a column of each part, null where it lacks the key.

    What a chain of full joins would give, in one aggregate: over a table in buckets of the key it needs no exchange, and no part is a task.
    """
    return rows.groupBy(key).agg(*(F.sum(F.when(F.col(part) == p, value)).alias(f"{part}_{p}") for p in parts))
