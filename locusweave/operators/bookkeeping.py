"""Which samples and files are done, pending or absent; merging of retried results."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from locusweave.functions import sites as s
from locusweave.sources.shared import stored


def pending(key: DataFrame, done: DataFrame, *on: str) -> DataFrame:
    """Key rows that aren't done yet."""
    return key.join(done.select(*on).distinct(), list(on), "left_anti")


def batches(rows: DataFrame, size: int, group: str, order: str) -> DataFrame:
    """Batch numbers of at most ``size`` rows within each group, by order.

    Rows are dealt in ranges of group and order and written, then numbered within each range; what the ranges before hold is added. So a group may be of any size.
    """
    ranged = stored(rows.repartitionByRange(group, order).withColumn("__part", F.spark_partition_id()), "batches")
    held = ranged.groupBy(group, "__part").agg(F.count(F.lit(1)).alias("__held"))
    before = held.withColumn("__before", F.coalesce(F.sum("__held").over(Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    n = F.row_number().over(Window.partitionBy(group, "__part").orderBy(order)) + F.col("__before")
    return ranged.join(before.select(group, "__part", "__before"), [group, "__part"]).withColumn("batch", F.floor((n - 1) / size).cast("int")).select(*rows.columns, "batch")


def progress(key: DataFrame, done: DataFrame, group: str, on: str) -> DataFrame:
    """By group: all, done and pending ids."""
    yes = done.select(on).distinct().withColumn("__yes", F.lit(True))
    return key.join(yes, on, "left").groupBy(group).agg(F.countDistinct(on).alias("all"), F.countDistinct(F.when(F.col("__yes"), F.col(on))).alias("done"), F.countDistinct(F.when(F.isnull("__yes"), F.col(on))).alias("pending"))


def missing_outputs(expected: DataFrame, listing: DataFrame, group: str, on: str) -> DataFrame:
    """Expected outputs that are absent, a row each, in no list: group, id, and how many its group misses."""
    gone = expected.select(group, on).distinct().join(listing.select(on).distinct(), on, "left_anti")
    n = gone.groupBy(group).agg(F.count(F.lit(1)).alias("n_missing"))
    return gone.join(n, group).select(group, on, "n_missing")


def retry_merge(old: DataFrame, new: DataFrame, keys: list[str], value: str = "dosage") -> DataFrame:
    """Old results with new ones preferred where they aren't null; one row per key, whatever the inputs repeat (the largest value counts)."""
    one = lambda df, name: df.groupBy(*keys).agg(F.max(value).alias(name))
    return one(old, "__old").join(one(new, "__new"), keys, "full").select(*keys, F.coalesce("__new", "__old").alias(value))


def still_failing(old: DataFrame, new: DataFrame, keys: list[str], value: str = "dosage") -> DataFrame:
    """Keys that have a value in neither result: what the next retry has to do."""
    return retry_merge(old, new, keys, value).where(F.isnull(value)).select(*keys)


def outcomes(log: DataFrame, *by: str) -> DataFrame:
    """Files by data type (and ``by``) and state; ``log``: data_type, file, state (ok, empty, failed, absent)."""
    n = lambda state: s.count_if(F.col("state") == state)
    return log.groupBy(*by, "data_type").agg(F.count(F.lit(1)).alias("planned"), n("ok").alias("successful"), n("empty").alias("empty"), n("failed").alias("failed"), n("absent").alias("absent"))
