"""Shards of regions gathered into files whose names are in genomic order, with a manifest of what each region came to."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusweave.functions import sites as s
from locusweave.sources.shared import stored


def shard_states(shards: DataFrame, regions: DataFrame) -> DataFrame:
    """region, n_rows, n_bad and state of each region: ``ok``, ``empty`` or ``failed`` (a line that is no record of the region).

    ``shards``: region, chromosome, position, value (the line); ``regions``: region, chromosome, start, end.
    """
    own = regions.select("region", F.col("chromosome").alias("__c"), "start", "end")
    fits = F.coalesce((F.col("chromosome") == F.col("__c")) & F.col("position").between(F.col("start"), F.col("end")), F.lit(False))
    found = shards.join(own, "region").groupBy("region").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(~fits).alias("n_bad"))
    state = F.when(F.isnull("n_rows"), "empty").when(F.col("n_bad") > 0, "failed").otherwise("ok")
    return regions.join(found, "region", "left").select("region", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.coalesce("n_bad", F.lit(0)).alias("n_bad"), state.alias("state"))


def ordered_gather(shards: DataFrame, regions: DataFrame, path: str) -> DataFrame:
    """Write the lines of all regions that are in order; give the manifest back. A failed region is reported there, and the others are gathered all the same.

    Tasks take ranges of the genomic order and files are numbered by range, so reading files by name gives the order.
    """
    manifest = stored(shard_states(shards, regions), "manifest")
    good = shards.join(manifest.where("state = 'ok'").select("region"), "region", "left_semi")
    good.orderBy(s.chromosome_rank("chromosome"), "position", "value").select("value").write.mode("overwrite").text(path)
    return manifest


def order_breaks(spark: SparkSession, path: str, key: F.Column) -> DataFrame:
    """file, n_lines, first, last and n_breaks of each file by name: lines whose key is less than the one before it in its file, or for the first one than the last of the file before.

    A file's lines are taken in the order in which one task reads it; files are small enough to be read whole by a task, or are split at line ends in order of their parts.
    """
    from pyspark.sql import Window

    lines = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    lines = lines.select("file", "block", "at", key.alias("key"))
    inside = lines.withColumn("before", F.lag("key").over(Window.partitionBy("file").orderBy("block", "at")))
    files = inside.groupBy("file").agg(F.count(F.lit(1)).alias("n_lines"), F.min_by("key", F.struct("block", "at")).alias("first"), F.max_by("key", F.struct("block", "at")).alias("last"), F.count_if(F.coalesce(F.col("key") < F.col("before"), F.lit(False))).alias("n_breaks"))
    met = F.lag("last").over(Window.orderBy("file"))
    return files.withColumn("n_breaks", F.col("n_breaks") + F.when(met > F.col("first"), 1).otherwise(0))
