"""Stages of a run kept in a folder, so that a later run reads what is there instead of computing it."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusweave.sources import bucketed

MANIFEST = "stage string, key string, path string, n_rows long"


def fingerprint(df: DataFrame) -> str:
    """A text that changes with what a table is made of: its columns, its optimized plan, and path, time and size of the files below it. No row is read."""
    parts = [df.schema.json(), df._jdf.queryExecution().optimizedPlan().canonicalized().toString()]
    files = df.inputFiles()
    if files:
        listed = df.sparkSession.read.format("binaryFile").load(files).select(F.xxhash64("path", "modificationTime", "length").cast("decimal(38,0)").alias("h"))
        parts.append(str(listed.agg(F.count(F.lit(1)), F.sum("h")).first()[:]))
    return digest(*parts)


def digest(*parts: object) -> str:
    return hashlib.sha256("\n".join(map(str, parts)).encode()).hexdigest()


class StageStore:
    """Stored stages below ``folder``: a table each, and a manifest with the key of what it was made of.

    A stage enters the manifest after its table is whole, so a run that broke off is taken up at the stage it was in. ``ran`` tells what this run did.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder, self.ran = spark, folder.rstrip("/"), []
        try:
            rows = spark.read.schema(MANIFEST).json(f"{self.folder}/manifest").collect()  # a row a stage and run
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = []
        self.known = {(r.stage, r.key): r.path for r in rows}

    def get(self, stage: str, key: str, build: Callable[[], DataFrame], *partitions: str, dealt: str | None = None) -> DataFrame:
        """The table of a stage under its key: read if the manifest has it, else built and written. ``dealt``: the column by which its rows are dealt and stay so, in buckets."""
        path = self.known.get((stage, key))
        self.ran.append((stage, "computed" if path is None else "read"))
        if path is None:
            path = f"{self.folder}/{stage}-{key[:24]}"
            if dealt:
                bucketed.keep(build(), path, dealt, *partitions)
            else:
                writer = build().write.mode("overwrite").option("compression", "zstd")
                (writer.partitionBy(*partitions) if partitions else writer).parquet(path)
            n = self.spark.read.parquet(path).count()
            self.spark.createDataFrame([(stage, key, path, n)], MANIFEST).coalesce(1).write.mode("append").json(f"{self.folder}/manifest")
            self.known[stage, key] = path
        return bucketed.kept(self.spark, path) if dealt else self.spark.read.parquet(path)

    def manifest(self) -> DataFrame:
        return self.spark.read.schema(MANIFEST).json(f"{self.folder}/manifest")
