"""Exports of several files from one stored table, with a manifest of their names and rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "name string, format string, path string, n_rows long"
READERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "csv": lambda spark, path: spark.read.option("header", True).csv(path),
    "tsv": lambda spark, path: spark.read.option("sep", "\t").csv(path),
    "json": lambda spark, path: spark.read.json(path),
    "parquet": lambda spark, path: spark.read.parquet(path),
}


class Export:
    """Files below a folder, each entered in the manifest with the rows that were written, as an observation of the write itself."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder, self.entries = spark, folder, []

    def add(self, name: str, df: DataFrame, kind: str = "csv", *partitions: str, codec: str | None = None) -> str:
        """Write ``df`` as ``name`` and give its path back. ``tsv`` has no header. ``codec`` packs the files; without one it is the format's own."""
        from pyspark.sql import Observation

        path, seen = f"{self.folder}/{name}", Observation(f"rows of {name} {len(self.entries)}")
        writer = df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite")
        writer = writer.partitionBy(*partitions) if partitions else writer
        writer = writer.option("compression", codec) if codec else writer
        if kind in ("csv", "tsv"):
            writer.option("header", kind == "csv").option("sep", "," if kind == "csv" else "\t").csv(path)
        else:
            writer.format(kind).save(path)
        self.entries.append((name, kind, path, int(seen.get["n"])))
        return path

    def manifest(self) -> DataFrame:
        """The manifest, written beside the files."""
        rows = self.spark.createDataFrame(self.entries, MANIFEST)
        rows.coalesce(1).write.mode("overwrite").json(f"{self.folder}/manifest")
        return rows

    def read_back(self) -> DataFrame:
        """name, format, n_rows as the manifest in the folder has it, and n_read, the rows that the files hold."""
        listed = self.spark.read.schema(MANIFEST).json(f"{self.folder}/manifest")
        out = None
        for name, kind, path, _ in self.entries:
            one = READERS[kind](self.spark, path).agg(F.count(F.lit(1)).alias("n_read")).select(F.lit(name).alias("name"), "n_read")
            out = one if out is None else out.unionByName(one)
        return listed.join(out, "name").select("name", "format", "n_rows", "n_read")
