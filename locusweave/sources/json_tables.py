"""JSON reports of any layout: all key paths, and every top-level value that is a table as long cells and as a CSV file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusweave.sources.shared import stored

#: Nesting at which a report is taken to be broken.
MAX_DEPTH = 100


def documents(spark: SparkSession, path: str) -> DataFrame:
    """The documents of a folder, one text a file."""
    return spark.read.text(path, wholetext=True).select(F.col("value").alias("json"))


def _children(rows: DataFrame, *keep: str) -> DataFrame:
    """Members of each value (column json): at (place), key (null in a list) and json; values that are neither list nor object have none."""
    parsed = rows.select(*keep, F.parse_json("json").alias("__v"))
    spark = rows.sparkSession
    exploded = parsed.lateralJoin(spark.tvf.variant_explode(F.col("__v").outer()))
    return exploded.select(*keep, F.col("pos").alias("at"), "key", F.to_json("value").alias("json"))


def kind(json: str) -> F.Column:
    """object, array, string, number, boolean or null, by a JSON text's first letter."""
    first = F.substring(json, 1, 1)
    return F.when(first == "{", "object").when(first == "[", "array").when(first == '"', "string").when(first.isin("t", "f"), "boolean").when(first == "n", "null").otherwise("number")


def key_paths(docs: DataFrame) -> DataFrame:
    """path, kind and depth of every key of the documents, each occurrence a row: ``a.b`` for the key b of an object, ``a[0].b`` within a list.

    One step goes one level down for all paths at once, so there are as many steps as levels.
    """
    level = stored(docs.select(F.lit("").alias("path"), "json"), "json-level")
    out = None
    for depth in range(1, MAX_DEPTH):
        below = _children(level, "path")
        name = F.when(F.isnull("key"), F.concat("path", F.lit("["), F.col("at").cast("string"), F.lit("]"))).when(F.col("path") == "", F.col("key")).otherwise(F.concat("path", F.lit("."), "key"))
        level = stored(below.select(name.alias("path"), "json", F.isnotnull("key").alias("__key")), "json-level")
        if not level.head(1):
            break
        one = level.where("__key").select("path", kind("json").alias("kind"), F.lit(depth).alias("depth"))
        out = one if out is None else out.unionByName(one)
        level = level.select("path", "json")
    else:
        raise ValueError(f"more than {MAX_DEPTH} levels")
    return docs.sparkSession.createDataFrame([], "path string, kind string, depth int") if out is None else out


def cells(docs: DataFrame) -> DataFrame:
    """name, row, column and value (as text, null for null) of every table among the top-level values.

    A table is a list of rows, an object of columns that are objects (row name to value) or lists, or a list of single values (column ``0``). Other values are skipped.
    """
    top = _children(docs).where("key IS NOT NULL").select(F.col("key").alias("name"), kind("json").alias("of"), "json")
    first = _children(top, "name", "of").select("name", "of", F.col("at").alias("at1"), F.col("key").alias("key1"), kind("json").alias("of1"), "json")
    first = stored(first, "json-members")
    plain = first.where("of = 'array' AND of1 NOT IN ('object', 'array')").select("name", F.col("at1").cast("string").alias("row"), F.lit("0").alias("column"), "json")
    second = _children(first.where("of1 IN ('object', 'array')"), "name", "of", "at1", "key1", "of1")
    member = F.coalesce("key", F.col("at").cast("string"))
    nested = second.select("name", F.when(F.col("of") == "array", F.col("at1").cast("string")).otherwise(member).alias("row"), F.when(F.col("of") == "array", member).otherwise(F.col("key1")).alias("column"), "json")
    text = F.when(kind("json") == "null", None).when(kind("json") == "string", F.try_variant_get(F.parse_json("json"), "$", "string")).otherwise(F.col("json"))
    return plain.unionByName(nested).select("name", "row", "column", text.alias("value"))


def write_tables(docs: DataFrame, folder: str) -> dict[str, tuple[str, list[str]]]:
    """One CSV for each table, without the names of its rows; its folder and columns by name. The names of tables and columns come to the driver: they are the report's own layout."""
    found = stored(cells(docs), "json-cells")
    names = [(r[0], r[1]) for r in found.select("name", "column").distinct().orderBy("name", "column").collect()]
    out: dict[str, tuple[str, list[str]]] = {}
    for name in dict.fromkeys(n for n, _ in names):
        columns = [c for n, c in names if n == name]
        wide = found.where(F.col("name") == name).groupBy("row").pivot("column", columns).agg(F.first("value"))
        path = f"{folder}/{name}.csv"
        wide.orderBy(F.expr("try_cast(row AS BIGINT)"), "row").select(*(F.col(f"`{c}`") for c in columns)).write.mode("overwrite").option("header", True).csv(path)
        out[name] = (path, columns)
    return out
