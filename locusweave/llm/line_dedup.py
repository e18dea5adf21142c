"""Line dedup over overlapping three-line windows, with DataFrame functions only.

Lines are the ``\\n``-split parts of a text, compared without outer white space. A window is three consecutive
lines that aren't all blank; its key is a 64-bit hash of each of its lines, taken together as 128 bits. Windows are counted over the whole corpus. Of a window
that is found again, the first place by (doc_id, text hash, line) stays; the lines covered by later places are removed, overlapping
places being merged. Texts of under three lines stay as they are.

Null text counts as empty. A null doc_id sorts first. Rows with equal doc_id and text are one place: they
get the same result. An empty table gives an empty result. Other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: White space that is cut off the ends of a line.
BLANK = " \t\r\x0b\x0c"


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _windows(keys: Column, size: int) -> Column:
    """Key of the window that starts at each line; null where all its lines are blank. ``keys`` is a column, or each window would trim all lines anew."""
    starts = F.sequence(F.lit(1), F.size(keys) - (size - 1))

    def key(i: Column) -> Column:
        parts = [F.element_at(keys, i + k) for k in range(size)]
        some = F.concat(*parts) != ""
        return F.when(some, F.struct(F.xxhash64(*parts).alias("a"), F.xxhash64(F.lit("second"), *parts).alias("b")))

    return F.when(F.size(keys) >= size, F.transform(starts, key))


def repeated_windows(docs: DataFrame, window_lines: int = 3) -> DataFrame:
    """Places of repeated windows other than the first: doc_id, th (hash of the text), pos (0-based line)."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.whole_text().alias("text"))
    lines = base.select("doc_id", F.xxhash64("text").alias("th"), _lines(F.col("text")).alias("lines")).where(F.size("lines") >= window_lines)
    trimmed = lines.select("doc_id", "th", F.transform("lines", lambda x: F.trim(x, F.lit(BLANK))).alias("keys"))
    places = trimmed.select("doc_id", "th", F.posexplode(_windows(F.col("keys"), window_lines)).alias("pos", "w")).where("w IS NOT NULL")
    places = places.select("doc_id", "th", "pos", F.col("w.a").alias("a"), F.col("w.b").alias("b"))
    place = F.struct("doc_id", "th", "pos")
    again = places.groupBy("a", "b").agg(F.min(place).alias("first"), F.max(place).alias("last")).where(~F.col("first").eqNullSafe(F.col("last")))
    found = places.join(again.select("a", "b", "first"), ["a", "b"])
    return found.where(~F.struct("doc_id", "th", "pos").eqNullSafe(F.col("first"))).select("doc_id", "th", "pos")


def dedup_lines(docs: DataFrame, window_lines: int = 3) -> DataFrame:
    """One row per input row: doc_id, n_lines, n_removed, removed (merged ranges ``from-to`` of lines, 0-based, inclusive), text."""
    later = repeated_windows(docs, window_lines)
    covered = later.groupBy("doc_id", "th").agg(F.array_sort(F.collect_set("pos")).alias("starts"))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.whole_text().alias("text")).withColumn("th", F.xxhash64("text"))
    other = covered.select(F.col("doc_id").alias("other_id"), F.col("th").alias("other_th"), "starts")
    joined = base.join(other, F.col("doc_id").eqNullSafe(F.col("other_id")) & (F.col("th") == F.col("other_th")), "left")
    lines = _lines(F.col("text"))
    last = window_lines - 1
    # a start opens a range if the one before ends earlier than its line, and closes one if the next starts later
    opens = F.filter("starts", lambda x, i: (i == 0) | (F.get("starts", i - 1) + last < x - 1))
    closes = F.transform(F.filter("starts", lambda x, i: (i == F.size("starts") - 1) | (F.get("starts", i + 1) > x + last + 1)), lambda x: x + last)
    ranges = F.when(F.isnotnull("starts"), F.arrays_zip(opens.alias("lo"), closes.alias("hi")))
    with_ranges = joined.select("doc_id", "text", lines.alias("lines"), F.coalesce(ranges, F.expr("array()").cast("array<struct<lo:int,hi:int>>")).alias("ranges"))
    # between the ranges, whole slices of lines stay
    n = F.size("ranges")
    kept = F.flatten(
        F.transform(
            F.sequence(F.lit(0), n),
            lambda i: F.slice(
                F.col("lines"),
                F.when(i == 0, 1).otherwise(F.get("ranges", i - 1)["hi"] + 2),
                F.when(i == n, F.size("lines")).otherwise(F.get("ranges", i)["lo"]) - F.when(i == 0, 0).otherwise(F.get("ranges", i - 1)["hi"] + 1),
            ),
        )
    )
    removed = F.aggregate("ranges", F.lit(0), lambda acc, r: acc + r["hi"] - r["lo"] + 1)
    return with_ranges.select(
        "doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        removed.cast("long").alias("n_removed"),
        F.array_join(F.transform("ranges", lambda r: F.concat(r["lo"].cast("string"), F.lit("-"), r["hi"].cast("string"))), ",").alias("removed"),
        F.when(n == 0, F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"),
    )


def op6_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(common.table(spark, sf_dir, "documents"))


OP6_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
l AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM d),
e AS (SELECT doc_id, lines, unnest(generate_series(1, len(lines) - 2)) AS i FROM l WHERE len(lines) >= 3),
t AS (SELECT doc_id, i - 1 AS pos, list_transform([lines[i], lines[i + 1], lines[i + 2]],
  lambda x: trim(x, ' ' || chr(9) || chr(11) || chr(12) || chr(13))) AS w FROM e),
p AS (SELECT * FROM t WHERE w <> ['', '', '']),
f AS (SELECT w, min((doc_id, pos)) AS place FROM p GROUP BY w HAVING count(*) > 1),
c AS (SELECT DISTINCT p.doc_id, p.pos + k AS line FROM p JOIN f USING (w), (SELECT unnest([0, 1, 2]) AS k) k WHERE (p.doc_id, p.pos) <> f.place),
g AS (SELECT doc_id, line, line - row_number() OVER (PARTITION BY doc_id ORDER BY line) AS run FROM c),
r AS (SELECT doc_id, min(line) AS lo, max(line) AS hi FROM g GROUP BY doc_id, run),
s AS (SELECT doc_id, string_agg(lo || '-' || hi, ',' ORDER BY lo) AS removed, CAST(sum(hi - lo + 1) AS BIGINT) AS n_removed, list(lo) AS los, list(hi) AS his FROM r GROUP BY doc_id)
SELECT l.doc_id, CAST(len(l.lines) AS BIGINT) AS n_lines, coalesce(s.n_removed, 0) AS n_removed, coalesce(s.removed, '') AS removed,
  CASE WHEN s.doc_id IS NULL THEN l.text ELSE array_to_string(list_filter(l.lines, lambda x, i: len(list_filter(list_zip(s.los, s.his), lambda z: i - 1 BETWEEN z[1] AND z[2])) = 0), chr(10)) END AS text
FROM l LEFT JOIN s USING (doc_id)
"""
