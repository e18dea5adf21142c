"""Exact dedup through an extendible-hash index on shared files.

1. Every map task chains equal texts locally (hash, then bytes), so a text that a third of all rows share
   leaves a task as one entry.
2. The directory starts with one bucket. A bucket with more text bytes than ``bucket_bytes`` is split by its
   next hash bit; when its local depth equals the global depth the directory doubles. It is made from
   a histogram over hash prefixes, which are a few bits longer than the directory of a table of this size has to be; so its
   size follows the number of buckets, and so does the histogram's. A bucket still overfull at that depth (long texts of one hash) keeps an overflow
   chain. By default buckets are sized for the cores at hand, between 1 and 64 MB.
3. Buckets are numbered by hash key, and each owner task gets a contiguous range of buckets, so of keys. It reads the entries in hash order, keeps a chain
   of the different texts of one hash only, and compares bytes. What it decides goes to index files in the shared folder.
4. Rows look up the index by hash and digest. Their texts don't move in this step.

Null ids lose against any id; if all ids of a group are null one row of them stays. Null text counts as
empty text. Of rows with equal id and text the first by all columns (as JSON) stays. An empty table gives an empty result. ``dedup`` reads no other
columns; ``keep_one`` keeps all columns, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

ENTRY = "bucket int, h long, text string, keep_id long, n long, n_keep long"
INDEX = "bucket int, h long, slot int, text_sha256 string, keep_id long, group_size long, n_keep long"
#: Text bytes that a map task gathers before it passes its entries on.
FLUSH_BYTES = 16 << 20
#: Bits of the histogram's prefixes before they are cut to the directory's depth; owner tasks at most.
PREFIX_BITS, OWNERS = 24, 50_000


def _later(a: int | None, b: int | None) -> int | None:
    return b if a is None else a if b is None else max(a, b)


def _chain(chain: list[list], text: str, keep: int | None, n: int, n_keep: int) -> bool:
    """Add to the entry of equal bytes in the chain, or append one; True if it was appended."""
    for entry in chain:
        if entry[0] == text:
            if entry[1] == keep:
                entry[3] += n_keep
            elif _later(entry[1], keep) == keep:
                entry[1], entry[3] = keep, n_keep
            entry[2] += n
            return False
    chain.append([text, keep, n, n_keep])
    return True


def _combine(batches: Iterator[pa.RecordBatch], directory: np.ndarray) -> Iterator[pa.RecordBatch]:
    depth = len(directory).bit_length() - 1
    chains: dict[int, list[list]] = {}
    held = 0

    def flush() -> pa.RecordBatch:
        rows = [(int(directory[(h & (1 << 64) - 1) >> 64 - depth]), h, *entry) for h, chain in chains.items() for entry in chain]
        kinds = (pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=["bucket", "h", "text", "keep_id", "n", "n_keep"])

    for batch in batches:
        for part in common.slices(batch):
            for h, text, doc_id in zip(part.column("h").to_pylist(), part.column("text").to_pylist(), part.column("doc_id").to_pylist()):
                if _chain(chains.setdefault(h, []), text, doc_id, 1, 1):
                    held += len(text) + 64
            if held > FLUSH_BYTES:
                yield flush()
                chains.clear()
                held = 0
    if chains:
        yield flush()


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries in hash order to decided slots; only the chain of the current hash is held."""
    out: list[tuple] = []
    chain: list[list] = []
    at: tuple | None = None

    def close() -> None:
        for slot, (text, keep, n, n_keep) in enumerate(chain):
            out.append((*at, slot, hashlib.sha256(text.encode()).hexdigest(), keep, n, n_keep))

    def flush() -> pa.RecordBatch:
        kinds = (pa.int32(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64())
        names = ["bucket", "h", "slot", "text_sha256", "keep_id", "group_size", "n_keep"]
        batch = pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)], names=names)
        out.clear()
        return batch

    for batch in batches:
        for part in common.slices(batch):
            for bucket, h, text, keep, n, n_keep in zip(*(part.column(c).to_pylist() for c in ("bucket", "h", "text", "keep_id", "n", "n_keep"))):
                if at != (bucket, h):
                    close()
                    chain, at = [], (bucket, h)
                _chain(chain, text, keep, n, n_keep)
        if len(out) >= 10_000:
            yield flush()
    close()
    if out:
        yield flush()


def grow_directory(sizes: np.ndarray, bucket_bytes: int) -> np.ndarray:
    """The bucket of each hash prefix, after splitting every bucket that holds more than ``bucket_bytes``; ``sizes``: bytes of each prefix.

    Buckets are numbered by the keys they hold.
    """
    max_depth = len(sizes).bit_length() - 1
    upto = np.concatenate(([0], np.cumsum(sizes)))
    directory, depth, buckets = np.zeros(1, np.int32), 0, [(0, 0)]  # of each bucket: local depth, leading bits
    full = [0]
    while full:
        bucket = full.pop()
        local, bits = buckets[bucket]
        width = 1 << (max_depth - local)
        if local == max_depth or upto[(bits + 1) * width] - upto[bits * width] <= bucket_bytes:
            continue
        if local == depth:  # doubling: each entry becomes two that point to the same bucket
            directory, depth = np.repeat(directory, 2), depth + 1
        new = len(buckets)
        buckets[bucket] = (local + 1, bits * 2)
        buckets.append((local + 1, bits * 2 + 1))
        half = 1 << (depth - local - 1)
        first = bits * 2 * half
        directory[first + half : first + 2 * half] = new
        full += [bucket, new]
    starts = np.concatenate(([True], directory[1:] != directory[:-1]))
    return np.repeat(np.cumsum(starts) - 1, 1 << (max_depth - depth)).astype(np.int32)


def build_index(docs: DataFrame, bucket_bytes: int | None = None) -> DataFrame:
    """The index as a table in the shared folder: one row per different text.

    ``docs`` needs ``doc_id`` and ``text``. ``slot`` numbers the texts that share a hash. ``n_keep`` counts the rows that have
    both the text and ``keep_id``.
    """
    base = common.small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), common.whole_text().alias("text")).withColumn("h", F.xxhash64("text"))
    keys = base.groupBy("h").agg(F.max(F.octet_length("text")).alias("size"))
    fine = common.written(keys.groupBy(F.shiftrightunsigned("h", 64 - PREFIX_BITS).cast("int").alias("prefix")).agg(F.sum("size").cast("long").alias("bytes")), "exact-prefixes")
    total = fine.agg(F.sum("bytes")).first()[0] or 0
    if bucket_bytes is None:
        bucket_bytes = min(64 << 20, max(1 << 20, total // (8 * docs.sparkSession.sparkContext.defaultParallelism)))
    depth = min(PREFIX_BITS, max(4, (total // bucket_bytes).bit_length() + 3))
    coarse = fine.groupBy(F.shiftright("prefix", PREFIX_BITS - depth).alias("prefix")).agg(F.sum("bytes").alias("bytes")).toPandas()  # some 8 rows for a bucket
    sizes = np.zeros(1 << depth, np.int64)
    sizes[coarse["prefix"].to_numpy(np.int64)] = coarse["bytes"].to_numpy(np.int64)
    directory = grow_directory(sizes, bucket_bytes)
    n_buckets = int(directory[-1]) + 1
    owners = min(n_buckets, OWNERS)
    owner = F.floor(F.col("bucket").cast("long") * owners / n_buckets).cast("int")
    entries = base.mapInArrow(lambda b: _combine(b, directory), ENTRY).repartitionById(owners, owner)
    return common.written(entries.sortWithinPartitions("bucket", "h").mapInArrow(_own, INDEX), "exact-index")


def dedup(docs: DataFrame, **index_options: int) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    index = build_index(docs, **index_options)
    text = common.whole_text()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("h"), F.sha2(text, 256).alias("text_sha256"))
    rows = rows.join(index.select("h", "text_sha256", "keep_id", "group_size", "n_keep"), ["h", "text_sha256"])
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    out = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    if not index.where("n_keep > 1").head(1):
        return rows.withColumn("kept", kept).select(*out)
    # rows of equal id and text: written with a number each, of which the least stays
    tied = common.written(rows.where(kept & (F.col("n_keep") > 1)).withColumn("row", F.monotonically_increasing_id()), "exact-ties")
    first = tied.groupBy("h", "text_sha256").agg(F.min("row").alias("row")).withColumn("kept", F.lit(True))
    tied = tied.join(first.select("row", "kept"), "row", "left").withColumn("kept", F.coalesce("kept", F.lit(False)))
    return rows.where(~(kept & (F.col("n_keep") > 1))).withColumn("kept", kept).select(*out).unionByName(tied.select(*out))


def keep_one(docs: DataFrame, **index_options: int) -> DataFrame:
    """The rows that stay, with all their columns. Texts that occur once are not in the list that rows are joined with."""
    index = build_index(docs, **index_options).where("group_size > 1").select("h", "text_sha256", "keep_id", "n_keep")
    text = common.whole_text()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("h"), F.sha2(text, 256).alias("text_sha256"), F.struct("*").alias("row"))
    rows = rows.join(index, ["h", "text_sha256"], "left").where(F.isnull("n_keep") | F.col("doc_id").eqNullSafe(F.col("keep_id")))
    if not index.where("n_keep > 1").head(1):
        return rows.select("row.*")
    tied = F.coalesce(F.col("n_keep") > 1, F.lit(False))
    one = rows.where(tied).groupBy("h", "text_sha256").agg(F.min_by("row", F.to_json("row")).alias("row"))
    return rows.where(~tied).select("row").unionByName(one.select("row")).select("row.*")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(common.table(spark, sf_dir, "documents"))


OP9_SQL = """
WITH t AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text_sha256)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, t.text_sha256 FROM t JOIN g USING (text_sha256)
"""
