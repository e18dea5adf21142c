"""MinHash near-dedup: improved consistent weighted sampling over TF-IDF shingles.

Shingles are five consecutive words (lower-cased runs of ASCII letters, digits and all non-ASCII characters); a text of one to four words is one
shingle. A shingle weighs ``tf * idf``. Document frequencies are counted over all documents in ``2 ** 18`` hashed
features, so the table of idf has one size at any input size. What shingles of few documents put into every feature - the median count - is
subtracted, and what doesn't stand out from the noise of that counts as one document; so a rare shingle has the largest idf at any size, and a frequent one its own.
The idf is smoothed, ``1 + blend * ln((1 + N) / (1 + df)) / ln(1 + N)``: with the full
logarithm, copies of a text that a third of all rows share would weigh less in what they share than in what sets them apart.

1. Signatures. Improved consistent weighted sampling draws 13 x 4 samples per text in numpy, with variates from fixed tables that
   are addressed by the shingle's hash. Equal texts have one signature. Four samples make a band.
2. Buckets are the texts that share a band. Buckets with the same members count once. A bucket is dealt out in blocks of at most
   ``BLOCK`` texts or ``BLOCK_BYTES`` of text, and the bucket's leader comes to each block. In a block all weighted Jaccard similarities are
   computed exactly (one matrix product over shared shingles); a spanning tree of the pairs at ``threshold`` or more leaves it.
3. Components of these links. In a bucket of several blocks whose members still lie in several components, the members outside the largest
   component are compared with all members of the bucket in the same way, so no link between members of a bucket is lost at any bucket size, and a
   few strays in a large bucket cost no more than one pass over it.
4. A class is a component; its id is its least doc_id.

Null text counts as empty; texts without words are near only to equal texts. A null doc_id is never a class id unless all
ids of the class are null. Of each class one row stays: the least doc_id, nulls last; of several rows with that id the first by the text's hash, and
of equal rows one (the first by all columns, as JSON, in ``keep_one``). An empty table gives an empty result. ``keep_one`` keeps all columns, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, wordhash
from .wordhash import U
from .components import components

SHINGLE = 5
BANDS, BAND_ROWS = 13, 4
DF_BITS = 18
DF_BLOCK = 4096
BLOCK, BLOCK_BYTES = 512, 4 << 20
BLEND = 0.15
#: Odd multipliers of the places in a shingle.
PLACES = [U(int(x) | 1) for x in np.random.default_rng(11).integers(1, 1 << 63, SHINGLE)]


def shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For lower-cased UTF-8 texts: text number, hash and count of every different shingle, by text and hash."""
    found = wordhash.words(texts)
    words, text_of = found.hashes(), found.text_of
    n_words = np.bincount(text_of, minlength=len(texts))
    m = max(0, len(words) - SHINGLE + 1)
    h = np.zeros(m, U)
    for k, odd in enumerate(PLACES):
        h += words[k : k + m] * odd
    whole = text_of[:m] == text_of[SHINGLE - 1 :][:m]
    h, owner = h[whole], text_of[:m][whole]
    short = np.flatnonzero((n_words > 0) & (n_words < SHINGLE))
    if len(short):
        at = np.cumsum(n_words) - n_words
        extra = np.array([sum(int(words[at[i] + k]) * int(PLACES[k]) for k in range(n_words[i])) + int(n_words[i]) & (1 << 64) - 1 for i in short], U)
        h, owner = np.concatenate((h, extra)), np.concatenate((owner, short))
        order = np.argsort(owner, kind="stable")
        h, owner = h[order], owner[order]
    h = wordhash.mix(h)
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        if hi - lo > 1:
            h[lo:hi].sort()
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    return owner[at], h[at], np.diff(np.concatenate((at, [len(h)])))


def _sliced(part: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    texts = [t.lower().encode("utf-8", "surrogatepass") for t in part.column("text").to_pylist()]
    for lo, hi in wordhash.cuts(texts):
        yield part.slice(lo, hi - lo), texts[lo:hi]


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, docs = np.zeros(1 << DF_BITS, np.int64), 0
    for batch in batches:
        for part in common.slices(batch):
            for rows, texts in _sliced(part):
                owner, h, _ = shingles(texts)
                feature = (h >> U(64 - DF_BITS)).astype(np.int64)
                new = np.ones(len(h), bool)
                new[1:] = (feature[1:] != feature[:-1]) | (owner[1:] != owner[:-1])
                total += np.bincount(feature[new], minlength=1 << DF_BITS)
                docs += len(rows)
    if docs:
        kind = next(k for k in (np.uint8, np.uint16, np.int64) if total.max() <= np.iinfo(k).max)
        blocks = total.reshape(-1, DF_BLOCK).astype(kind)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(blocks)), pa.int32()), pa.array([b.tobytes() for b in blocks], pa.binary()), pa.array([docs if i == 0 else 0 for i in range(len(blocks))], pa.int64())],
            names=["block", "counts", "docs"],
        )


def _unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, {DF_BLOCK: np.uint8, 2 * DF_BLOCK: np.uint16, 8 * DF_BLOCK: np.int64}[len(raw)]).astype(np.int64)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    docs: dict[int, int] = {}
    for batch in batches:
        for block, raw, n in zip(*(batch.column(c).to_pylist() for c in ("block", "counts", "docs"))):
            sums[block] = sums.get(block, 0) + _unpacked(raw)
            docs[block] = docs.get(block, 0) + n
    if sums:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary()), pa.array(list(docs.values()), pa.int64())], names=["block", "counts", "docs"]
        )


def idf_table(docs: DataFrame, blend: float = BLEND) -> np.ndarray:
    """Smoothed idf of each hashed feature, from document frequencies over all documents."""
    kind = "block int, counts binary, docs long"
    rows = docs.select(common.whole_text().alias("text")).mapInArrow(_frequencies, kind).repartition("block").mapInArrow(_summed, kind).collect()  # 2 ** 18 counts at most
    counts, n = np.zeros(1 << DF_BITS), sum(r.docs for r in rows)
    for r in rows:
        counts[r.block * DF_BLOCK : (r.block + 1) * DF_BLOCK] = _unpacked(r.counts)
    return smoothed_idf(counts, n, blend)


def smoothed_idf(counts: np.ndarray, n: int, blend: float) -> np.ndarray:
    """From the documents of each feature and of all."""
    noise = np.median(counts)
    df = counts - noise
    df[df < 4 * np.sqrt(noise)] = 1
    return (1 + blend * np.log((1 + n) / (1 + np.maximum(df, 1))) / max(np.log(1 + n), 1e-9)).clip(1).astype(np.float32)


#: Filled once in each Python worker.
_TABLES: dict[str, np.ndarray] = {}


def _sampling_tables() -> tuple[np.ndarray, ...]:
    """r, 1 / r and beta, ln c of the sampling scheme, for 16 bits of hash each, and a multiplier per sample."""
    if "r" not in _TABLES:
        rng = np.random.default_rng(5)
        _TABLES["r"] = rng.gamma(2, 1, 1 << 16).clip(1e-3).astype(np.float32)
        _TABLES["1/r"] = (1 / _TABLES["r"]).astype(np.float32)
        _TABLES["beta"] = rng.random(1 << 16).astype(np.float32)
        _TABLES["ln c"] = (np.log(rng.gamma(2, 1, 1 << 16).clip(1e-6)) + 64).astype(np.float32)
        _TABLES["odd"] = rng.integers(1, 1 << 63, BANDS * BAND_ROWS).astype(U) | U(1)
    return tuple(_TABLES[k] for k in ("r", "1/r", "beta", "ln c", "odd"))


def consistent_samples(h: np.ndarray, log_weight: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """One 32-bit tag per text and sample, naming the sampled shingle and its weight level. ``starts`` begins each text's shingles.

    For weight S: t = floor(ln S / r + beta), ln a = ln c - r (t - beta + 1); the shingle of least a is the sample.
    """
    r, inverse, beta, log_c, odd = _sampling_tables()
    out = np.empty((len(starts), len(odd)), np.uint32)
    low = h & U(0xFFFFFFFF)
    for k, o in enumerate(odd):
        m = h * o
        i, j = (m >> U(48)).view(np.int64), (m >> U(32) & U(0xFFFF)).view(np.int64)
        b = beta.take(j)
        t = log_weight * inverse.take(i)
        t += b
        np.floor(t, out=t)
        tag = t.astype(np.int32).view(np.uint32) * np.uint32(0x85EBCA6B)
        t -= b
        t += np.float32(1)
        t *= r.take(i)
        a = log_c.take(j)
        a -= t  # positive, as ln c was shifted by 64; so its bits order like the number
        key = a.view(np.uint32).astype(U)
        key <<= U(32)
        key |= low ^ tag
        out[:, k] = np.minimum.reduceat(key, starts).astype(np.uint32)
    return out


def _signatures(batches: Iterator[pa.RecordBatch], idf: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in common.slices(batch):
            for rows, texts in _sliced(part):
                owner, h, tf = shingles(texts)
                if not len(h):
                    continue
                weight = np.log(tf * idf[(h >> U(64 - DF_BITS)).astype(np.int64)]).astype(np.float32)
                starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
                tags = consistent_samples(h, weight, starts).astype(U)
                bands = np.zeros((len(starts), BANDS), U)
                for k in range(BAND_ROWS):
                    bands = wordhash.mix(bands + tags[:, k::BAND_ROWS] * PLACES[k] + np.arange(1, BANDS + 1, dtype=U))
                nodes = rows.column("node").take(pa.array(owner[starts]))
                flat = pa.array(bands.view(np.int64).ravel())
                offsets = pa.array(np.arange(0, flat.__len__() + 1, BANDS, dtype=np.int32))
                yield pa.RecordBatch.from_arrays([nodes, pa.array([len(texts[i]) for i in owner[starts]], pa.int64()), pa.ListArray.from_arrays(offsets, flat)], names=["node", "size", "bands"])


def _tokens(texts: list[bytes], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, token and weight; a shingle that stands n times is n tokens, so that weighted sets become plain ones."""
    parts = [(lo, *shingles(texts[lo:hi])) for lo, hi in wordhash.cuts(texts)]
    owner, h, tf = (np.concatenate(x) for x in zip(*((lo + o, h, n) for lo, o, h, n in parts)))
    repeat = np.arange(tf.sum()) - np.repeat(np.cumsum(tf) - tf, tf)
    w = idf[(h >> U(64 - DF_BITS)).astype(np.int64)].astype(np.float64)
    return np.repeat(owner, tf), np.repeat(h, tf) + repeat.astype(U) * U(wordhash.BASE), np.repeat(w, tf)


def similarities(texts: list[bytes], idf: np.ndarray) -> np.ndarray:
    """Weighted Jaccard similarity of all pairs of a block."""
    owner, token, w = _tokens(texts, idf)
    n = len(texts)
    total = np.bincount(owner, w, n)
    _, first, column, count = np.unique(token, return_index=True, return_inverse=True, return_counts=True)
    shared = np.cumsum(count > 1) - 1
    keep = count[column] > 1
    owner, column, weight = owner[keep], shared[column[keep]], w[first][count > 1]
    both = np.zeros((n, n))
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for lo in range(0, len(weight), 4096):
        a, b = np.searchsorted(column, (lo, lo + 4096))
        x = np.zeros((n, min(4096, len(weight) - lo)))
        x[owner[a:b], column[a:b] - lo] = 1
        both += (x * weight[lo : lo + 4096]) @ x.T
    union = total[:, None] + total[None, :] - both
    return np.divide(both, union, out=np.zeros_like(both), where=union > 0)


def _spanning(near: np.ndarray, group: list) -> list[tuple[int, int]]:
    """A forest that joins what ``near`` and equal groups join; edges inside a group are left out."""
    n, free, edges = len(near), np.ones(len(near), bool), []
    members: dict = {}
    for i, g in enumerate(group):
        members.setdefault(g, []).append(i)
    for root in range(n):
        if not free[root]:
            continue
        queue = members[group[root]].copy()
        free[queue] = False
        while queue:
            i = queue.pop()
            for j in np.flatnonzero(near[i] & free):
                if free[j]:
                    edges.append((i, int(j)))
                    more = members[group[j]]
                    free[more] = False
                    queue += more
    return edges


def _linked(batches: Iterator[pa.RecordBatch], idf: np.ndarray, threshold: float) -> Iterator[pa.RecordBatch]:
    """Links of each block; its rows come together, as they are sorted by key, i, j."""
    at: tuple | None = None
    texts: dict[bytes, tuple[bytes, bytes]] = {}
    links: list[tuple[bytes, bytes]] = []

    def close() -> None:
        if len({g for g, _ in texts.values()}) > 1:
            nodes = list(texts)
            near = similarities([t for _, t in texts.values()], idf) >= threshold - 1e-9
            links.extend((nodes[i], nodes[j]) for i, j in _spanning(near, [g for g, _ in texts.values()]))
        texts.clear()

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.binary()) for k in (0, 1)], names=["a", "b"])
        links.clear()
        return out

    for batch in batches:
        for part in common.slices(batch):
            for key, i, j, node, group, text in zip(*(part.column(c).to_pylist() for c in ("key", "i", "j", "node", "root", "text"))):
                if (key, i, j) != at:
                    close()
                    at = (key, i, j)
                texts[node] = (group, text.lower().encode("utf-8", "surrogatepass"))
        if links:
            yield flush()
    close()
    if links:
        yield flush()


def node_of(text: Column) -> Column:
    """128-bit name of a text."""
    return F.unhex(F.md5(text))


def _links(rows: DataFrame, texts: DataFrame, idf: np.ndarray, threshold: float) -> DataFrame:
    """``rows``: key, i, j, node, root; each (key, i, j) is a block."""
    full = rows.join(texts, "node").select("key", "i", "j", "node", "root", "text").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return full.mapInArrow(lambda b: _linked(b, idf, threshold), "a binary, b binary")


def near_classes(docs: DataFrame, threshold: float = 0.8, blend: float = BLEND) -> DataFrame:
    """node, root of every text that is near to a different text; texts of one root are one class."""
    base = common.small_batches(docs).select(common.whole_text().alias("text")).select(node_of(F.col("text")).alias("node"), "text")
    idf = idf_table(docs, blend)
    signatures = base.mapInArrow(lambda b: _signatures(b, idf), "node binary, size long, bands array<long>")
    signatures = common.written(signatures.dropDuplicates(["node"]), "signatures")
    banded = signatures.select(F.explode("bands").alias("key"), "node", "size")
    order = F.xxhash64("node", "key")
    member = F.xxhash64("node")
    buckets = banded.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"), F.min(order).alias("lead"), F.sum(member.cast("decimal(20,0)")).alias("sum"), F.bit_xor(member).alias("xor")
    ).where("n > 1")
    same = buckets.groupBy("n", "sum", "xor").agg(F.min(F.struct("key", "bytes", "lead")).alias("one"))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("one.bytes") / BLOCK_BYTES)).cast("int")
    buckets = common.cut(same.select(F.col("one.key").alias("key"), F.col("one.lead").alias("lead"), blocks.alias("blocks")))
    members = banded.join(buckets, "key").select("key", "blocks", "node", "size", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"), (order == F.col("lead")).alias("leads"))
    members = common.written(members, "members")

    # the texts of all members, one row each; equal texts are combined before they are shuffled (a semi join would be
    # pushed below the aggregate, where rows of equal texts meet in one task)
    texts = base.groupBy("node").agg(F.first("text").alias("text"))
    texts = common.written(texts.join(members.select("node").distinct(), "node"), "texts")
    own = F.when(F.col("leads"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("block"))
    first = members.select("key", F.explode(own).alias("i"), "node").select("key", "i", F.col("i").alias("j"), "node", F.col("node").alias("root"))
    links = common.written(_links(first, texts, idf, threshold), "links")
    found = components(links)

    large = members.where("blocks > 1")
    if not large.head(1):
        return found
    rooted = large.join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    parts = rooted.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"))
    most = F.struct("n", "root")
    wide = parts.groupBy("key").agg(F.max(most)["root"].alias("main"), F.sum("n").alias("all"), F.max("n").alias("n"), (F.sum("bytes") - F.max_by("bytes", most)).alias("bytes"))
    wide = wide.where(F.col("all") > F.col("n"))  # buckets in several components
    groups = F.greatest(F.ceil((F.col("all") - F.col("n")) * 2 / BLOCK), F.ceil(F.col("bytes") * 2 / BLOCK_BYTES)).cast("int")
    wide = common.cut(wide.select("key", "main", groups.alias("groups")))
    open_rows = rooted.join(wide, "key").select("key", "node", "root", "block", "blocks", "groups", (F.col("root") != F.col("main")).alias("stray"), F.pmod(F.xxhash64(F.lit("stray"), "node"), F.col("groups")).cast("int").alias("group"))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    every = open_rows.select("key", F.col("block").alias("i"), each("groups").alias("j"), "node", "root")
    strays = open_rows.where("stray").select("key", each("blocks").alias("i"), F.col("group").alias("j"), "node", "root")
    more = common.written(_links(every.unionByName(strays), texts, idf, threshold), "links")
    if not more.head(1):
        return found
    return components(links.unionByName(more))


def _led(docs: DataFrame, near: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows as doc_id, node, row; and, for every node of a class of several rows, class_id, lead (the node that stays), times (rows with both) and class_size."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), node_of(common.whole_text()).alias("node"), F.struct("*").alias("row"))
    ids = rows.select("doc_id", "node").join(near, "node", "left").withColumn("root", F.coalesce("root", "node"))
    order = F.struct(F.isnull("doc_id"), "doc_id", "node")
    # each (doc_id, node) with the number of its rows, so that a large class of equal rows is small before it is grouped
    counted = ids.groupBy("root", "doc_id", "node").agg(F.count(F.lit(1)).alias("n"))
    classes = counted.groupBy("root").agg(F.min(order).alias("least"), F.min_by("n", order).alias("times"), F.sum("n").alias("class_size")).where("class_size > 1")
    classes = common.cut(classes.select("root", F.col("least.doc_id").alias("class_id"), F.col("least.node").alias("lead"), "times", "class_size"))
    # written, so that Spark can split the rows of a large class in the join
    names = near.join(classes, "root").unionByName(classes.select(F.col("root").alias("node"), *classes.columns)).dropDuplicates(["node"]).drop("root")
    return rows, common.written(names, "classes")


def near_duplicates(docs: DataFrame, threshold: float = 0.8, blend: float = BLEND) -> DataFrame:
    """One row per input row: doc_id, class_id (least doc_id of its class), class_size (rows), kept (one row of each class)."""
    rows, names = _led(docs, near_classes(docs, threshold, blend))
    rows = rows.select("doc_id", "node").join(names, "node", "left")
    leads = F.isnull("lead") | F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("node") == F.col("lead"))
    out = [F.col("doc_id"), F.when(F.isnull("lead"), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("class_size", F.lit(1)).alias("class_size")]
    if not names.where("times > 1").head(1):
        return rows.select(*out, leads.alias("kept"))
    # equal rows that lead their class: written with a number each, of which the least stays
    tied = leads & F.coalesce(F.col("times") > 1, F.lit(False))
    ties = common.written(rows.where(tied).withColumn("row", F.monotonically_increasing_id()), "near-ties")
    first = ties.groupBy("node").agg(F.min("row").alias("row")).select("row", F.lit(True).alias("first"))
    ties = ties.join(first, "row", "left").select(*out, F.coalesce("first", F.lit(False)).alias("kept"))
    return rows.where(~tied).select(*out, leads.alias("kept")).unionByName(ties)


def keep_one(docs: DataFrame, threshold: float = 0.8, blend: float = BLEND) -> DataFrame:
    """The rows that stay, with all their columns: one of each class of near or equal texts."""
    rows, names = _led(docs, near_classes(docs, threshold, blend))
    kept = rows.join(names, "node", "left").where(F.isnull("lead") | F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("node") == F.col("lead")))
    if not names.where("times > 1").head(1):
        return kept.select("row.*")
    tied = F.coalesce(F.col("times") > 1, F.lit(False))
    one = kept.where(tied).groupBy("node").agg(F.min_by("row", F.to_json("row")).alias("row"))
    return kept.where(~tied).select("row").unionByName(one.select("row")).select("row.*")


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(common.table(spark, sf_dir, "documents"))
