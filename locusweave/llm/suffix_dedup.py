"""Removal of byte strings of 100 bytes that stand earlier already, by the Burrows-Wheeler transform of a collection of pieces, built column by column.

1. Pieces. Texts are cut where the minimizer (the k-byte string of least hash) of their 100-byte strings changes. Equal strings have equal minimizers, so only pieces of one minimizer can share
   strings: minimizers are the keys by which the collection is dealt to tasks. Pieces whose minimizer stands once in all texts go; equal pieces are combined, and but for the first their bytes go at once.
2. Collections. A task takes whole keys, some 130,000 bytes at a time. A piece enters as five documents, one for each start modulo five, so that a symbol is a word of five bytes and a string of
   100 bytes is 20 symbols. Each round inserts one symbol of each document, from the last to the first, into the transform - kept as the sorted pairs of symbol and place of what follows it - and
   updates the common prefixes: that of two neighbours is one more than the least common prefix between the places of what follows them.
3. Runs of suffixes with common prefixes of 20 symbols or more are equal strings; all but the first by (doc_id, hash of the text, start) are covered.
4. A key of more than ``key_pieces`` different pieces isn't gathered in a task: its strings are taken one by one and joined with the first place of each.

Tables between these steps are files in the shared folder, read in order; a collection of bounded size stays in its task's memory.

Null text counts as empty. A null doc_id sorts first. Rows with equal doc_id and text are one document: they get the same result. Rows of one doc_id with different texts go by a hash of the text.
An empty table gives an empty result. Other columns aren't read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Bytes of a string that may not stand twice; bytes of a minimizer; bytes of a symbol.
LENGTH, SEED, WORD = 100, 32, 5
#: Strings of a piece at most, as all hold its minimizer.
PIECE = LENGTH - SEED + 1
#: Bytes of text whose hashes are held at a time, and bytes of the pieces of a collection.
SEGMENT, COLLECTION = 1 << 20, 1 << 17
#: Bits that a place takes among hashes held at a time.
PLACE_BITS = 22
#: Different pieces of a key that a task takes together: 5 MB of text, for which its arrays take some 300 MB.
KEY_PIECES = 1 << 15
ODD = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(ODD), -1, 1 << 64))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: A number for each byte, for sums that stand for strings.
BYTES = _mixed(np.arange(1, 257, dtype=np.uint64) * ODD)


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    step = 1
    while step * 2 <= width:
        x, step = np.minimum(x[:-step], x[step:]), step * 2
    return np.minimum(x[: len(x) - (width - step)], x[width - step :]) if step < width else x


@cache
def _powers(x: np.uint64) -> np.ndarray:
    """Powers of ``x`` for all places among texts that are hashed together."""
    out = np.full(1 << PLACE_BITS, x)
    out[0] = 1
    return np.cumprod(out)


def _seeds(values: np.ndarray) -> np.ndarray:
    """A hash of each SEED bytes: sums of neighbours, doubled."""
    h, step, factor = values, 1, int(ODD)
    while step < SEED:
        h = h[:-step] * np.uint64(factor) + h[step:]
        step, factor = step * 2, factor * factor % (1 << 64)
    return _mixed(h)


def _cut(text: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of texts that stand one after another, each ending at one of ``ends``: minimizer, first place, number of strings; and the numbers of all bytes.

    Of equal minimizers in a string the first counts. All strings of a piece hold one minimizer at one place, so no string stands twice in a piece.
    """
    values = BYTES[text]
    seeds = _seeds(values)
    low = np.uint64((1 << PLACE_BITS) - 1)
    least = _least((seeds & ~low) | np.arange(len(seeds), dtype=np.uint64), PIECE)
    n = len(least)
    inside = np.ones(n, bool)  # strings that don't reach into the next text
    for back in range(1, LENGTH):
        at = ends[:-1] - back
        inside[at[(at >= 0) & (at < n)]] = False
    new = inside.copy()
    new[1:] &= (least[1:] != least[:-1]) | ~inside[:-1]
    starts = np.flatnonzero(new)
    strings = np.add.reduceat(inside.astype(np.int64), starts) if len(starts) else starts
    return seeds[(least[starts] & low).astype(np.int64)], starts, strings, values


def _hashes(values: np.ndarray, starts: np.ndarray, strings: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each piece, from sums over all bytes before its ends."""
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * _powers(ODD)[: len(values)])))
    return _mixed((sums[starts + strings + LENGTH - 1] - sums[starts]) * _powers(INVERSE)[starts])


PIECES = "key long, hash long, doc_id long, th long, start long, n int"


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray], list[int], list[int]]]:
    """Parts of texts of some SEGMENT bytes in all, with the row and the first byte of each; a long text comes in parts that overlap."""
    for batch in batches:
        texts = batch.column("text")
        parts: list[np.ndarray] = []
        row: list[int] = []
        base: list[int] = []
        held = 0
        for i in range(len(batch)):
            buffer = texts[i].as_buffer()
            text = np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)
            for lo in range(0, len(text) - LENGTH + 1, SEGMENT):
                part = text[lo : lo + SEGMENT + LENGTH - 1]
                parts.append(part)
                row.append(i)
                base.append(lo)
                held += len(part)
                if held >= SEGMENT:
                    yield batch, parts, row, base
                    parts, row, base, held = [], [], [], 0
        if parts:
            yield batch, parts, row, base


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Minimizers with the number of their pieces, as partial counts."""
    for _, parts, _, _ in _segments(batches):
        keys, n = np.unique(_cut(np.concatenate(parts), np.cumsum([len(p) for p in parts]))[0], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], names=["key", "n"])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, parts, row, base in _segments(batches):
        ends = np.cumsum([len(p) for p in parts])
        keys, starts, strings, values = _cut(np.concatenate(parts), ends)
        hashes = _hashes(values, starts, strings)
        of = np.searchsorted(ends, starts, side="right")
        at = pa.array(np.array(row)[of])
        place = starts - np.concatenate(([0], ends))[of] + np.array(base)[of]
        columns = [pa.array(keys.view(np.int64)), pa.array(hashes.view(np.int64)), batch.column("doc_id").take(at), batch.column("th").take(at), pa.array(place, pa.int64()), pa.array(strings.astype(np.int32))]
        yield pa.RecordBatch.from_arrays(columns, names=["key", "hash", "doc_id", "th", "start", "n"])


#: A symbol takes 40 bits of a pair, a place 24.
PLACE = np.uint64(24)
LOW = np.uint64((1 << 24) - 1)


class Collection:
    """The transform of a collection of documents, given as places of their symbols in ``words``.

    ``pairs`` holds, in the order of suffixes, the first symbol of each and the place of the rest of it (lower bits); ``common`` the common prefix of each with the one before
    it, in symbols, up to 255. The empty suffixes of the documents stand first.
    """

    def __init__(self, words: np.ndarray, first: np.ndarray, lengths: np.ndarray) -> None:
        self.words, self.first, self.lengths = words, first, lengths
        self.n = len(first)
        self.pairs = np.zeros(0, np.uint64)
        self.common = np.zeros(self.n, np.uint8)
        self.at = np.arange(self.n)  # place of each document's suffix
        for column in range(1, int(lengths.max(initial=0)) + 1):
            self._insert(column)

    def _insert(self, column: int) -> None:
        """One symbol of each document, the ``column``-th from its end."""
        docs = np.flatnonzero(self.lengths >= column)
        symbols = self.words[self.first[docs] + WORD * (self.lengths[docs] - column)]
        new = (symbols.astype(np.uint64) << PLACE) | self.at[docs].astype(np.uint64)
        order = np.argsort(new)
        new, docs = new[order], docs[order]
        gaps = np.searchsorted(self.pairs, new)
        places = gaps + np.arange(len(new))
        size = len(self.pairs) + len(new)
        is_new = np.zeros(size, bool)
        is_new[places] = True
        kept = np.flatnonzero(~is_new)
        pairs = np.empty(size, np.uint64)
        pairs[kept], pairs[places] = self.pairs, new
        touched = np.flatnonzero(is_new | np.concatenate(([False], is_new[:-1])))
        common = np.zeros(self.n + size, np.uint8)
        common[self.n + kept] = self.common[self.n :]
        common[self.n + touched] = self._common(pairs, touched)
        # places of rests, as suffixes have moved
        moved = np.concatenate((np.arange(self.n), self.n + kept))
        self.pairs = (pairs & ~LOW) | moved[(pairs & LOW).astype(np.int64)].astype(np.uint64)
        self.common = common
        self.at = moved[self.at]
        self.at[docs] = self.n + places

    def _common(self, pairs: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Common prefixes of the suffixes ``at`` with those before them, from the common prefixes between the places of their rests."""
        before = pairs[np.maximum(at - 1, 0)]
        here = pairs[at]
        same = (at > 0) & (before >> PLACE == here >> PLACE)
        lo, hi = (before[same] & LOW).astype(np.int64) + 1, (here[same] & LOW).astype(np.int64)
        out = np.zeros(len(at), np.uint8)
        if len(lo):
            level = np.frexp((hi - lo + 1).astype(np.float64))[1] - 1
            least, found = self.common, np.zeros(len(lo), np.uint8)
            for j in range(int(level.max()) + 1):
                if j:
                    step = 1 << (j - 1)
                    least = np.minimum(least[:-step], least[step:])
                of = np.flatnonzero(level == j)
                found[of] = np.minimum(least[lo[of]], least[hi[of] - (1 << j) + 1])
            out[same] = np.minimum(found, 254) + 1
        return out

    def starts(self) -> np.ndarray:
        """Where in ``words`` each suffix starts, in their order: documents are read from front to back."""
        out = np.empty(len(self.pairs), np.int64)
        rest = (self.pairs & LOW).astype(np.int64)
        docs, at = np.arange(self.n), self.at
        for i in range(int(self.lengths.max(initial=0))):
            more = self.lengths[docs] > i
            docs, at = docs[more], at[more]
            out[at - self.n] = self.first[docs] + WORD * i
            at = rest[at - self.n]
        return out


def _repeats(texts: list[bytes], places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Covered ranges of the pieces: number of the piece, first and last byte but one. ``places``: a number for each piece's first string by which all are ordered; the next ones count up."""
    sizes = np.array([len(t) for t in texts])
    first = np.concatenate(([0], np.cumsum(sizes + WORD)))[:-1]
    data = np.frombuffer((b"\0" * WORD).join(texts) + b"\0" * (2 * WORD), np.uint8).astype(np.uint64)
    words = data[: 1 - WORD]
    for i in range(1, WORD):
        words = (words << np.uint64(8)) | data[i : len(data) - WORD + 1 + i]
    shift = np.tile(np.arange(WORD), len(texts))
    of = np.repeat(np.arange(len(texts)), WORD)
    collection = Collection(words, first[of] + shift, -(-(sizes[of] - shift) // WORD))
    starts = collection.starts()
    piece = np.searchsorted(first, starts, side="right") - 1
    inside = starts - first[piece]
    whole = inside + LENGTH <= sizes[piece]
    place = np.where(whole, places[piece] + inside, np.iinfo(np.int64).max)
    runs = np.flatnonzero(collection.common[collection.n :] < LENGTH // WORD)
    least = np.repeat(np.minimum.reduceat(place, runs), np.diff(np.append(runs, len(place))))
    covered = np.sort(starts[whole & (place > least)])
    if not len(covered):
        return covered, covered, covered
    piece = np.searchsorted(first, covered, side="right") - 1
    opens = np.concatenate(([True], (covered[1:] > covered[:-1] + LENGTH) | (piece[1:] != piece[:-1])))
    closes = np.append(opens[1:], True)
    return piece[opens], covered[opens] - first[piece[opens]], covered[closes] - first[piece[closes]] + LENGTH


RANGES = "doc_id long, th long, lo long, hi long"


def _collections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in the order of their keys to covered ranges."""
    open_key: int | None = None
    rows: list[tuple] = []
    held = 0

    def flush() -> pa.RecordBatch:
        order = sorted({(r[0] is not None, r[0] or 0, r[1]) for r in rows})
        rank = {k: i for i, k in enumerate(order)}
        places = np.array([(rank[(r[0] is not None, r[0] or 0, r[1])] << 40) + r[2] for r in rows])
        piece, lo, hi = _repeats([r[3] for r in rows], places)
        found = [rows[p] for p in piece.tolist()]
        start = np.array([r[2] for r in found], np.int64)
        columns = [pa.array([r[0] for r in found], pa.int64()), pa.array([r[1] for r in found], pa.int64()), pa.array(start + lo), pa.array(start + hi)]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "th", "lo", "hi"])

    for batch in batches:
        for key, *row in zip(*(batch.column(c).to_pylist() for c in ("key", "doc_id", "th", "start", "piece"))):
            if key != open_key and held >= COLLECTION:
                yield flush()
                rows, held = [], 0
            open_key = key
            rows.append(tuple(row))
            held += len(row[3])
    if rows:
        yield flush()


def _finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with the list of their covered ranges to what is left of them."""
    for batch in batches:
        for part in common.slices(batch):
            out = []
            for doc_id, text, ranges in zip(*(part.column(c).to_pylist() for c in ("doc_id", "text", "ranges"))):
                spans: list[list[int]] = []
                for r in sorted((r["lo"], r["hi"]) for r in ranges or ()):
                    if spans and r[0] <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], r[1])
                    else:
                        spans.append(list(r))
                edges = [0, *(x for s in spans for x in s), len(text)]
                left = b"".join(text[lo:hi] for lo, hi in zip(edges[::2], edges[1::2])) if spans else text
                out.append((doc_id, len(text), len(text) - len(left), len(spans), hashlib.sha256(left).hexdigest(), spans, left))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.list_(pa.int64())), pa.binary())
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)], names=names)


def _same(left: str, right: str) -> F.Column:
    """The document of both sides is one."""
    return F.col(f"{left}.doc_id").eqNullSafe(F.col(f"{right}.doc_id")) & (F.col(f"{left}.th") == F.col(f"{right}.th"))


def covered_ranges(docs: DataFrame, key_pieces: int = KEY_PIECES) -> DataFrame:
    """doc_id, th, lo, hi (bytes, hi exclusive) of all that is covered; ranges of a document may overlap. ``docs`` has doc_id, th and text (binary)."""
    long = docs.where(F.octet_length("text") >= LENGTH)
    pieces = long.mapInArrow(_pieces, PIECES)
    often = long.select("text").mapInArrow(_keys, "key long, n long").groupBy("key").agg(F.sum("n").alias("of_key")).where("of_key > 1").select("key")
    with common.cleaned(docs.sparkSession):
        shared = common.written(pieces.join(often, "key"), "suffix-pieces")
    place = F.struct("doc_id", "th", "start")
    firsts = shared.groupBy("key", "hash", "n").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("copies"))
    with common.cleaned(docs.sparkSession):
        firsts = common.written(firsts, "suffix-firsts")
    later = shared.join(firsts.where("copies > 1").select("key", "hash", "n", "first"), ["key", "hash", "n"]).where(~place.eqNullSafe(F.col("first")))
    later = later.select("doc_id", "th", F.col("start").alias("lo"), (F.col("start") + F.col("n") + (LENGTH - 1)).alias("hi"))
    several = firsts.groupBy("key").agg(F.count(F.lit(1)).alias("different")).where("different > 1").select("key", (F.col("different") > key_pieces).alias("hot"))
    wanted = firsts.join(several, "key").select("first.*", "key", "n", "hot").groupBy("doc_id", "th").agg(F.collect_list(F.struct("key", "start", "n", "hot")).alias("pieces"))
    texts = docs.alias("d").join(wanted.alias("w"), _same("d", "w")).select("d.*", F.explode("pieces").alias("p")).select("doc_id", "th", "text", "p.*")
    cut = F.substring("text", F.col("start").cast("int") + 1, F.col("n") + (LENGTH - 1))
    with common.cleaned(docs.sparkSession):
        texts = common.written(texts.select("key", "doc_id", "th", "start", "n", "hot", cut.alias("piece")), "suffix-collection")
    dealt = common.small_batches(texts.where("NOT hot")).select("key", "doc_id", "th", "start", "piece").repartition("key").sortWithinPartitions("key")
    found = dealt.mapInArrow(_collections, RANGES).unionByName(later)
    if not texts.where("hot").head(1):
        return found
    strings = texts.where("hot").select("doc_id", "th", "start", "piece", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("i"))
    string = F.substring("piece", F.col("i") + 1, LENGTH)
    strings = strings.select("doc_id", "th", (F.col("start") + F.col("i")).alias("start"), F.xxhash64(string).alias("a"), F.xxhash64(F.lit("second"), string).alias("b"))
    first = strings.groupBy("a", "b").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    again = strings.join(first, ["a", "b"]).where(~place.eqNullSafe(F.col("first")))
    return found.unionByName(again.select("doc_id", "th", F.col("start").alias("lo"), (F.col("start") + LENGTH).alias("hi")))


def dedup_strings(docs: DataFrame, key_pieces: int = KEY_PIECES) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (removed bytes, from and to), kept (the bytes that stay)."""
    text = common.whole_text()
    docs = common.small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.cast("binary").alias("text"))
    ranges = covered_ranges(docs, key_pieces).groupBy("doc_id", "th").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))
    joined = docs.alias("d").join(ranges.alias("r"), _same("d", "r"), "left").select("d.doc_id", "d.text", "r.ranges")
    return joined.mapInArrow(_finished, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<array<long>>, kept binary")


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_strings(common.table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


OP13_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
b AS MATERIALIZED (SELECT doc_id, lo, least(512, length(h) / 2 - 99 - lo) AS n, substring(h, CAST(2 * lo + 1 AS INT), 1222) AS h FROM (SELECT doc_id, h, unnest(generate_series(0, CAST(length(h) / 2 AS BIGINT) - 100, 512)) AS lo FROM d) x),
w AS MATERIALIZED (SELECT doc_id, lo + i AS i, md5_number(substring(h, CAST(2 * i + 1 AS INT), 200)) AS k FROM (SELECT doc_id, lo, h, unnest(generate_series(0, CAST(n AS BIGINT) - 1)) AS i FROM b) x),
f AS MATERIALIZED (SELECT k, min((doc_id, i)) AS place FROM w GROUP BY k HAVING count(*) > 1),
c AS MATERIALIZED (SELECT w.doc_id, w.i FROM w JOIN f USING (k) WHERE (w.doc_id, w.i) <> f.place),
g AS (SELECT doc_id, i, sum(CASE WHEN i <= before + 100 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM c) x),
r AS (SELECT doc_id, min(i) AS lo, max(i) + 100 AS hi FROM g GROUP BY doc_id, run),
e AS (SELECT doc_id, lo, hi, lead(lo) OVER (PARTITION BY doc_id ORDER BY lo) AS next_lo, row_number() OVER (PARTITION BY doc_id ORDER BY lo) AS nr FROM r),
k AS (SELECT d.doc_id, count(*) AS n_spans, CAST(sum(hi - lo) AS BIGINT) AS n_removed,
  string_agg(CASE WHEN nr = 1 THEN substring(h, 1, CAST(2 * lo AS INT)) ELSE '' END || substring(h, CAST(2 * hi + 1 AS INT), CAST(2 * (coalesce(next_lo, length(h) / 2) - hi) AS INT)), '' ORDER BY lo) AS kept FROM e JOIN d USING (doc_id) GROUP BY d.doc_id)
SELECT d.doc_id, CAST(length(h) / 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""
