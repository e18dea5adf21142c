"""Quality rules by distribution divergence.

For every language that the corpus names, its documents give a reference: the mean of their histograms of character classes, and of
their histograms of common words. A language's common words are the ``N_COMMON`` with the largest mean share, learned from the same documents; words are told apart
by a hash of ``WORD_BITS`` bits, so what is counted has one size at any vocabulary, and all other words share a bin. Only documents that pass the base rules, and are
long enough for the comparison, count for a reference, and a language needs ``min_documents`` of them; a document without a language counts for none.

A document is compared with the nearest
reference by Jensen-Shannon distance (base 2, so from 0 to 1). It fails where a distance is over its bound and the document is
long enough for that comparison: ``min_chars`` for classes, ``min_words`` for words. Without any reference the base rules decide.

References are sums over all documents, gathered in the tasks; the driver gets some 30 numbers for each language. Null text has no
words and fails the base rule. doc_id, null or repeated, is only passed on. An empty table gives an empty result. Other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common, wordhash
from .wordhash import U

N_COMMON, WORD_BITS = 24, 13
#: Characters, told apart by their first UTF-8 byte: lower, upper, digit, white space, sentence marks, other ASCII, other letters, the rest.
CLASSES = 8
SYMBOLS = "#*$%&|<>"
SPACE = " \t\n\x0b\x0c\r"

OUT = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, class_distance double, word_distance double"


def _class_table() -> np.ndarray:
    """Class of each byte; 8 for bytes inside a character."""
    out = np.full(256, 5, np.uint8)
    out[ord("a") : ord("z") + 1] = 0
    out[ord("A") : ord("Z") + 1] = 1
    out[ord("0") : ord("9") + 1] = 2
    out[[ord(c) for c in SPACE]] = 3
    out[[ord(c) for c in ".,;:'\"-?"]] = 4
    out[0x80:0xC0] = 8
    out[0xC3:0xE0] = 6
    out[0xC2] = out[0xE0:] = 7
    return out


CLASS_OF = _class_table()
#: 1 for white space, 2 for symbols, 4 for bytes that begin a character.
MARKS = np.zeros(256, np.uint8)
MARKS[[ord(c) for c in SPACE]] = 1
MARKS[[ord(c) for c in SYMBOLS]] = 2
MARKS[:0x80] |= 4
MARKS[0xC0:] |= 4
#: Bytes of the words that the base rules count.
DENSE = (MARKS & 1) == 0
#: Odd multipliers of the places in a window.
PLACES = [U(int(x) | 1) for x in np.random.default_rng(13).integers(1, 1 << 63, 5)]


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a five-word window that the text has twice or more."""
    seen: dict[tuple, int] = {}
    again = bytearray(len(words))
    for i, w in enumerate(zip(words, words[1:], words[2:], words[3:], words[4:])):
        first = seen.setdefault(w, i)
        if first != i:
            again[i : i + 5] = again[first : first + 5] = b"\1" * 5
    return sum(again)


def _duplicate_lines(text: str) -> int:
    lines = [x for x in text.split("\n") if x and x.strip(SPACE)]
    return len(lines) - len(set(lines))


@dataclass
class Counts:
    """Of each text: what the base rules count, and its histograms."""

    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat: np.ndarray
    n_chars: np.ndarray
    classes: np.ndarray
    #: Text number and bucket of each word (lower-cased letters and digits), and how many a text has.
    text_of: np.ndarray
    buckets: np.ndarray
    n_plain: np.ndarray

    @property
    def failed(self) -> np.ndarray:
        return (self.n_words < 10) | (100 * self.n_repeat > 20 * self.n_words)


def counts(texts: list[str]) -> Counts:
    encoded = [t.encode("utf-8", "surrogatepass") for t in texts]
    n = len(texts)
    raw = np.frombuffer(b"".join(encoded), np.uint8)
    owner = np.repeat(np.arange(n), [len(e) for e in encoded])
    count = lambda keep: np.bincount(owner[keep], minlength=n)
    marks = MARKS[raw]
    n_chars, spaces = count(marks >= 4), count(marks & 1 > 0)
    classes = np.bincount(owner * 9 + CLASS_OF[raw], minlength=9 * n).reshape(n, 9)[:, :CLASSES]
    dense = wordhash.words(encoded, DENSE)
    n_words = np.bincount(dense.text_of, minlength=n)
    # windows that may stand twice in a text, by their hash; only such texts are compared word by word
    h, m = dense.hashes(), max(0, len(dense.text_of) - 4)
    window = sum((h[k : k + m] * PLACES[k] for k in range(5)), np.zeros(m, U))
    at = dense.text_of[:m]
    whole = at == dense.text_of[4:][:m]
    at, window = at[whole], wordhash.mix(window[whole])
    order = np.lexsort((window, at))
    at, window = at[order], window[order]
    n_repeat = np.zeros(n, np.int64)
    for i in np.unique(at[1:][(at[1:] == at[:-1]) & (window[1:] == window[:-1])]):
        n_repeat[i] = repeated_words(encoded[i].split())
    plain = wordhash.words([e.lower() for e in encoded])
    buckets = (plain.hashes() >> U(64 - WORD_BITS)).astype(np.int64)
    dup = np.array([_duplicate_lines(t) for t in texts], np.int64)
    return Counts(n_words, n_chars - spaces, count(marks & 2 > 0), dup, n_repeat, n_chars, classes, plain.text_of, buckets, np.bincount(plain.text_of, minlength=n))


def distances(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distances of every row of ``p`` to every row of ``q``; 1 if one is empty."""
    p, q = (x / np.maximum(x.sum(1, keepdims=True), 1e-300) for x in (p.astype(float), q.astype(float)))
    some = (p.sum(1) > 0)[:, None] & (q.sum(1) > 0)
    p, q = p[:, None, :], q[None]
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        kl = sum(np.where(x > 0, x * np.log2(x / m), 0).sum(2) for x in (p, q))
    return np.where(some, np.sqrt(np.maximum(kl, 0) / 2), 1.0)


@dataclass
class References:
    langs: list[str]
    classes: np.ndarray  # language x class
    common: np.ndarray  # language x N_COMMON buckets, -1 where there are fewer
    words: np.ndarray  # language x (N_COMMON + 1) mean shares; the last is all other words


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    for part in common.slices(batch):
        texts = part.column("text").to_pylist()
        for lo, hi in wordhash.cuts(texts):
            yield part.slice(lo, hi - lo), texts[lo:hi]


def _references(batches: Iterator[pa.RecordBatch], min_chars: int, min_words: int) -> Iterator[pa.RecordBatch]:
    """By language: documents and sums of their class histograms, documents and sums of their shares of words, as one array."""
    sums: dict[str, np.ndarray] = {}
    size = CLASSES + (1 << WORD_BITS) + 2
    for batch in batches:
        for part, texts in _pieces(batch):
            langs = part.column("lang").to_pylist()
            c = counts(texts)
            for lang in set(langs) - {None}:
                ours = np.array([x == lang for x in langs]) & ~c.failed
                out = sums.setdefault(lang, np.zeros(size))
                long = ours & (c.n_chars >= min_chars)
                out[0] += long.sum()
                out[2 : 2 + CLASSES] += (c.classes[long] / c.n_chars[long][:, None]).sum(0)
                long = ours & (c.n_plain >= min_words)
                out[1] += long.sum()
                at = long[c.text_of]
                out[2 + CLASSES :] += np.bincount(c.buckets[at], 1 / c.n_plain[c.text_of[at]], 1 << WORD_BITS)
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array([s.tolist() for s in sums.values()], pa.list_(pa.float64()))], names=["lang", "sums"])


def references(docs: DataFrame, min_chars: int = 200, min_words: int = 40, min_documents: int = 20) -> References:
    base = common.small_batches(docs).select(F.col("lang").cast("string").alias("lang"), common.whole_text().alias("text"))
    rows = base.mapInArrow(lambda b: _references(b, min_chars, min_words), "lang string, sums array<double>").select("lang", F.posexplode("sums").alias("at", "x"))
    rows = rows.where("x <> 0").groupBy("lang", "at").agg(F.sum("x").alias("x"))
    first = 2 + CLASSES
    # of the words only the most common ones of each language leave the cluster
    place = F.when(F.col("at") < first, F.lit(0)).otherwise(F.row_number().over(Window.partitionBy("lang", F.col("at") >= first).orderBy(F.desc("x"), "at")))
    found: dict[str, dict[int, float]] = {}
    for r in rows.withColumn("place", place).where(F.col("place") <= N_COMMON).orderBy("lang", "place", "at").collect():
        found.setdefault(r.lang, {})[r["at"]] = r.x
    langs, classes, top, words = [], [], [], []
    for lang, sums in found.items():
        if min(sums.get(0, 0), sums.get(1, 0)) >= min_documents:
            at = [k for k in sums if k >= first]
            share = np.array([sums[k] for k in at] + [0.0] * (N_COMMON - len(at))) / sums[1]
            langs.append(lang)
            classes.append([sums.get(2 + k, 0.0) for k in range(CLASSES)])
            top.append([k - first for k in at] + [-1] * (N_COMMON - len(at)))
            words.append([*share, max(0.0, 1 - share.sum())])
    return References(langs, np.array(classes).reshape(-1, CLASSES), np.array(top, np.int64).reshape(-1, N_COMMON), np.array(words).reshape(-1, N_COMMON + 1))


def word_histograms(c: Counts, ref: References, k: int) -> np.ndarray:
    """Of each text the numbers of the common words of language ``k``, and of all others."""
    bin_of = np.full(1 << WORD_BITS, N_COMMON)
    known = ref.common[k] >= 0
    bin_of[ref.common[k][known]] = np.flatnonzero(known)
    n = len(c.n_plain)
    return np.bincount(c.text_of * (N_COMMON + 1) + bin_of[c.buckets], minlength=n * (N_COMMON + 1)).reshape(n, -1)


def _rules(batches: Iterator[pa.RecordBatch], ref: References, bounds: dict) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in _pieces(batch):
            c = counts(texts)
            n = len(texts)
            by_class = by_word = np.zeros(n)
            has_class = has_word = np.zeros(n, bool)
            if ref.langs:
                has_class, has_word = c.n_chars >= bounds["min_chars"], c.n_plain >= bounds["min_words"]
                by_class = distances(c.classes, ref.classes).min(1)
                by_word = np.min([distances(word_histograms(c, ref, k), ref.words[k : k + 1])[:, 0] for k in range(len(ref.langs))], axis=0)
            kept = ~(c.failed | has_class & (by_class > bounds["max_class_distance"]) | has_word & (by_word > bounds["max_word_distance"]))
            whole = [pa.array(x, pa.int64()) for x in (c.n_words, c.word_chars, c.n_symbols, c.n_dup_lines, c.n_repeat)]
            measured = [pa.array(d, pa.float64(), mask=~has) for d, has in ((by_class, has_class), (by_word, has_word))]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *whole, pa.array(c.failed), pa.array(kept), *measured], names=[x.split()[0] for x in OUT.split(", ")])


def rules(docs: DataFrame, min_chars: int = 200, min_words: int = 40, min_documents: int = 20, max_class_distance: float = 0.25, max_word_distance: float = 0.37) -> DataFrame:
    """One row per input row: the base counts, the verdict and both distances (null under the minimum length)."""
    ref = references(docs, min_chars, min_words, min_documents)
    bounds = {"min_chars": min_chars, "min_words": min_words, "max_class_distance": max_class_distance, "max_word_distance": max_word_distance}
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.whole_text().alias("text"))
    return base.mapInArrow(lambda b: _rules(b, ref, bounds), OUT)


def op7_divergence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules(common.table(spark, sf_dir, "documents"))
