"""Toxicity: noisy-channel deobfuscation, then scoring of the restored text.

1. Character language model. Trigrams of the letters of all words, with the word boundary, are counted over all documents
   (numpy per batch, one sum in Spark). A model has 64 symbols, so at most 64 ** 3 counts at any input size. Beside them ``2 ** KNOWN_BITS`` hashed
   counts tell common words from fragments.
2. Restoring. A token that may be disguised - leetspeak or marks inside a word, letters spaced out, letters repeated three times or
   more - spans one lattice with the arcs of all kinds: a symbol may be the letter it looks like, a mark to be left out, a masked vowel (``*``), or a boundary; a run may be
   one or two letters; a space may be left out. A token may touch quotes and punctuation, end in a look-alike, and mix disguises; a doubled letter alone is no disguise.
   Viterbi decoding finds the path with the best channel and language model probability. A token with one path is
   itself, so only tokens with a choice are decoded. Then a space between two short fragments, neither of them a common word, may be left out; this choice
   touches five trigrams only, so it is made for all spaces at once in numpy. Whole texts are restored.
3. Score. A word's evidence is the lower bound of the log-odds (by document) of the word and of its first four and five bytes among labelled
   documents. A text's score is a logistic of its strongest evidence. Lexicon and logistic are fitted on at most about ``max_labelled`` labelled
   documents that aren't held out, drawn by a hash of the id; the sample is restored and written once. The logistic sees each document's evidence
   under a lexicon of the other half of the sample, so that its probabilities hold for new documents. The lexicon keeps every entry with evidence.

Labels, lang, source and doc_id aren't inputs of a score. Null text counts as empty and gets the bias alone, like a text without words.
doc_id, null or repeated, is only passed on. Without labels, every text gets score 0. An empty table gives an empty result. Other
columns of the input are not read; ``keep_clean`` keeps them. Label rows with null id or label are ignored; of several labels of an id the largest counts; of
the rows of one id one is in the sample.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, ngrams, wordhash

#: What a character may stand for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "*": "aeiou", "#": "h"}
#: Costs in nats of the channel: a look-alike, a mark left out (cheap if it looks like no letter), a boundary put for a mark, letters of a run left
#: out, the space between spaced letters kept, one letter of two left out, punctuation that looks like a letter left out before and after a word. Leaving out must cost more than a letter does under the model, or short outputs win.
LOOK, DROP, DROP_LOOK, BREAK, RUN, KEEP, DOUBLE, HEAD, TAIL = 1.0, 0.5, 9.0, 7.0, 0.5, 4.0, 3.0, 4.0, 2.0
#: A vowel for a mask between letters, the space after a first or before a last single letter that is a word, the space left out between fragments.
MASK, KEEP_WORD, JOIN = 2.6, 1.5, 2.0
#: Hashed counts of words, and the share of all words from which one is common. Fragments that are joined have so many letters at most, together and the shorter.
KNOWN_BITS, KNOWN_SHARE = 18, 2e-5
JOINED, FRAGMENT = 10, 4
#: Look-alikes that are punctuation at a word's edge.
WEAK = "!|+(*"
SYMBOLS = 64

WORD = re.compile(r"[^\W\d_]+")
#: A word with marks or digits inside, before or after it; after it only look-alikes.
MARKED = re.compile(r"(?<![^\W\d_])[^\W\d_]+(?:(?:[^\w\s]|[\d_])+[^\W\d_]\S*|[@$0-9!|+(*#]+)|(?<![^\W_])(?<![@$!|+(*#])[@$0-9!|+(*#]+[^\W\d_]\S*")
#: Single letters or look-alikes, set apart by marks or spaces.
SPACED = re.compile(r"(?<![^\W_])(?:[^\W\d_]|[0-9@$!|+(#])(?:[\s.\-_*]+(?:[^\W\d_]|[0-9@$!|+(#])){2,}(?![^\W_])")
RUNNING = re.compile(r"(.)\1{2,}")
LOOKS = np.array(sorted(map(ord, LEET)))
SEPARATORS = np.array([c for c in range(0x3001) if chr(c).isspace() or chr(c) in ".-_*"])
#: Distinct tokens that a worker remembers before it starts anew.
MEMORY = 200_000


@cache
def symbol_table() -> np.ndarray:
    """Symbol of each code point: 0 for what isn't a letter, 1 to 26 for a to z, 27 to 63 shared by all other letters."""
    codes = np.arange(0x110000, dtype=np.int64)
    out = np.where(ngrams.letter_table(), 27 + codes % 37, 0)
    out[97:123] = np.arange(1, 27)
    return out.astype(np.int32)


@dataclass
class LanguageModel:
    logp: np.ndarray  # log probability of a symbol after two others
    known: np.ndarray | None = None  # whether a bucket of words is common


def _trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigrams, and after them the buckets of words."""
    symbols = symbol_table()
    total = np.zeros(SYMBOLS**3 + (1 << KNOWN_BITS), np.int64)
    for batch in batches:
        for part in common.slices(batch):
            texts = part.column("text").to_pylist()
            codes, _ = ngrams.code_points(["\0" + t for t in texts])
            s = symbols[codes]
            if len(s) >= 3:
                key = s[:-2] * (SYMBOLS * SYMBOLS)
                key += s[1:-1] * SYMBOLS
                key += s[2:]
                total[: SYMBOLS**3] += np.bincount(key, minlength=SYMBOLS**3)
            for at in _sliced(texts):
                h = wordhash.words([t.lower().encode("utf-8", "surrogatepass") for t in texts[at]]).hashes()
                total[SYMBOLS**3 :] += np.bincount((h >> wordhash.U(64 - KNOWN_BITS)).astype(np.int64), minlength=1 << KNOWN_BITS)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["gram", "n"])


def language_model(docs: DataFrame) -> LanguageModel:
    """Interpolated trigrams and common words; counts are over all documents."""
    rows = common.small_batches(docs).select(common.whole_text().alias("text")).mapInArrow(_trigrams, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    both = np.zeros(SYMBOLS**3 + (1 << KNOWN_BITS))
    both[rows["gram"].to_numpy(np.int64)] = rows["n"].to_numpy(np.float64)
    return modelled(both)


def modelled(counts: np.ndarray) -> LanguageModel:
    n, words = counts[: SYMBOLS**3].reshape(SYMBOLS, SYMBOLS, SYMBOLS), counts[SYMBOLS**3 :]
    n[:, 0, 0] = 0  # a boundary is one symbol
    two, one = n.sum(0), n.sum((0, 1))
    p1 = (one + 1) / (one.sum() + SYMBOLS)
    p2 = two / np.maximum(two.sum(1, keepdims=True), 1)
    p3 = n / np.maximum(n.sum(2, keepdims=True), 1)
    return LanguageModel(np.log(0.8 * p3 + 0.15 * p2 + 0.05 * p1).astype(np.float32), words > KNOWN_SHARE * max(1.0, words.sum()))


@dataclass
class Decoder:
    """Restores texts under a language model."""

    model: LanguageModel
    memory: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.logp, self.letters = self.model.logp.tolist(), ngrams.letter_table()
        self.alone = {c for c in "abcdefghijklmnopqrstuvwxyz" if self.model.known is not None and self.model.known[int(wordhash.words([c.encode()]).hashes()[0] >> wordhash.U(64 - KNOWN_BITS))]}

    @staticmethod
    def _symbol(c: str) -> int:
        o = ord(c)
        return o - 96 if 97 <= o <= 122 else 27 + o % 37 if c.isalpha() else 0

    def lattice(self, token: str, spaced: bool) -> list[list[tuple[str, float]]]:
        """For each position the texts that may stand there, with their costs."""
        out: list[list[tuple[str, float]]] = []
        strong = [k for k, c in enumerate(token) if c.isalnum() or c in LEET and c not in WEAK] or [0]
        i = 0
        while i < len(token):
            c, j = token[i], i + 1
            while j < len(token) and token[j] == c:
                j += 1
            run = j - i
            alone = not spaced or c != "*" or 0 < i and j < len(token) and not token[i - 1].isalnum() and not token[j].isalnum()
            if c.isalpha():
                out.append([(c, 0.0)] if run == 1 else [(c + c, 0.0), (c, DOUBLE)] if run == 2 else [(c, RUN), (c + c, 2 * RUN)])
            elif spaced and (c not in LEET or not alone):
                word = i == 1 and token[0] in self.alone or j == len(token) - 1 and token[-1] in self.alone
                mask = [(x, MASK) for x in LEET["*"]] if c == "*" else []
                out.append([("", 0.0), (" ", KEEP_WORD if word else KEEP), *mask])
            else:
                one = LEET.get(c, "")
                looks = [(x, LOOK) for x in one] if run == 1 else [(x + y, LOOK) for x in one for y in one] + [(x, LOOK + (DOUBLE if run == 2 else RUN)) for x in one]
                edge = TAIL if i > strong[-1] else HEAD if i < strong[0] else DROP_LOOK
                out.append([*looks, ("", (edge if c in WEAK else DROP_LOOK) if looks else DROP), (" ", BREAK)])
            i = j
        return out

    def decode(self, token: str, spaced: bool = False) -> str:
        key = "\n" + token if spaced else token  # one token may be decoded both ways
        known = self.memory.get(key)
        if known is not None:
            return known
        paths = {(0, 0): (0.0, None)}  # last two symbols: best log probability, path backwards as linked pairs
        logp, symbol = self.logp, self._symbol
        for choices in [*self.lattice(token, spaced), [(" ", 0.0)]]:
            step: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (score, path) in paths.items():
                for text, cost in choices:
                    x, y, total = a, b, score - cost
                    for c in text:
                        s = symbol(c)
                        if not (s == 0 and y == 0):
                            total += logp[x][y][s]
                            x, y = y, s
                    at = step.get((x, y))
                    if at is None or total > at[0]:
                        step[x, y] = (total, (text, path) if text else path)
            paths = step
        path, parts = max(paths.values(), key=lambda p: p[0])[1], []
        while path:
            parts.append(path[0])
            path = path[1]
        restored = "".join(reversed(parts)).strip()
        if len(self.memory) >= MEMORY:
            self.memory.clear()
        self.memory[key] = restored
        return restored

    def restore(self, text: str, spaced: bool = True, marked: bool = True, repeated: bool = True) -> str:
        """The lower-cased text with every disguised token decoded. The kinds of disguise that a text is known not to have may be left out."""
        text = self._decoded(text.lower(), spaced, marked, repeated)
        return text if not text or self.model.known is None else self.joined([text.encode("utf-8", "surrogatepass")])[0].decode("utf-8", "surrogatepass")

    def _decoded(self, text: str, spaced: bool, marked: bool, repeated: bool) -> str:
        if spaced:
            text = SPACED.sub(lambda m: self.decode(m[0], True) if WORD.search(m[0]) else m[0], text)
        if marked:
            text = MARKED.sub(lambda m: self.decode(m[0]), text)
        if repeated:
            text = WORD.sub(lambda m: self.decode(m[0]) if RUNNING.search(m[0]) else m[0], text)
        return text

    def joined(self, texts: list[bytes]) -> list[bytes]:
        """Spaces between fragments of words are left out where the language model gains more than that costs."""
        found = wordhash.words(texts)
        raw = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
        starts, ends = found.starts, found.ends
        size = ends - starts
        short = np.minimum(size[:-1], size[1:])
        pair = (starts[1:] == ends[:-1] + 1) & (raw[ends[:-1]] == 32) & (short <= FRAGMENT) & (size[:-1] + size[1:] <= JOINED) & (size[:-1] + size[1:] >= 4)
        at = np.flatnonzero(pair)
        if not len(at):
            return texts
        letters = np.concatenate(([0], np.cumsum((raw >= 97) & (raw <= 122))))
        plain = letters[ends] - letters[starts] == size
        rare = plain & ~self.model.known[(found.hashes() >> wordhash.U(64 - KNOWN_BITS)).astype(np.int64)]
        at = at[rare[at] & rare[at + 1]]
        symbol = np.where((raw >= 97) & (raw <= 122), raw.astype(np.int64) - 96, 0)
        b, c = symbol[ends[at] - 1], symbol[starts[at + 1]]
        a, d = np.where(size[at] > 1, symbol[ends[at] - 2], 0), np.where(size[at + 1] > 1, symbol[np.minimum(starts[at + 1] + 1, len(raw) - 1)], 0)
        lp = self.model.logp
        gain = lp[a, b, c] + lp[b, c, d] - (lp[a, b, 0] + lp[b, 0, c] + lp[0, c, d])
        gone = ends[at[gain > JOIN]]
        if not len(gone):
            return texts
        stays = np.ones(len(raw), bool)
        stays[gone] = False
        cut = np.cumsum([len(t) + 1 for t in texts])
        cut -= np.searchsorted(gone, cut)
        rest = raw[stays].tobytes()
        return [rest[lo : hi - 1] for lo, hi in zip([0, *cut[:-1]], cut)]

    def restored(self, texts: list[str]) -> list[bytes]:
        """As UTF-8. Which kinds of disguise a text may have is told in numpy for all texts at once; most have none."""
        if not texts:
            return []
        codes, starts = ngrams.code_points(texts)
        letter = self.letters[codes]
        look = np.isin(codes, LOOKS)
        marked, repeated, spaced = (np.zeros(len(codes), bool) for _ in range(3))
        marked[:-1] = letter[:-1] & look[1:]  # a look-alike after a letter
        marked[:-1] |= ~letter[:-1] & letter[1:] & (codes[:-1] != 32) & (codes[:-1] > 13)  # a mark before a letter
        same = letter[:-1] & (codes[:-1] == codes[1:])
        repeated[:-2] = same[:-1] & same[1:]  # three of a letter
        at = np.flatnonzero(~np.isin(codes, SEPARATORS))
        unit = (letter | look)[at]
        unit[:-2] &= unit[1:-1] & unit[2:]
        apart = at[1:] - at[:-1] > 1
        spaced[at[:-2][unit[:-2] & apart[:-1] & apart[1:]]] = True  # three units set apart
        kinds = [np.add.reduceat(x, starts, dtype=np.int64) > 0 for x in (spaced, marked, repeated)]
        plain = [(self._decoded(t.lower(), *k) if any(k) else t.lower()).encode("utf-8", "surrogatepass") for t, *k in zip(texts, *(x.tolist() for x in kinds))]
        return plain if self.model.known is None else self.joined(plain)


#: Beginnings of words that are features beside the whole words, in bytes.
BEGINNINGS = (4, 5)


def word_features(texts: list[bytes]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Text number of each word; hashes of each word and of its beginnings."""
    found = wordhash.words(texts)
    return found.text_of, [found.hashes(), *(found.hashes(n) + wordhash.U(n) for n in BEGINNINGS)]


@dataclass
class Model:
    features: np.ndarray  # hashes, sorted
    bounds: np.ndarray  # their evidence
    weights: np.ndarray  # bias, strongest word, second strongest, sum of all other words (log); none but the bias is negative
    seen: np.ndarray | None = None

    def evidence(self, texts: list[bytes]) -> np.ndarray:
        """For each text its strongest and second strongest word and log(1 + the evidence of its other different words): none is less with a word more."""
        out = np.zeros((len(texts), 3))
        text_of, hashes = word_features(texts)
        if not len(text_of) or not len(self.features):
            return out
        if self.seen is None:  # a filter before the exact search
            self.seen = np.zeros(1 << 20, bool)
            self.seen[(self.features >> wordhash.U(44)).astype(np.int64)] = True
        best = np.zeros(len(text_of))
        for h in hashes:
            at = np.flatnonzero(self.seen[(h >> wordhash.U(44)).view(np.int64)])
            i = np.searchsorted(self.features, h[at]).clip(max=len(self.features) - 1)
            best[at] = np.maximum(best[at], np.where(self.features[i] == h[at], self.bounds[i], 0))
        at = np.flatnonzero(best)
        rows = sorted(set(zip(text_of[at].tolist(), hashes[0][at].tolist(), best[at].tolist())), key=lambda r: -r[2])
        for text, _, e in rows:
            row = out[text]
            row[0 if row[0] == 0 else 1 if row[1] == 0 else 2] += e
        out[:, 2] = np.log1p(out[:, 2])
        return out

    def scores(self, texts: list[bytes]) -> np.ndarray:
        z = self.weights[0] + self.evidence(texts) @ self.weights[1:]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _sliced(texts: list[str]) -> Iterator[slice]:
    lo = total = 0
    for i, t in enumerate(texts):
        if i > lo and total + len(t) > wordhash.SLICE_BYTES:
            yield slice(lo, i)
            lo, total = i, 0
        total += len(t)
    if lo < len(texts):
        yield slice(lo, len(texts))


def _restored(batches: Iterator[pa.RecordBatch], lm: LanguageModel) -> Iterator[pa.RecordBatch]:
    decoder = Decoder(lm)
    for batch in batches:
        for part in common.slices(batch):
            texts = part.column("text").to_pylist()
            whole = [t for s in _sliced(texts) for t in decoder.restored(texts[s])]
            yield pa.RecordBatch.from_arrays([pa.array(whole, pa.binary()), part.column("toxic"), part.column("half")], names=["text", "toxic", "half"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each label and half that have a feature, as partial counts. Texts are restored ones."""
    parts, held = [], 0

    def flush() -> pa.RecordBatch:
        h, kind = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
        found, at = np.unique(h, return_inverse=True)
        n = np.bincount(at * 4 + kind, minlength=4 * len(found)).reshape(-1, 4)
        parts.clear()
        return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), *(pa.array(n[:, k]) for k in range(4))], names=["feature", *COUNTS])

    for batch in batches:
        for part in common.slices(batch):
            texts, labels = part.column("text").to_pylist(), part.column("toxic").to_numpy() + 2 * part.column("half").to_numpy()
            for s in _sliced(texts):
                text_of, hashes = word_features(texts[s])
                for h in hashes:
                    order = np.lexsort((h, text_of))
                    h, owner = h[order], text_of[order]
                    new = np.ones(len(h), bool)
                    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
                    parts.append((h[new], labels[s][owner[new]].astype(np.int64)))
                    held += int(new.sum())
            if held > 4_000_000:
                yield flush()
                held = 0
    if parts:
        yield flush()


def _evidenced(batches: Iterator[pa.RecordBatch], halves: tuple[Model, Model]) -> Iterator[pa.RecordBatch]:
    """Evidence of each restored text under the lexicon of the other half."""
    for batch in batches:
        for part in common.slices(batch):
            texts, half = part.column("text").to_pylist(), part.column("half").to_numpy()
            rows = np.zeros((len(texts), 3))
            for k in (0, 1):
                at = np.flatnonzero(half == k)
                some = [texts[i] for i in at]
                for s in _sliced(some):
                    rows[at[s]] = halves[1 - k].evidence(some[s])
            yield pa.RecordBatch.from_arrays([part.column("toxic"), *(pa.array(rows[:, i]) for i in range(3))], names=["toxic", "a", "b", "c"])


def logistic(x: np.ndarray, y: np.ndarray, counts: np.ndarray | None = None, ridge: float = 1e-2) -> np.ndarray:
    """Projected Newton steps for a logistic regression with a bias in front, whose other weights aren't negative: more evidence never lowers a score. ``counts``: how often each row counts."""
    n = np.ones(len(x)) if counts is None else counts
    x = np.column_stack([np.ones(len(x)), x])
    least = np.array([-np.inf] + [0.0] * (x.shape[1] - 1))
    w = np.zeros(x.shape[1])
    loss = lambda w: n @ np.logaddexp(0, x @ w) - (n * y) @ (x @ w) + ridge * (w @ w) / 2
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (n * (p - y)) + ridge * w
        free = (w > least) | (gradient < 0)  # a weight at its bound stays there while the loss would fall beyond it
        if np.abs(gradient[free]).max(initial=0) < 1e-6:
            break
        hessian = (x * (n * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.zeros(len(w))
        step[free] = np.linalg.solve(hessian[np.ix_(free, free)], gradient[free])
        now, size = loss(w), 1.0
        while size > 1e-6 and loss(np.maximum(w - size * step, least)) > now:
            size /= 2
        w = np.maximum(w - size * step, least)
    return w


#: How much a toxic document's strongest word alone counts beside the document, in fitting the logistic.
ALONE = 0.25

#: Clean and toxic documents of the first half of the sample, then of the second.
COUNTS = ("clean0", "toxic0", "clean1", "toxic1")


def lexicon(features: np.ndarray, clean: np.ndarray, toxic: np.ndarray, n_clean: float, n_toxic: float) -> Model:
    """Features whose lower bound of the log-odds is over one half, with these bounds."""
    t, c = toxic + 0.5, clean + 0.5
    bound = np.log(t / (n_toxic + 1 - t)) - np.log(c / (n_clean + 1 - c)) - 2 * np.sqrt(1 / t + 1 / c)
    at = np.flatnonzero((toxic >= 3) & (bound > 0.5))
    at = at[np.argsort(features[at])]
    return Model(features[at], bound[at], np.zeros(4))


def fit(docs: DataFrame, labels: DataFrame, lm: LanguageModel, max_labelled: int = 40_000) -> Model | None:
    """Lexicon and logistic from a bounded sample of the labelled documents that aren't held out."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(~common.held_out())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = known.count()
    if not n:
        return None
    order = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    taken = known.where(order < int((1 << 30) * min(1.0, max_labelled / n)))  # about max_labelled narrow rows at most
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.whole_text().alias("text"))
    one = base.join(F.broadcast(taken), "doc_id").groupBy("doc_id", "toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    half = F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2)).cast("int")
    sample = common.written(one.select("text", "toxic", half.alias("half")).mapInArrow(lambda b: _restored(b, lm), "text binary, toxic int, half int"), "toxic-sample")
    size = np.zeros(4)
    for r in sample.groupBy("toxic", "half").agg(F.count(F.lit(1)).alias("n")).collect():
        size[r.toxic + 2 * r.half] = r.n
    if not (size[0] + size[2]) or not (size[1] + size[3]):
        return None
    counts = sample.mapInArrow(_counted, "feature long, " + ", ".join(f"{c} long" for c in COUNTS)).groupBy("feature").agg(*(F.sum(c).alias(c) for c in COUNTS))
    strong = counts.where("toxic0 + toxic1 >= 3 AND (toxic0 + toxic1) * {} > (clean0 + clean1) * {}".format(float(size[0] + size[2]), float(size[1] + size[3]))).toPandas()
    features = strong["feature"].to_numpy(np.int64).view(np.uint64)
    c0, t0, c1, t1 = (strong[c].to_numpy(np.float64) for c in COUNTS)
    halves = lexicon(features, c0, t0, size[0], size[1]), lexicon(features, c1, t1, size[2], size[3])
    model = lexicon(features, c0 + c1, t0 + t1, size[0] + size[2], size[1] + size[3])
    found = sample.mapInArrow(lambda b: _evidenced(b, halves), "toxic int, a double, b double, c double").toPandas()
    x, y = found[["a", "b", "c"]].to_numpy(), found["toxic"].to_numpy(np.float64)
    # labelled texts hold several such words as a rule; each toxic one also counts, in part, with its strongest word alone
    alone = x[(y == 1) & (x[:, 0] > 0)] * [1, 0, 0]
    model.weights = logistic(np.concatenate([x, alone]), np.concatenate([y, np.ones(len(alone))]), np.repeat([1, ALONE], [len(x), len(alone)]))
    return model


def scorer(lm: LanguageModel, model: Model | None) -> Column:
    """A pandas UDF of the text; the other columns of a row stay in the JVM."""
    held: list[Decoder] = []

    def score(texts: pd.Series) -> pd.Series:
        if model is None:
            return pd.Series(np.zeros(len(texts)))
        if not held:
            held.append(Decoder(lm))
        whole = texts.tolist()
        return pd.Series(np.concatenate([model.scores(held[0].restored(whole[s])) for s in _sliced(whole)] or [np.zeros(0)]))

    return F.pandas_udf(score, "double")


def fitted_scorer(docs: DataFrame, labels: DataFrame, **options: int) -> Column:
    lm = language_model(docs)
    return scorer(lm, fit(docs, labels, lm, **options))


def score(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **options: int) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted."""
    udf = fitted_scorer(docs, labels, **options)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.held_out().alias("held_out"), udf(common.whole_text()).alias("score"))
    return base.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **options: int) -> DataFrame:
    """The rows whose score is under the threshold, with all their columns."""
    udf = fitted_scorer(docs, labels, **options)
    return docs.where(udf(common.whole_text()) < threshold)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))
