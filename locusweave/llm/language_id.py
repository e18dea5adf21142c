"""Language ID by averaged hashed subword embeddings and a linear softmax.

A text is the mean of the embeddings of its character 1- to 4-grams inside words (boundary included), hashed into ``BUCKETS``
rows; a linear softmax gives the language. Embeddings and softmax are trained together by stochastic gradient descent in numpy, in the tasks: the
sample - about ``per_lang_rows`` labelled documents of every language, drawn by a hash of id and text - is written once and dealt to at most ``SHARDS`` shards;
in an epoch each shard takes its minibatches from the same model, and the models are averaged. So a task holds one model and one minibatch, and the driver
models of one size, whatever the length of the texts and the number of languages. Each sampled document is seen whole and as a short window, so that
short texts are learned too. A temperature and the rejection bound are fitted on a fifth of the sample that training doesn't see, from sums of a fixed size.

As all of it is linear in the n-grams, prediction looks up one row of class scores per n-gram; whole texts are scored inside the tasks.

A text that is null or has no letter is ``und`` with score 0. A text whose calibrated probability is under the bound gets
``rejected`` true beside its best language. doc_id, null or repeated, is only passed on; equal rows are one row of the sample. Without any
labelled document every text is ``und``. An empty table gives an empty result. Other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, ngrams

BUCKETS = 1 << 15
SIZES = (1, 2, 3, 4)
OUT = "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean"


#: An epoch's minibatches are dealt to at most so many models that are averaged, one for each SHARD_ROWS texts; small samples are taken several times.
SHARDS, SHARD_ROWS, STEPS = 4, 2000, 600
DIM, BATCH = 16, 32
SAMPLE = "lang int, order long, kind int, buckets binary, shares binary"
PARTS = "n long, table binary, weights binary, bias binary"
TEMPERATURES = np.geomspace(0.05, 5, 40)
#: Bins of the probabilities of the right ones.
BINS = 1000


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray  # embedding of each bucket
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    bound: float = 0.0
    _scores: np.ndarray | None = None

    @property
    def scores(self) -> np.ndarray:
        """Class scores of each bucket's embedding; made once in each worker."""
        if self._scores is None:
            self._scores = self.table @ self.weights
        return self._scores


def features(text: str, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text's n-grams and their shares."""
    codes, _ = ngrams.code_points([text])
    found = np.concatenate([b[keep] for b, keep in ngrams.subwords(codes, letters, SIZES, BUCKETS)] or [np.zeros(0, np.int32)])
    buckets, n = np.unique(found, return_counts=True)
    return buckets.astype(np.int32), (n / max(1, len(found))).astype(np.float32)


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    letters = ngrams.letter_table()
    kinds = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
    for batch in batches:
        for part in common.slices(batch):
            rows = []
            for lang, order, text in zip(part.column("lang").to_pylist(), part.column("order").to_pylist(), part.column("text").to_pylist()):
                words = text.split()
                at = order % max(1, len(words) - 8)
                for kind, view in enumerate((text, " ".join(words[at : at + 8]))):
                    buckets, shares = features(view, letters)
                    if len(buckets):
                        rows.append((lang, order, kind, buckets.tobytes(), shares.tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=["lang", "order", "kind", "buckets", "shares"])


def sample(docs: DataFrame, per_lang_rows: int) -> tuple[list[str], DataFrame | None]:
    """The languages, and the written features of about ``per_lang_rows`` labelled documents of each; ``lang`` is the place in the list."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), common.whole_text().alias("text")).where("lang IS NOT NULL").where(~common.held_out())
    counts = base.groupBy("lang").count().collect()  # one row per language
    if not counts:
        return [], None
    langs = sorted(r.lang for r in counts)
    order = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30))
    most = {r.lang: int((1 << 30) * min(1.0, per_lang_rows / r["count"])) for r in counts}
    share = F.create_map(*(F.lit(x) for k, lang in enumerate(langs) for x in (lang, (k << 31) + most[lang])))
    known = base.withColumn("share", F.try_element_at(share, F.col("lang")))
    taken = known.select(F.shiftright("share", 31).cast("int").alias("lang"), order.alias("order"), F.pmod("share", F.lit(1 << 31)).alias("most"), "text").where("order < most")
    # equal rows are one; they are combined in the map tasks, before the shuffle
    one = taken.groupBy("lang", "order").agg(F.min("text").alias("text"))
    return langs, common.written(one.mapInArrow(_sampled, SAMPLE), "languages")


def step(table: np.ndarray, weights: np.ndarray, bias: np.ndarray, some: list[tuple[int, np.ndarray, np.ndarray]], rate: float) -> None:
    """One step of gradient descent, in place. ``some``: class, buckets and shares of each text of the minibatch."""
    y, sizes = np.array([r[0] for r in some]), [len(r[1]) for r in some]
    buckets, shares = np.concatenate([r[1] for r in some]), np.concatenate([r[2] for r in some])
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    hidden = np.add.reduceat(table[buckets] * shares[:, None], starts)
    p = _softmax(hidden @ weights + bias)
    p[np.arange(len(some)), y] -= 1
    back = p @ weights.T
    rate = rate / len(some)
    weights -= rate * hidden.T @ p
    bias -= rate * p.sum(0)
    order = np.argsort(buckets, kind="stable")
    buckets, text_of = buckets[order], np.repeat(np.arange(len(some)), sizes)[order]
    first = np.flatnonzero(np.concatenate(([True], buckets[1:] != buckets[:-1])))
    table[buckets[first]] -= np.add.reduceat(rate * BUCKETS**0.5 * shares[order][:, None] * back[text_of], first)


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for lang, buckets, shares in zip(*(batch.column(c) for c in ("lang", "buckets", "shares"))):
        yield lang.as_py(), np.frombuffer(buckets.as_py(), np.int32), np.frombuffer(shares.as_py(), np.float32)


def _epoch(batches: Iterator[pa.RecordBatch], model: Model, rate: float) -> Iterator[pa.RecordBatch]:
    """A shard's model after its minibatches, with the number of its rows. Shards that share a task follow each other in it."""
    names, kinds = [c.split()[0] for c in PARTS.split(", ")], (pa.int64(), *(pa.binary(),) * 3)
    some: list[tuple] = []
    shard, now, seen = None, (), 0

    def finished() -> Iterator[pa.RecordBatch]:
        if some:
            step(*now, some, rate)
            some.clear()
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([x], kind) for x, kind in zip((seen, *(a.tobytes() for a in now)), kinds)], names=names)

    for batch in batches:
        for k, row in zip(batch.column("shard").to_pylist(), _rows(batch)):
            if k != shard:
                yield from finished()
                shard, now, seen = k, (model.table.copy(), model.weights.copy(), model.bias.copy()), 0
            some.append(row)
            seen += 1
            if len(some) == BATCH:
                step(*now, some, rate)
                some.clear()
    yield from finished()


def _losses(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """Losses at every temperature, or, with a temperature, the right ones by their probability."""
    out = np.zeros(len(TEMPERATURES) if model.temperature < 0 else BINS + 1)
    for batch in batches:
        for y, buckets, shares in _rows(batch):
            z = shares @ model.scores[buckets] + model.bias
            if model.temperature < 0:
                out -= np.log(_softmax(z / TEMPERATURES[:, None])[:, y] + 1e-12)
            else:
                p = _softmax(z[None] / model.temperature)[0]
                if p.argmax() == y:
                    out[int(p.max() * BINS)] += 1
    yield pa.RecordBatch.from_arrays([pa.array(range(len(out)), pa.int32()), pa.array(out)], names=["at", "value"])


def _summed(rows: DataFrame, model: Model) -> np.ndarray:
    found = rows.mapInArrow(lambda b: _losses(b, model), "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).orderBy("at").collect()
    return np.array([r.value for r in found])


def train(docs: DataFrame, per_lang_rows: int = 1000, epochs: int = 6, rate: float = 1.0, seed: int = 7) -> Model | None:
    """Averaged minibatch SGD with a falling rate; calibration on every fifth document. None without labelled texts."""
    langs, rows = sample(common.small_batches(docs), per_lang_rows)
    n = rows.count() if rows is not None else 0
    if not n:
        return None
    shards = min(SHARDS, 1 + n // SHARD_ROWS)
    times = max(1, STEPS * BATCH * shards // (epochs * n))
    rng = np.random.default_rng(seed)
    model = Model(langs, rng.normal(0, 0.5, (BUCKETS, DIM)).astype(np.float32), rng.normal(0, 0.1, (DIM, len(langs))).astype(np.float32), np.zeros(len(langs), np.float32))
    fit = rows.where("order % 5 <> 0")
    fit = fit if fit.head(1) else rows
    for e in range(epochs):
        dealt = fit.withColumn("time", F.explode(F.sequence(F.lit(1), F.lit(min(times, STEPS))))) if times > 1 else fit.withColumn("time", F.lit(1))
        dealt = dealt.select("*", F.pmod(F.xxhash64("order"), F.lit(shards)).cast("int").alias("shard"), F.xxhash64("order", "kind", F.lit(e)).alias("turn"))
        dealt = dealt.repartitionById(shards, "shard").sortWithinPartitions("shard", "time", "turn", "lang", "kind").select("shard", "lang", "buckets", "shares")
        now = rate * (1 - e / epochs)
        parts = dealt.mapInArrow(lambda b, m=model, r=now: _epoch(b, m, r), PARTS).collect()  # SHARDS models
        share = np.array([p.n for p in parts], np.float32) / sum(p.n for p in parts)
        mean = lambda name, like: sum(w * np.frombuffer(p[name], np.float32) for w, p in zip(share, parts)).reshape(like.shape)
        model = Model(langs, mean("table", model.table), mean("weights", model.weights), mean("bias", model.bias))
    held = rows.where("order % 5 = 0")
    held = held if held.head(1) else fit
    model.temperature = -1.0
    model.temperature = float(TEMPERATURES[int(np.argmin(_summed(held, model)))])
    right = np.cumsum(_summed(held, model))
    # the bound that rejects as many of the wrong ones as it can while it keeps 99 % of the right ones
    if right[-1]:
        model.bound = min(0.9, int(np.searchsorted(right, 0.01 * right[-1], "right")) / BINS)
    return model


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


def logits(texts: list[str], model: Model, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class scores of each text and the number of its n-grams."""
    codes, starts = ngrams.code_points(texts)
    total, n = np.zeros((len(texts), len(model.langs))), np.zeros(len(texts))
    for buckets, keep in ngrams.subwords(codes, letters, SIZES, BUCKETS):
        at = starts[starts < len(buckets)]
        values = model.scores[buckets]
        values[~keep] = 0
        total[: len(at)] += np.add.reduceat(values, at, axis=0, dtype=np.float64)
        n[: len(at)] += np.add.reduceat(keep, at, dtype=np.int64)
    return total / np.maximum(n, 1)[:, None] + model.bias, n


def _predict(batches: Iterator[pa.RecordBatch], model: Model | None) -> Iterator[pa.RecordBatch]:
    letters = ngrams.letter_table()
    for batch in batches:
        for whole in common.slices(batch):
            for lo in range(0, len(whole), 512):
                part = whole.slice(lo, 512)
                texts = part.column("text").to_pylist()
                n = len(texts)
                langs, score, rejected = ["und"] * n, np.zeros(n), np.zeros(n, bool)
                if model:
                    z, grams = logits(texts, model, letters)
                    p = _softmax(z / model.temperature)
                    best = p.argmax(1)
                    known = grams > 0
                    langs = [model.langs[b] if k else "und" for b, k in zip(best, known)]
                    score = np.where(known, p.max(1), 0.0)
                    rejected = known & (score < model.bound)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(langs, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
                    names=["doc_id", "held_out", "lang_pred", "score", "rejected"],
                )


def identify(docs: DataFrame, per_lang_rows: int = 1000) -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score (calibrated probability), rejected."""
    model = train(docs, per_lang_rows)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.held_out().alias("held_out"), common.whole_text().alias("text"))
    return base.mapInArrow(lambda b: _predict(b, model), OUT)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(common.table(spark, sf_dir, "documents"))
