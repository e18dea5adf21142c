"""Soft-membership mixing of documents to target weights of domains.

1. A softmax over hashed character features is trained in numpy on a bounded sample of a labelled table: about ``per_domain_rows``
   documents of every domain, drawn by a hash of the id, fewer of each where that would be more than ``max_rows`` in all. It gives each document a
   posterior over domains; no domain is left out.
2. A document's tokens are its white-space words. Domain k holds ``sum(tokens * posterior_k)`` expected tokens. The default target
   raises the shares of these totals to the power ``alpha`` and scales them so that no domain has to shrink; ``pinned`` domains keep their share.
   If a rate has a least value, the scale is the smallest for which rates that are linear in the posteriors meet the target, so that it can be met.
3. Document rates >= ``min_rate`` (0 by default) minimise ``sum_k (sum_d rate_d tokens_d posterior_dk / target_k - 1) ** 2`` by accelerated projected
   gradients, preconditioned by tokens, from rate 1. A gradient depends on one number per domain, so an iteration is one sum over the
   documents in Spark; a document's rate follows from the list of these numbers, and no table of rates is rewritten.
4. A document is taken ``floor(rate + u)`` times, u being a hash of its id and text in [0, 1).

What the rates leave open is returned: ``residual`` is the relative gap of each domain's total to its target. A gap above ``flag_above`` is
warned of, and ``mix`` has it in the column ``target_gap``; with ``strict`` it is an error.

Null text counts as empty: no tokens, rate 1. Rows with a null label aren't used for training. Without labels all documents are one
domain. doc_id, null or repeated, is only passed on, beside its part in u; of the rows of one id one is in the sample. An empty table gives an
empty result. Rows keep all their columns in ``resampled``, whatever their names.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

DIM = 2048
#: A weight of zero counts as this share.
LEAST_SHARE = 1e-4
SLICE = 256


def features(texts: list[str]) -> np.ndarray:
    """Square roots of the shares of hashed byte trigrams; case and marks count."""
    out = np.zeros((len(texts), DIM), np.float32)
    for i, t in enumerate(texts):
        b = np.frombuffer(t.encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
        if len(b) >= 3:
            h = (b[:-2] * np.uint32(0x01000193) + b[1:-1]) * np.uint32(0x01000193) + b[2:]
            n = np.bincount(h * np.uint32(0x9E3779B1) >> np.uint32(32 - 11), minlength=DIM)
            out[i] = np.sqrt(n / n.sum())
    return out


@dataclass
class Classifier:
    domains: list[str]
    weights: np.ndarray
    bias: np.ndarray

    def posteriors(self, texts: list[str]) -> np.ndarray:
        z = features(texts) @ self.weights + self.bias
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for whole in common.slices(batch):
            for lo in range(0, len(whole), SLICE):
                part = whole.slice(lo, SLICE)
                x = features(part.column("text").to_pylist()).astype(np.float16)
                yield pa.RecordBatch.from_arrays([part.column("domain"), part.column("order"), pa.array([r.tobytes() for r in x], pa.binary())], names=["domain", "order", "x"])


def train(docs: DataFrame, labelled: DataFrame, per_domain_rows: int = 600, max_rows: int = 20_000, epochs: int = 200) -> Classifier:
    """``labelled``: doc_id, domain. Softmax regression by full gradient steps with momentum, on about per_domain_rows documents of each domain."""
    common.small_batches(docs)
    known = labelled.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("domain").cast("string").alias("domain")).where("doc_id IS NOT NULL AND domain IS NOT NULL")
    known = known.groupBy("doc_id").agg(F.min("domain").alias("domain"))
    counts = known.groupBy("domain").count().collect()  # one row per domain
    one = Classifier(["all"], np.zeros((DIM, 1), np.float32), np.zeros(1, np.float32))
    if not counts:
        return one
    each = min(per_domain_rows, max(1, max_rows // len(counts)))
    order = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    share = F.create_map(*(F.lit(x) for r in counts for x in (r.domain, int((1 << 30) * min(1.0, each / r["count"])))))
    taken = known.withColumn("order", order).where(F.col("order") < F.try_element_at(share, F.col("domain")))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.whole_text().alias("text"))
    # one text of each id, chosen in the map tasks
    sample = base.join(F.broadcast(taken), "doc_id").groupBy("doc_id", "domain", "order").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    sample = sample.select("domain", "order", "text").mapInArrow(_featured, "domain string, order long, x binary")
    rows = sorted(sample.collect(), key=lambda r: (r.order, r.x))  # about max_rows vectors of one size at most
    if not rows:
        return one
    domains = sorted({r.domain for r in rows})
    x = np.array([np.frombuffer(r.x, np.float16) for r in rows], np.float32)
    y = np.zeros((len(rows), len(domains)), np.float32)
    y[np.arange(len(rows)), [domains.index(r.domain) for r in rows]] = 1
    prior = y.mean(0)
    model = Classifier(domains, np.zeros((DIM, len(domains)), np.float32), np.log(prior))
    speed = np.zeros_like(model.weights)
    for _ in range(epochs):
        z = x @ model.weights + model.bias
        p = np.exp(z - z.max(1, keepdims=True))
        p = p / p.sum(1, keepdims=True) - y
        speed = 0.9 * speed - 2.0 * (x.T @ p / len(x) + 1e-5 * model.weights)
        model.weights += speed
        model.bias -= 0.5 * p.mean(0)
    return model


@dataclass
class Rates:
    """A document's rate from its posterior and the numbers of all iterations so far."""

    target: np.ndarray
    step: float
    least: float
    errors: list[np.ndarray] = field(default_factory=list)
    residual: dict[str, float] = field(default_factory=dict)

    @property
    def gap(self) -> float:
        return max(self.residual.values(), default=0.0)

    def points(self, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rates after the iterations so far, and the point at which the next gradient is taken."""
        q = p / self.target
        rate = point = np.maximum(np.ones(len(p)), self.least)
        momentum = 1.0
        for e in self.errors:
            new = np.maximum(self.least, point - self.step * (q @ e))
            after = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
            point = new + (momentum - 1) / after * (new - rate)
            rate, momentum = new, after
        return rate, point


def _sums(batches: Iterator[pa.RecordBatch], k: int, rates: Rates | None) -> Iterator[pa.RecordBatch]:
    """Expected tokens by domain at the next point and at the rates; without rates, the totals and their products."""
    total = np.zeros(k + k * k) if rates is None else np.zeros(2 * k)
    for batch in batches:
        p = batch.column("p").flatten().to_numpy(zero_copy_only=False).reshape(-1, k).astype(np.float64)
        n = batch.column("n_tokens").to_numpy().astype(np.float64)
        if rates is None:
            total += np.concatenate([n @ p, ((p * n[:, None]).T @ p).ravel()])
        else:
            rate, point = rates.points(p)
            total += np.concatenate([(n * point) @ p, (n * rate) @ p])
    yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], names=["at", "value"])


def _summed(table: DataFrame, k: int, rates: Rates | None) -> np.ndarray:
    rows = table.select("p", "n_tokens").mapInArrow(lambda b: _sums(b, k, rates), "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(k + k * k if rates is None else 2 * k)
    for r in rows:
        out[r.at] = r.value
    return out


def _posteriors(batches: Iterator[pa.RecordBatch], model: Classifier) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for whole in common.slices(batch):
            for lo in range(0, len(whole), SLICE):
                part = whole.slice(lo, SLICE)
                texts = part.column("text").to_pylist()
                p = model.posteriors(texts).astype(np.float32)
                flat = pa.ListArray.from_arrays(pa.array(np.arange(0, p.size + 1, p.shape[1], dtype=np.int32)), pa.array(p.ravel()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("u"), pa.array([len(t.split()) for t in texts], pa.int64()), flat], names=["doc_id", "u", "n_tokens", "p"])


def _uniform() -> Column:
    return F.pmod(F.xxhash64(F.lit("mix"), F.col("doc_id").cast("long"), common.whole_text()), F.lit(1 << 40)) / float(1 << 40)


def targets(have: np.ndarray, square: np.ndarray, domains: list[str], weights: dict[str, float] | None, pinned: tuple[str, ...], alpha: float, least: float) -> np.ndarray:
    """Expected tokens that each domain is to have. ``square``: sums of tokens times products of posteriors."""
    natural = have / have.sum()
    if weights is not None and (unknown := sorted(set(weights) - set(domains))):
        raise ValueError(f"weights of domains that have no labelled document: {unknown}")
    share = natural**alpha if weights is None else np.maximum([weights.get(d, 0.0) for d in domains], 0.0)
    held = np.array([d in pinned for d in domains])
    if held.any() and not held.all():
        share = np.where(held, natural, share * (1 - natural[held].sum()) / max(share[~held].sum(), 1e-12))
    share = np.maximum(share / share.sum(), LEAST_SHARE)
    target = share * (have / share)[share > LEAST_SHARE].max()
    if least > 0:
        for scale in 1.01 ** np.arange(141):  # up to four times
            rise = np.linalg.lstsq(square, scale * target - least * have, rcond=None)[0]
            if rise.min() >= -1e-9 * max(1.0, abs(rise).max()):
                return scale * target
    return target


def fit_rates(
    table: DataFrame, domains: list[str], weights: dict[str, float] | None = None, pinned: tuple[str, ...] = (), alpha: float = 0.7, min_rate: float = 0.0,
    tolerance: float = 1e-3, max_iterations: int = 200, flag_above: float = 0.01, strict: bool = False,
) -> Rates | None:
    """``table``: n_tokens, p. ``weights``: target shares of the domains; by default the natural shares to the power alpha.

    It ends when every total is within ``tolerance`` of its target, or nothing moves any more. None if there are no tokens.
    """
    k = len(domains)
    first = _summed(table, k, None)
    have, square = first[:k], first[k:].reshape(k, k)
    if not have.sum() > 0:
        return None
    have = np.maximum(have, 1e-9 * have.sum())
    target = targets(have, square, domains, weights, pinned, alpha, min_rate)
    step = 1 / np.linalg.eigvalsh(square / np.outer(target, target)).max()
    rates, best, idle = Rates(target, step, min_rate), np.inf, 0
    for done in range(max_iterations + 1):
        sums = _summed(table, k, rates)
        gap = np.abs(sums[k:] / target - 1)
        idle = 0 if gap.max() < 0.99 * best else idle + 1
        best = min(best, gap.max())
        if gap.max() < tolerance or idle == 10 or done == max_iterations:
            break
        rates.errors.append(sums[:k] / target - 1)
    rates.residual = dict(zip(domains, gap.tolist()))
    if rates.gap > flag_above:
        said = "targets not met: " + ", ".join(f"{d} {g:.1%}" for d, g in rates.residual.items() if g > flag_above)
        if strict:
            raise ValueError(said)
        warnings.warn(said, stacklevel=2)
    return rates


def posterior_table(docs: DataFrame, model: Classifier) -> DataFrame:
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _uniform().alias("u"), common.whole_text().alias("text"))
    return common.written(base.mapInArrow(lambda b: _posteriors(b, model), "doc_id long, u double, n_tokens long, p array<float>"), "posteriors")


def _rated(batches: Iterator[pa.RecordBatch], domains: list[str], rates: Rates | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        p = batch.column("p").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(domains)).astype(np.float64)
        n, u = batch.column("n_tokens").to_numpy(), batch.column("u").to_numpy()
        rate = np.where(n > 0, rates.points(p)[0], 1.0) if rates else np.ones(len(n))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), batch.column("n_tokens"), pa.array([domains[i] for i in p.argmax(1)], pa.string()), pa.array(p.max(1)), pa.array(rate),
                pa.array(np.floor(rate + u).astype(np.int64)), pa.array(np.full(len(n), rates.gap if rates else 0.0)),
            ],
            names=["doc_id", "n_tokens", "domain", "posterior", "rate", "copies", "target_gap"],
        )


def mix(docs: DataFrame, labelled: DataFrame, **options: object) -> DataFrame:
    """One row per input row: doc_id, n_tokens, domain (the likeliest), posterior, rate, copies, target_gap (the largest of any domain)."""
    model = train(docs, labelled)
    table = posterior_table(docs, model)
    rates = fit_rates(table, model.domains, **options)
    return table.mapInArrow(lambda b: _rated(b, model.domains, rates), "doc_id long, n_tokens long, domain string, posterior double, rate double, copies long, target_gap double")


def resampled(docs: DataFrame, labelled: DataFrame, **options: object) -> DataFrame:
    """Each row as often as its rate says, with all columns. Rates are computed beside the text, so nothing is joined.

    Rows are dealt by a hash of id, text and number of the copy, so that copies don't stand together in what is made of the rows.
    """
    model = train(docs, labelled)
    rates = fit_rates(posterior_table(docs, model), model.domains, **options)

    def copies(texts: pd.Series, u: pd.Series) -> pd.Series:
        out = np.ones(len(texts), np.int64)
        for lo in range(0, len(texts), SLICE):
            some = texts.iloc[lo : lo + SLICE].tolist()
            p = model.posteriors(some).astype(np.float32).astype(np.float64)
            rate = rates.points(p)[0] if rates else np.ones(len(p))
            out[lo : lo + SLICE] = np.where([bool(t.split()) for t in some], np.floor(rate + u.iloc[lo : lo + SLICE].to_numpy()), 1)
        return pd.Series(out)

    n = F.pandas_udf(copies, "long")(common.whole_text(), _uniform())
    # no filter on the number: Spark would run the UDF once more for it
    counted = docs.select(F.struct("*").alias("row"), n.alias("n"))
    dealt = counted.select("row", F.posexplode(F.array_repeat(F.lit(1), F.col("n").cast("int"))).alias("copy", "one"))
    return dealt.repartition(F.xxhash64("row.doc_id", F.xxhash64("row.text"), "copy")).select("row.*")


def labelled_domains(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The labelled table of the query and the pipeline: ``poor`` where the quality label is 0, else the document's language."""
    known = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).where("quality IS NOT NULL")
    named = docs.select("doc_id", F.coalesce("lang", F.lit("none")).alias("lang"))
    return named.join(known, "doc_id").select("doc_id", F.when(F.col("quality") == 0, "poor").otherwise(F.col("lang")).alias("domain"))


def op4_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages are evened out; what is likely poor isn't raised."""
    docs = common.table(spark, sf_dir, "documents")
    return mix(docs, labelled_domains(docs, common.table(spark, sf_dir, "labels")), pinned=("poor",))
