"""Rows that stand in an order under a key: cut into chunks of bounded length, and hashed in order."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.types import IntegerType, LongType, StructField, StructType


def _starts(keys: pa.Array, before: object) -> np.ndarray:
    """True where a key differs from the one before it; ``before`` is the key before the batch (a list's item, or any other object if there is none)."""
    null = keys.is_null().to_numpy(zero_copy_only=False)
    values = keys.fill_null(0).to_numpy(zero_copy_only=False)
    new = np.ones(len(keys), bool)
    new[1:] = (values[1:] != values[:-1]) | (null[1:] != null[:-1])
    new[0] = not isinstance(before, list) or keys[0].as_py() != before[0]
    return new


def chunked(df: DataFrame, key: str, *order: str, rows: int = 128) -> DataFrame:
    """``df`` with ``chunk`` and ``idx``: the rows of a long key, sorted by ``order``, in chunks of up to ``rows`` rows, numbered upwards.

    Rows are dealt by ranges of key and order, so a key with very many rows spreads over tasks; ``order`` should leave no ties. Write the result before using it twice.
    """
    schema = StructType([*df.schema.fields, StructField("chunk", LongType()), StructField("idx", IntegerType())])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: object = None
        done, count = 0, (TaskContext.get().partitionId() << 40) - 1  # rows of the open key so far, number of its chunk
        for batch in batches:
            if not len(batch):
                continue
            keys = batch.column(key)
            new = _starts(keys, at)
            i = np.arange(len(batch))
            start = np.maximum.accumulate(np.where(new, i, -1))
            pos = np.where(start < 0, i + done, i - start)
            idx = pos % rows
            chunk = count + np.cumsum(idx == 0)
            at, done, count = [keys[-1].as_py()], int(pos[-1]) + 1, int(chunk[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(chunk, pa.int64()), pa.array(idx.astype(np.int32))], names=[*batch.schema.names, "chunk", "idx"])

    return df.repartitionByRange(key, *order).sortWithinPartitions(key, *order).mapInArrow(number, schema)


def hashed(batches: Iterator[pa.RecordBatch], key: str, piece: str, between: bytes) -> Iterator[pa.RecordBatch]:
    """key, sha256 of each run of a key: SHA-256 of its pieces, joined. A run is hashed as it streams by; nothing of it is held."""
    at: object = None
    state = hashlib.sha256()
    out: list[tuple] = []

    def flush() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.string())], names=[key, "sha256"])
        out.clear()
        return batch

    for batch in batches:
        if not len(batch):
            continue
        new = _starts(batch.column(key), at)
        keys, pieces = batch.column(key).to_pylist(), batch.column(piece).to_pylist()
        ends = [*np.flatnonzero(new).tolist(), len(keys)]
        if not new[0]:
            state.update(between + between.join(p.encode() for p in pieces[: ends[0]]))
        for lo, hi in zip(ends, ends[1:]):
            if at is not None:
                out.append((at[0], state.hexdigest()))
            at, state = [keys[lo]], hashlib.sha256(between.join(p.encode() for p in pieces[lo:hi]))
        at = [keys[-1]]
        if len(out) >= 10_000:
            yield flush()
    if at is not None:
        out.append((at[0], state.hexdigest()))
        yield flush()
