"""Digests of groups of rows in order, taken as the rows stream by."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ordered_md5(rows: DataFrame, key: str, order: list[F.Column], piece: str) -> DataFrame:
    """key, hash (MD5 of a key's pieces one after another, in order) and n_sites (their number).

    A task has whole keys and sorts its rows on disk where they don't fit; of a key it holds the state of the digest only, never the list of its pieces.
    """
    names = [f"__o{i}" for i in range(len(order))]
    dealt = rows.select(key, F.col(piece).alias("__piece"), *(o.alias(n) for o, n in zip(order, names))).repartition(key).sortWithinPartitions(key, *names).select(key, "__piece")

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, state, n = None, hashlib.md5(), 0
        for batch in batches:
            done = []
            for name, pieces in batch.groupby(key, sort=False)["__piece"]:
                if name != at:
                    if at is not None:
                        done.append((at, state.hexdigest(), n))
                    at, state, n = name, hashlib.md5(), 0
                state.update("".join(pieces).encode())
                n += len(pieces)
            yield pd.DataFrame(done, columns=[key, "hash", "n_sites"])
        if at is not None:
            yield pd.DataFrame([(at, state.hexdigest(), n)], columns=[key, "hash", "n_sites"])

    return dealt.where(F.col(key).isNotNull()).mapInPandas(digest, f"{key} string, hash string, n_sites long")
