"""Cost-balanced packing of documents into sequences.

A document's ids (byte-level BPE, then id 0) are estimated to cost ``linear * n + quadratic * n ** 2``. A task packs its documents in
groups of about ``group_tokens`` ids. In a group, a document first fills whole sequences of its own; what remains of it is a
piece. Pieces go, longest first, to the lowest-cost sequence with room for them; a piece that fits nowhere is cut and its head
fills the roomiest sequence. A group has as many full sequences as its ids fill, and for the ids left over
sequences whose capacities are the powers of two that add up to them; so every sequence ends full and nothing is padded.

No data is shuffled: groups follow the input's partitions. sequence_id is the partition's number times 2 ** 32, plus a counter.
Texts are tokenized whole. tiktoken runs the same vocabulary as the tokenizers file, several times as fast; the ids are compared in the
tests, and a text that it can't take is given to tokenizers.

Null text counts as empty: its one id 0 is packed. doc_id, null or repeated, is only passed on; each row is packed by itself. An
empty table gives an empty result. Other columns of the input are not read.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

OUT = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, row long"
KINDS = (pa.int64(),) * 8


def encoder(tokenizer_file: str | None = None, ranks_file: str | None = None) -> Callable[[str], list[int]]:
    """Ids of a whole text. The files default to those of the installed public tokenizers."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(ranks_file or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    slow: list[Tokenizer] = []
    fast = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={"<|endoftext|>": len(ranks)})

    def encode(text: str) -> list[int]:
        try:
            return fast.encode(text, allowed_special="all")
        except BaseException as error:  # a panic of its regular expressions isn't an Exception
            if not isinstance(error, Exception) and type(error).__name__ != "PanicException":
                raise
            if not slow:
                slow.append(Tokenizer.from_file(tokenizer_file or public_tokenizers.path("byte_bpe_50k.json")))
            return slow[0].encode(text, add_special_tokens=False).ids

    return encode


def capacities(n_ids: int, size: int) -> np.ndarray:
    """Full sequences, then the powers of two that the rest consists of."""
    full, rest = divmod(n_ids, size)
    return np.array([size] * full + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1], np.int64)


def assign(lengths: list[int], size: int, linear: float, quadratic: float) -> list[tuple[int, int, int, int]]:
    """(document, start, length, sequence) of each piece, in the order in which sequences are filled."""
    pieces, rest, used = [], [], 0
    for doc, n in enumerate(lengths):
        for start in range(0, n - size + 1, size):
            pieces.append((doc, start, size, used))
            used += 1
        if n % size:
            rest.append((n % size, doc, n - n % size))
    rest.sort(key=lambda r: (-r[0], r[1]))
    room = capacities(sum(r[0] for r in rest), size)
    cost = np.zeros(len(room))
    for n, doc, start in rest:
        while n:
            fits = room >= n
            if fits.any():
                to = int(np.argmin(np.where(fits, cost, np.inf)))
                take = n
            else:
                to = int(np.argmax(room))
                take = int(room[to])
            pieces.append((doc, start, take, used + to))
            room[to] -= take
            cost[to] += linear * take + quadratic * take * take
            start, n = start + take, n - take
    return pieces


def _pack(batches: Iterator[pa.RecordBatch], size: int, group_tokens: int, linear: float, quadratic: float, files: tuple) -> Iterator[pa.RecordBatch]:
    encode = encoder(*files)
    task = TaskContext.get()
    first = (task.partitionId() if task else 0) << 32
    docs: list[tuple[int | None, np.ndarray, int]] = []
    held, seen = 0, first

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal first
        pieces = assign([len(ids) for _, ids, _ in docs], size, linear, quadratic)
        filled: dict[int, int] = {}
        rows = []
        for doc, start, n, sequence in pieces:
            doc_id, ids, row = docs[doc]
            offset = filled.get(sequence, 0)
            filled[sequence] = offset + n
            rows.append((doc_id, start, n, zlib.crc32(ids[start : start + n].tobytes()), len(ids), first + sequence, offset, row))
        first += len(filled)
        docs.clear()
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(KINDS)], names=[c.split()[0] for c in OUT.split(", ")])

    for batch in batches:
        for part in common.slices(batch):
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                ids = np.array([*encode(text), 0], "<u4")
                docs.append((doc_id, ids, seen))
                seen += 1
                held += len(ids)
                if held >= group_tokens:
                    yield from flush()
                    held = 0
    if docs:
        yield from flush()


def pack(docs: DataFrame, size: int = 1024, group_tokens: int = 1 << 20, linear: float = 1.0, quadratic: float = 1 / 2048, tokenizer_file: str | None = None, ranks_file: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, row (a number of the input row, which tells copies of a document apart)."""
    base = common.small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), common.whole_text().alias("text"))
    return base.mapInArrow(lambda b: _pack(b, size, group_tokens, linear, quadratic, (tokenizer_file, ranks_file)), OUT)


def op8_cost_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(common.table(spark, sf_dir, "documents"))
