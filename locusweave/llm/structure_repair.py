"""Repair of the turns of conversations: the cheapest edits that give role initials ``(s?(ua)+)?``, by a Viterbi search that runs over chunks in parallel.

1. Rows are sorted by conversation and turn in ranges, so that a long conversation spreads over tasks, and cut into chunks. A chunk is a string of row classes (role, fault), a byte a row.
2. Every chunk runs backwards over costs by state from a cost vector at its right end. That of a conversation's last chunk is known; all others start from zeros, a speculation.
3. Fix-up passes: a chunk whose right neighbour came to another vector than it had started from runs again, along with its old run, until the two differ only by a constant; from there on
   the old run is right but for that constant. Passes go on until no vector changes. Usually one is enough, as a few rows decide what all starts come to.
4. The constants add up to the cost. Chunks map the state they are entered in to the one they are left in; doubling steps compose these maps along a conversation. With its state known, each chunk
   traces forwards and takes, of the edits that lie on a cheapest way, the one whose initial is least.

Edits: D(elete) 3, I(nsert) 2, K(eep) 0, R(erole) 2; a truncated row that isn't deleted costs 1 more; blank and repeated rows have to be deleted.

Turns that are null come first; rows of one turn go by role, then by a hash of their text. A null role or text is one space, and so is a null in the damage key. Rows whose conv_id is null are one conversation.
Equal rows are each a row. An empty table gives an empty result. Other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import common, sequences

#: Rows of a chunk.
CHUNK_ROWS = 128
#: States: nothing yet, after the system turn, after a user's turn, after an assistant's.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: Costs at the end of a conversation: an answer, or a question and an answer, have to be inserted.
AT_END = (0, 4, 2, 0)
FAR = 1 << 40
#: The state after a user's or assistant's turn is added, by the state before it.
ADDED = np.array([USER, USER, ASSISTANT, USER])
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
#: Faults of a row, and the class of no row.
NONE, BLANK, REPEATED, CUT = range(4)
NO_ROW = 16
#: State after keeping a row of initial s, u, a or another in each state; -1: can't be kept.
KEPT = np.array([[SYSTEM, -1, -1, -1], [USER, USER, -1, USER], [-1, -1, ASSISTANT, -1], [-1, -1, -1, -1]])

CLASSES = np.arange(NO_ROW)
STAYS = np.append((CLASSES % 4 == NONE) | (CLASSES % 4 == CUT), False)
EXTRA = np.append(np.where(CLASSES % 4 == CUT, TRUNCATED, 0), 0)
AFTER = np.concatenate([KEPT[CLASSES // 4], np.full((1, 4), -1)])
AFTER[~STAYS] = -1
#: Edits of a row as a number: letter, inserted turns before it, whether the first of these and the row's new role are the assistant's.
LETTERS = "DKR"


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with planted faults by crc32 of ``conv_id:turn`` modulo 20: 0 drops a row, 1 empties it, 2 takes its sentence ends, 3 repeats it, 4 makes it the user's. ``copy`` is 1 for a repetition."""
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    hit = F.crc32(F.concat(word("conv_id"), F.lit(":"), word("turn")).cast("binary")) % 20
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), word("role").alias("role"), word("text").alias("text"), hit.alias("hit"))
    text = F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.where("hit <> 0").select("conv_id", "turn", F.when(F.col("hit") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(copies).alias("copy"))


ORDER = ("turn", "role", "a", "copy", "tie")


def _keyed(rows: DataFrame) -> DataFrame:
    """Rows with what orders them: two hashes of the text stand for it, and a number that tells equal rows apart."""
    return rows.select("conv_id", "turn", "role", "text", "copy", F.xxhash64("text").alias("a"), F.xxhash64(F.lit("second"), "text").alias("b"), F.monotonically_increasing_id().alias("tie"))


def _classes(rows: DataFrame) -> DataFrame:
    """Ordered rows without their texts, with ``cls``: four times the initial's number plus the fault."""
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    cut = ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    rows = rows.select("conv_id", *ORDER, "b", blank.alias("blank"), cut.alias("cut"))
    again = rows.where("NOT blank").groupBy("conv_id", "role", "a", "b").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("turn", "copy", "tie")).alias("first")).where("n > 1")
    again = again.select(*(F.col(c).alias(f"of_{c}") for c in ("conv_id", "role", "a", "b")), "first")
    same = F.col("conv_id").eqNullSafe(F.col("of_conv_id")) & (F.col("role") == F.col("of_role")) & (F.col("a") == F.col("of_a")) & (F.col("b") == F.col("of_b"))
    seen = F.isnotnull("first") & ~F.struct("turn", "copy", "tie").eqNullSafe(F.col("first"))
    fault = F.when(F.col("blank"), BLANK).when(seen, REPEATED).when(F.col("cut"), CUT).otherwise(NONE)
    initial = F.substring("role", 1, 1)
    number = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    return rows.join(again, same, "left").select("conv_id", *ORDER, (number * 4 + fault).cast("int").alias("cls"))


def _step(costs: np.ndarray, cls: np.ndarray) -> np.ndarray:
    """Costs (rows of four states) before a row of class ``cls``, from those after it."""
    to = AFTER[cls]
    keep = np.where(to >= 0, np.take_along_axis(costs, np.maximum(to, 0), 1), FAR) + EXTRA[cls][:, None]
    rerole = np.where(STAYS[cls][:, None], costs[:, ADDED], FAR) + (REROLE + EXTRA[cls][:, None])
    best = np.minimum(np.minimum(costs + DELETE, keep), rerole)
    best = np.minimum(best, np.minimum(best[:, ADDED] + INSERT, best[:, ADDED[ADDED]] + 2 * INSERT))
    return np.where((cls == NO_ROW)[:, None], costs, best)


def _level(costs: np.ndarray) -> np.ndarray:
    return costs - costs[:, :1]


def _backward(codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Costs at all places of all chunks: (chunk, place, state)."""
    costs = np.empty((len(codes), codes.shape[1] + 1, 4), np.int64)
    costs[:, -1] = ends
    for i in range(codes.shape[1] - 1, -1, -1):
        costs[:, i] = _step(costs[:, i + 1], codes[:, i])
    return costs


def _fix_up(codes: np.ndarray, old_ends: np.ndarray, ends: np.ndarray, old_begins: np.ndarray) -> np.ndarray:
    """Costs at the beginnings after starting anew from ``ends``; a chunk stops where both runs differ by a constant."""
    begins, open_ = np.empty_like(ends), np.arange(len(codes))
    old, new = old_ends, ends
    for i in range(codes.shape[1] - 1, -1, -1):
        old, new = _step(old, codes[open_, i]), _step(new, codes[open_, i])
        apart = (_level(new) != _level(old)).any(axis=1)
        met = open_[~apart]
        begins[met] = old_begins[met] + (new - old)[~apart][:, :1]
        open_, old, new = open_[apart], old[apart], new[apart]
        if not len(open_):
            return begins
    begins[open_] = new
    return begins


def _trace(costs: np.ndarray, codes: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edits of each row as numbers, and the state after the last row: at each place the least initial that lies on a cheapest way."""
    n = np.arange(len(codes))
    edits = np.zeros(codes.shape, np.uint8)
    for i in range(codes.shape[1]):
        here, there, cls = costs[:, i], costs[:, i + 1], codes[:, i]
        row = cls != NO_ROW
        inserted, first = np.zeros(len(n), np.uint8), ADDED[state] == ASSISTANT
        for _ in range(2):
            delete = there[n, state] + DELETE == here[n, state]
            insert = row & ~delete & (here[n, ADDED[state]] + INSERT == here[n, state])
            inserted += insert
            state = np.where(insert, ADDED[state], state)
        delete = there[n, state] + DELETE == here[n, state]
        to = AFTER[cls, state]
        keep = ~delete & (to >= 0) & (there[n, to] + EXTRA[cls] == here[n, state])
        new = ADDED[state]
        edits[:, i] = np.where(delete, 0, np.where(keep, 1, 2)) + 3 * inserted + 9 * first + 18 * (new == ASSISTANT)
        state = np.where(row & ~delete, np.where(keep, to, new), state)
    return edits, state


def _matrix(codes: list[bytes]) -> np.ndarray:
    out = np.full((len(codes), max(map(len, codes), default=0)), NO_ROW, np.uint8)
    for i, c in enumerate(codes):
        out[i, : len(c)] = np.frombuffer(c, np.uint8)
    return out


def _longs(rows: list) -> np.ndarray:
    return np.array(rows, np.int64).reshape(-1, 4)


def _with(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    kept = [(n, c) for n, c in zip(batch.schema.names, batch.columns) if n not in columns]
    return pa.RecordBatch.from_arrays([*(c for _, c in kept), *columns.values()], names=[*(n for n, _ in kept), *columns])


def _arrays(x: np.ndarray) -> pa.Array:
    return pa.array(x.tolist(), pa.list_(pa.int64()))


def _started(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first run of all chunks."""
    for batch in batches:
        codes, last = _matrix(batch.column("codes").to_pylist()), batch.column("last").to_numpy(zero_copy_only=False)
        ends = np.where(last[:, None], np.array(AT_END), 0).astype(np.int64)
        begins = _backward(codes, ends)[:, 0]
        yield _with(batch, ends=_arrays(ends), begins=_arrays(_level(begins)), cost=pa.array(begins[:, 0], pa.int64()))


def _again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Another run of chunks whose neighbour's vector (``now``) isn't the one they started from."""
    for batch in batches:
        ends, now, begins = (_longs(batch.column(c).to_pylist()) for c in ("ends", "now", "begins"))
        begins = begins + batch.column("cost").to_numpy()[:, None]
        begins = _fix_up(_matrix(batch.column("codes").to_pylist()), ends, now, begins)
        yield _with(batch, ends=_arrays(now), begins=_arrays(_level(begins)), cost=pa.array(begins[:, 0], pa.int64()))


def _mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state in which a chunk is left, for each state in which it may be entered."""
    for batch in batches:
        codes = _matrix(batch.column("codes").to_pylist())
        costs = _backward(codes, _longs(batch.column("ends").to_pylist()))
        left = np.stack([_trace(costs, codes, np.full(len(codes), s))[1] for s in range(4)], axis=1)
        yield _with(batch, map=_arrays(left))


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edits of chunks whose state at entry is known."""
    words = np.array(["I" * (e // 3 % 3) + LETTERS[e % 3] for e in range(36)])
    for batch in batches:
        texts = batch.column("codes").to_pylist()
        codes, last = _matrix(texts), batch.column("last").to_pylist()
        edits, state = _trace(_backward(codes, _longs(batch.column("ends").to_pylist())), codes, batch.column("state").to_numpy().astype(np.int64))
        tails = [AT_END[s] // INSERT if at_end else 0 for s, at_end in zip(state.tolist(), last)]
        rows = [e[: len(t)] for e, t in zip(edits, texts)]
        audit = ["".join(words[r]) + "I" * t for r, t in zip(rows, tails)]
        yield _with(batch, edits=pa.array([r.tobytes() for r in rows], pa.binary()), tail=pa.array(tails, pa.int32()), audit=pa.array(audit, pa.string()))


CHUNK = "conv_id long, chunk long, no int, last boolean, codes binary"
RUN = f"{CHUNK}, ends array<long>, begins array<long>, cost long"


def _settled(runs: DataFrame, max_passes: int = 1000) -> DataFrame:
    """Runs of conversations of several chunks, after fix-up passes; of each pass only a count comes to the driver."""
    for _ in range(max_passes):
        other = runs.select(F.col("conv_id").alias("of"), (F.col("no") - 1).alias("no"), F.col("begins").alias("now"))
        joined = runs.alias("r").join(other.alias("o"), F.col("r.conv_id").eqNullSafe(F.col("o.of")) & (F.col("r.no") == F.col("o.no")), "left").select("r.*", "now")
        joined = joined.withColumn("stale", F.coalesce(F.col("now") != F.col("ends"), F.lit(False)))
        stale = joined.where("stale")
        if not stale.head(1):
            return runs
        fixed = stale.select(*runs.columns, "now").mapInArrow(_again, f"{CHUNK}, now array<long>, ends array<long>, begins array<long>, cost long").drop("now")
        runs = common.cut(joined.where("NOT stale").select(*runs.columns).unionByName(fixed))
    raise RuntimeError(f"cost vectors did not settle in {max_passes} passes")


def _entered(runs: DataFrame) -> DataFrame:
    """``state`` in which each chunk is entered: maps composed along conversations, spans doubling."""
    maps = common.cut(runs.mapInArrow(_mapped, f"{RUN}, map array<long>"))
    at = maps.select("conv_id", "no", "map")
    longest, span = at.agg(F.max("no")).first()[0], 1
    while span <= longest:
        before = at.select(F.col("conv_id").alias("of"), (F.col("no") + span).alias("to"), F.col("map").alias("first"))
        joined = at.join(before, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("no") == F.col("to")), "left")
        composed = F.when(F.isnull("first"), F.col("map")).otherwise(F.transform("first", lambda x: F.get("map", x.cast("int"))))
        at, span = common.cut(joined.select("conv_id", "no", composed.alias("map"))), span * 2
    left = at.select(F.col("conv_id").alias("of"), (F.col("no") + 1).alias("to"), F.get("map", F.lit(NOTHING)).alias("state"))
    joined = runs.join(left, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("no") == F.col("to")), "left")
    return joined.select(*runs.columns, F.coalesce("state", F.lit(NOTHING)).cast("long").alias("state"))


def edits(rows: DataFrame, chunk_rows: int = CHUNK_ROWS) -> tuple[DataFrame, DataFrame]:
    """The ordered rows (without texts) with their chunk and place, and the chunks with cost and edits, both written to the shared folder."""
    placed = common.written(sequences.chunked(_classes(_keyed(rows)), "conv_id", *ORDER, rows=chunk_rows), "repair-rows")
    packed = F.array_sort(F.collect_list(F.struct("idx", "cls")))
    chunks = placed.groupBy("conv_id", "chunk").agg(packed.alias("rows"))
    along = W.partitionBy("conv_id").orderBy("chunk")
    hexed = F.transform("rows", lambda r: F.lpad(F.hex(r["cls"]), 2, "0"))
    chunks = chunks.select("conv_id", "chunk", (F.row_number().over(along) - 1).alias("no"), F.isnull(F.lead("chunk").over(along)).alias("last"), F.unhex(F.array_join(hexed, "")).alias("codes"))
    runs = common.written(chunks.mapInArrow(_started, RUN), "repair-runs")
    single = runs.where("last AND no = 0").withColumn("state", F.lit(NOTHING).cast("long"))
    alone = runs.where("last AND no = 0").select(F.col("conv_id").alias("of"))
    several = runs.join(alone, F.col("conv_id").eqNullSafe(F.col("of")), "left_anti")
    if several.head(1):
        single = single.unionByName(_entered(_settled(common.cut(several))))
    return placed, common.written(single.mapInArrow(_edited, f"{RUN}, state long, edits binary, tail int, audit string"), "repair-edits")


#: Turns that stand inserted before a row, by number and whether the first is the assistant's.
INSERTED = {(n, a): [("user", "assistant")[(i + a) % 2] for i in range(n)] for n in range(3) for a in (0, 1)}


def _rewritten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order, each chunk's edits before its first row, to the repaired turns. Only the edits of the open chunk are held."""
    edits, i, tail = b"", 0, []
    for batch in batches:
        for part in common.slices(batch):
            out: list[tuple] = []
            for conv, role, text, new, n in zip(*(part.column(c).to_pylist() for c in ("conv_id", "role", "text", "edits", "tail"))):
                if new is not None:
                    edits, i = new, 0
                    tail = INSERTED[n, n % 2]  # one turn: an answer, two: a question and its answer
                    continue
                e, i = edits[i], i + 1
                out += [(conv, "I", r, "") for r in INSERTED[e // 3 % 3, e // 9 % 2]]
                if e % 3 == 1:
                    out.append((conv, "K", role, text))
                elif e % 3 == 2:
                    out.append((conv, "R", "assistant" if e >= 18 else "user", text))
                if i == len(edits):
                    out += [(conv, "I", r, "") for r in tail]
            kinds = (pa.int64(), pa.string(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], names=["conv_id", "edit", "role", "text"])


def repaired_turns(rows: DataFrame, placed: DataFrame, chunks: DataFrame) -> DataFrame:
    """conv_id, edit (I, K or R), role, text of the repaired conversations. A task has whole conversations, and their turns in order."""
    first = placed.where("idx = 0").join(chunks.select(F.col("chunk").alias("of"), "edits", "tail"), F.col("chunk") == F.col("of"))
    heads = first.select("conv_id", *ORDER, F.lit(None).cast("string").alias("text"), F.lit(0).alias("kind"), "edits", "tail")
    texts = _keyed(rows).select("conv_id", *ORDER, "text", F.lit(1).alias("kind"), F.lit(None).cast("binary").alias("edits"), F.lit(None).cast("int").alias("tail"))
    dealt = common.small_batches(heads.unionByName(texts)).repartition("conv_id").sortWithinPartitions("conv_id", *ORDER, "kind")
    return dealt.mapInArrow(_rewritten, "conv_id long, edit string, role string, text string")


def _faults(placed: DataFrame, chunks: DataFrame) -> DataFrame:
    """Counts by conversation. Pairs of neighbours are counted in chunks, and where chunks meet."""
    code = lambda i: F.conv(F.substring("hex", 2 * i + 1, 2), 16, 10).cast("int")
    fault = lambda f: F.sum(F.when(F.col("cls") % 4 == f, 1).otherwise(0))
    turns = placed.groupBy("conv_id").agg((F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"), fault(BLANK).alias("blank"), fault(REPEATED).alias("duplicate"), fault(CUT).alias("truncated"))
    lawful = lambda x, y: F.concat(x.cast("string"), y.cast("string")).isin("01", "12", "21")  # noqa: E731  su, ua, au
    initials = chunks.select("conv_id", "no", F.hex("codes").alias("hex"), F.length("codes").alias("n"))
    initials = initials.withColumn("i", F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda k: F.shiftright(code(k), 2)))
    before = F.lag(F.element_at("i", -1)).over(W.partitionBy("conv_id").orderBy("no"))
    inside = F.aggregate(F.sequence(F.lit(0), F.size("i") - 1), F.lit(0), lambda acc, k: acc + F.when((k > 0) & ~lawful(F.get("i", k - 1), F.get("i", k)), 1).otherwise(0))
    met = F.when(F.isnotnull("before") & ~lawful(F.col("before"), F.get("i", F.lit(0))), 1).otherwise(0)
    pairs = initials.withColumn("before", before).groupBy("conv_id").agg(F.sum(inside + met).alias("illegal"))
    return turns.join(pairs.withColumnRenamed("conv_id", "of"), F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")


def repair(rows: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text, copy): gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    placed, chunks = edits(rows, chunk_rows)
    whole = F.transform(F.array_sort(F.collect_list(F.struct("no", "audit"))), lambda c: c["audit"])
    ways = chunks.groupBy("conv_id").agg(F.sum("cost").alias("cost"), F.array_join(whole, "").alias("audit")).withColumnRenamed("conv_id", "way_of")
    lines = repaired_turns(rows, placed, chunks).select("conv_id", F.concat_ws(":", "role", "text").alias("line"))
    hashes = lines.mapInArrow(lambda b: sequences.hashed(b, "conv_id", "line", b"\n"), "conv_id long, sha256 string").withColumnRenamed("conv_id", "hash_of")
    out = _faults(placed, chunks).join(ways, F.col("conv_id").eqNullSafe(F.col("way_of"))).join(hashes, F.col("conv_id").eqNullSafe(F.col("hash_of")), "left")
    return out.select("conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), "audit", F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op11_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = common.table(spark, sf_dir, "conversations")
    found = repair(damaged(conversations)).withColumnRenamed("conv_id", "of")
    every = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().join(found, F.col("conv_id").eqNullSafe(F.col("of")), "left").drop("of")
    nothing: dict[str, Column] = {c: F.lit(0).cast("long") for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")} | {"audit": F.lit(""), "repaired_sha256": F.sha2(F.lit(""), 256)}
    return every.select("conv_id", *(F.coalesce(F.col(c), v).alias(c) for c, v in nothing.items()))


OP11_SQL = r"""
WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
b AS (SELECT *, flatten(list_transform(generate_series(1, length(key)), lambda i: [CAST(ascii(substring(key, CAST(i AS INT), 1)) AS BIGINT), 0, 0, 0, 0, 0, 0, 0])) AS bits FROM k),
h AS (SELECT *, xor(list_reduce(list_concat([4294967295], bits), lambda c, x: xor(xor(c, x) >> 1, (xor(c, x) & 1) * 3988292384)), 4294967295) % 20 AS hit FROM b),
d AS (SELECT conv_id, turn, CASE hit WHEN 4 THEN 'user' ELSE role END AS role, CASE hit WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, copy FROM h, (VALUES (0), (1)) c(copy) WHERE hit <> 0 AND (copy = 0 OR hit = 3)),
p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen FROM d),
f AS MATERIALIZED (SELECT conv_id, turn, role, text, pos, substring(role, 1, 1) AS i, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN seen > 1 THEN 'duplicate'
  WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault FROM p),
adds(q, q2, role) AS (VALUES (0, 2, 'user'), (1, 2, 'user'), (2, 3, 'assistant'), (3, 2, 'user')),
keeps(q, i, q2) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
ins(q, q2, cost, letters, lines) AS (SELECT q, q, 0, '', CAST([] AS VARCHAR[]) FROM adds UNION ALL SELECT q, q2, 2, 'I', [role || ':'] FROM adds UNION ALL SELECT q, 3, 4, 'II', ['user:', 'assistant:'] FROM adds WHERE q < 2),
r AS (SELECT conv_id, CAST(0 AS BIGINT) AS pos, ins.q2 AS q, {'cost': ins.cost, 'audit': ins.letters, 'lines': ins.lines} AS b FROM (SELECT DISTINCT conv_id FROM f) c, ins WHERE ins.q = 0
 UNION ALL SELECT conv_id, pos, q, min(b) FROM (
  SELECT r.conv_id, f.pos, n.q2 AS q, {'cost': r.b.cost + n.cost + CASE l WHEN 'D' THEN 3 WHEN 'R' THEN 2 ELSE 0 END + CASE WHEN l <> 'D' AND fault = 'truncated' THEN 1 ELSE 0 END, 'audit': r.b.audit || l || n.letters,
   'lines': list_concat(list_concat(r.b.lines, CASE l WHEN 'D' THEN CAST([] AS VARCHAR[]) WHEN 'K' THEN [f.role || ':' || text] ELSE [adds.role || ':' || text] END), n.lines)} AS b
  FROM r JOIN f ON f.conv_id IS NOT DISTINCT FROM r.conv_id AND f.pos = r.pos + 1 JOIN adds ON adds.q = r.q LEFT JOIN keeps ON keeps.q = r.q AND keeps.i = f.i CROSS JOIN (VALUES ('D'), ('K'), ('R')) o(l)
  JOIN ins n ON n.q = CASE l WHEN 'D' THEN r.q WHEN 'K' THEN keeps.q2 ELSE adds.q2 END WHERE l = 'D' OR (fault NOT IN ('blank', 'duplicate') AND (l = 'R' OR keeps.q2 IS NOT NULL))) x GROUP BY conv_id, pos, q),
n AS (SELECT conv_id, count(*) AS rows, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated FROM f GROUP BY conv_id),
g AS (SELECT conv_id, count(*) FILTER (before IS NOT NULL AND before || i NOT IN ('su', 'ua', 'au')) AS illegal FROM (SELECT conv_id, i, lag(i) OVER (PARTITION BY conv_id ORDER BY pos) AS before FROM f) x GROUP BY conv_id),
w AS (SELECT r.conv_id, min(r.b) AS b FROM r JOIN n ON n.conv_id IS NOT DISTINCT FROM r.conv_id AND n.rows = r.pos WHERE r.q IN (0, 3) GROUP BY r.conv_id)
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(w.b.cost, 0) AS BIGINT) AS cost,
 coalesce(w.b.audit, '') AS audit, sha256(coalesce(array_to_string(w.b.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN w ON w.conv_id IS NOT DISTINCT FROM c.conv_id
"""
