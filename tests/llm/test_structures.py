"""Operators over conversations and byte strings against brute force, and on odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from locusweave.llm import common, mixing, packing, prefix_trie, secret_scan, sequences, structure_repair, suffix_dedup, toxicity

TALK = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"


@pytest.fixture(scope="module")
def talks(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/conversations.parquet").cache()


def odd_talks(spark):
    """Nulls everywhere, empty and very long texts, ties, repeated rows, unknown roles, and columns whose names operators use."""
    rows = [(1, None, None, None), (1, None, "user", "Hi."), (1, 0, "user", ""), (1, 0, "user", ""), (None, 3, "assistant", "a?"), (None, None, "tool", "x"), (2, 5, "system", "s."), (2, 5, "system", "s.")]
    rows += [(2, 9, "user", "word " * 40_000), (2, 10, "assistant", "ß😀."), (3, 1, "", "e."), (3, 2, "User", "\n\t"), (-7, 1, "user", "n"), (-7, 2, "assistant", "n!"), (5, 1, "user", "Hi."), (6, 1, "user", "Hi.")]
    df = spark.createDataFrame(rows, TALK)
    return df.withColumns({c: F.lit("clash") for c in ("chunk", "idx", "cls", "a", "b", "no", "node", "parent", "depth", "kind", "tie", "copy", "edits", "weight")})


# --- 11


def cheapest(rows):
    """(cost, audit) of rows (initial, fault): all ways, the best by state at each place."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    add = {"": "u", "s": "u", "u": "a", "a": "u"}

    def with_inserts(at):
        for _ in range(4):
            for state, (cost, way) in list(at.items()):
                new = (cost + 2, way + "I")
                if new < at.get(add[state], (10**9, "")):
                    at[add[state]] = new
        return at

    at = with_inserts({"": (0, "")})
    for initial, fault in rows:
        new = {}
        for state, (cost, way) in at.items():
            options = [(state, (cost + 3, way + "D"))]
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                options.append((add[state], (cost + 2 + extra, way + "R")))
                if (state, initial) in step:
                    options.append((step[state, initial], (cost + extra, way + "K")))
            for to, value in options:
                new[to] = min(new.get(to, (10**9, "")), value)
        at = with_inserts(new)
    return min(at[s] for s in ("", "a") if s in at)


def repaired_by_hand(rows):
    """Digest of one conversation's rows (turn, role, text) in order."""
    turns = [t for t, _, _ in rows if t is not None]
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.strip(SPACE)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    initials = [role[:1] for _, role, _ in rows]
    cost, audit = cheapest(list(zip(initials, faults)))
    out, i, state = [], 0, ""
    for letter in audit:
        if letter == "I":
            state = {"": "user", "s": "user", "u": "assistant", "a": "user"}[state[:1]]
            out.append((state, ""))
            continue
        _, role, text = rows[i]
        i += 1
        if letter != "D":
            state = role if letter == "K" else {"": "user", "s": "user", "u": "assistant", "a": "user"}[state[:1]]
            out.append((state, text))
    assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in out))
    illegal = sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:]))
    text = "\n".join(f"{r}:{t}" for r, t in out)
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def damaged_by_hand(rows):
    """By conversation, rows (turn, role, text) with planted faults."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text, hit = " " if role is None else role, " " if text is None else text, zlib.crc32(key.encode()) % 20
        out[conv] += [] if hit == 0 else [(turn, "user" if hit == 4 else role, "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text)] * (1 + (hit == 3))
    return out


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def test_repair_by_brute_force(spark, talks, sf_dir):
    rows = [tuple(r[c] for c in ("conv_id", "turn", "role", "text")) for r in talks.collect()]
    want = {(conv, *repaired_by_hand(sorted(x))) for conv, x in damaged_by_hand(rows).items()}
    assert {tuple(r) for r in structure_repair.op11_structure_repair(spark, sf_dir).select(COLUMNS).collect()} == want


@pytest.mark.parametrize("chunk_rows", [1, 7, 128])
def test_repair_of_long_conversations(spark, chunk_rows):
    """Chunks that are entered in every state, and starts that are far from the true costs, must give what one run gives."""
    rng = random.Random(chunk_rows)
    rows = []
    for conv, n in enumerate([1, 2, 30, 130]):
        for turn in range(n):
            role = rng.choice(["user", "assistant"]) if conv % 2 else ["user", "assistant"][turn % 2]
            rows.append((conv, turn, "system" if rng.random() < 0.1 else role, rng.choice(["Yes.", f"Text {turn}.", f"cut {turn}", "", f"What {turn}?"])))
    df = spark.createDataFrame(rows, TALK).withColumn("copy", F.lit(0)).repartition(3)
    by = defaultdict(list)
    for conv, *row in rows:
        by[conv].append(tuple(row))
    want = {(conv, *repaired_by_hand(x)) for conv, x in by.items()}
    assert {tuple(r) for r in structure_repair.repair(df, chunk_rows).select(COLUMNS).collect()} == want


def test_fix_up_stops_where_runs_are_parallel():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 16, (50, 40)).astype(np.uint8)
    old, new = np.zeros((50, 4), np.int64), rng.integers(0, 9, (50, 4))
    begins = structure_repair._backward(codes, old)[:, 0]
    assert (structure_repair._fix_up(codes, old, new, begins) == structure_repair._backward(codes, new)[:, 0]).all()


def test_repair_of_odd_rows(spark):
    df = odd_talks(spark)
    rows = [tuple(r[c] for c in ("conv_id", "turn", "role", "text")) for r in df.collect()]
    first = lambda r: (r[0] is not None, r[0] or 0)
    got = {r[0]: tuple(r) for r in structure_repair.repair(structure_repair.damaged(df)).select(COLUMNS).collect()}
    for conv, x in damaged_by_hand(rows).items():
        if not x:
            assert conv not in got
            continue
        assert got[conv][1:] == repaired_by_hand(sorted(x, key=lambda r: (first(r), r[1])))
    assert structure_repair.repair(structure_repair.damaged(df.limit(0))).count() == 0


def test_streamed_hashes(spark):
    rows = [(i % 7 if i % 7 else None, i, f"p{i}ß") for i in range(500)]
    df = spark.createDataFrame(rows, "k long, i long, p string").repartition(3, "k").sortWithinPartitions("k", "i")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        got = {tuple(r) for r in df.mapInArrow(lambda b: sequences.hashed(b, "k", "p", b", "), "k long, sha256 string").collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = defaultdict(list)
    for k, _, p in rows:
        want[k].append(p)
    assert got == {(k, hashlib.sha256(", ".join(v).encode()).hexdigest()) for k, v in want.items()}


# --- 12


def trie_by_hand(rows):
    """Rows (conv_id, turn, role, text) to the nodes' digests, node by node."""
    talks = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            talks[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    plain = {c: [(r, t) for _, r, t in sorted(x)] for c, x in talks.items()}
    members, ends = defaultdict(set), defaultdict(list)
    for c in sorted(plain):
        h = zlib.crc32(str(c).encode()) % 9
        turns = tuple(plain.get(c - int(np.fmod(c, 5)), [])[:h] + plain[c][h:])
        for d in range(len(turns) + 1):
            members[turns[:d]].add(c)
        ends[turns].append(str(c))
    out = set()
    for node, m in members.items():
        below = [x for x in members if x[: len(node)] == node]
        kids = [x for x in below if len(x) == len(node) + 1]
        leaves = sum(not any(len(y) == len(x) + 1 and y[: len(x)] == x for y in below) for x in below)
        saved = sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in below if x)
        out.add((min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(kids), leaves, saved, hashlib.sha256(",".join(ends[node]).encode()).hexdigest()))
    return out


def test_trie_by_brute_force(spark, talks, sf_dir):
    rows = [tuple(r[c] for c in ("conv_id", "turn", "role", "text")) for r in talks.collect()]
    assert {tuple(r) for r in prefix_trie.op12_prefix_trie(spark, sf_dir).collect()} == trie_by_hand(rows)


@pytest.mark.parametrize("table, query, sql", [("conversations", structure_repair.op11_structure_repair, structure_repair.OP11_SQL), ("conversations", prefix_trie.op12_prefix_trie, prefix_trie.OP12_SQL), ("documents", suffix_dedup.op13_suffix_dedup, suffix_dedup.OP13_SQL)])
def test_sql(spark, sf_dir, table, query, sql):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    want = con.sql(sql)
    got = query(spark, sf_dir)
    assert got.columns == want.columns
    assert {tuple(r) for r in got.collect()} == set(want.fetchall())


def test_trie_of_odd_and_shared_rows(spark):
    df = odd_talks(spark)
    more = [(100 + i, t, "user" if t % 2 == 0 else "assistant", f"t{t if t < 5 + i % 3 else t * 100 + i % 4}") for i in range(25) for t in range(i % 13)]
    df = df.select("conv_id", "turn", "role", "text").unionByName(spark.createDataFrame(more, TALK))
    turns, sizes = prefix_trie.rebuilt(prefix_trie.placed_turns(df.withColumn("part", F.lit("clash")), chunk_rows=2))
    assert {tuple(r) for r in prefix_trie.summarized(*prefix_trie.trie(turns, sizes)).collect()} == trie_by_hand([tuple(r) for r in df.collect()])
    turns, sizes = prefix_trie.rebuilt(prefix_trie.placed_turns(df.limit(0)))
    assert prefix_trie.summarized(*prefix_trie.trie(turns, sizes)).count() == 0


def test_prefixes_over_chunks(spark):
    """Hashes of prefixes don't depend on where chunks end."""
    turns = spark.createDataFrame([(c, p, p * 7 + c // 2, 3, 1) for c in range(4) for p in range(23)], "conv_id long, pos long, a long, b long, size long")
    assert sorted(map(tuple, prefix_trie.prefixes(turns, 4).collect())) == sorted(map(tuple, prefix_trie.prefixes(turns, 100).collect()))


def test_contraction_of_chains_and_stars(spark):
    rng = random.Random(3)
    parent = {0: None}
    for i in range(1, 150):
        parent[i] = i - 1 if rng.random() < 0.9 else rng.randrange(i)
    for i in range(150, 250):
        parent[i] = 0
    depth = {0: 0}
    for i in range(1, 250):
        depth[i] = depth[parent[i]] + 1
    rows = [(i, p, depth[i], None if p is None else depth[p], i * i % 11) for i, p in parent.items()]
    got = prefix_trie.subtree_totals(spark.createDataFrame(rows, "id long, parent long, depth long, up_depth long, v long"), ("v",))
    want = {i: i * i % 11 for i in parent}
    for i in range(249, 0, -1):
        want[parent[i]] += want[i]
    assert sorted(map(tuple, got.collect())) == sorted(want.items())


# --- 13

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def strings_by_hand(rows):
    """Rows (doc_id, text) to digests, string by string."""
    seen, out = set(), {}
    for doc_id, text in sorted({(r[0], r[1] or "") for r in rows}, key=lambda r: (r[0] is not None, r[0] or 0)):
        raw = text.encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - 99):
            if raw[i : i + 100] in seen:
                gone[i : i + 100] = b"\1" * 100
            seen.add(raw[i : i + 100])
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out[doc_id, text] = (len(raw), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest())
    return sorted(((r[0], *out[r[0], r[1] or ""]) for r in rows), key=repr)


def digests(df):
    return sorted((tuple(r[c] for c in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def repeating(spark):
    """Passages shared at all offsets, periodic texts, odd rows, and columns whose names the operator uses."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeß") for _ in range(rng.randint(1, 9)))
    shared = [" ".join(word() for _ in range(n)) for n in (12, 20, 25, 40, 200)]
    texts = [" ".join(rng.choice([word(), word(), word(), rng.choice(shared)[rng.randint(0, 30) :]]) for _ in range(rng.randint(0, 60))) for _ in range(60)]
    texts += [None, "", "a", "a" * 99, "a" * 100, "a" * 101, "ab" * 500, "x" * 5000, "abc" * 40 + "y" * 150 + "abc" * 40, shared[4], shared[4], shared[4] * 3, "\0" * 130, "\0" * 131, "end" + "\0" * 120, "日本" * 90]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)] + [(None, shared[4], None, None, None), (3, texts[3], None, None, None)]
    return spark.createDataFrame(rows, DOCS).withColumns({c: F.lit("clash") for c in ("key", "hash", "th", "start", "n", "piece", "ranges", "first", "hot", "of_key", "copies")}).repartition(5)


@pytest.mark.parametrize("key_pieces", [1 << 15, 2])
def test_strings_by_brute_force(repeating, key_pieces):
    rows = [(r["doc_id"], r["text"]) for r in repeating.collect()]
    assert digests(suffix_dedup.dedup_strings(repeating, key_pieces)) == strings_by_hand(rows)


def test_strings_of_the_corpus(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert digests(suffix_dedup.op13_suffix_dedup(spark, sf_dir)) == strings_by_hand(rows)


def test_strings_of_an_empty_table(repeating):
    assert suffix_dedup.dedup_strings(repeating.limit(0)).count() == 0


def test_strings_over_segments_and_collections(repeating, monkeypatch):
    """Long texts are hashed in parts, and keys fill many collections; neither may change a result."""
    whole = [(r["doc_id"], r["text"]) for r in repeating.collect()]
    texts = [(t or "").encode() for _, t in whole]
    batch = pa.RecordBatch.from_arrays([pa.array([d for d, _ in whole], pa.int64()), pa.array(range(len(whole)), pa.int64()), pa.array(texts, pa.binary())], names=["doc_id", "th", "text"])
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 50)
    strings = set()
    for b in suffix_dedup._pieces(iter([batch])):
        for key, th, start, n in zip(*(b.column(c).to_pylist() for c in ("key", "th", "start", "n"))):
            strings |= {(th, start + i, key) for i in range(n)}
    monkeypatch.undo()
    want = set()
    for b in suffix_dedup._pieces(iter([batch])):
        for key, th, start, n in zip(*(b.column(c).to_pylist() for c in ("key", "th", "start", "n"))):
            want |= {(th, start + i, key) for i in range(n)}
    assert strings == want and len(want) == sum(max(0, len(t) - 99) for t in texts)


def test_transform_against_sorted_suffixes():
    """Order and common prefixes after all columns, against sorting."""
    rng = np.random.default_rng(2)
    lengths = rng.integers(0, 12, 40)
    step = suffix_dedup.WORD
    words = rng.integers(0, 3, (int(lengths.sum()) + 1) * step).astype(np.uint64)
    first = np.concatenate(([0], np.cumsum(lengths * step)))[:-1]
    got = suffix_dedup.Collection(words, first, lengths)
    suffix = {int(f + step * i): tuple(words[f + step * i : f + step * n : step].tolist()) for f, n in zip(first, lengths) for i in range(n)}
    order = [suffix[s] for s in got.starts().tolist()]
    assert order == sorted(suffix.values())
    common = [0] + [next((i for i, (a, b) in enumerate(zip(x, y)) if a != b), min(len(x), len(y))) for x, y in zip(order, order[1:])]
    assert got.common[got.n :].tolist() == common


# scores that evidence never lowers, and credentials by their parts


def test_weights_are_never_negative_and_fit():
    """On data where a count would get a negative weight, the loss is least among weights that aren't negative."""
    rng = np.random.default_rng(4)
    x = np.abs(rng.normal(size=(400, 3)))
    y = (rng.random(400) < 1 / (1 + np.exp(-(x @ [2, 1, -2] - 0.5)))).astype(float)
    w = toxicity.logistic(x, y)
    assert (w[1:] >= 0).all() and w[3] == 0 and w[1] > 0.5
    full = np.column_stack([np.ones(400), x])
    loss = lambda v: np.logaddexp(0, full @ v).sum() - y @ (full @ v) + 0.005 * v @ v
    for i in range(4):
        for d in (-0.01, 0.01):
            v = w.copy()
            v[i] += d
            assert (i and v[i] < 0) or loss(v) >= loss(w) - 1e-6
    twice = toxicity.logistic(np.concatenate([x, x]), np.concatenate([y, y]))
    assert np.allclose(twice, toxicity.logistic(x, y, np.full(400, 2.0)), atol=1e-4)


def test_a_toxic_word_more_never_lowers_a_score():
    words = [f"word{i}" for i in range(30)]
    features = np.array(sorted(int(toxicity.word_features([w.encode()])[1][0][0]) for w in words), np.uint64)
    rng = np.random.default_rng(5)
    model = toxicity.Model(features, rng.uniform(0.5, 6, 30), np.array([-4.0, 0.9, 0.5, 0.3]))
    for _ in range(50):
        order = rng.permutation(words)
        scores = [model.scores([" ".join(order[:k]).encode()])[0] for k in range(31)]
        assert all(a <= b + 1e-12 for a, b in zip(scores, scores[1:]))


def test_one_strong_word_is_enough():
    """Documents hold several toxic words as a rule; a single one as strong as theirs is flagged all the same."""
    rng = np.random.default_rng(6)
    toxic = np.sort(rng.uniform(3, 5, (200, 2)))[:, ::-1]
    x = np.concatenate([np.column_stack([toxic, np.full(200, 1.0)]), np.column_stack([np.where(rng.random(2000) < 0.02, 1.0, 0), np.zeros((2000, 2))])])
    y = np.repeat([1.0, 0.0], [200, 2000])
    alone = x[:200] * [1, 0, 0]
    w = toxicity.logistic(np.concatenate([x, alone]), np.concatenate([y, np.ones(200)]), np.repeat([1, toxicity.ALONE], [2200, 200]))
    assert 1 / (1 + np.exp(-(w @ [1, 4.0, 0, 0]))) > 0.9


def planted(rng):
    """(text, secret or None): credentials in several parts, and texts as close to them as can be without being any."""
    alphabet = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    value = lambda n=24: "".join(rng.choice(alphabet) for _ in range(n - 2)) + "7q"
    name, host = rng.choice(["admin", "svc-batch", "loader@example.org"]), rng.choice(["db.internal.example", "10.1.2.3:5432", "queue.example.net"])
    v, other = value(), value()
    positive = [
        f"DB_USER={name}\nDB_KEY={v}\n", f"OAUTH_CLIENT_ID={value(12)}\nOAUTH_KEY={v}", f"user: {name}\npass: '{v}'", f"host={host}\nkey={v}\n", f'{{"server": "{host}", "auth": "{v}"}}', f"postgres://{name}@{host}/x {v}",
        f"AWS_ACCESS_KEY_ID=AKIA{'ABCDEFGH' * 2}\n{v}", f"url = {host}\n" + "# note\n" * 30 + f"credential {v}", f"see https://wiki.example.org/setup\nAUTH={v}", f"login = {name}\n{v}", f"app.account={name}\napp.value={v}", f"https://{name}:x@{host}/a\n{v}",
    ]
    negative = [
        f"commit {v} fixes https://example.org/issues/12", f"see https://example.org/a/b for build {v}", f"user: {name}\n\nbuild {v}", f"host={host}\n\n\nchecksum {v}", f"the id {v} has no owner", f"user: {name} logged in from the long corridor", f"key={v}",
        "host=db.internal.example\nmessage=thisisaverylongwordwithoutanydigit", f"superuserless {v}", "login = " + name + "\n" + "1" * 24, f"ghost = story {other}", f"https://example.org/{v}",
    ]
    return [(t, v) for t in positive] + [(t, None) for t in negative]


def test_credentials_by_their_parts():
    """Precision and recall over hundreds of planted texts; the README gives the figures."""
    rng, hits, missed, false = random.Random(8), 0, 0, 0
    for _ in range(40):
        for text, secret in planted(rng):
            base = secret_scan.base_spans(text)
            found = {text[s:e] for s, _, e in secret_scan.linked_spans(text, base)} | {text[s:e] for s, _, e in base if secret and secret in text[s:e] and (secret := text[s:e])}
            hits += secret is not None and bool(found & {secret})
            missed += secret is not None and not found & {secret}
            false += len(found - {secret})
    print("hits", hits, "missed", missed, "false", false)
    assert hits / (hits + missed) >= 0.98 and hits / (hits + false) >= 0.98


# copies


def test_copies_are_dealt_and_told_apart(spark, sf_dir, monkeypatch):
    """Copies of a document come to many partitions, and each copy is packed whole, under a row number of its own."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        mixed = common.written(mixing.resampled(docs, mixing.labelled_domains(docs, labels), pinned=("poor",), min_rate=3.0).withColumn("part", F.spark_partition_id()), "copies")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    several = mixed.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("part").alias("parts")).where("n > 2").collect()
    assert len(several) > 100 and sum(r.parts > 1 for r in several) > 0.8 * len(several)
    pieces = packing.pack(mixed.drop("part")).collect()
    rows = defaultdict(list)
    for r in pieces:
        rows[r.doc_id, r.row].append((r.start, r.length, r.doc_tokens))
    assert Counter(d for d, _ in rows) == {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    for parts in rows.values():
        parts.sort()
        ends = [s + n for s, n, _ in parts]
        assert [s for s, _, _ in parts] == [0, *ends[:-1]] and ends[-1] == parts[0][2]
