"""The trie of conversations that share beginnings, with totals of all subtrees by parallel tree contraction.

A node is a sequence of turns (role, text) with which some conversation begins; the root is the empty one. Nodes are found by a 128-bit hash of the sequence, the exclusive or of
hashes of its turns with their places, so that prefixes of a long conversation come from sums over chunks. Contraction goes in rounds:

1. Rake: leaves go; what they hold is added to their parents, in one aggregate.
2. Compress: of nodes with one child, those go whose depth has the round's bit set while their parent's hasn't (never two neighbours). The child moves up to the parent's parent, and its edge takes
   along what the node held. Rounds take the bits of the depth in turn, so an untouched chain halves.

A raked node's total is known when it goes. Afterwards rounds are undone from the last to the first: the total of a compressed node is that of its child plus what it held.
Rounds grow with the logarithm of the longest chain; each joins only nodes that are still there.

Turns that are null come first; turns of one number go by role, then by a hash of their text. Null role or text is empty. Rows whose conv_id is null belong to no conversation and aren't read.
Equal rows are each a turn. An empty table gives an empty result. Other columns aren't read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import common, sequences

#: Turns of a chunk.
CHUNK_ROWS = 128


def placed_turns(conversations: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """conv_id, pos (from 0), a and b (hashes of role and text), size (bytes of the text) of each turn, written to the shared folder."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), empty("role").alias("role"), empty("text").alias("text")).where("conv_id IS NOT NULL")
    rows = rows.select("conv_id", "turn", "role", F.xxhash64("role", "text").alias("a"), F.xxhash64(F.lit("second"), "role", "text").alias("b"), F.octet_length("text").cast("long").alias("size"))
    rows = sequences.chunked(rows.withColumn("tie", F.monotonically_increasing_id()), "conv_id", "turn", "role", "a", "tie", rows=chunk_rows)
    rows = common.written(rows.select("conv_id", "chunk", "idx", "a", "b", "size"), "trie-turns")
    before = F.sum("n").over(W.partitionBy("conv_id").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1))
    later = rows.groupBy("conv_id", "chunk").agg(F.count(F.lit(1)).alias("n")).select(F.col("chunk").alias("of"), before.alias("before")).where("before > 0")
    return rows.join(later, F.col("chunk") == F.col("of"), "left").select("conv_id", (F.col("idx") + F.coalesce("before", F.lit(0))).alias("pos"), "a", "b", "size")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin as the first of their five does: turns (conv_id, pos, a, b, size), and conv_id with its number of turns.

    The first h turns are those of conversation ``c - c % 5``, h being crc32 of the id modulo 9; then come c's own after its first h.
    """
    sizes = common.written(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")), "trie-sizes")
    base = F.col("conv_id") - F.col("conv_id") % 5
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    others = sizes.select(F.col("conv_id").alias("of"), F.col("n").alias("n_base"))
    ids = sizes.select("conv_id", base.alias("base"), head.alias("h"), "n").join(others, F.col("base") == F.col("of"), "left")
    ids = ids.select("conv_id", "base", "h", F.least("h", F.coalesce("n_base", F.lit(0))).alias("lent"), F.greatest(F.col("n") - F.col("h"), F.lit(0)).alias("own"))
    columns = ("a", "b", "size")
    lent = turns.where("pos < 8").withColumnRenamed("conv_id", "base").join(ids.select("conv_id", "base", "h"), "base").where("pos < h").select("conv_id", "pos", *columns)
    own = turns.join(ids.where("own > 0").select("conv_id", "h", "lent"), "conv_id").where("pos >= h").select("conv_id", (F.col("pos") - F.col("h") + F.col("lent")).alias("pos"), *columns)
    return lent.unionByName(own), ids.select("conv_id", (F.col("lent") + F.col("own")).alias("n"))


def prefixes(turns: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """conv_id, depth, x and y (hash of the conversation's first ``depth`` turns), up_x and up_y (of one turn fewer), size of the last turn's text."""
    rows = turns.select("conv_id", "pos", "size", F.xxhash64("pos", "a", "b").alias("x"), F.xxhash64(F.lit("second"), "pos", "a", "b").alias("y"), F.floor(F.col("pos") / chunk_rows).alias("part"))
    along = W.partitionBy("conv_id").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = rows.groupBy("conv_id", "part").agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    before = parts.select(F.col("conv_id").alias("of"), F.col("part").alias("of_part"), F.bit_xor("x").over(along).alias("before_x"), F.bit_xor("y").over(along).alias("before_y")).where("of_part > 0")
    inside = W.partitionBy("conv_id", "part").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    rows = rows.select("conv_id", "pos", "part", "size", "x", "y", F.bit_xor("x").over(inside).alias("upto_x"), F.bit_xor("y").over(inside).alias("upto_y"))
    rows = rows.join(before, (F.col("conv_id") == F.col("of")) & (F.col("part") == F.col("of_part")), "left")
    whole = {c: F.col(f"upto_{c}").bitwiseXOR(F.coalesce(f"before_{c}", F.lit(0))) for c in ("x", "y")}
    return rows.select("conv_id", (F.col("pos") + 1).alias("depth"), "size", *(v.alias(c) for c, v in whole.items()), *(v.bitwiseXOR(F.col(c)).alias(f"up_{c}") for c, v in whole.items()))


def subtree_totals(nodes: DataFrame, values: tuple[str, ...]) -> DataFrame:
    """id and the sums of ``values`` over each node's subtree; ``nodes`` has id, parent (null for roots), depth (more than the parent's) and the values."""
    kids = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("of")).agg(F.count(F.lit(1)).alias("kids"))
    edges = [f"{v}_edge" for v in values]
    at = nodes.join(kids, F.col("id") == F.col("of"), "left").select("id", "parent", "depth", F.when(F.isnotnull("parent"), F.col("up_depth")).alias("up_depth"), F.coalesce("kids", F.lit(0)).alias("kids"), *values, *(F.lit(0).cast("long").alias(e) for e in edges))
    at = common.cut(at)
    bits = max(1, int(at.agg(F.max("depth")).first()[0] or 0).bit_length())
    known, gone, round_ = [], [], 0
    while True:
        leaves = at.where("kids = 0")
        known.append(leaves.select("id", *values))
        if not at.where("kids > 0").head(1):
            break
        gains = leaves.where("parent IS NOT NULL").groupBy(F.col("parent").alias("of")).agg(F.count(F.lit(1)).alias("lost"), *(F.sum(F.col(v) + F.col(e)).alias(f"{v}_gain") for v, e in zip(values, edges)))
        rest = at.where("kids > 0").join(gains, F.col("id") == F.col("of"), "left")
        rest = rest.select("id", "parent", "depth", "up_depth", (F.col("kids") - F.coalesce("lost", F.lit(0))).alias("kids"), *((F.col(v) + F.coalesce(f"{v}_gain", F.lit(0))).alias(v) for v in values), *edges)
        bit = lambda c: F.shiftright(c, round_ % bits) % 2 == 1  # noqa: B023, E731
        rest = common.cut(rest.withColumn("goes", F.coalesce((F.col("kids") == 1) & bit("depth") & ~bit("up_depth"), F.lit(False))))
        went = rest.where("goes").select(F.col("id").alias("of"), F.col("parent").alias("to"), F.col("up_depth").alias("to_depth"), *(F.col(v).alias(f"{v}_held") for v in values), *(F.col(e).alias(f"{e}_up") for e in edges))
        stay = rest.where("NOT goes").join(went, F.col("parent") == F.col("of"), "left")
        moved = F.isnotnull("of")
        held = {v: F.col(v + "_held") + F.col(v + "_edge") for v in values}
        at = common.cut(
            stay.select(
                "id", F.when(moved, F.col("to")).otherwise(F.col("parent")).alias("parent"), "depth", F.when(moved, F.col("to_depth")).otherwise(F.col("up_depth")).alias("up_depth"), "kids", *values,
                *(F.when(moved, held[v] + F.col(f"{v}_edge_up")).otherwise(F.col(f"{v}_edge")).alias(f"{v}_edge") for v in values), F.col("of").alias("went"), *(held[v].alias(f"{v}_more") for v in values),
            )
        )
        gone.append(at.where("went IS NOT NULL").select("went", "id", *(f"{v}_more" for v in values)))
        round_ += 1
    # undo the rounds: a node that went in round r has a child that was there after it, so one whose total came later
    total = known[-1]
    for r in range(len(gone) - 1, -1, -1):
        back = gone[r].join(total, "id").select(F.col("went").alias("id"), *((F.col(v) + F.col(f"{v}_more")).alias(v) for v in values))
        total = total.unionByName(common.cut(back)).unionByName(known[r])
    return total


def trie(turns: DataFrame, sizes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes (id, conv_id, depth, parent, up_depth, parent_conv_id, n_convs, size), written to the shared folder, and id with conv_id of every conversation at the node where it ends."""
    at = common.written(prefixes(turns), "trie-prefixes")
    below = at.groupBy("depth", "x", "y").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("up_x").alias("up_x"), F.min("up_y").alias("up_y"), F.min("size").alias("size"))
    root = sizes.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    zero = F.lit(0).cast("long")
    root = root.select(zero.alias("depth"), zero.alias("x"), zero.alias("y"), "conv_id", "n_convs", zero.alias("up_x"), zero.alias("up_y"), zero.alias("size"))
    nodes = common.written(below.unionByName(root).withColumn("id", F.monotonically_increasing_id()), "trie-nodes")
    parents = nodes.select(F.col("id").alias("parent"), F.col("depth").alias("up_depth"), F.col("x").alias("of_x"), F.col("y").alias("of_y"), F.col("conv_id").alias("parent_conv_id"))
    up = (F.col("depth") - 1 == F.col("up_depth")) & (F.col("up_x") == F.col("of_x")) & (F.col("up_y") == F.col("of_y"))
    linked = common.written(nodes.join(parents, up, "left").select("id", "conv_id", "depth", "parent", "up_depth", "parent_conv_id", "n_convs", "size"), "trie-links")
    last = at.join(sizes.withColumnRenamed("conv_id", "of"), (F.col("conv_id") == F.col("of")) & (F.col("depth") == F.col("n"))).select("conv_id", "depth", "x", "y")
    last = last.unionByName(sizes.where("n = 0").select("conv_id", zero.alias("depth"), zero.alias("x"), zero.alias("y")))
    return linked, last.join(nodes.select("id", "depth", "x", "y"), ["depth", "x", "y"]).select("id", "conv_id")


def summarized(nodes: DataFrame, ends: DataFrame) -> DataFrame:
    """Nodes with n_children, n_leaves, saved_tokens and ends_sha256. The ids that end at a node are hashed as they stream by in order, in one task a node."""
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("id")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, "id", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long"))
    values = nodes.select("id", "parent", "depth", "up_depth", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("size")).alias("saved_tokens"))
    totals = subtree_totals(values, ("n_leaves", "saved_tokens"))
    listed = ends.select("id", "conv_id", F.col("conv_id").cast("string").alias("name")).repartition("id").sortWithinPartitions("id", "conv_id")
    hashes = listed.mapInArrow(lambda b: sequences.hashed(b, "id", "name", b","), "id long, sha256 string")
    out = nodes.join(totals, "id").join(hashes, "id", "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, sizes = rebuilt(placed_turns(common.table(spark, sf_dir, "conversations")))
    return summarized(*trie(turns, common.written(sizes, "trie-rebuilt")))


OP12_SQL = """
WITH t AS (SELECT conv_id, {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS w, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM conversations WHERE conv_id IS NOT NULL),
l AS (SELECT conv_id, list(w ORDER BY pos) AS l FROM t GROUP BY conv_id),
b AS (SELECT conv_id, l, flatten(list_transform(generate_series(1, length(CAST(conv_id AS VARCHAR))), lambda i: [CAST(ascii(substring(CAST(conv_id AS VARCHAR), CAST(i AS INT), 1)) AS BIGINT), 0, 0, 0, 0, 0, 0, 0])) AS bits FROM l),
h AS (SELECT conv_id, l, xor(list_reduce(list_concat([4294967295], bits), lambda c, x: xor(xor(c, x) >> 1, (xor(c, x) & 1) * 3988292384)), 4294967295) % 9 AS h FROM b),
r AS (SELECT c.conv_id, list_concat(coalesce(o.l[1:c.h], []), c.l[c.h + 1:]) AS l FROM h c LEFT JOIN l o ON o.conv_id = c.conv_id - c.conv_id % 5),
p AS (SELECT conv_id, l[1:k] AS pre, len(l) = k AS ends, k FROM (SELECT conv_id, l, unnest(generate_series(0, len(l))) AS k FROM r) x),
n AS (SELECT pre, k AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256 FROM p GROUP BY pre, k),
c AS (SELECT pre[1:depth - 1] AS pre, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
v AS (SELECT n.*, coalesce(n_children, 0) AS n_children, (n_convs - 1) * coalesce(strlen(n.pre[depth].text), 0) AS saved FROM n LEFT JOIN c ON n.pre = c.pre),
s AS (SELECT pre[1:k] AS pre, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves FROM (SELECT pre, saved, n_children, unnest(generate_series(0, depth)) AS k FROM v) x GROUP BY 1)
SELECT v.conv_id, v.depth, o.conv_id AS parent_conv_id, v.n_convs, v.n_children, s.n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, v.ends_sha256
FROM v JOIN s ON v.pre = s.pre LEFT JOIN n o ON v.depth > 0 AND o.pre = v.pre[1:v.depth - 1]
"""
