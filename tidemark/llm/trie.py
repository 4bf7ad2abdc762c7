"""The prefix trie of conversations, with subtree totals by parallel tree contraction.

A node is a distinct sequence of first turns, named by its smallest member and its depth.
Subtree totals come from rounds of two steps over the shrinking tree:

* rake: nodes without children add what they hold to their parents and go;
* compress: nodes with one child are spliced out of their chain; the parent takes over what
  the node holds, the child takes the node's place.  A coin per node and round sees to it
  that no two neighbours go at once.

When only the root is left, the rounds are undone from the last to the first: a raked node's
total is what it held, a spliced node's what it held and its child's total.
Rounds grow with the logarithm of the number of nodes, whatever the shape of the trie.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ranked, ship, stored

#: Turns of one conversation whose running digests are one task's work.
BLOCK = 4096
#: Members in one piece of a joined list.
PIECE = 4096


def ordered_turns(messages: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv_id, pos, role, text): turns with their place in the conversation, from 0."""
    role = F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    rows = messages.where(F.col(conv_col).isNotNull())
    rows = rows.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), role, text)
    rows = rows.withColumn("digest", F.md5(F.col("text").cast("binary")))
    return ranked(rows, ["conv_id"], ["turn", "role", "digest"], "trie-turns", "pos").select("conv_id", "pos", "role", "text")


def with_shared_prefix(turns: DataFrame, base: Column, kept: Column) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first ``kept`` turns are those of the conversation ``base``.

    Both are expressions over conv_id; ``kept`` must be small.  Returns all conversations (conv_id,
    n_turns) and their turns (conv_id, pos, role, text).
    """
    turns = stored(turns, "trie-own")
    own = turns.groupBy("conv_id").agg(F.count("*").alias("n")).withColumn("base", base).withColumn("kept", kept)
    others = own.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    plan = own.join(others, "base", "left").withColumn("n_base", F.least("kept", F.coalesce("n_base", F.lit(0))))
    plan = stored(plan.withColumn("n_turns", F.col("n_base") + F.greatest(F.lit(0), F.col("n") - F.col("kept"))), "trie-plan")
    # a base's turns go to each conversation that keeps some of them
    most = turns.select(F.col("conv_id").alias("base"), "pos", "role", "text")
    first = plan.where("n_base > 0").select("conv_id", "base", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_base").cast("long") - 1)).alias("pos"))
    first = first.join(most, ["base", "pos"]).select("conv_id", "pos", "role", "text")
    rest = turns.join(plan.select("conv_id", "kept", "n_base"), "conv_id").where("pos >= kept")
    rest = rest.select("conv_id", (F.col("pos") - F.col("kept") + F.col("n_base")).alias("pos"), "role", "text")
    return plan.select("conv_id", "n_turns"), first.unionByName(rest)


def prefix_digests(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, a, b, pa, pb, size): the digest (a, b) of the first ``depth`` turns and that of one turn fewer.

    A digest is a pair of exact sums of 64-bit hashes of (position, role, text).  Sums run within blocks
    of turns; one row per block carries them on, so a long conversation spreads over many tasks.
    """
    one = F.xxhash64("pos", F.lit(1), "role", "text").cast("decimal(20,0)")
    two = F.conv(F.substring(F.md5(F.concat_ws("\u0000", "pos", F.length("role"), "role", "text").cast("binary")), 1, 16), 16, 10).cast("decimal(20,0)")
    rows = turns.select("conv_id", "pos", F.floor(F.col("pos") / BLOCK).alias("block"), one.alias("x"), two.alias("y"), F.length("text").alias("size"))
    rows = stored(rows, "trie-hashes")
    wide = lambda c: c.cast("decimal(38,0)")
    totals = rows.groupBy("conv_id", "block").agg(wide(F.sum("x")).alias("sx"), wide(F.sum("y")).alias("sy"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select("conv_id", "block", *(F.coalesce(wide(F.sum(c).over(before)), wide(F.lit(0))).alias(c) for c in ("sx", "sy")))
    within = Window.partitionBy("conv_id", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    run = rows.withColumn("rx", wide(F.sum("x").over(within))).withColumn("ry", wide(F.sum("y").over(within))).join(carried, ["conv_id", "block"])
    a, b = wide(F.col("rx") + F.col("sx")), wide(F.col("ry") + F.col("sy"))
    return run.select("conv_id", (F.col("pos") + 1).alias("depth"), a.alias("a"), b.alias("b"), wide(a - F.col("x")).alias("pa"), wide(b - F.col("y")).alias("pb"), "size")



def subtree_totals(nodes: DataFrame, values: list[str]) -> DataFrame:
    """(id, values): sums over each node's subtree. ``nodes``: id, parent (null: the root), values as longs."""
    kids = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("kids"))
    state = stored(nodes.select("id", "parent", *values).join(kids, "id", "left").fillna({"kids": 0}), "trie-state")
    settled: list[DataFrame] = []
    spliced: list[DataFrame] = []
    zero = [F.lit(0).cast("long").alias(v) for v in values]
    sums = [F.sum(v).alias(v) for v in values]
    turn = 0
    while not state.where("parent IS NOT NULL").isEmpty():
        # rake: leaves hand over what they hold
        leaf = F.expr("kids = 0 AND parent IS NOT NULL")
        settled.append(state.where(leaf).select("id", *values))
        handed = state.where(leaf).groupBy("parent").agg(*sums, F.count("*").alias("gone"))
        handed = handed.select(F.col("parent").alias("id"), F.lit(None).cast("long").alias("parent"), *values, (-F.col("gone")).alias("kids"), F.lit(0).alias("real"))
        stay = state.where(~leaf).select("id", "parent", *values, "kids", F.lit(1).alias("real"))
        rest = stay.unionByName(handed).groupBy("id").agg(F.max("parent").alias("parent"), *sums, F.sum("kids").alias("kids"))
        rest = stored(rest, "trie-raked")
        # compress: of each edge of a child and its only-child's parent the coin decides
        coin = F.pmod(F.xxhash64("id", F.lit(turn)), F.lit(2)) == 1
        up = rest.where("parent IS NOT NULL AND kids = 1").where(coin)
        up = up.select(F.col("id").alias("parent"), F.col("parent").alias("above"), *(F.col(v).alias(f"up_{v}") for v in values))
        edge = rest.join(up, "parent", "left")
        stays = F.expr("kids = 1") & coin & F.col("parent").isNotNull()  # a child that may go itself holds its parent back
        cut = F.col("above").isNotNull() & ~stays
        edge = stored(edge.withColumn("cut", cut), "trie-edges")
        gone = edge.where("cut").select(F.col("parent").alias("id"), F.col("id").alias("child"), "above", *(F.col(f"up_{v}").alias(v) for v in values))
        spliced.append(gone.drop("above"))
        moved = edge.select("id", F.when(F.col("cut"), F.col("above")).otherwise(F.col("parent")).alias("parent"), *values, "kids", F.lit(0).alias("out"))
        taken = gone.groupBy("above").agg(*sums)
        taken = taken.select(F.col("above").alias("id"), F.lit(None).cast("long").alias("parent"), *values, F.lit(0).cast("long").alias("kids"), F.lit(0).alias("out"))
        marks = gone.select("id", F.lit(None).cast("long").alias("parent"), *zero, F.lit(0).cast("long").alias("kids"), F.lit(1).alias("out"))
        new = moved.unionByName(taken).unionByName(marks).groupBy("id")
        new = new.agg(F.max("parent").alias("parent"), *sums, F.sum("kids").alias("kids"), F.max("out").alias("out"))
        state = stored(new.where("out = 0").drop("out"), "trie-state")
        turn += 1
    known = reduce(DataFrame.unionByName, settled, state.select("id", *values))
    for gone in reversed(spliced):
        if gone.isEmpty():
            continue
        below = known.select(F.col("id").alias("child"), *(F.col(v).alias(f"below_{v}") for v in values))
        whole = gone.join(below, "child").select("id", *((F.col(v) + F.col(f"below_{v}")).alias(v) for v in values))
        known = known.unionByName(stored(whole, "trie-whole"))
    return known


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of neighbouring rows of one key as joined text, some thousand to a piece."""
    held, ids, at = None, [], 0

    def piece() -> pa.RecordBatch:
        arrays = [pa.array([held], pa.int64()), pa.array([ids[0]], pa.int64()), pa.array([",".join(map(str, ids))])]
        return pa.RecordBatch.from_arrays(arrays, names=["key", "first", "ids"])

    for batch in batches:
        for key, one in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if ids and (key != held or len(ids) == PIECE):
                yield piece()
                ids = []
            held = key
            ids.append(one)
    if ids:
        yield piece()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each key's pieces, joined by commas; rows come sorted by key and first id."""
    held, digest = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([held], pa.int64()), pa.array([digest.hexdigest()])], names=["key", "ends_sha256"])

    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if digest is not None and key == held:
                digest.update(b",")
            else:
                if digest is not None:
                    yield row()
                held, digest = key, hashlib.sha256()
            digest.update(text.encode())
    if digest is not None:
        yield row()


def joined_ids_hash(rows: DataFrame) -> DataFrame:
    """(key, ends_sha256): SHA-256 of each key's ids, ascending and joined by commas.

    Ids are sorted over all tasks and joined in pieces; only pieces of a key meet in one task, which
    hashes them one after the other.
    """
    pieces = rows.repartitionByRange("key", "one").sortWithinPartitions("key", "one").mapInArrow(_pieces, "key long, first long, ids string")
    return pieces.repartition("key").sortWithinPartitions("key", "first").select("key", "ids").mapInArrow(_hashed, "key long, ends_sha256 string")


def prefix_trie(
    messages: DataFrame,
    base: Column | None = None,
    kept: Column | None = None,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """The nodes of the prefix trie of all conversations.

    Per node: conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs, n_children,
    n_leaves, saved_tokens (over the subtree, (members - 1) times the code points of the last text) and
    ends_sha256 (of the members that end here).  With ``base`` and ``kept``, expressions over
    conv_id, the first ``kept`` turns of each conversation are replaced by those of ``base``.

    Turns are in the order of turn (null first), role and md5 of the text; a null role or text is empty, repeated turns
    are all kept.  Rows without a conversation id are left out.  A long conversation and a
    first turn that very many share spread over many tasks; a long text is hashed whole.  An empty table gives
    no node.  Other columns are ignored.
    """
    spark = messages.sparkSession
    ship(spark)
    turns = ordered_turns(messages, conv_col, turn_col, role_col, text_col)
    base = F.col("conv_id") if base is None else base
    kept = F.lit(0) if kept is None else kept
    convs, turns = with_shared_prefix(turns, base, kept.cast("long"))
    none = F.lit(0).cast("decimal(38,0)")
    nothing = F.lit(None).cast("decimal(38,0)")
    root = convs.select("conv_id", F.lit(0).cast("long").alias("depth"), none.alias("a"), none.alias("b"), nothing.alias("pa"), nothing.alias("pb"), F.lit(0).alias("size"))
    rows = stored(prefix_digests(turns).unionByName(root), "trie-rows")
    least = rows.groupBy("depth", "a", "b").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.first("pa").alias("pa"), F.first("pb").alias("pb"), F.first("size").alias("size"))
    least = stored(least.withColumn("id", F.monotonically_increasing_id()), "trie-nodes")
    above = least.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    nodes = least.join(above, ["depth", "pa", "pb"], "left")
    nodes = stored(nodes.select("id", "parent", "conv_id", "depth", "parent_conv_id", "n_convs", "size", "a", "b"), "trie-tree")
    kids = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("n_children"))
    nodes = stored(nodes.join(kids, "id", "left").fillna({"n_children": 0}), "trie-kids")
    leaves = F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("n_leaves")
    saved = ((F.col("n_convs") - 1) * F.col("size")).cast("long").alias("saved_tokens")
    totals = subtree_totals(nodes.select("id", "parent", leaves, saved), ["n_leaves", "saved_tokens"])
    ends = convs.withColumnRenamed("n_turns", "depth").join(rows.select("conv_id", "depth", "a", "b"), ["conv_id", "depth"])
    ends = stored(ends.join(nodes.select("id", "depth", "a", "b"), ["depth", "a", "b"]).select(F.col("id").alias("key"), F.col("conv_id").alias("one")), "trie-ends")
    hashed = joined_ids_hash(ends).withColumnRenamed("key", "id")
    out = nodes.join(totals, "id").join(hashed, "id", "left")
    empty = hashlib.sha256(b"").hexdigest()
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.col("n_children").cast("long").alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"),
    )


#: DuckDB SQL for the rows of the registered query, over whole prefixes as lists.
TRIE_SQL = """
WITH t AS (
  SELECT conv_id, list({'r': coalesce(role, ''), 'x': coalesce(text, '')}
                       ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS own
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (
  SELECT *, xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda h, b: list_reduce([xor(h, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)),
    4294967295) % 6 AS kept
  FROM t),
b AS (
  SELECT h.conv_id, list_concat(coalesce(o.own[1:h.kept], []), h.own[h.kept + 1:]) AS v
  FROM h LEFT JOIN t o ON o.conv_id = h.conv_id - h.conv_id % 100),
p AS (SELECT conv_id, v, unnest(range(0, len(v) + 1)) AS depth FROM b),
n AS (
  SELECT v[1:depth] AS prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE depth = len(v)) AS ends
  FROM p GROUP BY ALL),
k AS (SELECT prefix[1:depth - 1] AS prefix, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
w AS (
  SELECT n.*, coalesce(k.n_children, 0) AS n_children, CASE WHEN depth > 0 THEN (n_convs - 1) * length(prefix[depth].x) ELSE 0 END AS saved
  FROM n LEFT JOIN k USING (prefix)),
d AS (SELECT prefix AS own, n_children, saved, unnest(range(0, depth + 1)) AS up, depth FROM w),
s AS (SELECT own[1:up] AS prefix, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved) AS saved_tokens FROM d GROUP BY ALL)
SELECT w.conv_id, w.depth, q.conv_id AS parent_conv_id, w.n_convs, w.n_children, s.n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens,
       sha256(coalesce(w.ends, '')) AS ends_sha256
FROM w JOIN s USING (prefix) LEFT JOIN w q ON w.depth > 0 AND q.depth = w.depth - 1 AND q.prefix = w.prefix[1:w.depth - 1]
"""
