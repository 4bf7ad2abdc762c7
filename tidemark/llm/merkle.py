"""Merkle manifest of a dataset, with nested-interval labels.

Rows of one source are leaves in order; every ``fanout`` consecutive nodes become a node,
until one is left, the subroot; the subroots of all sources form a tree of their own.

A node is labelled with the interval of leaf ranks it covers.  Level by level from the top,
nodes join the parent whose interval contains theirs, looked up by the bucket of ranks of
the parent's level, and take over its ancestors.  What the parent's interval has besides the
node's own is the siblings: those before it and those after it.  A parent has at most
``fanout`` children, so no join key is hot, however large a source is.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ranked, stored

STEP = "array<struct<left:string,right:string>>"


def row_hash(fields: Sequence[Column]) -> Column:
    """SHA-256 (hex) of the fields' UTF-8 byte counts and values; a null field is ``-``."""

    def one(c: Column) -> Column:
        v = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-"))

    return F.sha2(F.concat(*map(one, fields)), 256)


@dataclass
class Tree:
    """Nodes of a forest by level: group columns, level, lo, hi (leaf ranks), hash and, over leaves, kids."""

    levels: list[DataFrame]
    group: list[str]
    fanout: int

    def nodes(self) -> DataFrame:
        """(group, level, lo, hi, hash) of all nodes."""
        return reduce(DataFrame.unionByName, [n.select(*self.group, F.lit(k).alias("level"), "lo", "hi", "hash") for k, n in enumerate(self.levels)])

    def tops(self) -> DataFrame:
        """(group, level, hash): the one node left of each group."""
        last = F.max(F.struct("level", "hash")).alias("top")
        return self.nodes().where("lo = 0").groupBy(*self.group).agg(last).select(*self.group, "top.level", "top.hash")


def forest(leaves: DataFrame, group: list[str], fanout: int, carry: Sequence[str] = ()) -> Tree:
    """The trees over ``leaves`` (group columns, rank from 0, hash); kids of the first level also hold ``carry``."""
    own = stored(leaves.select(*group, F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi"), "hash", *carry), "merkle-leaves")
    levels, level, span = [own], 0, fanout
    most = own.agg(F.max("hi")).first()[0] or 0
    while span // fanout < most:
        kid = F.struct("lo", "hi", "hash", *(carry if level == 0 else ()))
        grouped = levels[-1].groupBy(*group, F.floor(F.col("lo") / span).alias("bucket")).agg(F.array_sort(F.collect_list(kid)).alias("kids"))
        # a group's one and only node is its top
        grouped = grouped.where((F.size("kids") > 1) | (F.col("bucket") > 0))
        joined = F.sha2(F.array_join(F.transform("kids", lambda k: k["hash"]), ""), 256)
        node = grouped.select(*group, F.col("kids")[0]["lo"].alias("lo"), F.element_at("kids", -1)["hi"].alias("hi"), joined.alias("hash"), "kids")
        levels.append(stored(node, "merkle-level"))
        level, span = level + 1, span * fanout
    return Tree(levels, group, fanout)


def _siblings(kids: str, lo: str, hi: str) -> Column:
    """The parent's interval without [lo, hi): the hashes before it and after it, joined."""
    joined = "array_join(transform(filter({kids}, k -> {test}), k -> k.hash), '')"
    left, right = joined.format(kids=kids, test=f"k.hi <= {lo}"), joined.format(kids=kids, test=f"k.lo >= {hi}")
    return F.expr(f"named_struct('left', {left}, 'right', {right})")


def ancestors(tree: Tree, tops: DataFrame, carry: Sequence[str]) -> DataFrame:
    """Every leaf with the siblings of itself and of its ancestors, from the leaf upwards, in ``path``.

    ``tops`` has for each group the level of its top node, the path above it, and columns that all
    its leaves get.  Returns group columns, lo, hash, ``carry``, path and those columns.
    """
    group, given = tree.group, [c for c in tops.columns if c not in (*tree.group, "level", "path")]
    below = None
    for level in range(len(tree.levels) - 1, 0, -1):
        nodes, span = tree.levels[level], tree.fanout ** (level + 1)
        tree_tops = nodes.where("lo = 0").join(tops.where(F.col("level") == level).drop("level"), group)
        found = tree_tops.select(*group, "lo", "hi", "kids", "path", *given)
        if below is not None:
            parent = below.select(*group, F.floor(F.col("lo") / span).alias("bucket"), F.col("lo").alias("plo"), F.col("hi").alias("phi"), F.col("kids").alias("all_kids"), "path", *given)
            inside = nodes.withColumn("bucket", F.floor(F.col("lo") / span)).join(parent, [*group, "bucket"])
            inside = inside.where("plo <= lo AND hi <= phi")
            path = F.concat(F.array(_siblings("all_kids", "lo", "hi")), F.col("path"))
            found = found.unionByName(inside.select(*group, "lo", "hi", "kids", path.alias("path"), *given))
        below = stored(found, "merkle-ancestors")
    alone = tree.levels[0].where("lo = 0").join(tops.where("level = 0").drop("level"), group)
    out = alone.select(*group, "lo", "hash", *carry, "path", *given)
    if below is not None:
        each = below.select(*group, F.explode("kids").alias("kid"), "kids", "path", *given)
        each = each.withColumn("path", F.concat(F.array(_siblings("kids", "kid.lo", "kid.hi")), F.col("path")))
        out = out.unionByName(each.select(*group, "kid.lo", "kid.hash", *[f"kid.{c}" for c in carry], "path", *given))
    return out


@dataclass
class Manifest:
    """The root, the nodes of the sources' trees and of the tree over them, and a proof per row."""

    root: str | None
    nodes: DataFrame
    proofs: DataFrame


def manifest(
    docs: DataFrame,
    fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    source_col: str = "source",
    id_col: str = "doc_id",
    fanout: int = 16,
    claimed: Mapping[str, Column] | None = None,
) -> Manifest:
    """The Merkle manifest of ``docs``.

    ``nodes``: tree (``source`` or ``root``), source, level, lo, hi, hash; a node covers the ranks lo to
    hi - 1 of its source's rows (of the sources).  ``proofs``: doc_id, source, leaf, claim, subroot,
    path (structs of the joined hashes to the left and to the right, from the leaf's level to the
    root).  ``claim`` is the hash of the row with the columns of ``claimed`` in place of its own; null
    where that makes no difference.

    Rows of a source are in the order of their ids (null first), equal ids in that of their hashes, so
    repeated rows are neighbours.  Sources are in bytewise order, a null source first.  Nulls, empty and
    long texts are fields like any others; a long text is hashed in one task.  An empty table has no root, no node
    and no proof.  Other columns are ignored.
    """
    if fanout < 2:
        raise ValueError("fanout must be at least 2")
    own = [F.col(c) for c in fields]
    leaf = row_hash(own)
    other = row_hash([claimed.get(c, F.col(c)) for c in fields]) if claimed else F.lit(None).cast("string")
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("name"),
        F.col(source_col).isNotNull().alias("named"),
        leaf.alias("hash"),
        other.alias("claim"),
    )
    rows = stored(rows.withColumn("claim", F.nullif("claim", "hash")), "merkle-rows")
    group = ["named", "name"]
    carry = ["doc_id", "claim"]
    sources = forest(ranked(rows, group, ["doc_id", "hash"], "merkle-ranks"), group, fanout, carry)
    subroots = stored(sources.tops(), "merkle-subroots")
    one = subroots.select(F.lit(0).alias("tree"), *group, "level", "hash")
    whole = forest(ranked(one, ["tree"], group, "merkle-sources"), ["tree"], fanout, [*group, "level"])
    top = whole.tops().first()
    root = top["hash"] if top else None
    start = F.array().cast(STEP).alias("path")
    above = ancestors(whole, whole.tops().select("tree", F.col("level"), start), [*group, "level"])
    above = stored(above.select(*group, "level", "path", F.col("hash").alias("subroot")), "merkle-above")
    proofs = ancestors(sources, above, carry)
    source = F.when(F.col("named"), F.col("name")).alias("source")
    nodes = sources.nodes().select(F.lit("source").alias("tree"), source, "level", "lo", "hi", "hash")
    nodes = nodes.unionByName(whole.nodes().select(F.lit("root").alias("tree"), F.lit(None).cast("string").alias("source"), "level", "lo", "hi", "hash"))
    return Manifest(root, nodes, proofs.select("doc_id", source, F.col("hash").alias("leaf"), "claim", "subroot", "path"))


def siblings_hash(path: str = "path") -> Column:
    """SHA-256 of all siblings of a path, level by level, left to right."""
    return F.expr(f"sha2(array_join(transform({path}, p -> concat(p.left, p.right)), ''), 256)")


def folded(leaf: str | Column, path: str = "path") -> Column:
    """The root that a leaf and its siblings give."""
    start = F.col(leaf) if isinstance(leaf, str) else leaf
    return F.aggregate(path, start, lambda a, p: F.sha2(F.concat(p["left"], a, p["right"]), 256))


#: DuckDB SQL for the rows of the registered query; levels of both trees by recursion.
_CRC = """list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda h, b: list_reduce([xor(h, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))"""


def _hash_sql(text: str) -> str:
    parts = []
    for c in ("doc_id", "source", "lang", "n_chars", text):
        v = f"CAST({c} AS VARCHAR)"
        parts.append(f"coalesce(CAST(octet_length(encode({v})) AS VARCHAR) || ':' || {v}, '-')")
    return "sha256(" + " || ".join(parts) + ")"


MERKLE_SQL = f"""
WITH RECURSIVE d AS (
  SELECT *, source IS NOT NULL AS named, coalesce(source, '') AS name, {_hash_sql('text')} AS leaf,
         CASE WHEN xor({_CRC}, 4294967295) % 5 = 0
              THEN {_hash_sql("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS claim
  FROM documents),
l AS (SELECT *, row_number() OVER (PARTITION BY named, name ORDER BY doc_id NULLS FIRST, leaf) - 1 AS lo FROM d),
s(lvl, named, name, k, h, n) AS (
  SELECT 0, named, name, lo, leaf, count(*) OVER (PARTITION BY named, name) FROM l
  UNION ALL
  SELECT any_value(lvl) + 1, named, name, k // 16, sha256(string_agg(h, '' ORDER BY k)), (any_value(n) + 15) // 16
  FROM s WHERE n > 1 GROUP BY named, name, k // 16),
sub AS (SELECT named, name, lvl, h, row_number() OVER (ORDER BY named, encode(name)) - 1 AS pos FROM s WHERE n = 1),
t(lvl, k, h, n) AS (
  SELECT 0, pos, h, count(*) OVER () FROM sub
  UNION ALL
  SELECT any_value(lvl) + 1, k // 16, sha256(string_agg(h, '' ORDER BY k)), (any_value(n) + 15) // 16 FROM t WHERE n > 1 GROUP BY k // 16),
step AS (
  SELECT a.named, a.name, a.lvl, a.k, coalesce(string_agg(b.h, '' ORDER BY b.k) FILTER (WHERE b.k < a.k), '') AS x,
         coalesce(string_agg(b.h, '' ORDER BY b.k) FILTER (WHERE b.k > a.k), '') AS y
  FROM s a JOIN s b ON a.lvl = b.lvl AND a.named = b.named AND a.name = b.name AND a.k // 16 = b.k // 16 WHERE a.n > 1
  GROUP BY a.named, a.name, a.lvl, a.k
  UNION ALL
  SELECT sub.named, sub.name, sub.lvl + a.lvl, -1, coalesce(string_agg(b.h, '' ORDER BY b.k) FILTER (WHERE b.k < a.k), ''),
         coalesce(string_agg(b.h, '' ORDER BY b.k) FILTER (WHERE b.k > a.k), '')
  FROM sub JOIN t a ON a.n > 1 AND a.k = sub.pos // CAST(pow(16, a.lvl) AS BIGINT) JOIN t b ON a.lvl = b.lvl AND a.k // 16 = b.k // 16
  GROUP BY sub.named, sub.name, sub.lvl, a.lvl),
f(doc_id, named, name, lo, top, leaf, lvl, acc, sib) AS (
  SELECT l.doc_id, l.named, l.name, l.lo, sub.lvl, l.leaf, 0, coalesce(l.claim, l.leaf), '' FROM l JOIN sub USING (named, name)
  UNION ALL
  SELECT f.doc_id, f.named, f.name, f.lo, f.top, f.leaf, f.lvl + 1, sha256(step.x || f.acc || step.y), f.sib || step.x || step.y
  FROM f JOIN step ON step.named = f.named AND step.name = f.name AND step.lvl = f.lvl
    AND step.k = CASE WHEN f.lvl < f.top THEN f.lo // CAST(pow(16, f.lvl) AS BIGINT) ELSE -1 END),
r AS (SELECT h AS root FROM t WHERE n = 1)
SELECT f.doc_id, f.leaf, sub.h AS subroot, r.root, sha256(f.sib) AS proof_sha256, f.acc AS folded_root, f.acc = r.root AS verified
FROM f JOIN sub USING (named, name) CROSS JOIN r
QUALIFY f.lvl = max(f.lvl) OVER (PARTITION BY f.named, f.name)
"""
