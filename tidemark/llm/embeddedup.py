"""Embedding near-duplicates by int8 tile products with error bounds.

Vectors are compared within their label only.  Equal vectors count as one class.
The classes of a label are dealt out to tiles; every pair of tiles is one group.
A vector u (of length one) is stored as scale * q + r with int8 q, and |r| = e is
measured, so the true cosine of u and v lies within e_u + e_v + e_u * e_v of
scale_u * scale_v * (q_u . q_v).  Only pairs that can reach the threshold are
computed in double precision.

A tile pair reports, per class, how many vectors it links to and the smallest
class it is connected with: at most a row per class, never the links themselves.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, stored
from .components import components
from .vectors import blocked, matrix, numbered, roots, usable

#: Beyond the quantisation error: rounding of the float32 product and of the bound itself.
SLACK = 1e-5
_EXACT = 1 << 24  # integers that float32 holds exactly


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows, their scales, measured error bounds, and the rows at length one."""
    unit = x / np.abs(x).max(axis=1, keepdims=True)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    scale = np.abs(unit).max(axis=1) / 127
    q = np.rint(unit / scale[:, None]).astype(np.int8)
    error = np.linalg.norm(unit - scale[:, None] * q, axis=1)
    return q, scale, error * (1 + 1e-9) + 1e-12, unit


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer products of int8 rows, exact: float32 takes as many components at once as stay exact."""
    step = _EXACT // (127 * 127)
    out = np.zeros((len(a), len(b)), np.float64 if a.shape[1] > step else np.float32)
    for at in range(0, a.shape[1], step):
        out += a[:, at : at + step].astype(np.float32) @ b[:, at : at + step].astype(np.float32).T
    return out


def tile_links(a: dict, b: dict | None, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Indices (x in a, y in b) of the pairs with cosine >= threshold; within a tile x < y."""
    other = a if b is None else b
    bound = a["e"][:, None] + other["e"][None, :] + a["e"][:, None] * other["e"][None, :]
    near = product(a["q"], other["q"]) * a["s"][:, None] * other["s"][None, :]
    possible = near + bound + SLACK >= threshold
    if b is None:
        possible = np.triu(possible, 1)
    x, y = np.nonzero(possible)
    keep = np.zeros(len(x), bool)
    for at in range(0, len(x), 1 << 15):  # full precision, a bounded number of pairs at a time
        i, j = x[at : at + (1 << 15)], y[at : at + (1 << 15)]
        cosine = np.einsum("ij,ij->i", a["u"][i], other["u"][j])
        keep[at : at + (1 << 15)] = cosine >= threshold
    return x[keep], y[keep]


def _tile(width: int):
    def run(table: pa.Table) -> pa.Table:
        q, s, e, u = quantise(matrix(table.column("vector"), width, "f8"))
        cells = {
            "label": pa.array([table.column("label")[0].as_py()], pa.string()),
            "block": pa.array([table.column("block")[0].as_py()], pa.int32()),
            "n_blocks": pa.array([table.column("n_blocks")[0].as_py()], pa.int32()),
        }
        parts = {"c": table.column("class").to_numpy(), "n": table.column("n").to_numpy(), "s": s, "e": e, "q": q, "u": u}
        return pa.table(cells | {k: pa.array([np.ascontiguousarray(v).tobytes()], pa.binary()) for k, v in parts.items()})

    return run


def _read_tile(table: pa.Table, k: int, width: int) -> dict:
    kinds = {"c": "i8", "n": "i8", "s": "f8", "e": "f8", "q": "i1", "u": "f8"}
    out = {name: np.frombuffer(table.column(name)[k].as_py(), kind) for name, kind in kinds.items()}
    return out | {name: out[name].reshape(-1, width) for name in "qu"}


def _pair(width: int, threshold: float):
    def run(table: pa.Table) -> pa.Table:
        tiles = [_read_tile(table, k, width) for k in np.argsort(table.column("block").to_numpy())]
        a, b = tiles[0], tiles[1] if len(tiles) > 1 else None
        x, y = tile_links(a, b, threshold)
        classes, sizes = (a["c"], a["n"]) if b is None else (np.concatenate([a["c"], b["c"]]), np.concatenate([a["n"], b["n"]]))
        if b is not None:
            y = y + len(a["c"])
        linked = np.bincount(x, sizes[y], len(classes)) + np.bincount(y, sizes[x], len(classes))
        root = roots(len(classes), x, y)
        at = np.flatnonzero(linked)
        return pa.table({"class": classes[at], "root": classes[root[at]], "links": linked[at].astype(np.int64)})

    return run


def embedding_duplicates(
    vectors: DataFrame,
    threshold: float = 0.98,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    tile: int = 1024,
) -> DataFrame:
    """Link vectors of one label whose cosine, in double precision, is at least ``threshold`` (above 0).

    Returns a row per input row: vec_id, n_links (other rows linked directly), component_id
    (smallest vec_id reachable, its own included) and kept (it is its own component).

    Rows with a null label, and vectors that are null, empty, zero or hold null or non-finite
    components, link with nothing.  Of vectors of unequal size the shorter is taken to end
    in zeros.  Rows that repeat an id are rows of their own; a null id is never a
    component_id of others and its row is kept.  An empty table gives an empty result.
    Other columns are ignored.
    """
    ship(vectors.sparkSession)
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(label_col).cast("string").alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    )
    good = F.col("label").isNotNull() & usable("vector") & F.exists("vector", lambda x: x != 0)
    grouped = rows.where(good).groupBy("label", "vector").agg(F.count("*").alias("n"), F.min("vec_id").alias("least"))
    classes = numbered(grouped, "vector-classes", "class")
    width = classes.agg(F.max(F.size("vector")).alias("w")).first()["w"] or 1

    sizes = classes.groupBy("label").agg(F.count("*").alias("of_label"))
    dealt = blocked(classes.join(sizes, "label"), "class", F.col("of_label"), tile)
    schema = "label string, block int, n_blocks int, c binary, n binary, s binary, e binary, q binary, u binary"
    tiles = dealt.select("label", "block", "n_blocks", "class", "n", "vector").groupBy("label", "block").applyInArrow(_tile(width), schema)
    tiles = stored(tiles, "tiles")
    # each tile goes to the pair with every tile of its label, itself included
    others = F.explode(F.expr("sequence(0, n_blocks - 1)")).alias("other")
    paired = tiles.select("*", others).withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    found = paired.groupBy("label", "low", "high").applyInArrow(_pair(width, threshold), "class long, root long, links long")
    found = stored(found, "tile-links")

    node = components(found.select(F.col("class").alias("a"), F.col("root").alias("b")))
    counted = found.groupBy("class").agg(F.sum("links").alias("links"))
    joined = classes.join(counted, "class", "left").join(node, F.col("class") == F.col("node"), "left")
    of_class = stored(
        joined.select("label", "vector", "least", F.coalesce("root", "class").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links")),
        "vector-components",
    )
    least = of_class.groupBy("root").agg(F.min("least").alias("component_id"))
    known = of_class.join(least, "root").select("label", "vector", "links", "component_id")
    marked = rows.select("vec_id", F.when(good, F.col("label")).alias("label"), "vector").join(known, ["label", "vector"], "left")
    component = F.coalesce("component_id", "vec_id")
    return marked.select(
        "vec_id",
        F.coalesce("links", F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )


#: DuckDB SQL for the rows of the registered query: all pairs, so for small tables only.
DUPLICATES_SQL = """
WITH RECURSIVE x AS (
  SELECT vec_id, label, generate_subscripts(embedding, 1) AS i, CAST(unnest(embedding) AS DOUBLE) AS x
  FROM embeddings WHERE label IS NOT NULL),
n AS (
  SELECT vec_id, sqrt(sum(x * x)) AS norm FROM x GROUP BY vec_id
  HAVING bool_and(x IS NOT NULL AND isfinite(x)) AND sum(x * x) > 0),
pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b, sum(a.x * b.x) AS dot
  FROM x AS a JOIN x AS b ON a.label = b.label AND a.i = b.i AND a.vec_id < b.vec_id
  GROUP BY a.vec_id, b.vec_id),
near AS (
  SELECT a, b FROM pairs JOIN n AS na ON na.vec_id = a JOIN n AS nb ON nb.vec_id = b
  WHERE dot / (na.norm * nb.norm) >= 0.98),
links AS (SELECT a, b FROM near UNION ALL SELECT b, a FROM near),
reach AS (
  SELECT vec_id, vec_id AS root FROM embeddings
  UNION
  SELECT links.b, reach.root FROM reach JOIN links ON links.a = reach.vec_id),
roots AS (SELECT vec_id, min(root) AS component_id FROM reach GROUP BY vec_id),
counts AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT roots.vec_id, coalesce(n_links, 0) AS n_links, component_id, roots.vec_id = component_id AS kept
FROM roots LEFT JOIN counts ON counts.vec_id = roots.vec_id
"""
