"""Exact top-k search by inner product in three phases with a uniform threshold.

The components of all vectors are dealt out to ``slices`` lists; a score is the sum
of one partial score per list.  Candidates and queries come in blocks; a group is a
candidate block, a query block and a slice.

1. Each list reports its ``depth`` * k best partial scores per query.  The candidates
   seen are scored exactly; the k-th best of these scores is a safe cutoff t.
2. Every list gets t with its queries and reports all entries of at least
   t / slices.  A candidate that reaches t does so in one list at least.
3. Sums of the reported entries raise the cutoff and bound what is missing; the
   candidates that can still reach it are scored exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ship, stored
from .vectors import blocked, matrix, numbered, usable

_LEAST = -(1 << 62)


def partial_scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer products; in floating point where that is exact."""
    top = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * q.shape[1]
    if top < 1 << 52:
        return (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    return q @ c.T


PACKED = "block int, slice int, rows binary, part binary, cut binary"


def _pack(width: int, slices: int):
    """A block as one row per slice; queries may carry their cutoffs."""
    edges = np.linspace(0, width, slices + 1).astype(int).tolist()

    def run(table: pa.Table) -> pa.Table:
        m = matrix(table.column("vector"), width, "i8")
        n = len(edges) - 1
        cut = table.column("cut").to_numpy().astype("i8").tobytes() if "cut" in table.column_names else None
        return pa.table({
            "block": pa.array([table.column("block")[0].as_py()] * n, pa.int32()),
            "slice": pa.array(range(n), pa.int32()),
            "rows": pa.array([table.column("row").to_numpy().tobytes()] * n, pa.binary()),
            "part": pa.array([np.ascontiguousarray(m[:, a:b]).tobytes() for a, b in zip(edges[:-1], edges[1:])], pa.binary()),
            "cut": pa.array([cut] * n, pa.binary()),
        })

    return run


def _pairs(kernel, names: list[str]):
    """A kernel over groups of a candidate and a query block; no rows where either is missing."""

    def run(table: pa.Table) -> pa.Table:
        if table.num_rows == 2:
            return kernel(table)
        kinds = [pa.int32() if n == "slice" else pa.int64() for n in names]
        return pa.table({n: pa.array([], t) for n, t in zip(names, kinds)})

    return run


def _read(table: pa.Table, is_query: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    k = table.column("is_query").to_pylist().index(is_query)
    rows = np.frombuffer(table.column("rows")[k].as_py(), "i8")
    part = np.frombuffer(table.column("part")[k].as_py(), "i8").reshape(len(rows), -1)
    cut = table.column("cut")[k].as_py()
    return rows, part, None if cut is None else np.frombuffer(cut, "i8")


def _lists(k: int):
    """Phase 1: the k best partial scores of each query in this group of blocks."""

    def run(table: pa.Table) -> pa.Table:
        queries, q, _ = _read(table, True)
        rows, c, _ = _read(table, False)
        scores = partial_scores(q, c)
        scores[queries[:, None] == rows[None, :]] = _LEAST
        best = np.argpartition(-scores, min(k, scores.shape[1]) - 1, axis=1)[:, :k]
        partial = np.take_along_axis(scores, best, axis=1)
        keep = partial > _LEAST
        at = np.broadcast_to(queries[:, None], best.shape)
        which = table.column("slice")[0].as_py()
        return pa.table({
            "query": at[keep], "row": rows[best][keep], "slice": pa.array([which] * int(keep.sum()), pa.int32()), "partial": partial[keep],
        })

    return run


def _entries(slices: int):
    """Phase 2: all entries of at least the query's uniform share of the cutoff."""

    def run(table: pa.Table) -> pa.Table:
        queries, q, cut = _read(table, True)
        rows, c, _ = _read(table, False)
        scores = partial_scores(q, c)
        enough = scores >= -(-cut // slices)[:, None]
        enough &= queries[:, None] != rows[None, :]
        x, y = np.nonzero(enough)
        return pa.table({"query": queries[x], "row": rows[y], "partial": scores[x, y]})

    return run


def _best(df: DataFrame, k: int, key: list[str], *order: Column) -> DataFrame:
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def top_k(
    vectors: DataFrame,
    k: int = 5,
    query_every: int = 50,
    scale: float = 256.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    slices: int = 2,
    candidate_block: int = 4096,
    query_block: int = 512,
    depth: int = 4,
) -> DataFrame:
    """The k best candidates of each query by the inner product of floor(scale * x), exactly.

    Queries are the rows whose id is divisible by ``query_every``; candidates are all rows but
    the query's own.  Returns query_id, rank (from 1), vec_id, score; ties go to the smaller
    vec_id, null ids last.  Fewer than k candidates give fewer rows.

    Vectors that are null, empty or hold null or non-finite components take no part.  Of
    vectors of unequal size the shorter is taken to end in zeros.  Rows that repeat an id are
    rows of their own, as queries and as candidates.  An empty table gives an empty result.
    Scaled components and scores must fit a long.  Other columns are ignored.
    """
    ship(vectors.sparkSession)
    source = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    whole = F.transform("vector", lambda x: F.floor(x * F.lit(scale)).cast("long"))
    rows = numbered(source.where(usable("vector")).select("vec_id", whole.alias("vector")), "vectors", "row")
    is_query = F.col("vec_id") % query_every == 0
    size = rows.agg(F.count("*").alias("n"), F.count(F.when(is_query, 1)).alias("q"), F.max(F.size("vector")).alias("w")).first()
    slices = max(1, min(slices, size["w"] or 1))

    pack = _pack(size["w"] or 1, slices)
    cands = stored(blocked(rows, "row", size["n"], candidate_block).groupBy("block").applyInArrow(pack, PACKED), "candidates")
    dealt = blocked(rows.where(is_query), "row", size["q"], query_block).select("block", "row", "vector")
    n_cand = max(1, -(-size["n"] // candidate_block))
    n_query = max(1, -(-size["q"] // query_block))

    def groups(queries: DataFrame, kernel, names: list[str]) -> DataFrame:
        """The kernel on each query block beside each candidate block, slice by slice."""
        fields = ["slice", "rows", "part", "cut"]
        to_cands = F.explode(F.sequence(F.lit(0), F.lit(n_cand - 1))).alias("cand_block")
        to_queries = F.explode(F.sequence(F.lit(0), F.lit(n_query - 1))).alias("query_block")
        blocks = queries.groupBy("block").applyInArrow(pack, PACKED)
        left = blocks.select(F.col("block").alias("query_block"), to_cands, F.lit(True).alias("is_query"), *fields)
        right = cands.select(to_queries, F.col("block").alias("cand_block"), F.lit(False).alias("is_query"), *fields)
        schema = ", ".join(f"{n} int" if n == "slice" else f"{n} long" for n in names)
        paired = left.unionByName(right).groupBy("query_block", "cand_block", "slice")
        return paired.applyInArrow(_pairs(kernel, names), schema)

    def scored(pairs: DataFrame) -> DataFrame:
        """Exact scores of (query, row) pairs."""
        a = rows.select(F.col("row").alias("query"), F.col("vector").alias("q"))
        b = rows.select("row", F.col("vector").alias("c"))
        size = F.least(F.size("q"), F.size("c"))
        products = F.zip_with(F.slice("q", 1, size), F.slice("c", 1, size), lambda x, y: x * y)
        score = F.aggregate(products, F.lit(0).cast("long"), lambda s, x: s + x)
        return pairs.join(b, "row").join(a, "query").select("query", "row", score.alias("score"))

    # 1: local lists, exact scores of what they show, the cutoff
    shown_per_list = k * depth  # deeper lists give a higher cutoff and fewer entries in the second phase
    lists = groups(dealt, _lists(shown_per_list), ["query", "row", "slice", "partial"])
    seen = _best(lists, shown_per_list, ["query", "slice"], F.desc("partial"), F.asc("row")).select("query", "row").distinct()
    shown = stored(scored(seen), "topk-seen")
    ranked = _best(shown, k, ["query"], F.desc("score"), F.asc("row"))
    cutoff = ranked.groupBy("query").agg(F.when(F.count("*") == k, F.min("score")).otherwise(F.lit(_LEAST)).alias("cut"))
    cutoff = stored(cutoff, "topk-cutoff")

    # 2: the cutoff travels with its query block, every list answers with what is sufficient
    told = dealt.join(cutoff, F.col("row") == F.col("query"), "left")
    told = told.select("block", "row", "vector", F.coalesce("cut", F.lit(_LEAST)).alias("cut"))
    entries = groups(told, _entries(slices), ["query", "row", "partial"])
    sums = stored(entries.groupBy("query", "row").agg(F.sum("partial").alias("sum"), F.count("*").alias("lists")), "topk-entries")

    # 3: a better cutoff from complete sums, then the rest of what can still reach it
    complete = sums.where(F.col("lists") == slices).select("query", "row", F.col("sum").alias("score"))
    known = complete.unionByName(shown).distinct()
    better = _best(known, k, ["query"], F.desc("score"), F.asc("row")).groupBy("query")
    better = better.agg(F.when(F.count("*") == k, F.min("score")).otherwise(F.lit(_LEAST)).alias("better"))
    bounded = sums.where(F.col("lists") < slices).join(cutoff, "query").join(better, "query")
    could = bounded.where((F.col("cut") == _LEAST) | (F.col("sum") * slices + (slices - F.col("lists")) * F.col("cut") > F.col("better") * slices))
    final = known.unionByName(scored(could.select("query", "row"))).distinct()
    ids = rows.select("row", "vec_id")
    named = final.join(ids, "row").join(ids.select(F.col("row").alias("query"), F.col("vec_id").alias("query_id")), "query")
    best = _best(named, k, ["query"], F.desc("score"), F.asc_nulls_last("vec_id"), F.asc("row"))
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


#: DuckDB SQL for the rows of the registered query: all pairs of a query and a candidate.
TOP_K_SQL = """
WITH x AS (
  SELECT vec_id, generate_subscripts(embedding, 1) AS i, unnest(embedding) AS x FROM embeddings),
bad AS (SELECT DISTINCT vec_id FROM x WHERE x IS NULL OR NOT isfinite(x)),
v AS (
  SELECT vec_id, i, CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) AS x
  FROM x WHERE vec_id NOT IN (SELECT vec_id FROM bad)),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
  FROM v AS q JOIN v AS c ON q.i = c.i AND q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0 GROUP BY q.vec_id, c.vec_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
