"""Connected components of a link table, as repeated joins on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import dropped


def components(edges: DataFrame, a: str = "a", b: str = "b", kind: str = "long") -> DataFrame:
    """(node, root): for every node of a link the smallest node reachable from it.

    Large-star and small-star steps in turn: every node links its larger neighbours to
    its smallest one, then its smaller neighbours likewise.  The number of links never
    grows, and stars are reached after a logarithmic number of rounds.  Each round is
    written to the shared folder and replaces the one before.  A node's minimum is a
    hash aggregate with partial sums on the map side; its join back to the links can
    be split where a node has very many.  Self-links and null ends are left out.
    """
    spark = edges.sparkSession
    schema = f"u {kind}, v {kind}"

    def write(df: DataFrame) -> tuple[DataFrame, str]:
        path = scratch_path(spark, "links")
        df.write.parquet(path)
        return spark.read.schema(schema).parquet(path), path

    def star(links: DataFrame, larger: bool) -> DataFrame:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))) if larger else links
        # u > v in links; for the small star the neighbours of u are exactly its smaller ones
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        linked = both.join(least, "u")
        if larger:
            return linked.where("v > u AND v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        moved = linked.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return moved.unionByName(least.select("u", F.col("m").alias("v")))

    known = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    flat = known.select(F.greatest(a, b).cast(kind).alias("u"), F.least(a, b).cast(kind).alias("v"))
    links, path = write(flat.where("u != v").distinct())
    mark = None
    while True:
        now = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if mark == (now["n"], now["h"]) or not now["n"]:
            break
        mark = (now["n"], now["h"])
        large, large_path = write(star(links, larger=True).distinct())
        dropped(spark, path)
        links, path = write(star(large, larger=False).distinct())
        dropped(spark, large_path)
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
