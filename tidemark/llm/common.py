"""Small helpers that several operators of this subpackage share."""

from __future__ import annotations

import io
import os
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import checkpoint_dir, scratch_path

_ROOT = Path(__file__).resolve().parents[2]


def ship(spark: SparkSession) -> None:
    """Lets Python workers import this package, once per application.

    Where it is installed, or on the workers' PYTHONPATH, there is nothing to do; else its
    source goes to the shared folder as an archive that Spark hands to every executor.
    """
    sc = spark.sparkContext
    on_path = {str(Path(p).resolve()) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p}
    name = f"tidemark-{sc.applicationId}.zip"
    if "site-packages" in _ROOT.parts or str(_ROOT) in on_path or name in sc._python_includes:
        return
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as archive:
        for f in sorted((_ROOT / "tidemark").rglob("*.py")):
            archive.write(f, f.relative_to(_ROOT).as_posix())
    path = f"{checkpoint_dir(spark)}/{name}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    out.write(data.getvalue())
    out.close()
    sc.addPyFile(path)


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id (as a long) and the text of a table, under fixed names.

    All other columns are dropped here, so theirs can't clash with columns an
    operator adds.
    """
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read back: computed once, lineage cut.

    A lost executor costs only the tasks it was running; nothing is kept on its disk.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ranked(df: DataFrame, group: list[str], order: list[str], name: str, rank: str = "rank") -> DataFrame:
    """The rows with their place in their group, from 0, by ``order`` (nulls first).

    Rows are range-sorted, so a large group spreads over many tasks; one row per group and
    partition carries the places across.  Group columns hold no nulls.  Rows that are equal in
    all of ``order`` come in any order.
    """
    part, at = f"{rank}_part", f"{rank}_at"
    cols = [*group, *order]
    placed = df.repartitionByRange(*map(F.col, cols)).sortWithinPartitions(*cols)
    placed = stored(placed.withColumn(part, F.spark_partition_id()).withColumn(at, F.monotonically_increasing_id()), name)
    firsts = placed.groupBy(*group, part).agg(F.min(at).alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    shift = (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift")
    joined = placed.join(firsts.select(*group, part, shift), [*group, part])
    return joined.withColumn(rank, F.col(at) + F.col("shift")).drop(part, at, "shift")


def dropped(spark: SparkSession, path: str) -> None:
    """Remove a table that ``stored`` wrote and that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def fold(id_col: str | Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; a null id counts as 0."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % modulus, F.lit(0))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
