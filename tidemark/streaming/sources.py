"""Streaming sources and bounded runners."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path


def parquet_stream(spark: SparkSession, directory: str, file_glob: str | None = None, schema=None,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream the parquet files of a directory (optionally only names matching ``file_glob``)."""
    if schema is None:
        probe = spark.read
        if file_glob:
            probe = probe.option("pathGlobFilter", file_glob)
        schema = probe.parquet(directory).schema
    r = spark.readStream.schema(schema)
    if file_glob:
        r = r.option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(directory)


def run_available_now(stream: DataFrame, path: str | None = None, *, output_mode: str = "append",
                      fmt: str = "parquet", checkpoint: str | None = None) -> DataFrame:
    """Run a stream over everything available now into files; return the written table.

    Output and checkpoint live under the shared checkpoint folder.
    """
    spark = stream.sparkSession
    path = path or scratch_path(spark, "stream-out")
    checkpoint = checkpoint or scratch_path(spark, "stream-ckpt")
    q = (stream.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint)
         .outputMode(output_mode).trigger(availableNow=True).start())
    q.awaitTermination()
    if fmt == "parquet":
        return spark.read.parquet(path)
    return spark.read.format(fmt).load(path)


def run_foreach_batch(stream: DataFrame, handler, *, checkpoint: str | None = None) -> None:
    """Run a ``foreachBatch`` handler over everything available now."""
    spark = stream.sparkSession
    checkpoint = checkpoint or scratch_path(spark, "stream-ckpt")
    q = stream.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint).trigger(
        availableNow=True).start()
    q.awaitTermination()
