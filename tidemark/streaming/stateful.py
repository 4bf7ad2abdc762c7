"""Positional operators on streams (ST3 SMA, ST5 runs) on Spark's state store.

A key is cut into stripes of ``stripe`` consecutive order values, and state belongs to
(key, stripe): a micro-batch touches the state of the stripes it has rows for and nothing
else, and a hot symbol spreads over as many tasks as it has stripes.

SMA: a stripe keeps its last ``n-1`` values and computes every frame that lies within it.
Only the first and last ``n-1`` rows of a stripe go on to a second operator, one state per
key, which joins the stripes up.  Runs: a stripe keeps its last interval and how many runs
it has seen; runs that cross a border are joined when the output is read.

State lives in RocksDB under the query's checkpoint, so a query that is started again
goes on where it stopped.  Rows must come in order between micro-batches (within one
they need not): a row older than what an earlier batch brought counts as arriving now.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.periods import Period, micros_ntz, ntz_micros, parse_period, period_begin, period_end
from ..operators.bars import BAR_COLUMNS, SEQ_COLUMNS, merge_ohlcv
from .processors import BAR_TYPES, SeamSma, StripeRuns, StripeSma

STRIPE = 1 << 16
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb_state(spark: SparkSession, partitions: int | None = None):
    """Queries started inside keep their state in RocksDB; the session's own settings come back afterwards."""
    wanted = {_PROVIDER: _ROCKSDB} | ({"spark.sql.shuffle.partitions": str(partitions)} if partitions else {})
    old = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def start(stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, partitions: int | None = None):
    """Start a query that appends to Parquet files under ``path`` with RocksDB state under ``checkpoint``.

    State is dealt over ``partitions`` tasks (the session's shuffle partitions by default), for good: the
    first start of a checkpoint decides.  Each costs a Python worker's start per micro-batch.
    """
    with rocksdb_state(stream.sparkSession, partitions):
        w = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        return w.outputMode("append").trigger(**(trigger or {"availableNow": True})).start()


def _key(name: str) -> tuple[str, str]:
    """Surrogates of a nullable key: state is never looked up by a null."""
    return f"_v_{name}", f"_n_{name}"


def with_state_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    names: list[str] = []
    for k in keys:
        v, n = _key(k)
        df = df.withColumn(v, F.coalesce(F.col(k).cast("string"), F.lit(""))).withColumn(n, F.col(k).isNull())
        names += [v, n]
    return df, names


def sma_stream(stream: DataFrame, n: int, value_col: str = "price", keys: Sequence[str] = ("symbol",), order_col: str = "seq",
               out: str | None = None, stripe: int = STRIPE) -> DataFrame:
    """The trailing SMA(n) on the newest row of each key as a streaming frame (ST3).

    Columns: those of the stream (the order column as a long, the value as a double) and the mean.  Equal
    to the batch SMA with ``newest_first=True``: the first ``n-1`` rows of a key have no row here,
    missing values don't count, and an empty stream has no row.  A row without an order value fails.
    """
    if n <= 0 or stripe <= 0:
        raise ValueError("n and stripe must be positive")
    order = F.when(F.col(order_col).isNull(), F.raise_error(F.lit(f"a row without {order_col}"))).otherwise(F.col(order_col).cast("long"))
    carry = [c for c in stream.columns if c not in (*keys, order_col, value_col)]
    rows, names = with_state_keys(stream.select(*keys, *carry, order.alias(order_col), F.col(value_col).cast("double").alias(value_col)), keys)
    types = {f.name: f.dataType for f in rows.schema.fields}
    own = [T.StructField(k, types[k]) for k in names]
    kept = [T.StructField(c, types[c]) for c in carry]
    tail = [T.StructField(order_col, T.LongType()), T.StructField(value_col, T.DoubleType()), T.StructField("mean", T.DoubleType())]
    rows = rows.withColumn("slot", F.floor(F.col(order_col) / stripe)).drop(*keys)
    rows = rows.withColumn("slot", F.pmod("slot", F.lit(1 << 62)))  # never negative: -1 marks seams
    inner = T.StructType([*own, T.StructField("slot", T.LongType()), T.StructField("kind", T.IntegerType()), *kept, *tail])
    done = rows.groupBy(*names, "slot").transformWithStateInPandas(StripeSma(n, names, order_col, value_col, carry), inner, "append", "none")
    seams = done.groupBy(*names, "slot").transformWithStateInPandas(SeamSma(n, names, order_col, value_col, carry), T.StructType([*own, *kept, *tail]), "append", "none")
    back = [F.when(~F.col(_key(k)[1]), F.col(_key(k)[0])).cast(stream.schema[k].dataType).alias(k) for k in keys]
    named = {**dict(zip(keys, back)), "mean": F.col("mean").alias(out or f"{value_col}_sma_{n}")}
    return seams.select(*[named.get(c, F.col(c)) for c in stream.columns], named["mean"])


def stream_sma(stream: DataFrame, out_path: str, checkpoint: str, n: int, value_col: str = "price", trigger: dict | None = None,
               partitions: int | None = None, **kw):
    """Start the streaming SMA (ST3); returns the ``StreamingQuery``. Read it with :func:`read_outputs`."""
    return start(sma_stream(stream, n, value_col, **kw), out_path, checkpoint, trigger, partitions)


def runs_stream(trades: DataFrame, period: Period | str = "daily", tie_break: str | None = "prepend", order_col: str = "seq",
                stripe: int = STRIPE) -> DataFrame:
    """Consecutive runs of one interval as a streaming frame of partial bars (ST5); see :func:`finalize_runs`.

    Trades (symbol, order column, ts, price, amount) without a time lie in no interval and in no
    run.  Prices and amounts are doubles without nulls.
    """
    p = parse_period(period) if isinstance(period, str) else period
    order = F.when(F.col(order_col).isNull(), F.raise_error(F.lit(f"a trade without {order_col}"))).otherwise(F.col(order_col).cast("long"))
    rows = trades.where(F.col("ts").isNotNull()).withColumn("begin", period_begin("ts", p))
    rows = rows.select("symbol", order.alias("seq"), ntz_micros("ts").alias("ts_us"), ntz_micros("begin").alias("begin_us"), F.col("price").cast("double").alias("price"), F.col("amount").cast("double").alias("amount"))
    rows, names = with_state_keys(rows, ["symbol"])
    rows = rows.withColumn("stripe", F.floor(F.col("seq") / stripe)).drop("symbol")
    schema = f"{names[0]} string, {names[1]} boolean, stripe long, begin_us long, run long, {BAR_TYPES}"
    done = rows.groupBy(*names, "stripe").transformWithStateInPandas(StripeRuns(names, tie_break), schema, "append", "none")
    symbol = F.when(~F.col(names[1]), F.col(names[0])).alias("symbol")
    begin = micros_ntz(F.col("begin_us")).alias("begin")
    done = done.withColumn("begin", begin)
    times = [micros_ntz(F.col(c)).alias(t) for c, t in (("first_us", "first_ts"), ("last_us", "last_ts"))]
    return done.select(symbol, "stripe", F.col("run").alias("stripe_run"), "begin", period_end("begin", p).alias("end"),
                       "open", "high", "low", "close", "volume", "n", *times, *SEQ_COLUMNS)


def stream_runs(trades: DataFrame, out_path: str, checkpoint: str, period: Period | str = "daily", tie_break: str | None = "prepend",
                trigger: dict | None = None, partitions: int | None = None, **kw):
    """Start the streaming run splitter (ST5); merge its output with :func:`finalize_runs`."""
    return start(runs_stream(trades, period, tie_break, **kw), out_path, checkpoint, trigger, partitions)


def finalize_runs(partials: DataFrame, tie_break: str | None = "prepend") -> DataFrame:
    """One bar per run from the partial bars of all stripes and batches.

    Runs are numbered along the stripes of a symbol: one row per stripe says how many runs it
    has and where it begins and ends; a run that goes on over a border counts once.
    """
    sym = F.col("symbol").eqNullSafe(F.col("_s"))
    own = merge_ohlcv(partials, ["symbol", "stripe", "stripe_run", "begin", "end"], tie_break)
    stripes = own.groupBy("symbol", "stripe").agg(
        F.max("stripe_run").alias("runs"), F.min_by("begin", "stripe_run").alias("head"), F.max_by("begin", "stripe_run").alias("tail"))
    along = Window.partitionBy("symbol").orderBy("stripe")
    joined = (F.lag("tail").over(along) == F.col("head")).cast("long")
    stripes = stripes.withColumn("same", F.coalesce(joined, F.lit(0)))
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum(F.col("runs") - F.col("same")).over(before), F.lit(0)) - F.col("same")
    stripes = stripes.select(F.col("symbol").alias("_s"), F.col("stripe").alias("_stripe"), offset.alias("_offset"))
    numbered = own.join(stripes, sym & (F.col("stripe") == F.col("_stripe"))).withColumn("run_id", F.col("_offset") + F.col("stripe_run"))
    merged = merge_ohlcv(numbered, ["symbol", "run_id", "begin", "end"], tie_break)
    return merged.select("symbol", "run_id", "begin", "end", *BAR_COLUMNS)


def read_outputs(spark: SparkSession, out_path: str) -> DataFrame:
    """What a query has written so far."""
    return spark.read.parquet(out_path)


def to_folder(path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` handler that writes each batch once; a batch that is run again after it was written stays as it is."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        jvm = spark._jvm.org.apache.hadoop.fs
        done = jvm.Path(f"{path}/batch_id={batch_id}/_SUCCESS")
        if not done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
            batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write
