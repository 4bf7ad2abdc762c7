"""Positional operators over a per-key order without a one-task-per-key window.

The reference processes every symbol as one ordered stream.  A plain
``Window.partitionBy("symbol").orderBy("seq")`` would put a whole symbol
(possibly a third of all rows) into a single task.  Instead every positional
operator here works on *blocks*: contiguous ranges of the order column
(``block = floor(ordinal / block_size)``).  The plan is always

1. one hash shuffle on ``(keys, block)``; the window runs inside blocks;
2. a per-block summary, one row per block, written to the shared folder, so
   the input is read twice and no more, whatever follows;
3. the same step on the summary: if there are more than ``FAN_OUT`` blocks they
   are gathered into ranges of ``FAN_OUT`` blocks, ranges into wider ranges, so
   that every window partition holds at most ``block_size`` rows or ``FAN_OUT``
   summaries, whether the order column is dense, sparse or clumped;
4. a join of the summary back on ``(keys, block)`` (AQE broadcasts it when
   its measured size is small, otherwise it is a co-partitioned join).

Where an order column is sparse or clumped, fixed ranges of it would hold a row or two
each, and the summary would be as large as the input.  Timestamps, and other columns with
``even=True``, are cut into blocks of about equal depth instead: a histogram of the column
(mergeable, at most ``CELLS`` rows) says where blocks begin.

Row frames (rows ``i .. i+n-1``) use global row numbers and fixed-size
chunks with an ``n-1`` row halo copied from the next chunk, so every chunk is
computed independently and the result is exact.

The order column must be unique within a key (``seq`` is, by construction).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.periods import ntz_micros
from ..session import scratch_path

DEFAULT_BLOCK = 1 << 20  # ordinal units per block (seq values, days, microseconds)
DEFAULT_CHUNK = 1 << 16  # rows per chunk for row frames
CELLS = 4096  # cells of the histogram that even blocks are cut by
FAN_OUT = 1 << 16  # blocks per range of blocks, at every level

ORD, BLK = "_ord", "_blk"
_FIRST = -(2**63)
_FIRST_SQL = f"(-{2**63 - 1}L - 1L)"


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _keys_sql(keys: Sequence[str]) -> str:
    return ", ".join(_q(k) for k in keys)


def _over_block(keys: Sequence[str], frame: str = "") -> str:
    return f"OVER (PARTITION BY {_keys_sql(keys)}, {BLK} ORDER BY {ORD}{frame})"


_RUNNING = " ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
_BEFORE = " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"


def ordinal(df: DataFrame, order_col: str, descending: bool = False) -> Column:
    """A bigint that sorts like ``order_col`` (negated when descending)."""
    dtype = df.schema[order_col].dataType
    c = F.col(order_col)
    if isinstance(dtype, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        o = c.cast("long")
    elif isinstance(dtype, T.DateType):
        o = F.unix_date(c).cast("long")
    elif isinstance(dtype, T.TimestampNTZType):
        o = ntz_micros(c)
    elif isinstance(dtype, T.TimestampType):
        o = F.unix_micros(c)
    elif isinstance(dtype, T.DecimalType) and dtype.scale == 0:
        o = c.cast("long")
    else:
        raise TypeError(f"order column {order_col} must be integral, date or timestamp, not {dtype}")
    return -o if descending else o


def _zero_sql(dtype: T.DataType) -> str:
    if isinstance(dtype, T.StringType):
        return "''"
    if isinstance(dtype, T.BooleanType):
        return "false"
    if isinstance(dtype, T.DateType):
        return "DATE'1970-01-01'"
    if isinstance(dtype, T.TimestampNTZType):
        return "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
    if isinstance(dtype, T.TimestampType):
        return "CAST(0 AS TIMESTAMP)"
    if isinstance(dtype, T.NumericType):
        return f"CAST(0 AS {dtype.simpleString()})"
    raise TypeError(f"unsupported key type {dtype}")


def with_blocks(
    df: DataFrame, order_col: str, descending: bool = False, block_size: int = DEFAULT_BLOCK,
    keys: Sequence[str] = (), even: bool | None = None,
) -> tuple[DataFrame, list[str]]:
    """Add ``_ord``, ``_blk`` and non-null key surrogates; return the partition key names.

    Rows without an order value come first (Spark's NULLS FIRST) instead of
    being lost; they have no order among themselves and are spread over blocks
    by a hash.  A nullable key ``k`` gets ``coalesce(k, zero)`` plus a null
    flag, so the window, the summary and the join all use plain equi-keys:
    the join then reuses the window's hash partitioning instead of shuffling
    the big side again when the summary is too large to broadcast.
    Columns that an earlier call left for the same order, block size and keys
    are kept, so chained operators share one shuffle; others are replaced.
    ``even`` (by default for timestamps) makes blocks of about ``block_size`` rows,
    from two narrow aggregations over the order column, instead of ``block_size`` units.
    """
    if block_size <= 0:
        raise ValueError("block_size must be positive")
    if even is None:
        even = isinstance(df.schema[order_col].dataType, (T.TimestampType, T.TimestampNTZType))
    spec = {"sequence": f"{order_col} {descending} {int(block_size)} {list(keys)} {even}"}
    if ORD in df.columns and df.schema[ORD].metadata == spec:
        return df, _partition_keys(df, keys)
    df = drop_blocks(df)
    extra: dict[str, Column] = {}
    for i, k in enumerate(keys):
        f = df.schema[k]
        if f.nullable:
            extra[f"_kv{i}"] = F.expr(f"coalesce({_q(k)}, {_zero_sql(f.dataType)})")
            extra[f"_kn{i}"] = F.expr(f"{_q(k)} IS NULL")
    hashed = [_q(f.name) for f in df.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    spread = F.expr(f"{_FIRST}L + pmod(xxhash64({', '.join(hashed)}), {1 << 40}L)")
    df = df.withColumns({**extra, ORD: F.coalesce(ordinal(df, order_col, descending), spread)})
    df = df.withColumn(ORD, F.col(ORD).alias(ORD, metadata=spec))
    b = int(block_size)
    block = f"({ORD} - pmod({ORD}, {b}L)) div {b}L"
    if even:
        cells = _even_blocks(df, ordinal(df, order_col, descending), b)
        block = f"CASE WHEN {_q(order_col)} IS NULL THEN {block} ELSE {cells} END" if cells else block
    return df.withColumn(BLK, F.expr(block)), _partition_keys(df, keys)


def _even_blocks(df: DataFrame, order: Column, block_rows: int) -> str | None:
    """SQL for blocks of about ``block_rows`` rows from a histogram of the order; None if there are no rows.

    Cells of few rows share a block, a cell of many is cut evenly between its own least and greatest
    value.  So a block holds more than twice its share only where values clump within a cell.
    """
    rows = df.select(order.alias("o")).where("o IS NOT NULL")
    span = rows.agg(F.min("o").alias("a"), F.max("o").alias("b")).first()
    if span["a"] is None:
        return None
    first, width = span["a"], (span["b"] - span["a"]) // CELLS + 1
    # halves keep the distance of far values within 64 bits
    cell = f"least(greatest((o div 2 - {first // 2}L) div {max(1, width // 2)}L, 0L), {CELLS - 1}L)"
    found = rows.groupBy(F.expr(cell).alias("cell")).agg(F.count("*").alias("n"), F.min("o").alias("a"), F.max("o").alias("b")).collect()
    base, low, step = [0] * CELLS, [0] * CELLS, [1 << 62] * CELLS
    block, filled = 0, 0
    for r in sorted(found, key=lambda r: r["cell"]):
        k, n = r["cell"], r["n"]
        if filled and filled + n > block_rows:
            block, filled = block + 1, 0
        base[k], low[k] = block, r["a"]
        parts = -(-n // block_rows)
        if parts > 1:
            step[k] = (r["b"] - r["a"]) // parts + 1
            block, filled = block + parts, 0
        else:
            filled += n
    at = cell.replace("o div 2", f"{ORD} div 2")
    pick = lambda values: f"array({', '.join(f'{v}L' if v > -(1 << 63) else _FIRST_SQL for v in values)})[{at}]"
    return f"{pick(base)} + ({ORD} div 2 - {pick(low)} div 2) div greatest({pick(step)} div 2, 1L)"


def _partition_keys(df: DataFrame, keys: Sequence[str]) -> list[str]:
    out: list[str] = []
    for i, k in enumerate(keys):
        out += [f"_kv{i}", f"_kn{i}"] if f"_kv{i}" in df.columns else [k]
    return out


def _stored(blocks: DataFrame, block_size: int) -> tuple[DataFrame, int]:
    """The block summary, written and read back, and how often its ranges must be gathered."""
    spark = blocks.sparkSession
    path = scratch_path(spark, "blocks")
    blocks.write.parquet(path)
    out = spark.read.schema(blocks.schema).parquet(path)
    return out, levels(out.count(), block_size)


def levels(n_blocks: int, block_size: int) -> int:
    """None if all blocks fit one window, else as many as a 64-bit order may need."""
    if n_blocks <= FAN_OUT:
        return 0
    ranges, out = (1 << 64) // block_size, 0
    while ranges > FAN_OUT:
        ranges, out = ranges // FAN_OUT, out + 1
    return out


def _offsets(blocks: DataFrame, pk: Sequence[str], sums: Sequence[str], level: int, ident: str = BLK) -> DataFrame:
    """(pk, block, _o_<sum>): per key the sums over all earlier blocks."""
    up = f"_up{level}"
    keys = [*pk, up] if level else list(pk)
    if level:
        blocks = blocks.withColumn(up, F.expr(f"({ident} - pmod({ident}, {FAN_OUT}L)) div {FAN_OUT}L"))
    over = f"OVER (PARTITION BY {_keys_sql(keys)} ORDER BY {ident}{_BEFORE})"
    inner = blocks.select(*keys, ident, *[F.expr(f"coalesce(sum({v}) {over}, 0) AS _o{v}") for v in sums])
    if not level:
        return inner
    wider = blocks.groupBy(*keys).agg(*[F.sum(v).alias(v) for v in sums])
    before = _offsets(wider, pk, sums, level - 1, up).withColumnsRenamed({f"_o{v}": f"_b{v}" for v in sums})
    both = inner.join(before, keys)
    return both.select(*pk, ident, *[(F.col(f"_o{v}") + F.col(f"_b{v}")).alias(f"_o{v}") for v in sums])


def _previous(blocks: DataFrame, pk: Sequence[str], last: str, level: int, ident: str = BLK) -> DataFrame:
    """(pk, block, _p): per key the ``last`` of the block before, null for the first block."""
    up = f"_up{level}"
    keys = [*pk, up] if level else list(pk)
    if level:
        blocks = blocks.withColumn(up, F.expr(f"({ident} - pmod({ident}, {FAN_OUT}L)) div {FAN_OUT}L"))
    over = f"OVER (PARTITION BY {_keys_sql(keys)} ORDER BY {ident})"
    inner = blocks.select(*keys, ident, F.expr(f"lag({last}) {over} AS _p"))
    if not level:
        return inner
    wider = blocks.groupBy(*keys).agg(F.max_by(last, ident).alias(last))
    before = _previous(wider, pk, last, level - 1, up).withColumnRenamed("_p", "_b")
    return inner.join(before, keys).select(*pk, ident, F.coalesce("_p", "_b").alias("_p"))


def _finish(df: DataFrame, keep_blocks: bool) -> DataFrame:
    if keep_blocks:
        return df
    return df.drop(ORD, BLK, *[c for c in df.columns if c.startswith("_kv") or c.startswith("_kn")])


def drop_blocks(df: DataFrame) -> DataFrame:
    return _finish(df, False)


def prefix_sums(
    df: DataFrame,
    keys: Sequence[str],
    order_col: str,
    sums: Mapping[str, Column | str],
    *,
    descending: bool = False,
    block_size: int = DEFAULT_BLOCK,
    even: bool | None = None,
    with_total: str | None = None,
    keep_blocks: bool = False,
) -> DataFrame:
    """Running (inclusive) sums per key in order: ``out = sum(value) over rows <= current``.

    ``sums`` maps an output name to a value column (or SQL text).
    ``with_total`` names an extra column holding the key's grand total of the
    first sum (e.g. the row count when summing 1).
    """
    d, pk = with_blocks(df, order_col, descending, block_size, keys, even)
    outs = list(sums)
    d = d.withColumns({f"_v_{o}": (F.expr(v) if isinstance(v, str) else v) for o, v in sums.items()})
    d = d.withColumns({f"_in_{o}": F.expr(f"sum(_v_{o}) {_over_block(pk, _RUNNING)}") for o in outs})
    blocks = d.groupBy(*pk, BLK).agg(*[F.expr(f"sum(_v_{o}) AS _t_{o}") for o in outs])
    blocks, level = _stored(blocks, block_size)
    summary = _offsets(blocks, pk, [f"_t_{o}" for o in outs], level)
    if with_total:
        summary = summary.join(blocks.groupBy(*pk).agg(F.sum(f"_t_{outs[0]}").alias(with_total)), pk)
    j = d.join(summary, [*pk, BLK], "inner")
    j = j.withColumns({o: F.expr(f"_o_t_{o} + _in_{o}") for o in outs})
    j = j.drop(*[f"_{p}_{o}" for o in outs for p in ("v", "in", "o_t")])
    return _finish(j, keep_blocks)


def prefix_sum(df: DataFrame, keys: Sequence[str], order_col: str, value: Column | str, out: str, **kw) -> DataFrame:
    return prefix_sums(df, keys, order_col, {out: value}, **kw)


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order_col: str,
    out: str = "rn",
    *,
    descending: bool = False,
    block_size: int = DEFAULT_BLOCK,
    even: bool | None = None,
    with_total: str | None = None,
    keep_blocks: bool = False,
) -> DataFrame:
    """1-based position of each row within its key (W7); optionally the key's row count."""
    return prefix_sums(
        df, keys, order_col, {out: "1L"},
        descending=descending, block_size=block_size, even=even, with_total=with_total, keep_blocks=keep_blocks,
    )


def row_position(df: DataFrame, keys: Sequence[str] = ("symbol",), order_col: str = "seq", out: str = "rn",
                 **kw) -> DataFrame:
    """1-based arrival position per key (an alias of :func:`number_rows`)."""
    return number_rows(df, keys, order_col, out, **kw)


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    order_col: str,
    cols: Sequence[str],
    *,
    descending: bool = False,
    block_size: int = DEFAULT_BLOCK,
    even: bool | None = None,
    prefix: str = "prev_",
    keep_blocks: bool = False,
) -> DataFrame:
    """``lag(col)`` per key in order, across block boundaries."""
    d, pk = with_blocks(df, order_col, descending, block_size, keys, even)
    lags = {"_first_in_blk": F.expr(f"lag({ORD}) {_over_block(pk)} IS NULL")}
    lags.update({f"_lag_{c}": F.expr(f"lag({_q(c)}) {_over_block(pk)}") for c in cols})
    d = d.withColumns(lags)
    last = d.groupBy(*pk, BLK).agg(F.max_by(F.struct(*[F.col(_q(c)).alias(f"l{i}") for i, c in enumerate(cols)]), ORD).alias("_last"))
    last, level = _stored(last, block_size)
    j = d.join(_previous(last, pk, "_last", level), [*pk, BLK], "inner")
    j = j.withColumns({
        f"{prefix}{c}": F.expr(f"CASE WHEN _first_in_blk THEN _p.l{i} ELSE _lag_{c} END") for i, c in enumerate(cols)
    })
    j = j.drop("_first_in_blk", "_p", *[f"_lag_{c}" for c in cols])
    return _finish(j, keep_blocks)


def _latest(blocks: DataFrame, pk: Sequence[str], last: str, level: int, ident: str = BLK) -> DataFrame:
    """(pk, block, _p): per key the newest ``last`` that is not null of all blocks before."""
    up = f"_up{level}"
    keys = [*pk, up] if level else list(pk)
    if level:
        blocks = blocks.withColumn(up, F.expr(f"({ident} - pmod({ident}, {FAN_OUT}L)) div {FAN_OUT}L"))
    over = f"OVER (PARTITION BY {_keys_sql(keys)} ORDER BY {ident}{_BEFORE})"
    inner = blocks.select(*keys, ident, F.expr(f"last({last}, true) {over} AS _p"))
    if not level:
        return inner
    wider = blocks.groupBy(*keys).agg(F.expr(f"max_by({last}, {ident}) FILTER (WHERE {last} IS NOT NULL) AS {last}"))
    before = _latest(wider, pk, last, level - 1, up).withColumnRenamed("_p", "_b")
    return inner.join(before, keys).select(*pk, ident, F.coalesce("_p", "_b").alias("_p"))


def with_latest(
    df: DataFrame,
    keys: Sequence[str],
    order_col: str,
    value: Column | str,
    when: Column | str,
    out: str,
    *,
    descending: bool = False,
    block_size: int = DEFAULT_BLOCK,
    even: bool | None = None,
) -> DataFrame:
    """``out``: the value of the newest row so far, the row itself included, for which ``when`` holds (else null)."""
    d, pk = with_blocks(df, order_col, descending, block_size, keys, even)
    value, when = (F.expr(x) if isinstance(x, str) else x for x in (value, when))
    d = d.withColumn("_known", F.when(when, F.struct(value.alias("v"))))
    d = d.withColumn("_here", F.expr(f"last(_known, true) {_over_block(pk, _RUNNING)}"))
    blocks = d.groupBy(*pk, BLK).agg(F.expr(f"max_by(_known, {ORD}) FILTER (WHERE _known IS NOT NULL) AS _last"))
    blocks, level = _stored(blocks, block_size)
    j = d.join(_latest(blocks, pk, "_last", level), [*pk, BLK], "inner")
    j = j.withColumn(out, F.coalesce("_here", "_p").getField("v"))
    return _finish(j.drop("_known", "_here", "_p"), False)


def lag_change(df: DataFrame, keys: Sequence[str], order_col: str, col: str, out: str = "changed",
               **kw) -> DataFrame:
    """Does ``col`` differ from the previous row's value (true on each key's first row)?"""
    d = with_previous(df.withColumn("_has", F.lit(True)), keys, order_col, [col, "_has"], prefix="_lc_", **kw)
    prev = _q(f"_lc_{col}")
    changed = F.expr(f"_lc__has IS NULL OR NOT ({prev} <=> {_q(col)})")
    return d.withColumn(out, changed).drop(f"_lc_{col}", "_lc__has", "_has")


def frame_aggregates(
    df: DataFrame,
    keys: Sequence[str],
    pos_col: str,
    frames: Mapping[str, tuple[int, Column | str]],
    *,
    chunk_rows: int = DEFAULT_CHUNK,
) -> DataFrame:
    """Aggregates over the forward row frame ``pos .. pos+n-1`` (per output column).

    ``frames`` maps an output name to ``(n, aggregate)`` (a Column or SQL such
    as ``"avg(price)"``).  Rows are cut into chunks of ``C >= max(n)``
    consecutive positions; the first ``max(n)-1`` rows of each chunk are also
    copied (as a halo) into the previous chunk, so each chunk's frames are
    complete and every chunk is an independent task.  Frames that run past the
    key's last row are partial; the caller filters by position.
    """
    if not frames:
        return df
    nmax = max(n for n, _ in frames.values())
    if nmax <= 0:
        raise ValueError("frame length must be positive")
    pos = _q(pos_col)
    parts = _chunks(df, pos_col, nmax, chunk_rows)
    spec = f"PARTITION BY {_keys_sql(keys)}, _chunk ORDER BY {pos}"
    w = Window.partitionBy(*keys, "_chunk").orderBy(pos_col)
    cols = {}
    for out, (n, agg) in frames.items():
        if isinstance(agg, str):
            cols[out] = F.expr(f"{agg} OVER ({spec} ROWS BETWEEN CURRENT ROW AND {n - 1} FOLLOWING)")
        else:
            cols[out] = agg.over(w.rowsBetween(0, n - 1))
    parts = parts.withColumns(cols)
    return parts.where(~F.col("_halo")).drop("_chunk", "_halo")


def frame_means(
    df: DataFrame,
    keys: Sequence[str],
    pos_col: str,
    value: str,
    sizes: Mapping[str, int],
    *,
    chunk_rows: int = DEFAULT_CHUNK,
    decimal: T.DecimalType | None = None,
) -> DataFrame:
    """Means of ``value`` over ``pos .. pos+n-1`` per output column, at a cost per row that does not grow with n.

    Positions are cut into blocks of n.  A frame is the rest of one block and the
    beginning of the next, so its sum is a running sum backwards plus a running sum
    forwards n-1 rows on: nothing is subtracted and nothing drifts.  Chunks and their
    halos are those of :func:`frame_aggregates`; frames past the key's last row are
    partial and the caller filters by position.  ``value`` is SQL for a double, or for a
    decimal of the type ``decimal``: sums are exact then, and means have four more decimal places.
    """
    zero, mean = "0D", "try_divide({total}, {count})"
    if decimal:
        p, s = min(38, decimal.precision + 10), decimal.scale
        zero = f"CAST(0 AS DECIMAL({p},{s}))"
        value = f"CAST({value} AS DECIMAL({decimal.precision},{s}))"
        mean = f"CAST(round(try_divide(CAST({{total}} AS DECIMAL({p},{s})), CAST({{count}} AS DECIMAL(10,0))), {s + 4}) AS DECIMAL({min(38, decimal.precision + 4)},{s + 4}))"
    nmax = max(sizes.values())
    if min(sizes.values()) <= 0:
        raise ValueError("frame length must be positive")
    # dealt by chunk once: the windows over blocks of a chunk and over the whole chunk all find their rows together
    parts = _chunks(df, pos_col, nmax, chunk_rows).repartition(*[F.col(_q(k)) for k in keys], "_chunk")
    pos, over = _q(pos_col), f"PARTITION BY {_keys_sql([*keys, '_chunk'])}"
    added = []
    for i, (out, n) in enumerate(sizes.items()):
        blk, to_end, to_here, far = f"_b{i}", f"_e{i}", f"_h{i}", f"_f{i}"
        pair = f"named_struct('s', coalesce(sum({value}) {{0}}, {zero}), 'c', count({value}) {{0}})"
        back = f"OVER ({over}, {blk} ORDER BY {pos} DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        here = f"OVER ({over}, {blk} ORDER BY {pos} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        parts = parts.withColumn(blk, F.expr(f"({pos} - 1) div {n}L"))
        parts = parts.withColumn(to_end, F.expr(pair.format(back))).withColumn(to_here, F.expr(pair.format(here)))
        parts = parts.withColumn(far, F.expr(f"lead({to_here}, {n - 1}) OVER ({over} ORDER BY {pos})"))
        whole = f"pmod({pos} - 1, {n}L) = 0"
        total = f"{to_end}.s + if({whole}, {zero}, coalesce({far}.s, {zero}))"
        count = f"{to_end}.c + if({whole}, 0L, coalesce({far}.c, 0L))"
        parts = parts.withColumn(out, F.expr(mean.format(total=total, count=count)))
        added += [blk, to_end, to_here, far]
    return parts.where(~F.col("_halo")).drop("_chunk", "_halo", *added)


def _chunks(df: DataFrame, pos_col: str, nmax: int, chunk_rows: int) -> DataFrame:
    """Every row once in its own chunk; the first nmax-1 rows of a chunk once more, as halo of the previous one."""
    c = max(int(chunk_rows), nmax)
    pos = _q(pos_col)
    copies = (f"CASE WHEN pmod({pos} - 1, {c}L) < {nmax - 1} AND ({pos} - 1) div {c}L > 0 "
              "THEN array(0, 1) ELSE array(0) END")
    return df.withColumn("_copy", F.explode(F.expr(copies))).withColumns({
        "_chunk": F.expr(f"({pos} - 1) div {c}L - _copy"), "_halo": F.expr("_copy = 1")}).drop("_copy")


def segment_ids(
    df: DataFrame,
    keys: Sequence[str],
    order_col: str,
    value_col: str,
    out: str = "run_id",
    *,
    descending: bool = False,
    block_size: int = DEFAULT_BLOCK,
    even: bool | None = None,
    seed_col: str | None = None,
) -> DataFrame:
    """Number the consecutive runs of equal ``value_col`` per key in order (1, 2, ...).

    One pass: inside each block a window finds the changes; a per-block
    summary (first value, last value, number of changes) and a window over
    the summary give every block its starting run id.  ``seed_col`` adds an
    extra increment at a row (used to continue run ids across stream batches).
    """
    d, pk = with_blocks(df, order_col, descending, block_size, keys, even)
    v = _q(value_col)
    has_prev = f"lag({ORD}) {_over_block(pk)} IS NOT NULL"
    prev = f"lag({v}) {_over_block(pk)}"
    inc = f"CASE WHEN {has_prev} AND NOT ({prev} <=> {v}) THEN 1L ELSE 0L END"
    if seed_col:
        inc = f"({inc} + coalesce(CAST({_q(seed_col)} AS BIGINT), 0L))"
    d = d.withColumn("_inc", F.expr(inc))
    d = d.withColumn("_local", F.expr(f"sum(_inc) {_over_block(pk, _RUNNING)}"))
    blocks = d.groupBy(*pk, BLK).agg(
        F.expr(f"min_by(named_struct('v', {v}), {ORD}) AS _first"), F.expr(f"max_by(named_struct('v', {v}), {ORD}) AS _last"),
        F.expr("sum(_inc) AS _internal"))
    blocks, level = _stored(blocks, block_size)
    known = blocks.join(_previous(blocks, pk, "_last", level), [*pk, BLK])
    known = known.withColumn("_new", F.expr("CASE WHEN _p IS NULL OR NOT (_p.v <=> _first.v) THEN 1L ELSE 0L END"))
    known = known.withColumn("_runs", F.expr("_internal + _new")).select(*pk, BLK, "_new", "_runs")
    summary = known.drop("_runs").join(_offsets(known, pk, ["_runs"], level), [*pk, BLK])
    j = d.join(summary, [*pk, BLK], "inner")
    j = j.withColumn(out, F.expr("_o_runs + _new + _local"))
    return _finish(j.drop("_inc", "_local", "_o_runs", "_new"), False)
