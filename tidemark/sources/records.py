"""CSV and JSON records in and out.

Reading keeps the reference's line rules: ``\\n`` framing (a ``\\r`` stays in
the record), the last line may lack its newline, an optional cap per line,
fields split on ``\\s*,\\s*`` with trailing empty fields dropped (the JVM
``split`` rule).  Writing never quotes.  Each reader works on batch and
streaming DataFrames alike (``spark.readStream.text`` gives the same column).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.formatting import format_2dp, iso_instant, parse_iso_instant
from ..functions.periods import seconds_ntz

# Fixed values of the record formats.
FIELD_SEPARATOR = r"\s*,\s*"
TRAILING_SEPARATORS = r"(\s*,\s*)+$"
TRADE_HEADER = ["timestamp", "price", "amount"]
BAR_HEADER = ["Begin", "End", "Open", "High", "Low", "Close", "Volume"]
QUOTE_HEADER = ["Date", "Open", "High", "Low", "Close", "Volume", "Adj Close"]
QUOTE_COLUMNS = ["date", "open", "high", "low", "close", "volume", "adj_close"]

QUOTE_SCHEMA = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("volume", T.LongType()),
        T.StructField("adj_close", T.DoubleType()),
    ]
)
TRADE_JSON_SCHEMA = "timestamp string, price double, amount double"
INTERVAL_JSON_SCHEMA = "begin string, end string"
OHLCV_JSON_SCHEMA = (
    "open double, high double, low double, close double, volume double, count bigint, first string, last string"
)


# ------------------------------------------------------------------ reading

def read_lines(spark: SparkSession, path: str | Sequence[str], *, stream: bool = False) -> DataFrame:
    """Text lines split on ``\\n`` only (``\\r`` is kept, as in the reference's framing)."""
    reader = spark.readStream if stream else spark.read
    return reader.option("lineSep", "\n").text(path if isinstance(path, str) else list(path))


def split_row(value: Column | str) -> Column:
    """One line -> array of fields (S1): split on ``\\s*,\\s*``, trailing empty fields dropped."""
    v = F.col(value) if isinstance(value, str) else value
    stripped = F.regexp_replace(v, TRAILING_SEPARATORS, "")
    # a line made only of separators splits into no fields on the JVM
    return F.when((F.length(stripped) == 0) & (F.length(v) > 0), F.array().cast("array<string>")).otherwise(
        F.split(stripped, FIELD_SEPARATOR, -1)
    )


def arrival_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Lines with ``file`` and ``seq``: the position of each line in the input (files by path, lines in order).

    The lines are written once to the shared folder with the split they came from;
    counts per split (one row each, the only rows in the one-task window) make the
    positions, so they hold however Spark packs splits into tasks.
    """
    return with_arrival(read_lines(spark, path).selectExpr("*", *SPLIT_COLUMNS))


# where a line was read: its file and the begin of its split
SPLIT_COLUMNS = ["_metadata.file_path AS file", "_metadata.file_block_start AS file_block"]


def _counted_places(names: list[str]):
    """Adds ``_place``, the number of lines before a line in its split; a split's lines come one after the other."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        held, n = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            file = batch.column(names.index("file")).dictionary_encode()
            keys = np.stack([file.indices.to_numpy(zero_copy_only=False), batch.column(names.index("file_block")).to_numpy(zero_copy_only=False)])
            begins = np.flatnonzero(np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)]))
            place = np.arange(batch.num_rows) - np.repeat(begins, np.diff(np.append(begins, batch.num_rows)))
            split = lambda i: (file[int(i)].as_py(), int(keys[1, i]))
            if split(0) == held:
                place[: begins[1] if len(begins) > 1 else None] += n
            held, n = split(batch.num_rows - 1), int(place[-1]) + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place)], names=[*names, "_place"])

    return run


def with_arrival(lines: DataFrame, first: int = 0) -> DataFrame:
    """Batch lines with ``file`` and ``file_block`` -> the same with ``seq`` from ``first`` on.

    A line's number is how many lines the splits before its own have, in the order of file and place,
    and its place in its split, counted while it is read.  Neither depends on how splits are packed
    into tasks.  The input is read twice, the first time for one count per split; no text is written.
    """
    splits = lines.groupBy("file", "file_block").agg(F.count("*").alias("_n"))
    before = Window.orderBy("file", "file_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)) + F.lit(first)).drop("_n")
    schema = T.StructType([*lines.schema.fields, T.StructField("_place", T.LongType())])
    placed = lines.mapInArrow(_counted_places(lines.columns), schema)
    return placed.join(splits, ["file", "file_block"]).withColumn("seq", F.col("_before") + F.col("_place")).drop("_place", "_before", "file_block")


def parse_csv(lines: DataFrame, *, max_line_bytes: int | None = None, strict: bool = True,
              value_col: str = "value", out: str = "row") -> DataFrame:
    """Lines -> ``row: array<string>``.

    With ``max_line_bytes`` a longer line fails the query when ``strict``;
    otherwise it stays, with a null ``row`` and ``too_long`` true.
    """
    v = F.col(value_col)
    too_long = F.lit(False) if max_line_bytes is None else F.octet_length(v) > F.lit(max_line_bytes)
    if strict:
        row = F.when(too_long, F.raise_error(F.concat(
            F.lit(f"line over the limit of {max_line_bytes} bytes: "), F.substring(v, 1, 40)))).otherwise(split_row(v))
        return lines.withColumn(out, row)
    return lines.withColumn("too_long", too_long).withColumn(out, F.when(~too_long, split_row(v)))


def _strict_cast(c: Column, dtype: str) -> Column:
    """Cast that fails on unparsable text whatever ``spark.sql.ansi.enabled`` says."""
    v = c.try_cast(dtype)
    return F.when(c.isNotNull() & v.isNull(), F.raise_error(
        F.concat(F.lit(f"cannot parse {dtype}: "), c))).otherwise(v)


def rows_to_trades(rows: DataFrame, *, symbol: str | Column | None = None, strict: bool = True,
                   row_col: str = "row", seq: Column | None = None) -> DataFrame:
    """``[unixtime, price, amount]`` rows -> trades (S2): exactly 3 fields, epoch seconds.

    ``seq`` defaults to the rows' own (see :func:`arrival_lines`) or null.
    ``strict`` (the reference) fails on a wrong width or unparsable number;
    otherwise such rows become nulls (``try_cast``) and are flagged ``bad``,
    lines over a cap also ``too_long``.
    """
    r = F.col(row_col)
    width_ok = F.size(r) == 3
    if strict:
        r = F.when(width_ok, r).otherwise(
            F.raise_error(F.concat(F.lit("trade row must have 3 fields: "), F.concat_ws(",", r))))
        secs, price, amount = _strict_cast(r[0], "bigint"), _strict_cast(r[1], "double"), _strict_cast(r[2], "double")
    else:
        secs = F.when(width_ok, r[0].try_cast("bigint"))
        price = F.when(width_ok, r[1].try_cast("double"))
        amount = F.when(width_ok, r[2].try_cast("double"))
    sym = F.lit(symbol) if isinstance(symbol, str) else symbol
    cols = []
    if sym is not None:
        cols.append(sym.alias("symbol"))
    if seq is None:
        seq = F.col("seq") if "seq" in rows.columns else F.lit(None).cast("long")
    cols.append(seq.alias("seq"))
    cols += [seconds_ntz(secs).alias("ts"), price.alias("price"), amount.alias("amount")]
    out = rows.select(*cols, *(["too_long"] if not strict and "too_long" in rows.columns else []))
    if not strict:
        out = out.withColumn("bad", F.col("ts").isNull() | F.col("price").isNull() | F.col("amount").isNull())
    return out


def read_trades(spark: SparkSession, path: str, symbol: str | None = None, *, strict: bool = True,
                max_line_bytes: int | None = None) -> DataFrame:
    """Headerless ``unixtime,price,amount`` CSV -> trades (S1 + S2).

    ``seq`` is the arrival order, line by line through the files in path order;
    it is written once (see :func:`arrival_lines`).  Under a ``symbol=``
    partitioned root the symbol comes from the layout.
    """
    lines = arrival_lines(spark, path)
    rows = parse_csv(lines, max_line_bytes=max_line_bytes, strict=strict)
    sym = symbol if symbol is not None else (F.col("symbol") if "symbol" in lines.columns else None)
    return rows_to_trades(rows, symbol=sym, strict=strict)


def read_trades_text(spark: SparkSession, path: str) -> DataFrame:
    """Read back the ``timestamp,price,amount`` CSV written by :func:`trades_to_csv` (ISO instants)."""
    raw = spark.read.option("header", True).option("lineSep", "\n").schema(
        "timestamp string, price string, amount string").csv(path)
    sym = [F.col("symbol")] if "symbol" in raw.columns else []
    return raw.select(*sym, parse_iso_instant("timestamp").alias("ts"), F.col("price").cast("double").alias("price"),
                      F.col("amount").cast("double").alias("amount"))


def read_quotes(spark: SparkSession, path: str, symbol: str | None = None, *, stream: bool = False) -> DataFrame:
    """Quote CSV with header (``Date, Open, ..., Adj Close``) -> typed quotes (S3).

    Every file's own header says where its columns are; a file that lacks one
    fails the query.  Blanks around commas and blank lines are ignored, quotes have
    no meaning, extra columns (such as an earlier calculated one) are dropped.
    ``seq`` is the line order through the files.  A stream can't look up headers:
    there every file must have the columns in the standard order, or the
    query fails, and ``seq`` is null (quotes are ordered by ``date``).
    """
    if stream:
        reader = spark.readStream.option("header", True).option("enforceSchema", False).option("quote", "").option(
            "ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).option("mode", "FAILFAST")
        raw = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in QUOTE_HEADER])).csv(path)
        cols = [F.col(f"`{h}`").cast(f.dataType).alias(f.name) for h, f in zip(QUOTE_HEADER, QUOTE_SCHEMA.fields)]
        seq = F.lit(None).cast("long")
    else:
        lines = arrival_lines(spark, path).where(F.trim("value") != "").withColumn("_row", split_row(F.trim("value")))
        heads = lines.groupBy("file").agg(F.min("seq").alias("_top"), F.min_by("_row", "seq").alias("_names"))
        for i, h in enumerate(QUOTE_HEADER):
            at = F.array_position("_names", h).cast("int")
            lacks = F.raise_error(F.concat(F.lit(f"no column {h} in "), F.col("file")))
            heads = heads.withColumn(f"_c{i}", F.when(at > 0, at).otherwise(lacks.cast("int")))
        raw = lines.join(heads, "file").where(F.col("seq") > F.col("_top"))
        cols = []
        for i, f in enumerate(QUOTE_SCHEMA.fields):
            field = F.try_element_at("_row", F.col(f"_c{i}"))
            short = F.raise_error(F.concat(F.lit(f"no {f.name} in quote line: "), F.col("value"))).cast("string")
            # only for lines below the header: a predicate on the column may be evaluated before the row filter
            text = F.when(F.col("seq") > F.col("_top"), F.coalesce(field, short))
            cols.append(_strict_cast(text, f.dataType.simpleString()).alias(f.name))
        seq = F.col("seq")
    sym = [F.lit(symbol).alias("symbol")] if symbol is not None else (
        [F.col("symbol")] if "symbol" in raw.columns else [])
    return raw.select(*sym, *cols, seq.alias("seq"))


def raw_passthrough(spark: SparkSession, root: str, symbol: str) -> DataFrame:
    """Untransformed record text of one symbol from a ``root/symbol=<s>/`` layout.

    The symbol predicate prunes partitions; only that symbol's files are read.
    """
    return spark.read.option("lineSep", "\n").text(root).where(F.col("symbol") == F.lit(symbol)).select("value")


def select_col(df: DataFrame, name: str, *, strict: bool = True) -> DataFrame:
    """One column by exact name (P1); a missing name raises, or gives an empty result when not strict."""
    if name in df.columns:
        return df.select(F.col(f"`{name}`"))
    if strict:
        raise ValueError(f"no column named {name!r}")
    return df.select(F.lit(None).cast("string").alias(name)).limit(0)


# ------------------------------------------------------------------ writing

def format_rows(df: DataFrame, cols: Sequence[str] | None = None, out: str = "value") -> DataFrame:
    """Rows -> ``a,b,c`` text lines, no quoting."""
    cols = list(cols or df.columns)
    return df.select(F.concat_ws(",", *[F.col(f"`{c}`").cast("string") for c in cols]).alias(out))


def trades_to_csv(t: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Trades -> text columns ``timestamp, price, amount`` (S5): ISO instant, JVM double text."""
    return t.select(
        *keep,
        iso_instant("ts").alias("timestamp"),
        F.col("price").cast("string").alias("price"),
        F.col("amount").cast("string").alias("amount"),
    )


def quotes_to_csv(q: DataFrame, sma_sizes: Sequence[int] = (), value_col: str = "adj_close") -> DataFrame:
    """Quotes (+ appended SMA columns) -> text columns under the quote file's header names.

    Numbers use the JVM's plain text form, SMA columns are expected already
    formatted (see ``indicators.append_sma``).
    """
    cols = [F.col(c).cast("string").alias(h) for c, h in zip(QUOTE_COLUMNS, QUOTE_HEADER)]
    cols += [F.col(f"{value_col}_sma_{n}").cast("string").alias(f"Adj Close SMA({n})") for n in sma_sizes]
    return q.select(*cols)


def bars_to_csv(bars: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Bars -> ``Begin,End,Open,High,Low,Close,Volume`` text columns, doubles as ``%1.2f``."""
    return bars.select(
        *keep,
        iso_instant("begin").alias("Begin"),
        iso_instant("end").alias("End"),
        format_2dp("open").alias("Open"),
        format_2dp("high").alias("High"),
        format_2dp("low").alias("Low"),
        format_2dp("close").alias("Close"),
        format_2dp("volume").alias("Volume"),
    )


def write_csv(text_cols: DataFrame, path: str, *, header: bool = True, mode: str = "overwrite",
              partition_by: Sequence[str] = (), sort_by: Sequence[str] = ()) -> None:
    """Write text columns as CSV without quoting; the header is written even with no rows.

    With ``sort_by`` the lines are in order through the files (range-partitioned, so no
    task sorts everything); otherwise they come as the plan leaves them.
    """
    if sort_by:
        text_cols = text_cols.orderBy(*sort_by)
    if partition_by and header and text_cols.isEmpty():  # no partition, so no file to carry the header
        text_cols, partition_by = text_cols.drop(*partition_by), ()
    w = (text_cols.write.mode(mode).option("header", header).option("quote", "\u0000")
         .option("escapeQuotes", False).option("lineSep", "\n"))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def write_trades_raw(t: DataFrame, root: str, *, mode: str = "overwrite") -> None:
    """Trades as headerless ``unixtime,price,amount`` lines under ``root/symbol=<s>/`` (the raw layout)."""
    from ..functions.periods import ntz_micros

    secs = F.floor(ntz_micros("ts") / F.lit(1_000_000)).cast("bigint")
    lines = t.select("symbol", F.concat_ws(",", secs.cast("string"), F.col("price").cast("string"),
                                           F.col("amount").cast("string")).alias("value"))
    lines.write.mode(mode).partitionBy("symbol").option("lineSep", "\n").text(root)


def _interval_struct(begin: str = "begin", end: str = "end") -> Column:
    return F.struct(iso_instant(begin).alias("begin"), iso_instant(end).alias("end"))


def _ohlcv_struct() -> Column:
    return F.struct(
        F.col("open"), F.col("high"), F.col("low"), F.col("close"), F.col("volume"),
        F.col("n").alias("count"), iso_instant("first_ts").alias("first"), iso_instant("last_ts").alias("last"),
    )


def trades_to_json(t: DataFrame, out: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Trades -> ``{"timestamp": "...Z", "price": p, "amount": a}``."""
    return t.select(*keep, F.to_json(F.struct(iso_instant("ts").alias("timestamp"), "price", "amount")).alias(out))


def bars_to_json(bars: DataFrame, out: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Bars -> ``[{"begin": ..., "end": ...}, {"open": ..., ..., "last": ...}]``."""
    return bars.select(
        *keep,
        F.concat(F.lit("["), F.to_json(_interval_struct()), F.lit(","), F.to_json(_ohlcv_struct()), F.lit("]")).alias(out)
    )


def _required(struct: str, field: str, strict: bool) -> Column:
    """A field of a parsed record; in strict mode a missing or null one fails the query."""
    c = F.col(f"{struct}.{field}")
    if not strict:
        return c
    return F.coalesce(c, F.raise_error(F.lit(f"JSON record without a value for {field}")))


def trades_from_json(lines: DataFrame, *, value_col: str = "value", strict: bool = True,
                     keep: Sequence[str] = ()) -> DataFrame:
    """JSON trades -> ``ts, price, amount`` (S8); a missing, null or bad field fails in strict mode."""
    mode = "FAILFAST" if strict else "PERMISSIVE"
    j = F.from_json(F.col(value_col), TRADE_JSON_SCHEMA, {"mode": mode})
    d = lines.select(*keep, j.alias("_j"))
    out = d.select(
        *keep,
        parse_iso_instant(_required("_j", "timestamp", strict), strict=strict).alias("ts"),
        _required("_j", "price", strict).alias("price"),
        _required("_j", "amount", strict).alias("amount"),
    )
    if not strict:  # permissive: unparsable records stay, flagged
        out = out.withColumn("bad", F.col("ts").isNull() | F.col("price").isNull() | F.col("amount").isNull())
    return out


def bars_from_json(lines: DataFrame, *, value_col: str = "value", strict: bool = True,
                   keep: Sequence[str] = ()) -> DataFrame:
    """JSON bars (as written by :func:`bars_to_json`) -> bar columns."""
    mode = "FAILFAST" if strict else "PERMISSIVE"
    schema = "array<string>"
    parts = F.from_json(F.col(value_col), schema, {"mode": mode})
    d = lines.select(
        *keep,
        F.from_json(F.get(parts, F.lit(0)), INTERVAL_JSON_SCHEMA, {"mode": mode}).alias("_i"),
        F.from_json(F.get(parts, F.lit(1)), OHLCV_JSON_SCHEMA, {"mode": mode}).alias("_o"),
    )

    def instant(struct: str, field: str) -> Column:
        return parse_iso_instant(_required(struct, field, strict), strict=strict)

    names = {"open": "open", "high": "high", "low": "low", "close": "close", "volume": "volume", "count": "n"}
    return d.select(
        *keep,
        instant("_i", "begin").alias("begin"),
        instant("_i", "end").alias("end"),
        *[_required("_o", f, strict).alias(n) for f, n in names.items()],
        instant("_o", "first").alias("first_ts"),
        instant("_o", "last").alias("last_ts"),
    )
