"""Positional indicators: simple moving averages and compounded indexes.

The SMA is positional, as in the reference: the row at input position ``i``
gets the mean of input rows ``i .. i+n-1`` and the last ``n-1`` rows are
dropped.  Quotes arrive newest first, which makes that a trailing mean by
date; ``newest_first=True`` expresses this with ``order_col`` descending.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans import sequence

# Fixed value: the calculated-column syntax, anchored and case-sensitive.
SMA_SPEC = r"sma\((\d+)\)"
DEFAULT_CALCULATED = "sma(10)"
_INT_MAX = 2**31 - 1


def parse_calculated(calculated: str) -> list[int]:
    """``"sma(10),sma(50)"`` -> ``[10, 50]``; the first bad item raises ``ValueError``.

    Items are split on ``,`` without trimming; trailing empty items are
    dropped as the JVM ``split`` does (so ``","`` means no calculated column).
    n must be a positive 32-bit integer; duplicates are rejected (they would
    give duplicate columns).
    """
    items = calculated.split(",")
    while items and items[-1] == "" and len(items) > 1:
        items.pop()
    if items == [""] and "," in calculated:
        items = []
    sizes: list[int] = []
    for item in items:
        m = re.fullmatch(SMA_SPEC, item)
        n = int(m.group(1)) if m else 0
        if not m or n <= 0 or n > _INT_MAX:
            raise ValueError(f"Invalid calculated column {item}")
        if n in sizes:
            raise ValueError(f"Duplicate calculated column {item}")
        sizes.append(n)
    return sizes


def sma_name(value_col: str, n: int) -> str:
    return f"{value_col}_sma_{n}"


def moving_averages(
    df: DataFrame,
    value_col: str,
    sizes: Sequence[int],
    *,
    keys: Sequence[str] = ("symbol",),
    order_col: str = "seq",
    newest_first: bool = True,
    chained: bool = True,
    names: Sequence[str] | None = None,
    fmt: str | None = None,
    block_size: int = sequence.DEFAULT_BLOCK,
    chunk_rows: int = sequence.DEFAULT_CHUNK,
    exact_running_sum: bool = False,
) -> DataFrame:
    """Append one SMA column per size.

    ``chained=True`` reproduces applying the stages one after another: stage
    k sees the previous stage's shortened table, so ``L - sum(n_k - 1)`` rows
    survive per key; surviving values equal the independent ones.  With
    ``chained=False`` rows are kept while every frame is complete.
    Decimal columns keep exact sums and have decimal means with four more places; all others
    are averaged as doubles.  ``fmt`` (e.g. ``"%1.2f"``) turns the SMA columns into formatted text.
    ``exact_running_sum`` reproduces the reference's ``sum + x - head``
    arithmetic bit for bit (see :func:`_running_sum_sma`).
    """
    sizes = list(sizes)
    if not sizes or any(n <= 0 for n in sizes):
        raise ValueError("SMA sizes must be positive")
    names = list(names) if names else [sma_name(value_col, n) for n in sizes]
    if exact_running_sum:
        return _running_sum_sma(df, value_col, sizes, names, keys=keys, order_col=order_col,
                                newest_first=newest_first, chained=chained, fmt=fmt)
    d = sequence.number_rows(
        df, keys, order_col, "_pos", descending=newest_first, block_size=block_size, with_total="_len"
    )
    v, dtype = "`" + value_col.replace("`", "``") + "`", df.schema[value_col].dataType
    decimal = dtype if isinstance(dtype, T.DecimalType) else None
    v = v if decimal else f"CAST({v} AS DOUBLE)"
    d = sequence.frame_means(d, keys, "_pos", v, dict(zip(names, sizes)), chunk_rows=chunk_rows, decimal=decimal)
    lost = sum(n - 1 for n in sizes) if chained else max(sizes) - 1
    d = d.where(F.expr(f"_pos <= _len - {lost}")).drop("_pos", "_len")
    if fmt:
        for name in names:
            d = d.withColumn(name, F.format_string(fmt, F.col(name)))
    return d


def _running_sum_sma(df: DataFrame, value_col: str, sizes: Sequence[int], names: Sequence[str], *,
                     keys: Sequence[str], order_col: str, newest_first: bool, chained: bool,
                     fmt: str | None) -> DataFrame:
    """The reference's sequential running sum, one key per ``applyInPandas`` group.

    The fold ``sum + x - head`` drifts in the last bits, so it cannot be split
    across tasks.  It is therefore only offered for date-ordered quote tables,
    and the plan fails on a second row of a key and day before anything is
    gathered: a group is bounded by the calendar (about 36,500 rows per
    century), however large the table.  Positional SMAs over trades use the
    blocked frame mean instead.
    """
    if not isinstance(df.schema[order_col].dataType, T.DateType):
        raise ValueError("exact_running_sum needs a quote table ordered by a date column (one row per key and day)")
    import numpy as np

    keys = list(keys)
    names = list(names)
    out_schema = T.StructType(list(df.schema.fields) + [T.StructField(nm, T.DoubleType()) for nm in names])
    lost = sum(n - 1 for n in sizes) if chained else max(sizes) - 1

    def fold(pdf):
        pdf = pdf.sort_values(order_col, ascending=not newest_first, kind="stable").reset_index(drop=True)
        vals = pdf[value_col].to_numpy("float64")
        for n, nm in zip(sizes, names):
            # x0, x1, ..., then x_i, -x_(i-n) in turn: accumulate adds strictly in this order
            steps = np.zeros((len(vals), 2))
            steps[:, 0] = vals
            steps[n:, 1] = -vals[: max(0, len(vals) - n)]
            totals = np.add.accumulate(steps.ravel())[1::2]
            res = np.full(len(vals), np.nan)
            res[: max(0, len(vals) - n + 1)] = totals[n - 1 :] / n
            pdf[nm] = res
        return pdf.iloc[: max(0, len(pdf) - lost)]

    row = F.when(F.count("*") == 1, F.first(F.struct(*[F.col(f"`{c}`") for c in df.columns]))).otherwise(
        F.raise_error(F.lit("exact_running_sum: more than one row of a key and day")))
    single = df.groupBy(*keys, order_col).agg(row.alias("_row")).select("_row.*")
    out = single.groupBy(*keys).applyInPandas(fold, schema=out_schema)
    if fmt:
        out = out.withColumns({nm: F.format_string(fmt, F.col(nm)) for nm in names})
    return out


def sma(df: DataFrame, value_col: str, n: int, **kw) -> DataFrame:
    """Single SMA(n) (W1); ``max(0, L-n+1)`` rows per key survive."""
    return moving_averages(df, value_col, [n], **kw)


def sma_col(df: DataFrame, name: str, n: int, fmt: str | None = "%1.2f", **kw) -> DataFrame:
    """SMA(n) of a (possibly text) column, formatted, under the header ``"<name> SMA(<n>)"``.

    Text values are parsed as doubles first (a bad number fails the query, as
    ``toDouble`` does).
    """
    out = f"{name} SMA({n})"
    d = df.withColumn("_sma_x", F.col(f"`{name}`").cast("double"))
    return moving_averages(d, "_sma_x", [n], names=[out], fmt=fmt, **kw).drop("_sma_x")


def append_sma(quotes: DataFrame, n: int, value_col: str = "adj_close", fmt: str | None = "%1.2f", **kw) -> DataFrame:
    """``Adj Close SMA(n)`` appended to a newest-first quote table."""
    kw.setdefault("order_col", "date")
    return moving_averages(quotes, value_col, [n], fmt=fmt, **kw)


def calculated(quotes: DataFrame, spec: str = DEFAULT_CALCULATED, value_col: str = "adj_close", **kw) -> DataFrame:
    """Chained calculated columns from a spec such as ``sma(10),sma(50)``."""
    sizes = parse_calculated(spec)
    if not sizes:
        return quotes
    kw.setdefault("order_col", "date")
    return moving_averages(quotes, value_col, sizes, chained=True, **kw)


def compound_index(
    df: DataFrame,
    shock_col: str,
    initial: float = 100.0,
    *,
    keys: Sequence[str] = ("symbol",),
    order_col: str = "seq",
    out: str = "index",
    block_size: int = sequence.DEFAULT_BLOCK,
) -> DataFrame:
    """Running compounded index (W6): ``p_i = |p_{i-1} * (1 + shock_i)|``, ``p_{-1} = initial``.

    Computed as ``initial * exp(prefix_sum(log|1 + shock|))`` on the blocked
    plan; ``abs(p * f) = abs(p) * abs(f)`` makes this exact for any shock, and a
    running count of zero factors pins the index to 0 after one.
    """
    f = F.abs(F.lit(1.0) + F.col(shock_col).cast("double"))
    sums = {
        "_logsum": F.when(f == 0, F.lit(0.0)).otherwise(F.log(f)),
        "_zeros": (f == 0).cast("long"),
    }
    d = sequence.prefix_sums(df, keys, order_col, sums, block_size=block_size)
    value = F.when(F.col("_zeros") > 0, F.lit(0.0)).otherwise(F.lit(float(initial)) * F.exp("_logsum"))
    return d.withColumn(out, value).drop("_logsum", "_zeros")
