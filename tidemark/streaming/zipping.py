"""Positional pairing of two live streams.

The i-th row of the left stream meets the i-th row of the right one per symbol, whichever comes
first.  A position is a stripe's offset and a place within it: stripes (see ``stateful``) count
their rows, one small state per symbol and side adds up whole stripes, and rows meet in
blocks of positions, where the early side waits.  So no step pins a hot symbol to a task
but the one that sees a number per stripe.  Rows that find no partner stay in the state.
Tasks pack the rows of a stripe into chunks before they are dealt out; chunks travel
between the steps and wait in the state, so a row costs no call to the state store.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .processors import BUNDLE, CountStripe, OffsetStripe, PairBlock, PlaceStripe, pack_stripes
from .stateful import STRIPE, start, with_state_keys

_JSON = {
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}
_KEYS = "_v_symbol string, _n_symbol boolean"


def zip_stream(left: DataFrame, right: DataFrame, left_order: str = "seq", right_order: str = "seq", left_prefix: str = "l_",
               right_prefix: str = "r_", pos_col: str = "rn", stripe: int = STRIPE, block: int = 4096) -> DataFrame:
    """Pairs of two streams with a ``symbol``: symbol, position (from 1) and the other columns of both sides, prefixed.

    Equal to the batch :func:`~tidemark.operators.zipping.zip_join` over all rows that have arrived, except that
    columns keep their prefix.  Rows of a side come in order of its order column between micro-batches; one
    that belongs to an earlier stripe than its side has reached, or has no order value, fails the query.
    Rows without a symbol pair among themselves.
    """
    sides, schemas = [], []
    for number, (side, order) in enumerate(((left, left_order), (right, right_order))):
        own = [c for c in side.columns if c != "symbol"]
        schemas.append(T.StructType([side.schema[c] for c in own]))
        at = F.when(F.col(order).isNull(), F.raise_error(F.lit(f"a row without {order}"))).otherwise(F.col(order).cast("long"))
        row = F.to_json(F.struct(*own), _JSON)
        sides.append(side.select("symbol", F.lit(number).alias("side"), at.alias("ord"), F.floor(at / stripe).alias("stripe"), row.alias("row")))
    rows, names = with_state_keys(sides[0].unionByName(sides[1]), ["symbol"])
    head = f"{_KEYS}, side int"
    chunk, bundle = "stripe long, place long, n long, rows string", F.shiftright("stripe", BUNDLE)
    out = rows.drop("symbol").mapInPandas(pack_stripes([*names, "side", "stripe"]), f"{head}, stripe long, ords binary, rows string")
    keys = [*names, "side", "bundle"]
    out = out.withColumn("bundle", bundle).groupBy(*keys).transformWithStateInPandas(CountStripe(keys), f"{head}, slot long, {chunk}", "append", "none")
    keys = [*names, "side", "slot"]
    out = out.groupBy(*keys).transformWithStateInPandas(OffsetStripe(keys), f"{head}, {chunk}", "append", "none")
    keys = [*names, "side", "bundle"]
    out = out.withColumn("bundle", bundle).groupBy(*keys).transformWithStateInPandas(
        PlaceStripe(keys, block), f"{head}, block long, pos long, rows string", "append", "none")
    keys = [*names, "block"]
    out = out.groupBy(*keys).transformWithStateInPandas(PairBlock(keys, block), f"{_KEYS}, pos long, left string, right string", "append", "none")
    symbol = F.when(~F.col(names[1]), F.col(names[0])).cast(left.schema["symbol"].dataType).alias("symbol")
    parsed = out.select(symbol, F.col("pos").alias(pos_col), *(F.from_json(c, s, _JSON).alias(c) for c, s in zip(("left", "right"), schemas)))
    cols = [F.col(f"{c}.{f.name}").alias(p + f.name) for c, p, s in zip(("left", "right"), (left_prefix, right_prefix), schemas) for f in s.fields]
    return parsed.select("symbol", pos_col, *cols)


def stream_zip(left: DataFrame, right: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, partitions: int | None = None, **kw):
    """Start pairing; returns the ``StreamingQuery``, which appends pairs to Parquet files under ``path``."""
    return start(zip_stream(left, right, **kw), path, checkpoint, trigger, partitions)
