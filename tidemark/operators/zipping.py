"""Positional pairing of two tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans import sequence


def _prefixed(df: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    if not prefix:
        return df
    return df.select(*keys, *[F.col(c).alias(prefix + c) for c in df.columns if c not in keys])


def zip_join(
    left: DataFrame,
    right: DataFrame,
    *,
    keys: Sequence[str] = ("symbol",),
    left_order: str = "seq",
    right_order: str = "seq",
    left_prefix: str = "l_",
    right_prefix: str = "r_",
    pos_col: str = "rn",
    left_descending: bool = False,
    right_descending: bool = False,
    block_size: int = sequence.DEFAULT_BLOCK,
) -> DataFrame:
    """Pair the i-th row of ``left`` with the i-th row of ``right`` per key; stop at the shorter.

    Positions come from the blocked row numbering; the pairing itself is an
    inner equi-join on ``(keys, rn)``, whose key is unique on both sides, so it
    cannot skew however large one symbol is.
    """
    lk = sequence.number_rows(left, keys, left_order, pos_col, descending=left_descending, block_size=block_size)
    rk = sequence.number_rows(right, keys, right_order, pos_col, descending=right_descending, block_size=block_size)
    on = [*keys, pos_col]
    left_p = _prefixed(lk, on, left_prefix)
    right_p = _prefixed(rk, on, right_prefix).select(*[F.col(c).alias(f"_r_{c}") if c in on else F.col(c)
                                                      for c in _prefixed(rk, on, right_prefix).columns])
    # null-safe on the keys: rows without a symbol pair among themselves instead of vanishing
    cond = [left_p[k].eqNullSafe(right_p[f"_r_{k}"]) for k in keys] + [left_p[pos_col] == right_p[f"_r_{pos_col}"]]
    return left_p.join(right_p, cond, "inner").drop(*[f"_r_{c}" for c in on])
