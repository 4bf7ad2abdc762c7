"""Small tables with the awkward cases every operator must take: nulls, empty and long texts,
repeated rows, extra columns whose names operators use themselves."""

from __future__ import annotations

import random

LONG = " ".join(random.Random(5).choices(["alpha", "beta,", "gamma.\n", "É", "42", "don't"], k=60_000))
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog. It's 3 o'clock!"),
    (2, ""),
    (3, None),
    (4, LONG),
    (5, "   \n\t  "),
    (5, "   \n\t  "),
    (6, "The quick brown fox jumps over the lazy dog. It's 3 o'clock!"),
    (None, "no id here, but text"),
    (None, None),
    (7, "中文 \U0001f600 é <|endoftext|> 'LL we'll"),
    (8, "a\n \n  b   c\r\n d  "),
]
EXTRA = "fp long, spans string, score string, part int, sequence_id string, row string, ids string"


def documents(spark, rows=None):
    rows = TEXTS if rows is None else rows
    return spark.createDataFrame([(i, t, "en", 9, "x", "y", 1, "z", "r", "q") for i, t in rows], f"doc_id long, text string, lang string, {EXTRA}")
