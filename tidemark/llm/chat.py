"""Chat formatting by multi-party perspective rotation.

Every participant of a conversation gets a rendering of the whole dialogue in which
that participant is the assistant and all others are named users.  The loss mask
covers what the assistant says (its text and the end marker) and nothing else.
System messages stay system messages, are never masked in, and don't speak.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored

START, END, BROKEN = "<|im_start|>", "<|im_end|>", "<| "
SYSTEM = "system"


def numbered_messages(messages: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv_id, role, text, pos): messages with their position in the conversation, from 0.

    Messages are range-sorted, so a long conversation spreads over many tasks; within a
    partition its rows are neighbours, and one row per conversation and partition carries
    the positions across.
    """
    rows = messages.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.col(role_col).cast("string").alias("role"),
        F.col(text_col).cast("string").alias("text"),
    )
    rows = rows.withColumn("digest", F.md5(F.col("text").cast("binary")))
    order = ["conv_id", "turn", "role", "digest"]  # the same order between partitions as within them
    ranged = rows.repartitionByRange(*map(F.col, order)).sortWithinPartitions(*order).drop("digest")
    placed = stored(ranged.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()), "messages")
    firsts = placed.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = firsts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    firsts = firsts.select(F.col("conv_id").alias("c"), F.col("part").alias("p"), "first", "before")
    joined = placed.join(firsts, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")))
    return joined.select("conv_id", "role", "text", (F.col("at") - F.col("first") + F.col("before")).alias("pos"))


def _clean(value: str) -> str:
    return f"replace(coalesce({value}, ''), '<|im_', '{BROKEN}im_')"


def perspectives(
    messages: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    block: int = 256,
) -> DataFrame:
    """Render every conversation once for each participant.

    Returns conv_id, speaker, part, n_messages, text and mask, the spans of ``text`` that count
    for the loss: an array of struct(start, end), in code points, end exclusive.  A dialogue comes
    in parts of ``block`` messages, numbered from 0; the parts in order are the whole rendering,
    so no row grows with the length of a conversation.

    Participants are the distinct roles but system.  A null role takes no perspective and is a user
    without a name; a null text is empty; marker strings in names and texts are broken up by a
    blank.  Messages are ordered by turn (null first), role and the MD5 of the text; repeated messages are all
    rendered.  Messages without a conversation id are one conversation without an id.  An empty
    table gives an empty result.  Other columns are ignored.
    """
    placed = numbered_messages(messages, conv_col, turn_col, role_col, text_col)
    part = F.floor(F.col("pos") / block).cast("int").alias("part")
    groups = placed.groupBy("conv_id", part).agg(F.array_sort(F.collect_list(F.struct("pos", "role", "text"))).alias("messages"))
    speakers = placed.where(F.col("role").isNotNull() & (F.col("role") != SYSTEM)).select(F.col("conv_id").alias("c"), F.col("role").alias("speaker")).distinct()
    rows = groups.join(speakers, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    name = f"concat('{START}user name=', {_clean('m.role')}, '\\n')"
    head = f"CASE WHEN m.role <=> speaker THEN '{START}assistant\\n' WHEN m.role <=> '{SYSTEM}' THEN '{START}system\\n' WHEN m.role IS NULL THEN '{START}user\\n' ELSE {name} END"
    turns = f"transform(messages, m -> named_struct('head', {head}, 'said', concat({_clean('m.text')}, '{END}'), 'own', m.role <=> speaker))"
    rows = rows.withColumn("turns", F.expr(turns))
    rows = rows.withColumn("sizes", F.expr("transform(turns, t -> length(t.head) + length(t.said) + 1)"))
    at = "aggregate(slice(sizes, 1, i), 0, (a, s) -> a + s) + length(t.head)"
    spans = F.expr(f"transform(turns, (t, i) -> named_struct('start', {at}, 'end', {at} + length(t.said), 'own', t.own))")
    rows = rows.withColumn("spans", spans)
    return rows.select(
        "conv_id",
        "speaker",
        "part",
        F.size("messages").alias("n_messages"),
        F.expr("array_join(transform(turns, t -> concat(t.head, t.said, '\\n')), '')").alias("text"),
        F.expr("transform(filter(spans, s -> s.own), s -> named_struct('start', s.start, 'end', s.end))").alias("mask"),
    )


def mask_text(mask: str = "mask") -> Column:
    """The spans of a mask as start:end, joined by commas."""
    return F.expr(f"array_join(transform({mask}, s -> concat_ws(':', s.start, s.end)), ',')")


#: DuckDB SQL for the rows of the registered query.
PERSPECTIVES_SQL = f"""
WITH m AS (
  SELECT conv_id, role, replace(coalesce(text, ''), '<|im_', '{BROKEN}im_') || '{END}' AS said,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, md5(text) NULLS FIRST) - 1 AS pos
  FROM conversations),
p AS (SELECT DISTINCT conv_id, role AS speaker FROM conversations WHERE role IS NOT NULL AND role <> '{SYSTEM}'),
r AS (
  SELECT m.conv_id, p.speaker, m.pos // 256 AS part, m.pos, m.said, coalesce(m.role = p.speaker, false) AS own,
         CASE WHEN m.role = p.speaker THEN '{START}assistant' WHEN m.role = '{SYSTEM}' THEN '{START}system'
              WHEN m.role IS NULL THEN '{START}user'
              ELSE '{START}user name=' || replace(m.role, '<|im_', '{BROKEN}im_') END || chr(10) AS head
  FROM m JOIN p ON m.conv_id IS NOT DISTINCT FROM p.conv_id),
o AS (
  SELECT *, sum(length(head) + length(said) + 1) OVER (PARTITION BY conv_id, speaker, part ORDER BY pos)
            - length(said) - 1 AS said_at
  FROM r)
SELECT conv_id, speaker, CAST(part AS INTEGER) AS part, CAST(count(*) AS INTEGER) AS n_messages,
       string_agg(head || said || chr(10), '' ORDER BY pos) AS text,
       string_agg(CAST(said_at AS VARCHAR) || ':' || CAST(said_at + length(said) AS VARCHAR), ',' ORDER BY pos) FILTER (WHERE own) AS mask
FROM o GROUP BY conv_id, speaker, part
"""
