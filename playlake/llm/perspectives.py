"""Multi-party perspective rotation of chats (operator 3), in DataFrame functions only.

For every participant of a conversation the dialogue is rendered once more: that speaker's turns
become the assistant's, all others' become turns of users with their names, and the loss mask covers what the
speaker says. Turns by ``CONTEXT`` speakers (system prompts) stay what they are in every rendering
and are no participants.

A rendering is a table of segments, one for each turn, with offsets into the rendered dialogue: the
dialogue is the segments in order, and the mask is the offsets ``loss_start`` to ``loss_end`` of its own turns
(text and end mark). So a conversation that holds a third of all turns is still many rows. Offsets
are running sums over the conversation. They are taken inside range partitions of (conversation, turn), of
which a long conversation spans several, and shifted by the sums of the partitions before; no task
holds a whole conversation. A rendering's offsets follow from two sums that do not depend on the
perspective: lengths as a user's turns, and what the speaker's own turns differ by.

Edge cases: turns with equal or null numbers are ordered by speaker, then by text (nulls first), and
equal rows stay two turns; a null text is an empty turn; a null speaker is named ``unknown``; a null conv_id is a
conversation of its own. A conversation without participants (system prompts only) has no rendering.
``<|`` in texts and names is broken by a space, so that no text can forge a mark. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from playlake.llm.common import store

CONTEXT = ("system",)
START, END = "<|start|>", "<|end|>\n"


def _safe(c: Column) -> Column:
    return F.replace(F.coalesce(c, F.lit("")), F.lit("<|"), F.lit("< |"))


def _ordered(turns: DataFrame, speaker: str) -> DataFrame:
    who = F.coalesce(_safe(F.col(speaker).cast("string")), F.lit(""))
    who = F.when(F.col(speaker).isNull(), "unknown").otherwise(who)
    name = F.regexp_replace(who, r"\s+", "_")
    return turns.select(
        F.col("conv_id"), F.col("turn"), who.alias("speaker"), name.alias("name"),
        F.col("text").cast("string").alias("raw"), _safe(F.col("text").cast("string")).alias("content"),
        F.monotonically_increasing_id().alias("tie"),
    )


def render(spark: SparkSession, turns: DataFrame, speaker: str = "role") -> DataFrame:
    """(conv_id, perspective, position, turn, speaker, segment, char_start, loss_start, loss_end).

    char_start is the offset of the segment in the rendered dialogue (code points); loss_start and
    loss_end are offsets of the learned part, null in the turns of others.
    """
    order = ["conv_id", "turn", "speaker", "raw", "tie"]
    context = F.col("speaker").isin(*CONTEXT)
    rows = _ordered(turns, speaker).repartitionByRange(*order).sortWithinPartitions(*order)
    other = F.when(context, F.concat(F.lit(START), "speaker", F.lit("\n"), "content", F.lit(END))).otherwise(
        F.concat(F.lit(f"{START}user name="), "name", F.lit("\n"), "content", F.lit(END))
    )
    own = F.when(~context, F.concat(F.lit(f"{START}assistant\n"), "content", F.lit(END)))
    rows = rows.select(
        "conv_id", "turn", "speaker", "raw", "tie", F.spark_partition_id().alias("pid"), other.alias("as_user"), own.alias("as_self")
    ).withColumn("wide", F.length("as_user")).withColumn("extra", F.length("as_self") - F.length("as_user"))
    # stored once: later steps must see the same range partitions
    rows = store(spark, rows, "turns")

    running = Window.partitionBy("pid", "conv_id").orderBy("turn", "speaker", "raw", "tie").rowsBetween(Window.unboundedPreceding, -1)
    inside = rows.withColumn("n_in", F.count("*").over(running)).withColumn("wide_in", F.coalesce(F.sum("wide").over(running), F.lit(0)))
    before = Window.partitionBy("conv_id").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    shift = (
        rows.groupBy("conv_id", "pid").agg(F.count("*").alias("n"), F.sum("wide").alias("w"))
        .select(
            F.col("conv_id").alias("c"), F.col("pid").alias("p"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n_before"),
            F.coalesce(F.sum("w").over(before), F.lit(0)).alias("wide_before"),
        )
    )
    placed = inside.join(shift, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("pid") == F.col("p"))).select(
        "conv_id", "turn", "speaker", "raw", "tie", "pid", "as_user", "as_self", "extra",
        (F.col("n_in") + F.col("n_before")).alias("position"), (F.col("wide_in") + F.col("wide_before")).alias("start"),
    )

    # what a speaker's own turns before this one differ by, in that speaker's rendering
    parts = rows.where("as_self is not null").groupBy("conv_id", "speaker", "pid").agg(F.sum("extra").alias("x"))
    by_speaker = Window.partitionBy("conv_id", "speaker").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    who = parts.select(F.col("conv_id").alias("c"), F.col("speaker").alias("perspective")).distinct()
    steps = (
        rows.select("conv_id", "pid").distinct()
        .join(who, F.col("conv_id").eqNullSafe(F.col("c")))
        .drop("c")
        .join(
            parts.select(F.col("conv_id").alias("c"), F.col("speaker").alias("s"), F.col("pid").alias("p"), "x"),
            F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("perspective") == F.col("s")) & (F.col("pid") == F.col("p")), "left",
        )
        .select("conv_id", F.col("perspective").alias("speaker"), "pid", F.coalesce("x", F.lit(0)).alias("x"))
        .select(
            F.col("conv_id").alias("c"), F.col("speaker").alias("perspective"), F.col("pid").alias("p"),
            F.coalesce(F.sum("x").over(by_speaker), F.lit(0)).alias("x_before"),
        )
    )
    views = placed.join(steps, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("pid") == F.col("p"))).drop("c", "p")
    mine = F.col("speaker") == F.col("perspective")
    in_view = Window.partitionBy("pid", "conv_id", "perspective").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    x_in = F.coalesce(F.sum(F.when(mine, F.col("extra")).otherwise(0)).over(in_view), F.lit(0))
    out = views.withColumn("char_start", F.col("start") + F.col("x_before") + x_in).withColumn(
        "segment", F.when(mine, F.col("as_self")).otherwise(F.col("as_user"))
    )
    head = len(f"{START}assistant\n")
    return out.select(
        "conv_id", "perspective", F.col("position").cast("long").alias("position"), "turn", "speaker", "segment",
        F.col("char_start").cast("long").alias("char_start"),
        F.when(mine, F.col("char_start") + head).cast("long").alias("loss_start"),
        F.when(mine, F.col("char_start") + F.length("segment")).cast("long").alias("loss_end"),
    )


#: The same rows in DuckDB, for conversations with columns conv_id, turn, role and text.
ORACLE = r"""
WITH t AS (
  SELECT conv_id, turn, CASE WHEN role IS NULL THEN 'unknown' ELSE replace(role, '<|', '< |') END AS speaker,
         text AS raw, replace(coalesce(text, ''), '<|', '< |') AS content
  FROM conversations
), s AS (
  SELECT conv_id, turn, speaker, raw,
         CASE WHEN speaker = 'system' THEN '<|start|>' || speaker || chr(10) || content || '<|end|>' || chr(10)
              ELSE '<|start|>user name=' || regexp_replace(speaker, '\s+', '_', 'g') || chr(10) || content || '<|end|>' || chr(10) END AS as_user,
         CASE WHEN speaker <> 'system' THEN '<|start|>assistant' || chr(10) || content || '<|end|>' || chr(10) END AS as_self,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, encode(speaker), encode(raw) NULLS FIRST) - 1 AS position
  FROM t
), p AS (
  SELECT DISTINCT conv_id, speaker AS perspective FROM s WHERE speaker <> 'system'
), v AS (
  SELECT s.conv_id, p.perspective, s.position, s.turn, s.speaker, s.speaker = p.perspective AS mine,
         CASE WHEN s.speaker = p.perspective THEN s.as_self ELSE s.as_user END AS segment
  FROM s JOIN p ON s.conv_id IS NOT DISTINCT FROM p.conv_id
), o AS (
  SELECT *, coalesce(sum(length(segment)) OVER (PARTITION BY conv_id, perspective ORDER BY position
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS char_start
  FROM v
)
SELECT conv_id, perspective, position::BIGINT AS position, turn, speaker, segment, char_start,
       CASE WHEN mine THEN char_start + length('<|start|>assistant') + 1 END AS loss_start,
       CASE WHEN mine THEN char_start + length(segment) END::BIGINT AS loss_end
FROM o
"""
