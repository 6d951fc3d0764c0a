"""Chat formatting: one rendering of a dialogue per participant.

In the rendering for a participant, that speaker's messages are the
assistant's, everyone else's are named users', and system messages stay
system messages.  The result has one row per message and perspective: the
rendered ``segment``, its character span in the whole rendering, and
``trained`` (true on the assistant's content, which ``mask_start`` and
``mask_end`` bound).  Segments in the order of ``start`` make up the whole
rendering, so no dialogue has to fit in one task.

Spans are prefix sums in two levels: sums per block of consecutive turns,
then inside each block.  A dialogue with a third of all rows so spreads over
its blocks; its messages meet their participants in ``SALT`` parts.  Rows of one
dialogue with equal turns, or null ones, are ordered in one block.

Cases: a null text renders as empty; a null role is the speaker
``unknown``; a dialogue with system messages only has no participant and no
row; equal turns are ordered by role and text and repeats stay; null turns
come first; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK, SALT = 256, 16
SYSTEM = "system"
OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"


def perspectives(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text", block: int = BLOCK) -> DataFrame:
    """``conv_id, perspective, turn, speaker, chat_role, segment, start, end, trained, mask_start, mask_end``."""
    rows = turns.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
                        F.coalesce(F.col(role), F.lit("unknown")).alias("speaker"),
                        F.coalesce(F.col(text), F.lit("")).alias("text"))
    people = rows.where(F.col("speaker") != SYSTEM).select(
        F.col("conv_id").alias("_conv"), F.col("speaker").alias("perspective")).distinct()
    people = people.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    dealt = rows.withColumn("_deal", F.pmod(F.xxhash64("turn", "speaker", "text"), F.lit(SALT)).cast("int"))
    seen = dealt.join(people, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("_deal") == F.col("_part"))).drop(
        "_conv", "_part", "_deal")
    own = F.col("speaker") == F.col("perspective")
    chat_role = F.when(F.col("speaker") == SYSTEM, "system").when(own, "assistant").otherwise("user")
    head = F.concat(F.lit(OPEN), F.col("chat_role"),
                    F.when(F.col("chat_role") == "user", F.concat(F.lit(" name="), F.col("speaker"))).otherwise(F.lit("")),
                    F.lit(CLOSE))
    seen = (seen.withColumn("chat_role", chat_role).withColumn("_head", head)
            .withColumn("segment", F.concat("_head", "text", F.lit(END)))
            .withColumn("_n", F.length("segment").cast("long"))
            .withColumn("_block", F.floor(F.col("turn") / F.lit(block))))
    group = ["conv_id", "perspective"]
    sums = seen.groupBy(*group, "_block").agg(F.sum("_n").alias("_s"))
    before = Window.partitionBy(*group).orderBy(F.col("_block").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*[F.col(c).alias(f"_{c}") for c in group], F.col("_block").alias("_b"),
                       F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_off"))
    on = (F.col("conv_id").eqNullSafe(F.col("_conv_id")) & (F.col("perspective") == F.col("_perspective"))
          & F.col("_block").eqNullSafe(F.col("_b")))
    inside = Window.partitionBy(*group, "_block").orderBy(
        F.col("turn").asc_nulls_first(), "speaker", "text").rowsBetween(Window.unboundedPreceding, -1)
    placed = seen.withColumn("_in", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(sums, on)
    start = F.col("_off") + F.col("_in")
    trained = F.col("chat_role") == "assistant"
    return placed.select(
        "conv_id", "perspective", "turn", "speaker", "chat_role", "segment", start.alias("start"),
        (start + F.col("_n")).alias("end"), trained.alias("trained"),
        F.when(trained, start + F.length("_head")).alias("mask_start"),
        F.when(trained, start + F.col("_n")).alias("mask_end"))


def digest(turns: DataFrame, **columns) -> DataFrame:
    """The spans with the segment's md5 in place of its text."""
    return perspectives(turns, **columns).withColumn("segment_md5", F.md5("segment")).drop("segment")


ORACLE = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS txt FROM conversations),
p AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> 'system'),
s AS (SELECT t.*, perspective, CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = perspective THEN 'assistant' ELSE 'user' END AS chat_role
      FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
h AS (SELECT *, '<|' || chat_role || CASE WHEN chat_role = 'user' THEN ' name=' || speaker ELSE '' END || '|>' || chr(10) AS head FROM s),
g AS (SELECT *, head || txt || '<|end|>' || chr(10) AS segment FROM h),
o AS (SELECT *, coalesce(sum(length(segment)) OVER (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, txt
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM g)
SELECT conv_id, perspective, turn, speaker, chat_role, start, (start + length(segment))::BIGINT AS "end",
  chat_role = 'assistant' AS trained,
  CASE WHEN chat_role = 'assistant' THEN (start + length(head))::BIGINT END AS mask_start,
  CASE WHEN chat_role = 'assistant' THEN (start + length(segment))::BIGINT END AS mask_end,
  md5(segment) AS segment_md5
FROM o
"""
