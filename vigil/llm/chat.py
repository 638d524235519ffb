"""Chat formatting by perspective rotation.

A dialogue with ``k`` participants is rendered ``k`` times, each time with
one of them as the assistant and the others as named users. Every turn is a
row with its place and its character span in the rendered dialogue; the loss
mask covers the text and the end mark of the assistant's turns.

Places and spans are prefix sums. The turns are range-sorted once, by
conversation, number, name and text; sums are taken over the ranges first
and then inside each, so a conversation of any length, with whatever numbers
its turns have, is split over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import read_table, stored

# --- fixed values: the template -----------------------------------------------
OPEN, CLOSE, END = "<|", "|>", "<|end|>\n"
# -------------------------------------------------------------------------------
SYSTEM_ROLES = ("system",)
_PART_BITS = 33  # monotonically_increasing_id: the partition is above these bits, the place in it below


def rotate(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", system_roles: tuple[str, ...] = SYSTEM_ROLES) -> DataFrame:
    """(conv_id, perspective, turn, position, chat_role, name, rendered, char_start, char_end, loss_start, loss_end).

    Participants are the distinct roles of a conversation other than
    ``system_roles``, whose turns are rendered as system turns from every
    perspective; a conversation without participants gives no rows. A turn
    is rendered as ``<|assistant|>``, ``<|user:NAME|>`` or ``<|system|>``, a
    line feed, the text and the end mark. ``loss_start`` and ``loss_end``
    are null where nothing is learnt.

    A null role is a participant named ``unknown``, a null text is empty,
    rows with a null conversation form one conversation of their own, and a
    null turn comes first. Turns with the same number are ordered by role
    and text; repeated rows are rendered once each. An empty table gives an
    empty result; other input columns are ignored.
    """
    # Keys without nulls, so that the join and the window share one exchange of the texts.
    conv = F.concat(F.when(F.col(conv_col).isNull(), "null").otherwise("="), F.coalesce(
        F.col(conv_col).cast("string"), F.lit("")))
    base = turns.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("unknown")).alias("name"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), conv.alias("conv"))
    # Equal turns cannot be told apart: the last key only deals them out.
    keys = ("conv", "turn", "name", "text", "_row")
    base = base.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    base = stored(base.drop("_row").withColumn("at", F.monotonically_increasing_id()), "chat-turns").withColumn(
        "range", F.shiftright("at", _PART_BITS))
    is_system = F.col("name").isin(*system_roles)
    own = F.col("name") == F.col("perspective")

    # Where each range of turns begins, for each participant: counts and sizes only.
    sums = stored(base.groupBy("conv", "range", "name").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars")), "chat-ranges")
    people = sums.filter(~is_system).select(F.col("conv").alias("_conv"), F.col("name").alias("perspective")).distinct()
    marks = [F.length(F.lit(OPEN + role + CLOSE + "\n" + END)) for role in ("assistant", "system", "user:")]
    extra = F.when(own, marks[0]).when(is_system, marks[1]).otherwise(marks[2] + F.length("name"))
    ranges = sums.join(people, F.col("conv") == F.col("_conv")).groupBy("conv", "perspective", "range").agg(
        F.sum("n").alias("n"), F.sum(F.col("chars") + F.col("n") * extra).alias("size"))
    earlier = Window.partitionBy("conv", "perspective").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select(
        F.col("conv").alias("_conv"), "perspective", F.col("range").alias("_range"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n_before"),
        F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("chars_before"))

    chat_role = F.when(own, F.lit("assistant")).when(is_system, F.lit("system")).otherwise(F.lit("user"))
    label = F.when(F.col("chat_role") == "user", F.concat(F.lit("user:"), F.col("name"))).otherwise(F.col("chat_role"))
    seen = base.join(starts, (F.col("conv") == F.col("_conv")) & (F.col("range") == F.col("_range"))).withColumn(
        "chat_role", chat_role).withColumn("head", F.concat(F.lit(OPEN), label, F.lit(CLOSE + "\n")))
    seen = seen.withColumn("size", (F.length("head") + F.length("text") + len(END)).cast("long"))
    inside = Window.partitionBy("conv", "perspective", "range").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    placed = seen.withColumn("position", F.col("n_before") + F.count(F.lit(1)).over(inside)).withColumn(
        "char_start", F.col("chars_before") + F.coalesce(F.sum("size").over(inside), F.lit(0))).withColumn(
        "rendered", F.concat("head", "text", F.lit(END)))
    learnt = F.col("chat_role") == "assistant"
    return placed.select(
        "conv_id", "perspective", "turn", F.col("position").cast("long").alias("position"), "chat_role", "name",
        "rendered", "char_start", (F.col("char_start") + F.col("size")).alias("char_end"),
        F.when(learnt, F.col("char_start") + F.length("head")).alias("loss_start"),
        F.when(learnt, F.col("char_start") + F.col("size")).alias("loss_end"))


def op4_rotate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotate(read_table(spark, sf_dir, "conversations"))


ORACLE = """
WITH base AS (
  SELECT conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, 'unknown') AS name, coalesce(text, '') AS text
  FROM conversations),
people AS (SELECT DISTINCT conv_id, name AS perspective FROM base WHERE name <> 'system'),
seen AS (
  SELECT b.*, p.perspective,
         CASE WHEN b.name = p.perspective THEN 'assistant' WHEN b.name = 'system' THEN 'system' ELSE 'user' END
           AS chat_role
  FROM base b JOIN people p ON b.conv_id IS NOT DISTINCT FROM p.conv_id),
headed AS (
  SELECT *, '<|' || CASE WHEN chat_role = 'user' THEN 'user:' || name ELSE chat_role END || '|>' || chr(10) AS head
  FROM seen),
rendered AS (SELECT *, head || text || '<|end|>' || chr(10) AS rendered FROM headed),
placed AS (
  SELECT *, count(*) OVER w AS position,
         coalesce(sum(length(rendered)) OVER w, 0) AS char_start
  FROM rendered
  WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, name, text
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT conv_id, perspective, turn, CAST(position AS BIGINT) AS position, chat_role, name, rendered,
       CAST(char_start AS BIGINT) AS char_start, CAST(char_start + length(rendered) AS BIGINT) AS char_end,
       CAST(CASE WHEN chat_role = 'assistant' THEN char_start + length(head) END AS BIGINT) AS loss_start,
       CAST(CASE WHEN chat_role = 'assistant' THEN char_start + length(rendered) END AS BIGINT) AS loss_end
FROM placed
"""
