"""Chat formatting by perspective rotation: every participant's view of a dialogue.

For every participant the dialogue is rendered with that speaker's turns as the assistant's,
the other speakers as named users and context roles (system) unchanged. Only the
assistant's own content and end mark count for training: ``mask_start`` to ``mask_end`` are
their code points in the rendered dialogue, and equal numbers for the other turns. The
rendered dialogue is its segments in the order of ``position``; ``start`` is where a segment begins.

All of it is DataFrame operations with built-in functions. A long conversation never meets in
one task: turns are range-partitioned by conversation and order, running sums are built within
a conversation's share of a partition, and one total per share carries them on.

Defined cases: turns are ordered by number (null first), speaker, and digest of the text, so
equal rows follow each other and all stay. A null text is empty. A turn without a speaker
is shown as the user ``unknown`` and has no perspective of its own. Turns without a
conversation id form one conversation. A conversation of context turns only has no
participants and gives no rows. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketlab.operators.staging import stage

CONTEXT_ROLES = ("system",)
END = "<|end|>"


def _ordered_turns(turns: DataFrame, conversation: str, turn: str, speaker: str, text: str) -> DataFrame:
    """Turns in order, with the number of their partition and their place in it, written down."""
    key = F.coalesce(F.concat(F.lit("="), F.col(conversation).cast("string")), F.lit("?"))
    rows = turns.select(
        key.alias("key"), F.col(conversation).alias("conv_id"), F.col(turn).alias("turn"), F.col(speaker).alias("speaker"),
        F.coalesce(text, F.lit("")).alias("text"))
    rows = rows.withColumn("n_chars", F.char_length("text").cast("long")).withColumn("digest", F.md5("text"))
    order = ["key", "turn", "speaker", "digest"]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return stage(placed.select(
        "key", "conv_id", "speaker", "text", "n_chars", F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().alias("seq")), "ordered_turns")


def rotate_perspectives(
    turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", speaker: str = "role", text: str = "text",
    context: tuple[str, ...] = CONTEXT_ROLES,
) -> DataFrame:
    """Per conversation, perspective and turn: position, role, name, segment, start, mask_start, mask_end."""
    placed = _ordered_turns(turns, conversation, turn, speaker, text)
    shares = placed.groupBy("key", "part").agg(F.count(F.lit(1)).alias("_turns"))
    speakers = placed.filter(F.col("speaker").isNotNull() & ~F.col("speaker").isin(*context)).select(
        "key", F.col("speaker").alias("perspective")).distinct()
    views = shares.select("key", "part").join(speakers, "key")

    own = F.col("speaker").eqNullSafe(F.col("perspective"))
    role = F.when(own, "assistant").when(F.col("speaker").isin(*context), F.col("speaker")).otherwise("user")
    rows = placed.join(views, ["key", "part"]).withColumn("role", role)
    rows = rows.withColumn("name", F.when(F.col("role") == "user", F.coalesce("speaker", F.lit("unknown"))))
    head = F.concat(F.lit("<|"), F.col("role"), F.coalesce(F.concat(F.lit(" name="), F.col("name")), F.lit("")), F.lit("|>\n"))
    rows = rows.withColumn("head", head)
    rows = rows.withColumn("size", F.char_length("head") + F.col("n_chars") + len(END) + 1)

    # What the conversation's earlier shares hold: one row per share and perspective.
    totals = rows.groupBy("key", "perspective", "part").agg(F.sum("size").alias("chars"), F.count(F.lit(1)).alias("turns"))
    earlier = Window.partitionBy("key", "perspective").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "key", "perspective", "part", F.coalesce(F.sum("chars").over(earlier), F.lit(0)).alias("chars_before"),
        F.coalesce(F.sum("turns").over(earlier), F.lit(0)).alias("turns_before"))
    within = Window.partitionBy("key", "perspective", "part").orderBy("seq")
    before = F.coalesce(F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = rows.withColumn("inner", before).withColumn("rank", F.row_number().over(within) - 1).join(
        offsets, ["key", "perspective", "part"])
    start = F.col("chars_before") + F.col("inner")
    mask_start = start + F.char_length("head")
    return numbered.select(
        "conv_id", "perspective", (F.col("turns_before") + F.col("rank")).cast("long").alias("position"), "role", "name",
        F.concat("head", "text", F.lit(END + "\n")).alias("segment"), start.alias("start"), mask_start.alias("mask_start"),
        F.when(F.col("role") == "assistant", mask_start + F.col("n_chars") + len(END)).otherwise(mask_start).alias("mask_end"))


def query(spark, folder: str) -> DataFrame:
    return rotate_perspectives(spark.read.parquet(f"{folder}/conversations.parquet"))


_CONTEXT = ", ".join(f"'{c}'" for c in CONTEXT_ROLES)
ORACLE_SQL = rf"""
WITH speakers AS (
  SELECT DISTINCT conv_id, role AS perspective FROM conversations WHERE role IS NOT NULL AND role NOT IN ({_CONTEXT})),
views AS (
  SELECT c.conv_id, s.perspective, c.turn, c.role AS speaker, coalesce(c.text, '') AS t,
    CASE WHEN c.role IS NOT DISTINCT FROM s.perspective THEN 'assistant' WHEN c.role IN ({_CONTEXT}) THEN c.role ELSE 'user' END AS role
  FROM conversations c JOIN speakers s ON c.conv_id IS NOT DISTINCT FROM s.conv_id),
headed AS (
  SELECT *, CASE WHEN role = 'user' THEN coalesce(speaker, 'unknown') END AS name,
    '<|' || role || CASE WHEN role = 'user' THEN ' name=' || coalesce(speaker, 'unknown') ELSE '' END || '|>' || chr(10) AS head
  FROM views),
placed AS (
  SELECT *, row_number() OVER w - 1 AS position,
    coalesce(sum(length(head) + length(t) + {len(END) + 1}) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM headed
  WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker NULLS FIRST, md5(t)))
SELECT conv_id, perspective, position, role, name, head || t || '{END}' || chr(10) AS segment, start,
  start + length(head) AS mask_start,
  start + length(head) + CASE WHEN role = 'assistant' THEN length(t) + {len(END)} ELSE 0 END AS mask_end
FROM placed
"""
