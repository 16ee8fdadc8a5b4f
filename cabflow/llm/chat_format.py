"""Chat formatting with cumulative-snapshot collapse.

Chat logs often hold the same conversation several times, each snapshot a few
turns longer. Every turn gets the rolling hash of the conversation up to it: two
sums of position-salted 64-bit hashes, so a prefix hash needs no ordered fold and
a very long conversation is split over tasks. A conversation whose whole hash is
the hash of a proper prefix of another one is dropped by an anti-join; of equal
conversations the smallest conv_id stays. What remains is rendered.

Defined results: turns are ordered by (turn, role, text), nulls first; equal rows
are turns of their own; a null role or text counts as empty; rows without a
conv_id form one conversation. A rendered row holds at most ``part_turns`` turns,
so one that is longer becomes several rows (part 0, 1, ...). An empty table gives
an empty result. Columns other than conv_id, turn, role and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cabflow.llm.common import load, running_sums

PART_TURNS = 512


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """conv (key), conv_id, role, text, pos (from 1), h1, h2 and the sums p1, p2 before this turn."""
    rows = turns.select(
        F.when(F.col("conv_id").isNull(), F.lit("")).otherwise(F.concat(F.lit("#"), F.col("conv_id").cast("string"))).alias("conv"),
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.lit(1).cast("long").alias("one"),
    )
    rows = rows.withColumn("bucket", F.coalesce(F.floor(F.col("turn") / F.lit(PART_TURNS)), F.lit(-(2**62))).cast("long"))
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    rows = running_sums(rows, ["conv"], "bucket", order, {"before": "one"})
    rows = rows.withColumn("pos", F.col("before") + 1).drop("bucket", "before", "one")
    rows = rows.withColumns(
        {
            "h1": F.xxhash64(F.lit("a"), "pos", "role", "text").cast("decimal(20,0)"),
            "h2": F.xxhash64(F.lit("b"), "text", "role", "pos").cast("decimal(20,0)"),
            "part": F.floor((F.col("pos") - 1) / F.lit(PART_TURNS)).cast("long"),
        }
    )
    rows = running_sums(rows, ["conv"], "part", [F.col("pos")], {"p1": "h1", "p2": "h2"})
    return rows.withColumns({"p1": F.col("p1").cast("decimal(38,0)"), "p2": F.col("p2").cast("decimal(38,0)")})


def maximal_conversations(hashed: DataFrame) -> DataFrame:
    """conv, n_turns, n_copies of the conversations that no other one continues."""
    whole = lambda p, h: (F.col(p) + F.col(h)).cast("decimal(38,0)")
    last = hashed.groupBy("conv").agg(
        F.max(F.struct("pos", whole("p1", "h1").alias("w1"), whole("p2", "h2").alias("w2"))).alias("last"),
        F.min("conv_id").alias("conv_id"),
    )
    complete = last.groupBy(
        F.col("last.pos").alias("n_turns"), F.col("last.w1").alias("w1"), F.col("last.w2").alias("w2")
    ).agg(F.min(F.struct("conv_id", "conv")).alias("first"), F.count(F.lit(1)).alias("n_copies"))
    # The state before a turn is a proper prefix: a turn follows it.
    proper = hashed.filter("pos > 1").select(
        (F.col("pos") - 1).alias("n_turns"), F.col("p1").alias("w1"), F.col("p2").alias("w2")
    ).distinct()
    kept = complete.join(proper, ["n_turns", "w1", "w2"], "left_anti")
    return kept.select(F.col("first.conv").alias("conv"), "n_turns", "n_copies")


def rendered_turn(role: Column, text: Column) -> Column:
    """One turn with its markers; marker openings inside the text are broken up."""
    safe = lambda c: F.replace(c, F.lit("<|"), F.lit("< |"))
    return F.concat(F.lit("<|im_start|>"), safe(role), F.lit("\n"), safe(text), F.lit("<|im_end|>\n"))


def chat_format(turns: DataFrame) -> DataFrame:
    """conv_id, part, n_turns (whole conversation), n_copies and the rendered text."""
    hashed = prefix_hashes(turns)
    kept = maximal_conversations(hashed).withColumnRenamed("conv", "__conv")
    rows = hashed.join(kept, F.col("conv") == F.col("__conv"), "inner")
    parts = rows.groupBy("conv", "part").agg(
        F.first("conv_id").alias("conv_id"),
        F.first("n_turns").alias("n_turns"),
        F.first("n_copies").alias("n_copies"),
        F.array_sort(F.collect_list(F.struct("pos", rendered_turn(F.col("role"), F.col("text")).alias("segment")))).alias("turns"),
    )
    return parts.select(
        "conv_id", "part", "n_turns", "n_copies", F.array_join(F.transform("turns", lambda t: t["segment"]), "").alias("text")
    )


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations collapsed to the maximal ones and rendered."""
    return chat_format(load(spark, sf_dir, "conversations"))


OP9_SQL = r"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id
                            ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations
), hashed AS (
  SELECT *, string_agg(md5(role || chr(31) || text), ',')
              OVER (PARTITION BY conv_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS prefix,
         count(*) OVER (PARTITION BY conv_id) AS n_turns
  FROM turns
), complete AS (
  SELECT prefix, min(conv_id) AS conv_id, count(*) AS n_copies FROM hashed WHERE pos = n_turns GROUP BY prefix
), kept AS (
  SELECT c.* FROM complete c
  WHERE NOT EXISTS (SELECT 1 FROM hashed h WHERE h.pos < h.n_turns AND h.prefix = c.prefix)
)
SELECT h.conv_id, ((h.pos - 1) // 512)::BIGINT AS part, h.n_turns::BIGINT AS n_turns, k.n_copies::BIGINT AS n_copies,
       string_agg('<|im_start|>' || replace(h.role, '<|', '< |') || chr(10) || replace(h.text, '<|', '< |')
                  || '<|im_end|>' || chr(10), '' ORDER BY h.pos) AS text
FROM hashed h JOIN kept k ON h.conv_id IS NOT DISTINCT FROM k.conv_id
GROUP BY h.conv_id, (h.pos - 1) // 512, h.n_turns, k.n_copies
"""
