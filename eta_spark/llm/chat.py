"""Chat logs: drops snapshots that a longer log continues, and renders what is left.

Logs often hold a conversation after every turn. A conversation is a snapshot
if its turns are the first turns of a longer one. Each turn has a hash of its
position, role and text; running sums of these hashes along a conversation
are the hashes of its prefixes, 128 bits in four lanes. Equal conversations
meet in one, the smallest conv_id; an anti-join with all proper prefixes
leaves the maximal ones, whose turns are rendered.

Turns are numbered by (turn, role, text) order within ranges of 1024 turn
numbers, plus offsets of the ranges, so one endless conversation is split. A
first turn shared by many conversations meets after partial aggregation.
Everything is DataFrame expressions.

Null roles and texts count as empty; a null turn comes first. Equal rows of a
conversation count once, different rows of the same turn both count. Rows
without conv_id belong to no conversation and are left out. Empty tables give
empty results. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eta_spark.llm.common import stored

RANGE = 1024
#: The marks of a turn; their opening is parted in texts, so that a text cannot start a turn.
OPEN, PARTED = "<|", "< |"


def segment(role: Column, text: Column) -> Column:
    plain = lambda c: F.replace(c, F.lit(OPEN), F.lit(PARTED))
    return F.concat(F.lit(OPEN), plain(role), F.lit("|>\n"), plain(text), F.lit("\n"))


def _lanes(*values: Column) -> list[Column]:
    """128 hash bits as four numbers of 32 bits, whose sums cannot overflow."""
    low, high = F.xxhash64(*values), F.xxhash64(F.lit("other"), *values)
    return [part for h in (low, high) for part in (h.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(h, 32))]


def numbered(conversations: DataFrame) -> DataFrame:
    """conv_id, position, role, text and the four lanes of the prefix that ends with the turn; n_turns."""
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    rows = rows.distinct().withColumn("part", F.coalesce(F.floor(F.col("turn") / RANGE), F.lit(-(2**62))))
    within = Window.partitionBy("conv_id", "part").orderBy("turn", "role", "text")
    placed = stored(rows.withColumn("place", F.row_number().over(within)), "turns")

    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("conv_id")
    parts = placed.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    parts = parts.select("conv_id", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"), F.sum("n").over(whole).alias("n_turns"))
    rows = placed.join(parts, ["conv_id", "part"]).withColumn("position", F.col("base") + F.col("place") - 1)
    rows = rows.withColumns({f"h{i}": lane for i, lane in enumerate(_lanes(F.col("position"), F.col("role"), F.col("text")))})
    running = Window.partitionBy("conv_id", "part").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    rows = stored(rows.withColumns({f"h{i}": F.sum(f"h{i}").over(running) for i in range(4)}), "prefixes")

    # The last turn of a range holds its sum.
    ends = rows.groupBy("conv_id", "part").agg(*(F.max(f"h{i}").alias(f"s{i}") for i in range(4)))
    ends = ends.select("conv_id", "part", *(F.coalesce(F.sum(f"s{i}").over(before), F.lit(0)).alias(f"s{i}") for i in range(4)))
    joined = rows.join(ends, ["conv_id", "part"])
    return joined.select("conv_id", "position", "n_turns", "role", "text", *((F.col(f"h{i}") + F.col(f"s{i}")).alias(f"h{i}") for i in range(4)))


def maximal(turns: DataFrame) -> DataFrame:
    """conv_id, copies: one of each conversation that no longer one continues."""
    key = ["position", *(f"h{i}" for i in range(4))]
    last = F.col("position") == F.col("n_turns") - 1
    whole = turns.where(last).groupBy(key).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("copies"))
    prefixes = turns.where(~last).select(key).distinct()
    return whole.join(prefixes, key, "left_anti").select("conv_id", "copies")


def render(conversations: DataFrame) -> DataFrame:
    """conv_id, copies, n_turns, position, start, rendered: the turns of maximal conversations.

    The text of a conversation is its turns in order; ``start`` is where a turn
    begins in it, in characters.
    """
    turns = stored(numbered(conversations), "numbered")
    chosen = turns.join(stored(maximal(turns), "maximal"), "conv_id")
    rows = chosen.withColumn("rendered", segment(F.col("role"), F.col("text"))).withColumn("part", F.floor(F.col("position") / RANGE))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("conv_id", "part").agg(F.sum(F.length("rendered")).alias("n"))
    sizes = sizes.select("conv_id", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("conv_id", "part").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inner", F.coalesce(F.sum(F.length("rendered")).over(within), F.lit(0))).join(sizes, ["conv_id", "part"])
    return rows.select("conv_id", "copies", "n_turns", "position", (F.col("base") + F.col("inner")).alias("start"), "rendered")


SQL = f"""
WITH turns AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
placed AS (SELECT *, row_number() OVER w - 1 AS position, count(*) OVER (PARTITION BY conv_id) AS n_turns FROM turns
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
prefixes AS (SELECT *, list(struct_pack(role, text)) OVER (PARTITION BY conv_id ORDER BY position) AS prefix FROM placed),
whole AS (SELECT min(conv_id) AS conv_id, count(*) AS copies, prefix FROM prefixes WHERE position = n_turns - 1 GROUP BY prefix),
kept AS (SELECT conv_id, copies FROM whole WHERE prefix NOT IN (SELECT prefix FROM prefixes WHERE position < n_turns - 1)),
rendered AS (SELECT conv_id, copies, n_turns, position,
  '{OPEN}' || replace(role, '{OPEN}', '{PARTED}') || '|>' || chr(10) || replace(text, '{OPEN}', '{PARTED}') || chr(10) AS rendered FROM placed JOIN kept USING (conv_id))
SELECT conv_id, copies, n_turns, position, coalesce(sum(length(rendered)) OVER (PARTITION BY conv_id ORDER BY position
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start, rendered FROM rendered
"""
