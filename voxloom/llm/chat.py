"""Chat formatting: collapse of logged snapshots, then rendering.

A conversation that grows is logged again and again, each time as a conversation of its own. One
that is a prefix of a longer one, or equal to one of a smaller id, adds nothing and goes. Every turn
gets a rolling hash of the turns up to it (the exclusive or of two 64-bit hashes of position, role
and text). A conversation stays unless its last hash is a hash inside another (anti-join); of equal
ones the smallest id stays. What stays is rendered with a chat template.

Scale: positions and hashes are computed in slices of ``SLICE`` turn numbers, and carried from slice
to slice by a window over one row per slice, so no task holds a whole long conversation. The sets
compared are distinct, so a conversation logged by a third of all ids is a single row. A rendered
conversation comes in one row per slice (nearly always one).

Turns are ordered by (turn, role, text), nulls first; repeated rows count once; null roles and
texts are empty, texts of any length are kept whole. Rows without ``conv_id`` belong to no
conversation and are left out. Further columns, whatever their names, are not read. An empty table
gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxloom.llm.components import written

SLICE = 512
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def turns(conversations: DataFrame, size: int = SLICE) -> DataFrame:
    """conv_id, slice, at (position from 1), role, text, h1, h2 (hashes of the turns up to here), n."""
    rows = conversations.filter("conv_id is not null").select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    rows = rows.withColumn("slice", F.floor(F.col("turn") / size))
    in_slice = Window.partitionBy("conv_id", "slice").orderBy("turn", "role", "text")
    placed = written(rows.withColumn("within", F.row_number().over(in_slice)), "turns")
    sizes = placed.groupBy("conv_id", "slice").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("conv_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("conv_id")
    offsets = sizes.select("conv_id", "slice", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"),
                           F.sum("rows").over(whole).alias("n"))

    def with_slice(left: DataFrame, right: DataFrame) -> DataFrame:
        right = right.withColumnRenamed("conv_id", "r_id").withColumnRenamed("slice", "r_slice")
        return left.join(right, (F.col("conv_id") == F.col("r_id")) & F.col("slice").eqNullSafe(F.col("r_slice"))).drop(
            "r_id", "r_slice")

    positioned = with_slice(placed, offsets).withColumn("at", F.col("offset") + F.col("within"))
    own = [F.xxhash64("at", "role", "text"), F.xxhash64("text", F.lit("|"), "role", "at")]
    running = in_slice.rowsBetween(Window.unboundedPreceding, 0)
    hashed = positioned.select("conv_id", "slice", "turn", "at", "role", "text", "n", own[0].alias("o1"), own[1].alias("o2"))
    per_slice = hashed.groupBy("conv_id", "slice").agg(F.bit_xor("o1").alias("s1"), F.bit_xor("o2").alias("s2"))
    carried = per_slice.select("conv_id", "slice", *[
        F.coalesce(F.bit_xor(f"s{i}").over(before), F.lit(0).cast("long")).alias(f"c{i}") for i in (1, 2)])
    rolled = with_slice(hashed, carried)
    return rolled.select("conv_id", "slice", "at", "role", "text", "n", *[
        F.col(f"c{i}").bitwiseXOR(F.bit_xor(f"o{i}").over(running)).alias(f"h{i}") for i in (1, 2)])


def maximal(rolled: DataFrame) -> DataFrame:
    """conv_id of the conversations that are no prefix of another one and of equal ones the first."""
    key = ["at", "h1", "h2"]
    prefixes = rolled.filter("at < n").select(*key).distinct()
    ends = rolled.filter("at = n").groupBy(*key).agg(F.min("conv_id").alias("conv_id"))
    return ends.join(prefixes, key, "left_anti").select("conv_id")


def render(conversations: DataFrame, size: int = SLICE) -> DataFrame:
    """conv_id, part, n_turns (of the part), text of every maximal conversation."""
    rolled = written(turns(conversations, size), "rolled")
    kept = rolled.join(maximal(rolled), "conv_id", "left_semi")
    turn = F.concat(F.lit(OPEN), "role", F.lit("\n"), "text", F.lit(f"{CLOSE}\n"))
    parts = kept.groupBy("conv_id", "slice").agg(
        F.count("*").alias("n_turns"), F.array_sort(F.collect_list(F.struct("at", turn.alias("turn")))).alias("turns"))
    part = F.row_number().over(Window.partitionBy("conv_id").orderBy("slice")) - 1
    return parts.select("conv_id", part.alias("part"), "n_turns", F.array_join("turns.turn", "").alias("text"))


SQL = f"""
WITH rows AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
placed AS (
  SELECT *, floor(turn / {SLICE}.0) AS slice,
    '{OPEN}' || role || chr(10) || text || '{CLOSE}' || chr(10) AS shown,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place,
    count(*) OVER (PARTITION BY conv_id) AS n
  FROM rows),
prefixes AS (
  SELECT conv_id, place, n, string_agg(length(role) || ':' || length(text) || ':' || role || text, ',') OVER (
    PARTITION BY conv_id ORDER BY place ROWS UNBOUNDED PRECEDING) AS prefix
  FROM placed),
kept AS (
  SELECT min(conv_id) AS conv_id FROM prefixes WHERE place = n
    AND prefix NOT IN (SELECT prefix FROM prefixes WHERE place < n)
  GROUP BY prefix)
SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY slice NULLS FIRST) - 1 AS INT) AS part,
  count(*) AS n_turns, string_agg(shown, '' ORDER BY place) AS text
FROM placed SEMI JOIN kept USING (conv_id) GROUP BY conv_id, slice
"""
