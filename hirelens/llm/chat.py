"""Chat formatting with cumulative-snapshot collapse, in DataFrame functions only.

Logs often hold the same conversation several times, each snapshot longer than the one before.  A conversation's turns
are numbered by (turn, role, text).  Its prefix of n turns has the hash sum over its first n turns of two independent
64-bit hashes of (place, role, text): a rolling sum, so all prefixes of a conversation cost one pass.
A conversation that equals a proper prefix of another is dropped by an anti-join on (n, hash); of
conversations equal throughout the one with the smallest conv_id stays.  The rest are rendered.

No conversation is collected whole: turns are numbered and summed in buckets of BUCKET turn numbers, and a few sums
per bucket carry both across buckets.  The rendering has one row for each bucket of BUCKET turns of a
conversation, in order; joined, the rows are its text.

Two conversations count as equal if both hash sums and the numbers of turns are: for n different prefixes some pair
agrees by chance with a probability of about n * n / 2 ** 129.

Edge cases: very long texts are hashed and rendered whole; turns without conv_id take no part; null role, text or turn count as empty, empty, and first; turns that
repeat are turns; missing turn numbers don't matter; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .runtime import staged

BUCKET = 256


PLACE = ["conv_id", "part", "by_role", "by_text"]


def _ahead(df: DataFrame, keys: list[str], *sums) -> DataFrame:
    """Sums over the earlier groups (by keys after the first) of the conversation: a few rows a conversation."""
    w = Window.partitionBy(keys[0]).orderBy(*keys[1:]).rowsBetween(Window.unboundedPreceding, -1)
    parts = df.groupBy(*keys).agg(*[s.alias(f"_{i}") for i, s in enumerate(sums)])
    return parts.select(*keys, *[F.coalesce(F.sum(f"_{i}").over(w), F.lit(0)).alias(f"before{i}") for i in range(len(sums))])


def placed_turns(conversations: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Every turn with its group (PLACE), its place within it, and two hashes of role and text: the one step that sorts texts.

    Groups are ranges of turn numbers; turns without a number, which all come first, are grouped by role and by how their
    text begins, so a conversation of such turns is not one group.
    """
    turn, blank = F.col("turn").cast("long"), F.lit("")
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.coalesce(turn, F.lit(-(1 << 62))).alias("turn"), F.coalesce(F.col("role").cast("string"), blank).alias("role"), F.coalesce(F.col("text").cast("string"), blank).alias("text"),
        turn.isNull().alias("unnumbered"),
    ).where(F.col("conv_id").isNotNull())
    groups = {"part": F.floor(F.col("turn") / bucket).cast("long"), "by_role": F.when(F.col("unnumbered"), F.col("role")).otherwise(blank), "by_text": F.when(F.col("unnumbered"), F.substring("text", 1, 8)).otherwise(blank)}
    hashes = {f"r{i}": F.xxhash64(F.lit(seed), "role", F.lit("\x00"), "text") for i, seed in ((1, 11), (2, 23))}
    own = Window.partitionBy(*PLACE).orderBy("turn", "role", "text")
    return turns.withColumns(groups).select(*PLACE, F.row_number().over(own).alias("within"), "role", "text", *[h.alias(n) for n, h in hashes.items()])


def prefixes(placed: DataFrame, ahead: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """conv_id, place (from 1) and h1, h2: the rolling hashes of the prefix that ends there.  No text is read."""
    narrow = placed.select(*PLACE, "within", "r1", "r2").join(ahead, PLACE).withColumn("place", F.col("within") + F.col("before0"))
    t = narrow.select("conv_id", "place", F.floor((F.col("place") - 1) / bucket).cast("long").alias("segment"), *[F.xxhash64("place", f"r{i}").cast("decimal(38,0)").alias(f"t{i}") for i in (1, 2)])
    rolling = Window.partitionBy("conv_id", "segment").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    sums = _ahead(t, ["conv_id", "segment"], F.sum("t1"), F.sum("t2"))
    return t.join(sums, ["conv_id", "segment"]).select("conv_id", "place", *[(F.sum(f"t{i}").over(rolling) + F.col(f"before{i - 1}")).alias(f"h{i}") for i in (1, 2)])


def maximal(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns and copies of the conversations that stay.  turns: as prefixes() gives them."""
    key = ["place", "h1", "h2"]
    ends = turns.groupBy("conv_id").agg(F.max("place").alias("place"))
    marks = turns.select("conv_id", *key).join(ends.withColumnRenamed("place", "last"), "conv_id")
    whole = marks.where(F.col("place") == F.col("last")).groupBy(*key).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("copies"))
    # A prefix that thousands of conversations share becomes one row before the shuffle.
    proper = marks.where(F.col("place") < F.col("last")).select(*key).distinct()
    return whole.join(proper, key, "left_anti").select("conv_id", F.col("place").alias("n_turns"), "copies")


def render(turn_start: str = "<|im_start|>", turn_end: str = "<|im_end|>"):
    """One turn as text; the marks occurring in a turn's own text or role are taken apart by a blank after '<'."""
    clean = lambda c: F.regexp_replace(c, r"<\|(im_start|im_end)\|>", "< |$1|>")
    return F.concat(F.lit(turn_start), clean("role"), F.lit("\n"), clean("text"), F.lit(f"{turn_end}\n"))


def format_chats(conversations: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """conv_id, segment (from 0), n_turns and copies of the conversation, and rendered: the segment's text.

    Texts go through one shuffle to be numbered and, those of kept conversations, through one to be joined; between them
    only hashes and places do.  Both stages are written, so nothing is worked out twice.
    """
    placed = staged(placed_turns(conversations, bucket), "turns")
    ahead = _ahead(placed, PLACE, F.count(F.lit(1)))
    kept = maximal(staged(prefixes(placed, ahead, bucket), "prefixes"))
    place = F.col("within") + F.col("before0")
    parts = (
        placed.join(ahead.join(kept, "conv_id"), PLACE)
        .select("conv_id", F.floor((place - 1) / bucket).cast("long").alias("segment"), place.alias("place"), "n_turns", "copies", render().alias("line"))
        .groupBy("conv_id", "segment")
        .agg(F.max("n_turns").alias("n_turns"), F.max("copies").alias("copies"), F.sort_array(F.collect_list(F.struct("place", "line"))).alias("lines"))  # at most `bucket` turns
    )
    return parts.select("conv_id", "segment", "n_turns", "copies", F.array_join(F.col("lines.line"), "").alias("rendered"))


ORACLE = rf"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), whole AS (
  SELECT conv_id, count(*) AS n, list(md5(role || chr(0) || text) ORDER BY place) AS turns FROM t GROUP BY conv_id
), prefixes AS (
  SELECT DISTINCT turns[1:k] AS p FROM (SELECT turns, unnest(range(1, n)) AS k FROM whole)
), kept AS (
  SELECT min(conv_id) AS conv_id, any_value(n) AS n_turns, count(*) AS copies
  FROM whole WHERE turns NOT IN (SELECT p FROM prefixes) GROUP BY turns
)
SELECT t.conv_id, CAST((place - 1) // {BUCKET} AS BIGINT) AS segment, any_value(n_turns) AS n_turns, any_value(copies) AS copies,
       string_agg('<|im_start|>' || regexp_replace(role, '<\|(im_start|im_end)\|>', '< |\1|>', 'g') || chr(10)
                  || regexp_replace(text, '<\|(im_start|im_end)\|>', '< |\1|>', 'g') || '<|im_end|>' || chr(10), '' ORDER BY place) AS rendered
FROM t JOIN kept USING (conv_id) GROUP BY t.conv_id, segment
"""
