"""Chat formatting after cumulative-snapshot collapse (operator 6, DataFrame functions only).

Logs often hold the same conversation several times, each longer than the one before. Turns
are numbered within their conversation; every prefix has a rolling hash (sums of hashes of
number, role and text, 128 bits). A conversation whose whole hash is that of a proper prefix
of another one, or of an equal one with a smaller id, is dropped by anti-joins; the maximal
ones are rendered as ChatML in parts of ``PART_TURNS`` turns, of which a very long
conversation has several (its text is theirs in turn).

Rows are sorted by ranges of conversation, turn, role and text, and numbered by stretches of
sorted rows with the counts of the stretches before, so that one enormous conversation is in no
single task or window, whatever its turn numbers are.

Nulls and edge cases: a null role or text differs from an empty one in the hash and renders
as empty; null turns come first; equal turn numbers are ordered by role and text; repeated
rows are turns of their own; turns with a null conv_id are one conversation; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martwright.llm.common import stored

PART_TURNS = 512
STRETCH_BITS = 9  # sorted rows of a stretch: 2 ** 9
_KEY = ["conv", "has_id"]


def numbered(conversations: DataFrame) -> DataFrame:
    """(conv, has_id, role, text, pos, h1, h2): turns numbered from 1, with their prefix hashes."""
    rows = conversations.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("conv"),
        F.col("conv_id").isNotNull().alias("has_id"), "turn", "role", "text")
    place = [F.col(c).asc_nulls_first() for c in (*_KEY, "turn", "role")]
    # rows of one beginning of a text stay in one range, where whole texts order them
    begin = F.substring("text", 1, 64).asc_nulls_first()
    lines = (rows.repartitionByRange(*place, begin)
             .sortWithinPartitions(*place, F.col("text").asc_nulls_first())
             .withColumn("nth", F.monotonically_increasing_id()))
    # numbers are consecutive within a range, so also within a stretch of one
    lines = stored(lines, "sorted-turns").withColumn("stretch", F.shiftright("nth", STRETCH_BITS))

    def before(of: Column, name: str) -> Column:
        """Sum over the stretches before."""
        w = Window.partitionBy(*_KEY).orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(of).over(w), F.lit(0)).alias(name)

    counts = (lines.groupBy(*_KEY, "stretch").agg(F.count("*").alias("n"), F.min("nth").alias("first"))
              .select(*_KEY, "stretch", "first", before(F.col("n"), "base")))
    placed = (lines.join(counts, [*_KEY, "stretch"])
              .withColumn("pos", F.col("base") + F.col("nth") - F.col("first") + 1)
              .drop("base", "nth", "first", "turn"))

    def hashed(seed: int) -> Column:
        return F.xxhash64(F.lit(seed), "pos", F.col("role").isNull(), "role", F.col("text").isNull(), "text")

    # decimal sums can't overflow; the hash is what is left modulo 2 ** 64
    whole = "decimal(38,0)"
    placed = placed.withColumns({"t1": hashed(1).cast(whole), "t2": hashed(2).cast(whole)})
    upto = Window.partitionBy(*_KEY, "stretch").orderBy("pos")
    sums = (placed.groupBy(*_KEY, "stretch").agg(F.sum("t1").alias("s1"), F.sum("t2").alias("s2"))
            .select(*_KEY, "stretch", before(F.col("s1"), "b1"), before(F.col("s2"), "b2")))

    def rolled(of: str, base: str) -> Column:
        return (F.sum(of).over(upto) + F.col(base)).cast(whole)

    return placed.join(sums, [*_KEY, "stretch"]).select(
        *_KEY, "role", "text", "pos", rolled("t1", "b1").alias("h1"), rolled("t2", "b2").alias("h2"))


def maximal(turns: DataFrame) -> DataFrame:
    """(conv, has_id, n_turns, n_copies): conversations that are no prefix of another one."""
    last = F.max(F.struct("pos", "h1", "h2"))
    whole = (turns.groupBy(*_KEY).agg(last.alias("x"))
             .select(*_KEY, F.col("x.pos").alias("pos"), F.col("x.h1").alias("h1"), F.col("x.h2").alias("h2")))
    # equal conversations: the smallest id stands for all
    ends = (whole.groupBy("pos", "h1", "h2")
            .agg(F.min(F.struct((~F.col("has_id")).alias("z"), F.col("conv"))).alias("x"),
                 F.count("*").alias("n_copies"))
            .select("pos", "h1", "h2", F.col("x.conv").alias("conv"), (~F.col("x.z")).alias("has_id"),
                    "n_copies"))
    # proper prefixes: turns that are not the last of their conversation
    inner = (turns.join(whole.select(*_KEY, F.col("pos").alias("last")), _KEY)
             .where(F.col("pos") < F.col("last")).select("pos", "h1", "h2").distinct())
    return ends.join(inner, ["pos", "h1", "h2"], "left_anti").select(
        *_KEY, F.col("pos").alias("n_turns"), "n_copies")


def render(turns: DataFrame, kept: DataFrame) -> DataFrame:
    """(conv_id, part, n_turns, n_copies, text): the conversations in ChatML."""
    line = F.concat(F.lit("<|im_start|>"), F.coalesce("role", F.lit("")), F.lit("\n"),
                    F.coalesce("text", F.lit("")), F.lit("<|im_end|>\n"))
    part = F.floor((F.col("pos") - 1) / PART_TURNS)
    texts = F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"])
    return (turns.join(kept, _KEY).withColumns({"part": part, "line": line})
            .groupBy(*_KEY, "part", "n_turns", "n_copies").agg(F.concat_ws("", texts).alias("text"))
            .select(F.when(F.col("has_id"), F.col("conv")).alias("conv_id"), "part", "n_turns",
                    "n_copies", "text"))


def run(conversations: DataFrame) -> DataFrame:
    turns = stored(numbered(conversations), "prefixes")
    return render(turns, maximal(turns))


SQL = """
WITH t AS (
  SELECT conv_id, role, text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS pos
  FROM conversations),
c AS (
  SELECT conv_id, count(*) AS n_turns, list({'r': role, 't': text} ORDER BY pos) AS l,
         string_agg('<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '')
                    || '<|im_end|>' || chr(10), '' ORDER BY pos) AS text
  FROM t GROUP BY conv_id),
e AS (SELECT min(conv_id) AS conv_id, count(*) AS n_copies, any_value(n_turns) AS n_turns, l,
             any_value(text) AS text FROM c GROUP BY l),
p AS (SELECT DISTINCT l[1:k] AS l FROM (SELECT l, unnest(range(1, n_turns)) AS k FROM e))
SELECT conv_id, CAST(0 AS BIGINT) AS part, n_turns, n_copies, text FROM e WHERE l NOT IN (SELECT l FROM p)
"""
