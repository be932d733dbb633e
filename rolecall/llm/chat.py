"""Dialogues of several parties, rendered once from the side of every participant.

In a participant's rendering that speaker is the assistant and all others are users with
their names; system turns stay system turns and have no rendering of their own. The mask
marks what the assistant says: its texts and their end marks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rolecall.llm.common import written

END = "<|end|>\n"


def _plain(text: Column) -> Column:
    """Texts cannot hold control marks."""
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def placed(turns: DataFrame, key: str, order: list[str]) -> DataFrame:
    """`turns` with `position`, a row's place (from 0) among those of its `key` in this order.

    Rows are laid out by ranges of (key, order), however many a key has, so a place is that
    within the range plus the key's rows in the ranges before.
    """
    laid = turns.repartitionByRange(key, *order).sortWithinPartitions(key, *order)
    place = F.monotonically_increasing_id()
    laid = written(laid.withColumn("_range", F.shiftright(place, 33)).withColumn("_place", place))
    counts = laid.groupBy(F.col(key).alias("_key"), F.col("_range").alias("_own")).agg(
        F.count("*").alias("_rows"), F.min("_place").alias("_first")
    )
    before = F.sum("_rows").over(Window.partitionBy("_key").orderBy("_own").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.withColumn("_before", F.coalesce(before, F.lit(0)))
    both = laid.join(counts, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_range") == F.col("_own")))
    return both.withColumn("position", F.col("_before") + F.col("_place") - F.col("_first")).select(*turns.columns, "position")


def rotate(conversations: DataFrame, system: str = "system", turns_per_part: int = 512) -> DataFrame:
    """conv_id, speaker, part, text, mask for every participant of every dialogue.

    A dialogue (`conv_id`, `turn`, `role`, `text`) is ordered by turn, role, text, and rendered
    in parts of `turns_per_part` turns each, numbered from 0, so that no task holds an unbounded
    dialogue; its rendering is its parts' texts in their order. `mask` is an array of (start,
    end) in code points of the whole rendering, not of the part.

    Rows equal in all four columns are one turn. NULL role is `unknown`, NULL text is empty, a
    NULL turn comes first, NULL conv_ids are one dialogue. A dialogue of system turns alone
    has no rendering. No rows give none. Other columns are not read.
    """
    turns = conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).distinct()
    turns = placed(turns, "conv_id", ["turn", "role", "text"])
    parts = turns.groupBy("conv_id", F.floor(F.col("position") / turns_per_part).alias("part")).agg(
        F.array_sort(F.collect_list(F.struct("position", "role", "text"))).alias("turns")
    )
    speakers = turns.filter(F.col("role") != system).select(F.col("conv_id").alias("_conv"), F.col("role").alias("speaker")).distinct()
    both = parts.join(speakers, F.col("conv_id").eqNullSafe(F.col("_conv")))

    def piece(t: Column) -> Column:
        own = t["role"] == F.col("speaker")
        head = (
            F.when(t["role"] == system, F.lit("<|system|>\n"))
            .when(own, F.lit("<|assistant|>\n"))
            .otherwise(F.concat(F.lit("<|user "), F.regexp_replace(t["role"], r"[\x00-\x1f<>|]", "_"), F.lit("|>\n")))
        )
        body = F.concat(_plain(t["text"]), F.lit(END))
        return F.struct(head.alias("head"), body.alias("body"), own.alias("own"))

    def said(p: Column) -> Column:
        return F.char_length(p["head"]) + F.char_length(p["body"])

    # Ends of the part's turns; then only a row for each part meets in a window.
    zero = F.lit(0).cast("long")
    pieces = both.withColumn("pieces", F.transform("turns", piece))
    pieces = pieces.withColumn("length", F.aggregate("pieces", zero, lambda total, p: total + said(p)))
    lengths = pieces.select("_conv", "speaker", "part", "length")
    ahead = Window.partitionBy("_conv", "speaker").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    lengths = lengths.withColumn("start", F.coalesce(F.sum("length").over(ahead), zero)).filter("start > 0")
    lengths = lengths.select(*[F.col(c).alias(f"_{c.strip('_')}_") for c in ("_conv", "speaker", "part", "start")])
    same = F.col("conv_id").eqNullSafe(F.col("_conv_")) & (F.col("speaker") == F.col("_speaker_")) & (F.col("part") == F.col("_part_"))
    pieces = pieces.join(lengths, same, "left").withColumn("start", F.coalesce("_start_", zero))

    # Turns of the speaker: (end of the turn, its length behind the head), by a running sum over lengths.
    span = "array<struct<start:bigint,end:bigint>>"
    own = F.transform("pieces", lambda p: F.struct(said(p).alias("all"), F.when(p["own"], F.char_length(p["body"])).alias("body")))
    empty = F.struct(F.col("start").alias("at"), F.array().cast(span).alias("mask"))

    def step(acc: Column, p: Column) -> Column:
        end = acc["at"] + p["all"]
        mark = F.array(F.struct((end - p["body"]).alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(p["body"].isNotNull(), F.concat(acc["mask"], mark)).otherwise(acc["mask"]).alias("mask"))

    return pieces.select(
        "conv_id", "speaker", "part",
        F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"])), "").alias("text"),
        F.aggregate(own, empty, step, lambda acc: acc["mask"]).alias("mask"),
    )


ORACLE = """
WITH turns AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations),
numbered AS (
  SELECT *, (row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1) // 512 AS part FROM turns),
speakers AS (SELECT DISTINCT conv_id, role AS speaker FROM turns WHERE role <> 'system'),
pieces AS (
  SELECT t.conv_id, speaker, part, turn, role, text, role = speaker AS own,
    CASE WHEN role = 'system' THEN '<|system|>' WHEN role = speaker THEN '<|assistant|>'
      ELSE '<|user ' || regexp_replace(role, '[\\x00-\\x1f<>|]', '_', 'g') || '|>' END || chr(10) AS head,
    replace(text, '<|', '< |') || '<|end|>' || chr(10) AS body
  FROM numbered t JOIN speakers s ON t.conv_id IS NOT DISTINCT FROM s.conv_id),
placed AS (
  SELECT *, sum(length(head) + length(body)) OVER (
    PARTITION BY conv_id, speaker ORDER BY turn NULLS FIRST, role, text) AS stop FROM pieces)
SELECT conv_id, speaker, part, string_agg(head || body, '' ORDER BY turn NULLS FIRST, role, text) AS text,
  coalesce(string_agg(CASE WHEN own THEN CAST(CAST(stop - length(body) AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(stop AS BIGINT) AS VARCHAR) END,
    ',' ORDER BY turn NULLS FIRST, role, text), '') AS mask
FROM placed GROUP BY conv_id, speaker, part
"""
