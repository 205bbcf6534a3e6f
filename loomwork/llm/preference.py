"""Preference pairs from chosen and rejected conversations, in DataFrame operations only.

Both conversations of a pair become arrays of turns in one grouping; the longest
common prefix of turns is rendered once as the prompt, and what follows it in
each is a completion with the spans that a loss counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HEAD, HEAD_END, TAIL = "<|", "|>\n", "<|end|>\n"
#: The end mark's line break is not part of what an assistant says.
TRAINED_TAIL = "<|end|>"


def _rendered(turn: Column) -> Column:
    return F.concat(F.lit(HEAD), turn["role"], F.lit(HEAD_END), turn["text"], F.lit(TAIL))


def _joined(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _rendered), "")


def _spans(turns: Column) -> Column:
    """[start, end) of the assistant's words and end marks in the rendered turns, in code points."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"))

    def step(state: Column, turn: Column) -> Column:
        first = state["at"] + F.length(turn["role"]) + len(HEAD + HEAD_END)
        span = F.struct(first.cast("long").alias("start"), (first + F.length(turn["text"]) + len(TRAINED_TAIL)).cast("long").alias("end"))
        return F.struct(
            (state["at"] + F.length(_rendered(turn))).cast("long").alias("at"),
            F.when(turn["role"] == "assistant", F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"),
        )

    return F.aggregate(turns, start, step, lambda state: state["spans"])


def _sides(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(
            F.col("pair_id"),
            F.lit(name).alias("side"),
            F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).alias("said"),
        )

    return side(chosen, "chosen").unionByName(side(rejected, "rejected")).where("pair_id is not null")


def preference_pairs(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """pair_id, n_common, prompt, chosen, rejected, chosen_spans, rejected_spans of every pair_id.

    Both tables have (pair_id, turn, role, text).  Turns go by turn, then role,
    then text; a null turn comes first, a null role is "unknown", a null text
    empty.  n_common counts the turns in the prompt.  Equal conversations give
    empty completions; a side that a pair_id lacks is an empty conversation.  Rows
    without a pair_id have no pair and go.  Other columns are not read; empty
    tables give an empty result.  A pair is one row and its prompt one text, so a
    pair's turns meet in one task; no pair waits for another.
    """
    turns = _sides(chosen, rejected).groupBy("pair_id").agg(*[F.array_sort(F.collect_list(F.when(F.col("side") == s, F.col("said")))).alias(s) for s in ("chosen", "rejected")])
    said = lambda c: F.transform(c, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    turns = turns.select("pair_id", *[said(s).alias(s) for s in ("chosen", "rejected")])
    shorter = F.least(F.size("chosen"), F.size("rejected"))
    # Places of the shorter one where the two say different things.
    differ = F.filter(F.sequence(F.lit(0), shorter), lambda i: (i < shorter) & (F.get("chosen", i) != F.get("rejected", i)))
    turns = turns.withColumn("n_common", F.coalesce(F.get(differ, F.lit(0)), shorter))
    after = lambda s: F.slice(s, F.col("n_common") + 1, F.size(s))
    return turns.select(
        "pair_id",
        F.col("n_common").cast("long").alias("n_common"),
        _joined(F.slice("chosen", F.lit(1), F.col("n_common"))).alias("prompt"),
        *[_joined(after(s)).alias(s) for s in ("chosen", "rejected")],
        *[_spans(after(s)).alias(f"{s}_spans") for s in ("chosen", "rejected")],
    )


def parroting(conversations: DataFrame) -> DataFrame:
    """Rejected counterparts (conv_id, turn, role, text): the last assistant turn repeats what was said right before it.

    Conversations without an assistant's turn after another turn stay as they are.
    Rows without a conv_id are no conversation and go; null roles and texts stay
    null, and are ordered as preference_pairs() reads them.
    """
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("unknown")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    in_order = Window.partitionBy("conv_id").orderBy("turn", role, text)
    place = F.row_number().over(in_order)
    rows = conversations.where("conv_id is not null").select("conv_id", "turn", "role", "text").withColumn("place", place).withColumn("before", F.lag("text").over(in_order))
    last = F.max(F.when((F.col("role") == "assistant") & (F.col("place") > 1), F.col("place"))).over(Window.partitionBy("conv_id"))
    return rows.withColumn("last", last).select("conv_id", "turn", "role", F.when(F.col("place") == F.col("last"), F.col("before")).otherwise(F.col("text")).alias("text"))


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat(s["start"].cast("string"), F.lit("-"), s["end"].cast("string"))), ",")


SQL = """
WITH n AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, turn, role, text,
         row_number() OVER w AS place, lag(text) OVER w AS before
  FROM n WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), l AS (
  SELECT *, max(CASE WHEN role = 'assistant' AND place > 1 THEN place END) OVER (PARTITION BY conv_id) AS last FROM c
), t AS (
  SELECT conv_id, place, role, text AS good, CASE WHEN place = last THEN before ELSE text END AS bad FROM l
), p AS (
  SELECT conv_id, coalesce(min(CASE WHEN good <> bad THEN place END) - 1, count(*)) AS n_common FROM t GROUP BY conv_id
), r AS (
  SELECT t.*, n_common, place > n_common AS later,
         '<|' || role || '|>' || chr(10) || good || '<|end|>' || chr(10) AS good_text,
         '<|' || role || '|>' || chr(10) || bad || '<|end|>' || chr(10) AS bad_text
  FROM t JOIN p USING (conv_id)
), s AS (
  SELECT *,
         coalesce(sum(CASE WHEN later THEN length(good_text) END) OVER b, 0) + length(role) + 5 AS good_at,
         coalesce(sum(CASE WHEN later THEN length(bad_text) END) OVER b, 0) + length(role) + 5 AS bad_at
  FROM r WINDOW b AS (PARTITION BY conv_id ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
)
SELECT conv_id AS pair_id, CAST(max(n_common) AS BIGINT) AS n_common,
       coalesce(string_agg(good_text, '' ORDER BY place) FILTER (NOT later), '') AS prompt,
       coalesce(string_agg(good_text, '' ORDER BY place) FILTER (later), '') AS chosen,
       coalesce(string_agg(bad_text, '' ORDER BY place) FILTER (later), '') AS rejected,
       coalesce(string_agg(CAST(CAST(good_at AS BIGINT) AS VARCHAR) || '-' || CAST(CAST(good_at + length(good) + 7 AS BIGINT) AS VARCHAR), ',' ORDER BY place) FILTER (later AND role = 'assistant'), '') AS chosen_spans,
       coalesce(string_agg(CAST(CAST(bad_at AS BIGINT) AS VARCHAR) || '-' || CAST(CAST(bad_at + length(bad) + 7 AS BIGINT) AS VARCHAR), ',' ORDER BY place) FILTER (later AND role = 'assistant'), '') AS rejected_spans
FROM s GROUP BY conv_id
"""
