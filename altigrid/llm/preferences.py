"""Preference formatting in DataFrame functions only.

A pair holds a chosen and a rejected conversation, lists of turns. Their longest
common prefix of turns (equal role and text) is rendered once as the prompt; what
follows is rendered as two completions. A mask names the characters of a completion
that are trained on: the text and end mark of its assistant turns, as
"begin-end" ranges (end exclusive) joined by commas; all else is masked.

Turns stand in the order of (turn, role, text), nulls first; repeated rows are
turns each. Null role or text is rendered as empty and equals null only. Equal
conversations give two empty completions, a missing one an empty prompt. Rows
without a conv_id are conversations of one turn each. An empty table gives an empty
result; columns other than conv_id, turn, role and text are not read. One
conversation has to fit in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

END = "<|end|>\n"
_TURNS = "array<struct<turn:bigint,role:string,text:string>>"


def conversations(turns: DataFrame) -> DataFrame:
    """conv_id, solo (tells rows without conv_id apart), turns in order."""
    solo = F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id())
    turn = F.struct(F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    return turns.withColumn("solo", solo).groupBy("conv_id", "solo").agg(F.sort_array(F.collect_list(turn)).cast(_TURNS).alias("turns"))


def pairs_of(turns: DataFrame) -> DataFrame:
    """(pair_id, chosen, rejected) from rows (pair_id, side, turn, role, text); side is chosen or rejected."""
    turn = F.struct(F.col("turn").cast("long").alias("turn"), "role", "text")
    return turns.groupBy("pair_id").agg(
        *(F.sort_array(F.collect_list(F.when(F.col("side") == side, turn))).cast(_TURNS).alias(side) for side in ("chosen", "rejected"))
    )


def swapped_replies(turns: DataFrame) -> DataFrame:
    """Pairs for turns without any: against each conversation the same one whose last
    assistant turn says what the conversation with the next number says last (without it, if
    there is none)."""
    known = conversations(turns)
    said = F.try_element_at(F.filter("turns", lambda t: t.role == "assistant"), F.lit(-1))
    replies = known.where("conv_id IS NOT NULL").select(F.try_subtract("conv_id", F.lit(1)).alias("conv_id"), said.text.alias("reply"))
    last = F.array_max(F.transform("turns", lambda t, i: F.when(t.role == "assistant", i)))
    joined = known.join(replies, "conv_id", "left").withColumn("last", last)
    swapped = F.transform("turns", lambda t, i: F.when(i == F.col("last"), t.withField("text", F.col("reply"))).otherwise(t))
    rejected = F.when(F.col("last").isNull(), F.col("turns")).when(
        F.col("reply").isNull(), F.filter("turns", lambda t, i: i != F.col("last"))
    ).otherwise(swapped)
    return joined.select(F.col("conv_id").alias("pair_id"), F.col("turns").alias("chosen"), rejected.alias("rejected"))


def _rendered(turns: Column) -> Column:
    return F.transform(turns, lambda t: F.concat(F.lit("<|"), F.coalesce(t.role, F.lit("")), F.lit("|>\n"), F.coalesce(t.text, F.lit("")), F.lit(END)))


def _mask(turns: Column, parts: Column) -> Column:
    """Ranges of the assistant turns' text and end mark in the joined parts."""
    ends = F.transform(parts, lambda p, i: F.aggregate(F.slice(parts, F.lit(1), i + 1), F.lit(0), lambda a, x: a + F.length(x)))
    spans = F.zip_with(turns, ends, lambda t, e: F.when(
        t.role == "assistant", F.concat((e - F.length(F.coalesce(t.text, F.lit(""))) - len(END)).cast("string"), F.lit("-"), e.cast("string"))))
    return F.array_join(F.filter(spans, lambda s: s.isNotNull()), ",")


def format_pairs(pairs: DataFrame) -> DataFrame:
    """pair_id, prefix_turns, prompt, chosen, rejected, chosen_mask, rejected_mask."""
    same = F.zip_with("chosen", "rejected", lambda a, b: a.role.eqNullSafe(b.role) & a.text.eqNullSafe(b.text) & a.isNotNull() & b.isNotNull())
    first = F.array_position("same", False)
    whole = pairs.select(
        "pair_id", *(F.coalesce(c, F.array().cast(_TURNS)).alias(c) for c in ("chosen", "rejected"))
    ).withColumn("same", same).withColumn("prefix_turns", F.when(first == 0, F.size("chosen")).otherwise(first - 1).cast("int"))
    cut = whole.select(
        "pair_id", "prefix_turns", F.slice("chosen", F.lit(1), F.col("prefix_turns")).alias("prefix"),
        *(F.slice(c, F.col("prefix_turns") + 1, F.size(c) + 1).alias(c) for c in ("chosen", "rejected")),
    )
    parts = cut.withColumns({f"{c}_parts": _rendered(F.col(c)) for c in ("prefix", "chosen", "rejected")})
    return parts.select(
        "pair_id", "prefix_turns", F.array_join("prefix_parts", "").alias("prompt"),
        *(F.array_join(f"{c}_parts", "").alias(c) for c in ("chosen", "rejected")),
        *(_mask(F.col(c), F.col(f"{c}_parts")).alias(f"{c}_mask") for c in ("chosen", "rejected")),
    )


ORACLE = """
WITH c AS (
  SELECT conv_id, list({'turn': turn, 'role': role, 'text': text} ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS t
  FROM conversations GROUP BY conv_id
), l AS (
  SELECT conv_id, t, list_max(list_filter(range(1, len(t) + 1), lambda i: t[i].role = 'assistant')) AS last FROM c
), p AS (
  SELECT l.conv_id, l.t AS chosen,
    CASE WHEN l.last IS NULL THEN l.t
         WHEN n.last IS NULL OR n.t[n.last].text IS NULL THEN list_filter(l.t, lambda x, i: i <> l.last)
         ELSE list_transform(l.t, lambda x, i: {'turn': x.turn, 'role': x.role, 'text': CASE WHEN i = l.last THEN n.t[n.last].text ELSE x.text END}) END AS rejected
  FROM l LEFT JOIN l AS n ON n.conv_id = l.conv_id + 1
), k AS (
  SELECT *, CAST(coalesce(list_min(list_filter(range(1, greatest(len(chosen), len(rejected)) + 1), lambda i: i > len(chosen) OR i > len(rejected)
    OR chosen[i].role IS DISTINCT FROM rejected[i].role OR chosen[i].text IS DISTINCT FROM rejected[i].text)) - 1, len(chosen)) AS INTEGER) AS n
  FROM p
), r AS (
  SELECT conv_id, n, chosen[n + 1:] AS ct, rejected[n + 1:] AS rt,
    list_transform(chosen, lambda x: '<|' || coalesce(x.role, '') || '|>' || chr(10) || coalesce(x.text, '') || '<|end|>' || chr(10)) AS cp,
    list_transform(rejected, lambda x: '<|' || coalesce(x.role, '') || '|>' || chr(10) || coalesce(x.text, '') || '<|end|>' || chr(10)) AS rp
  FROM k
), s AS (
  SELECT conv_id, n, ct, rt, cp[:n] AS pp, cp[n + 1:] AS cp, rp[n + 1:] AS rp FROM r
)
SELECT conv_id, n AS prefix_turns, coalesce(array_to_string(pp, ''), '') AS prompt,
  coalesce(array_to_string(cp, ''), '') AS chosen, coalesce(array_to_string(rp, ''), '') AS rejected,
  coalesce(array_to_string(list_transform(list_filter(range(1, len(ct) + 1), lambda i: ct[i].role = 'assistant'),
    lambda i: CAST(list_sum(list_transform(cp[:i], lambda z: length(z))) - length(coalesce(ct[i].text, '')) - 8 AS BIGINT) || '-' || CAST(list_sum(list_transform(cp[:i], lambda z: length(z))) AS BIGINT)), ','), '') AS chosen_mask,
  coalesce(array_to_string(list_transform(list_filter(range(1, len(rt) + 1), lambda i: rt[i].role = 'assistant'),
    lambda i: CAST(list_sum(list_transform(rp[:i], lambda z: length(z))) - length(coalesce(rt[i].text, '')) - 8 AS BIGINT) || '-' || CAST(list_sum(list_transform(rp[:i], lambda z: length(z))) AS BIGINT)), ','), '') AS rejected_mask
FROM s
"""
