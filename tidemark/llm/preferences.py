"""Preference formatting: one prompt and two masked completions per pair of conversations.

The turns of the chosen and the rejected conversation are compared place by place; the
longest common prefix is rendered once as the prompt. What follows in each is its
completion, and only what the assistant says there is to be learnt: its text and the end mark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

END = "<|end|>"
LEARNT = "assistant"


def numbered(turns: DataFrame) -> DataFrame:
    """(pair_id, place, role, text): turns in order, counted from 0.

    Null roles and texts count as empty. Of rows that share pair_id and turn the smallest
    (role, text) stands; rows without pair_id or turn are left out.
    """
    filled = turns.select(
        F.col("pair_id").cast("long").alias("pair_id"),
        F.col("turn").cast("long").alias("turn"),
        F.struct(
            F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
        ).alias("said"),
    ).filter("pair_id is not null and turn is not null")
    single = filled.groupBy("pair_id", "turn").agg(F.min("said").alias("said"))
    order = Window.partitionBy("pair_id").orderBy("turn")
    return single.select(
        "pair_id", (F.row_number().over(order) - 1).alias("place"), "said.role", "said.text"
    )


def format_pairs(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """One row per pair_id of either side.

    Both take pair_id, turn, role and text. Returns pair_id, shared (turns in the
    prompt), prompt, chosen, rejected, and per completion the character spans to learn
    (arrays of begin and end). Equal conversations are all prompt, with empty completions.
    Other columns are ignored.
    """
    a = numbered(chosen).select("pair_id", "place", F.struct("role", "text").alias("a"))
    b = numbered(rejected).select("pair_id", "place", F.struct("role", "text").alias("b"))
    both = a.join(b, ["pair_id", "place"], "full")
    differs = F.when(~F.col("a").eqNullSafe(F.col("b")), F.col("place"))
    pair = Window.partitionBy("pair_id")
    split = both.withColumn("common", F.min(differs).over(pair)).withColumn(
        "early", F.coalesce(F.col("place") < F.col("common"), F.lit(True))
    )

    def part(side: str, early: bool) -> tuple[Column, Column, Column]:
        said = F.col(side)
        head = F.concat(F.lit("<|"), said["role"], F.lit("|>\n"))
        body = F.concat(said["text"], F.lit(END))
        here = said.isNotNull() & (F.col("early") if early else ~F.col("early"))
        return (
            F.when(here, F.concat(head, body, F.lit("\n"))),
            F.length(head),
            F.when(here & (said["role"] == LEARNT), F.length(body)),
        )

    order = pair.orderBy("place")
    columns = [F.when(F.col("early"), 1).alias("kept")]
    for name, side, early in (("prompt", "a", True), ("chosen", "a", False), ("rejected", "b", False)):
        text, head, learnt = part(side, early)
        begin = F.sum(F.length(text)).over(order) - F.length(text) + head
        columns.append(F.when(text.isNotNull(), F.struct("place", text.alias("t"))).alias(name))
        if not early:
            span = F.struct(begin.alias("begin"), (begin + learnt).alias("end"))
            columns.append(F.when(learnt.isNotNull(), span).alias(f"{name}_spans"))
    rows = split.select("pair_id", *columns)

    def joined(name: str) -> Column:
        in_order = F.array_sort(F.collect_list(name))
        return F.array_join(F.transform(in_order, lambda x: x["t"]), "").alias(name)

    return rows.groupBy("pair_id").agg(
        F.count("kept").alias("shared"),
        joined("prompt"),
        joined("chosen"),
        joined("rejected"),
        F.array_sort(F.collect_list("chosen_spans")).alias("chosen_spans"),
        F.array_sort(F.collect_list("rejected_spans")).alias("rejected_spans"),
    )


def swapped_answers(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each conversation as chosen, and up to its last answer with another one as rejected.

    ``conversations`` has conv_id, turn, role and text. The other answer is the last one of
    the neighbour (conv_id with the lowest bit flipped); without one the conversation
    is its own rejected side. Pairs are named by conv_id.
    """
    turns = conversations.select(F.col("conv_id").alias("pair_id"), "turn", "role", "text")
    answer = F.when(
        F.col("role") == LEARNT, F.struct("turn", F.coalesce("text", F.lit("")).alias("text"))
    )
    last = turns.filter("pair_id is not null").groupBy("pair_id").agg(F.max(answer).alias("last"))
    last = last.filter("last.turn is not null").select("pair_id", "last.*")
    flipped = F.col("pair_id").bitwiseXOR(F.lit(1).cast("long"))
    other = last.select(flipped.alias("pair_id"), F.col("text").alias("other"))
    swap = last.select("pair_id", F.col("turn").alias("at")).join(other, "pair_id")
    kept = turns.join(swap, "pair_id", "left").filter("other is null or turn <= at")
    swapped = (F.col("turn") == F.col("at")) & F.col("other").isNotNull()
    rejected = kept.select(
        "pair_id",
        "turn",
        F.when(swapped, F.lit(LEARNT)).otherwise(F.col("role")).alias("role"),
        F.when(swapped, F.col("other")).otherwise(F.col("text")).alias("text"),
    )
    return turns, rejected


def spans_as_text(spans: Column) -> Column:
    """``begin-end`` per span, separated by commas."""
    each = F.transform(
        spans, lambda s: F.concat(s["begin"].cast("string"), F.lit("-"), s["end"].cast("string"))
    )
    return F.array_join(each, ",")


ORACLE = f"""
WITH turns AS (
  SELECT conv_id AS pair_id, turn, role, text FROM conversations
  WHERE conv_id IS NOT NULL AND turn IS NOT NULL
), answers AS (
  SELECT pair_id, max(turn) AS spot FROM turns WHERE role = '{LEARNT}' GROUP BY 1
), lasts AS (
  SELECT pair_id, spot, max(coalesce(text, '')) AS text
  FROM answers JOIN turns USING (pair_id) WHERE turn = spot AND role = '{LEARNT}' GROUP BY 1, 2
), swaps AS (
  SELECT l.pair_id, l.spot, o.text AS other FROM lasts l JOIN lasts o ON o.pair_id = xor(l.pair_id, 1)
), rejected AS (
  SELECT t.pair_id, turn, CASE WHEN turn = spot THEN '{LEARNT}' ELSE role END AS role,
         CASE WHEN turn = spot THEN other ELSE text END AS text
  FROM turns t LEFT JOIN swaps s ON s.pair_id = t.pair_id WHERE spot IS NULL OR turn <= spot
), a AS (
  SELECT pair_id, row_number() OVER (PARTITION BY pair_id ORDER BY turn) - 1 AS place, said AS a
  FROM (SELECT pair_id, turn, min({{'role': coalesce(role, ''), 'text': coalesce(text, '')}}) AS said
        FROM turns GROUP BY 1, 2)
), b AS (
  SELECT pair_id, row_number() OVER (PARTITION BY pair_id ORDER BY turn) - 1 AS place, said AS b
  FROM (SELECT pair_id, turn, min({{'role': coalesce(role, ''), 'text': coalesce(text, '')}}) AS said
        FROM rejected GROUP BY 1, 2)
), split AS (
  SELECT *, coalesce(place < min(CASE WHEN a IS DISTINCT FROM b THEN place END)
                     OVER (PARTITION BY pair_id), true) AS early
  FROM a FULL JOIN b USING (pair_id, place)
), said AS (
  SELECT pair_id, place, 'prompt' AS side, a.role AS role, a.text AS text
  FROM split WHERE early AND a IS NOT NULL
  UNION ALL SELECT pair_id, place, 'chosen', a.role, a.text FROM split
  WHERE NOT early AND a IS NOT NULL
  UNION ALL SELECT pair_id, place, 'rejected', b.role, b.text FROM split
  WHERE NOT early AND b IS NOT NULL
), rendered AS (
  SELECT *, '<|' || role || '|>' || chr(10) AS head, text || '{END}' AS body FROM said
), placed AS (
  SELECT *, head || body || chr(10) AS whole,
         sum(length(head) + length(body) + 1) OVER (PARTITION BY pair_id, side ORDER BY place)
           - length(body) - 1 AS first
  FROM rendered
)
SELECT pair_id, count(*) FILTER (side = 'prompt') AS shared,
       coalesce(string_agg(whole, '' ORDER BY place) FILTER (side = 'prompt'), '') AS prompt,
       coalesce(string_agg(whole, '' ORDER BY place) FILTER (side = 'chosen'), '') AS chosen,
       coalesce(string_agg(whole, '' ORDER BY place) FILTER (side = 'rejected'), '') AS rejected,
       coalesce(string_agg(first || '-' || (first + length(body)), ',' ORDER BY place)
                FILTER (side = 'chosen' AND role = '{LEARNT}'), '') AS chosen_spans,
       coalesce(string_agg(first || '-' || (first + length(body)), ',' ORDER BY place)
                FILTER (side = 'rejected' AND role = '{LEARNT}'), '') AS rejected_spans
FROM placed GROUP BY pair_id
"""
