"""Preference data: chosen and rejected conversations with the turns they begin with rendered once.

DataFrame operations only. The common prefix of a pair is the longest run of turns, from the first on, that have the same role
and text in both. It is rendered once as the prompt; what follows in either conversation is its completion. Every rendered
turn is a row, so that no conversation, however long, has to be held by one task; ``assembled`` puts the rows of a
pair together where one text for each part is wanted.

A rendered turn is ``<|role|>`` and a line break, the text, and ``<|end|>`` with a line break. loss_from is the number of its
first characters that training must mask: the whole turn in a prompt and for any role but the assistant, else only
the header.

Defined cases: turns are compared null-safe, and a null role or text is rendered as empty. Of several rows with one turn
number the least role, then the least text counts, nulls first. Gaps in turn numbers count as they are: turns are
compared by number. Rows without pair or turn number cannot be placed and are left out. A conversation that is missing or a prefix
of the other has no completion rows; equal conversations give a prompt alone. Empty tables give an empty result. Other columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

ASSISTANT = "assistant"
END = "<|end|>\n"


def header(role: Column) -> Column:
    return F.concat(F.lit("<|"), F.coalesce(role, F.lit("")), F.lit("|>\n"))


def _turns(conversations: DataFrame, pair: str, side: str) -> DataFrame:
    """(pair_id, turn, side): one struct (role, text) for each turn."""
    rows = conversations.where(F.col(pair).isNotNull() & F.col("turn").isNotNull())
    # nulls come first in a struct's order
    return rows.groupBy(F.col(pair).alias("pair_id"), F.col("turn").cast("long").alias("turn")).agg(F.min(F.struct("role", "text")).alias(side))


def format_pairs(chosen: DataFrame, rejected: DataFrame, pair: str = "pair_id") -> DataFrame:
    """(pair_id, part, turn, role, rendered, loss_from) of two tables (pair, turn, role, text).

    part is prompt, chosen or rejected.
    """
    both = _turns(chosen, pair, "c").join(_turns(rejected, pair, "r"), ["pair_id", "turn"], "full")
    split = both.groupBy("pair_id").agg(F.min(F.when(~F.col("c").eqNullSafe(F.col("r")), F.col("turn"))).alias("differ"))
    placed = both.join(split, "pair_id")
    shared = F.col("differ").isNull() | (F.col("turn") < F.col("differ"))
    parts = F.when(shared, F.array(F.struct(F.lit("prompt").alias("part"), F.col("c").alias("t")))).otherwise(
        F.array(F.struct(F.lit("chosen").alias("part"), F.col("c").alias("t")), F.struct(F.lit("rejected").alias("part"), F.col("r").alias("t")))
    )
    rows = placed.select("pair_id", "turn", F.explode(parts).alias("p")).where("p.t is not null").select("pair_id", "p.part", "turn", "p.t.role", "p.t.text")
    rendered = F.concat(header(F.col("role")), F.coalesce("text", F.lit("")), F.lit(END))
    trained = (F.col("part") != "prompt") & (F.coalesce("role", F.lit("")) == ASSISTANT)
    loss = F.when(trained, F.length(header(F.col("role")))).otherwise(F.length("rendered"))
    return rows.withColumn("rendered", rendered).select("pair_id", "part", "turn", "role", "rendered", loss.cast("long").alias("loss_from"))


def assembled(parts: DataFrame) -> DataFrame:
    """(pair_id, prompt, chosen, rejected, chosen_masks, rejected_masks) of the rows of ``format_pairs``.

    A mask is an array of (n_masked, n_trained) characters for each turn in order. One row holds a whole pair, as a
    row of documents holds a whole text.
    """
    rows = parts.groupBy("pair_id", "part").agg(F.array_sort(F.collect_list(F.struct("turn", "rendered", "loss_from"))).alias("t"))
    text = F.array_join(F.transform("t", lambda t: t["rendered"]), "")
    masks = F.transform("t", lambda t: F.struct(t["loss_from"].alias("n_masked"), (F.length(t["rendered"]) - t["loss_from"]).alias("n_trained")))
    sides = rows.select("pair_id", "part", text.alias("text"), masks.alias("masks"))

    def of(part: str, column: str) -> Column:
        return F.max(F.when(F.col("part") == part, F.col(column)))

    texts = [F.coalesce(of(p, "text"), F.lit("")).alias(p) for p in ("prompt", "chosen", "rejected")]
    return sides.groupBy("pair_id").agg(*texts, *[F.first(F.when(F.col("part") == p, F.col("masks")), ignorenulls=True).alias(f"{p}_masks") for p in ("chosen", "rejected")])


def neighbours(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations 2k and 2k + 1 as the chosen and the rejected side of pair k, for tables without preferences."""
    rows = conversations.select(F.floor(F.col("conv_id") / 2).alias("pair_id"), F.pmod("conv_id", F.lit(2)).alias("side"), "turn", "role", "text")
    return rows.where("side = 0").drop("side"), rows.where("side = 1").drop("side")


#: The same rows from the conversations table by plain SQL.
SQL = """
WITH t AS (
  SELECT CAST(floor(conv_id / 2) AS BIGINT) AS pair_id, conv_id % 2 AS side, turn, min({'role': role, 'text': text}) AS m
  FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY 1, 2, 3),
both_ AS (
  SELECT coalesce(c.pair_id, r.pair_id) AS pair_id, coalesce(c.turn, r.turn) AS turn, c.m AS c, r.m AS r
  FROM (SELECT * FROM t WHERE side = 0) c FULL JOIN (SELECT * FROM t WHERE side = 1) r ON c.pair_id = r.pair_id AND c.turn = r.turn),
split AS (SELECT pair_id, min(turn) FILTER (WHERE c IS DISTINCT FROM r) AS differ FROM both_ GROUP BY 1),
placed AS (SELECT b.*, s.differ IS NULL OR b.turn < s.differ AS shared FROM both_ b JOIN split s USING (pair_id)),
rows_ AS (
  SELECT pair_id, 'prompt' AS part, turn, c AS m FROM placed WHERE shared
  UNION ALL SELECT pair_id, 'chosen', turn, c FROM placed WHERE NOT shared AND c IS NOT NULL
  UNION ALL SELECT pair_id, 'rejected', turn, r FROM placed WHERE NOT shared AND r IS NOT NULL),
shown AS (
  SELECT pair_id, part, turn, m.role AS role, '<|' || coalesce(m.role, '') || '|>' || chr(10) AS head, coalesce(m.text, '') || '<|end|>' || chr(10) AS body FROM rows_)
SELECT pair_id, part, turn, role, head || body AS rendered,
  CAST(CASE WHEN part <> 'prompt' AND role = 'assistant' THEN length(head) ELSE length(head) + length(body) END AS BIGINT) AS loss_from
FROM shown
"""
