"""Preference formatting: the longest common turn prefix of a chosen and a rejected conversation is the prompt,
rendered once; what follows it on either side is a completion in which only the assistant's turns carry loss."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm.common import settle, table
from tallyframe.llm.links import hot_join

#: How one turn is written.
HEAD, TAIL = "<|{role}|>\n", "\n<|end|>\n"
TRAINED = "assistant"
SIDES = ("prompt", "chosen", "rejected")


def merged_turns(turns: DataFrame, key: str) -> DataFrame:
    """One row for each (key, turn): its parts (role, text) in order of role and text. Rows without key or turn go,
    null roles and texts count as empty, repeated rows are one part."""
    part = F.struct(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = turns.where(F.col(key).isNotNull() & F.col("turn").isNotNull())
    return rows.groupBy(F.col(key).alias("pair_id"), "turn").agg(F.array_sort(F.collect_set(part)).alias("parts"))


def rendered(parts) -> F.Column:
    role = HEAD.split("{role}")
    return F.array_join(F.transform(parts, lambda p: F.concat(F.lit(role[0]), p["role"], F.lit(role[1]), p["text"], F.lit(TAIL))), "")


def preference_turns(chosen: DataFrame, rejected: DataFrame, key: str = "pair_id") -> DataFrame:
    """chosen, rejected (key, turn, role, text, ...) -> pair_id, side, turn, text, trained: the paired training
    samples in rendered turns. side `prompt` holds the turns before the first difference, once; `chosen` and
    `rejected` hold the rest. trained marks completion turns spoken by the assistant alone; the prompt and what
    users say in a completion carry no loss.

    Turns are compared by (pair, turn), and the rows of a pair with a large share of all turns scatter over salts to
    learn where its sides part, so no conversation is gathered in one task, however long. Rows with the
    same pair and turn are parts of one turn. A pair needs rows on both sides; equal sides are all prompt and give
    no completion. Other columns are ignored; empty tables give an empty result."""
    left = merged_turns(chosen, key).withColumnRenamed("parts", "good")
    right = merged_turns(rejected, key).withColumnRenamed("parts", "bad")
    both = left.join(right, ["pair_id", "turn"], "full")
    split = both.groupBy("pair_id").agg(
        F.min(F.when(~F.col("good").eqNullSafe(F.col("bad")), F.col("turn"))).alias("split"), F.count("good").alias("n_good"), F.count("bad").alias("n_bad"),
    ).where("n_good > 0 AND n_bad > 0")
    shared = F.col("split").isNull() | (F.col("turn") < F.col("split"))
    side = lambda name, parts, which: F.when(which & F.col(parts).isNotNull(), F.struct(F.lit(name).alias("side"), F.col(parts).alias("parts")))
    split = settle(split)
    sizes = split.select("pair_id", (F.col("n_good") + F.col("n_bad")).alias("size"))
    rows = hot_join(both, split.select("pair_id", "split"), ["pair_id"], sizes, "turn").select(
        "pair_id", "turn", F.explode(F.array(side("prompt", "good", shared), side("chosen", "good", ~shared), side("rejected", "bad", ~shared))).alias("s")
    ).where("s IS NOT NULL")
    trained = (F.col("s.side") != "prompt") & F.forall("s.parts", lambda p: p["role"] == TRAINED)
    return rows.select("pair_id", "s.side", "turn", rendered(F.col("s.parts")).alias("text"), trained.alias("trained"))


def preference_pairs(chosen: DataFrame, rejected: DataFrame, key: str = "pair_id") -> DataFrame:
    """The same as one row for each pair: prompt, chosen and rejected texts, and for either completion its mask: the
    spans (code points, end exclusive) that carry loss. For conversations that fit one training sample."""
    turn = F.struct("turn", "text", "trained")
    sides = preference_turns(chosen, rejected, key).groupBy("pair_id").agg(*(F.array_sort(F.collect_list(F.when(F.col("side") == name, turn))).alias(name) for name in SIDES))
    text = lambda name: F.array_join(F.transform(name, lambda t: t["text"]), "").alias(name)
    kind = "array<struct<start:int,end:int>>"

    def mask(name: str) -> F.Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("spans"))
        step = lambda done, t: F.struct(
            (done["at"] + F.length(t["text"])).alias("at"),
            F.when(t["trained"], F.concat(done["spans"], F.array(F.struct(done["at"].alias("start"), (done["at"] + F.length(t["text"])).alias("end")).cast("struct<start:int,end:int>")))).otherwise(done["spans"]).alias("spans"),
        )
        return F.aggregate(name, start, step, lambda done: done["spans"]).alias(f"{name}_mask")

    return sides.select("pair_id", text("prompt"), text("chosen"), text("rejected"), mask("chosen"), mask("rejected"))


def swapped_answers(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs out of plain conversations, every one with all its turns: chosen is the conversation, rejected the same with
    the assistant turn before the last one, an answer to another question, in the last one's place; where the assistant
    speaks once, an empty answer stands there; where it never speaks, both sides are equal and all is prompt. What
    follows the last answer follows it on both sides. Rows without conversation or turn go."""
    rows = conversations.where("conv_id IS NOT NULL AND turn IS NOT NULL").select("conv_id", "turn", "role", "text")
    answer = F.coalesce(F.col("role") == TRAINED, F.lit(False))
    known = settle(rows.groupBy("conv_id").agg(F.max(F.when(answer, F.col("turn"))).alias("last"), F.count(F.lit(1)).alias("size")))
    sizes = known.select("conv_id", "size")
    earlier = hot_join(rows.where(answer).select("conv_id", "turn"), known.select("conv_id", "last"), ["conv_id"], sizes, "turn").where("turn < last")
    marks = settle(known.join(earlier.groupBy("conv_id").agg(F.max("turn").alias("before")), "conv_id", "left").drop("size"))
    told = hot_join(rows, marks, ["conv_id"], sizes, "turn")
    pair, at_last = F.col("conv_id").alias("pair_id"), F.coalesce(answer & (F.col("turn") == F.col("last")), F.lit(False))
    chosen = rows.select(pair, "turn", "role", "text")
    moved = told.where(answer & (F.col("turn") == F.col("before"))).select(pair, F.col("last").alias("turn"), "role", "text")
    rest = told.where(~at_last | F.col("before").isNull()).select(pair, "turn", "role", F.when(at_last, F.lit("")).otherwise(F.col("text")).alias("text"))
    return chosen, rest.unionByName(moved)


def op6_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preference_turns(*swapped_answers(table(spark, sf_dir, "conversations")))


OP6_SQL = """
WITH c AS (SELECT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
a AS (SELECT conv_id, turn FROM c WHERE role = 'assistant'),
l AS (SELECT conv_id, max(turn) AS last FROM a GROUP BY conv_id),
b AS (SELECT a.conv_id, max(turn) AS before FROM a JOIN l USING (conv_id) WHERE turn < last GROUP BY 1),
t AS (SELECT c.conv_id, turn, role, text, last, before FROM c LEFT JOIN l USING (conv_id) LEFT JOIN b USING (conv_id)),
good AS (SELECT conv_id, turn, list_sort(list(DISTINCT struct_pack(role := coalesce(role, ''), text := coalesce(text, '')))) AS parts FROM t GROUP BY 1, 2),
r AS (SELECT conv_id, turn, role, text FROM t WHERE turn IS DISTINCT FROM last OR role IS DISTINCT FROM 'assistant'
  UNION ALL SELECT conv_id, last, role, text FROM t WHERE turn = before AND role = 'assistant'
  UNION ALL SELECT conv_id, turn, role, '' FROM t WHERE turn = last AND role = 'assistant' AND before IS NULL),
bad AS (SELECT conv_id, turn, list_sort(list(DISTINCT struct_pack(role := coalesce(role, ''), text := coalesce(text, '')))) AS parts FROM r GROUP BY 1, 2),
j AS (SELECT coalesce(good.conv_id, bad.conv_id) AS pair_id, coalesce(good.turn, bad.turn) AS turn, good.parts AS g, bad.parts AS b FROM good FULL JOIN bad ON good.conv_id = bad.conv_id AND good.turn = bad.turn),
s AS (SELECT pair_id, min(CASE WHEN g IS DISTINCT FROM b THEN turn END) AS split FROM j GROUP BY 1),
o AS (SELECT j.pair_id, 'prompt' AS side, turn, g AS parts FROM j JOIN s USING (pair_id) WHERE split IS NULL OR turn < split
  UNION ALL SELECT j.pair_id, 'chosen', turn, g FROM j JOIN s USING (pair_id) WHERE turn >= split AND g IS NOT NULL
  UNION ALL SELECT j.pair_id, 'rejected', turn, b FROM j JOIN s USING (pair_id) WHERE turn >= split AND b IS NOT NULL)
SELECT pair_id, side, turn, array_to_string(list_transform(parts, lambda p: concat('<|', p.role, '|>', chr(10), p.text, chr(10), '<|end|>', chr(10))), '') AS text,
  side <> 'prompt' AND len(list_filter(parts, lambda p: p.role <> 'assistant')) = 0 AS trained FROM o
"""

QUERIES = {"op6_preference": op6_preference}
ORACLES = {"op6_preference": OP6_SQL}
