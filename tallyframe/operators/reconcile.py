"""Two readings of one form, and readings against a known truth."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions import answers as A
from tallyframe.functions import recode
from tallyframe.operators.quality import MULTI_MARK

READ_KEYS = ("record_id", "page", "qid")
MISMATCH_NOTE = "the two independent reads differ"
# Flags of a known truth that a reading has to carry as well, and those a second
# reading may contribute.
REQUIRED_TRUTH_FLAGS = ("multi_mark_on_single_select",)
SECOND_READ_FLAGS = ("ambiguous_mark", "needs_review")


def _both_reads(reads: DataFrame, keys: Sequence[str]) -> DataFrame:
    """First and second read of each key side by side, from one aggregation instead of a self-join.

    reads: (keys..., read_no, entry VARIANT). Each key has two reads, so the group state is fixed. error names a
    read that is missing, or says that one is there more than once: which of them holds is not for us to choose.
    """
    pick = [
        F.max_by("entry", F.when(F.col("read_no") == number, 1)).alias(f"entry_{number}") for number in (1, 2)
    ]
    seen = [F.count_if(F.col("read_no") == number).alias(f"_seen_{number}") for number in (1, 2)]
    error = (
        F.when((F.col("_seen_1") > 1) | (F.col("_seen_2") > 1), "duplicate_read")
        .when(F.col("_seen_1") == 0, "read_1_missing").when(F.col("_seen_2") == 0, "read_2_missing")
    )
    return reads.groupBy(*keys).agg(*pick, *seen).withColumns({
        f"entry_{number}": F.when(F.col(f"_seen_{number}") == 1, F.col(f"entry_{number}")) for number in (1, 2)
    }).withColumn("error", error)


def _flags(entry: str) -> Column:
    return recode.flags_of(F.try_variant_get(entry, "$.flags", "array<string>"))


def double_read_merge(reads: DataFrame, keys: Sequence[str] = READ_KEYS) -> DataFrame:
    """Keep the first read; where the second differs ask for review and lower the confidence.

    error names the read that is missing or repeated; such a key has no match. Array order and reading metadata do not count as differences.
    """
    # A column of its own: it is worked out once, however often it is asked for.
    pair = _both_reads(reads, keys).withColumn("_match", A.values_equal("entry_1", "entry_2"))
    complete, match = F.col("error").isNull(), F.col("_match")
    differs = complete & ~match
    flags = recode.add_flag(_flags("entry_1"), recode.REVIEW_FLAG, differs)
    note = F.try_variant_get("entry_1", "$.note", "string")
    return pair.select(
        *keys,
        A.cell_join(F.col("entry_1")).alias("value"), F.col("entry_1").alias("entry"),
        F.when(differs, "low").otherwise(F.try_variant_get("entry_1", "$.confidence", "string")).alias("confidence"),
        flags.alias("flags"),
        F.when(differs, recode.note_concat(note, F.lit(MISMATCH_NOTE))).otherwise(note).alias("note"),
        recode.needs_review(flags).alias("needs_review"),
        F.when(complete, match).alias("reads_match"),
        "error",
    )


def single_read_pass(reads: DataFrame, keys: Sequence[str] = READ_KEYS) -> DataFrame:
    """One read only: needs_review follows from the flags."""
    return reads.select(
        *keys, A.cell_join(F.col("entry")).alias("value"), "entry",
        F.try_variant_get("entry", "$.confidence", "string").alias("confidence"), _flags("entry").alias("flags"),
        F.try_variant_get("entry", "$.note", "string").alias("note"), recode.needs_review(_flags("entry")).alias("needs_review"),
    )


def self_consistency_merge(reads: DataFrame, keys: Sequence[str] = READ_KEYS) -> DataFrame:
    """Multiple-choice variant: review signals of either read are kept, a mismatch gets its own flag, and
    the multi-mark flag must agree with the value that is kept. run1, run2 and match are for inspection. A key
    without exactly one of each read stays, with its error and without a match."""
    pair = _both_reads(reads, keys).withColumns({
        name: F.try_variant_get(entry, "$.value", "variant") for name, entry in (("_one", "entry_1"), ("_two", "entry_2"))
    })
    one, two = F.col("_one"), F.col("_two")
    match = A.values_equal("_one", "_two", ignore=())
    borrowed = F.array_intersect(_flags("entry_2"), F.array(*[F.lit(flag) for flag in SECOND_READ_FLAGS]))
    flags = recode.add_flag(F.array_union(_flags("entry_1"), borrowed), "self_consistency_mismatch", F.col("error").isNull() & ~match)
    several = F.coalesce(F.size(F.try_variant_get(one, "$", "array<variant>")) >= 2, F.lit(False))
    is_nested = A.is_object(one)
    flags = F.when(is_nested | several, flags).otherwise(recode.remove_flag(flags, MULTI_MARK))
    return pair.select(
        *keys, A.cell_join(F.col("entry_1")).alias("value"), flags.alias("flags"),
        F.to_json(one).alias("run1"), F.to_json(two).alias("run2"), F.when(F.col("error").isNull(), match).alias("match"), "error",
    )


def page_match_merge(reads: DataFrame) -> DataFrame:
    """A page is the expected one only if every read says so: (record_id, page, page_matches, flags)."""
    rows = reads.groupBy("record_id", "page").agg(F.coalesce(F.bool_and("page_matches"), F.lit(False)).alias("page_matches"))
    return rows.withColumn("flags", recode.add_flag(F.lit(None).cast("array<string>"), recode.REVIEW_FLAG, ~F.col("page_matches")))


def page_note_merge(reads: DataFrame) -> DataFrame:
    """(record_id, page, note) from the notes of both reads."""
    picks = [F.max(F.when(F.col("read_no") == number, F.col("page_note"))).alias(f"_n{number}") for number in (1, 2)]
    rows = reads.groupBy("record_id", "page").agg(*picks)
    return rows.select("record_id", "page", recode.page_note_merge("_n1", "_n2").alias("note"))


def answer_union(merged: DataFrame, required: Sequence[str]) -> DataFrame:
    """Pages merged into one record: (record_id, answers map, missing, unexpected).

    A record has at most as many answers as the contract has questions: repeats of a question are
    reduced before the map is built, and questions outside the contract are only counted.
    """
    wanted = F.array(*[F.lit(qid) for qid in required])
    one = merged.groupBy("record_id", "qid").agg(F.min(F.struct("page", "value")).alias("_first"), F.count(F.lit(1)).alias("_n"))
    known = F.array_contains(wanted, F.col("qid"))
    rows = one.groupBy("record_id").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.when(known, F.struct("qid", F.col("_first.value").alias("value")))))).alias("answers"),
        F.count_if(~known).alias("n_unexpected"), F.count_if(F.col("_n") > 1).alias("n_repeated"),
    )
    missing = F.array_except(wanted, F.map_keys("answers"))
    return rows.select("record_id", "answers", missing.alias("missing"), "n_unexpected", "n_repeated")


# ---- truth ----------------------------------------------------------------------------------------

def truth_normalise(truth: DataFrame) -> DataFrame:
    """Older nested truth entries to (record_id, qid, value VARIANT, flags, error).

    components {id: {value}} become {id: value}; grid rows {row: {value: []}} become {rows: {row: []}} with
    the remaining keys kept beside them. Only the flags a reading must reproduce are kept.
    """
    entry = F.col("entry")
    value = F.try_variant_get(entry, "$.value", "variant")
    components = F.try_variant_get(entry, "$.components", "map<string,variant>")
    rows = F.try_variant_get(F.coalesce(value, entry), "$.rows", "map<string,variant>")
    flat_components = F.to_variant_object(F.transform_values(components, lambda _, part: A.unwrap_value(part)))
    flat_rows = F.transform_values(rows, lambda _, part: A.unwrap_value(part))
    beside = F.map_filter(
        F.try_variant_get(F.coalesce(value, entry), "$", "map<string,variant>"),
        lambda key, _: ~key.isin("rows", "flags", "confidence", "note", "needs_review"),
    )
    grid = F.to_variant_object(F.map_concat(beside, F.create_map(F.lit("rows"), F.to_variant_object(flat_rows))))
    shaped = F.when(rows.isNotNull(), grid).when(value.isNotNull(), value).when(components.isNotNull(), flat_components)
    required = F.array_sort(F.array_intersect(_flags("entry"), F.array(*[F.lit(flag) for flag in REQUIRED_TRUTH_FLAGS])))
    return truth.select(
        "record_id", "qid", shaped.alias("value"), required.alias("flags"),
        F.when(~A.is_object(entry), "truth_not_object").when(shaped.isNull(), "truth_without_value").alias("error"),
    )


def field_selection(truth: DataFrame, extracted: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """(record_id, qid) to compare: the listed fields of every record on either side, or the union of both sides."""
    both = truth.select("record_id", "qid").union(extracted.select("record_id", "qid"))
    if fields is None:
        return both.distinct()
    listed = F.array(*[F.lit(name) for name in dict.fromkeys(fields)])
    return both.select("record_id").distinct().select("record_id", F.explode(listed).alias("qid"))


def truth_comparison(truth: DataFrame, extracted: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """Expected against actual per (record, question).

    Both sides: (record_id, qid, value VARIANT, flags array<string>). A missing side is an error, and a
    field with an error matches neither in value nor in flags.
    """
    left = truth.select("record_id", "qid", F.col("value").alias("_expected"), F.col("flags").alias("_required"), F.lit(True).alias("_in_truth"))
    right = extracted.select("record_id", "qid", F.col("value").alias("_actual"), F.col("flags").alias("_flags"), F.lit(True).alias("_in_extracted"))
    rows = left.join(right, ["record_id", "qid"], "full_outer")
    if fields is not None:
        rows = field_selection(truth, extracted, fields).join(rows, ["record_id", "qid"], "left")
    no_truth, no_extracted = F.col("_in_truth").isNull(), F.col("_in_extracted").isNull()
    errors = F.filter(
        F.array(F.when(no_truth, "missing_in_truth"), F.when(no_extracted, "missing_in_extracted")), lambda item: item.isNotNull()
    )
    missing = F.array_except(recode.flags_of("_required"), recode.flags_of("_flags"))
    clean = ~no_truth & ~no_extracted
    return rows.select(
        "record_id", "qid",
        (clean & A.values_equal("_expected", "_actual", ignore=())).alias("value_match"),
        (clean & (F.size(missing) == 0)).alias("flags_match"),
        F.when(clean, missing).otherwise(F.array().cast("array<string>")).alias("missing_flags"), errors.alias("errors"),
        F.to_json("_expected").alias("expected_value"), F.to_json("_actual").alias("actual_value"),
    )


def accuracy_summary(comparison: DataFrame) -> DataFrame:
    """Matched and compared fields per record, per question and overall, in one aggregation."""
    matched = F.col("value_match") & F.col("flags_match") & (F.size("errors") == 0)
    rows = comparison.select("record_id", "qid", matched.alias("_match"))
    sets = [["record_id"], ["qid"], []]
    table = rows.groupingSets(sets, "record_id", "qid").agg(
        F.grouping_id().alias("_gid"), F.count_if("_match").alias("matched"), F.count(F.lit(1)).alias("total")
    )
    level = F.when(F.col("_gid") == 1, "record").when(F.col("_gid") == 2, "question").otherwise("overall")
    return table.select(
        level.alias("level"), F.coalesce("record_id", "qid", F.lit("")).alias("name"), "matched", "total",
        (F.col("matched") / F.col("total")).alias("accuracy"),
    )
