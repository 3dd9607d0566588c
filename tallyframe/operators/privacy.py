"""Privacy projection and masking, plus the small filters around them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.sources.contract import Contract

# Typed tokens put in place of personal data found in free text.
MASK_PATTERNS = {
    "[EMAIL]": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "[PHONE]": r"\+?[0-9][0-9 ().-]{7,}[0-9]",
}

#: Shorter words of a name are too common to be masked on their own.
NAME_LETTERS = 3


def pii_projection(records: DataFrame, contract: Contract) -> DataFrame:
    """Documents without personal answers and without source images. The input is untouched."""
    fields = F.try_variant_get("document", "$", "map<string,variant>")
    answers = F.try_variant_get("document", "$.answers", "map<string,variant>")
    personal = contract.pii_fields
    safe_answers = F.map_filter(answers, lambda qid, _: ~qid.isin(*personal)) if personal else answers
    replaced = F.transform_values(
        F.map_filter(fields, lambda name, _: name != "source_images"),
        lambda name, value: F.when((name == "answers") & safe_answers.isNotNull(), F.to_variant_object(safe_answers)).otherwise(value),
    )
    return records.withColumn("document", F.to_variant_object(replaced))


def pii_mask_text(text: Column, patterns: Mapping[str, str] = MASK_PATTERNS) -> Column:
    """Personal data in free text replaced by typed tokens, whole text, in the given order."""
    for token, pattern in patterns.items():
        text = F.regexp_replace(text, pattern, token.replace("$", "\\$"))
    return text


def pii_hits(text: Column, patterns: Mapping[str, str] = MASK_PATTERNS) -> Column:
    """How many pieces each pattern found, for a finding: map<token, count>. Counted after the
    patterns before it have been masked, so nothing counts twice."""
    counts = []
    for token, pattern in patterns.items():
        counts += [F.lit(token), F.regexp_count(text, F.lit(pattern))]
        text = F.regexp_replace(text, pattern, token)
    return F.create_map(*counts)


def name_terms(names: Column, least: int = NAME_LETTERS) -> Column:
    """What to look for, longest first: each name, and its words of `least` letters or more. names: array<string>."""
    known = F.filter(F.transform(F.coalesce(names, F.array().cast("array<string>")), lambda name: F.trim(name)), lambda name: name.rlike(r"\p{L}"))
    words = F.filter(F.flatten(F.transform(known, lambda name: F.split(name, r"[^\p{L}\p{M}\p{N}]+"))), lambda word: (F.length(word) >= least) & word.rlike(r"\p{L}"))
    sized = F.transform(F.array_distinct(F.concat(known, words)), lambda term: F.struct((-F.length(term)).alias("order"), term.alias("term")))
    return F.transform(F.array_sort(sized), lambda item: item["term"])


def mask_names(text: Column, names: Column, least: int = NAME_LETTERS) -> Column:
    """[NAME] in place of the given names and their words, whole words in either case. One pattern a row, so a text is read
    once however many names it is searched for; null names leave it as it is."""
    terms = name_terms(names, least)
    literal = F.transform(terms, lambda term: F.concat(F.lit("\\Q"), F.replace(term, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E")))
    pattern = F.concat(F.lit(r"(?iu)(?<![\p{L}\p{M}\p{N}])(?:"), F.array_join(literal, "|"), F.lit(r")(?![\p{L}\p{M}\p{N}])"))
    return F.when(F.size(terms) > 0, F.regexp_replace(text, pattern, F.lit("[NAME]"))).otherwise(text)


def mask_record_names(entries: DataFrame, contract: Contract) -> DataFrame:
    """entries (record_id, qid, value, ...) without personal answers, and with each record's own names masked in the values of its
    other answers: a name is what a personal answer of the same record holds, if there is a letter in it. A record has at most as many
    as its contract has personal questions."""
    personal = list(contract.pii_fields)
    named = entries.where(F.col("qid").isin(*personal) & F.col("value").isNotNull()) if personal else entries.limit(0)
    names = named.groupBy("record_id").agg(F.collect_set("value").alias("_names"))
    others = entries.where(~F.col("qid").isin(*personal)) if personal else entries
    return others.join(names, "record_id", "left").withColumn("value", mask_names(pii_mask_text(F.col("value")), F.col("_names"))).drop("_names")


def complete_cases(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def record_subset(df: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows whose record_id is in wanted; repeated ids there do not repeat rows."""
    return df.join(wanted.select("record_id"), "record_id", "left_semi")


def unknown_ids(wanted: DataFrame, known: DataFrame) -> DataFrame:
    return wanted.select("record_id").distinct().join(known.select("record_id"), "record_id", "left_anti")


def review_filter(statuses: DataFrame, show: Sequence[str], search: str | None = None) -> DataFrame:
    """Records in the given states whose id contains the search text, ignoring case."""
    kept = statuses.filter(F.col("status").isin(*show))
    needle = (search or "").strip().lower()
    return kept.filter(F.contains(F.lower("record_id"), F.lit(needle))) if needle else kept


def redacted_diff(comparison: DataFrame, show: bool = False) -> DataFrame:
    """Differing fields; expected and actual only when asked for."""
    differing = comparison.filter(~(F.col("value_match") & F.col("flags_match")))
    return differing.withColumns({
        name: F.col(name) if show else F.lit(None).cast("string") for name in ("expected_value", "actual_value")
    })
