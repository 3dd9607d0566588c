"""License scans by an exact set-similarity join: tokens in global frequency order, with prefix, length and
positional filters, find every block of a text that contains enough of a template."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm.common import table

WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWERED = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A block is BLOCK words and the next one starts STRIDE words on, so STRIDE words in a row lie in one block.
BLOCK, STRIDE = 64, 32


@dataclass(frozen=True)
class Template:
    """words in order; percent of its distinct words that a block must hold; in_order asks for consecutive words."""

    label: str
    words: tuple[str, ...]
    percent: int = 80
    in_order: bool = False

    @property
    def needed(self) -> int:
        return -(-self.percent * len(set(self.words)) // 100)


def phrase(label: str, text: str) -> Template:
    return Template(label, tuple(text.split()), 100, True)


def notice(label: str, text: str) -> Template:
    return Template(label, tuple(text.split()))


PHRASES = (phrase("cc-by", "cc by"), phrase("gpl", "general public license"), phrase("reserved", "all rights reserved"))
NOTICES = (
    notice("apache-2.0", "licensed under the apache license version 2 0"),
    notice("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy"),
    notice("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    notice("cc-by-nc", "licensed under cc by nc 4 0"),
    notice("cc-by-sa", "creative commons attribution sharealike license"),
    notice("cc0", "to the extent possible under law waived all copyright and related or neighboring rights"),
    notice("gpl-3.0", "licensed under the gnu general public license version 3"),
    notice("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    notice("mit", "released under the mit license"),
    notice("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    notice("mpl-2.0", "subject to the terms of the mozilla public license v 2 0"),
    notice("no-warranty", "the software is provided as is without warranty of any kind express or implied"),
)


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWERED), F.lit(WORD_PATTERN), F.lit(0))


def token_order(words: DataFrame, tokens: list[str]) -> list[str]:
    """The templates' tokens by their count in all texts, rarest first, then by name. Only as many rows as there
    are template tokens come back."""
    met = words.select(F.explode(F.filter("words", lambda w: w.isin(tokens))).alias("token")).groupBy("token").count()
    counts = {row.token: row["count"] for row in met.collect()}
    return sorted(tokens, key=lambda token: (counts.get(token, 0), token))


def template_matches(docs: DataFrame, templates: tuple[Template, ...] = (*PHRASES, *NOTICES)) -> DataFrame:
    """docs (doc_id, text, ...) -> row, doc_id, n_words, block, label, share, in_order, starts; every (block,
    template) with enough shared words, and one row without a label for a text that has none.

    Words are runs outside 00-2F, 3A-60 and 7B-7F after lower-casing A-Z; null counts as empty. Blocks of 64 words
    start every 32 words; templates are at most 32 words long. share is the part of the template's distinct words
    that the block holds; starts are the words (from 0) of the block's first half at which an in-order template
    stands word for word. Repeated rows stay apart by `row`; an empty table gives an empty result."""
    if any(len(t.words) > STRIDE for t in templates):
        raise ValueError(f"a template has more than {STRIDE} words")
    words = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", words_of(F.col("text")).alias("words"))
    order = token_order(words, sorted({w for t in templates for w in t.words}))
    rank = {token: at for at, token in enumerate(order)}
    index, probes = [], set()
    for number, t in enumerate(templates):
        tokens = sorted(set(t.words), key=rank.get)
        for at, token in enumerate(tokens[: len(tokens) - t.needed + 1]):
            probes.add(token)
            index.append((token, at, number, t.label, tokens, t.needed, t.in_order, list(t.words)))
    index = docs.sparkSession.createDataFrame(index, "token string, at int, template int, label string, tokens array<string>, needed int, in_order boolean, phrase array<string>")
    least = min(t.needed for t in templates)

    places = F.when(F.size("words") > 0, F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda at: F.get("words", at).isin(sorted(probes))))
    near = F.flatten(F.transform(places, lambda at: F.array((at / STRIDE).cast("int"), (at / STRIDE).cast("int") - 1)))
    ordered = F.array(*(F.lit(token) for token in order))
    block = lambda k: F.struct(
        k.alias("block"), F.array_intersect(ordered, F.slice("words", k * STRIDE + 1, BLOCK)).alias("held"), F.slice("words", k * STRIDE + 1, BLOCK).alias("own"),
    )
    blocks = words.select("row", "doc_id", "words", F.filter(F.array_distinct(near), lambda k: k >= 0).alias("near"))
    blocks = blocks.select("row", "doc_id", F.size("words").cast("long").alias("n_words"), F.transform("near", block).alias("blocks"))
    blocks = blocks.select("row", "doc_id", "n_words", F.explode_outer("blocks").alias("b")).select("row", "doc_id", "n_words", "b.*")
    probe = blocks.select("*", F.posexplode_outer(F.slice("held", 1, F.greatest(F.size("held") - least + 1, F.lit(0)))).alias("place", "token"))

    shared = F.array_intersect("held", "tokens")
    passes = (
        (probe.token == index.token)
        & (F.size("held") >= F.col("needed"))
        & (1 + F.least(F.size("held") - F.col("place"), F.size("tokens") - F.col("at")) - 1 >= F.col("needed"))
        & (F.get(shared, F.lit(0)) == index.token)
        & (F.size(shared) >= F.col("needed"))
    )
    found = probe.join(F.broadcast(index), passes, "left")
    starts = F.when(F.col("in_order"), F.filter(F.sequence(F.lit(0), F.lit(STRIDE - 1)), lambda at: F.slice("own", at + 1, F.size("phrase")) == F.col("phrase")))
    return found.select(
        "row", "doc_id", "n_words", "block", "label", (F.size(shared) / F.size("tokens")).alias("share"), "in_order",
        F.transform(starts, lambda at: (F.col("block") * STRIDE + at).cast("long")).alias("starts"),
    )


def scan_licenses(docs: DataFrame, phrases: tuple[Template, ...] = PHRASES, notices: tuple[Template, ...] = NOTICES) -> DataFrame:
    """One row for each text: n_words, the places of the phrases (n_base, first_word, last_word, base_labels), all
    labels, and score: the largest share of a template found, 0 without a label."""
    found = template_matches(docs, (*phrases, *notices))
    base = F.col("in_order") & (F.size("starts") > 0)
    labels = lambda which: F.array_join(F.array_sort(F.collect_set(F.when(which, F.col("label")))), ",")
    counted = base | (F.col("label").isNotNull() & ~F.col("in_order"))
    return found.groupBy("row", "doc_id", "n_words").agg(
        F.coalesce(F.sum(F.when(base, F.size("starts"))), F.lit(0)).cast("long").alias("n_base"),
        F.min(F.when(base, F.array_min("starts"))).alias("first_word"), F.max(F.when(base, F.array_max("starts"))).alias("last_word"),
        labels(base).alias("base_labels"), labels(counted).alias("labels"), F.coalesce(F.max(F.when(counted, F.col("share"))), F.lit(0.0)).alias("score"),
    ).drop("row")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


_WORDS = f"coalesce(regexp_extract_all(translate(text, '{UPPER}', '{LOWERED}'), '{WORD_PATTERN}'), [])"
_PHRASES = ", ".join(f"('{t.label}', {list(t.words)!r}, {len(t.words)})" for t in PHRASES)
_NOTICES = ", ".join(f"({number}, '{t.label}', {sorted(set(t.words))!r}, {t.needed})" for number, t in enumerate(NOTICES))
OP1_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
e AS (SELECT doc_id, unnest(w) AS token, unnest(range(0, len(w))) AS pos FROM d),
p(label, phrase, size) AS (VALUES {_PHRASES}),
b AS (SELECT e.doc_id, label, pos FROM e JOIN p ON e.token = phrase[1] JOIN d ON d.doc_id = e.doc_id WHERE d.w[pos + 1:pos + size] = phrase),
t(number, label, tokens, needed) AS (VALUES {_NOTICES}),
tt AS (SELECT number, label, needed, len(tokens) AS size, unnest(tokens) AS token FROM t),
m AS (SELECT doc_id, number, label, needed, size, e.token, unnest([pos // {STRIDE}, pos // {STRIDE} - 1]) AS block FROM e JOIN tt USING (token)),
f AS (SELECT doc_id, label, count(DISTINCT token) / size AS share FROM m WHERE block >= 0 GROUP BY doc_id, number, label, needed, size, block HAVING count(DISTINCT token) >= needed),
bb AS (SELECT doc_id, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM b GROUP BY doc_id),
l AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score FROM (SELECT doc_id, label, 1.0::DOUBLE AS share FROM b UNION ALL SELECT doc_id, label, share FROM f) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM d LEFT JOIN bb USING (doc_id) LEFT JOIN l USING (doc_id)
"""

QUERIES = {"op1_license_scan": op1_license_scan}
ORACLES = {"op1_license_scan": OP1_SQL}
