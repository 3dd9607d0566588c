"""Language ID against a plain version of the same rule, on letters, numerals and many languages."""

import math
import random

import brute
from pyspark.sql import functions as F

from tallyframe.llm import language


def test_fit_and_predict_equal_the_plain_version(spark):
    rng = random.Random(6)
    pools = {f"l{k}": ["".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) for _ in range(40)] for k, letters in enumerate(("abcde", "cdefé", "efgßa", "नमस्ते", "дома", "abxyz"))}
    train = [(" ".join(rng.choice(pool) for _ in range(rng.randint(1, 30))), lang) for lang, pool in pools.items() for _ in range(12)] + [(None, "l1"), ("", "l2"), ("12 ²", "l3"), ("lost", None)]
    asked = [" ".join(rng.choice(rng.choice(list(pools.values()))) for _ in range(rng.randint(1, 40))) for _ in range(60)]
    asked += [None, "", "² ½", "Ⅷ ① 12", "½ abc", "ZZZ", "a" * 5000, "e\u0301te\u0301", "\u0301 7", train[0][0], train[0][0]]
    labelled = spark.createDataFrame([(k, t, lang) for k, (t, lang) in enumerate(train)], "doc_id long, text string, lang string")
    docs = spark.createDataFrame([(k, t, "clash") for k, t in enumerate(asked)], "doc_id long, text string, lang_pred string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(docs, language.fit(labelled)).collect()}
    known = [(text, lang) for text, lang in train if text is not None and lang is not None]
    for k, (lang, score) in enumerate(brute.languages(known, asked)):
        assert got[k][0] == lang and math.isclose(got[k][1], score, rel_tol=1e-9), asked[k][:50]


def test_every_language_is_learned_however_rare(spark):
    """A language with three rows among thousands of another keeps all its words."""
    rows = spark.range(6000).select(F.col("id").alias("doc_id"), F.concat(F.lit("common words of "), F.col("id").cast("string")).alias("text"), F.lit("a").alias("lang"))
    rare = spark.createDataFrame([(9000 + k, f"seltenes{k} wort", "b") for k in range(3)], "doc_id long, text string, lang string")
    model = language.fit(rows.union(rare.select("doc_id", F.regexp_replace("text", "[0-9]", "x").alias("text"), "lang")), fit_rows=50)
    assert model.value.langs == ["a", "b"] and "seltenesx" in model.value.tables[0]
