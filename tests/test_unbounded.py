"""No depth, size or work limit changes a result."""

from fractions import Fraction
from itertools import combinations
from math import comb

import numpy as np
import pytest
from frames import rows
from pyspark.sql import functions as F

from tallyframe.functions import answers as A
from tallyframe.functions import pvalues
from tallyframe.operators import flatten, quality, reconcile, structure
from tallyframe.sources.contract import Contract


def parsed(spark, texts, schema="record_id string, text string"):
    return spark.createDataFrame(texts, schema).withColumn("document", F.parse_json("text"))


def nested_value(depth, items):
    text = items
    for level in range(depth):
        text = f'{{"n{level}":{text},"flags":["x"]}}'
    return text


@pytest.mark.parametrize("depth", [0, 1, 4, 40])
def test_array_order_does_not_count_at_any_depth(spark, depth):
    df = spark.createDataFrame([(nested_value(depth, "[1,[2,3]]"), nested_value(depth, "[[3.0,2],1]"), nested_value(depth, "[1,2,3]"))], "a string, b string, c string")
    df = df.select(*[F.parse_json(name).alias(name) for name in "abc"])
    assert rows(df.select(A.values_equal("a", "b").alias("same"), A.values_equal("a", "c").alias("other"))) == [{"same": True, "other": False}]


def test_kinds_and_missing_stay_apart(spark):
    texts = ["null", "[]", "1", '"1"', "true", '"true"', "{}", None]
    pairs = [(i, j, a, b) for (i, a), (j, b) in combinations(enumerate(texts), 2)]
    df = spark.createDataFrame(pairs, "i int, j int, a string, b string").select("i", "j", F.parse_json("a").alias("a"), F.parse_json("b").alias("b"))
    assert df.where(A.values_equal("a", "b")).count() == 0


def test_nested_entries_four_levels_deep(spark):
    deep = '{"answers":{"q":{"components":{"c":{"rows":{"r":{"subfield":{"s":{"derived_subfield":{"d":{"value":"x","needs_review":true}}}}}}}}}}}'
    long = flatten.answers_long(parsed(spark, [("R1", deep), ("R2", '{"answers":{"q":{"value":1}}}')]))
    assert [row["path"] for row in rows(long.where("record_id = 'R1'").select("path"), "path")] == [
        "q", "q.components.c", "q.components.c.rows.r", "q.components.c.rows.r.subfield.s", "q.components.c.rows.r.subfield.s.derived_subfield.d",
    ]
    counts = quality.needs_review_count(flatten.entry_parts(long), nested=True)
    assert {row["record_id"]: row["n_needs_review"] for row in counts.collect()}["R1"] == 1


def test_missing_and_repeated_reads_keep_their_key(spark):
    reads = spark.createDataFrame(
        [("a", 1, "q", 1, "1"), ("a", 1, "q", 2, "1"), ("b", 1, "q", 1, "1"), ("c", 1, "q", 2, "1"), ("d", 1, "q", 1, "1"), ("d", 1, "q", 1, "2"), ("d", 1, "q", 2, "1")],
        "record_id string, page int, qid string, read_no int, body string",
    ).select("record_id", "page", "qid", "read_no", F.parse_json(F.concat(F.lit('{"value":'), "body", F.lit("}"))).alias("entry"))
    want = [("a", None), ("b", "read_2_missing"), ("c", "read_1_missing"), ("d", "duplicate_read")]
    for merge, match in ((reconcile.double_read_merge, "reads_match"), (reconcile.self_consistency_merge, "match")):
        got = rows(merge(reads), "record_id")
        assert [(row["record_id"], row["error"]) for row in got] == want
        assert [row[match] for row in got] == [True, None, None, None]


def exact_by_counting(u, n1, n2):
    ways = {}
    for ranks in combinations(range(1, n1 + n2 + 1), n1):
        value = sum(ranks) - n1 * (n1 + 1) // 2
        ways[value] = ways.get(value, 0) + 1
    tail = sum(n for value, n in ways.items() if value >= max(u, n1 * n2 - u))
    return min(Fraction(1), Fraction(2 * tail, comb(n1 + n2, n1)))


@pytest.mark.parametrize(("n1", "n2"), [(1, 1), (1, 6), (2, 5), (3, 3), (4, 6), (5, 5)])
def test_exact_p_equals_counting(n1, n2):
    for u in range(n1 * n2 + 1):
        assert pvalues.mann_whitney_exact(u, n1, n2) == pytest.approx(float(exact_by_counting(u, n1, n2)))


def test_exact_p_has_no_work_limit():
    small, large = pvalues.mann_whitney_two_sided(0, 8, 30_000, 0), pvalues.mann_whitney_two_sided(0, 8, 3_000_000, 0)
    assert 0 < large < small < 1e-30
    assert pvalues.mann_whitney_two_sided(0, 8, 3_000_000, 0, method="normal") > 1e-10


def test_varimax_reaches_the_criterion(spark):
    rng = np.random.default_rng(3)
    simple = np.kron(np.eye(3), np.ones((4, 1))) * 0.8 + rng.normal(0, 0.02, (12, 3))
    turn = np.linalg.qr(rng.normal(size=(3, 3)))[0]
    found = structure._varimax(simple @ turn)
    spread = lambda m: (m**4).sum() - ((m**2).sum(axis=0) ** 2).sum() / len(m)
    assert spread(found) >= spread(simple) - 1e-9
    assert np.allclose(found @ found.T, simple @ simple.T)
    for angle in (-0.01, 0.01):
        c, s = np.cos(angle), np.sin(angle)
        assert spread(found @ np.array([[c, -s, 0], [s, c, 0], [0, 0, 1]])) <= spread(found) + 1e-12


def test_spelling_takes_the_code_alone(spark):
    from tallyframe.functions.recode import spelling_normalise

    df = spark.createDataFrame([("kinh",), ("KINH",), (" H'Mong ",)], "x string")
    assert [row["y"] for row in df.select(spelling_normalise("x").alias("y")).collect()] == ["Kinh", "KINH", "Mông"]


def test_boundaries_are_a_fixed_size_sketch_and_ranks_stay_exact(spark):
    from tallyframe.operators import ranks

    values = spark.range(5_000).select(F.lit("k").alias("k"), (F.col("id") * 7 % 5_000).cast("double").alias("x"), F.lit(2).alias("n"))
    for buckets in (2, 7, 64):
        got = ranks.midranks(values, ["k"], "x", buckets=buckets)
        assert got.where("midrank <> 2 * x + 1.5").count() == 0 and got.count() == 5_000


def test_a_value_that_fills_a_pair_scatters(spark):
    from tallyframe.operators import ranks

    pairs = 2_000
    rows_ = spark.range(pairs * 3).select((F.col("id") % pairs).alias("pair"), F.when(F.col("id") % pairs == 5, 1.0).otherwise(F.col("id") * 1.0).alias("x"), F.col("id").alias("other"))
    rows_ = rows_.unionByName(spark.range(3_000).select(F.lit(5).cast("long").alias("pair"), F.lit(1.0).alias("x"), F.col("id").alias("other")))
    counts = rows_.groupBy("pair", "x").agg(F.count(F.lit(1)).alias("n"))
    joined = ranks.join_ranks(rows_, ranks.midranks(counts, ["pair"], "x", bound_keys=[]), counts, ["pair"], "x", spread="other")
    assert joined.where("midrank IS NULL").count() == 0 and joined.count() == pairs * 3 + 3_000
    assert {row["midrank"] for row in joined.where("pair = 5").collect()} == {(3_003 + 1) / 2}


def test_one_group_with_most_values(spark):
    from tallyframe.operators import crosstab

    df = spark.range(9_000).select(F.when(F.col("id") % 10 > 0, "big").otherwise(F.concat(F.lit("g"), F.col("id") % 30)).alias("g"), F.concat(F.lit("v"), F.col("id")).alias("v"))
    got = crosstab.crosstab(df, "v", "g")
    assert got.count() == 9_000 and got.agg(F.sum("percent")).first()[0] == pytest.approx(df.select("g").distinct().count())
    assert {row["valid_n"] for row in got.where("group = 'big'").select("valid_n").distinct().collect()} == {8_100}


def test_strict_payloads(spark):
    from tallyframe.operators.payloads import strict_findings
    from tallyframe.sources.contract import Contract

    contract = Contract({"questions": [
        {"id": "t", "page": 1, "type": "text", "subfield": {"id": "s"}},
        {"id": "one", "page": 1, "type": "single_select", "options": [{"code": "a", "other_text": True}, {"code": "b"}]},
        {"id": "many", "page": 1, "type": "multi_select", "options": [{"code": "a"}, {"code": "b"}]},
        {"id": "c", "page": 1, "type": "composite", "components": [{"id": "x", "type": "single_select", "options": [{"code": "yes"}]}]},
        {"id": "g", "page": 1, "type": "device_grid", "rows": [{"code": "r1"}, {"code": "r2"}], "columns": [{"code": "k"}], "extra_option": {"code": "none"}},
    ]})
    good = '{"t":{"value":"x","subfield":{"s":{"value":null}}},"one":{"value":["a","b"],"other_text":"o"},"many":{"value":[],"flags":["f"]},"c":{"components":{"x":{"value":"yes"}}},"g":{"rows":{"r1":{"value":["k"]},"r2":{"value":null}},"none":false}}'
    bad = '{"t":{"value":1,"subfield":7},"one":{"value":{"a":1},"odd":1,"other_text":null},"many":{"value":"a"},"c":{"components":{"x":{"value":"no"},"y":{}}},"g":{"rows":{"r1":{"value":["k","z"]}},"none":"no"},"extra":{}}'
    got = strict_findings(parsed(spark, [("ok", f'{{"answers":{good}}}'), ("bad", f'{{"answers":{bad}}}'), ("none", "{}")]), contract)
    assert [row for row in rows(got) if row["record_id"] == "ok"] == []
    assert {row["qid"] for row in rows(got.where("record_id = 'none' AND rule = 'missing_question'"))} == {"t", "one", "many", "c", "g"}
    assert {(row["qid"], row["rule"], row["detail"]) for row in rows(got) if row["record_id"] == "bad"} == {
        ("extra", "unexpected_question", ""), ("t", "wrong_shape", "value"), ("t", "not_an_object", "subfield"), ("one", "wrong_shape", "value"), ("one", "unexpected_member", "odd"),
        ("many", "wrong_shape", "value"), ("c", "unexpected_member", "components.y"), ("c", "invalid_option_code", "components.x.value:no"),
        ("g", "missing_member", "rows.r2"), ("g", "invalid_option_code", "rows.r1.value:z"), ("g", "wrong_shape", "none"),
    }
    needs = strict_findings(parsed(spark, [("ok", f'{{"answers":{good}}}')]), contract, meta=["flags"])
    assert {row["detail"] for row in rows(needs.where("qid = 'many'"))} == set() and {row["detail"] for row in rows(needs.where("qid = 'g'"))} == {"flags", "rows.r1.flags", "rows.r2.flags"}


def test_entries_next_to_each_other_and_containers_stay(spark):
    """Containers side by side, one with a value of its own, one that is empty, and a hundred members at one level."""
    many = ",".join(f'"m{k}":{{"value":{k}}}' for k in range(100))
    text = f'{{"answers":{{"p":{{"value":7,"components":{{"a":{{"value":1}},"b":null}},"rows":{{{many}}}}},"e":{{"rows":{{}}}},"s":[1,2],"n":null}}}}'
    found = {row["path"]: row["value"] for row in rows(flatten.entry_parts(flatten.answers_long(parsed(spark, [("R1", text)]))))}
    assert found["p"] == "7" and found["p.components.a"] == "1" and found["p.components.b"] is None and found["e"] is None and found["s"] == "1;2"
    assert [found[f"p.rows.m{k}"] for k in range(100)] == [str(k) for k in range(100)] and len(found) == 106


def test_entries_of_two_levels_come_from_generators_and_parts_one_by_one(spark):
    """Only a question with deeper entries is walked; a container's text or null is none; what is not asked for is not looked up."""
    text = '{"answers":{"a":{"rows":{"x.y":{"value":1,"flags":["needs_review"]},"z":{"rows":"no","components":null}}},"b":{"subfield":{"s":{"rows":{"r":{"needs_review":true}}},"t":3}},"c":{"rows":[1]}}}'
    long = flatten.answers_long(parsed(spark, [("R1", text), ("R2", '{"answers":[{"rows":{"r":1}}]}'), ("R3", '{}')]))
    seen = flatten.entry_parts(long).select("path", "needs_review")
    assert sorted(map(tuple, seen.collect())) == [
        ("a", False), ("a.rows.x.y", True), ("a.rows.z", False), ("b", False), ("b.subfield.s", False), ("b.subfield.s.rows.r", True), ("b.subfield.t", False), ("c", False),
    ]
    plan = seen._jdf.queryExecution().optimizedPlan().toString()
    assert "confidence" not in plan and "_inner" not in plan


def test_long_entries_are_not_broadcast(spark, tmp_path):
    """What generators make of a row counts for Spark as one row, so the entries of large tables look small enough to broadcast."""
    contract = Contract({"schema_version": "1", "total_pages": 1, "questions": [{"id": name, "page": 1, "type": "text"} for name in ("a", "b")]})
    texts = [("R1", '{"answers":{"a":{"value":"x"}}}'), ("R2", '{"answers":{"a":null,"b":{"value":null}}}'), ("R3", "{}")]
    spark.createDataFrame(texts, "record_id string, text string").write.parquet(f"{tmp_path}/texts")
    records = spark.read.parquet(f"{tmp_path}/texts").select("record_id", F.parse_json("text").alias("document"))
    dense = flatten.densify(flatten.answers_long(records), records, contract)
    plan = dense._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert [(r["record_id"], r["qid"], r["was_missing"]) for r in rows(dense.select("record_id", "qid", "was_missing"), "record_id", "qid")] == [
        ("R1", "a", False), ("R1", "b", True), ("R2", "a", False), ("R2", "b", False), ("R3", "a", True), ("R3", "b", True),
    ]


def test_two_reads_are_compared_once(spark):
    """The comparison is the dear part of a merge: every column that depends on it takes it from one place."""
    reads = spark.createDataFrame([("a", 1, "q", 1, '{"value":["x","y"],"note":"n"}'), ("a", 1, "q", 2, '{"value":["y","x"]}'), ("b", 1, "q", 1, '{"value":["xy","z"]}'), ("b", 1, "q", 2, '{"value":["x","yz"]}')],
                                  "record_id string, page int, qid string, read_no int, body string")
    merged = reconcile.double_read_merge(reads.select("record_id", "page", "qid", "read_no", F.parse_json("body").alias("entry")))
    pair = spark.createDataFrame([("1", "2")], "a string, b string").select(F.parse_json("a").alias("a"), F.parse_json("b").alias("b"))

    def filters(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("map_filter(")

    assert filters(merged) == filters(pair.select(A.values_equal("a", "b").alias("same")))
    assert [(r["record_id"], r["reads_match"], r["confidence"], r["flags"], r["note"], r["needs_review"]) for r in rows(merged, "record_id")] == [
        ("a", True, None, [], "n", False), ("b", False, "low", ["needs_review"], reconcile.MISMATCH_NOTE, True),
    ]


def test_texts_of_one_length_and_numbers_are_still_compared(spark):
    """Only what cannot be equal is told apart by its text."""
    same = [('{"value":["ab","c"],"note":"x"}', '{"value":["c","ab"]}'), ('{"value":1.0}', '{"value":1}'), ('[1,2]', '[2,1]'), ('{"value":{"a":1,"flags":[]}}', '{"value":{"a":1}}'), ('{"value":[[1,2],3]}', '{"value":[3,[2,1]]}')]
    other = [('{"value":["ab","c"]}', '{"value":["a","bc"]}'), ('{"value":"1.0"}', '{"value":1}'), ('{"value":"a"}', '{"value":"b"}'), ('{"value":"[1"}', '{"value":"1["}'), ('{"value":[1]}', '{"value":1}'), ('{"value":null}', '{}'), ('[]', '{}')]
    df = spark.createDataFrame([(a, b, want) for want, pairs in ((True, same), (False, other)) for a, b in pairs], "x string, y string, want boolean")
    got = df.select("x", "y", F.parse_json("x").alias("a"), F.parse_json("y").alias("b"), "want").where(A.values_equal("a", "b") != F.col("want"))
    assert rows(got.select("x", "y")) == []
