"""Recodes, projection, privacy, quality and reconciliation on small documented cases."""

import json

import pytest
from frames import rows
from pyspark.sql import functions as F

from tallyframe.functions import answers as A
from tallyframe.functions import recode as R
from tallyframe.operators import flatten, privacy, quality, reconcile
from tallyframe.plans.analyze import run_analysis
from tallyframe.sources import records as scans
from tallyframe.sources import sinks
from tallyframe.sources.contract import Contract, contracts_frame
from tallyframe.streaming.records import stream_records, stream_wide

BASIC = {
    "schema_version": "1.0.0", "total_pages": 1,
    "questions": [
        {"id": "respondent_name", "page": 1, "text": "Name", "type": "text", "pii": True},
        {"id": "satisfaction", "page": 1, "text": "Overall", "type": "single_select", "options": [{"code": "low"}, {"code": "medium"}, {"code": "high"}]},
        {"id": "channels", "page": 1, "text": "Channels", "type": "multi_select", "options": [{"code": "web"}, {"code": "phone"}, {"code": "office"}]},
        {"id": "comment", "page": 1, "text": "Comment", "type": "free_text"},
        {"id": "PAGE_NOTES", "page": None, "type": "free_text", "per_page": True},
    ],
}
RICH = {
    "schema_version": "2", "total_pages": 2,
    "questions": [
        {"id": "q1", "page": 1, "type": "single_select", "options": [
            {"code": "a"}, {"code": "khac", "other_text": True, "subfield": {"id": "why"}}], "subfield": [{"id": "s1"}, {"id": "s2"}]},
        {"id": "q2", "page": 1, "type": "composite", "components": [{"id": "c1", "type": "single_select", "options": [{"code": "x"}]}, {"id": "c2", "type": "text"}]},
        {"id": "q3", "page": 2, "type": "matrix", "expected_data_rows": 2, "rows": [{"group_header": "H"}, {"code": "r1"}, {"code": "r2"}],
         "columns": [{"code": "u"}, {"code": "v"}], "row_content_column": {"code": "content"}},
        {"id": "q4", "page": 2, "type": "device_grid", "rows": [{"code": "d1"}], "columns": [{"code": "u"}, {"code": "v"}], "extra_option": {"code": "nobody"}},
        {"id": "q5", "page": 2, "type": "text", "derived_subfield": {"id": "y"}},
    ],
}


def documents(spark, *answers, **more):
    raw = [(f"r{i}", json.dumps({"record_id": f"r{i}", "answers": a, **more})) for i, a in enumerate(answers)]
    return spark.createDataFrame(raw, "record_id string, t string").select("record_id", F.parse_json("t").alias("document"))


def values(spark, build, *cells, kind="string"):
    df = spark.createDataFrame([(i, cell) for i, cell in enumerate(cells)], f"i int, x {kind}")
    return [r["y"] for r in rows(df.select("i", build(F.col("x")).alias("y")), "i")]


def test_recodes_at_their_boundaries(spark):
    assert values(spark, R.strip_suffix, "lung-phinh-16phieu", "sa-pa") == ["lung-phinh", "sa-pa"]
    assert values(spark, R.age_from_year, "1995", " 1995 ", "19x") == [31, 31, None]
    assert values(spark, R.age_bracket, 30, 35, 45, 46, None, kind="int") == ["<35", "35-45", "35-45", ">45", None]
    texts = ["Hết lớp 9", "Hết lớp 7", "Lớp 12", "Hết lớp 11", "9/12", "12/12", "Tiểu học", None]
    assert values(spark, R.education_bracket, *texts) == ["thcs", "tieu_hoc", "thpt", "thcs", "thcs", "thpt", "tieu_hoc", None]
    assert values(spark, R.marriage_age_bracket, "16", "18", "x") == ["<18", ">=18", None]
    assert values(spark, R.experience_bracket, "9", "0", "7-8", ">1", ">0.5", None) == [">=1", "<1", None, ">=1", None, None]
    assert values(spark, R.safe_float, ">1", " 2.5 ", "1e3", "") == [None, 2.5, 1000.0, None]
    assert values(spark, R.spelling_normalise, "H'MÔNG", "dao đỏ", " Tày ", "kinh", None) == ["Mông", "Dao", "Tày", "Kinh", None]
    assert values(spark, R.as_single_category, None, ["nguoi_khac", "chong"], ["51_75", "25_50"], [], kind="array<string>") == [None, "chong+nguoi_khac", "25_50+51_75", None]
    assert values(spark, R.as_code_list, None, ["a", None], kind="array<string>") == [[], ["a"]]
    assert values(spark, R.base_question, "Q14_lam_dat", "Q21a", "province", "Q22b_khac") == ["Q14", "Q21a", "province", "Q22b"]


def test_ticks_outrank_the_written_grade(spark):
    df = spark.createDataFrame([("Lớp 3", True, True), ("Lớp 3", True, None), ("Lớp 3", None, None)], "t string, never boolean, trained boolean")
    got = df.select(R.education_bracket("t", F.col("never"), F.col("trained")).alias("b"))
    assert [r["b"] for r in got.collect()] == ["thpt", "khong_di_hoc", "tieu_hoc"]


def test_codes_are_matched_to_the_contract(spark):
    allowed = ["nong_dan", "buon_ban", "khac"]
    got = values(spark, lambda c: R.canonical_codes(c, allowed), ["buon_ban", "nong_dan"], ["NONG_DAN", "nong_dan"], ["code_la", "khac"], [], None, kind="array<string>")
    assert got == [["nong_dan", "buon_ban"], ["nong_dan"], ["khac", "code_la"], [], None]


def test_review_state_in_both_forms(spark):
    df = spark.createDataFrame([(["needs_review"], None), (["x"], None), (None, True), (None, None)], "f array<string>, b boolean")
    assert [r[0] for r in df.select(R.needs_review("f", "b")).collect()] == [True, False, True, False]


def test_basic_record_flattens_without_personal_data(spark):
    contract = Contract(BASIC)
    records = documents(spark, {
        "respondent_name": {"value": "Private Person"}, "satisfaction": {"value": "high"}, "channels": {"value": ["web", "phone"]}, "comment": {"value": "ok"},
    }, source_images=["private.png"])
    manifest = spark.createDataFrame([("r0", "x.pdf", "pilot")], "record_id string, source_path string, group string")
    row = rows(flatten.manifest_join(flatten.flatten_records(records, contract), manifest))[0]
    assert "respondent_name" not in row and row["meta__group"] == "pilot" and "meta__source_path" not in row
    assert (row["channels__web"], row["channels__office"], row["comment"]) == (1, 0, "ok")
    assert "respondent_name" in flatten.flatten_records(records, contract, include_pii=True).columns
    safe = json.loads(privacy.pii_projection(records, contract).select(F.to_json("document")).first()[0])
    assert "respondent_name" not in safe["answers"] and "source_images" not in safe and safe["record_id"] == "r0"


def test_null_empty_missing_and_bare_values_stay_apart(spark):
    cases = [{}, {"channels": None}, {"channels": {"value": None}}, {"channels": {"value": []}}, {"channels": "web"}, {"channels": {"value": "phone"}}, {"satisfaction": {"value": ["low", "high"]}}]
    got = rows(flatten.flatten_records(documents(spark, *cases), Contract(BASIC)), "record_id")
    assert [r["channels__web"] for r in got] == [None, None, None, 0, 1, 0, None]
    assert got[6]["satisfaction"] == "low;high" and got[0]["satisfaction"] is None


def test_rich_contract_fields_and_cells(spark):
    contract = Contract(RICH)
    names = [field.column for field in contract.fields()]
    assert names == ["q1", "q1__s1", "q1__s2", "q2__c1", "q2__c2", "q3__r1", "q3__r2", "q4__d1__u", "q4__d1__v", "q4__nobody", "q5", "q5__y"]
    assert {"q1__why", "q1__other_text", "q3__r1__content"} <= {field.column for field in contract.fields(option_extras=True)}
    records = documents(spark, {
        "q1": {"value": "khac", "other_text": "hm", "subfield": {"s1": {"value": 1}, "why": {"value": "so"}}}, "q2": {"components": {"c1": True, "c2": {"value": None}}},
        "q3": {"rows": {"r1": {"value": ["u", "v"], "content": "note"}}}, "q4": {"rows": {"d1": {"value": []}}, "nobody": False}, "q5": 7,
    })
    row = rows(flatten.flatten_records(records, contract, option_extras=True))[0]
    assert (row["q2__c1"], row["q2__c2"], row["q3__r1"], row["q3__r2"]) == ("true", None, "u;v", None)
    assert (row["q4__d1__u"], row["q4__d1__v"], row["q4__nobody"], row["q5"], row["q1__s1"], row["q1__s2"]) == (0, 0, "false", "7", "1", None)
    assert (row["q1__other_text"], row["q1__why"], row["q3__r1__content"]) == ("hm", "so", "note")
    fields = rows(contract.field_dictionary(spark), "position")
    assert fields[7]["kind"] == "contains" and fields[7]["path"] == ["q4", "rows", "d1"] and fields[9]["kind"] == "raw"


def test_contract_tables_agree_with_the_compiled_contract(spark):
    from tallyframe.operators import contracts

    documents_ = contracts_frame(spark, {"rich": json.dumps(RICH), "basic": json.dumps(BASIC)})
    for name, contract in (("rich", Contract(RICH)), ("basic", Contract(BASIC))):
        listed = rows(contracts.field_dictionary(documents_).filter(F.col("contract") == name), "position", "place")
        assert [(r["column"], r["kind"], tuple(r["path"]), r["code"]) for r in listed] == [(f.column, f.kind, f.path, f.code) for f in contract.fields()]
        book = {r["column"]: r["kind"] for r in rows(contracts.codebook(documents_).filter(F.col("contract") == name))}
        assert book == {r["column"]: r["kind"] for r in rows(flatten.codebook(contract, spark))}
    loaded = contracts.load_contracts(spark.createDataFrame([("a", "{"), ("b", "{}"), ("c", '{"questions": []}')], "contract string, text string"))
    assert [r["error"] for r in rows(loaded.drop("document"), "contract")] == ["unreadable_json", "no_questions_array", None]


def test_empty_record_passes_its_own_check(spark):
    contract = Contract(RICH)
    blank = flatten.empty_record(contract)
    assert blank["answers"]["q2"]["components"]["c1"] == {"value": False} and blank["answers"]["q4"] == {"rows": {"d1": {"value": []}}, "nobody": False}
    found = quality.record_completeness(documents(spark, blank["answers"]), contract)
    assert {(r["qid"], r["rule"]) for r in rows(found)} == {("q3", "missing_row_content"), ("q5", "missing_derived_subfield")}


def test_completeness_rules(spark):
    contract = Contract(RICH)
    records = documents(spark, {"q1": {"value": ["khac"]}, "q2": {"components": {"c1": {}}}, "q3": None, "q4": 5}, {"q2": {}, "q3": {"rows": {"r1": {}, "r2": {"content": 1}}}})
    found = {(r["record_id"], r["path"], r["rule"]) for r in rows(quality.record_completeness(records, contract))}
    assert {
        ("r0", "q1.subfield.s1", "missing_subfield"), ("r0", "q1.subfield.why", "missing_option_subfield"), ("r0", "q2.components.c2", "missing_component"),
        ("r0", "q3", "null_entry"), ("r0", "q4", "entry_not_object"), ("r0", "q5", "missing_answer"),
        ("r1", "q1", "missing_answer"), ("r1", "q2.components", "missing_components"), ("r1", "q3.rows.r1", "missing_row_content"),
    } <= found
    assert ("r1", "q3.rows.r2", "missing_row_content") not in found
    bare = spark.createDataFrame([("x", "{}")], "record_id string, t string").select("record_id", F.parse_json("t").alias("document"))
    assert [r["rule"] for r in rows(quality.record_completeness(bare, contract))] == ["missing_answers"]


@pytest.mark.parametrize("change, rule", [
    ({"questions": []}, "no_questions"), ({"total_pages": 0}, "total_pages"), ({"questions": [{"id": "", "type": "text", "page": 1}]}, "question_id"),
    ({"questions": [{"id": "a", "type": "text", "page": 1}] * 2}, "duplicate_question_id"), ({"questions": [{"id": "a", "type": "odd", "page": 1}]}, "unsupported_type"),
    ({"questions": [{"id": "a", "type": "text", "page": 99}]}, "page_range"), ({"questions": [{"id": "a", "type": "text"}]}, "page_range"),
])
def test_basic_lint(spark, change, rule):
    assert rule in {r["rule"] for r in rows(quality.contract_lint(contracts_frame(spark, {"c": json.dumps({**BASIC, **change})})))}


def lint_strict(spark, *questions):
    document = {"total_pages": 2, "questions": list(questions)}
    return {r["rule"] for r in rows(quality.contract_lint_strict(contracts_frame(spark, {"c": json.dumps(document)})))}


def test_strict_lint(spark):
    single = {"id": "s", "page": 1, "type": "single_select", "options": [{"code": "a"}, {"code": "b"}]}
    assert lint_strict(spark, single) == set() and lint_strict(spark, *RICH["questions"]) == set()
    assert lint_strict(spark, {**single, "options": [{"code": "a", "exclusive": True}]}) == {"all_options_exclusive"}
    assert lint_strict(spark, {**single, "page": None, "per_page": True}) == set()
    assert lint_strict(spark, {**single, "per_page": True}) == {"per_page_with_page"}
    matrix = RICH["questions"][2]
    assert lint_strict(spark, {k: v for k, v in matrix.items() if k != "expected_data_rows"}) == {"expected_data_rows_missing"}
    assert lint_strict(spark, {**matrix, "expected_data_rows": 5}) == {"expected_data_rows"}

    def depends(**condition):
        return lint_strict(spark, single, RICH["questions"][1], {"id": "d", "page": 1, "type": "text", "depends_on": condition})

    assert depends(question="zz", equals="a") == {"depends_on_missing_question"}
    assert depends(question="s", equals="zz") == {"depends_on_unknown_code"}
    assert depends(question="s", equals="a", contains="b") == {"depends_on_operator"}
    assert depends(question="s", **{"in": "a"}) == {"depends_on_needs_list"}
    assert depends(question="s", **{"in": ["a", "b"]}) == set() and depends(question="c1", equals="x") == set()


def test_code_rules_and_field_count(spark):
    table = contracts_frame(spark, {"c": json.dumps({"total_pages": 3, "questions": [
        {"id": "a", "page": 1, "type": "single_select", "options": [{"code": "X"}, {"code": "x"}, {"code": "y"}, {"code": "y"}, {"code": ""}]}, *RICH["questions"],
        {"id": "n", "type": "free_text", "per_page": True}]})})
    assert {r["rule"] for r in rows(quality.contract_code_rules(table))} == {"codes_differ_by_case", "duplicate_code", "empty_code"}
    counted = {r["qid"]: r["n_fields"] for r in rows(quality.export_field_count(table))}
    assert counted == {"a": 1, "q1": 5, "q2": 2, "q3": 4, "q4": 2, "q5": 2, "n": 3}


def test_payload_findings_and_struct(spark):
    contract = Contract(BASIC)
    records = documents(spark, {"satisfaction": {"value": "High"}, "channels": {"value": ["web", "fax"]}, "extra": {}})
    found = {(r["qid"], r["rule"], r["detail"]) for r in rows(flatten.payload_findings(records, contract))}
    assert found == {("respondent_name", "missing_question", ""), ("comment", "missing_question", ""), ("extra", "unexpected_question", ""), ("channels", "invalid_option_code", "fax")}
    text = json.dumps({"channels": {"value": ["web"], "confidence": "low"}})
    df = spark.createDataFrame([(text,)], "t string").select(F.from_json("t", flatten.contract_struct(contract)).alias("a"))
    assert df.select("a.channels.value", "a.channels.confidence").first() == (["web"], "low")


def test_readings_follow_the_mark_rules(spark):
    contract = Contract({"questions": [
        {"id": "s", "page": 1, "type": "single_select", "options": [{"code": "nong_dan"}, {"code": "buon_ban"}]},
        {"id": "m", "page": 1, "type": "multi_select", "options": [{"code": "a"}, {"code": "none", "exclusive": True}]},
    ]})
    flag = quality.MULTI_MARK
    data = [("1", "s", ["buon_ban", "nong_dan"], []), ("2", "s", ["NONG_DAN"], [flag]), ("3", "s", [], [flag]), ("4", "m", ["a", "none"], [flag]), ("5", "s", ["code_la"], []), ("6", "m", None, ["own_flag"])]
    readings = spark.createDataFrame(data, "record_id string, qid string, codes array<string>, flags array<string>")
    codes = quality.contract_codes(contract, spark)
    got = {r["record_id"]: r for r in rows(quality.normalise_readings(readings, codes))}
    assert got["1"]["codes"] == ["nong_dan", "buon_ban"] and got["1"]["flags"] == [flag]
    assert (got["2"]["codes"], got["2"]["flags"]) == (["nong_dan"], []) and (got["3"]["codes"], got["3"]["flags"]) == (None, [])
    assert got["4"]["flags"] == [] and got["5"]["flags"] == ["invalid_option_code"] and got["5"]["codes"] == ["code_la"]
    assert got["6"]["codes"] is None and got["6"]["bad_flags"] == ["own_flag"]
    assert [r["record_id"] for r in rows(quality.exclusive_conflict(readings, codes))] == ["4"]


def test_pages_against_the_manifest(spark):
    manifest = spark.createDataFrame([("ok", "7"), ("few", "7"), ("many", ""), ("none", "7"), ("bad", "x")], "record_id string, expected_pages string")
    pages = spark.createDataFrame([(r, i) for r, n in (("ok", 7), ("few", 6), ("many", 8), ("bad", 1)) for i in range(1, n + 1)], "record_id string, page_no int")
    got = {r["record_id"]: (r["flag"], r["status"], r["found_pages"]) for r in rows(quality.page_reconciliation(manifest, pages, 7))}
    assert got == {
        "ok": (None, "ok", 7), "few": ("missing_page", "needs_review", 6), "many": ("extra_page", "needs_review", 8),
        "none": ("source_not_found", "error", 0), "bad": ("processing_error", "error", 0),
    }
    odd = spark.createDataFrame([("a", 1), ("a", 1), ("a", 4), ("a", None)], "record_id string, page_no int")
    assert {r["rule"]: r["pages"] for r in rows(quality.page_set_check(odd, 2))} == {"page_not_integer": 1, "duplicate_page": 1, "unexpected_page": 1, "missing_page": 1}


def reads(spark, *entries):
    data = [(str(r), 1, "q", n, json.dumps(e)) for r, pair in enumerate(entries) for n, e in enumerate(pair, 1) if e is not None]
    return spark.createDataFrame(data, "record_id string, page int, qid string, read_no int, t string").select(
        "record_id", "page", "qid", "read_no", F.parse_json("t").alias("entry"))


def test_double_read_merge(spark):
    got = rows(reconcile.double_read_merge(reads(
        spark,
        ({"value": "high", "confidence": "high", "flags": []}, {"value": "low", "confidence": "high", "flags": []}),
        ({"value": ["hoi_phu_nu", "hoi_nong_dan"], "flags": ["x", "x"]}, {"value": ["hoi_nong_dan", "hoi_phu_nu"], "confidence": "low", "note": "n"}),
        ({"value": None}, {"value": []}), ({"value": 1}, {"value": "1"}), ({"value": "a"}, None),
    )), "record_id")
    assert (got[0]["value"], got[0]["confidence"], got[0]["needs_review"], got[0]["flags"]) == ("high", "low", True, ["needs_review"])
    assert got[1]["reads_match"] and got[1]["flags"] == ["x"] and not got[1]["needs_review"]
    assert not got[2]["reads_match"] and not got[3]["reads_match"]
    assert got[4]["error"] == "read_2_missing" and got[4]["reads_match"] is None


def test_self_consistency_merge(spark):
    flag = quality.MULTI_MARK
    got = rows(reconcile.self_consistency_merge(reads(
        spark,
        ({"value": ["a", "b"], "flags": [flag]}, {"value": ["a"], "flags": ["needs_review", flag]}),
        ({"value": "a", "flags": [flag]}, {"value": "a", "flags": ["ambiguous_mark"]}),
    )), "record_id")
    assert got[0]["flags"] == [flag, "needs_review", "self_consistency_mismatch"] and not got[0]["match"]
    assert got[1]["flags"] == ["ambiguous_mark"] and got[1]["match"]


def test_truth_comparison_errors_and_selection(spark):
    def side(*items):
        return spark.createDataFrame([("r", q, json.dumps(v), f) for q, v, f in items], "record_id string, qid string, t string, flags array<string>").select(
            "record_id", "qid", F.parse_json("t").alias("value"), "flags")

    truth = side(("a", [1, 2], ["multi_mark_on_single_select"]), ("b", True, []), ("c", "x", []))
    found = side(("a", [2, 1], []), ("b", 1, ["extra"]), ("d", "x", []))
    got = {r["qid"]: r for r in rows(reconcile.truth_comparison(truth, found))}
    assert got["a"]["value_match"] and not got["a"]["flags_match"] and got["a"]["missing_flags"] == ["multi_mark_on_single_select"]
    assert not got["b"]["value_match"] and got["b"]["flags_match"]
    assert got["c"]["errors"] == ["missing_in_extracted"] and got["d"]["errors"] == ["missing_in_truth"] and not got["d"]["flags_match"]
    listed = {r["qid"]: r["errors"] for r in rows(reconcile.truth_comparison(truth, found, ["a", "zz"]))}
    assert listed == {"a": [], "zz": ["missing_in_truth", "missing_in_extracted"]}
    hidden = rows(privacy.redacted_diff(reconcile.truth_comparison(truth, found)))
    assert all(r["expected_value"] is None for r in hidden) and len(hidden) == 4
    assert any(r["expected_value"] == "true" for r in rows(privacy.redacted_diff(reconcile.truth_comparison(truth, found), show=True)))


def test_masking_reads_whole_texts(spark):
    long = "word " * 5000 + "call +84 912 345 678 or mail a.b@c.org"
    masked = spark.createDataFrame([(long,)], "t string").select(privacy.pii_mask_text(F.col("t")), privacy.pii_hits(F.col("t"))).first()
    assert masked[0].endswith("call [PHONE] or mail [EMAIL]") and masked[1] == {"[EMAIL]": 1, "[PHONE]": 1}


def test_file_round_trips(spark, tmp_path):
    folder = tmp_path / "records"
    folder.mkdir()
    (folder / "A-1.json").write_text(json.dumps({"answers": {}}), encoding="utf-8")
    (folder / "B.json").write_text('{"record_id": "B", "answers": {"x": NaN}}', encoding="utf-8")
    (folder / "C.json").write_text("[1]", encoding="utf-8")
    (folder / "D.json.bak").write_text("{}", encoding="utf-8")
    got = {r["file_name"]: (r["record_id"], r["error"]) for r in rows(scans.scan_records(spark, str(folder)).drop("document"))}
    assert got == {"A-1.json": ("A-1", None), "B.json": ("B", "unreadable_json"), "C.json": ("C", "root_not_object")}
    manifest = tmp_path / "manifest.csv"
    manifest.write_bytes("﻿record_id,source_path,note\n A-1 ,a.pdf,\"x, \"\"y\"\"\nz\"\n\nB,b.pdf,\n".encode())
    loaded = rows(scans.load_manifest(spark, str(manifest)), "record_id")
    assert [r["record_id"] for r in loaded] == ["A-1", "B"] and loaded[0]["note"] == 'x, "y"\nz'
    manifest.write_text("record_id,source_path\nA,a\nA,b\n")
    with pytest.raises(ValueError, match="duplicate_record_id"):
        scans.load_manifest(spark, str(manifest))
    sources = tmp_path / "sources"
    (sources / "one").mkdir(parents=True)
    (sources / "one" / "A-1.png").write_bytes(b"\x89PNG\r\n\x1a\nxx")
    (sources / "A-1.pdf").write_bytes(b"junk")
    (sources / "B.txt").write_bytes(b"no")
    found = rows(scans.source_inventory(spark, str(sources), check_header=True))
    assert len(found) == 1 and found[0]["n_sources"] == 2 and found[0]["path"].endswith("A-1.pdf") and not found[0]["readable"]
    pages = tmp_path / "assembly"
    pages.mkdir()
    (pages / "A-1.json").write_text(json.dumps({"record_id": "A-1", "expected_pages": 2, "status": "ok", "pages": [{"tentative_page": 1, "image_path": "p1"}]}, indent=1))
    assert rows(scans.scan_assembly(spark, str(pages)).select("record_id", "tentative_page")) == [{"record_id": "A-1", "tentative_page": 1}]
    wide = spark.createDataFrame([("a", 1, 'q "x"')], "record_id string, n int, t string")
    sinks.write_wide(wide, str(tmp_path / "wide.csv"), csv=True)
    assert rows(scans.scan_wide(spark, str(tmp_path / "wide.csv"), "record_id string, n int, t string")) == [{"record_id": "a", "n": 1, "t": 'q "x"'}]


def test_run_analysis_end_to_end(spark, tmp_path):
    (tmp_path / "schema.json").write_text(json.dumps(BASIC))
    (tmp_path / "manifest.csv").write_text("record_id,source_path,group\nDEMO-1,demo.pdf,pilot\nDEMO-2,demo.pdf,main\n")
    full = tmp_path / "full"
    full.mkdir()
    for i, level in ((1, "high"), (2, "low")):
        (full / f"DEMO-{i}.json").write_text(json.dumps({"record_id": f"DEMO-{i}", "answers": {
            "respondent_name": {"value": "Private"}, "satisfaction": {"value": level}, "channels": {"value": ["web"]}, "comment": {"value": "fine"}}}))
    out = str(tmp_path / "out")
    wide = run_analysis(spark, str(tmp_path / "schema.json"), str(tmp_path / "manifest.csv"), str(full), out, {
        "variable_types": {"satisfaction": "categorical", "channels__web": "binary"}, "policy": {"alpha": 0.05}})
    assert wide.count() == 2 and "respondent_name" not in wide.columns and "meta__group" in wide.columns
    assert spark.read.parquet(f"{out}/analysis/frequencies").count() == 3
    assert "Private" not in "".join(r[0] for r in spark.read.text(f"{out}/safe_records").collect())
    findings = spark.read.parquet(f"{out}/findings")
    assert {r["rule"] for r in findings.collect()} == {"missing_page_notes"}
    (tmp_path / "manifest.csv").write_text("record_id,source_path\nDEMO-1,demo.pdf\n")
    with pytest.raises(ValueError, match="DEMO-2"):
        run_analysis(spark, str(tmp_path / "schema.json"), str(tmp_path / "manifest.csv"), str(full), str(tmp_path / "out2"))


def test_streamed_records_give_the_batch_rows(spark, tmp_path):
    contract = Contract(BASIC)
    folder = tmp_path / "in"
    folder.mkdir()
    for i in range(3):
        (folder / f"r{i}.json").write_text(json.dumps({"answers": {"satisfaction": {"value": "low"}, "channels": {"value": ["web"][:i]}}}))
    stream_wide(stream_records(spark, str(folder)), contract, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    batch = flatten.flatten_records(scans.valid_records(scans.scan_records(spark, str(folder))), contract)
    assert rows(spark.read.parquet(str(tmp_path / "out")), "record_id") == rows(batch, "record_id")


def test_household_scope(spark):
    from tallyframe.operators import association, effects, structure
    from tallyframe.plans import household

    def form(year, years_exp, owner, grade):
        return {
            "Q2": {"value": year}, "Q4": {"value": "khac", "other_text": " H'mông "}, "Q8": {"value": ["51_75", "25_50"]}, "Q21a": {"value": "1_3_lan"},
            "Q5": {"components": {"Q5_khong_di_hoc": {"value": False}, "Q5_lop_cao_nhat": {"value": grade}}}, "Q30": {"value": ["tieu_thu", "san_xuat"]},
            "Q6": {"value": "co_chong", "subfield": {"Q6_tuoi_ket_hon": {"value": "17"}}}, "Q9": {"derived_subfield": {"Q9_derived_years_exp": {"value": years_exp}}},
            "Q11": {"value": ["khong_hoi_vien"]}, "Q14": {"rows": {"lam_dat": {"value": ["vo", "chong"]}, "trong": {"value": "chong"}}},
            "Q17": {"rows": {"dien_thoai": {"value": ["vo"]}, "may_tinh": {"value": []}}, "khong_ai_co": False}, "Q27a": {"value": owner},
        }

    records = documents(spark, form("1995", 9, "vo", "Hết lớp 9"), form(1979, ">1", "chong", None))
    wide = flatten.flatten_scoped(records, household.scope())
    a, b = rows(wide, "record_id")
    assert (a["Q2_tuoi"], a["age_bracket"], b["age_bracket"], a["education_grade_bracket"], b["education_grade_bracket"]) == (31, "<35", ">45", "thcs", None)
    assert (a["Q4"], a["Q8"], a["Q6_tuoi_ket_hon"], a["marriage_age_bracket"]) == ("Mông", "25_50+51_75", 17.0, "<18")
    assert (a["Q9_derived_years_exp"], b["Q9_derived_years_exp"], b["experience_years_bracket"]) == (9.0, None, ">=1")
    assert (a["Q14_lam_dat"], a["Q17_dien_thoai_vo"], a["Q17_may_tinh_vo"], a["Q17_may_tinh_bang_vo"], a["Q17_khong_ai_co"]) == ("chong+vo", 1, 0, None, False)
    assert (a["Q11_khong_hoi_vien"], a["Q18_khac"]) == (1, None)
    helped = flatten.derived_columns(wide, household.helper_columns())
    first = rows(helped, "record_id")[0]
    assert (first["Q8_ordinal"], first["Q11_la_hoi_vien"], first["Q27a_dung_ten_dat"], first["Q30_nhom_khau_cao_gia"], first["Q30_is_thu_hai"]) == (None, False, True, True, False)
    assert effects.curated_effects(helped, household.EFFECTS).count() == len(household.EFFECTS)
    assert association.curated_group_tests(helped, household.GROUP_TESTS).count() == 2
    features = rows(structure.segment_features(wide, household.segment_columns(), ["record_id"]), "record_id")[0]
    assert features["owns_devices"] == 0.5 and features["labour_index"] == pytest.approx(100 / 18) and features["rides"] is None


def test_both_review_counts_come_from_one_shuffle(spark):
    from tallyframe.operators import quality

    rows_ = [("a", "q", "q", True), ("a", "q", "q.rows.r", True), ("a", "p", "p", False), ("b", "q", "q", False), ("c", "q", "q.rows.r", True)]
    entries = spark.createDataFrame(rows_, "record_id string, qid string, path string, needs_review boolean").repartition(3)
    top, nested = quality.needs_review_count(entries), quality.needs_review_count(entries, nested=True)
    assert sorted(map(tuple, top.collect())) == [("a", 1), ("b", 0)]
    assert sorted(map(tuple, nested.collect())) == [("a", 2), ("b", 0), ("c", 1)]
    both = top.join(nested.withColumnRenamed("n_needs_review", "n_nested"), "record_id")
    assert sorted(map(tuple, both.collect())) == [("a", 1, 2), ("b", 0, 0)]
    assert "ReusedExchange" in both._jdf.queryExecution().executedPlan().toString()


def test_entries_are_not_shuffled_for_whether_they_are_there(spark):
    from tallyframe.operators import flatten
    from tallyframe.sources.contract import Contract
    from tallyframe.sources.records import parse_records

    contract = Contract({"questions": [{"id": "a", "type": "text", "page": 1}, {"id": "b", "type": "text", "page": 1}]})
    records = parse_records(spark.createDataFrame([('{"record_id":"R1","answers":{"a":{"value":null}}}',)], "value string"), file_name=None)
    dense = flatten.densify(flatten.answers_long(records), records, contract).select("record_id", "qid", "was_missing")
    assert sorted(map(tuple, dense.collect())) == [("R1", "a", False), ("R1", "b", True)]
    plan = dense._jdf.queryExecution().optimizedPlan().toString()
    joined = plan[plan.index("Join"):].splitlines()
    assert "entry#" not in next(line for line in joined if "_void" in line).split(" AS _void")[-1]


def test_canonical_text_of_shallow_and_deep_values_is_the_same(spark, monkeypatch):
    """Values with few brackets are written without the walk over levels, to the same text."""
    texts = [
        '{"value":["b","a"],"flags":["x"],"n":10.0}', '{"n":10,"value":["a","b"],"note":null}', '[[2,1],[1,2],{}]', '[]', '{}', 'null', '"10.0"', '10.00', '-0.0', '100', 'true',
        '{"rows":{"r1":["Q","[{"]}}', '{"a":{"b":{"c":1.50}}}', '{"a":null,"b":[null,"null"]}', '["{","["]', '1e2', '{"k,1:":"x","k":",1:"}', None,
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string").select("id", F.parse_json("t").alias("v"))

    def canonical(shallow, ignore):
        monkeypatch.setattr(A, "SHALLOW", shallow)
        return {r["id"]: r["c"] for r in df.select("id", A.canonical_value("v", ignore).alias("c")).collect()}

    for ignore in ((), A.ENTRY_METADATA):
        walked = canonical(-1, ignore)
        assert canonical(3, ignore) == walked and walked[len(texts) - 1] is None
    plan = df.select(A.canonical_value("v").alias("c"))._jdf.queryExecution().analyzed().toString()
    assert "startswith" in plan.lower()


def test_validation_reads_the_records_once(spark):
    contract = Contract({"total_pages": 1, "questions": [
        {"id": "a`b", "type": "composite", "page": 1, "components": [{"id": "c"}]},
        {"id": "s", "type": "single_select", "page": 1, "options": [{"code": "x", "subfield": {"id": "why"}}]},
        {"id": "m", "type": "matrix", "page": 1, "rows": [{"code": "r1"}, {"code": "r2"}], "columns": [{"code": "k"}], "row_content_column": {"code": "text"}},
        {"id": "n", "page": None, "type": "free_text", "per_page": True},
    ]})
    bodies = [
        '{"record_id":"odd","answers":{"a`b":{"components":null},"s":{"value":["x"]},"m":{"rows":{"r1":null,"r2":{"value":[{"text":1}]}}}},"page_notes":{"1":null}}',
        '{"record_id":"bare","answers":{"a`b":[1],"s":null,"m":{"rows":[]}},"page_notes":7}',
        '{"record_id":"none","answers":[]}', '{"record_id":"full","answers":{"a`b":{"components":{"c":null}},"s":{"value":null},"m":{"rows":{"r1":{"text":null},"r2":"t"}}},"page_notes":{"1":{}}}',
        '{"record_id":"b d"}', '[1]', '{',
    ]
    records = scans.parse_records(spark.createDataFrame([(f"f{i}.json", body) for i, body in enumerate(bodies)], "file_name string, value string"))
    found = quality.validate_records(records, contract)
    assert sorted(tuple(str(v) for v in row) for row in found.collect()) == sorted([
        ("odd", "a`b", "a`b.components", "missing_components", ""), ("odd", "s", "s.subfield.why", "missing_option_subfield", "x"), ("odd", "m", "m.rows.r2", "missing_row_content", "text"),
        ("bare", "a`b", "a`b", "entry_not_object", "ARRAY<BIGINT>"), ("bare", "s", "s", "null_entry", ""), ("bare", "m", "m.rows", "missing_rows", ""), ("bare", "n", "page_notes", "missing_page_notes", ""),
        ("none", "", "answers", "missing_answers", ""), ("b d", "None", "None", "invalid_record_id", "f4.json"),
        ("f5", "None", "None", "root_not_object", "f5.json"), ("f6", "None", "None", "unreadable_json", "f6.json"),
    ])
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and plan.count("parseJson") == 1


def test_a_join_on_ids_does_not_parse_again(spark):
    """The filter that a join puts on ids stays behind the parser."""
    raw = spark.createDataFrame([('{"record_id":"R1","answers":{"a":{"needs_review":true}}}',)], "value string")
    counts = quality.needs_review_count(flatten.entry_parts(flatten.answers_long(scans.parse_records(raw, file_name=None))), nested=True)
    found = spark.createDataFrame([("R1",), ("R2",)], "record_id string").join(counts, "record_id")
    assert rows(found) == [{"record_id": "R1", "n_needs_review": 1}]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("parseJson") == 1
