"""Data quality as findings: (record_id, qid, path, rule, detail) rows, never exceptions per record."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions import answers as A
from tallyframe.functions import recode
from tallyframe.operators.flatten import union_all
from tallyframe.sources.contract import (
    DEPENDS_LIST,
    DEPENDS_SCALAR,
    QUESTION_TYPES,
    Contract,
    allowed_codes,
    as_list,
    row_codes,
)
from tallyframe.sources.dimensions import small_table

FINDING_TYPE = "array<struct<qid:string,path:string,rule:string,detail:string>>"
MULTI_MARK = "multi_mark_on_single_select"
#: Type of a value of which only its name counts.
_LEAF = "array<array<boolean>>"
# The flags a reader may set itself, for the full and the multiple-choice layout.
READER_FLAGS = (
    "ambiguous_mark", "needs_review", "multi_mark_on_single_select",
    "conflicting_answer", "exclusive_conflict", "margin_note",
)
CHOICE_READER_FLAGS = ("ambiguous_mark", "needs_review", "multi_mark_on_single_select")


def _finding(qid: str | Column, path: str | Column, rule: str, detail: str | Column = "") -> Column:
    def as_column(value):
        return value if isinstance(value, Column) else F.lit(value)

    return F.struct(
        as_column(qid).alias("qid"), as_column(path).alias("path"), F.lit(rule).alias("rule"), as_column(detail).alias("detail")
    )


def _when(condition: Column, finding: Column) -> Column:
    """A one- or zero-element array of findings."""
    return F.when(condition, F.array(finding)).otherwise(F.array().cast(FINDING_TYPE))


def _each(names: Column, qid: str, prefix: str, rule: str) -> Column:
    """A finding per name in an array."""
    return F.transform(names, lambda name: _finding(qid, F.concat(F.lit(prefix), name), rule, name))


# ---- contract lint --------------------------------------------------------------------------------
# Contracts arrive as a table (contract, document), so lint scales with the number of versions.

def _questions(contracts: DataFrame) -> DataFrame:
    """(contract, position, total_pages, question, qid, type, page, per_page), one row per question."""
    listed = F.try_variant_get("document", "$.questions", "array<variant>")
    rows = contracts.select(
        "contract", F.try_variant_get("document", "$.total_pages", "int").alias("total_pages"),
        F.posexplode(listed).alias("position", "question"),
    )
    question = F.col("question")
    return rows.select(
        "*",
        F.when(F.schema_of_variant(F.try_variant_get(question, "$.id", "variant")) == "STRING", F.nullif(F.try_variant_get(question, "$.id", "string"), F.lit(""))).alias("qid"),
        F.try_variant_get(question, "$.type", "string").alias("type"),
        F.when(F.schema_of_variant(F.try_variant_get(question, "$.page", "variant")) == "BIGINT", F.try_variant_get(question, "$.page", "int")).alias("page"),
        F.coalesce(F.try_variant_get(question, "$.per_page", "boolean"), F.lit(False)).alias("per_page"),
    )


def _rule(rows: DataFrame, condition: Column, rule: str, detail: Column) -> DataFrame:
    return rows.filter(condition).select("contract", "qid", F.lit(rule).alias("rule"), detail.cast("string").alias("detail"))


def contract_lint(contracts: DataFrame) -> DataFrame:
    """Basic rules: (contract, qid, rule, detail)."""
    shape = contracts.select(
        "contract", F.lit(None).cast("string").alias("qid"),
        F.size(F.try_variant_get("document", "$.questions", "array<variant>")).alias("n"),
        F.when(
            F.schema_of_variant(F.try_variant_get("document", "$.total_pages", "variant")) == "BIGINT",
            F.try_variant_get("document", "$.total_pages", "int"),
        ).alias("total_pages"),
    )
    has_questions = F.coalesce(F.col("n") > 0, F.lit(False))
    rows = _questions(contracts)
    limit = F.greatest(F.coalesce("total_pages", F.lit(1)), F.lit(1))
    off_page = ~F.col("per_page") & ~F.coalesce(F.col("page").between(1, limit), F.lit(False))
    return union_all([
        _rule(shape, ~has_questions, "no_questions", F.lit("")),
        _rule(shape, has_questions & ~F.coalesce(F.col("total_pages") >= 1, F.lit(False)), "total_pages", F.col("total_pages")),
        _rule(rows, F.col("qid").isNull(), "question_id", F.col("position")),
        _rule(
            rows.filter("qid is not null").groupBy("contract", "qid").agg(F.count(F.lit(1)).alias("n")),
            F.col("n") > 1, "duplicate_question_id", F.col("n"),
        ),
        _rule(rows, ~F.coalesce(F.col("type").isin(*QUESTION_TYPES), F.lit(False)), "unsupported_type", F.col("type")),
        _rule(rows, off_page, "page_range", F.col("page")),
    ])


def _coded(rows: DataFrame) -> DataFrame:
    """(contract, qid, list_name, code) for options, rows and columns."""
    lists = F.array(*[
        F.struct(F.lit(name).alias("list_name"), F.try_variant_get("question", f"$.{name}", "array<variant>").alias("items"))
        for name in ("options", "rows", "columns")
    ])
    each = rows.select("contract", "qid", F.inline(lists)).filter("items is not null")
    return each.select("contract", "qid", "list_name", F.explode("items").alias("item")).select(
        "contract", "qid", "list_name", "item", F.try_variant_get("item", "$.code", "string").alias("code")
    )


def contract_code_rules(contracts: DataFrame) -> DataFrame:
    """Option and column codes must be there, differ, and differ by more than case."""
    coded = _coded(_questions(contracts)).filter("list_name <> 'rows'")
    groups = coded.filter("code <> ''").groupBy("contract", "qid", "list_name", F.lower("code").alias("folded")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("code").alias("spellings")
    )
    return union_all([
        _rule(coded, F.coalesce(F.col("code"), F.lit("")) == "", "empty_code", F.col("list_name")),
        _rule(groups, F.col("n") > F.col("spellings"), "duplicate_code", F.col("folded")),
        _rule(groups, F.col("spellings") > 1, "codes_differ_by_case", F.col("folded")),
    ])


def contract_lint_strict(contracts: DataFrame) -> DataFrame:
    """Structural rules and depends_on checks on top of types, ids and pages."""
    rows = _questions(contracts).withColumns({
        name: F.coalesce(F.size(F.try_variant_get("question", f"$.{name}", "array<variant>")), F.lit(0))
        for name in ("rows", "columns")
    } | {
        "expected": F.try_variant_get("question", "$.expected_data_rows", "int"),
        "options": F.try_variant_get("question", "$.options", "array<variant>"),
    })
    headers = F.size(F.filter(
        F.coalesce(F.try_variant_get("question", "$.rows", "array<variant>"), F.array().cast("array<variant>")),
        lambda row: F.try_variant_get(row, "$.group_header", "variant").isNotNull(),
    ))
    rows = rows.withColumn("data_rows", F.col("rows") - headers)
    matrix, grid = F.col("type") == "matrix", F.col("type") == "device_grid"
    all_exclusive = F.col("options").isNotNull() & (F.size("options") > 0) & F.forall(
        "options", lambda option: F.coalesce(F.try_variant_get(option, "$.exclusive", "boolean"), F.lit(False))
    )
    repeated = _coded(rows).filter("code is not null").groupBy("contract", "qid", "list_name", "code").agg(F.count(F.lit(1)).alias("n"))
    limit = F.coalesce("total_pages", F.lit(1))
    structure = [
        _rule(rows.groupBy("contract", "qid").agg(F.count(F.lit(1)).alias("n")), F.col("n") > 1, "duplicate_question_id", F.col("n")),
        _rule(rows, ~F.coalesce(F.col("type").isin(*QUESTION_TYPES), F.lit(False)), "unsupported_type", F.col("type")),
        _rule(repeated, F.col("n") > 1, "duplicate_code", F.concat_ws(":", "list_name", "code")),
        _rule(rows, all_exclusive, "all_options_exclusive", F.lit("")),
        _rule(rows, matrix & (F.col("columns") == 0), "matrix_without_columns", F.lit("")),
        _rule(rows, matrix & (F.col("data_rows") == 0), "matrix_without_rows", F.lit("")),
        _rule(rows, matrix & F.col("expected").isNull(), "expected_data_rows_missing", F.lit("")),
        _rule(rows, matrix & (F.col("expected") != F.col("data_rows")), "expected_data_rows", F.concat_ws("!=", "data_rows", "expected")),
        _rule(rows, grid & ((F.col("rows") == 0) | (F.col("columns") == 0)), "grid_incomplete", F.lit("")),
        _rule(rows, F.col("per_page") & ~A.absent(F.try_variant_get("question", "$.page", "variant")), "per_page_with_page", F.col("page")),
        _rule(rows, ~F.col("per_page") & ~F.coalesce(F.col("page").between(1, limit), F.lit(False)), "page_range", F.col("page")),
    ]
    return union_all([*structure, *_depends_rules(rows)])


def _depends_rules(rows: DataFrame) -> list[DataFrame]:
    question = F.col("question")
    operators = (*DEPENDS_SCALAR, *DEPENDS_LIST)
    used = F.filter(F.array(*[F.lit(name) for name in operators]), lambda name: F.array_contains(F.col("keys"), name))
    dependent = (
        rows.select("contract", "qid", F.try_variant_get(question, "$.depends_on", "variant").alias("depends"))
        .filter(~A.absent(F.col("depends")))
        .select(
            "contract", "qid", "depends", F.try_variant_get("depends", "$.question", "string").alias("target"),
            F.map_keys(F.try_variant_get("depends", "$", "map<string,variant>")).alias("keys"),
        )
        .withColumn("operators", used)
    )
    components = F.try_variant_get(question, "$.components", "array<variant>")
    own = rows.select("contract", F.col("qid").alias("target"), question.alias("target_question"))
    parts = rows.filter("type = 'composite'").select("contract", F.explode(components).alias("target_question")).select(
        "contract", F.try_variant_get("target_question", "$.id", "string").alias("target"), "target_question"
    )
    targets = own.unionByName(parts).dropDuplicates(["contract", "target"])
    options = F.coalesce(F.try_variant_get("target_question", "$.options", "array<variant>"), F.array().cast("array<variant>"))
    codes = F.filter(
        F.concat(
            F.transform(options, lambda option: F.try_variant_get(option, "$.code", "string")),
            F.array(F.try_variant_get("target_question", "$.extra_option.code", "string")),
        ),
        lambda code: code.isNotNull(),
    )
    known = dependent.join(targets.withColumn("codes", codes).drop("target_question"), ["contract", "target"])
    operator = F.try_element_at("operators", F.lit(1))
    raw = F.lit(None).cast("variant")
    for name in operators:
        raw = F.when(operator == name, F.try_variant_get("depends", f"$.{name}", "variant")).otherwise(raw)
    single = known.filter(F.size("operators") == 1).withColumns({"operator": operator, "raw": raw})
    wants_list = F.col("operator").isin(*DEPENDS_LIST)
    values = F.when(wants_list & ~A.is_array(F.col("raw")), F.array().cast("array<string>")).otherwise(A.text_members(F.col("raw")))
    unknown = F.array_except(values, F.col("codes"))
    return [
        _rule(dependent.join(targets, ["contract", "target"], "left_anti"), F.lit(True), "depends_on_missing_question", F.col("target")),
        _rule(known, F.size("operators") != 1, "depends_on_operator", F.array_join("operators", ",")),
        _rule(single, wants_list & ~A.is_array(F.col("raw")), "depends_on_needs_list", F.col("operator")),
        _rule(single, (F.size("codes") > 0) & (F.size(unknown) > 0), "depends_on_unknown_code", F.array_join(unknown, ",")),
    ]


def export_field_count(contracts: DataFrame) -> DataFrame:
    """Fields each question adds to an exported record: (contract, qid, n_fields)."""
    def length(variant: Column, path: str) -> Column:
        found = F.try_variant_get(variant, path, "variant")
        listed = F.size(F.try_variant_get(found, "$", "array<variant>"))
        return F.when(A.absent(found), 0).when(A.is_array(found), listed).otherwise(1)

    def members(variant: Column, path: str) -> Column:
        return F.coalesce(F.try_variant_get(variant, path, "array<variant>"), F.array().cast("array<variant>"))

    def truthy(variant: Column, path: str) -> Column:
        return F.coalesce(F.try_variant_get(variant, path, "boolean"), F.lit(False))

    def present(variant: Column, path: str) -> Column:
        return F.try_variant_get(variant, path, "variant").isNotNull()

    def count(item: Column, nested: bool) -> Column:
        kind = F.try_variant_get(item, "$.type", "string")
        options = members(item, "$.options")
        plain = (
            F.lit(1) + length(item, "$.subfield") + length(item, "$.derived_subfield")
            + F.size(F.filter(options, lambda option: present(option, "$.subfield")))
            + F.size(F.filter(options, lambda option: truthy(option, "$.other_text")))
        )
        rows = F.filter(members(item, "$.rows"), lambda row: ~present(row, "$.group_header"))
        content = F.try_variant_get(item, "$.row_content_column", "variant")
        matrix = (
            F.size(rows) * F.when(A.absent(content), 1).otherwise(2)
            + F.size(F.filter(rows, lambda row: truthy(row, "$.other_text")))
        )
        grid = F.size(members(item, "$.rows")) + F.when(present(item, "$.extra_option"), 1).otherwise(0)
        total = F.when(kind == "matrix", matrix).when(kind == "device_grid", grid)
        if nested:
            parts = F.transform(members(item, "$.components"), lambda part: count(part, nested=False))
            total = total.when(kind == "composite", F.aggregate(parts, F.lit(0), lambda acc, n: acc + n))
        return total.otherwise(plain)

    rows = _questions(contracts)
    n = F.when(F.col("per_page"), F.coalesce("total_pages", F.lit(1))).otherwise(count(F.col("question"), nested=True))
    return rows.select("contract", "position", "qid", n.alias("n_fields"))


# ---- records --------------------------------------------------------------------------------------

def _containers(question) -> dict[str, list[str]]:
    """Container name to the members the contract requires in it."""
    kind = question["type"]
    wanted: dict[str, list[str]] = {}
    if kind == "composite":
        wanted["components"] = [part["id"] for part in question.get("components", [])]
    elif kind in ("matrix", "device_grid"):
        wanted["rows"] = row_codes(question)
    for container in ("subfield", "derived_subfield"):
        names = [part["id"] for part in as_list(question.get(container))]
        if names:
            wanted[container] = names
    return wanted


def _option_subfields(question) -> list[tuple[str, str]]:
    if question["type"] != "single_select":
        return []
    return [(option["code"], option["subfield"]["id"]) for option in question.get("options", []) if option.get("subfield")]


def _row_content(question) -> str | None:
    content = question.get("row_content_column") or {}
    return content["code"] if content and not content.get("skip_extraction") else None


def _name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _shape(question) -> str:
    """Type of a question's entry for its completeness: names in the entry, names in its containers and, where rows have
    content, in the rows. What is no object there is NULL, and nothing below the names is kept."""
    row = f"map<string,{_LEAF}>" if _row_content(question) else _LEAF
    return f"map<string,map<string,{row}>>"


def _question_findings(question, i: int) -> list[Column]:
    """Completeness rules of one question as arrays of findings, over its prepared columns:
    _m the names in its entry and their members, _e the entry itself if it is no object."""
    qid = question["id"]
    entry, fields = F.col(f"_e{i}"), F.col(f"_m{i}")
    usable = fields.isNotNull()
    none = F.array().cast(FINDING_TYPE)
    # One branch per state of the entry, so a well-formed entry is tested once.
    state = (
        F.when(usable, none)
        .when(entry.isNull(), F.array(_finding(qid, qid, "missing_answer")))
        .when(F.is_variant_null(entry), F.array(_finding(qid, qid, "null_entry")))
        .otherwise(F.array(_finding(qid, qid, "entry_not_object", F.schema_of_variant(entry))))
    )
    out = [state]
    if question["type"] not in ("composite", "matrix", "device_grid"):
        out.append(_when(usable & ~F.map_contains_key(fields, "value"), _finding(qid, qid, "missing_value")))
    for container, names in _containers(question).items():
        box = F.try_element_at(fields, F.lit(container))
        wanted = F.array(*[F.lit(name) for name in names]).cast("array<string>")
        rule = {"components": "missing_component", "rows": "missing_row"}.get(container, f"missing_{container}")
        lacking = F.array_except(wanted, F.coalesce(F.map_keys(box), F.array().cast("array<string>")))
        if container in ("components", "rows"):
            out.append(_when(usable & box.isNull(), _finding(qid, f"{qid}.{container}", f"missing_{container}")))
            usable_box = box.isNotNull()
        else:
            usable_box = usable
        out.append(F.when(usable_box & (F.size(lacking) > 0), _each(lacking, qid, f"{qid}.{container}.", rule)).otherwise(none))
    content = _row_content(question)
    if content and "rows" in _containers(question):
        box = F.try_element_at(fields, F.lit("rows"))
        for code in _containers(question)["rows"]:
            cells = F.try_element_at(box, F.lit(code))
            lacking = box.isNotNull() & (~F.map_contains_key(box, code) | (cells.isNotNull() & ~F.map_contains_key(cells, content)))
            out.append(_when(lacking, _finding(qid, f"{qid}.rows.{code}", "missing_row_content", content)))
    for code, part in _option_subfields(question):
        chosen = F.array_contains(F.col(f"_v{i}"), code)
        held = F.coalesce(F.map_contains_key(F.try_element_at(fields, F.lit("subfield")), part), F.lit(False))
        out.append(_when(usable & F.coalesce(chosen, F.lit(False)) & ~held, _finding(qid, f"{qid}.subfield.{part}", "missing_option_subfield", code)))
    return out


def _completeness(records: DataFrame, contract: Contract, *keep: str) -> tuple[DataFrame, Column]:
    """The records' kept columns with what the rules look at, and the findings over them.

    One look at the answers takes the names in all entries the contract asks for; only an entry that is no object, and the
    value of one whose options ask for more, are looked up by themselves.
    """
    asked = list(enumerate(contract.answered_questions))
    notes_for = [question["id"] for question in contract.questions if question.get("per_page")]
    shape = ",".join(f"{_name(q['id'])}:{_shape(q)}" for _, q in asked)
    answers = F.try_variant_get("document", "$.answers", f"struct<{shape}>" if asked else f"map<string,{_LEAF}>")
    notes = F.try_variant_get("document", "$.page_notes", f"map<string,{_LEAF}>")
    parts = records.select(*keep, "document", answers.alias("_answers"), notes.alias("_notes"))

    def at(question, *path: str) -> Column:
        return A.path_lookup(F.col("document"), ["answers", question["id"], *path])

    names = {i: F.col("_answers").getField(q["id"]) for i, q in asked}
    parts = parts.select(
        *keep, F.col("_answers").isNull().alias("_none"), "_notes", *[names[i].alias(f"_m{i}") for i, _ in asked],
        *[F.when(names[i].isNull(), at(q)).alias(f"_e{i}") for i, q in asked],
        *[A.text_members(at(q, "value")).alias(f"_v{i}") for i, q in asked if _option_subfields(q)],
    )
    none = F.array().cast(FINDING_TYPE)
    per_question = [found for i, question in asked for found in _question_findings(question, i)]
    pages = F.array(*[F.lit(str(page)) for page in range(1, contract.total_pages + 1)])
    for qid in notes_for:
        lacking = F.array_except(pages, F.map_keys("_notes"))
        per_question.append(
            F.when(F.col("_notes").isNull(), F.array(_finding(qid, "page_notes", "missing_page_notes")))
            .when(F.size(lacking) > 0, _each(lacking, qid, "page_notes.", "missing_page_note")).otherwise(none)
        )
    return parts, F.when(F.col("_none"), F.array(_finding("", "answers", "missing_answers"))).otherwise(F.concat(*per_question, none))


def _inlined(found: DataFrame) -> DataFrame:
    """(record_id, _findings) to a row each. Findings are compiled as a column of their own, where the generator would interpret
    every rule; the coalesce keeps Spark from filtering by them first, which would work them out again."""
    return found.select("record_id", F.inline(F.coalesce("_findings", F.array().cast(FINDING_TYPE))))


def record_completeness(records: DataFrame, contract: Contract) -> DataFrame:
    """Everything the contract requires and a record lacks. Row-local: one scan, no shuffle."""
    parts, findings = _completeness(records, contract, "record_id")
    return _inlined(parts.select("record_id", findings.alias("_findings")))


def validate_records(records: DataFrame, contract: Contract) -> DataFrame:
    """Findings of scanned records, unreadable ones included; clean records are absent. One scan: what `corrupt_findings` says
    of an unreadable record stands in place of its completeness."""
    parts, findings = _completeness(records, contract, "record_id", "file_name", "error")
    text = F.lit(None).cast("string")
    corrupt = F.array(F.struct(text.alias("qid"), text.alias("path"), F.col("error").alias("rule"), F.col("file_name").alias("detail")))
    name = F.when(F.col("error").isNull(), F.col("record_id")).otherwise(F.coalesce("record_id", "file_name"))
    found = F.when(F.col("error").isNull(), findings).otherwise(corrupt)
    return _inlined(parts.select(name.alias("record_id"), found.alias("_findings")))


def finding_summary(findings: DataFrame) -> DataFrame:
    """Per record: number of findings and the rules broken."""
    return findings.groupBy("record_id").agg(
        F.count(F.lit(1)).alias("n_findings"), F.array_sort(F.collect_set("rule")).alias("rules")
    )


# ---- pages ----------------------------------------------------------------------------------------

def page_status(expected: Column, found: Column, source_missing: Column, unreadable: Column) -> dict[str, Column]:
    flag = (
        F.when(source_missing, "source_not_found").when(unreadable, "unreadable")
        .when(found < expected, "missing_page").when(found > expected, "extra_page")
    )
    return {
        "flag": flag,
        "status": F.when(flag.isNull(), "ok").when(flag.isin("missing_page", "extra_page"), "needs_review").otherwise("error"),
    }


def page_reconciliation(manifest: DataFrame, pages: DataFrame, total_pages: int, sources: DataFrame | None = None) -> DataFrame:
    """Expected against found pages per manifest record.

    manifest: (record_id, expected_pages text, may be blank). pages: (record_id, page_no). sources, if
    given, is an inventory (record_id, readable); without it a record lacking pages has no source.
    A page count that is no whole number is an error of that row only.
    """
    raw = F.trim(F.coalesce(F.col("expected_pages").cast("string"), F.lit("")))
    asked = manifest.select("record_id", raw.alias("_raw"), F.when(raw == "", F.lit(total_pages)).otherwise(recode.safe_int(raw)).alias("expected_pages"))
    found = pages.groupBy("record_id").agg(F.count(F.lit(1)).alias("found_pages"))
    rows = asked.join(found, "record_id", "left")
    if sources is None:
        no_source, unreadable = F.col("found_pages").isNull(), F.lit(False)
    else:
        rows = rows.join(sources.select("record_id", "readable", F.lit(True).alias("_has")), "record_id", "left")
        no_source, unreadable = F.col("_has").isNull(), ~F.coalesce("readable", F.lit(True))
    bad = F.col("expected_pages").isNull()
    n_found = F.when(no_source | unreadable | bad, F.lit(0)).otherwise(F.coalesce("found_pages", F.lit(0)))
    states = page_status(F.col("expected_pages"), n_found, no_source, unreadable)
    return rows.select(
        "record_id", "expected_pages", n_found.cast("bigint").alias("found_pages"),
        F.when(bad, "processing_error").otherwise(states["flag"]).alias("flag"),
        F.when(bad, "error").otherwise(states["status"]).alias("status"),
        F.when(bad, F.concat(F.lit("expected_pages is not a number: "), F.col("_raw"))).alias("error"),
    )


def page_set_check(pages: DataFrame, total_pages: int) -> DataFrame:
    """Page numbers must be exactly 1..N without repeats: findings (record_id, rule, pages).

    Counted per (record, page) first, so a record with very many pages never gathers in one row.
    """
    counts = pages.groupBy("record_id", "page_no").agg(F.count(F.lit(1)).alias("n"))
    valid = F.col("page_no").between(1, total_pages)
    per_record = counts.groupBy("record_id").agg(
        F.collect_set(F.when(valid, F.col("page_no"))).alias("_have"),
        F.count_if(F.col("page_no").isNull()).alias("no_number"),
        F.count_if(F.col("n") > 1).alias("repeated"), F.count_if(~valid).alias("outside"),
    )
    missing = F.size(F.array_except(F.array(*[F.lit(i) for i in range(1, total_pages + 1)]), F.col("_have")))
    rules = [
        ("page_not_integer", F.col("no_number")), ("duplicate_page", F.col("repeated")),
        ("unexpected_page", F.col("outside")), ("missing_page", missing),
    ]
    found = F.filter(F.array(*[F.struct(F.lit(rule).alias("rule"), n.cast("bigint").alias("pages")) for rule, n in rules]), lambda item: item.pages > 0)
    return per_record.select("record_id", F.inline(found))


# ---- readings -------------------------------------------------------------------------------------

def contract_codes(contract: Contract, spark) -> DataFrame:
    """Dimension (qid, type, allowed, exclusive), one row per question."""
    rows = [
        (q["id"], q["type"], allowed_codes(q), [o["code"] for o in q.get("options", []) if o.get("exclusive")])
        for q in contract.answered_questions
    ]
    return small_table(spark, rows, "qid string, type string, allowed array<string>, exclusive array<string>")


def multi_mark_rule(codes: Column, flags: Column) -> dict[str, Column]:
    """Single-choice marks: two or more keep the list and the flag, one unwraps, none is NULL."""
    several = F.size(codes) >= 2
    return {
        "codes": F.when(F.size(codes) > 0, codes),
        "flags": F.when(several, recode.add_flag(flags, MULTI_MARK)).otherwise(recode.remove_flag(flags, MULTI_MARK)),
    }


def normalise_readings(readings: DataFrame, codes: DataFrame) -> DataFrame:
    """Readings (record_id, qid, codes array<string>, flags array<string>) brought to contract spelling.

    Unknown codes are kept as read and flagged; the multi-mark flag is set or taken off by what is
    there; foreign flags are reported in bad_flags.
    """
    rows = readings.join(F.broadcast(codes), "qid", "left")
    allowed = F.coalesce("allowed", F.array().cast("array<string>"))
    invalid = F.when(F.col("codes").isNotNull(), recode.invalid_codes("codes", allowed))
    rows = rows.withColumns({"_codes": recode.canonical_codes("codes", allowed), "invalid": F.coalesce(invalid, F.array().cast("array<string>"))})
    single = F.col("type") == "single_select"
    rule = multi_mark_rule(F.col("_codes"), F.col("flags"))
    flags = F.when(single, rule["flags"]).otherwise(recode.remove_flag("flags", MULTI_MARK))
    return rows.select(
        *[name for name in readings.columns if name not in ("codes", "flags")],
        F.when(single, rule["codes"]).otherwise(F.col("_codes")).alias("codes"),
        F.when(F.size("invalid") > 0, F.array_union(flags, F.array(F.lit("invalid_option_code")))).otherwise(flags).alias("flags"),
        "invalid", F.array_except(recode.flags_of("flags"), F.array(*[F.lit(flag) for flag in CHOICE_READER_FLAGS])).alias("bad_flags"),
    )


def flag_ownership(readings: DataFrame, allowed: Sequence[str] = READER_FLAGS) -> DataFrame:
    """Flags a reader set without being entitled to: (record_id, qid, flag)."""
    foreign = F.array_except(recode.flags_of("flags"), F.array(*[F.lit(flag) for flag in allowed]))
    return readings.select("record_id", "qid", F.explode(foreign).alias("flag"))


def exclusive_conflict(readings: DataFrame, codes: DataFrame) -> DataFrame:
    """Readings in which an exclusive option stands beside others."""
    rows = readings.join(F.broadcast(codes), "qid")
    clash = F.arrays_overlap("codes", "exclusive") & (F.size(F.array_distinct("codes")) > 1)
    return rows.filter(clash).select(
        "record_id", "qid", F.lit("exclusive_conflict").alias("rule"), F.array_join(F.array_sort("codes"), "+").alias("detail")
    )


def skip_logic_conflict(readings: DataFrame, questions: DataFrame) -> DataFrame:
    """Answers present although the question they depend on rules them out.

    readings: (record_id, qid, codes). A target that was not answered rules nothing out. The two sides
    meet on (record_id, target question), so work spreads over records.
    """
    depends = questions.filter("depends_question is not null").select(
        "qid", "depends_question", "depends_operator", "depends_values"
    )
    answered = readings.filter(F.size("codes") > 0).select("record_id", "qid", "codes")
    given = answered.select("record_id", "qid").join(F.broadcast(depends), "qid")
    target = answered.select("record_id", F.col("qid").alias("depends_question"), F.col("codes").alias("_target"))
    overlap = F.arrays_overlap("_target", "depends_values")
    # A list never equals one code, so equals is false for several marks and not_equals true.
    equal = (F.size("_target") == 1) & overlap
    holds = (
        F.when(F.col("depends_operator").isin("equals", "in"), equal)
        .when(F.col("depends_operator").isin("not_equals", "not_in"), ~equal)
        .when(F.col("depends_operator") == "contains", overlap)
        .otherwise(~overlap)
    )
    return given.join(target, ["record_id", "depends_question"]).filter(~holds).select(
        "record_id", "qid", F.lit("skip_logic_conflict").alias("rule"),
        F.concat_ws(" ", "depends_question", "depends_operator", F.array_join("depends_values", "+")).alias("detail"),
    )


# ---- review state ---------------------------------------------------------------------------------

def needs_review_count(entries: DataFrame, nested: bool = False) -> DataFrame:
    """Entries awaiting review per record; nested also counts those inside components, rows, subfields.

    Both counts come from the same aggregate, so that Spark makes one for a query that asks for both: n_top <= n always
    holds, and naming them keeps either branch on the one shuffle."""
    top = F.col("path") == F.col("qid")
    counted = entries.groupBy("record_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(top).alias("n_top"), F.count_if("needs_review").alias("all_"), F.count_if(top & F.col("needs_review")).alias("top_")
    )
    if nested:
        return counted.filter((F.col("n_top") <= F.col("n")) & (F.col("top_") <= F.col("all_"))).select("record_id", F.col("all_").alias("n_needs_review"))
    return counted.filter((F.col("n_top") > 0) & (F.col("n") > 0) & (F.col("top_") <= F.col("all_"))).select("record_id", F.col("top_").alias("n_needs_review"))


def flagged_pages(entries: DataFrame, questions: DataFrame) -> DataFrame:
    """Pages holding flagged entries, each with the one to visit next (wrapping to the first).

    Distinct (record, page) rows only; a record has at most as many as the contract has pages.
    """
    pages = questions.filter("not per_page").select("qid", "page")
    flagged = entries.filter("needs_review").join(F.broadcast(pages), "qid")
    per_record = flagged.groupBy("record_id").agg(F.array_sort(F.collect_set("page")).alias("pages"))
    return per_record.select("record_id", "pages", F.explode("pages").alias("page")).select(
        "record_id", "page", next_flagged(F.col("pages"), F.col("page")).alias("next_page")
    )


def next_flagged(pages: Column, current: Column) -> Column:
    """The first flagged page after the current one, else the first flagged page."""
    return F.coalesce(F.try_element_at(F.filter(pages, lambda page: page > current), F.lit(1)), F.try_element_at(pages, F.lit(1)))


def review_backlog(counts: DataFrame, reviewed: DataFrame) -> DataFrame:
    """Open entries in records nobody has reviewed yet: (n_records, n_pending)."""
    pending = counts.join(reviewed.select("record_id"), "record_id", "left_anti")
    return pending.agg(F.count(F.lit(1)).alias("n_records"), F.coalesce(F.sum("n_needs_review"), F.lit(0)).alias("n_pending"))


def record_status(manifest: DataFrame, scanned: DataFrame) -> DataFrame:
    """pending / broken / flagged / clean per manifest record. scanned: (record_id, broken, n_needs_review)."""
    rows = manifest.select("record_id").join(scanned.withColumn("_seen", F.lit(True)), "record_id", "left")
    status = (
        F.when(F.coalesce("broken", F.lit(False)), "broken").when(F.col("_seen").isNull(), "pending")
        .when(F.col("n_needs_review") > 0, "flagged").otherwise("clean")
    )
    return rows.select("record_id", status.alias("status"), F.coalesce("n_needs_review", F.lit(0)).alias("n_needs_review"))
