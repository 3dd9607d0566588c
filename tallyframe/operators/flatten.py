"""Contract-driven projection: nested answers to wide columns or long rows, always one select."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions import answers as A
from tallyframe.functions import recode
from tallyframe.sources.contract import Contract, Field, allowed_codes, as_list, row_codes
from tallyframe.sources.dimensions import small_table

META_PREFIX = "meta__"


def field_column(item: Field, answers: Column) -> Column:
    entry = A.path_lookup(answers, item.path)
    if item.kind == "contains":
        return A.contains_code(entry, item.code).alias(item.column)
    return A.cell_join(entry).alias(item.column)


def flatten_records(
    records: DataFrame, contract: Contract, include_pii: bool = False, keep: Sequence[str] = (), option_extras: bool = False
) -> DataFrame:
    """(record_id, document) to one wide row per record. Personal fields are left out unless asked for."""
    hidden = set() if include_pii else set(contract.pii_fields)
    body = A.path_lookup(F.col("document"), ["answers"])
    parsed = records.select("record_id", *keep, body.alias("_answers"))
    columns = [field_column(item, F.col("_answers")) for item in contract.fields(option_extras) if item.qid not in hidden]
    return parsed.select("record_id", *keep, *columns)


def meta_prefix(manifest: DataFrame) -> DataFrame:
    names = {name: META_PREFIX + name for name in manifest.columns if name not in ("record_id", "source_path")}
    return manifest.withColumnsRenamed(names).drop("source_path")


def manifest_join(records: DataFrame, manifest: DataFrame, include_manifest_columns: bool = True) -> DataFrame:
    """Records with their manifest columns. Both sides grow with the survey, so the join is Spark's choice."""
    columns = meta_prefix(manifest) if include_manifest_columns else manifest.select("record_id")
    return records.join(columns, "record_id")


def manifest_orphans(records: DataFrame, manifest: DataFrame) -> DataFrame:
    """Records the manifest does not know."""
    return records.join(manifest.select("record_id"), "record_id", "left_anti").select("record_id")


def derived_columns(df: DataFrame, helpers: Mapping[str, Column]) -> DataFrame:
    """Named helper columns for an analysis; never written back."""
    return df.withColumns(dict(helpers))


def label_resolution(names: DataFrame, codebook: DataFrame, helper_labels: Mapping[str, str]) -> DataFrame:
    """(column) to (column, label): codebook first, then helper labels, then the name itself."""
    book = codebook.select("column", F.col("label").alias("_label"))
    return names.join(F.broadcast(book), "column", "left").select(
        "column", F.coalesce("_label", recode.mapped("column", helper_labels or {"": ""}), "column").alias("label")
    )


def codebook(contract: Contract, spark, section_of: Callable[[Mapping[str, Any]], str | None] | None = None) -> DataFrame:
    """Wide column to kind, label, section and options."""
    section_of = section_of or (lambda question: question.get("section"))
    rows = []
    for question in contract.answered_questions:
        options = [(str(o["code"]), o.get("label")) for o in question.get("options", []) or question.get("columns", []) if o.get("code")]
        names = {str(o["code"]): o.get("label", o["code"]) for part in ("options", "rows", "columns") for o in question.get(part, []) if o.get("code")}
        names |= {part["id"]: part.get("text", part["id"]) for part in question.get("components", [])}
        for item in Contract({"questions": [question]}).fields():
            tail = [names.get(part, part) for part in item.column.split("__")[1:]]
            kind = "binary" if item.kind == "contains" else "boolean" if item.kind == "raw" else (
                "categorical" if options or question["type"] in ("single_select", "matrix") else "text"
            )
            label = " — ".join([question.get("text", question["id"]), *tail])
            listed = [{"code": code, "label": text} for code, text in options] if kind == "categorical" else None
            rows.append((item.column, kind, label, section_of(question), listed))
    return small_table(spark, rows, "column string, kind string, label string, section string, options options")


# ---- long form ------------------------------------------------------------------------------------

_CONTAINER = r'"(' + "|".join(A.ENTRY_CONTAINERS) + r')"\s*:\s*\{'


_BOXES = "struct<" + ",".join(f"{name}:map<string,variant>" for name in A.ENTRY_CONTAINERS) + ">"
_HINTS = "struct<" + ",".join(f"{name}:string" for name in A.ENTRY_CONTAINERS) + ">"
_INNER_HINTS = "struct<" + ",".join(f"{name}:map<string,{_HINTS}>" for name in A.ENTRY_CONTAINERS) + ">"
_MEMBERS = "array<struct<key:string,value:variant>>"


def _nested(path: Column, entry: Column) -> Column:
    """The entries in an entry's containers, by their path."""
    def members(boxes: Column, name: str) -> Column:
        return F.transform(F.map_entries(boxes[name]), lambda item: F.struct(F.concat_ws(".", path, F.lit(name), item["key"]).alias("key"), item["value"].alias("value")))

    # The array of one gives the containers a name, so that they are looked up once.
    boxes = F.array(F.try_variant_get(entry, "$", _BOXES))
    return F.flatten(F.flatten(F.transform(boxes, lambda found: F.array_compact(F.array(*[members(found, name) for name in A.ENTRY_CONTAINERS])))))


def _deeper(qid: str, entry: str) -> Column:
    """The entries that are nested in a question's nested entries, by their path, walked level by level: the entries found last
    give the next ones, in no more levels than containers in the entry's text. NULL if no nested entry has containers."""
    hints = F.try_variant_get(entry, "$", _INNER_HINTS)
    inner = [F.map_values(hints[name])[box] for name in A.ENTRY_CONTAINERS for box in A.ENTRY_CONTAINERS]
    levels = F.sequence(F.lit(1), F.greatest(F.regexp_count(F.to_json(entry), F.lit(_CONTAINER)), F.lit(1)))

    def deeper(walked: Column, _: Column) -> Column:
        found = F.flatten(F.transform(walked["last"], lambda item: _nested(item["key"], item["value"])))
        return F.struct(found.alias("last"), F.concat(walked["all"], found).alias("all"))

    first = _nested(F.col(qid), F.col(entry))
    walk = F.aggregate(levels, F.struct(first.alias("last"), F.array().cast(_MEMBERS).alias("all")), deeper, lambda walked: walked["all"])
    return F.when(F.concat_ws("", *inner) != "", walk)


def answers_long(records: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """(record_id, keep..., qid, path, entry VARIANT): every question entry, and the entries nested in its components,
    rows and subfields at any depth; the entry that holds them has a row too. One narrow step, for streams as well.

    A question's entry and those in its containers are rows of their own by generators alone. Only a question with
    entries deeper than these is walked level by level."""
    rows = records.select(
        "record_id", *keep,
        F.explode(F.try_variant_get("document", "$.answers", "map<string,variant>")).alias("qid", "entry"),
    )
    rows = rows.select("record_id", *keep, "qid", "entry", _deeper("qid", "entry").alias("_deep"))

    def part(box: Column, members: Column) -> Column:
        return F.struct(box.alias("_box"), members.alias("_members"))

    own = F.array(F.struct(F.lit(None).cast("string").alias("key"), F.col("entry").alias("value")))
    parts = [part(F.lit(""), own), *[part(F.lit(name), F.map_entries(A.path_lookup(F.col("entry"), [name], "map<string,variant>"))) for name in A.ENTRY_CONTAINERS], part(F.lit(None).cast("string"), F.col("_deep"))]
    rows = rows.select("record_id", *keep, "qid", F.inline(F.array(*parts)))
    # The coalesce keeps Spark from working the members out a second time, as a filter.
    rows = rows.select("record_id", *keep, "qid", "_box", F.inline(F.coalesce("_members", F.array().cast(_MEMBERS))).alias("_key", "entry"))
    path = F.when(F.col("_box") == "", F.col("qid")).when(F.col("_box").isNull(), F.col("_key")).otherwise(F.concat_ws(".", "qid", "_box", "_key"))
    return rows.select("record_id", *keep, "qid", path.alias("path"), "entry")


def entry_parts(long: DataFrame) -> DataFrame:
    """Typed view of long entries: value text, confidence, flags, note, needs_review. An entry that holds others and has
    no value of its own has none here. Parts are looked up one by one: who asks for few pays for few."""
    kept = [name for name in long.columns if name != "entry"]
    part = lambda name, kind="variant": A.path_lookup(F.col("entry"), [name], kind)
    own = long.select(*kept, "entry", part("value").alias("_value"), part("flags", "array<string>").alias("_flags"), part("needs_review", "boolean").alias("_marked"))
    holds = F.col("_value").isNull() & reduce(Column.__or__, [part(name).isNotNull() for name in A.ENTRY_CONTAINERS])
    value = F.coalesce("_value", "entry")
    flags = recode.flags_of("_flags")
    return own.select(
        *kept,
        F.when(~holds, F.coalesce(F.array_join(F.try_variant_get(value, "$", "array<string>"), ";"), F.try_variant_get(value, "$", "string"))).alias("value"),
        part("confidence", "string").alias("confidence"),
        flags.alias("flags"),
        part("note", "string").alias("note"),
        # Repeated flags do not matter here.
        recode.needs_review("_flags", "_marked").alias("needs_review"),
    )


# ---- typed payloads and defaults ------------------------------------------------------------------

def _entry_type(value: str) -> str:
    return f"struct<value:{value},confidence:string,flags:array<string>,note:string>"


def contract_struct(contract: Contract, page: int | None = None) -> str:
    """DDL of the answers object a reading must have, for from_json."""
    parts = []
    for question in contract.answered_questions:
        if page is not None and question.get("page") != page:
            continue
        fields = []
        kind = question["type"]
        if kind == "composite":
            inner = ",".join(f"`{part['id']}`:{_entry_type('string')}" for part in question.get("components", []))
            fields.append(f"components:struct<{inner}>")
        elif kind in ("matrix", "device_grid"):
            content = question.get("row_content_column") or {}
            row_type = _entry_type("array<string>")
            if content and not content.get("skip_extraction"):
                row_type = row_type[:-1] + f",`{content['code']}`:string>"
            inner = ",".join(f"`{code}`:{row_type}" for code in row_codes(question))
            fields.append(f"rows:struct<{inner}>")
            if question.get("extra_option"):
                fields.append(f"`{question['extra_option']['code']}`:boolean")
        else:
            fields.append("value:array<string>" if kind == "multi_select" else "value:string")
            subfields = as_list(question.get("subfield")) + [o["subfield"] for o in question.get("options", []) if o.get("subfield")]
            for name, members in (("subfield", subfields), ("derived_subfield", as_list(question.get("derived_subfield")))):
                if members:
                    inner = ",".join(f"`{part['id']}`:{_entry_type('string')}" for part in members)
                    fields.append(f"{name}:struct<{inner}>")
            if any(option.get("other_text") for option in question.get("options", [])):
                fields.append("other_text:string")
        fields += ["confidence:string", "flags:array<string>", "note:string"]
        parts.append(f"`{question['id']}`:struct<{','.join(fields)}>")
    return f"struct<{','.join(parts)}>"


def payload_findings(records: DataFrame, contract: Contract, page: int | None = None) -> DataFrame:
    """Answers objects checked against the contract: missing questions, unknown questions, unknown codes."""
    questions = contract.page_slice(page) if page is not None else contract.answered_questions
    wanted = F.array(*[F.lit(question["id"]) for question in questions])
    entries = F.try_variant_get(A.path_lookup(F.col("document"), ["answers"]), "$", "map<string,variant>")
    found = F.coalesce(F.map_keys(entries), F.array().cast("array<string>"))

    def finding(qid: Column, rule: str, detail: Column) -> Column:
        return F.struct(qid.alias("qid"), F.lit(rule).alias("rule"), detail.alias("detail"))

    def unknown_codes(qid: str, codes: Column) -> Column:
        return F.transform(codes, lambda code: finding(F.lit(qid), "invalid_option_code", code))

    nothing = F.lit("")
    findings = [
        F.transform(F.array_except(wanted, found), lambda qid: finding(qid, "missing_question", nothing)),
        F.transform(F.array_except(found, wanted), lambda qid: finding(qid, "unexpected_question", nothing)),
    ]
    for question in questions:
        if question["type"] not in ("single_select", "multi_select"):
            continue
        codes = A.text_members(A.path_lookup(F.col("document"), ["answers", question["id"], "value"]))
        unknown = recode.invalid_codes(F.coalesce(codes, F.array().cast("array<string>")), allowed_codes(question))
        findings.append(unknown_codes(question["id"], unknown))
    return records.select("record_id", F.inline(F.concat(*findings)))


def _default_entry(question: Mapping[str, Any]) -> Any:
    kind = question["type"]
    if kind == "composite":
        entry: dict[str, Any] = {"components": {
            part["id"]: {"value": False if part.get("type") == "single_select" and len(part.get("options", [])) == 1 else None}
            for part in question.get("components", [])
        }}
    elif kind in ("matrix", "device_grid"):
        empty: Any = None if kind == "matrix" else []
        entry = {"rows": {code: {"value": empty} for code in row_codes(question)}}
        if kind == "device_grid" and question.get("extra_option"):
            entry[question["extra_option"]["code"]] = False
    else:
        entry = {"value": [] if kind == "multi_select" else None}
    if question.get("subfield"):
        entry["subfield"] = {part["id"]: {"value": None} for part in as_list(question["subfield"])}
    return entry


def empty_record(contract: Contract) -> dict[str, Any]:
    """Every answer present with its default; page notes present and null."""
    return {
        "schema_version": contract.schema_version,
        "answers": {question["id"]: _default_entry(question) for question in contract.answered_questions},
        "page_notes": {str(page): None for page in range(1, contract.total_pages + 1)},
    }


def densify(long: DataFrame, record_ids: DataFrame, contract: Contract) -> DataFrame:
    """Long entries for every record and question, missing ones filled with the contract's default.

    The questions ride along as a literal array, so the only shuffle is the join on (record_id, qid). Both sides grow with
    the survey, yet Spark takes what generators make of a row for no more rows than went in, and would broadcast all entries
    of large tables. The hint keeps the join sorted and merged.
    """
    import json

    defaults = F.array(*[
        F.struct(F.lit(q["id"]).alias("qid"), F.lit(json.dumps(_default_entry(q))).alias("default")) for q in contract.answered_questions
    ])
    slots = record_ids.select("record_id", F.inline(defaults))
    # Whether an entry is there travels apart from it: who asks for no more shuffles no entries.
    top = long.filter(F.col("path") == F.col("qid")).select("record_id", "qid", "entry", F.col("entry").isNull().alias("_void"))
    return slots.join(top.hint("merge"), ["record_id", "qid"], "left").select(
        "record_id", "qid", F.coalesce("entry", F.parse_json("default")).alias("entry"), F.coalesce("_void", F.lit(True)).alias("was_missing")
    )


# ---- scoped and full layouts ----------------------------------------------------------------------

@dataclass(frozen=True)
class Scope:
    """Which answers enter an analysis table, and how each is recoded.

    single: single-choice ids kept as (combo) codes. multi: id -> option codes as indicators.
    matrix: id -> row codes as (combo) codes. grid: id -> (rows, columns, extra option).
    recodes: output column -> builder taking the answers column, for buckets and numbers.
    """

    single: Sequence[str] = ()
    multi: Mapping[str, Sequence[str]] = field(default_factory=dict)
    matrix: Mapping[str, Sequence[str]] = field(default_factory=dict)
    grid: Mapping[str, tuple[Sequence[str], Sequence[str], str | None]] = field(default_factory=dict)
    recodes: Mapping[str, Callable[[Column], Column]] = field(default_factory=dict)
    separator: str = "_"


def flatten_scoped(records: DataFrame, scope: Scope, keep: Sequence[str] = ()) -> DataFrame:
    """Explicit-scope layout: only what the scope names."""
    answers = F.col("_answers")
    columns = {name: build(answers) for name, build in scope.recodes.items()}
    for qid in scope.single:
        columns.setdefault(qid, A.sorted_combo(A.path_lookup(answers, [qid])))
    for qid, codes in scope.multi.items():
        entry = A.path_lookup(answers, [qid, "value"])
        columns |= {scope.separator.join((qid, code)): A.contains_code(entry, code) for code in codes}
    for qid, rows in scope.matrix.items():
        columns |= {scope.separator.join((qid, row)): A.sorted_combo(A.path_lookup(answers, [qid, "rows", row])) for row in rows}
    for qid, (rows, grid_columns, extra) in scope.grid.items():
        for row in rows:
            cell = A.path_lookup(answers, [qid, "rows", row])
            members = F.coalesce(A.text_members(A.unwrap_value(cell)), F.array().cast("array<string>"))
            for code in grid_columns:
                columns[scope.separator.join((qid, row, code))] = F.when(
                    ~A.absent(cell), F.array_contains(members, code).cast("int")
                )
        if extra:
            columns[scope.separator.join((qid, extra))] = A.path_lookup(answers, [qid, extra], "boolean")
    parsed = records.select("record_id", *keep, A.path_lookup(F.col("document"), ["answers"]).alias("_answers"))
    return parsed.select("record_id", *keep, *[column.alias(name) for name, column in columns.items()])


def flatten_full(
    records: DataFrame,
    contract: Contract,
    drop_questions: Sequence[str] = (),
    drop_answers: Sequence[str] = (),
    drop_subfields: Sequence[str] = (),
    other_text_for: Sequence[str] = (),
    separator: str = "_",
) -> DataFrame:
    """Identity-keeping dump of every answer as written: lists joined by '; ', nothing recoded.

    drop_questions disappear entirely, drop_answers lose their own text but keep their subfields.
    """
    answers = F.col("_answers")
    columns: dict[str, Column] = {}

    def written(*path: str) -> Column:
        return A.cell_join(A.path_lookup(answers, path), "; ")

    for question in contract.answered_questions:
        qid, kind = question["id"], question["type"]
        if qid in drop_questions:
            continue
        if kind == "composite":
            columns |= {part["id"]: written(qid, "components", part["id"]) for part in question["components"]}
            continue
        if kind in ("matrix", "device_grid"):
            columns |= {separator.join((qid, row)): written(qid, "rows", row) for row in row_codes(question)}
            content = question.get("row_content_column") or {}
            if content and not content.get("skip_extraction"):
                for row in row_codes(question):
                    columns[separator.join((qid, row, content["code"]))] = A.path_lookup(answers, [qid, "rows", row, content["code"]], "string")
            if question.get("extra_option"):
                code = question["extra_option"]["code"]
                columns[separator.join((qid, code))] = A.path_lookup(answers, [qid, code], "string")
            continue
        if qid not in drop_answers:
            columns[qid] = written(qid)
        if qid in other_text_for:
            columns[f"{qid}_other_text"] = A.path_lookup(answers, [qid, "other_text"], "string")
        members = [("subfield", part) for part in as_list(question.get("subfield"))]
        members += [("subfield", o["subfield"]) for o in question.get("options", []) if o.get("subfield")]
        members += [("derived_subfield", part) for part in as_list(question.get("derived_subfield"))]
        columns |= {part["id"]: written(qid, box, part["id"]) for box, part in members if part["id"] not in drop_subfields}
    parsed = records.select("record_id", A.path_lookup(F.col("document"), ["answers"]).alias("_answers"))
    return parsed.select("record_id", *[column.alias(name) for name, column in columns.items()])


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
