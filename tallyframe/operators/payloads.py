"""Whole payloads against the contract: required members, shapes by question type, nullability, foreign fields and
codes, also inside components, rows and grids. Each record is checked in one narrow pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions import answers as A
from tallyframe.sources.contract import Contract, as_list, option_codes, row_codes

TEXT = ("STRING", "VOID")
LISTED = ("VOID", "ARRAY<VOID>", "ARRAY<STRING>")
#: Shapes a value may have, by question type.
SHAPES = {"text": TEXT, "free_text": TEXT, "single_select": (*TEXT, "ARRAY<VOID>", "ARRAY<STRING>"), "multi_select": LISTED}
FINDING = "array<struct<qid:string,rule:string,detail:string>>"


@dataclass(frozen=True)
class Slot:
    """What may stand at a place: a value of some shapes and codes, or an object of named members."""

    shapes: tuple[str, ...] = ()
    codes: tuple[str, ...] | None = None
    members: Mapping[str, Slot] = field(default_factory=dict)
    optional: frozenset[str] = frozenset()


def _entry(shapes: tuple[str, ...], codes: Sequence[str] | None, meta: Sequence[str], more: Mapping[str, Slot] = {}) -> Slot:
    slots = {"value": Slot(shapes, None if codes is None else tuple(codes)), **more}
    return Slot(members=slots | {name: Slot() for name in A.ENTRY_METADATA}, optional=frozenset(A.ENTRY_METADATA) - frozenset(meta))


def _scalar(question: Mapping[str, Any], meta: Sequence[str], more: Mapping[str, Slot] = {}) -> Slot:
    kind = question.get("type")
    if kind not in SHAPES:
        raise ValueError(f"no payload shape for question type {kind!r}")
    return _entry(SHAPES[kind], option_codes(question) if kind.endswith("_select") else None, meta, more)


def expected(question: Mapping[str, Any], meta: Sequence[str]) -> Slot:
    kind = question.get("type")
    told = {name: Slot() for name in A.ENTRY_METADATA}
    free = frozenset(A.ENTRY_METADATA) - frozenset(meta)
    if kind == "composite":
        return Slot(members=told | {"components": Slot(members={part["id"]: _scalar(part, meta) for part in question.get("components", [])})}, optional=free)
    if kind in ("matrix", "device_grid"):
        codes = [column["code"] for column in question.get("columns", []) if column.get("code")]
        members = told | {"rows": Slot(members={row: _entry(LISTED, codes, meta) for row in row_codes(question)})}
        extra = question.get("extra_option") or {}
        return Slot(members=members | ({extra["code"]: Slot(("BOOLEAN",))} if extra.get("code") else {}), optional=free)
    options = question.get("options", [])
    inner = {"subfield": [*as_list(question.get("subfield")), *(option["subfield"] for option in options if option.get("subfield"))], "derived_subfield": as_list(question.get("derived_subfield"))}
    more = {name: Slot(members={part["id"]: _entry(TEXT, None, meta) for part in parts}) for name, parts in inner.items() if parts}
    if any(option.get("other_text") for option in options):
        more["other_text"] = Slot(TEXT)
    return _scalar(question, meta, more)


def _found(qid: str, rule: str, detail: Column | str) -> Column:
    return F.struct(F.lit(qid).alias("qid"), F.lit(rule).alias("rule"), (F.lit(detail) if isinstance(detail, str) else detail).alias("detail"))


def _check(qid: str, slot: Slot, path: tuple[str, ...]) -> list[Column]:
    """Findings at and below a place; nothing is said below a place that is missing or has the wrong shape."""
    here, place = A.path_lookup(F.col("document"), ["answers", qid, *path]), ".".join(path)
    none = F.array().cast(FINDING)
    if not slot.members:
        out = []
        if slot.shapes:
            out.append(F.when(here.isNotNull() & ~F.schema_of_variant(here).isin(*slot.shapes), F.array(_found(qid, "wrong_shape", place))).otherwise(none))
        if slot.codes is not None:
            held = F.coalesce(A.text_members(here), F.array().cast("array<string>"))
            unknown = F.array_except(F.filter(held, lambda code: code.isNotNull()), F.array(*map(F.lit, slot.codes)).cast("array<string>"))
            fits = F.schema_of_variant(here).isin(*slot.shapes)
            out.append(F.when(fits, F.transform(unknown, lambda code: _found(qid, "invalid_option_code", F.concat_ws(":", F.lit(place), code)))).otherwise(none))
        return out
    keys = F.map_keys(A.fields_of(here))
    wanted = [name for name in slot.members if name not in slot.optional]
    named = lambda rule: lambda name: _found(qid, rule, F.concat_ws(".", *map(F.lit, path), name))
    out = [
        F.when(here.isNotNull() & keys.isNull(), F.array(_found(qid, "not_an_object", place))).otherwise(none),
        F.when(keys.isNotNull(), F.transform(F.array_except(F.array(*map(F.lit, wanted)).cast("array<string>"), keys), named("missing_member"))).otherwise(none),
        F.when(keys.isNotNull(), F.transform(F.array_except(keys, F.array(*map(F.lit, slot.members)).cast("array<string>")), named("unexpected_member"))).otherwise(none),
    ]
    for name, inner in slot.members.items():
        out += _check(qid, inner, (*path, name))
    return out


def strict_findings(records: DataFrame, contract: Contract, page: int | None = None, meta: Sequence[str] = ()) -> DataFrame:
    """(record_id, qid, rule, detail): every way in which a record's answers depart from the contract. meta names the
    reading fields (confidence, flags, note) that each entry has to carry; the others may be there."""
    questions = contract.page_slice(page) if page is not None else contract.answered_questions
    entries = A.fields_of(A.path_lookup(F.col("document"), ["answers"]))
    held = F.coalesce(F.map_keys(entries), F.array().cast("array<string>"))
    wanted = F.array(*[F.lit(question["id"]) for question in questions]).cast("array<string>")
    question = lambda rule: lambda qid: F.struct(qid.alias("qid"), F.lit(rule).alias("rule"), F.lit("").alias("detail"))
    found = [F.transform(F.array_except(wanted, held), question("missing_question")), F.transform(F.array_except(held, wanted), question("unexpected_question"))]
    for one in questions:
        found += _check(one["id"], expected(one, meta), ())
    return records.select("record_id", F.inline(F.concat(*[column.cast(FINDING) for column in found])))
