"""Contracts as data: a table (contract, document) of many versions or many forms, taken apart by Spark.

`Contract` compiles the one contract a run follows; these operators read a whole archive of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions import answers as A
from tallyframe.operators.quality import _questions

FIELD_TYPE = "array<struct<parts:array<string>,labels:array<string>,kind:string,path:array<string>,code:string>>"


def load_contracts(raw: DataFrame) -> DataFrame:
    """(contract, text) to (contract, document, error): a contract is an object with a questions array."""
    parsed = raw.select("contract", F.try_parse_json("text").alias("document"))
    listed = A.is_array(A.path_lookup(F.col("document"), ["questions"]))
    return parsed.select(
        "contract", "document", F.when(F.col("document").isNull(), "unreadable_json").when(~listed, "no_questions_array").alias("error")
    )


def _members(item: Column, name: str) -> Column:
    """A list of definitions, or a single one as a list."""
    found = F.try_variant_get(item, f"$.{name}", "variant")
    several = F.try_variant_get(found, "$", "array<variant>")
    return F.coalesce(several, F.when(~A.absent(found), F.array(found)), F.array().cast("array<variant>"))


def _text(item: Column, name: str) -> Column:
    return F.try_variant_get(item, f"$.{name}", "string")


def _label(item: Column, key: str) -> Column:
    return F.coalesce(_text(item, "label"), _text(item, "text"), _text(item, key))


def _field(parts: list[Column], labels: list[Column], kind: str, path: list[Column], code: Column | None = None) -> Column:
    return F.struct(
        F.array(*parts).cast("array<string>").alias("parts"), F.array(*labels).cast("array<string>").alias("labels"), F.lit(kind).alias("kind"),
        F.array(*path).cast("array<string>").alias("path"), (code if code is not None else F.lit(None)).cast("string").alias("code"),
    )


def _fields(question: Column, qid: Column, kind: Column) -> Column:
    """The output fields of one question, in order."""
    def coded(items: Column) -> Column:
        return F.filter(items, lambda item: F.coalesce(_text(item, "code"), F.lit("")) != "")

    rows, columns = coded(_members(question, "rows")), coded(_members(question, "columns"))
    none = F.array().cast(FIELD_TYPE)

    def inside(container: str, items: Column) -> Column:
        return F.transform(items, lambda part: _field([_text(part, "id")], [_label(part, "id")], "scalar", [qid, F.lit(container), _text(part, "id")]))

    cells = F.transform(rows, lambda row: _field([_text(row, "code")], [_label(row, "code")], "scalar", [qid, F.lit("rows"), _text(row, "code")]))
    grid = F.flatten(F.transform(rows, lambda row: F.transform(columns, lambda column: _field(
        [_text(row, "code"), _text(column, "code")], [_label(row, "code"), _label(column, "code")], "contains",
        [qid, F.lit("rows"), _text(row, "code")], _text(column, "code"),
    ))))
    options = F.transform(coded(_members(question, "options")), lambda option: _field(
        [_text(option, "code")], [_label(option, "code")], "contains", [qid], _text(option, "code")
    ))
    extra = F.transform(coded(_members(question, "extra_option")), lambda option: _field(
        [_text(option, "code")], [_label(option, "code")], "raw", [qid, _text(option, "code")]
    ))
    own = (
        F.when(kind == "composite", inside("components", _members(question, "components")))
        .when(kind == "matrix", F.concat(cells, extra)).when(kind == "device_grid", F.concat(grid, extra))
        .when(kind == "multi_select", options).otherwise(F.array(_field([], [], "scalar", [qid])))
    )
    return F.concat(none, own, *[inside(name, _members(question, name)) for name in ("subfield", "derived_subfield")])


def _each_field(contracts: DataFrame) -> DataFrame:
    questions = _questions(contracts).filter("not per_page and qid is not null")
    listed = _fields(F.col("question"), F.col("qid"), F.col("type"))
    return questions.select("contract", "position", "qid", "type", "question", F.posexplode(listed).alias("place", "f"))


def field_dictionary(contracts: DataFrame) -> DataFrame:
    """Output columns of every contract: (contract, position, place, column, kind, path, code)."""
    return _each_field(contracts).select(
        "contract", "position", "place", F.concat_ws("__", F.col("qid"), "f.parts").alias("column"), "f.kind", "f.path", "f.code"
    )


def codebook(contracts: DataFrame) -> DataFrame:
    """Kind, label and section of every output column: (contract, column, kind, label, section)."""
    question = F.col("question")
    coded = (F.size(_members(question, "options")) > 0) | F.col("type").isin("single_select", "matrix")
    kind = F.when(F.col("f.kind") == "contains", "binary").when(F.col("f.kind") == "raw", "boolean").when(coded, "categorical").otherwise("text")
    return _each_field(contracts).select(
        "contract", F.concat_ws("__", F.col("qid"), "f.parts").alias("column"), kind.alias("kind"),
        F.concat_ws(" — ", F.coalesce(_text(question, "text"), F.col("qid")), "f.labels").alias("label"), _text(question, "section").alias("section"),
    )
