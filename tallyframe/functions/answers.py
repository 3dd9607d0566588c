"""Answer entries as VARIANT: lookup, unwrapping, cells, indicators, canonical form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Keys of an entry that describe the reading, not the answer.
ENTRY_METADATA = ("confidence", "flags", "note")
ENTRY_CONTAINERS = ("components", "rows", "subfield", "derived_subfield")
#: Opening brackets up to which a value is written from the outside in.
SHALLOW = 3


def _step(name: str) -> str:
    return "['" + name.replace("\\", "\\\\").replace("'", "\\'") + "']"


def path_lookup(answers: Column, path: Sequence[str], as_type: str = "variant") -> Column:
    """Nested get. A missing key, or a step into something that is no object, is NULL."""
    return F.try_variant_get(answers, "$" + "".join(_step(str(name)) for name in path), as_type)


def absent(value: Column) -> Column:
    """Missing key and JSON null alike."""
    return value.isNull() | F.is_variant_null(value)


def fields_of(value: Column) -> Column:
    """An object as map<string,variant>, NULL for anything else."""
    return F.try_variant_get(value, "$", "map<string,variant>")


def is_object(value: Column) -> Column:
    return fields_of(value).isNotNull()


def is_array(value: Column) -> Column:
    return F.try_variant_get(value, "$", "array<variant>").isNotNull()


def unwrap_value(entry: Column) -> Column:
    """{value: x} gives x (also when x is null), anything else is taken as the value itself."""
    return F.coalesce(F.try_variant_get(entry, "$.value", "variant"), entry)


def text_members(value: Column) -> Column:
    """A JSON array as array<string>; a scalar as a one-element array; null or missing as NULL."""
    scalar = F.try_variant_get(value, "$", "string")
    return F.coalesce(F.try_variant_get(value, "$", "array<string>"), F.when(scalar.isNotNull(), F.array(scalar)))


def cell_join(entry: Column, separator: str = ";") -> Column:
    """Scalar text, or list members joined in list order."""
    value = unwrap_value(entry)
    return F.coalesce(F.array_join(F.try_variant_get(value, "$", "array<string>"), separator), F.try_variant_get(value, "$", "string"))


def contains_code(entry: Column, code: str) -> Column:
    """1/0 indicator, NULL when not answered. An empty list was answered, so it gives 0."""
    return (F.array_position(text_members(unwrap_value(entry)), code) > 0).cast("int")


def sorted_combo(entry: Column) -> Column:
    """Single-choice value; several marks become a sorted '+' combo, an empty list NULL."""
    members = F.filter(text_members(unwrap_value(entry)), lambda code: code.isNotNull())
    return F.when(F.size(members) > 0, F.array_join(F.array_sort(members), "+"))


def _members(node: Column, ignore: Sequence[str]) -> Column:
    """The members of an object without the ignored keys, or of an array, as nodes; empty for anything else."""
    path, value = node["path"], node["value"]
    kept = F.map_entries(F.map_filter(fields_of(value), lambda key, _: ~key.isin(*ignore)) if ignore else fields_of(value))

    def child(key: Column, member: Column, at: Column) -> Column:
        return F.struct(F.concat_ws(".", path, at.cast("string")).alias("path"), path.alias("parent"), key.alias("key"), member.alias("value"))

    items = F.try_variant_get(value, "$", "array<variant>")
    return F.coalesce(
        F.transform(kept, lambda entry, at: child(entry["key"], entry["value"], at)),
        F.transform(items, lambda item, at: child(F.lit(""), item, at)), F.array().cast("array<struct<path:string,parent:string,key:string,value:variant>>"),
    )


def canonical_value(value: str, ignore: Sequence[str] = ENTRY_METADATA) -> Column:
    """Order-insensitive, type-tagged text of the JSON value in a column, however deep it nests.

    Array order and the ignored keys do not matter; null, [] and missing stay distinct, as do 1, "1" and true. A number
    without a fraction is written without one.

    A value with few brackets is written from the outside in, an array's members sorted by text, an object's by key and behind the
    key's length. Any other is taken apart level by level, and its nodes are put together from the last to the first, so that
    each finds its members' texts. Plain expressions; the work is the square of a value's nodes at most."""
    found = F.transform(F.array(_part(F.col(value), ignore)), lambda part: _texted(part, ignore))
    return F.transform(found, lambda side: F.when(side["text"].isNotNull(), _canonical(side, ignore)))[0]


def _part(value: Column, ignore: Sequence[str]) -> Column:
    """A value, with its members by key if it is an object, without the ignored ones, and by place if it is an array."""
    fields = fields_of(value)
    kept = F.map_filter(fields, lambda key, _: ~key.isin(*ignore)) if ignore else fields
    return F.struct(value.alias("value"), kept.alias("fields"), F.try_variant_get(value, "$", "array<variant>").alias("items"))


def _texted(part: Column, ignore: Sequence[str]) -> Column:
    """A part beside the JSON text of its value, an object's without the ignored members."""
    text = F.to_json(part["value"])
    return F.struct(part.alias("part"), (F.when(part["fields"].isNotNull(), F.to_json(part["fields"])).otherwise(text) if ignore else text).alias("text"))


def _canonical(side: Column, ignore: Sequence[str]) -> Column:
    text = side["text"]
    shallow = F.regexp_count(text, F.lit(r"[\[{]")) <= SHALLOW
    written = F.when(_holds(text), _outside_in(side["part"], ignore, SHALLOW)).otherwise(_leaf(text))
    return F.when(shallow, written).otherwise(_level_by_level(side["part"]["value"], text, ignore))


def _holds(text: Column) -> Column:
    return text.startswith("{") | text.startswith("[")


def _leaf(text: Column) -> Column:
    plain = F.coalesce(text, F.lit("null"))
    return F.when(plain.endswith("0"), F.regexp_replace(plain, r"^(-?[0-9]+)\.0+$", "$1")).otherwise(plain)


def _keyed(member: Column) -> Column:
    return F.concat(F.length(member["key"]).cast("string"), F.lit(":"), member["key"], member["text"])


def _outside_in(part: Column, ignore: Sequence[str], levels: int) -> Column:
    """The canonical text of an object or array that nests in no more than that many levels."""
    is_map = part["fields"].isNotNull()
    named = F.coalesce(F.map_entries(part["fields"]), F.transform(part["items"], lambda item: F.struct(F.lit("").alias("key"), item.alias("value"))))
    nodes = F.transform(named, lambda item: F.struct(item["key"].alias("key"), item["value"].alias("value"), F.to_json(item["value"]).alias("text")))

    def inner(node: Column) -> Column:
        if levels <= 1:
            return _leaf(node["text"])
        # The array of one gives the part a name, so that it is taken once.
        inside = F.transform(F.array(_part(node["value"], ignore)), lambda found: _outside_in(found, ignore, levels - 1))[0]
        return F.when(_holds(node["text"]), inside).otherwise(_leaf(node["text"]))

    # One mention of what is inside, for objects and arrays alike: the expression grows with the levels and not with their power.
    members = F.sort_array(F.transform(nodes, lambda node: F.struct(node["key"].alias("key"), inner(node).alias("text"))))
    joined = F.array_join(F.transform(members, lambda member: F.when(is_map, _keyed(member)).otherwise(member["text"])), ",")
    return F.concat(F.when(is_map, "{").otherwise("["), joined, F.when(is_map, "}").otherwise("]"))


def _level_by_level(value: Column, plain: Column, ignore: Sequence[str]) -> Column:
    root = F.array(F.struct(F.lit("r").alias("path"), F.lit("").alias("parent"), F.lit("").alias("key"), value.alias("value")))
    levels = F.sequence(F.lit(1), F.greatest(F.regexp_count(plain, F.lit(r"[\[{]")), F.lit(1)))

    def deeper(walked: Column, _: Column) -> Column:
        found = F.flatten(F.transform(walked["last"], lambda node: _members(node, ignore)))
        return F.struct(found.alias("last"), F.concat(walked["all"], found).alias("all"))

    nodes = F.aggregate(levels, F.struct(root.alias("last"), root.alias("all")), deeper, lambda walked: F.reverse(walked["all"]))

    def written(done: Column, node: Column) -> Column:
        inner = F.array_sort(F.transform(F.filter(done, lambda other: other["parent"] == node["path"]), lambda other: F.struct(other["key"].alias("key"), other["text"].alias("text"))))
        text = (
            F.when(is_object(node["value"]), F.concat(F.lit("{"), F.array_join(F.transform(inner, _keyed), ","), F.lit("}")))
            .when(is_array(node["value"]), F.concat(F.lit("["), F.array_join(inner["text"], ","), F.lit("]")))
            .otherwise(_leaf(F.to_json(node["value"])))
        )
        return F.concat(done, F.array(F.struct(node["parent"].alias("parent"), node["key"].alias("key"), text.alias("text"))))

    nothing = F.array().cast("array<struct<parent:string,key:string,text:string>>")
    return F.aggregate(nodes, nothing, written, lambda done: F.element_at(done, -1)["text"])


def values_equal(left: str, right: str, ignore: Sequence[str] = ENTRY_METADATA) -> Column:
    """Texts that agree as written, but for the ignored members, are equal. Of the others only those that may still be equal are
    brought to canonical form: it differs from the text by the order of an array's members, the ignored members of inner
    objects and numbers with a fraction of zero."""
    found = F.transform(F.array(_part(F.col(left), ignore), _part(F.col(right), ignore)), lambda part: _texted(part, ignore))

    def judged(sides: Column) -> Column:
        one, two = sides[0]["text"], sides[1]["text"]
        both = F.concat(one, two)
        # Another order leaves a text as long as it was.
        lasting = (F.locate("{", F.substring(one, 2, 2**31 - 1)) == 0) & (F.locate("{", F.substring(two, 2, 2**31 - 1)) == 0) & ~both.contains(".0")
        apart = lasting & ((F.length(one) != F.length(two)) | ~both.contains("["))
        same = F.size(F.array_distinct(F.transform(sides, lambda side: _canonical(side, ignore)))) == 1
        return F.when(one.eqNullSafe(two), True).when(both.isNull() | apart, False).otherwise(same)

    return F.transform(F.array(found), judged)[0]
