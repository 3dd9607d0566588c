"""Registered queries: scans, contract-driven projection, privacy, sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalog.tables import (
    CONTRACT, LINE_NUMBERS, LINE_STATUSES, ORDER_LINES, ORDER_RECORDS, RETURN_FLAGS,
    order_documents, order_lines, order_records, table, tidy,
)
from tallyframe.functions import answers as A
from tallyframe.functions import recode as R
from tallyframe.operators import flatten, privacy
from tallyframe.plans.session import checkpoint_dir
from tallyframe.sources import records as scans
from tallyframe.sources import sinks
from tallyframe.sources.contract import Contract

QUERIES, ORACLES = {}, {}


def query(name, sql=None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def contract():
    return Contract(CONTRACT)


def scratch(spark) -> str:
    """A fresh folder below the shared one."""
    return f"{checkpoint_dir(spark).rstrip('/')}/scratch-{uuid.uuid4().hex}"


# ---- scans ----------------------------------------------------------------------------------------

def raw_documents(spark, sf_dir):
    """Documents as read from files, some of them damaged by the price of their order."""
    keys = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("R"), F.col("o_orderkey").cast("string")).alias("record_id"), F.col("o_totalprice").alias("price")
    )
    rows = order_documents(spark, sf_dir).join(keys, "record_id")
    price, body = F.col("price"), F.col("value")
    value = (
        F.when(price > 490000, F.substring(body, 1, 40)).when(price > 480000, F.concat(F.lit("["), body, F.lit("]")))
        .when(price > 470000, F.replace(body, F.lit('"record_id":"R'), F.lit('"record_id":"R ')))
        .when(price > 460000, F.regexp_replace(body, r'"record_id":"R\d+",', ""))
        .when(price > 450000, F.replace(body, F.lit('{"value":true}'), F.lit('{"value":NaN}'))).otherwise(body)
    )
    return rows.select(F.concat("record_id", F.lit(".json")).alias("file_name"), value.alias("value"))


def raw_records(spark, sf_dir):
    return scans.parse_records(raw_documents(spark, sf_dir))


RAW = """raw as (select 'R' || cast(o_orderkey as varchar) as stem, 'R' || cast(o_orderkey as varchar) || '.json' as file_name,
  case when o_totalprice > 490000 then 'unreadable_json' when o_totalprice > 480000 then 'root_not_object'
       when o_totalprice > 470000 then 'invalid_record_id' when o_totalprice > 460000 then null
       when o_totalprice > 450000 then 'unreadable_json' end as error,
  o_totalprice as price, o_orderkey from orders)"""


@query("src_record_id", f"""with {RAW} select file_name, case when price > 470000 and price <= 480000 then 'R ' || cast(o_orderkey as varchar) else stem end as record_id from raw""")
def src_record_id(spark, sf_dir):
    return raw_records(spark, sf_dir).select("file_name", "record_id")


@query("src_corrupt", f"""with {RAW} select case when error = 'invalid_record_id' then 'R ' || cast(o_orderkey as varchar) else stem end as record_id,
  cast(null as varchar) as qid, cast(null as varchar) as path, error as rule, file_name as detail from raw where error is not null""")
def src_corrupt(spark, sf_dir):
    return scans.corrupt_findings(raw_records(spark, sf_dir))


@query("src_strict_json", f"with {RAW} select coalesce(error, 'ok') as state, count(*) as n from raw group by 1")
def src_strict_json(spark, sf_dir):
    return raw_records(spark, sf_dir).groupBy(F.coalesce("error", F.lit("ok")).alias("state")).agg(F.count(F.lit(1)).alias("n"))


@query("src_records", f"""with {ORDER_RECORDS} select record_id, 6 + cast(o_totalprice <= 450000 as integer) + cast(order_id is not null as integer) as n_answers from order_answers""")
def src_records(spark, sf_dir):
    """Documents written one per line, then scanned back from storage."""
    path = scratch(spark)
    order_documents(spark, sf_dir).select("value").write.text(f"{path}/records.json")
    found = scans.valid_records(scans.scan_records(spark, path, one_per_line=True))
    entries = F.try_variant_get("document", "$.answers", "map<string,variant>")
    return found.select("record_id", F.size(entries).alias("n_answers"))


PAGES = """select 'R' || cast(l_orderkey as varchar) as record_id, l_linenumber as page_no from lineitem"""


def inventories(spark, sf_dir):
    """Page inventories as JSON text: one page per line number in use."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_set("l_linenumber")).alias("pages"))
    rows = table(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    page = F.transform(F.coalesce("pages", F.array().cast("array<int>")), lambda i: F.struct(
        F.lit("scan.pdf").alias("source_file"), F.lit("pdf_page").alias("kind"), F.concat(F.lit("p"), i.cast("string"), F.lit(".png")).alias("image_path"), i.alias("tentative_page")
    ))
    return rows.select(F.to_json(F.struct(
        F.concat(F.lit("R"), F.col("o_orderkey").cast("string")).alias("record_id"), F.lit(4).alias("expected_pages"), F.lit("ok").alias("status"), page.alias("pages")
    )).alias("value"))


@query("src_assembly", """with l as (select distinct l_orderkey, l_linenumber from lineitem)
select 'R' || cast(o_orderkey as varchar) as record_id, cast(4 as integer) as expected_pages, 'ok' as status, case when l_orderkey is not null then 'scan.pdf' end as source_file,
  case when l_orderkey is not null then 'pdf_page' end as kind, 'p' || cast(l_linenumber as varchar) || '.png' as image_path, l_linenumber as tentative_page
from orders left join l on l_orderkey = o_orderkey""")
def src_assembly(spark, sf_dir):
    return scans.parse_assembly(inventories(spark, sf_dir))


def manifest(spark, sf_dir):
    """A manifest row per order: customers repeat, some keys are blank."""
    return table(spark, sf_dir, "orders").select(
        F.when(F.col("o_totalprice") > 490000, " ").otherwise(F.concat(F.lit(" C"), F.col("o_custkey").cast("string"))).alias("record_id"),
        F.when(F.col("o_totalprice") < 5000, F.lit(None)).otherwise("scan.pdf").alias("source_path"),
    )


@query("src_manifest", """with m as (select case when o_totalprice > 490000 then '' else 'C' || cast(o_custkey as varchar) end as record_id, o_totalprice < 5000 as no_path from orders)
select record_id, 'blank_key' as rule, count(*) as n from m where record_id = '' or no_path group by 1
union all select record_id, 'duplicate_record_id', count(*) from m where record_id <> '' group by 1 having count(*) > 1""")
def src_manifest(spark, sf_dir):
    return scans.manifest_findings(manifest(spark, sf_dir))


@query("src_progress", "select doc_id, md5(text) as digest, lang from documents")
def src_progress(spark, sf_dir):
    """Texts with commas, quotes and line breaks, written as CSV and scanned back."""
    path = scratch(spark)
    sinks.write_wide(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), path, csv=True)
    return scans.scan_csv(spark, path).select(F.col("doc_id").cast("bigint").alias("doc_id"), F.md5("text").alias("digest"), "lang")


@query("src_wide_csv", "select p_partkey, p_name, p_size, p_retailprice from part")
def src_wide_csv(spark, sf_dir):
    path = f"{scratch(spark)}.csv"
    sinks.write_wide(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_retailprice"), path, csv=True)
    return scans.scan_wide(spark, path, "p_partkey bigint, p_name string, p_size int, p_retailprice double")


# ---- flatten --------------------------------------------------------------------------------------

def yes(condition: str) -> str:
    return f"case when {condition} then 'true' else 'false' end"


FLAT = {
    "status": "array_to_string(status_list, ';')",
    "priority": "priority_value",
    **{f"flags__{code}": f"case when flag_list is not null then cast(list_contains(flag_list, '{code}') as integer) end" for code in (*RETURN_FLAGS, "none")},
    "amount__total": "printf('%.2f', o_totalprice)",
    "amount__big": yes("o_totalprice > 250000"),
    **{f"lines__l{k}": f"replace(l{k}, '+', ';')" for k in LINE_NUMBERS},
    **{f"modes__{flag}__{status}": f"case when order_id is not null then {flag}_{status} end" for flag in RETURN_FLAGS for status in LINE_STATUSES},
    "modes__uniform": f"case when order_id is not null then {yes('uniform')} end",
    "placed": "strftime(o_orderdate, '%Y-%m-%d')",
    "placed__day": "cast(day(o_orderdate) as varchar)",
    "placed__year": "cast(year(o_orderdate) as varchar)",
}


def flat_sql(names) -> str:
    return f"with {ORDER_RECORDS} select record_id, {', '.join(f'{FLAT[name]} as {name}' for name in names)} from order_answers"


def flat_part(name, columns):
    @query(name, flat_sql(columns))
    def run(spark, sf_dir):
        return flatten.flatten_records(order_records(spark, sf_dir), contract()).select("record_id", *columns)


@query("flatten_records", flat_sql(FLAT))
def flatten_records(spark, sf_dir):
    return flatten.flatten_records(order_records(spark, sf_dir), contract())


flat_part("unwrap_value", ["status", "priority"])
flat_part("cell_join", ["status", "lines__l1"])
flat_part("one_hot_multi", [name for name in FLAT if name.startswith("flags__")])
flat_part("one_hot_grid", [name for name in FLAT if name.startswith("modes__") and name != "modes__uniform"])
flat_part("matrix_rows", [name for name in FLAT if name.startswith("lines__")])
flat_part("composite_fields", ["amount__total", "amount__big"])
flat_part("extra_option", ["modes__uniform"])
flat_part("subfields", ["placed", "placed__day", "placed__year"])


@query("flatten_scoped", f"""with {ORDER_RECORDS} select record_id, case when o_totalprice <= 450000 and o_orderpriority <> '4-NOT SPECIFIED' then upper(priority_code) end as priority_up,
  2026 - year(o_orderdate) as age, array_to_string(list_sort(status_list), '+') as status,
  {', '.join(f"{FLAT[f'flags__{code}']} as flags_{code}" for code in RETURN_FLAGS)}, l1 as lines_l1, l2 as lines_l2,
  {', '.join(f"{FLAT[f'modes__{flag}__{status}']} as modes_{flag}_{status}" for flag in ('A', 'N') for status in LINE_STATUSES)},
  case when order_id is not null then uniform end as modes_uniform from order_answers""")
def flatten_scoped(spark, sf_dir):
    scope = flatten.Scope(
        single=["status"], multi={"flags": list(RETURN_FLAGS)}, matrix={"lines": ["l1", "l2"]}, grid={"modes": (["A", "N"], list(LINE_STATUSES), "uniform")},
        recodes={
            "priority_up": lambda answers: F.upper(A.sorted_combo(A.path_lookup(answers, ["priority"]))),
            "age": lambda answers: R.age_from_year(A.path_lookup(answers, ["placed", "derived_subfield", "year", "value"], "string")),
        },
    )
    return flatten.flatten_scoped(order_records(spark, sf_dir), scope)


@query("flatten_full", f"""with {ORDER_RECORDS} select record_id, 'Customer ' || cast(o_custkey as varchar) as customer, array_to_string(status_list, '; ') as status,
  case when flag_list is not null then array_to_string(flag_list, '; ') end as flags, printf('%.2f', o_totalprice) as total, {yes('o_totalprice > 250000')} as big,
  {', '.join(f"replace(l{k}, '+', '; ') as lines_l{k}" for k in LINE_NUMBERS)},
  {', '.join(f"case when order_id is not null then concat_ws('; ', case when {flag}_F = 1 then 'F' end, case when {flag}_O = 1 then 'O' end) end as modes_{flag}" for flag in RETURN_FLAGS)},
  {FLAT['modes__uniform']} as modes_uniform, cast(year(o_orderdate) as varchar) as year from order_answers""")
def flatten_full(spark, sf_dir):
    return flatten.flatten_full(
        order_records(spark, sf_dir), contract(), drop_questions=["priority"], drop_answers=["placed"], drop_subfields=["day"]
    )


# One row per entry: questions, then nested entries with their path.
ENTRY_SQL = f"""entries as (
  select record_id, 'customer' as qid, 'customer' as path, 'Customer ' || cast(o_custkey as varchar) as value, false as review from order_answers
  union all select record_id, 'status', 'status', array_to_string(status_list, ';'), o_totalprice > 400000 and o_orderpriority <> '4-NOT SPECIFIED' and len(status_list) = 1 from order_answers
  union all select record_id, 'priority', 'priority', priority_value, false from order_answers where o_totalprice <= 450000
  union all select record_id, 'flags', 'flags', case when flag_list is not null then array_to_string(flag_list, ';') end, o_totalprice > 480000 from order_answers
  union all select record_id, 'amount', 'amount', null, false from order_answers
  union all select record_id, 'amount', 'amount.components.total', printf('%.2f', o_totalprice), false from order_answers
  union all select record_id, 'amount', 'amount.components.big', {yes('o_totalprice > 250000')}, false from order_answers
  union all select record_id, 'lines', 'lines', null, false from order_answers
  {' '.join(f"union all select record_id, 'lines', 'lines.rows.l{k}', replace(l{k}, '+', ';'), {'o_totalprice > 350000' if k == 1 else 'false'} from order_answers" for k in LINE_NUMBERS)}
  union all select record_id, 'modes', 'modes', null, false from order_answers where order_id is not null
  {' '.join(f"union all select record_id, 'modes', 'modes.rows.{flag}', concat_ws(';', case when {flag}_F = 1 then 'F' end, case when {flag}_O = 1 then 'O' end), false from order_answers where order_id is not null" for flag in RETURN_FLAGS)}
  union all select record_id, 'placed', 'placed', strftime(o_orderdate, '%Y-%m-%d'), false from order_answers
  union all select record_id, 'placed', 'placed.subfield.day', cast(day(o_orderdate) as varchar), false from order_answers
  union all select record_id, 'placed', 'placed.derived_subfield.year', cast(year(o_orderdate) as varchar), false from order_answers)"""


def entries(spark, sf_dir):
    return flatten.entry_parts(flatten.answers_long(order_records(spark, sf_dir)))


@query("answers_long", f"with {ORDER_RECORDS}, {ENTRY_SQL} select record_id, qid, path, value, review as needs_review from entries")
def answers_long(spark, sf_dir):
    return entries(spark, sf_dir).select("record_id", "qid", "path", "value", "needs_review")


@query("page_slice", f"""with {ORDER_RECORDS}, {ENTRY_SQL}, p(page, qid) as (values (1, 'customer'), (1, 'status'), (1, 'priority'), (1, 'flags'), (1, 'amount'), (2, 'lines'), (2, 'modes'), (2, 'placed'))
select p.page, e.qid, count(*) as n_entries from entries e join p on p.qid = e.qid group by 1, 2""")
def page_slice(spark, sf_dir):
    pages = contract().questions_frame(spark).filter("not per_page").select("qid", "page")
    return entries(spark, sf_dir).join(F.broadcast(pages), "qid").groupBy("page", "qid").agg(F.count(F.lit(1)).alias("n_entries"))


@query("contract_struct", f"""with {ORDER_RECORDS} select record_id, case when flag_list is not null then array_to_string(flag_list, ',') end as flags,
  replace(l1, '+', ',') as l1, case when order_id is not null then uniform end as uniform, strftime(o_orderdate, '%Y-%m-%d') as placed from order_answers""")
def contract_struct(spark, sf_dir):
    ddl = flatten.contract_struct(contract())
    rows = order_documents(spark, sf_dir).select("record_id", F.from_json("value", f"struct<answers:{ddl}>").alias("d"))
    a = F.col("d.answers")
    return rows.select(
        "record_id", F.array_join(a["flags"]["value"], ",").alias("flags"), F.array_join(a["lines"]["rows"]["l1"]["value"], ",").alias("l1"),
        a["modes"]["uniform"].alias("uniform"), a["placed"]["value"].alias("placed"),
    )


@query("empty_record", f"""with {ORDER_RECORDS} select record_id, qid, was_missing from (
  select record_id, 'priority' as qid, o_totalprice > 450000 as was_missing from order_answers
  union all select record_id, 'modes', order_id is null from order_answers
  union all select record_id, unnest(['customer', 'status', 'flags', 'amount', 'lines', 'placed']), false from order_answers)""")
def empty_record(spark, sf_dir):
    records = order_records(spark, sf_dir)
    return flatten.densify(flatten.answers_long(records), records, contract()).select("record_id", "qid", "was_missing")


@query("payload_validation", f"""with {ORDER_RECORDS} select record_id, 'priority' as qid, 'missing_question' as rule, '' as detail from order_answers where o_totalprice > 450000
union all select record_id, 'modes', 'missing_question', '' from order_answers where order_id is null""")
def payload_validation(spark, sf_dir):
    return flatten.payload_findings(order_records(spark, sf_dir), contract())


def order_manifest(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("R"), F.col("o_orderkey").cast("string")).alias("record_id"), F.lit("scan.pdf").alias("source_path"),
        F.col("o_orderpriority").alias("group"), F.date_format("o_orderdate", "yyyy").alias("wave"),
    )


@query("manifest_join", f"""with {ORDER_RECORDS} select record_id, array_to_string(status_list, ';') as status, o_orderpriority as meta__group, cast(year(o_orderdate) as varchar) as meta__wave
from order_answers where o_orderkey % 5 > 0""")
def manifest_join(spark, sf_dir):
    wide = flatten.flatten_records(order_records(spark, sf_dir), contract()).select("record_id", "status")
    return flatten.manifest_join(wide, order_manifest(spark, sf_dir).filter("cast(substr(record_id, 2) as bigint) % 5 > 0"))


@query("meta_prefix", "select 'R' || cast(o_orderkey as varchar) as record_id, o_orderpriority as meta__group, cast(year(o_orderdate) as varchar) as meta__wave from orders")
def meta_prefix(spark, sf_dir):
    return flatten.meta_prefix(order_manifest(spark, sf_dir))


@query("derived_columns", f"with {ORDER_LINES} select order_id, coalesce(list_contains(string_split(l1, '+'), 'A'), false) as starts_a, case when n_lines > 4 then 'long' else 'short' end as length, A_O = 1 or R_O = 1 as open from order_lines")
def derived_columns(spark, sf_dir):
    helpers = {
        "starts_a": R.combo_has("l1", ["A"], null_as=False), "length": F.when(F.col("n_lines") > 4, "long").otherwise("short"),
        "open": R.any_of_indicators("A_O", "R_O"),
    }
    return flatten.derived_columns(order_lines(spark, sf_dir), helpers).select("order_id", *helpers)


@query("label_resolution", f"""with {ORDER_RECORDS}, {ENTRY_SQL}, n as (select distinct qid as c from entries)
select c as column, case c when 'status' then 'Status' when 'customer' then 'Customer' when 'priority' then 'Priority' when 'placed' then 'Placed on' when 'amount' then 'Amount (helper)' else c end as label from n""")
def label_resolution(spark, sf_dir):
    names = entries(spark, sf_dir).select(F.col("qid").alias("column")).distinct()
    return flatten.label_resolution(names, flatten.codebook(contract(), spark), {"amount": "Amount (helper)"})


# ---- privacy --------------------------------------------------------------------------------------

@query("pii_projection", f"""with {ORDER_RECORDS} select record_id, 'answers,page_notes,record_id' as fields,
  concat_ws(',', 'amount', 'flags', 'lines', case when order_id is not null then 'modes' end, 'placed', case when o_totalprice <= 450000 then 'priority' end, 'status') as answers from order_answers""")
def pii_projection(spark, sf_dir):
    safe = privacy.pii_projection(order_records(spark, sf_dir), contract())

    def names(path):
        return F.array_join(F.array_sort(F.map_keys(F.try_variant_get("document", path, "map<string,variant>"))), ",")

    return safe.select("record_id", names("$").alias("fields"), names("$.answers").alias("answers"))


@query("pii_fields", "select 'R' || cast(o_orderkey as varchar) as record_id, 'customer' as qid, 'Customer ' || cast(o_custkey as varchar) as value from orders")
def pii_fields(spark, sf_dir):
    """The personal answers that the projection takes away."""
    personal = contract().questions_frame(spark).filter("pii").select("qid")
    long = flatten.answers_long(order_records(spark, sf_dir)).join(F.broadcast(personal), "qid", "left_semi")
    return flatten.entry_parts(long).select("record_id", "qid", "value")


@query("complete_cases", f"with {ORDER_LINES} select order_id, l1, l2, l3 from order_lines where l1 is not null and l2 is not null and l3 is not null")
def complete_cases(spark, sf_dir):
    return privacy.complete_cases(order_lines(spark, sf_dir), ["l1", "l2", "l3"]).select("order_id", "l1", "l2", "l3")


@query("scope_filter", "select l_returnflag as flag, l_linestatus as line, count(*) as n from lineitem group by 1, 2")
def scope_filter(spark, sf_dir):
    """Only declared variables reach the analysis; undeclared kinds and columns are refused first."""
    from tallyframe.operators.association import validate_kinds

    lines, declared = table(spark, sf_dir, "lineitem"), {"l_returnflag": "categorical", "l_linestatus": "binary"}
    validate_kinds(lines, declared)
    return lines.select(*declared).groupBy(F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("line")).agg(F.count(F.lit(1)).alias("n"))


def wanted_ids(spark, sf_dir):
    """Ids of the records behind large lines, with repeats, and some that no record has."""
    return table(spark, sf_dir, "lineitem").filter("l_quantity > 45").select(
        F.concat(F.when(F.col("l_discount") > 0.09, "X").otherwise("R"), F.col("l_orderkey").cast("string")).alias("record_id")
    )


WANTED = "wanted as (select case when l_discount > 0.09 then 'X' else 'R' end || cast(l_orderkey as varchar) as record_id from lineitem where l_quantity > 45)"


@query("record_subset", f"with {WANTED} select 'R' || cast(o_orderkey as varchar) as record_id from orders where 'R' || cast(o_orderkey as varchar) in (select record_id from wanted)")
def record_subset(spark, sf_dir):
    return privacy.record_subset(order_documents(spark, sf_dir), wanted_ids(spark, sf_dir)).select("record_id")


@query("unknown_ids", f"with {WANTED} select distinct record_id from wanted where record_id not in (select 'R' || cast(o_orderkey as varchar) from orders)")
def unknown_ids(spark, sf_dir):
    return privacy.unknown_ids(wanted_ids(spark, sf_dir), order_documents(spark, sf_dir))


# ---- sinks ----------------------------------------------------------------------------------------

@query("snk_safe_records", f"with {ORDER_RECORDS} select record_id, false as has_customer, cast(null as varchar) as images, strftime(o_orderdate, '%Y-%m-%d') as placed from order_answers")
def snk_safe_records(spark, sf_dir):
    path = scratch(spark)
    sinks.write_safe_records(privacy.pii_projection(order_records(spark, sf_dir), contract()), f"{path}/safe.json")
    document = F.try_parse_json("value")
    return spark.read.text(path, recursiveFileLookup=True).select(
        A.path_lookup(document, ["record_id"], "string").alias("record_id"), A.path_lookup(document, ["answers", "customer"]).isNotNull().alias("has_customer"),
        A.path_lookup(document, ["source_images"], "string").alias("images"), A.path_lookup(document, ["answers", "placed", "value"], "string").alias("placed"),
    )


@query("snk_wide", flat_sql(FLAT))
def snk_wide(spark, sf_dir):
    path = scratch(spark)
    sinks.write_wide(flatten.flatten_records(order_records(spark, sf_dir), contract()), path)
    return scans.scan_wide(spark, path)


@query("snk_results", "select 'frequencies' as family, 'l_returnflag ' || l_returnflag as item, count(*) as n from lineitem group by l_returnflag union all select 'descriptives', 'l_quantity', count(*) from lineitem")
def snk_results(spark, sf_dir):
    from tallyframe.operators.describe import descriptive_summary
    from tallyframe.operators.frequency import frequency_table

    path, lines = scratch(spark), table(spark, sf_dir, "lineitem")
    sinks.write_results({"frequencies": frequency_table(lines, ["l_returnflag"]), "descriptives": descriptive_summary(lines, ["l_quantity"])}, path)
    first = spark.read.parquet(f"{path}/frequencies").select(F.lit("frequencies").alias("family"), F.concat_ws(" ", "variable", "value").alias("item"), "n")
    second = spark.read.parquet(f"{path}/descriptives").select(F.lit("descriptives").alias("family"), F.col("variable").alias("item"), "n")
    return first.unionByName(second)


@query("snk_report_tables", f"""select 'data' as part, cast(null as varchar) as item, cast(count(*) as bigint) as n from order_c
union all select 'frequencies', 'status ' || status, count(*) from order_c group by status
union all select 'frequencies', 'size ' || coalesce(size, '(missing)'), count(*) from order_c group by size
union all select 'associations', 'status size', count(*) from order_c where size is not null""".replace("order_c", "(select o_orderstatus as status, case when o_totalprice < 100000 then 'small' else 'large' end as size from orders)"))
def snk_report_tables(spark, sf_dir):
    from tallyframe.plans.analyze import analyze_dataset, report_tables

    wide = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("record_id"), F.col("o_orderstatus").alias("status"),
        F.when(F.col("o_totalprice") < 100000, "small").otherwise("large").alias("size"),
    )
    tables = report_tables(wide, analyze_dataset(wide, {"status": "categorical", "size": "categorical"}))
    data = tables["data"].agg(F.lit("data").alias("part"), F.lit(None).cast("string").alias("item"), F.count(F.lit(1)).alias("n"))
    frequencies = tables["frequencies"].select(F.lit("frequencies").alias("part"), F.concat_ws(" ", "field", "value").alias("item"), F.col("count").alias("n"))
    associations = tables["associations"].select(F.lit("associations").alias("part"), F.concat_ws(" ", "variable_a", "variable_b").alias("item"), "n")
    return tidy(data.unionByName(frequencies).unionByName(associations))


# ---- payloads that break every rule ---------------------------------------------------------------

_PAYLOAD_FORM = {"questions": [
    {"id": "status", "page": 1, "type": "single_select", "options": [{"code": "F"}, {"code": "O"}, {"code": "P"}]},
    {"id": "note", "page": 1, "type": "text", "subfield": {"id": "day"}},
    {"id": "amount", "page": 1, "type": "composite", "components": [{"id": "big", "type": "single_select", "options": [{"code": "yes"}]}]},
    {"id": "grid", "page": 1, "type": "device_grid", "rows": [{"code": "r"}], "columns": [{"code": "F"}, {"code": "O"}], "extra_option": {"code": "none"}},
]}
#: Order number modulo 8: status, note, amount and grid, and what is wrong with them.
_PAYLOADS = {
    0: ('{"value":"%s"}', '{"value":null,"subfield":{"day":{"value":"1"}}}', '{"components":{"big":{"value":"yes"}}}', '{"rows":{"r":{"value":[]}},"none":true}', [("grid", None)]),
    1: ('{"value":["%s","Q"]}', '{"value":7,"subfield":{"day":{"value":"1"}}}', '{"components":{"big":{"value":"no"}}}', '{"rows":{"r":{"value":["F","Z"]}},"none":true}', [
        ("status", "invalid_option_code", "value:Q"), ("note", "wrong_shape", "value"), ("amount", "invalid_option_code", "components.big.value:no"), ("grid", "invalid_option_code", "rows.r.value:Z")]),
    2: ('{"value":{"x":"%s"}}', '{"value":"a"}', '{"components":{}}', '{"rows":{},"none":1}', [
        ("status", "wrong_shape", "value"), ("note", "missing_member", "subfield"), ("amount", "missing_member", "components.big"), ("grid", "missing_member", "rows.r"), ("grid", "wrong_shape", "none")]),
    3: ('{"value":"%s","more":1}', '"bare"', '{"components":[]}', '{"rows":{"r":{"value":"F"},"s":{"value":null}},"none":false}', [
        ("status", "unexpected_member", "more"), ("note", "not_an_object", ""), ("amount", "not_an_object", "components"), ("grid", "unexpected_member", "rows.s"), ("grid", "wrong_shape", "rows.r.value")]),
}


def _payload_rows(spark, sf_dir):
    kind = F.pmod(F.col("o_orderkey"), F.lit(8))
    text = F.lit('{"answers":{}}')
    for number, (*parts, _) in _PAYLOADS.items():
        body = ",".join(f'"{question["id"]}":{part}' for question, part in zip(_PAYLOAD_FORM["questions"], parts))
        text = F.when(kind == number, F.format_string('{"answers":{' + body + "}}", "o_orderstatus")).otherwise(text)
    extra = F.when(kind == 4, F.lit('{"answers":{"other":{"value":1}}}')).otherwise(text)
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("record_id"), F.parse_json(extra).alias("document"))


_PAYLOAD_SQL = [
    (number, *finding) for number, (*_, findings) in _PAYLOADS.items() for finding in findings if finding[1]
] + [(number, question["id"], "missing_question", "") for number in (4, 5, 6, 7) for question in _PAYLOAD_FORM["questions"]] + [(4, "other", "unexpected_question", "")]


@query("payload_rules", f"""with r(kind, qid, rule, detail) as (values {', '.join(str(row) for row in _PAYLOAD_SQL)})
select cast(o_orderkey as varchar) as record_id, qid, rule, detail from orders join r on o_orderkey % 8 = kind""")
def payload_rules(spark, sf_dir):
    """Missing, foreign and misshapen members and unknown codes, inside rows, grids and components too."""
    from tallyframe.operators.payloads import strict_findings
    from tallyframe.sources.contract import Contract

    return strict_findings(_payload_rows(spark, sf_dir), Contract(_PAYLOAD_FORM))
