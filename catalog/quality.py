"""Registered queries: contract lint, record checks, pages, readings, reconciliation, truth."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.records import ENTRY_SQL, RAW, contract, entries, raw_records
from catalog.tables import CONTRACT, ORDER_RECORDS, heavy, order_records, table, tidy
from tallyframe.operators import contracts, privacy, quality, reconcile
from tallyframe.sources.contract import Contract

QUERIES, ORACLES = {}, {}


def query(name, sql=None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


# ---- contracts: one small document per part, faulty by the part's columns --------------------------

def contract_texts(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    size, price = F.col("p_size"), F.col("p_retailprice")
    first = F.struct(
        F.when(size == 1, "").otherwise("a").alias("id"), F.when(F.col("p_type") == "ECONOMY", "single_select").otherwise(F.lower("p_type")).alias("type"), (size % 6).alias("page"),
        F.array(
            F.struct(F.lit("x").alias("code"), (size > 25).alias("exclusive")),
            F.struct(F.when(size % 10 == 3, "x").when(size % 10 == 4, "X").when(size % 10 == 5, "").otherwise("y").alias("code"), (size > 30).alias("exclusive")),
        ).alias("options"),
    )
    second = F.struct(
        F.when(size > 40, "a").otherwise("b").alias("id"), F.lit("matrix").alias("type"), F.lit(2).alias("page"),
        F.array(F.struct(F.lit("r1").alias("code")), F.struct(F.lit("r2").alias("code"))).alias("rows"),
        F.array(F.struct(F.lit("c1").alias("code"))).alias("columns"), F.when(size % 4 > 0, size % 4).alias("expected_data_rows"),
        F.struct(F.when(price > 1500, "zz").otherwise("a").alias("question"), F.when(size % 3 == 0, "x").alias("equals"),
                 F.when(size % 3 != 1, F.when(size % 5 == 0, "q").otherwise("x")).alias("in")).alias("depends_on"),
    )
    doc = F.struct(F.when(size != 50, 5).otherwise(0).alias("total_pages"), F.when(size < 50, F.array(F.to_json(first), F.to_json(second))).alias("qs"))
    text = F.concat(F.lit('{"total_pages":'), doc["total_pages"].cast("string"), F.lit(',"questions":['), F.coalesce(F.array_join(doc["qs"], ","), F.lit("")), F.lit("]}"))
    return part.select(F.concat(F.lit("C"), F.col("p_partkey").cast("string")).alias("contract"), text.alias("text"))


def part_contracts(spark, sf_dir):
    return contracts.load_contracts(contract_texts(spark, sf_dir)).select("contract", "document")


PARTS = """c as (select 'C' || cast(p_partkey as varchar) as contract, p_size as s, p_type, p_retailprice as price,
  case when p_size = 1 then null else 'a' end as q1, case when p_size > 40 then 'a' else 'b' end as q2,
  case when p_type = 'ECONOMY' then 'single_select' else lower(p_type) end as type1,
  case when p_size % 10 = 3 then 'x' when p_size % 10 = 4 then 'X' when p_size % 10 = 5 then '' else 'y' end as code2 from part)"""


@query("src_contract", """select 'C' || cast(p_partkey as varchar) as contract, case when p_retailprice > 1500 then 'no_questions_array' when p_type = 'ECONOMY' then 'unreadable_json' end as error from part""")
def src_contract(spark, sf_dir):
    """Contract texts, some cut short and some with their questions under another name."""
    dear, cheap = F.col("p_retailprice") > 1500, F.col("p_type") == "ECONOMY"
    keys = table(spark, sf_dir, "part").select(F.concat(F.lit("C"), F.col("p_partkey").cast("string")).alias("contract"), dear.alias("dear"), cheap.alias("cheap"))
    damaged = F.when(F.col("dear"), F.replace("text", F.lit('"questions"'), F.lit('"items"'))).when(F.col("cheap"), F.substring("text", 1, 20)).otherwise(F.col("text"))
    raw = contract_texts(spark, sf_dir).join(keys, "contract").select("contract", damaged.alias("text"))
    return contracts.load_contracts(raw).select("contract", "error")


FIELDS = """fields as (
  select contract, cast(0 as integer) as position, cast(0 as integer) as place, q1 as "column", 'scalar' as kind, q1 as path, type1, q1 as label from c where s < 50 and q1 is not null
  union all select contract, 1, unnest([0, 1]), q2 || unnest(['__r1', '__r2']), 'scalar', q2 || unnest(['.rows.r1', '.rows.r2']), 'matrix', q2 || unnest([' — r1', ' — r2']) from c where s < 50)"""


@query("field_dictionary", f"""with {PARTS}, {FIELDS} select contract, position, place, "column", kind, path, cast(null as varchar) as code from fields""")
def field_dictionary(spark, sf_dir):
    return contracts.field_dictionary(part_contracts(spark, sf_dir)).withColumn("path", F.array_join("path", "."))


@query("codebook", f"""with {PARTS}, {FIELDS} select contract, "column", 'categorical' as kind, label, cast(null as varchar) as section from fields""")
def codebook(spark, sf_dir):
    return contracts.codebook(part_contracts(spark, sf_dir))


@query("contract_lint", f"""with {PARTS}
select contract, cast(null as varchar) as qid, 'no_questions' as rule, '' as detail from c where s = 50
union all select contract, q1, 'question_id', '0' from c where s = 1
union all select contract, 'a', 'duplicate_question_id', '2' from c where s > 40 and s < 50
union all select contract, q1, 'unsupported_type', type1 from c where s < 50 and type1 <> 'single_select'
union all select contract, q1, 'page_range', cast(s % 6 as varchar) from c where s < 50 and s % 6 = 0""")
def contract_lint(spark, sf_dir):
    return quality.contract_lint(part_contracts(spark, sf_dir))


@query("contract_code_rules", f"""with {PARTS}
select contract, q1 as qid, 'empty_code' as rule, 'options' as detail from c where s < 50 and code2 = ''
union all select contract, q1, 'duplicate_code', 'x' from c where s < 50 and code2 = 'x'
union all select contract, q1, 'codes_differ_by_case', 'x' from c where s < 50 and code2 = 'X'""")
def contract_code_rules(spark, sf_dir):
    return quality.contract_code_rules(part_contracts(spark, sf_dir))


@query("contract_lint_strict", f"""with {PARTS}, d as (select *, q2 as qid, (s % 3 = 0) as has_eq, (s % 3 <> 1) as has_in, case when s % 5 = 0 then 'q' else 'x' end as in_value from c where s < 50)
select contract, 'a' as qid, 'duplicate_question_id' as rule, '2' as detail from d where s > 40
union all select contract, q1, 'unsupported_type', type1 from d where type1 <> 'single_select'
union all select contract, q1, 'duplicate_code', 'options:x' from d where code2 = 'x'
union all select contract, q1, 'all_options_exclusive', '' from d where s > 30
union all select contract, qid, 'expected_data_rows_missing', '' from d where s % 4 = 0
union all select contract, qid, 'expected_data_rows', '2!=' || cast(s % 4 as varchar) from d where s % 4 in (1, 3)
union all select contract, q1, 'page_range', cast(s % 6 as varchar) from d where s % 6 = 0
union all select contract, qid, 'depends_on_missing_question', case when price > 1500 then 'zz' else 'a' end from d where price > 1500 or s = 1
union all select contract, qid, 'depends_on_operator', concat_ws(',', case when has_eq then 'equals' end, case when has_in then 'in' end) from d where price <= 1500 and s <> 1 and has_eq = has_in
union all select contract, qid, 'depends_on_needs_list', 'in' from d where price <= 1500 and s <> 1 and has_in and not has_eq""")
def contract_lint_strict(spark, sf_dir):
    return quality.contract_lint_strict(part_contracts(spark, sf_dir))


@query("export_field_count", f"""with {PARTS} select contract, cast(0 as integer) as position, q1 as qid, cast(case when type1 = 'single_select' then 1 else 1 end as integer) as n_fields from c where s < 50
union all select contract, 1, q2, 2 from c where s < 50""")
def export_field_count(spark, sf_dir):
    return quality.export_field_count(part_contracts(spark, sf_dir))


# ---- records --------------------------------------------------------------------------------------

COMPLETENESS = """findings as (
  select record_id, 'priority' as qid, 'priority' as path, 'missing_answer' as rule, '' as detail from order_answers where o_totalprice > 450000
  union all select record_id, 'modes', 'modes', 'missing_answer', '' from order_answers where order_id is null
  union all select record_id, 'status', 'status', 'entry_not_object', 'STRING' from order_answers where o_orderpriority = '4-NOT SPECIFIED'
  union all select record_id, 'PAGE_NOTES', 'page_notes.2', 'missing_page_note', '2' from order_answers where o_orderstatus = 'P'
  {extra})"""
WIDER = """union all select record_id, 'amount', 'amount.components.tax', 'missing_component', 'tax' from order_answers
  union all select record_id, 'lines', 'lines.rows.l8', 'missing_row', 'l8' from order_answers
  union all select record_id, 'placed', 'placed.subfield.hour', 'missing_subfield', 'hour' from order_answers
  union all select record_id, 'status', 'status.subfield.why', 'missing_option_subfield', 'P' from order_answers where o_orderstatus = 'P' and o_orderpriority <> '4-NOT SPECIFIED'"""


def wider_contract():
    """The contract with more asked for than the documents hold."""
    import copy

    document = copy.deepcopy(CONTRACT)
    by_id = {question["id"]: question for question in document["questions"]}
    by_id["amount"]["components"].append({"id": "tax", "type": "text"})
    by_id["lines"]["rows"].append({"code": "l8"})
    by_id["placed"]["subfield"] = [{"id": "day"}, {"id": "hour"}]
    by_id["status"]["options"][2]["subfield"] = {"id": "why"}
    return Contract(document)


@query("record_completeness", f"with {ORDER_RECORDS}, {COMPLETENESS.format(extra=WIDER)} select * from findings")
def record_completeness(spark, sf_dir):
    return quality.record_completeness(order_records(spark, sf_dir), wider_contract())


@query("validate_records", f"""with {ORDER_RECORDS}, {RAW}, base as (select * from order_answers), {COMPLETENESS.format(extra='').replace('findings as', 'f1 as')},
f as (select f1.*, price, error from f1 join raw on raw.stem = f1.record_id where error is null
  union all select case when error = 'invalid_record_id' then 'R ' || cast(o_orderkey as varchar) else stem end, null, null, error, file_name, price, error from raw where error is not null)
select record_id, count(*) as n_findings, array_to_string(list_sort(list_distinct(list(rule))), ',') as rules from f group by 1""")
def validate_records(spark, sf_dir):
    summary = quality.finding_summary(quality.validate_records(raw_records(spark, sf_dir), contract()))
    return summary.withColumn("rules", F.array_join("rules", ","))


# ---- pages ----------------------------------------------------------------------------------------

def page_manifest(spark, sf_dir):
    """Expected page counts as text: blank, not a number, or a number by price."""
    price = F.col("o_totalprice")
    asked = F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "").when(price > 480000, "n/a").otherwise(
        F.concat(F.lit(" "), F.floor(price / 100000 + 1).cast("string")))
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("record_id"), asked.alias("expected_pages"))


def pages(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("record_id"), F.col("l_linenumber").alias("page_no"))


PAGE_STATUS = """m as (select cast(o_orderkey as varchar) as record_id, case when o_orderpriority = '4-NOT SPECIFIED' then cast(4 as bigint) when o_totalprice > 480000 then null
    else cast(floor(o_totalprice / 100000 + 1) as bigint) end as expected_pages from orders),
p as (select cast(l_orderkey as varchar) as record_id, count(*) as found from lineitem group by 1),
s as (select m.record_id, expected_pages, case when expected_pages is null then 0 else coalesce(found, 0) end as found_pages,
  case when expected_pages is null then 'processing_error' when found is null then 'source_not_found' when found < expected_pages then 'missing_page' when found > expected_pages then 'extra_page' end as flag
  from m left join p on p.record_id = m.record_id),
t as (select *, case when flag is null then 'ok' when flag in ('missing_page', 'extra_page') then 'needs_review' else 'error' end as status,
  case when flag = 'processing_error' then 'expected_pages is not a number: n/a' end as error from s)"""


@query("page_reconciliation", f"with {PAGE_STATUS} select * from t")
def page_reconciliation(spark, sf_dir):
    return quality.page_reconciliation(page_manifest(spark, sf_dir), pages(spark, sf_dir), 4)


@query("batch_isolation", f"with {PAGE_STATUS} select status, coalesce(flag, '') as flag, count(*) as n_records, count(error) as n_errors from t group by 1, 2")
def batch_isolation(spark, sf_dir):
    """Bad rows become error rows; all others are processed as usual."""
    rows = quality.page_reconciliation(page_manifest(spark, sf_dir), pages(spark, sf_dir), 4)
    return rows.groupBy("status", F.coalesce("flag", F.lit("")).alias("flag")).agg(F.count(F.lit(1)).alias("n_records"), F.count("error").alias("n_errors"))


@query("source_inventory", """select cast(l_orderkey as varchar) as record_id, 'scans/' || cast(min(l_linenumber) as varchar) || '.png' as path, count(distinct l_linenumber) as n_sources from lineitem group by l_orderkey""")
def source_inventory(spark, sf_dir):
    """First source per record in sorted order, from a listing of paths."""
    from tallyframe.sources.records import first_source

    listing = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("record_id"), F.concat(F.lit("scans/"), F.col("l_linenumber").cast("string"), F.lit(".png")).alias("path")
    ).distinct()
    return first_source(listing, ["path"])


@query("page_set_check", """with p as (select cast(l_orderkey as varchar) as record_id, l_linenumber as page, count(*) as n from lineitem group by 1, 2),
r as (select record_id, count(*) filter (where n > 1) as repeated, count(*) filter (where page > 3) as outside, 3 - count(*) filter (where page <= 3) as missing from p group by 1)
select record_id, 'duplicate_page' as rule, repeated as pages from r where repeated > 0
union all select record_id, 'unexpected_page', outside from r where outside > 0
union all select record_id, 'missing_page', missing from r where missing > 0""")
def page_set_check(spark, sf_dir):
    return quality.page_set_check(pages(spark, sf_dir), 3)


# ---- readings: code lists per question, with case drift, unknown codes and several marks ------------

CHOICES = {"questions": [
    {"id": "line", "page": 1, "type": "single_select", "options": [{"code": "F"}, {"code": "O"}]},
    {"id": "flags", "page": 1, "type": "multi_select", "options": [{"code": "A"}, {"code": "R"}, {"code": "none", "exclusive": True}]},
    {"id": "speed", "page": 2, "type": "single_select", "options": [{"code": "urgent"}, {"code": "slow"}], "depends_on": {"question": "flags", "contains": "A"}},
    {"id": "kind", "page": 2, "type": "single_select", "options": [{"code": "big"}, {"code": "small"}], "depends_on": {"question": "line", "not_equals": "F"}},
    {"id": "care", "page": 2, "type": "single_select", "options": [{"code": "yes"}], "depends_on": {"question": "line", "in": ["O"]}},
]}


def readings(spark, sf_dir):
    """(record_id, qid, codes, flags) per order."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.array_sort(F.collect_set("l_linestatus")).alias("line"), F.array_sort(F.collect_set("l_returnflag")).alias("flags"), F.max("l_discount").alias("discount")
    )
    rows = lines.join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    none = F.array().cast("array<string>")
    marked = F.when(F.col("discount") > 0.09, F.array(F.lit("multi_mark_on_single_select"), F.lit("odd_flag"))).otherwise(none)
    sides = F.array(
        F.struct(F.lit("line").alias("qid"), F.transform("line", lambda code: F.lower(code)).alias("codes"), marked.alias("flags")),
        F.struct(F.lit("flags").alias("qid"), F.when(F.col("o_totalprice") < 50000, F.array_append("flags", "none")).otherwise(F.reverse("flags")).alias("codes"), marked.alias("flags")),
        F.struct(F.lit("speed").alias("qid"), F.when(F.col("o_orderpriority") == "1-URGENT", F.array(F.lit("urgent"))).when(F.col("o_orderpriority") == "5-LOW", none).alias("codes"), none.alias("flags")),
        F.struct(F.lit("kind").alias("qid"), F.array(F.when(F.col("o_totalprice") > 300000, "big").otherwise("small")).alias("codes"), F.array(F.lit("needs_review")).alias("flags")),
        F.struct(F.lit("care").alias("qid"), F.when(F.col("o_orderpriority") == "2-HIGH", F.array(F.lit("yes"))).alias("codes"), none.alias("flags")),
    )
    return rows.select(F.col("o_orderkey").cast("string").alias("record_id"), F.inline(sides))


READINGS = """b as (select cast(o_orderkey as varchar) as record_id, list_sort(list_distinct(list(l_linestatus))) as line, list_sort(list_distinct(list(l_returnflag))) as fl,
    max(l_discount) as discount, any_value(o_totalprice) as price, any_value(o_orderpriority) as prio from lineitem join orders on l_orderkey = o_orderkey group by o_orderkey),
mk as (select *, case when discount > 0.09 then ['multi_mark_on_single_select', 'odd_flag'] else cast([] as varchar[]) end as marked from b)"""
CLEAN_FLAGS = """case when price < 50000 then list_concat(list_filter(fl, lambda c: c in ('A', 'R')), ['none']) else list_filter(fl, lambda c: c in ('A', 'R')) end"""


def normalised(spark, sf_dir):
    return quality.normalise_readings(readings(spark, sf_dir), quality.contract_codes(Contract(CHOICES), spark))


def listed(df, *names):
    return df.withColumns({name: F.array_join(name, ",") for name in names})


@query("multi_mark_rule", f"""with {READINGS}
select record_id, array_to_string(line, ',') as codes, case when len(line) > 1 then case when discount > 0.09 then 'multi_mark_on_single_select,odd_flag' else 'multi_mark_on_single_select' end
  else case when discount > 0.09 then 'odd_flag' else '' end end as flags from mk""")
def multi_mark_rule(spark, sf_dir):
    return listed(normalised(spark, sf_dir).filter("qid = 'line'").select("record_id", "codes", "flags"), "codes", "flags")


@query("invalid_code_retention", f"""with {READINGS}
select record_id, array_to_string(list_concat({CLEAN_FLAGS}, case when list_contains(fl, 'N') then ['N'] else cast([] as varchar[]) end), ',') as codes,
  concat_ws(',', case when discount > 0.09 then 'odd_flag' end, case when list_contains(fl, 'N') then 'invalid_option_code' end) as flags,
  case when list_contains(fl, 'N') then 'N' else '' end as invalid from mk""")
def invalid_code_retention(spark, sf_dir):
    rows = normalised(spark, sf_dir).filter("qid = 'flags'").select("record_id", "codes", "flags", "invalid")
    return listed(rows, "codes", "flags", "invalid")


@query("flag_ownership", f"""with {READINGS} select record_id, unnest(['line', 'flags']) as qid, 'odd_flag' as flag from mk where discount > 0.09""")
def flag_ownership(spark, sf_dir):
    return quality.flag_ownership(readings(spark, sf_dir))


@query("exclusive_conflict", f"""with {READINGS} select record_id, 'flags' as qid, 'exclusive_conflict' as rule, array_to_string(list_sort(list_append(fl, 'none')), '+') as detail from mk where price < 50000""")
def exclusive_conflict(spark, sf_dir):
    return quality.exclusive_conflict(readings(spark, sf_dir), quality.contract_codes(Contract(CHOICES), spark))


@query("skip_logic_conflict", f"""with {READINGS}
select record_id, 'speed' as qid, 'skip_logic_conflict' as rule, 'flags contains A' as detail from mk where prio = '1-URGENT' and not list_contains(fl, 'A')
union all select record_id, 'kind', 'skip_logic_conflict', 'line not_equals F' from mk where line = ['F']
union all select record_id, 'care', 'skip_logic_conflict', 'line in O' from mk where prio = '2-HIGH' and line <> ['O']""")
def skip_logic_conflict(spark, sf_dir):
    questions = Contract(CHOICES).questions_frame(spark)
    return quality.skip_logic_conflict(normalised(spark, sf_dir), questions)


# ---- review state ---------------------------------------------------------------------------------

@query("needs_review_state", f"with {ORDER_RECORDS}, {ENTRY_SQL} select record_id, path, review as needs_review from entries where qid in ('status', 'flags', 'lines')")
def needs_review_state(spark, sf_dir):
    return entries(spark, sf_dir).filter(F.col("qid").isin("status", "flags", "lines")).select("record_id", "path", "needs_review")


REVIEW = f"""{ORDER_RECORDS}, {ENTRY_SQL}, counts as (select record_id, count(*) filter (where review) as n_needs_review from entries group by 1)"""


@query("needs_review_count", f"with {REVIEW}, top as (select record_id, count(*) filter (where review) as n_top from entries where path = qid group by 1) select c.record_id, n_top, n_needs_review as n_nested from counts c join top on top.record_id = c.record_id")
def needs_review_count(spark, sf_dir):
    rows = entries(spark, sf_dir)
    top = quality.needs_review_count(rows).withColumnRenamed("n_needs_review", "n_top")
    return top.join(quality.needs_review_count(rows, nested=True).withColumnRenamed("n_needs_review", "n_nested"), "record_id")


@query("flagged_pages", f"""with {REVIEW}, g as (select distinct record_id, case when qid in ('lines', 'modes', 'placed') then 2 else 1 end as page from entries where review)
select record_id, cast(page as integer) as page, cast(coalesce((select min(h.page) from g h where h.record_id = g.record_id and h.page > g.page), (select min(h.page) from g h where h.record_id = g.record_id)) as integer) as next_page from g""")
def flagged_pages(spark, sf_dir):
    return quality.flagged_pages(entries(spark, sf_dir), contract().questions_frame(spark))


def reviewed(spark, sf_dir):
    return table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select(F.concat(F.lit("R"), F.col("o_orderkey").cast("string")).alias("record_id"))


@query("review_backlog", f"""with {REVIEW} select count(*) as n_records, cast(sum(n_needs_review) as bigint) as n_pending from counts
where record_id not in (select 'R' || cast(o_orderkey as varchar) from orders where o_orderstatus = 'F')""")
def review_backlog(spark, sf_dir):
    counts = quality.needs_review_count(entries(spark, sf_dir), nested=True)
    return quality.review_backlog(counts, reviewed(spark, sf_dir))


def statuses(spark, sf_dir):
    """Orders as manifest; of their documents the cheap ones are not there yet and some dear ones are broken."""
    price = F.col("o_totalprice")
    keys = table(spark, sf_dir, "orders").select(F.concat(F.lit("R"), F.col("o_orderkey").cast("string")).alias("record_id"), price.alias("price"))
    counts = quality.needs_review_count(entries(spark, sf_dir), nested=True)
    scanned = keys.filter("price >= 20000").join(counts, "record_id").select("record_id", (F.col("price") > 495000).alias("broken"), "n_needs_review")
    return quality.record_status(keys, scanned)


STATUS = f"""{REVIEW}, st as (select a.record_id, case when o_totalprice > 495000 then 'broken' when o_totalprice < 20000 then 'pending' when n_needs_review > 0 then 'flagged' else 'clean' end as status,
  case when o_totalprice < 20000 then 0 else n_needs_review end as n_needs_review from order_answers a join counts c on c.record_id = a.record_id)"""


@query("record_status", f"with {STATUS} select * from st")
def record_status(spark, sf_dir):
    return statuses(spark, sf_dir)


@query("review_filter", f"with {STATUS} select * from st where status in ('flagged', 'broken') and contains(lower(record_id), 'r12')")
def review_filter(spark, sf_dir):
    return privacy.review_filter(statuses(spark, sf_dir), ["flagged", "broken"], " R12 ")


# ---- two reads ------------------------------------------------------------------------------------

def reads(spark, sf_dir):
    """Two reads of two questions per order: reordered, contradicting, or with the second one missing."""
    price = F.col("o_totalprice")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    flags = F.when(priority == "1-URGENT", F.array(F.lit("ambiguous_mark"))).otherwise(F.array().cast("array<string>"))

    def entry(value, confidence, flag_list, note):
        return F.to_json(F.struct(value.alias("value"), F.lit(confidence).alias("confidence"), flag_list.alias("flags"), note.alias("note")), {"ignoreNullFields": "false"})

    pair_one, pair_two = F.array(status, F.lit("z")), F.when(price > 400000, F.array(status)).otherwise(F.array(F.lit("z"), status))
    nothing = F.lit(None).cast("string")
    rows = F.array(
        F.struct(F.lit(1).alias("page"), F.lit("status").alias("qid"), F.lit(1).alias("read_no"),
                 entry(F.when(price < 450000, status), "high", F.array().cast("array<string>"), F.when(status == "P", "unclear").otherwise(nothing)).alias("body")),
        F.struct(F.lit(1).alias("page"), F.lit("status").alias("qid"), F.when(price < 10000, 3).otherwise(2).alias("read_no"),
                 entry(F.when(price > 420000, "X").otherwise(status), "medium", F.array(F.lit("margin_note")), nothing).alias("body")),
        F.struct(F.lit(2).alias("page"), F.lit("marks").alias("qid"), F.lit(1).alias("read_no"),
                 entry(pair_one, "high", F.array(F.lit("multi_mark_on_single_select")), nothing).alias("body")),
        F.struct(F.lit(2).alias("page"), F.lit("marks").alias("qid"), F.lit(2).alias("read_no"), entry(pair_two, "low", flags, nothing).alias("body")),
    )
    orders = heavy(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("record_id"), F.inline(rows))
    return orders.filter("read_no < 3").select("record_id", "page", "qid", "read_no", F.parse_json("body").alias("entry"))


NOTE = reconcile.MISMATCH_NOTE
MERGED = f"""merged as (
  select cast(o_orderkey as varchar) as record_id, cast(1 as integer) as page, 'status' as qid, case when o_totalprice < 450000 then o_orderstatus end as value,
    case when o_totalprice >= 10000 then o_totalprice <= 420000 end as reads_match, 'high' as base, '' as base_flags, case when o_orderstatus = 'P' then 'unclear' end as base_note,
    case when o_totalprice < 10000 then 'read_2_missing' end as error from orders
  union all select cast(o_orderkey as varchar), 2, 'marks', o_orderstatus || ';z', o_totalprice <= 400000, 'high', 'multi_mark_on_single_select', null, null from orders),
full_merge as (select record_id, page, qid, value, case when reads_match = false then 'low' else base end as confidence,
    concat_ws(',', nullif(base_flags, ''), case when reads_match = false then 'needs_review' end) as flags,
    case when reads_match = false then concat_ws('; ', base_note, '{NOTE}') else base_note end as note, coalesce(reads_match = false, false) as needs_review, reads_match, error from merged)"""


@query("double_read_merge", f"with {MERGED} select * from full_merge")
def double_read_merge(spark, sf_dir):
    return listed(reconcile.double_read_merge(reads(spark, sf_dir)).drop("entry"), "flags")


@query("single_read_pass", f"with {MERGED} select record_id, page, qid, value, base as confidence, base_flags as flags, base_note as note, false as needs_review from merged")
def single_read_pass(spark, sf_dir):
    return listed(reconcile.single_read_pass(reads(spark, sf_dir).filter("read_no = 1")).drop("entry"), "flags")


@query("self_consistency_merge", f"""select cast(o_orderkey as varchar) as record_id, 'marks' as qid, o_orderstatus || ';z' as value, o_totalprice <= 400000 as match, cast(null as varchar) as error,
  concat_ws(',', 'multi_mark_on_single_select', case when o_orderpriority = '1-URGENT' then 'ambiguous_mark' end, case when o_totalprice > 400000 then 'self_consistency_mismatch' end) as flags from orders
union all select cast(o_orderkey as varchar), 'status', case when o_totalprice < 450000 then o_orderstatus end, case when o_totalprice >= 10000 then o_totalprice <= 420000 end,
  case when o_totalprice < 10000 then 'read_2_missing' end, case when o_totalprice > 420000 then 'self_consistency_mismatch' else '' end from orders""")
def self_consistency_merge(spark, sf_dir):
    rows = reconcile.self_consistency_merge(reads(spark, sf_dir))
    return listed(rows.select("record_id", "qid", "value", "match", "error", "flags"), "flags")


def page_reads(spark, sf_dir):
    """Whether each read took the page for the expected one, and what it noted in the margin."""
    price = F.col("o_totalprice")
    sides = F.array(
        F.struct(F.lit(1).alias("read_no"), (price < 450000).alias("page_matches"), F.when(price > 200000, F.col("o_orderpriority")).alias("page_note")),
        F.struct(F.lit(2).alias("read_no"), (price > 30000).alias("page_matches"), F.when(price < 300000, F.lit("5-LOW")).otherwise("").alias("page_note")),
    )
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("record_id"), F.lit(1).alias("page"), F.inline(sides))


@query("page_match_merge", """select cast(o_orderkey as varchar) as record_id, cast(1 as integer) as page, o_totalprice < 450000 and o_totalprice > 30000 as page_matches,
  case when o_totalprice < 450000 and o_totalprice > 30000 then '' else 'needs_review' end as flags from orders""")
def page_match_merge(spark, sf_dir):
    return listed(reconcile.page_match_merge(page_reads(spark, sf_dir)), "flags")


@query("page_note_merge", """select cast(o_orderkey as varchar) as record_id, cast(1 as integer) as page, case when o_totalprice <= 200000 then '5-LOW'
  when o_totalprice >= 300000 or o_orderpriority = '5-LOW' then o_orderpriority else o_orderpriority || ' [second read: 5-LOW]' end as note from orders""")
def page_note_merge(spark, sf_dir):
    return reconcile.page_note_merge(page_reads(spark, sf_dir))


@query("answer_union", f"""with {MERGED} select record_id, max(value) filter (where qid = 'marks') as marks, max(value) filter (where qid = 'status') as status, 'name' as missing, cast(0 as bigint) as n_unexpected, cast(0 as bigint) as n_repeated
from merged group by 1""")
def answer_union(spark, sf_dir):
    rows = reconcile.answer_union(reconcile.double_read_merge(reads(spark, sf_dir)), ["name", "status", "marks"])
    return rows.select(
        "record_id", F.col("answers")["marks"].alias("marks"), F.col("answers")["status"].alias("status"), F.array_join("missing", ",").alias("missing"), "n_unexpected", "n_repeated"
    )


# ---- truth ----------------------------------------------------------------------------------------

def truth_entries(spark, sf_dir):
    """Known answers in the older nested shapes."""
    price, status = F.col("o_totalprice"), F.col("o_orderstatus")

    def body(value):
        return F.to_json(value)

    yes = (price > 200000)
    sides = F.array(
        F.struct(F.lit("status").alias("qid"), body(F.struct(F.array(status, F.lit("z")).alias("value"), F.array(F.lit("multi_mark_on_single_select"), F.lit("margin_note")).alias("flags"))).alias("body")),
        F.struct(F.lit("amount").alias("qid"), body(F.struct(F.struct(F.struct(yes.alias("value")).alias("big")).alias("components"))).alias("body")),
        F.struct(F.lit("grid").alias("qid"), body(F.struct(F.struct(F.struct(F.array(status).alias("value")).alias("r1")).alias("rows"), yes.alias("none"))).alias("body")),
    )
    rows = heavy(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("record_id"), price.alias("price"), F.inline(sides))
    return rows.filter("not (qid = 'grid' and price > 480000)").select("record_id", "qid", F.parse_json("body").alias("entry"))


def truth(spark, sf_dir):
    return reconcile.truth_normalise(truth_entries(spark, sf_dir)).select("record_id", "qid", "value", "flags")


def extracted(spark, sf_dir):
    price, status = F.col("o_totalprice"), F.col("o_orderstatus")
    yes = F.when(price > 200000, "true").otherwise("false")
    none = F.array().cast("array<string>")
    sides = F.array(
        F.struct(F.lit("status").alias("qid"), F.concat(F.lit('["z","'), status, F.lit('"]')).alias("body"),
                 F.when(F.col("o_orderpriority") != "5-LOW", F.array(F.lit("multi_mark_on_single_select"))).otherwise(none).alias("flags")),
        F.struct(F.lit("amount").alias("qid"), F.concat(F.lit('{"big":'), F.when(status == "P", F.when(price > 200000, "1").otherwise("0")).otherwise(yes), F.lit("}")).alias("body"), none.alias("flags")),
        F.struct(F.lit("grid").alias("qid"), F.concat(F.lit('{"none":'), yes, F.lit(',"rows":{"r1":["'), F.when(price < 100000, "Q").otherwise(status), F.lit('"]}}')).alias("body"), none.alias("flags")),
    )
    rows = heavy(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("record_id"), price.alias("price"), F.inline(sides))
    return rows.filter("not (qid = 'amount' and price < 20000)").select("record_id", "qid", F.parse_json("body").alias("value"), "flags")


COMPARED = """cmp as (
  select cast(o_orderkey as varchar) as record_id, 'status' as qid, true as value_match, o_orderpriority <> '5-LOW' as flags_match,
    case when o_orderpriority = '5-LOW' then 'multi_mark_on_single_select' else '' end as missing_flags, '' as errors from orders
  union all select cast(o_orderkey as varchar), 'amount', o_totalprice >= 20000 and o_orderstatus <> 'P', o_totalprice >= 20000, '', case when o_totalprice < 20000 then 'missing_in_extracted' else '' end from orders
  union all select cast(o_orderkey as varchar), 'grid', o_totalprice <= 480000 and o_totalprice >= 100000, o_totalprice <= 480000, '', case when o_totalprice > 480000 then 'missing_in_truth' else '' end from orders)"""


def compared(spark, sf_dir):
    return reconcile.truth_comparison(truth(spark, sf_dir), extracted(spark, sf_dir))


@query("truth_comparison", f"with {COMPARED} select * from cmp")
def truth_comparison(spark, sf_dir):
    return listed(compared(spark, sf_dir).drop("expected_value", "actual_value"), "missing_flags", "errors")


@query("truth_normalise", """select cast(o_orderkey as varchar) as record_id, 'status' as qid, '["' || o_orderstatus || '","z"]' as value, 'multi_mark_on_single_select' as flags from orders
union all select cast(o_orderkey as varchar), 'amount', '{"big":' || case when o_totalprice > 200000 then 'true' else 'false' end || '}', '' from orders
union all select cast(o_orderkey as varchar), 'grid', '{"none":' || case when o_totalprice > 200000 then 'true' else 'false' end || ',"rows":{"r1":["' || o_orderstatus || '"]}}', '' from orders where o_totalprice <= 480000""")
def truth_normalise(spark, sf_dir):
    return listed(truth(spark, sf_dir).withColumn("value", F.to_json("value")), "flags")


@query("field_selection", """select cast(o_orderkey as varchar) as record_id, unnest(['status', 'amount', 'grid']) as qid, 'union' as rule from orders
union all select cast(o_orderkey as varchar), unnest(['status', 'other']), 'listed' from orders""")
def field_selection(spark, sf_dir):
    one, two = truth(spark, sf_dir), extracted(spark, sf_dir)
    both = reconcile.field_selection(one, two).withColumn("rule", F.lit("union"))
    return both.unionByName(reconcile.field_selection(one, two, ["status", "other", "status"]).withColumn("rule", F.lit("listed")))


@query("accuracy_summary", f"""with {COMPARED}, m as (select record_id, qid, value_match and flags_match and errors = '' as ok from cmp)
select 'record' as level, record_id as name, count(*) filter (where ok) as matched, count(*) as total, round(count(*) filter (where ok) / cast(count(*) as double), 6) as accuracy from m group by record_id
union all select 'question', qid, count(*) filter (where ok), count(*), round(count(*) filter (where ok) / cast(count(*) as double), 6) from m group by qid
union all select 'overall', '', count(*) filter (where ok), count(*), round(count(*) filter (where ok) / cast(count(*) as double), 6) from m""")
def accuracy_summary(spark, sf_dir):
    return tidy(reconcile.accuracy_summary(compared(spark, sf_dir)))


@query("redacted_diff", f"with {COMPARED} select record_id, qid, value_match, flags_match, cast(null as varchar) as expected_value, cast(null as varchar) as actual_value from cmp where not (value_match and flags_match)")
def redacted_diff(spark, sf_dir):
    return privacy.redacted_diff(compared(spark, sf_dir)).drop("missing_flags", "errors")
