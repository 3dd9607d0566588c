"""Given tables, and the survey-shaped tables Spark derives from them.

Each derived table has its SQL twin beside it, so a query and its check read the same definition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.plans.session import spread

EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
RETURN_FLAGS = ("A", "N", "R")
LINE_STATUSES = ("F", "O")
PRIORITY_CODES = {"1-URGENT": "urgent", "2-HIGH": "high", "3-MEDIUM": "medium", "4-NOT SPECIFIED": "unspecified", "5-LOW": "low"}
LINE_NUMBERS = (1, 2, 3, 4, 5, 6, 7)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def heavy(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table whose rows are about to be worked hard."""
    return spread(table(spark, sf_dir, name))


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round doubles, so that sums taken in another order compare equal; -0.0 becomes 0.0."""
    return df.select(*[
        (F.round(F.col(f"`{name}`"), digits) + F.lit(0.0)).alias(name) if kind == "double" else F.col(f"`{name}`")
        for name, kind in df.dtypes
    ])


# ---- orders as answers to choice questions --------------------------------------------------------

def order_choices(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        F.col("o_orderkey").cast("string").alias("record_id"),
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderpriority")).alias("priority"),
        F.col("o_orderstatus").alias("status"),
        F.when(F.col("o_totalprice") < 100000, "small").when(F.col("o_totalprice") < 300000, "middle").otherwise("large").alias("size"),
        F.col("o_totalprice").alias("price"),
    )


ORDER_CHOICES = """
order_choices as (
  select cast(o_orderkey as varchar) as record_id,
    case when o_orderpriority <> '4-NOT SPECIFIED' then o_orderpriority end as priority,
    o_orderstatus as status,
    case when o_totalprice < 100000 then 'small'
         when o_totalprice < 300000 then 'middle' else 'large' end as size,
    o_totalprice as price
  from orders)"""


# ---- events as visits: one record per user and day, with ticked event types -----------------------

def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    ticked = [F.max((F.col("event_type") == kind).cast("int")).alias(f"t__{kind}") for kind in EVENT_TYPES]
    hour = F.min(F.hour("ts"))
    return events.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        *ticked,
        F.array_join(F.array_sort(F.collect_set("event_type")), "+").alias("combo"),
        F.when(hour < 6, "night").when(hour < 14, "day").otherwise("evening").alias("part"),
        F.count(F.lit(1)).alias("n_events"), F.sum("value").alias("spent"),
    ).select(
        F.concat_ws("_", "user_id", "day").alias("record_id"), "user_id", *[f"t__{kind}" for kind in EVENT_TYPES],
        "combo", "part", "n_events", "spent",
    )


VISITS = f"""
visits as (
  select cast(user_id as varchar) || '_' || strftime(cast(ts as date), '%Y-%m-%d') as record_id, user_id,
    {', '.join(f"max(case when event_type = '{kind}' then 1 else 0 end) as t__{kind}" for kind in EVENT_TYPES)},
    string_agg(distinct event_type, '+' order by event_type) as combo,
    case when min(hour(ts)) < 6 then 'night' when min(hour(ts)) < 14 then 'day' else 'evening' end as part,
    count(*) as n_events, sum(value) as spent
  from events group by user_id, cast(ts as date))"""


# ---- lineitem as matrix and grid answers of an order ----------------------------------------------

def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order: combo of return flags on each line number, and 0/1 per (return flag, line status)."""
    lines = table(spark, sf_dir, "lineitem")
    flag, line = F.col("l_returnflag"), F.col("l_linenumber")
    cells = {
        f"{code}_{status}": F.max(((flag == code) & (F.col("l_linestatus") == status)).cast("int")) for code in RETURN_FLAGS for status in LINE_STATUSES
    }
    # All flags of an order are one sorted set; a set for each line number would cost as many objects an order.
    marks = F.array_sort(F.collect_set(F.when(flag.isNotNull(), F.struct(line.alias("line"), flag.alias("flag")))))
    found = lines.groupBy(F.col("l_orderkey").alias("order_id")).agg(
        marks.alias("marks"), *[cell.alias(name) for name, cell in cells.items()], F.count(F.lit(1)).alias("n_lines"), F.max("l_quantity").alias("top_quantity")
    )

    def combo(number: int) -> Column:
        here = F.filter("marks", lambda mark: mark["line"] == number)
        return F.nullif(F.array_join(F.transform(here, lambda mark: mark["flag"]), "+"), F.lit("")).alias(f"l{number}")

    rows = [combo(number) for number in LINE_NUMBERS]
    uniform = F.array_max(F.col("marks.flag")) == F.array_min(F.col("marks.flag"))
    return found.select("order_id", *rows, *cells, "n_lines", "top_quantity", uniform.alias("uniform"))


ORDER_LINES = f"""
order_lines as (
  select l_orderkey as order_id,
    {', '.join(f"string_agg(distinct l_returnflag, '+' order by l_returnflag) filter (where l_linenumber = {k}) as l{k}" for k in LINE_NUMBERS)},
    {', '.join(f"max(case when l_returnflag = '{flag}' and l_linestatus = '{status}' then 1 else 0 end) as {flag}_{status}" for flag in RETURN_FLAGS for status in LINE_STATUSES)},
    count(*) as n_lines, max(l_quantity) as top_quantity, max(l_returnflag) = min(l_returnflag) as uniform
  from lineitem group by l_orderkey)"""


# ---- orders as questionnaire documents ------------------------------------------------------------

CONTRACT = {
    "schema_version": "1.0.0",
    "title": "Order questionnaire",
    "total_pages": 2,
    "questions": [
        {"id": "customer", "page": 1, "section": "head", "text": "Customer", "type": "text", "pii": True},
        {"id": "status", "page": 1, "section": "head", "text": "Status", "type": "single_select", "options": [
            {"code": "F", "label": "Filled"}, {"code": "O", "label": "Open"}, {"code": "P", "label": "Partial"}]},
        {"id": "priority", "page": 1, "section": "head", "text": "Priority", "type": "single_select", "options": [
            {"code": code, "label": code.title()} for code in PRIORITY_CODES.values()]},
        {"id": "flags", "page": 1, "section": "lines", "text": "Return flags", "type": "multi_select", "options": [
            {"code": flag, "label": f"Flag {flag}"} for flag in RETURN_FLAGS] + [{"code": "none", "label": "None", "exclusive": True}]},
        {"id": "amount", "page": 1, "section": "lines", "text": "Amount", "type": "composite", "components": [
            {"id": "total", "type": "text"}, {"id": "big", "type": "single_select", "options": [{"code": "yes"}]}]},
        {"id": "lines", "page": 2, "section": "lines", "text": "Lines", "type": "matrix", "expected_data_rows": len(LINE_NUMBERS),
         "rows": [{"group_header": "First lines"}] + [{"code": f"l{k}", "label": f"Line {k}"} for k in LINE_NUMBERS],
         "columns": [{"code": flag, "label": f"Flag {flag}"} for flag in RETURN_FLAGS]},
        {"id": "modes", "page": 2, "section": "lines", "text": "Modes", "type": "device_grid",
         "rows": [{"code": flag, "label": f"Flag {flag}"} for flag in RETURN_FLAGS],
         "columns": [{"code": status, "label": f"Status {status}"} for status in LINE_STATUSES],
         "extra_option": {"code": "uniform", "label": "All the same"}},
        {"id": "placed", "page": 2, "section": "tail", "text": "Placed on", "type": "text",
         "subfield": {"id": "day"}, "derived_subfield": [{"id": "year"}],
         "depends_on": {"question": "flags", "not_contains": "none"}},
        {"id": "PAGE_NOTES", "page": None, "section": "meta", "text": "Notes", "type": "free_text", "per_page": True},
    ],
}


def _json(column: Column) -> Column:
    return F.to_json(column, {"ignoreNullFields": "false"})


def _entry(value: Column, *more: Column) -> Column:
    return F.struct(value.alias("value"), *more)


def _combo_array(column: str) -> Column:
    return F.when(F.col(column).isNotNull(), F.split(column, r"\+"))


def order_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(record_id, value): one JSON text per order with wrapped, bare, null, empty and missing answers."""
    orders = heavy(spark, sf_dir, "orders")
    rows = orders.join(order_lines(spark, sf_dir), F.col("o_orderkey") == F.col("order_id"), "left")
    price, status, priority = F.col("o_totalprice"), F.col("o_orderstatus"), F.col("o_orderpriority")
    code = F.lit(None).cast("string")
    for name, value in PRIORITY_CODES.items():
        code = F.when(priority == name, value).otherwise(code)
    present = F.filter(
        F.array(*[F.when((F.col(f"{flag}_F") + F.col(f"{flag}_O")) > 0, flag) for flag in RETURN_FLAGS]), lambda flag: flag.isNotNull()
    )
    flagged = F.when(price < 20000, F.array_append(present, "none")).when((status == "F") & (price < 60000), F.array().cast("array<string>")).when(
        F.col("order_id").isNotNull(), present
    )

    def quoted(name: str, body: Column) -> Column:
        return F.concat(F.lit(f'"{name}":'), body)

    cells = F.struct(*[
        _entry(F.filter(F.array(*[F.when(F.col(f"{flag}_{s}") > 0, s) for s in LINE_STATUSES]), lambda s: s.isNotNull())).alias(flag)
        for flag in RETURN_FLAGS
    ])
    review = F.when(price > 400000, F.array(F.lit("needs_review"))).otherwise(F.array().cast("array<string>"))
    answers = F.concat_ws(
        ",",
        quoted("customer", _json(_entry(F.concat(F.lit("Customer "), F.col("o_custkey").cast("string"))))),
        quoted("status", F.when(priority == "4-NOT SPECIFIED", F.concat(F.lit('"'), status, F.lit('"')))
               .when((status == "P") & (priority == "5-LOW"), F.lit('{"value":["P","O"]}'))
               .otherwise(_json(_entry(status, review.alias("flags"))))),
        F.when(price <= 450000, quoted("priority", F.when(priority == "4-NOT SPECIFIED", F.lit('{"value":null}')).otherwise(_json(_entry(code))))),
        quoted("flags", _json(_entry(flagged, (price > 480000).alias("needs_review")))),
        quoted("amount", _json(F.struct(F.struct(
            _entry(F.format_string("%.2f", price)).alias("total"), _entry(price > 250000).alias("big")).alias("components")))),
        quoted("lines", _json(F.struct(F.struct(*[
            _entry(_combo_array(f"l{k}"), F.when((F.lit(k) == 1) & (price > 350000), F.array(F.lit("needs_review"))).alias("flags")).alias(f"l{k}")
            for k in LINE_NUMBERS]).alias("rows")))),
        F.when(F.col("order_id").isNotNull(), quoted("modes", _json(F.struct(cells.alias("rows"), F.col("uniform"))))),
        quoted("placed", _json(F.struct(
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("value"),
            F.struct(_entry(F.dayofmonth("o_orderdate")).alias("day")).alias("subfield"),
            F.struct(_entry(F.year("o_orderdate")).alias("year")).alias("derived_subfield")))),
    )
    notes = F.when(status == "P", F.lit('{"1":null}')).otherwise(F.lit('{"1":null,"2":"ok"}'))
    text = F.concat(
        F.lit('{"record_id":"R'), F.col("o_orderkey").cast("string"), F.lit('","source_images":["scan.png"],"answers":{'),
        answers, F.lit('},"page_notes":'), notes, F.lit("}"),
    )
    return rows.select(F.concat(F.lit("R"), F.col("o_orderkey").cast("string")).alias("record_id"), text.alias("value"))


def order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed documents (record_id, document)."""
    from tallyframe.sources.records import parse_records

    return parse_records(order_documents(spark, sf_dir), file_name=None).select("record_id", "document")


ORDER_RECORDS = ORDER_LINES + f"""
, order_base as (
  select 'R' || cast(o_orderkey as varchar) as record_id, o.*, l.*,
    case o_orderpriority {' '.join(f"when '{name}' then '{code}'" for name, code in PRIORITY_CODES.items())} end as priority_code,
    list_filter([{', '.join(f"case when {flag}_F + {flag}_O > 0 then '{flag}' end" for flag in RETURN_FLAGS)}], lambda x: x is not null) as present
  from orders o left join order_lines l on o_orderkey = order_id)
, order_answers as (
  select *,
    case when o_totalprice < 20000 then list_append(present, 'none')
         when o_orderstatus = 'F' and o_totalprice < 60000 then cast([] as varchar[])
         when order_id is not null then present end as flag_list,
    case when o_orderpriority <> '4-NOT SPECIFIED' and o_orderstatus = 'P' and o_orderpriority = '5-LOW' then ['P', 'O'] else [o_orderstatus] end as status_list,
    case when o_totalprice <= 450000 and o_orderpriority <> '4-NOT SPECIFIED' then priority_code end as priority_value
  from order_base)"""
