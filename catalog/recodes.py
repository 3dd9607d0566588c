"""Registered queries: row-local recodes over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.tables import ORDER_LINES, VISITS, heavy, order_lines, table, visits
from tallyframe.functions import answers as A
from tallyframe.functions import recode as R
from tallyframe.operators.privacy import MASK_PATTERNS, mask_names, pii_hits, pii_mask_text

QUERIES, ORACLES = {}, {}


def register(name, build, sql):
    QUERIES[name], ORACLES[name] = build, sql


# Free-form text built from the order columns: integers, decimals, blanks, bounds, ranges, words.
def written_text():
    return (
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit(" "), F.col("o_custkey").cast("string"), F.lit(" ")))
        .when(F.col("o_orderpriority") == "5-LOW", F.format_string("%.2f", "o_totalprice"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.concat(F.lit(">"), F.substring("o_orderpriority", 1, 1)))
        .when(F.col("o_orderpriority") == "1-URGENT", F.lit(">0.5"))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.lit("7-8"))
    )

WRITTEN_SQL = """written as (select o_orderkey, case when o_orderstatus = 'F' then ' ' || cast(o_custkey as varchar) || ' '
  when o_orderpriority = '5-LOW' then printf('%.2f', o_totalprice) when o_orderpriority = '2-HIGH' then '>2'
  when o_orderpriority = '1-URGENT' then '>0.5' when o_orderpriority = '3-MEDIUM' then '7-8' end as t from orders)"""
IS_INT = r"regexp_full_match(trim(t), '-?[0-9]+')"
IS_NUMBER = r"regexp_full_match(trim(t), '[0-9]+(\.[0-9]+)?')"


def written(build, name="out"):
    return lambda spark, sf_dir: table(spark, sf_dir, "orders").select("o_orderkey", build(written_text()).alias(name))


register("to_numeric", written(R.to_numeric), f"with {WRITTEN_SQL} select o_orderkey, case when {IS_NUMBER} then cast(trim(t) as double) end as out from written")
register("safe_int", written(R.safe_int), f"with {WRITTEN_SQL} select o_orderkey, case when {IS_INT} then cast(trim(t) as bigint) end as out from written")
register("safe_float", written(R.safe_float), f"with {WRITTEN_SQL} select o_orderkey, case when {IS_NUMBER} then cast(trim(t) as double) end as out from written")
register(
    "qualitative_bound", written(R.experience_bracket),
    f"""with {WRITTEN_SQL} select o_orderkey, case when t = '>2' then '>=1' when t = '>0.5' then null
when {IS_NUMBER} then case when cast(trim(t) as double) < 1 then '<1' else '>=1' end end as out from written""",
)
register(
    "age_from_year",
    lambda spark, sf_dir: table(spark, sf_dir, "orders").select("o_orderkey", R.age_from_year(F.date_format("o_orderdate", "yyyy")).alias("age")),
    "select o_orderkey, cast(2026 - year(o_orderdate) as bigint) as age from orders",
)
register(
    "numeric_bracket",
    lambda spark, sf_dir: table(spark, sf_dir, "part").select(
        "p_partkey", R.age_bracket("p_size").alias("age"), R.marriage_age_bracket(F.col("p_size").cast("string")).alias("marriage"),
        R.numeric_bracket("p_retailprice", [1000, 1200], ["low", "middle", "high"], closed="right").alias("price"),
    ),
    """select p_partkey, case when p_size < 35 then '<35' when p_size <= 45 then '35-45' else '>45' end as age,
case when p_size < 18 then '<18' else '>=18' end as marriage,
case when p_retailprice <= 1000 then 'low' when p_retailprice <= 1200 then 'middle' else 'high' end as price from part""",
)

def grade_text():
    return (
        F.when(F.col("p_type") == "ECONOMY", F.concat(F.lit("Hết lớp "), (F.col("p_size") / 4).cast("int").cast("string")))
        .when(F.col("p_type") == "SMALL", F.concat((F.col("p_size") / 4).cast("int").cast("string"), F.lit("/12")))
        .when(F.col("p_name").startswith("red"), F.lit("Tiểu Học")).when(F.col("p_name").startswith("blue"), F.lit("đã học THCS"))
        .when(F.col("p_name").startswith("small"), F.lit("Trung  học phổ thông")).when(F.col("p_name").startswith("large"), F.lit("khác"))
    )

GRADE_SQL = """graded as (select p_partkey, p_size, p_type, case when p_type in ('ECONOMY', 'SMALL') then cast(floor(p_size / 4) as integer)
  when starts_with(p_name, 'red') then 5 when starts_with(p_name, 'blue') then 9 when starts_with(p_name, 'small') then 12 end as g from part)"""
register(
    "grade_from_text",
    lambda spark, sf_dir: table(spark, sf_dir, "part").select("p_partkey", R.grade_from_text(grade_text()).alias("grade")),
    f"with {GRADE_SQL} select p_partkey, g as grade from graded",
)
register(
    "education_bracket",
    lambda spark, sf_dir: table(spark, sf_dir, "part").select(
        "p_partkey", R.education_bracket(grade_text(), never_schooled=F.col("p_size") < 5, vocational=F.col("p_size") > 48).alias("bracket")
    ),
    f"""with {GRADE_SQL} select p_partkey, case when p_size > 48 then 'thpt' when p_size < 5 then 'khong_di_hoc' when g >= 12 then 'thpt'
when g >= 9 then 'thcs' when g is not null then 'tieu_hoc' end as bracket from graded""",
)
register(
    "spelling_normalise",
    lambda spark, sf_dir: table(spark, sf_dir, "documents").select("doc_id", R.spelling_normalise(
        F.when(F.col("lang") == "de", F.lit(" H'MÔNG ")).when(F.col("lang") == "fr", F.lit("Dao Đỏ")).otherwise(F.concat(F.lit(" "), F.upper("lang")))
    ).alias("name")),
    "select doc_id, case when lang = 'de' then 'Mông' when lang = 'fr' then 'Dao' else upper(lang) end as name from documents",
)
register(
    "strip_suffix",
    lambda spark, sf_dir: table(spark, sf_dir, "supplier").select("s_suppkey", R.strip_suffix(
        F.concat(F.lower("s_name"), F.when(F.col("s_acctbal") > 0, F.concat(F.lit("-"), F.col("s_nationkey").cast("string"), F.lit("phieu"))).otherwise("-phieu"))
    ).alias("slug")),
    "select s_suppkey, lower(s_name) || case when s_acctbal > 0 then '' else '-phieu' end as slug from supplier",
)

# Code lists of an order: the return flags of its lines, NULL members where a flag has no open line.
def codes_of():
    return F.when(F.col("n_lines") > 1, F.array(*[F.when(F.col(f"{flag}_O") > 0, flag) for flag in ("R", "N", "A")]))

CODES_SQL = "coded as (select order_id, n_lines, l1, l2, l3, A_O, N_O, R_O, case when n_lines > 1 then [case when R_O > 0 then 'R' end, case when N_O > 0 then 'N' end, case when A_O > 0 then 'A' end] end as codes from order_lines)"
KEPT_SQL = "list_filter(coalesce(codes, []), lambda c: c is not null)"


def coded(**columns):
    return lambda spark, sf_dir: order_lines(spark, sf_dir).select("order_id", *[build(codes_of()).alias(name) for name, build in columns.items()])


def joined(array):
    return F.array_join(array, ",")


register("as_code_list", coded(codes=lambda c: joined(R.as_code_list(c))), f"with {ORDER_LINES}, {CODES_SQL} select order_id, array_to_string({KEPT_SQL}, ',') as codes from coded")
register(
    "as_single_category", coded(combo=R.as_single_category),
    f"with {ORDER_LINES}, {CODES_SQL} select order_id, nullif(array_to_string(list_sort({KEPT_SQL}), '+'), '') as combo from coded",
)
register(
    "canonical_codes",
    lambda spark, sf_dir: order_lines(spark, sf_dir).select(
        "order_id", joined(R.canonical_codes(F.transform(R.as_code_list(codes_of()), F.lower), ["A", "R", "Z"])).alias("codes"),
        joined(R.invalid_codes(F.transform(R.as_code_list(codes_of()), F.lower), ["A", "R", "Z"])).alias("invalid"),
    ),
    f"""with {ORDER_LINES}, {CODES_SQL} select order_id, concat_ws(',', case when list_contains(codes, 'A') then 'A' end, case when list_contains(codes, 'R') then 'R' end,
case when list_contains(codes, 'N') then 'n' end) as codes, case when list_contains(codes, 'N') then 'n' else '' end as invalid from coded""",
)
register(
    "flag_set_ops",
    lambda spark, sf_dir: order_lines(spark, sf_dir).select(
        "order_id", joined(R.flags_of(F.concat(R.as_code_list(codes_of()), R.as_code_list(codes_of())))).alias("deduped"),
        joined(R.add_flag(R.as_code_list(codes_of()), "N", F.col("n_lines") > 3)).alias("added"), joined(R.remove_flag(R.as_code_list(codes_of()), "R")).alias("removed"),
    ),
    f"""with {ORDER_LINES}, {CODES_SQL}, k as (select *, {KEPT_SQL} as kept from coded)
select order_id, array_to_string(kept, ',') as deduped, array_to_string(case when n_lines > 3 and not list_contains(kept, 'N') then list_append(kept, 'N') else kept end, ',') as added,
  array_to_string(list_filter(kept, lambda c: c <> 'R'), ',') as removed from k""",
)
register(
    "other_text_override",
    lambda spark, sf_dir: table(spark, sf_dir, "documents").select("doc_id", R.other_text_override(
        F.when(F.col("lang") == "en", "khac").otherwise(F.col("lang")), F.when(F.col("n_chars") > 1000, F.col("source")).when(F.col("n_chars") > 500, "")
    ).alias("code")),
    "select doc_id, case when lang = 'en' then case when n_chars > 1000 then source else 'khac' end else lang end as code from documents",
)
KNOWN = ("click", "error", "view")
register(
    "combo_parts",
    lambda spark, sf_dir: visits(spark, sf_dir).filter("combo is not null").select("record_id", joined(R.combo_parts("combo", KNOWN)).alias("parts")),
    f"""with {VISITS} select record_id, case when contains(combo, '+') and len(list_filter(string_split(combo, '+'), lambda p: not list_contains(['click', 'error', 'view'], p))) = 0
then replace(combo, '+', ',') else combo end as parts from visits where combo is not null""",
)
register(
    "combo_has",
    lambda spark, sf_dir: visits(spark, sf_dir).select(
        "record_id", R.combo_has("combo", ["click", "view"]).alias("either"), R.combo_has("combo", ["error"], null_as=False).alias("error"),
    ),
    f"""with {VISITS} select record_id, list_has_any(string_split(combo, '+'), ['click', 'view']) as either,
coalesce(list_contains(string_split(combo, '+'), 'error'), false) as error from visits""",
)
register(
    "yes_no_bool",
    lambda spark, sf_dir: table(spark, sf_dir, "labels").select("doc_id", R.yes_no_bool(
        F.when(F.col("quality") == 1, "co").when(F.col("toxic") == 0, "khong").otherwise("?")
    ).alias("good")),
    "select doc_id, case when quality = 1 then true when toxic = 0 then false end as good from labels",
)
register(
    "ordinal_map",
    lambda spark, sf_dir: table(spark, sf_dir, "orders").select(
        "o_orderkey", R.ordinal_map("o_orderpriority", ["5-LOW", "3-MEDIUM", "2-HIGH", "1-URGENT"]).alias("level"),
        R.ordinal_map(F.when(F.col("o_orderstatus") == "F", "25_50").when(F.col("o_orderstatus") == "O", "tren_75").otherwise("25_50+51_75")).alias("income"),
    ),
    """select o_orderkey, cast(case o_orderpriority when '5-LOW' then 1 when '3-MEDIUM' then 2 when '2-HIGH' then 3 when '1-URGENT' then 4 end as integer) as level,
cast(case o_orderstatus when 'F' then 2 when 'O' then 4 end as integer) as income from orders""",
)
register(
    "any_of_indicators",
    lambda spark, sf_dir: order_lines(spark, sf_dir).select("order_id", R.any_of_indicators("A_F", F.when(F.col("n_lines") > 2, F.col("R_F"))).alias("any")),
    f"with {ORDER_LINES} select order_id, A_F = 1 or (n_lines > 2 and R_F = 1) as any from order_lines",
)
register(
    "base_question",
    lambda spark, sf_dir: table(spark, sf_dir, "part").select("p_partkey", R.base_question(
        F.when(F.col("p_type") == "ECONOMY", F.concat(F.lit("Q"), F.col("p_size").cast("string"), F.lit("a_row"))).when(F.col("p_type") == "SMALL", F.lit("age_bracket"))
        .otherwise(F.concat(F.lit("S"), F.col("p_size").cast("string"), F.lit("_x"))), {"age_bracket": "Q2"}
    ).alias("question")),
    """select p_partkey, case when p_type = 'ECONOMY' then 'Q' || cast(p_size as varchar) || 'a' when p_type = 'SMALL' then 'Q2'
else 'S' || cast(p_size as varchar) end as question from part""",
)
register(
    "note_concat",
    lambda spark, sf_dir: table(spark, sf_dir, "orders").select(
        "o_orderkey", R.note_concat(F.when(F.col("o_orderstatus") != "F", F.col("o_orderpriority")), F.when(F.col("o_totalprice") > 200000, "").otherwise("cheap")).alias("note"),
        R.page_note_merge(F.when(F.col("o_orderstatus") != "F", F.col("o_orderpriority")), F.when(F.col("o_orderstatus") != "O", F.lit("5-LOW"))).alias("page_note"),
    ),
    """select o_orderkey, nullif(concat_ws('; ', case when o_orderstatus <> 'F' then o_orderpriority end, case when o_totalprice <= 200000 then 'cheap' end), '') as note,
case when o_orderstatus = 'F' then '5-LOW' when o_orderstatus = 'O' or o_orderpriority = '5-LOW' then o_orderpriority else o_orderpriority || ' [second read: 5-LOW]' end as page_note from orders""",
)
register(
    "safe_identifier",
    lambda spark, sf_dir: table(spark, sf_dir, "pages").select("page_id", R.is_safe_identifier("url").alias("safe"), R.safe_identifier("url").alias("slug")),
    "select page_id, regexp_full_match(url, '[A-Za-z0-9_-]+') as safe, regexp_replace(url, '[^A-Za-z0-9_-]', '_', 'g') as slug from pages",
)
register(
    "provenance_columns",
    lambda spark, sf_dir: table(spark, sf_dir, "orders").withColumns(R.provenance_columns("1.0.0", "reader", "full_extraction")).select(
        "o_orderkey", "schema_version", "authored_by", "purpose", F.col("extracted_at").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\+00:00$").alias("is_iso")
    ),
    "select o_orderkey, '1.0.0' as schema_version, 'reader' as authored_by, 'full_extraction' as purpose, true as is_iso from orders",
)
register(
    "path_lookup",
    lambda spark, sf_dir: table(spark, sf_dir, "events").select("event_id", F.try_parse_json("props").alias("v")).select(
        "event_id", A.path_lookup(F.col("v"), ["k"], "int").alias("k"), A.path_lookup(F.col("v"), ["k", "deep"], "int").alias("through_number"),
        A.path_lookup(F.col("v"), ["zz"], "int").alias("missing"),
    ),
    """select event_id, cast(json_extract(props, '$.k') as integer) as k, cast(null as integer) as through_number, cast(null as integer) as missing from events""",
)

# Canonical comparison: two spellings of one entry, differing in order, metadata, or type.
def left_entry():
    return F.concat(
        F.lit('{"value":["'), F.lower("o_orderstatus"), F.lit('","z"],"note":"'), F.col("o_orderpriority"), F.lit('","n":'), F.col("o_custkey").cast("string"), F.lit("}")
    )

def right_entry():
    return F.concat(
        F.lit('{"n":'), F.when(F.col("o_orderpriority") == "5-LOW", F.concat(F.lit('"'), F.col("o_custkey").cast("string"), F.lit('"'))).otherwise(
            F.concat(F.col("o_custkey").cast("string"), F.lit(".0"))),
        F.lit(',"value":["z","'), F.when(F.col("o_totalprice") > 300000, "q").otherwise(F.lower("o_orderstatus")), F.lit('"],"flags":["x"]}'),
    )

register(
    "canonical_value",
    lambda spark, sf_dir: heavy(spark, sf_dir, "orders").select(
        "o_orderkey", F.try_parse_json(left_entry()).alias("l"), F.try_parse_json(right_entry()).alias("r")
    ).select("o_orderkey", A.values_equal("l", "r").alias("same")),
    "select o_orderkey, o_orderpriority <> '5-LOW' and not o_totalprice > 300000 as same from orders",
)


def masked_sql(text: str, upto: int | None = None) -> str:
    for token, pattern in list(MASK_PATTERNS.items())[:upto]:
        text = f"regexp_replace({text}, '{pattern}', '{token}', 'g')"
    return text


def hits_sql(i: int) -> str:
    pattern = list(MASK_PATTERNS.values())[i]
    return f"len(regexp_extract_all({masked_sql('text', i)}, '{pattern}'))"


register(
    "pii_mask_text",
    lambda spark, sf_dir: heavy(spark, sf_dir, "documents").select(
        "doc_id", F.md5(pii_mask_text(F.col("text"))).alias("masked"), pii_hits(F.col("text")).alias("hits")
    ).select("doc_id", "masked", *[F.col("hits")[token].alias(token.strip("[]").lower()) for token in MASK_PATTERNS]),
    f"""select doc_id, md5({masked_sql('text')}) as masked, {', '.join(f"cast({hits_sql(i)} as integer) as {token.strip('[]').lower()}" for i, token in enumerate(MASK_PATTERNS))} from documents""",
)


# A text's first two capitalised words stand for the name its writer gave. The SQL has no look-around: it masks the whole name
# and then its words, each twice, as neighbours share the separator between them.
def twice_sql(text: str, terms: str) -> str:
    pattern = f"'(?i)(^|[^\\p{{L}}\\p{{M}}\\p{{N}}])(?:' || {terms} || ')($|[^\\p{{L}}\\p{{M}}\\p{{N}}])'"
    once = f"regexp_replace({text}, {pattern}, '\\1[NAME]\\2', 'g')"
    return f"case when {terms} <> '' then regexp_replace({once}, {pattern}, '\\1[NAME]\\2', 'g') else {text} end"


NAME_SQL = f"""with n as (select doc_id, text, regexp_extract_all(text, '[A-Z][a-z]+')[1:2] as given from documents),
t as (select doc_id, text, case when len(given) = 2 and given[1] = given[2] then given[1] else array_to_string(given, ' ') end as whole,
  array_to_string(list_filter(given, lambda w: len(w) >= 3), '|') as words from n),
o as (select doc_id, words, {twice_sql('text', 'whole')} as text from t),
m as (select doc_id, {twice_sql('text', 'words')} as masked from o)
select doc_id, md5(masked) as masked, (len(masked) - len(replace(masked, '[NAME]', ''))) // 6 as n_names from m"""


def masked_names(spark, sf_dir):
    given = F.array_distinct(F.slice(F.regexp_extract_all("text", F.lit("[A-Z][a-z]+"), F.lit(0)), 1, 2))
    rows = heavy(spark, sf_dir, "documents").select("doc_id", mask_names(F.col("text"), F.array(F.array_join(given, " "))).alias("masked"))
    return rows.select("doc_id", F.md5("masked").alias("masked"), F.regexp_count("masked", F.lit(r"\[NAME\]")).cast("long").alias("n_names"))


register("pii_mask_names", masked_names, NAME_SQL)
