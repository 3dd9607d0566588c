"""Registered queries: frequencies, descriptives, series."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.tables import (
    EVENT_TYPES, LINE_NUMBERS, LINE_STATUSES, ORDER_CHOICES, ORDER_LINES, RETURN_FLAGS, VISITS,
    heavy, order_choices, order_lines, table, tidy, visits,
)
from tallyframe.operators import crosstab, describe, frequency, series
from tallyframe.plans.policy import Policy

PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW", "6-NEVER")
TICKS = [f"t__{kind}" for kind in EVENT_TYPES]
GRID = [f"{flag}_{status}" for flag in RETURN_FLAGS for status in LINE_STATUSES]

QUERIES, ORACLES = {}, {}


def query(name, sql=None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def long_sql(source: str, columns) -> str:
    return " union all ".join(f"select '{name}' as variable, cast({name} as varchar) as value from {source}" for name in columns)


def frequency_sql(source: str, columns, ctes: str = "", denominator: str = "valid_n", below: int = 0) -> str:
    head = f"with {ctes}, " if ctes else "with "
    return f"""{head}long as ({long_sql(source, columns)}),
t as (select variable, count(*) as all_n, count(value) as valid_n from long group by 1),
c as (select variable, value, count(*) as n from long where value is not null group by 1, 2)
select c.variable, c.value, case when n >= {below} then n end as n,
  case when n >= {below} then round(n / cast({denominator} as double), 6) end as percent, n < {below} as suppressed,
  valid_n, all_n - valid_n as missing_n, {denominator} as denominator_n
from c join t on c.variable = t.variable"""


@query("frequency_table", frequency_sql("order_choices", ("priority", "status", "size"), ORDER_CHOICES))
def frequency_table(spark, sf_dir):
    return tidy(frequency.frequency_table(order_choices(spark, sf_dir), ["priority", "status", "size"]))


@query("frequency_all", frequency_sql("part", ("p_brand", "p_type", "p_size", "p_name")))
def frequency_all(spark, sf_dir):
    return tidy(frequency.frequency_table(table(spark, sf_dir, "part"), ["p_brand", "p_type", "p_size", "p_name"]))


@query("small_cell_suppression", frequency_sql("part", ("p_brand", "p_type"), denominator="all_n", below=85))
def small_cell_suppression(spark, sf_dir):
    policy = Policy(suppress_below_n=85, percent_denominator="all")
    return tidy(frequency.frequency_table(table(spark, sf_dir, "part"), ["p_brand", "p_type"], policy))


@query("frequency_report", f"""with {ORDER_CHOICES}, long as ({long_sql('order_choices', ('priority', 'status', 'size'))})
select variable as field, coalesce(value, '(missing)') as value, count(*) as count,
  round(count(*) / cast((select count(*) from orders) as double), 6) as percent
from long group by 1, 2""")
def frequency_report(spark, sf_dir):
    return tidy(frequency.frequency_report(order_choices(spark, sf_dir).drop("price")))


def coded_sql(source: str, ctes: str, options: dict) -> str:
    declared = ", ".join(f"('{name}', '{code}', {i})" for name, codes in options.items() for i, code in enumerate(codes))
    return f"""with {ctes}, long as ({long_sql(source, options)}),
declared(variable, value, position) as (values {declared}),
t as (select variable, count(*) as total_n, count(value) as valid_n from long group by 1),
parts as (
  select variable, value, string_split(value, '+') as p,
    (select list(d.value) from declared d where d.variable = long.variable) as known
  from long where value is not null),
spread as (
  select variable, unnest(case when contains(value, '+') and len(list_filter(p, lambda x: not list_contains(known, x))) = 0 then p else [value] end) as value
  from parts),
c as (select variable, value, count(*) as n from spread group by 1, 2),
s as (select variable, sum(n) as tallied from c group by 1),
r as (select coalesce(c.variable, d.variable) as variable, coalesce(c.value, d.value) as value, coalesce(n, 0) as n, position
  from c full outer join declared d on c.variable = d.variable and c.value = d.value)
select r.variable, r.value, cast(r.n as bigint) as n, round(r.n / cast(total_n as double), 6) as percent, position is not null as declared, position,
  valid_n, total_n - valid_n as missing_n, total_n, coalesce(tallied, 0) > valid_n as has_overlap
from r join t on r.variable = t.variable left join s on r.variable = s.variable"""


@query("frequency_coded", coded_sql("visits", VISITS, {"combo": ("click", "purchase", "signup", "view", "share"), "part": ("night", "day", "evening", "dawn")}))
def frequency_coded(spark, sf_dir):
    options = {"combo": ["click", "purchase", "signup", "view", "share"], "part": ["night", "day", "evening", "dawn"]}
    return tidy(frequency.frequency_coded(visits(spark, sf_dir), options))


@query("frequency_combo", f"select variable, value, n, percent, valid_n, missing_n, has_overlap from ({coded_sql('visits', VISITS, {'combo': EVENT_TYPES})}) where n > 0")
def frequency_combo(spark, sf_dir):
    return tidy(frequency.frequency_combo(visits(spark, sf_dir), "combo", EVENT_TYPES))


def ticks_sql(source: str, columns) -> str:
    return " union all ".join(
        f"select '{name}' as option, count(*) filter (where {name} = 1) as n, count(*) as total_n from {source}" for name in columns
    )


@query("multi_select_freq", f"with {VISITS} select option, n, round(n / cast(total_n as double), 6) as percent, total_n from ({ticks_sql('visits', TICKS)})")
def multi_select_freq(spark, sf_dir):
    return tidy(frequency.multi_select_freq(visits(spark, sf_dir), TICKS))


@query("grid_freq", f"""with {ORDER_LINES}, g as (select * replace (cast(uniform as integer) as uniform) from order_lines)
select option, n, round(n / cast(total_n as double), 6) as percent, total_n from ({ticks_sql('g', [*GRID, 'uniform'])})""")
def grid_freq(spark, sf_dir):
    return tidy(frequency.grid_freq(order_lines(spark, sf_dir), GRID, "uniform"))


_ROWS = ", ".join(f"('l{k}')" for k in LINE_NUMBERS)


@query("matrix_summary", f"""with {ORDER_LINES}, long as ({long_sql('order_lines', [f'l{k}' for k in LINE_NUMBERS])}),
total as (select count(*) as total_n from order_lines),
spread as (select variable, unnest(string_split(value, '+')) as value from long where value is not null),
lab as (select variable, case when value in ('A', 'N') then value else '(other)' end as value from spread),
c as (select variable, value, count(*) as n from lab group by 1, 2),
whole as (select variable, case when value in ('A', 'N', 'A+N') then value else '(other)' end as value from long where value is not null),
other as (select variable, count(*) as n from whole where value = '(other)' group by 1),
plain as (select variable, unnest(string_split(value, '+')) as value from whole where value <> '(other)'),
pc as (select variable, value, count(*) as n from plain group by 1, 2 union all select variable, '(other)', n from other),
grid as (select r as variable, o as option from (values {_ROWS}) a(r), (values ('A'), ('N'), ('(other)')) b(o))
select grid.variable as row, option, coalesce(n, 0) as n, round(coalesce(n, 0) / cast(total_n as double), 6) as percent
from grid left join pc on pc.variable = grid.variable and pc.value = grid.option, total""")
def matrix_summary(spark, sf_dir):
    rows = {f"l{k}": f"l{k}" for k in LINE_NUMBERS}
    return tidy(frequency.matrix_summary(order_lines(spark, sf_dir), rows, ["A", "N"]))


@query("stacked_series", f"""with {ORDER_LINES}, long as ({long_sql('order_lines', [f'l{k}' for k in LINE_NUMBERS])}),
spread as (select variable, unnest(string_split(value, '+')) as value from long where value is not null)
select variable as row, {', '.join(f"round(count(*) filter (where value = '{flag}') / cast((select count(*) from order_lines) as double), 6) as {flag}" for flag in RETURN_FLAGS)}
from spread group by 1""")
def stacked_series(spark, sf_dir):
    rows = {f"l{k}": f"l{k}" for k in LINE_NUMBERS}
    return tidy(series.stacked_series(frequency.matrix_summary(order_lines(spark, sf_dir), rows, RETURN_FLAGS), RETURN_FLAGS))


@query("frequency_union", f"""with {ORDER_CHOICES}, a as ({frequency_sql('order_choices', ('size',), ORDER_CHOICES, 'all_n')}),
b as ({frequency_sql('order_choices', ('status',), ORDER_CHOICES, 'all_n')})
select 0 as part_order, 'size of order' as part, value, n, percent from a
union all select 1, 'status of order', value, n, percent from b""")
def frequency_union(spark, sf_dir):
    policy, rows = Policy(percent_denominator="all"), order_choices(spark, sf_dir)
    return tidy(frequency.frequency_union({
        "size of order": frequency.frequency_table(rows, ["size"], policy),
        "status of order": frequency.frequency_table(rows, ["status"], policy),
    }))


@query("indicator_lookup", f"""with f as ({frequency_sql('order_choices', ('priority', 'status'), ORDER_CHOICES)})
select w.indicator, w.variable, w.value, coalesce(percent, 0.0) as percent
from (values ('urgent', 'priority', '1-URGENT'), ('open', 'status', 'O'), ('lost', 'status', 'L')) w(indicator, variable, value)
left join f on f.variable = w.variable and f.value = w.value""")
def indicator_lookup(spark, sf_dir):
    table_ = frequency.frequency_table(order_choices(spark, sf_dir), ["priority", "status"])
    wanted = {"urgent": ("priority", "1-URGENT"), "open": ("status", "O"), "lost": ("status", "L")}
    return tidy(frequency.indicator_lookup(table_, wanted))


@query("top_two_categories", f"""with f as ({frequency_sql('order_choices', ('priority', 'status', 'size'), ORDER_CHOICES)}),
r as (select *, row_number() over (partition by variable order by n desc, value) as position from f)
select variable, cast(position as integer) as position, value, n, percent, missing_n from r where position <= 2""")
def top_two_categories(spark, sf_dir):
    return tidy(series.top_two_categories(frequency.frequency_table(order_choices(spark, sf_dir), ["priority", "status", "size"])))


@query("top_three_options", f"""with {VISITS}, f as ({ticks_sql('visits', TICKS)})
select option, n, round(n / cast(total_n as double), 6) as percent, total_n from f where n > 0 order by n desc, option limit 3""")
def top_three_options(spark, sf_dir):
    return tidy(series.top_three_options(frequency.multi_select_freq(visits(spark, sf_dir), TICKS)))


@query("bar_series", f"""with c as ({coded_sql('order_choices', ORDER_CHOICES, {'priority': PRIORITIES})})
select variable, value, n, percent from c where n > 0""")
def bar_series(spark, sf_dir):
    return tidy(series.bar_series(frequency.frequency_coded(order_choices(spark, sf_dir), {"priority": PRIORITIES})))


# ---- descriptives ---------------------------------------------------------------------------------

def summary_sql(source: str, columns, extra: str = "", ctes: str = "", digits: int = 6) -> str:
    head = f"with {ctes} " if ctes else ""
    return head + " union all ".join(
        f"""select '{name}' as variable, nullif(count({name}), 0) as n, round(avg({name}), {digits}) as mean, round(stddev_samp({name}), {digits}) as std,
  cast(min({name}) as double) as min, round(quantile_cont(cast({name} as double), 0.25), 6) as q1,
  round(quantile_cont(cast({name} as double), 0.5), 6) as median, round(quantile_cont(cast({name} as double), 0.75), 6) as q3,
  cast(max({name}) as double) as max{extra.format(name=name, source=source)} from {source}"""
        for name in columns
    )


LINE_NUMERIC = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


# The mean discount of the sf0.01 lines is 0.0499185 exactly, a rounding tie at six digits.
@query("descriptive_summary", summary_sql("lineitem", LINE_NUMERIC, digits=5))
def descriptive_summary(spark, sf_dir):
    return tidy(describe.descriptive_summary(heavy(spark, sf_dir, "lineitem"), LINE_NUMERIC), 5)


_MODE = ", (select cast(m.v as double) from (select {name} as v, count(*) as c from {source} where {name} is not null group by 1 order by c desc, v limit 1) m) as mode"


@query("descriptive_mode", summary_sql("part", ("p_size", "p_retailprice"), _MODE))
def descriptive_mode(spark, sf_dir):
    return tidy(describe.descriptive_mode(table(spark, sf_dir, "part"), ["p_size", "p_retailprice"]))


@query("index_describe", f"select variable, min, median, max, mean from ({summary_sql('customer', ('c_acctbal',))})")
def index_describe(spark, sf_dir):
    return tidy(describe.index_describe(table(spark, sf_dir, "customer"), "c_acctbal"))


@query("group_mean_index", f"""with {ORDER_CHOICES} select size as "group", count(*) as n, round(avg(price), 6) as mean
from order_choices where size is not null group by 1""")
def group_mean_index(spark, sf_dir):
    return tidy(describe.group_mean_index(order_choices(spark, sf_dir), "price", "size"))


def histogram_sql(name: str, source: str) -> str:
    return f"""select '{name}' as variable, bin, round(lo + bin * (hi - lo) / 12, 6) as bin_low, round(lo + (bin + 1) * (hi - lo) / 12, 6) as bin_high,
  (select count(*) from {source} where least(cast(floor(({name} - lo) / ((hi - lo) / cast(12 as double))) as integer), 11) = bin) as n
from (select cast(min({name}) as double) as lo, cast(max({name}) as double) as hi from {source}), (select cast(range as integer) as bin from range(12))"""


@query("histogram", " union all ".join(histogram_sql(name, "lineitem") for name in ("l_quantity", "l_extendedprice")))
def histogram(spark, sf_dir):
    return tidy(series.histogram(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice"]))


@query("index_histogram", """with i as (select l_quantity * 2 as x from lineitem)
select bin, round(bin * cast(100 as double) / 12, 6) as bin_low, round((bin + 1) * cast(100 as double) / 12, 6) as bin_high,
  (select count(*) from i where least(cast(floor(x / (cast(100 as double) / 12)) as integer), 11) = bin) as n, (select round(avg(x), 6) from i) as mean
from (select cast(range as integer) as bin from range(12))""")
def index_histogram(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select((F.col("l_quantity") * 2).alias("index"))
    return tidy(series.index_histogram(rows, "index"))


@query("box_plot", """with q as (select event_type as "group", count(*) as n, quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.5) as median,
  quantile_cont(value, 0.75) as q3 from events group by 1)
select q."group", round(q1, 6) as q1, round(median, 6) as median, round(q3, 6) as q3, q.n,
  min(value) filter (where value between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)) as whisker_low,
  max(value) filter (where value between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)) as whisker_high,
  count(*) filter (where not value between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)) as n_outliers
from q join events on event_type = q."group" group by all""")
def box_plot(spark, sf_dir):
    return tidy(series.box_plot(table(spark, sf_dir, "events"), "value", "event_type"))


# ---- cross-tabulations ----------------------------------------------------------------------------

def customers(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.select(
        "r_name", "n_name", F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).alias("segment"), F.col("c_acctbal").alias("balance")
    )


CUSTOMERS = """customers as (
  select r_name, n_name, case when c_acctbal > 0 then c_mktsegment end as segment, c_acctbal as balance
  from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey)"""
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY", "SPACECRAFT")
REGIONS = ("AFRICA", "ASIA", "ATLANTIS")
_SEGMENT_VALUES = ", ".join(f"({i}, '{name}')" for i, name in enumerate(SEGMENTS))


@query("crosstab", f"""with {CUSTOMERS}, c as (select r_name as "group", segment as value, count(*) as n from customers where segment is not null group by 1, 2),
t as (select "group", cast(sum(n) as bigint) as valid_n from c group by 1)
select c."group", value, case when n >= 55 then n end as n, case when n >= 55 then round(n / cast(valid_n as double), 6) end as percent,
  valid_n, cast(0 as bigint) as missing_n, valid_n as denominator_n, n < 55 as suppressed from c join t on c."group" = t."group" """)
def crosstab_(spark, sf_dir):
    return tidy(crosstab.crosstab(customers(spark, sf_dir), "segment", "r_name", Policy(suppress_below_n=55)))


def levels_sql(groups: str, withhold: str = "''") -> str:
    return f"""slots as (select * from g, (values {_SEGMENT_VALUES}) s(position, value)),
  n as (select g.level, g."group", segment as value, count(*) as n from member m join g on g.level = m.level and g."group" = m."group" where segment is not null group by 1, 2, 3)
select s.level, s."group", s.value, cast(s.position as integer) as position, coalesce(n, 0) as n,
  case when s."group" not in ({withhold}) then case when total_n > 0 then round(coalesce(n, 0) / cast(total_n as double), 6) else 0.0 end end as percent, valid_n, total_n
from slots s left join n on n.level = s.level and n."group" = s."group" and n.value = s.value"""


@query("crosstab_grid", f"""with {CUSTOMERS},
member as (select 'group' as level, r_name as "group", segment from customers union all select 'all', '__all__', segment from customers),
w(level, "group") as (values ('all', '__all__'), {', '.join(f"('group', '{name}')" for name in REGIONS)}),
g as (select w.level, w."group", count(m."group") as total_n, count(segment) as valid_n from w left join member m on m.level = w.level and m."group" = w."group" group by 1, 2),
{levels_sql('')}""".replace("select s.level, s.\"group\"", "select s.\"group\""))
def crosstab_grid(spark, sf_dir):
    return tidy(crosstab.crosstab_grid(customers(spark, sf_dir), "segment", "r_name", SEGMENTS, REGIONS))


@query("crosstab_two_level", f"""with {CUSTOMERS},
member as (select 'upper' as level, r_name as "group", segment from customers union all select 'lower', n_name, segment from customers
  union all select 'all', '__all__', segment from customers),
g as (select level, "group", count(*) as total_n, count(segment) as valid_n from member group by 1, 2),
{levels_sql('', "'NATION_3'")}""")
def crosstab_two_level(spark, sf_dir):
    return tidy(crosstab.crosstab_two_level(customers(spark, sf_dir), "segment", "r_name", "n_name", SEGMENTS, withhold=["NATION_3"]))


@query("multi_select_by_group", f"""with {VISITS} select * replace (round(percent, 6) as percent) from ({' union all '.join(
    f"select '{name}' as option, part as \"group\", count(*) filter (where {name} = 1) as n, count(*) as n_group, count(*) filter (where {name} = 1) / cast(count(*) as double) as percent from visits group by part" for name in TICKS)})""")
def multi_select_by_group(spark, sf_dir):
    return tidy(frequency.multi_select_by_group(visits(spark, sf_dir), TICKS, "part"))


@query("breakdown_by_group", f"""with {VISITS}, spread as (select part as "group", unnest(string_split(combo, '+')) as value from visits where combo is not null)
select s."group", value, count(*) as n, n_group, round(count(*) / cast(n_group as double), 6) as percent
from spread s join (select part as "group", count(*) as n_group from visits group by 1) g on g."group" = s."group" group by 1, 2, 4""")
def breakdown_by_group(spark, sf_dir):
    return tidy(crosstab.breakdown_by_group(visits(spark, sf_dir), "combo", "part", EVENT_TYPES))


@query("membership_crosstab", f"""with {VISITS}, spread as (select unnest(string_split(combo, '+')) as "group", part as value from visits where combo is not null)
select s."group", value, count(*) as n, n_group, round(count(*) / cast(n_group as double), 6) as percent
from spread s join (select "group", count(*) as n_group from spread group by 1) g on g."group" = s."group" group by 1, 2, 4""")
def membership_crosstab(spark, sf_dir):
    return tidy(crosstab.membership_crosstab(visits(spark, sf_dir), "combo", "part"))


def _pos(column: str, codes) -> str:
    return f"coalesce(list_has_any(string_split({column}, '+'), [{', '.join(repr(code) for code in codes)}]), false)"


@query("positive_share_pairs", f"""with {ORDER_LINES}, p(pair, side, n) as (
  select 'first line', 'does', count(*) filter (where {_pos('l1', ('A', 'N'))}) from order_lines
  union all select 'first line', 'decides', count(*) filter (where {_pos('l2', ('A',))}) from order_lines
  union all select 'later line', 'does', count(*) filter (where {_pos('l2', ('R',))}) from order_lines
  union all select 'later line', 'decides', count(*) filter (where {_pos('l3', ('N', 'R'))}) from order_lines)
select pair, side, n, total_n, round(n / cast(total_n as double), 6) as percent from p, (select count(*) as total_n from order_lines)""")
def positive_share_pairs(spark, sf_dir):
    return tidy(crosstab.positive_share_pairs(order_lines(spark, sf_dir), {
        "first line": (("l1", ["A", "N"]), ("l2", ["A"])), "later line": (("l2", ["R"]), ("l3", ["N", "R"])),
    }))


@query("multi_code_share", f"""with {VISITS} select part as "group", count(*) filter (where {_pos('combo', ('purchase', 'signup'))}) as n, count(*) as n_group,
  round(count(*) filter (where {_pos('combo', ('purchase', 'signup'))}) / cast(count(*) as double), 6) as percent from visits group by 1""")
def multi_code_share(spark, sf_dir):
    return tidy(crosstab.multi_code_share(visits(spark, sf_dir), "combo", ["purchase", "signup"], "part"))


@query("ownership_vs_usage", f"""with {VISITS}, f as ({ticks_sql('visits', ('t__signup', 't__purchase', 't__click'))})
select case when option = 't__signup' then 'owns' else 'uses' end as role, option as name, n, total_n, round(n / cast(total_n as double), 6) as percent from f""")
def ownership_vs_usage(spark, sf_dir):
    return tidy(crosstab.ownership_vs_usage(visits(spark, sf_dir), "t__signup", ["t__purchase", "t__click"]))


@query("conditional_ownership", f"""with {ORDER_LINES}, f as ({' union all '.join(
    f"select '{flag}' as device, '{status}' as person, count(*) filter (where {flag}_F = 1 or {flag}_O = 1) as n_owners, count(*) filter (where {flag}_{status} = 1) as n, count(*) as total_n from order_lines"
    for flag in RETURN_FLAGS for status in LINE_STATUSES)})
select *, round(n_owners / cast(total_n as double), 6) as owner_percent, round(n / cast(n_owners as double), 6) as percent from f""")
def conditional_ownership(spark, sf_dir):
    devices = {flag: {status: f"{flag}_{status}" for status in LINE_STATUSES} for flag in RETURN_FLAGS}
    return tidy(crosstab.conditional_ownership(order_lines(spark, sf_dir), devices))


_WANTED = (("1-URGENT", "small"), ("1-URGENT", "large"), ("5-LOW", "small"), ("5-LOW", "huge"))


@query("joint_categories", f"""with {ORDER_CHOICES}, w("first", "second") as (values {', '.join(f"('{a}', '{b}')" for a, b in _WANTED)}),
t as (select count(*) as total_n, count(*) filter (where priority is not null and size is not null) as valid_n from order_choices)
select w."first", w."second", count(c.record_id) as n, round(count(c.record_id) / cast(total_n as double), 6) as percent, valid_n, total_n - valid_n as missing_n
from w left join order_choices c on c.priority = w."first" and c.size = w."second", t group by 1, 2, 5, 6, total_n""")
def joint_categories(spark, sf_dir):
    return tidy(crosstab.joint_categories(order_choices(spark, sf_dir), "priority", "size", _WANTED))


@query("overview_counts", f"""with {CUSTOMERS} select r_name as region, count(*) as n, round(avg(balance), 6) as mean_age from customers group by 1
union all select '__all__', count(*), round(avg(balance), 6) from customers""")
def overview_counts(spark, sf_dir):
    return tidy(crosstab.overview_counts(customers(spark, sf_dir), "r_name", "balance"))


@query("indicator_bundle", f"""with {VISITS}, f as ({ticks_sql('visits', TICKS)}), g as (select part, avg(spent) as m, count(*) as n from visits group by 1)
select 'ticks' as part, cast(null as varchar) as level, option as name, n, total_n, round(n / cast(total_n as double), 6) as value from f
union all select 'shares', part, cast(null as varchar), count(*) filter (where {_pos('combo', ('purchase', 'signup'))}), count(*),
  round(count(*) filter (where {_pos('combo', ('purchase', 'signup'))}) / cast(count(*) as double), 6) from visits group by part
union all select 'spending', part, cast(null as varchar), n, cast(null as bigint), round(m, 6) from g""")
def indicator_bundle(spark, sf_dir):
    from tallyframe.plans.analyze import indicator_bundle as bundle

    return tidy(bundle(visits(spark, sf_dir), {
        "ticks": lambda df: frequency.multi_select_freq(df, TICKS),
        "shares": lambda df: crosstab.multi_code_share(df, "combo", ["purchase", "signup"], "part"),
        "spending": lambda df: describe.group_mean_index(df, "spent", "part"),
    }))
