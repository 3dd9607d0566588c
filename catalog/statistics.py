"""Registered queries: associations, tests, effect sizes, reliability."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from catalog.frequency import CUSTOMERS, customers, frequency_sql, summary_sql
from catalog.tables import LINE_NUMBERS, ORDER_LINES, VISITS, heavy, order_lines, table, tidy, visits
from tallyframe.operators import association, effects, reliability, series
from tallyframe.plans.analyze import analyze_dataset as analyze
from tallyframe.plans.policy import Policy

QUERIES, ORACLES = {}, {}


def query(name, sql=None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


# ---- SQL for tail probabilities, by Simpson's rule and closed sums --------------------------------

def normal_upper_sql(z: str) -> str:
    return (
        "(list_sum(list_transform(range(0, 2401), lambda i: (case when i in (0, 2400) then 1 when i % 2 = 1 then 4 else 2 end)"
        f" * exp(-pow(({z}) + i * cast(0.005 as double), 2) / 2))) * cast(0.005 as double) / 3 / sqrt(2 * pi()))"
    )


def chi2_p_sql(x: str, df: str) -> str:
    even = f"exp(-({x}) / 2) * list_sum(list_transform(range(0, cast(({df}) // 2 as bigint)), lambda i: pow(({x}) / 2, i) / gamma(i + 1)))"
    odd = (
        f"(2 * {normal_upper_sql(f'sqrt({x})')} + exp(-({x}) / 2) * coalesce(list_sum(list_transform(range(0, cast((({df}) - 1) // 2 as bigint)), "
        f"lambda i: pow(({x}) / 2, i + cast(0.5 as double)) / gamma(i + cast(1.5 as double)))), 0))"
    )
    return f"(case when ({df}) % 2 = 0 then {even} else {odd} end)"


def student_sql(t: str, df: str) -> str:
    def area(start: str) -> str:
        return (
            "list_sum(list_transform(range(0, 4001), lambda i: (case when i in (0, 4000) then 1 when i % 2 = 1 then 4 else 2 end)"
            f" * exp(-(({df}) + 1) / cast(2 as double) * ln(1 + pow({start} + i * cast(0.01 as double), 2) / ({df})))))"
        )

    return f"({area(f'abs({t})')} / {area('0')})"


def u_p_sql(u: str, n1: str, n2: str, ties: str) -> str:
    n = f"cast({n1} + {n2} as double)"
    sd = f"sqrt(cast({n1} as double) * {n2} / 12 * (({n} + 1) - {ties} / ({n} * ({n} - 1))))"
    gap = f"(greatest({u}, cast({n1} as double) * {n2} - {u}) - cast({n1} as double) * {n2} / 2 - cast(0.5 as double))"
    return f"least(1.0, 2 * {normal_upper_sql(f'{gap} / {sd}')})"


# ---- SQL per pair ---------------------------------------------------------------------------------

def chi_sql(source: str, a: str, b: str) -> str:
    return f"""(with p as (select cast({a} as varchar) as a, cast({b} as varchar) as b from {source} where {a} is not null and {b} is not null),
  t as (select count(*) as n from p), ra as (select a, count(*) as r from p group by a), cb as (select b, count(*) as c from p group by b),
  o as (select a, b, count(*) as o from p group by a, b),
  g as (select ra.a, cb.b, r, c, coalesce(o, 0) as o, r * cast(c as double) / n as e from ra cross join cb cross join t left join o on o.a = ra.a and o.b = cb.b)
  select sum((o - e) * (o - e) / e) as chi2, ((select count(*) from ra) - 1) * ((select count(*) from cb) - 1) as df, max(n) as n,
    least((select count(*) from ra), (select count(*) from cb)) as k, least(min(r), min(c)) as min_group_n from g, t)"""


def group_sql(source: str, x: str, g: str, keep: str = "") -> str:
    return f"""(with p as (select cast({x} as double) as x, cast({g} as varchar) as g from {source} where {x} is not null and {g} is not null {keep}),
  m as (select count(*) as total, avg(x) as gm from p),
  r as (select x, g, rank() over (order by x) + (count(*) over (partition by x) - 1) / cast(2 as double) as r from p),
  lv as (select g, count(*) as n, sum(r - (total + 1) / cast(2 as double)) as rg, avg(x) as mean from r, m group by g),
  ti as (select sum(pow(c, 3) - c) as tie_sum from (select cast(count(*) as double) as c from p group by x)),
  ss as (select sum((x - gm) * (x - gm)) as ss_total from p, m),
  f as (select count(*) as levels, min(n) as min_group_n, arg_min(n, g) as n1, arg_min(rg, g) as rg1, sum(rg * rg / n) as rb, sum(n * (mean - gm) * (mean - gm)) as between_ from lv, m)
  select total, levels, min_group_n, tie_sum, between_, ss_total, n1, total - n1 as n2,
    12 / (cast(total as double) * (total + 1)) * rb / (1 - tie_sum / (pow(cast(total as double), 3) - total)) as h,
    case when levels = 2 then rg1 + n1 * cast(total - n1 as double) / 2 end as u,
    between_ / (levels - 1) / ((ss_total - between_) / (total - levels)) as f
  from m, ti, ss, f)"""


def spearman_sql(source: str, a: str, b: str) -> str:
    return f"""(with p as (select cast({a} as double) as a, cast({b} as double) as b from {source} where {a} is not null and {b} is not null),
  r as (select rank() over (order by a) + (count(*) over (partition by a) - 1) / cast(2 as double) as ra,
    rank() over (order by b) + (count(*) over (partition by b) - 1) / cast(2 as double) as rb from p)
  select corr(ra, rb) as rho, count(*) as n from r)"""


def spearman_p_sql(rho: str, n: str) -> str:
    return student_sql(f"({rho} * sqrt(({n} - 2) / ((1 - {rho}) * (1 + {rho}))))", f"({n} - 2)")


def cramers_row(source, a, b, digits=6):
    return f"""select '{a}' as variable_a, '{b}' as variable_b, 'cramers_v' as method, round(sqrt(chi2 / (n * (k - 1))), 6) as effect,
  round({chi2_p_sql('chi2', 'df')}, {digits}) as p_value, n, min_group_n from {chi_sql(source, a, b)}"""


def spearman_row(source, a, b, digits=6):
    return f"""select '{a}' as variable_a, '{b}' as variable_b, 'spearman_rho' as method, round(rho, 6) as effect,
  round({spearman_p_sql('rho', 'n')}, {digits}) as p_value, n, cast(null as bigint) as min_group_n from {spearman_sql(source, a, b)}"""


def mixed_row(source, x, g, names=None, digits=6):
    a, b = names or (x, g)
    return f"""select '{a}' as variable_a, '{b}' as variable_b, case when levels = 2 then 'rank_biserial' else 'eta' end as method,
  round(case when levels = 2 then 1 - 2 * u / (cast(n1 as double) * n2) else sqrt(between_ / ss_total) end, 6) as effect,
  round(case when levels = 2 then {u_p_sql('u', 'n1', 'n2', 'tie_sum')} else {chi2_p_sql('h', '(levels - 1)')} end, {digits}) as p_value,
  total as n, min_group_n from {group_sql(source, x, g)}"""


# ---- a table of mixed kinds with gaps -------------------------------------------------------------

MIX_TYPES = {
    "quantity": "continuous", "price": "continuous", "discount": "ordinal", "flag": "categorical", "line": "binary", "priority": "categorical",
}


def mix(spark, sf_dir):
    """Order lines with their order's priority; priority has gaps."""
    lines, orders = heavy(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("discount"), F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("line"),
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderpriority")).alias("priority"),
    )


MIX = """mix as (select l_quantity as quantity, l_extendedprice as price, l_discount as discount,
  l_returnflag as flag, l_linestatus as line, case when o_orderpriority <> '4-NOT SPECIFIED' then o_orderpriority end as priority
  from lineitem join orders on l_orderkey = o_orderkey)"""
NUMBERS = ("quantity", "price", "discount")


def matrix_sql() -> str:
    rows = []
    for i, (a, b) in enumerate(combinations(MIX_TYPES, 2)):
        if a in NUMBERS and b in NUMBERS:
            row = spearman_row("mix", a, b, 15)
        elif a in NUMBERS:
            row = mixed_row("mix", a, b, digits=15)
        else:
            row = cramers_row("mix", a, b, 15)
        rows.append(f"select cast({i} as integer) as pair, * from ({row})")
    return f"""raw as ({' union all '.join(rows)}),
ranked as (select *, row_number() over (order by p_value, pair) as rk, count(p_value) over () as m from raw),
adjusted as (select *, least(1.0, min(p_value * m / rk) over (order by rk rows between current row and unbounded following)) as adjusted_p_value from ranked),
matrix as (select pair, variable_a, variable_b, method, effect, round(p_value, 6) as p_value, round(adjusted_p_value, 5) as adjusted_p_value, n, min_group_n,
  case when n < 20 then 'low_pair_n' when min_group_n < 5 then 'small_group' end as caution,
  case when p_value is not null and not (n < 20 or coalesce(min_group_n < 5, false)) then p_value < 0.05 end as significant,
  case when method in ('spearman_rho', 'rank_biserial') then case when effect > 0 then 'same' else 'opposite' end end as direction from adjusted)"""


def mix_matrix(spark, sf_dir):
    return association.association_matrix(mix(spark, sf_dir), MIX_TYPES)


def tidy_matrix(df):
    """p-values to the digits that do not depend on rounding them before adjustment."""
    return tidy(df.withColumn("adjusted_p_value", F.round("adjusted_p_value", 5)))


@query("association_matrix", f"with {MIX}, {matrix_sql()} select * from matrix")
def association_matrix(spark, sf_dir):
    return tidy_matrix(mix_matrix(spark, sf_dir))


@query("top_associations", f"""with {MIX}, {matrix_sql()} select variable_a, variable_b, method, effect, abs(effect) as strength, n from matrix
where not (variable_a in ('flag', 'line') and variable_b in ('flag', 'line')) order by abs(effect) desc, pair limit 5""")
def top_associations(spark, sf_dir):
    top = association.top_associations(mix_matrix(spark, sf_dir), 5, structural=["flag", "line"])
    return tidy(top.select("variable_a", "variable_b", "method", "effect", "strength", "n"))


SECTIONS = {"quantity": "amount", "price": "amount", "discount": "amount", "flag": "state", "line": "state", "priority": "order"}


@query("block_summary", f"""with {MIX}, {matrix_sql()}, s(v, section) as (values {', '.join(f"('{v}', '{s}')" for v, s in SECTIONS.items())}),
both_ as (select variable_a as a, variable_b as b, effect from matrix union all select variable_b, variable_a, effect from matrix)
select x.section as section_a, y.section as section_b, count(effect) as n_pairs, round(avg(abs(effect)), 5) as mean_effect
from both_ join s x on x.v = a join s y on y.v = b group by 1, 2""")
def block_summary(spark, sf_dir):
    return tidy(association.block_summary(mix_matrix(spark, sf_dir), SECTIONS), 5)


@query("effect_matrix", f"""with {MIX}, {matrix_sql()},
both_ as (select variable_a as a, variable_b as b, effect from matrix union all select variable_b, variable_a, effect from matrix)
select a as variable, {', '.join(f"max(effect) filter (where b = '{v}') as {v}" for v in MIX_TYPES)} from both_ group by a""")
def effect_matrix(spark, sf_dir):
    return tidy(association.effect_matrix(mix_matrix(spark, sf_dir), list(MIX_TYPES)))


@query("association_dispatch", f"with {MIX}, {matrix_sql()} select method, count(*) as n_pairs, cast(sum(n) as bigint) as n_rows from matrix group by 1")
def association_dispatch(spark, sf_dir):
    return mix_matrix(spark, sf_dir).groupBy("method").agg(F.count(F.lit(1)).alias("n_pairs"), F.sum("n").alias("n_rows"))


@query("caution_flag", f"""with {CUSTOMERS}, p as (select n_name, count(*) as n, count(*) filter (where balance > 9500) as rich from customers where segment is not null group by 1)
select n_name, n, rich, case when n < 50 then 'low_pair_n' when rich < 3 then 'small_group' end as caution from p""")
def caution_flag(spark, sf_dir):
    rows = customers(spark, sf_dir).filter("segment is not null").groupBy("n_name").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("balance") > 9500).alias("rich")
    )
    return rows.withColumn("caution", association.caution_flag(F.col("n"), F.col("rich"), Policy(min_pair_n=50, min_group_n=3)))


@query("significance_label", """select l_suppkey, n, round(p, 6) as p_value, case when n >= 500 then p < 0.05 end as significant
from (select l_suppkey, count(*) as n, exp(-avg(l_discount) * 60) as p from lineitem group by 1)""")
def significance_label(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("n"), F.exp(-F.avg("l_discount") * 60).alias("p_value")
    )
    return tidy(rows.withColumn("significant", association.significance_label(F.col("p_value"), F.col("n") < 500, 0.05)))


@query("effect_direction", f"with {MIX}, {matrix_sql()} select variable_a, variable_b, method, direction from matrix")
def effect_direction(spark, sf_dir):
    return mix_matrix(spark, sf_dir).select("variable_a", "variable_b", "method", "direction")


@query("benjamini_hochberg", """with p as (select c_custkey, c_mktsegment as family, case when c_acctbal > 0 then exp(-c_acctbal / 1000) end as p from customer),
r as (select *, row_number() over (partition by family order by p nulls last, c_custkey) as rk, count(p) over (partition by family) as m from p)
select c_custkey, family, round(p, 8) as p_value,
  round(case when p is not null then least(1.0, min(p * m / rk) over (partition by family order by rk rows between current row and unbounded following)) end, 6) as adjusted_p_value from r""")
def benjamini_hochberg(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_mktsegment").alias("family"),
        F.when(F.col("c_acctbal") > 0, F.exp(-F.col("c_acctbal") / 1000)).alias("p_value"),
    )
    out = association.benjamini_hochberg_many(rows, "c_custkey", family=["family"])
    return out.select("c_custkey", "family", F.round("p_value", 8).alias("p_value"), F.round("adjusted_p_value", 6).alias("adjusted_p_value"))


# ---- single measures ------------------------------------------------------------------------------

@query("contingency", f"with {MIX} " + " union all ".join(
    f"""select '{a}' as variable_a, '{b}' as variable_b, cast({a} as varchar) as a, cast({b} as varchar) as b, count(*) as n
from mix where {a} is not null and {b} is not null group by 3, 4""" for a, b in (("flag", "line"), ("line", "priority"))))
def contingency(spark, sf_dir):
    return association.contingency(mix(spark, sf_dir), [("flag", "line"), ("line", "priority")])


CAT_PAIRS = (("flag", "line"), ("flag", "priority"), ("line", "priority"))


@query("chi_square", f"with {MIX} " + " union all ".join(
    f"""select '{a}' as variable_a, '{b}' as variable_b, round(chi2, 6) as chi2, df, round({chi2_p_sql('chi2', 'df')}, 6) as p_value, n, min_group_n
from {chi_sql('mix', a, b)}""" for a, b in CAT_PAIRS))
def chi_square(spark, sf_dir):
    return tidy(association.chi_square(mix(spark, sf_dir), CAT_PAIRS))


@query("cramers_v", f"with {MIX} " + " union all ".join(cramers_row("mix", a, b) for a, b in CAT_PAIRS))
def cramers_v(spark, sf_dir):
    return tidy(association.cramers_v(mix(spark, sf_dir), CAT_PAIRS))


@query("average_rank", " union all ".join(f"""select '{name}' as variable, cast({name} as double) as x, count(*) as n, min(rk) + (count(*) - 1) / cast(2 as double) as midrank
from (select {name}, rank() over (order by {name}) as rk from lineitem) group by {name}""" for name in ("l_quantity", "l_extendedprice")))
def average_rank(spark, sf_dir):
    return association.average_rank(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice"])


NUM_PAIRS = (("quantity", "price"), ("quantity", "discount"))


@query("spearman_rho", f"with {MIX} " + " union all ".join(
    f"select variable_a, variable_b, method, effect, p_value, n from ({spearman_row('mix', a, b)})" for a, b in NUM_PAIRS))
def spearman_rho(spark, sf_dir):
    return tidy(association.spearman_rho(mix(spark, sf_dir), NUM_PAIRS))


@query("rank_biserial", f"with {MIX} " + " union all ".join(mixed_row("mix", a, "line") for a in NUMBERS))
def rank_biserial(spark, sf_dir):
    return tidy(association.rank_biserial(mix(spark, sf_dir), [(a, "line") for a in NUMBERS]))


@query("mann_whitney", f"with {MIX} " + " union all ".join(
    f"""select '{a}' as outcome, 'line' as "group", u, round({u_p_sql('u', 'n1', 'n2', 'tie_sum')}, 6) as p_value, n1, n2, levels
from {group_sql('mix', a, 'line')}""" for a in NUMBERS))
def mann_whitney(spark, sf_dir):
    return tidy(association.mann_whitney(mix(spark, sf_dir), [(a, "line") for a in NUMBERS]))


@query("kruskal_wallis", f"with {MIX} " + " union all ".join(
    f"""select '{a}' as outcome, '{g}' as "group", round(h, 6) as h, levels - 1 as df, round({chi2_p_sql('h', '(levels - 1)')}, 6) as p_value, total as n
from {group_sql('mix', a, g)}""" for a, g in (("quantity", "flag"), ("price", "priority"))))
def kruskal_wallis(spark, sf_dir):
    return tidy(association.kruskal_wallis(mix(spark, sf_dir), [("quantity", "flag"), ("price", "priority")]))


@query("eta", f"with {MIX} " + " union all ".join(
    f"""select '{a}' as variable_a, '{g}' as variable_b, round(sqrt(between_ / ss_total), 6) as eta, round(between_ / ss_total, 8) as eta_squared,
  round({chi2_p_sql('h', '(levels - 1)')}, 6) as p_value, total as n, levels, min_group_n from {group_sql('mix', a, g)}"""
    for a, g in (("quantity", "flag"), ("price", "priority"))))
def eta(spark, sf_dir):
    out = association.eta(mix(spark, sf_dir), [("quantity", "flag"), ("price", "priority")])
    return out.withColumns({"eta": F.round("eta", 6), "eta_squared": F.round("eta_squared", 8), "p_value": F.round("p_value", 6)})


@query("anova_f", f"with {MIX} " + " union all ".join(
    f"""select '{a}' as variable_a, '{g}' as variable_b, round(f, 6) as f, levels - 1 as df1, total - levels as df2,
  round(case when levels = 3 then pow(1 + 2 * f / (total - levels), -(total - levels) / cast(2 as double)) end, 6) as p_value, total as n from {group_sql('mix', a, g)}"""
    for a, g in (("quantity", "flag"), ("price", "flag"))))
def anova_f(spark, sf_dir):
    return tidy(association.anova_f(mix(spark, sf_dir), [("quantity", "flag"), ("price", "flag")]))


@query("eta_squared", f"with {MIX} " + " union all ".join(
    f"""select '{g}' as category, '{a}' as outcome, round(between_ / ss_total, 8) as eta_squared,
  round(pow(1 + 2 * f / (total - levels), -(total - levels) / cast(2 as double)), 6) as p_value, total as n from {group_sql('mix', a, g)}"""
    for a, g in (("quantity", "flag"), ("discount", "flag"))))
def eta_squared(spark, sf_dir):
    out = effects.eta_squared(mix(spark, sf_dir), [("flag", "quantity"), ("discount", "flag")])
    return out.withColumns({"eta_squared": F.round("eta_squared", 8), "p_value": F.round("p_value", 6)})


ODDS = """odds as (select a, b, count(*) filter (where x = a1 and y = b1) as n11, count(*) filter (where x = a1 and y = b0) as n10,
  count(*) filter (where x = a0 and y = b1) as n01, count(*) filter (where x = a0 and y = b0) as n00, count(*) as n from (
  select 'quality' as a, 'toxic' as b, cast(quality as varchar) as x, cast(toxic as varchar) as y, '1' as a1, '0' as a0, '1' as b1, '0' as b0 from labels) group by a, b)"""


@query("odds_ratio", f"""with {ODDS} select a as variable_a, b as variable_b, round(n11 * cast(n00 as double) / (n10 * cast(n01 as double)), 6) as odds_ratio, n,
  cast(n11 as double) as n11, cast(n10 as double) as n10, cast(n01 as double) as n01, cast(n00 as double) as n00, false as corrected from odds""")
def odds_ratio(spark, sf_dir):
    return tidy(effects.odds_ratio(table(spark, sf_dir, "labels"), [("quality", "toxic")]))


def tick_odds(a: str, b: str) -> str:
    return f"""select 't__{a}' as variable_a, 't__{b}' as variable_b,
  (count(*) filter (where t__{a} = 1 and t__{b} = 1)) * cast(count(*) filter (where t__{a} = 0 and t__{b} = 0) as double)
  / (count(*) filter (where t__{a} = 1 and t__{b} = 0) * cast(count(*) filter (where t__{a} = 0 and t__{b} = 1) as double)) as odds_ratio from visits"""


@query("forest_series", f"""with {VISITS}, f as ({tick_odds('click', 'view')} union all {tick_odds('error', 'purchase')})
select variable_a, variable_b, round(odds_ratio, 6) as odds_ratio, case when odds_ratio >= 1 then 'higher' else 'lower' end as side,
  (select max(odds_ratio) / min(odds_ratio) > 8 from f) as log_scale from f""")
def forest_series(spark, sf_dir):
    return tidy(series.forest_series(effects.odds_ratio(visits(spark, sf_dir), [("t__click", "t__view"), ("t__error", "t__purchase")])))


def slope_sql(a: str, b: str) -> str:
    return f"""(select regr_slope({b}, {a}) as slope, regr_intercept({b}, {a}) as intercept, corr({b}, {a}) as r, count(*) as n
  from mix where {a} is not null and {b} is not null)"""


@query("regression_slope", f"with {MIX} " + " union all ".join(
    f"""select '{a}' as variable_a, '{b}' as variable_b, round(slope, 5) as slope, round(intercept, 5) as intercept, round(r, 5) as r,
  round({spearman_p_sql('r', 'n')}, 5) as p_value, n from {slope_sql(a, b)}""" for a, b in (("quantity", "price"), ("discount", "quantity"))))
def regression_slope(spark, sf_dir):
    return tidy(effects.regression_slope(mix(spark, sf_dir), [("quantity", "price"), ("discount", "quantity")]), 5)


@query("variance_explained_series", f"with {MIX} " + " union all ".join(
    f"select '{g}' as category, '{a}' as outcome, round(between_ / ss_total * 100, 6) as percent_explained, total as n from {group_sql('mix', a, g)}"
    for a, g in (("quantity", "flag"), ("price", "priority"))))
def variance_explained_series(spark, sf_dir):
    return tidy(series.variance_explained_series(effects.eta_squared(mix(spark, sf_dir), [("quantity", "flag"), ("priority", "price")])))


@query("curated_effects", f"""with {MIX}
select cast(0 as integer) as position, 'price' as topic, 'quantity' as a, 'price' as b, 'slope' as kind, round(slope, 5) as value, n from {slope_sql('quantity', 'price')}
union all select 1, 'price', 'price', 'priority', 'eta_squared', round(between_ / ss_total, 5), total from {group_sql('mix', 'price', 'priority')}
union all select 2, 'amount', 'flag', 'quantity', 'eta_squared', round(between_ / ss_total, 5), total from {group_sql('mix', 'quantity', 'flag')}
union all select 3, 'state', 'line', 'flag', 'odds_ratio', null, count(*) from mix""")
def curated_effects(spark, sf_dir):
    out = effects.curated_effects(mix(spark, sf_dir), [
        ("price", "quantity", "price", "slope"), ("price", "price", "priority", "eta_squared"),
        ("amount", "flag", "quantity", "eta_squared"), ("state", "line", "flag", "odds_ratio"),
    ])
    return tidy(out.drop("detail"), 5)


# ---- group comparisons ----------------------------------------------------------------------------

def medians_sql(source: str, x: str, g: str) -> str:
    return f"""select string_agg(g || ':' || n || ':' || cast(md as varchar), ';' order by g) from (
  select cast({g} as varchar) as g, count(*) as n, round(quantile_cont(cast({x} as double), 0.5), 3) as md from {source} where {x} is not null and {g} is not null group by 1)"""


def compare_row(source: str, x: str, g: str) -> str:
    return f"""select '{x}' as outcome, '{g}' as "group", case when levels = 2 then 'mann_whitney_u' else 'kruskal_wallis' end as method,
  round(case when levels = 2 then u else h end, 6) as statistic,
  round(case when levels = 2 then {u_p_sql('u', 'n1', 'n2', 'tie_sum')} else {chi2_p_sql('h', '(levels - 1)')} end, 6) as p_value,
  ({medians_sql(source, x, g)}) as groups, case when min_group_n < 5 then 'small_group' end as caution from {group_sql(source, x, g)}"""


COMPARISONS = (("quantity", "line"), ("price", "flag"), ("discount", "priority"))


def flat_groups(df):
    return df.withColumn("groups", F.array_join(F.transform(
        "groups", lambda g: F.concat_ws(":", g.group, g.n, F.round(g.median, 3).cast("string"))), ";"))


@query("compare_groups", f"with {MIX} " + " union all ".join(compare_row("mix", *pair) for pair in COMPARISONS))
def compare_groups(spark, sf_dir):
    return tidy(flat_groups(association.compare_groups(mix(spark, sf_dir), COMPARISONS)))


@query("curated_group_tests", f"""with {MIX}
select 'size' as topic, 'quantity' as outcome, 'line' as "group", 'mann_whitney' as test, u as statistic, round({u_p_sql('u', 'n1', 'n2', 'tie_sum')}, 6) as p_value, min_group_n < 10 as low_n from {group_sql('mix', 'quantity', 'line')}
union all select 'price', 'price', 'priority', 'kruskal_wallis', round(h, 6), round({chi2_p_sql('h', '(levels - 1)')}, 6), min_group_n < 10 from {group_sql('mix', 'price', 'priority')}
union all select 'odd', 'price', 'flag', 'mann_whitney', null, null, true""")
def curated_group_tests(spark, sf_dir):
    return tidy(association.curated_group_tests(mix(spark, sf_dir), [
        ("size", "quantity", "line", "mann_whitney"), ("price", "price", "priority", "kruskal_wallis"), ("odd", "price", "flag", "mann_whitney"),
    ]))


# ---- reliability ----------------------------------------------------------------------------------

def alpha_sql(source: str, name: str, items) -> str:
    complete = " and ".join(f"{item} is not null" for item in items)
    k = len(items)
    return f"""select '{name}' as scale, round({k} / cast({k - 1} as double) * (1 - ({' + '.join(f'var_samp({item})' for item in items)}) / var_samp({' + '.join(items)})), 6) as alpha,
  count(*) as n, cast({k} as integer) as items, cast(null as varchar) as reason from {source} where {complete}"""


SCALE_ITEMS = "scale_items as (select l_discount * 100 as d, l_tax * 100 as t, l_quantity / 5 as q from lineitem)"


@query("cronbach_alpha", f"""with {SCALE_ITEMS} {alpha_sql('scale_items', 'three', ('d', 't', 'q'))} union all {alpha_sql('scale_items', 'two', ('d', 't'))}
union all select 'gone', null, 0, 2, 'missing_columns:zz'""")
def cronbach_alpha(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        (F.col("l_discount") * 100).alias("d"), (F.col("l_tax") * 100).alias("t"), (F.col("l_quantity") / 5).alias("q")
    )
    return tidy(reliability.cronbach_alpha(rows, {"three": ["d", "t", "q"], "two": ["d", "t"], "gone": ["d", "zz"]}))


ROWS = [f"l{k}" for k in LINE_NUMBERS]
POSITIVE = ("A", "R")


def positive_sql(column: str) -> str:
    return f"cast(coalesce(list_has_any(string_split({column}, '+'), ['A', 'R']), false) as integer)"


BINARY = f"binary_items as (select order_id, n_lines, {', '.join(f'{positive_sql(c)} as {c}' for c in ROWS)} from order_lines)"


@query("binary_item_matrix", f"with {ORDER_LINES}, {BINARY} select order_id, {', '.join(ROWS)} from binary_items")
def binary_item_matrix(spark, sf_dir):
    return reliability.binary_item_matrix(order_lines(spark, sf_dir), ROWS, POSITIVE, keep=["order_id"])


@query("cronbach_alpha_filled", f"with {ORDER_LINES}, {BINARY} {alpha_sql('binary_items', 'lines', ROWS)}")
def cronbach_alpha_filled(spark, sf_dir):
    return tidy(reliability.cronbach_alpha_filled(order_lines(spark, sf_dir), {"lines": (ROWS, POSITIVE)}))


@query("composite_index", f"""with {ORDER_LINES}, {BINARY}, a as ({alpha_sql('binary_items', 'lines', ROWS)})
select order_id, case when alpha >= 0.1 then round(({' + '.join(ROWS)}) / cast({len(ROWS)} as double) * 100, 6) end as lines,
  cast(null as double) as strict from binary_items, a""")
def composite_index(spark, sf_dir):
    rows = order_lines(spark, sf_dir)
    loose = reliability.composite_index(rows, {"lines": (ROWS, POSITIVE)}, keep=["order_id", *ROWS], threshold=0.1)
    return tidy(reliability.composite_index(loose, {"strict": (ROWS, POSITIVE)}, keep=["order_id", "lines"]))


@query("radar_series", f"""with {ORDER_LINES}, {BINARY} select region, item, round(value, 6) as value from (
  select case when n_lines > 4 then 'long' else 'short' end as region, {', '.join(f'avg({c}) * 100 as {c}' for c in ROWS)} from binary_items group by 1)
unpivot (value for item in ({', '.join(ROWS)}))""")
def radar_series(spark, sf_dir):
    rows = order_lines(spark, sf_dir).withColumn("region", F.when(F.col("n_lines") > 4, "long").otherwise("short"))
    return tidy(series.radar_series(rows, ROWS, POSITIVE, "region"))


# ---- everything under one policy ------------------------------------------------------------------

@query("analyze_dataset", f"""with {MIX}, {matrix_sql()}
select 'associations' as family, variable_a || ' ' || variable_b as item, effect as value from matrix
union all select 'frequencies', variable || ' ' || value, percent from ({frequency_sql('mix', ('discount', 'flag', 'line', 'priority'), MIX)})
union all select 'descriptives', variable, round(median, 6) from ({summary_sql('mix', NUMBERS, ctes=MIX)})
union all select 'reliability', scale, alpha from ({alpha_sql('mix', 'amounts', ('quantity', 'price'))})
union all select 'group_tests', outcome || ' ' || "group", statistic from ({compare_row('mix', 'quantity', 'line')})""")
def analyze_dataset(spark, sf_dir):
    found = analyze(mix(spark, sf_dir), MIX_TYPES, {"amounts": ["quantity", "price"]}, [("quantity", "line")])
    shape = {
        "associations": (F.concat_ws(" ", "variable_a", "variable_b"), "effect"),
        "frequencies": (F.concat_ws(" ", "variable", "value"), "percent"),
        "descriptives": (F.col("variable"), "median"), "reliability": (F.col("scale"), "alpha"),
        "group_tests": (F.concat_ws(" ", "outcome", "group"), "statistic"),
    }
    parts = [found[family].select(F.lit(family).alias("family"), item.alias("item"), F.col(value).alias("value")) for family, (item, value) in shape.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return tidy(out)
