"""Registered queries: factors, segments, projection."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.tables import LINE_STATUSES, ORDER_LINES, RETURN_FLAGS, VISITS, order_lines, table, tidy, visits
from tallyframe.operators import series, structure

QUERIES, ORACLES = {}, {}


def query(name, sql=None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


GRID = [f"{flag}_{status}" for flag in RETURN_FLAGS for status in LINE_STATUSES]
ITEMS = ("l_quantity", "l_extendedprice", "l_discount", "one")


def corr_sql(a: str, b: str) -> str:
    value = "1.0" if a == b else "0.0" if "one" in (a, b) else f"round(corr({a}, {b}), 6)"
    return f"select '{a}' as item_a, '{b}' as item_b, cast({value} as double) as r from lineitem" + (" limit 1" if "corr" not in value else "")


@query("item_correlation", " union all ".join(f"({corr_sql(a, b)})" for a in ITEMS for b in ITEMS))
def item_correlation(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").withColumn("one", F.lit(1.0))
    return tidy(structure.item_correlation(rows, ITEMS))


# ---- factors in SQL: Jacobi rotations of the correlations, then planar rotations of the loadings ----

def jacobi_sql(name: str, matrix: str, size: int, sweeps: int = 12) -> str:
    """CTEs that end in `name` (factor, value, vector): eigenvalues from the largest, of the one row `matrix` (a), a symmetric
    matrix as one list, row by row. A step turns one pair of axes so that their cell becomes 0."""
    pairs = [(p, q) for p in range(1, size + 1) for q in range(p + 1, size + 1)]

    def turned(cells: str, row: bool) -> str:
        place, first, second = ("k // {n} + 1", "(p - 1) * {n} + k % {n} + 1", "(q - 1) * {n} + k % {n} + 1") if row else ("k % {n} + 1", "k // {n} * {n} + p", "k // {n} * {n} + q")
        place, first, second = (text.format(n=size) for text in (place, first, second))
        return (f"list_transform(range(0, {size * size}), lambda k: case when {place} = p then c * {cells}[{first}] - s * {cells}[{second}]"
                f" when {place} = q then s * {cells}[{first}] + c * {cells}[{second}] else {cells}[k + 1] end)")

    cell = lambda i, j: f"a[({i} - 1) * {size} + {j}]"
    angle = f"case when {cell('p', 'q')} = 0 then 0 when {cell('p', 'p')} = {cell('q', 'q')} then pi() / 4 * sign({cell('p', 'q')}) else atan(2 * {cell('p', 'q')} / ({cell('q', 'q')} - {cell('p', 'p')})) / 2 end"
    return f"""{name}_steps as (
  select 0 as step, a, list_transform(range(0, {size * size}), lambda k: cast(case when k // {size} = k % {size} then 1 else 0 end as double)) as v from {matrix}
  union all
  select step + 1, {turned('half', True)}, v from (
    select step, p, q, c, s, {turned('a', False)} as half, {turned('v', False)} as v from (
      select step, a, v, p, q, cos(phi) as c, sin(phi) as s from (
        select *, {angle} as phi from (select step, a, v, {[p for p, _ in pairs]}[step % {len(pairs)} + 1] as p, {[q for _, q in pairs]}[step % {len(pairs)} + 1] as q from {name}_steps where step < {sweeps * len(pairs)}))))),
{name} as (select row_number() over (order by value desc) as factor, value, vector from (
  select a[(i - 1) * {size} + i] as value, list_transform(range(0, {size}), lambda k: v[k * {size} + i]) as vector
  from (select a, v, unnest(range(1, {size + 1})) as i from {name}_steps where step = {sweeps * len(pairs)})))"""


def pearson_sql(a: str, b: str) -> str:
    return "cast(1 as double)" if a == b else f"case when stddev_pop({a}) > 0 and stddev_pop({b}) > 0 then corr({a}, {b}) else 0 end"


P = len(GRID)
FACTORS = f"""with recursive {ORDER_LINES},
correlations as (select [{', '.join(pearson_sql(a, b) for a in GRID for b in GRID)}] as a from order_lines),
{jacobi_sql('eigen', 'correlations', P)},
kept as (select greatest(1, count(*) filter (value > 1)) as m from eigen),
turns as (
  select 0 as step, list(list_transform(vector, lambda x: x * sqrt(greatest(value, 0))) order by factor) as cols from eigen, kept where factor <= m
  union all
  select step + 1, list_transform(cols, lambda col, i: case when i = f then list_transform(range(1, {P + 1}), lambda k: x[k] * cos(t) + y[k] * sin(t)) when i = g then list_transform(range(1, {P + 1}), lambda k: y[k] * cos(t) - x[k] * sin(t)) else col end)
  from (select *, atan2(2 * list_sum(list_transform(range(1, {P + 1}), lambda k: u[k] * v[k])) - 2 * list_sum(u) * list_sum(v) / {P},
      list_sum(list_transform(range(1, {P + 1}), lambda k: u[k] * u[k] - v[k] * v[k])) - (pow(list_sum(u), 2) - pow(list_sum(v), 2)) / {P}) / 4 as t
    from (select *, list_transform(range(1, {P + 1}), lambda k: x[k] * x[k] - y[k] * y[k]) as u, list_transform(range(1, {P + 1}), lambda k: 2 * x[k] * y[k]) as v
      from (select step, cols, f, g, cols[f] as x, cols[g] as y
        from (select step, cols, pairs[step % len(pairs) + 1][1] as f, pairs[step % len(pairs) + 1][2] as g
          from (select step, cols, list_filter(flatten(list_transform(range(1, len(cols) + 1), lambda i: list_transform(range(1, len(cols) + 1), lambda j: [i, j]))), lambda e: e[1] < e[2]) as pairs from turns)
          where step < 60 * len(pairs)))))),
columns_ as (select unnest(cols) as col, generate_subscripts(cols, 1) as factor from (select arg_max(cols, step) as cols from turns)),
signed as (select factor, list_transform(col, lambda x: x * case when list_max(col) >= -list_min(col) then 1 else -1 end) as col from columns_),
loadings as (select [{', '.join(f"'{name}'" for name in GRID)}][i] as item, cast(factor as integer) as factor, col[i] as loading from (select factor, col, unnest(range(1, {P + 1})) as i from signed))"""


def factors(spark, sf_dir):
    return structure.factor_extraction(order_lines(spark, sf_dir), GRID)


@query("factor_extraction", f"{FACTORS} select item, factor, round(loading, 6) as loading from loadings")
def factor_extraction(spark, sf_dir):
    return tidy(factors(spark, sf_dir).loadings)


@query("factor_grouping", f"""{FACTORS}, strongest as (select item, arg_max(factor, abs(loading)) as factor, max(abs(loading)) as size from loadings group by item)
select factor, string_agg(item, ',' order by item) as items from strongest where size >= 0.4 group by factor having count(*) >= 2""")
def factor_grouping(spark, sf_dir):
    return structure.factor_grouping(factors(spark, sf_dir).loadings).withColumn("items", F.array_join("items", ","))


@query("scree_series", f"{FACTORS} select cast(factor as integer) as factor, round(value, 6) as eigenvalue from eigen")
def scree_series(spark, sf_dir):
    return tidy(series.scree_series(spark, factors(spark, sf_dir).eigenvalues))


FEATURES = {"clicks": "t__click", "buys": "t__purchase", "spent": "spent", "events": "n_events"}


def features(spark, sf_dir):
    """Feature rows of visits."""
    return structure.segment_features(visits(spark, sf_dir), {"clicks": F.col("t__click"), "buys": F.col("t__purchase"), "spent": F.col("spent"), "events": F.col("n_events")}, keep=["record_id"])


def gaps(spark, sf_dir):
    """The same with some indicators and sums not known, for filling in."""
    return features(spark, sf_dir).withColumns({"clicks": F.when(F.col("events") > 2, F.col("clicks")), "spent": F.when(F.col("events") > 1, F.col("spent"))})


FEATURE_ROWS = f"""{VISITS}, f as (select record_id, cast(t__click as double) as clicks, cast(t__purchase as double) as buys,
  spent, cast(n_events as double) as events from visits)"""
GAP_ROWS = f"{FEATURE_ROWS}, g as (select * replace (case when events > 2 then clicks end as clicks, case when events > 1 then spent end as spent) from f)"
IMPUTED = f"""{GAP_ROWS}, i as (select record_id, coalesce(clicks, (select clicks from g where clicks is not null group by clicks order by count(*) desc, clicks limit 1)) as clicks,
  buys, coalesce(spent, (select quantile_cont(spent, 0.5) from g)) as spent, events from g)"""


@query("segment_features", f"with {FEATURE_ROWS} select * replace (round(spent, 6) as spent) from f")
def segment_features(spark, sf_dir):
    return tidy(features(spark, sf_dir))


def imputed(spark, sf_dir):
    return structure.impute_central(gaps(spark, sf_dir), median_columns=["spent"], mode_columns=["clicks", "buys"])


@query("impute_central", f"with {IMPUTED} select * replace (round(spent, 6) as spent) from i")
def impute_central(spark, sf_dir):
    return tidy(imputed(spark, sf_dir))


@query("standardise", f"with {FEATURE_ROWS} select record_id, {', '.join(f'round(({n} - (select avg({n}) from f)) / (select stddev_pop({n}) from f), 6) as {n}' for n in FEATURES)} from f")
def standardise(spark, sf_dir):
    return tidy(structure.standardise(features(spark, sf_dir), list(FEATURES)))


def sweep(spark, sf_dir):
    scaled = structure.standardise(imputed(spark, sf_dir), list(FEATURES))
    return scaled, structure.kmeans_sweep(scaled, list(FEATURES))


# ---- k-means in SQL: every run is one row whose centres step until they rest -----------------------

AXES = range(1, len(FEATURES) + 1)


def apart_sql(left: str, right: str) -> str:
    """Squared distance of two lists, to nine digits."""
    return f"round({' + '.join(f'pow({left}[{a}] - {right}[{a}], 2)' for a in AXES)}, 9)"


def draw_sql(restart: int) -> str:
    digest = f"md5('42,{restart // 4},' || array_to_string(list_transform(x, lambda c: cast(cast(round(c * 1000000) as bigint) as varchar)), ','))"
    return f"-ln((cast(cast('0x' || substr({digest}, {8 * (restart % 4) + 1}, 8) as bigint) as double) + cast(0.5 as double)) / cast(4294967296 as double)) / w"


NEAREST = f"list_transform(cs, lambda c: {apart_sql('x', 'c')})"
MOVED = f"list_sum(list_transform(range(1, len(cs) + 1), lambda i: {' + '.join(f'pow(new_cs[i][{a}] - cs[i][{a}], 2)' for a in AXES)})) > cast(0.0001 as double)"
SWEEP = f"""with recursive {IMPUTED},
m as (select {', '.join(f'avg({n}) as m_{n}, stddev_pop({n}) as s_{n}' for n in FEATURES)} from i),
z as (select [{', '.join(f'round(({n} - m_{n}) / s_{n}, 9)' for n in FEATURES)}] as x from i, m),
v as (select x, cast(count(*) as double) as w from z group by x),
d as ({' union all '.join(f'select {r} as r, x, {draw_sql(r)} as t from v' for r in range(10))}),
firsts as (select r, x, row_number() over (partition by r order by t, x) as place from d qualify place <= 4),
starts as (select k, r, list(x order by place) as cs from firsts, (values (2), (3), (4)) as ks(k) where place <= k group by k, r),
steps as (
  select k, r, 0 as step, cs, true as moves from starts
  union all
  select k, r, step + 1, new_cs, {MOVED} from (
    select k, r, step, any_value(cs) as cs, list_transform(any_value(cs), lambda c, i: coalesce(list_filter(list(struct_pack(place := place, mean := mean)), lambda e: e.place = i)[1].mean, c)) as new_cs
    from (select k, r, step, any_value(cs) as cs, list_position(ds, list_min(ds)) as place, [{', '.join(f'round(sum(w * x[{a}]) / sum(w), 9)' for a in AXES)}] as mean
      from (select steps.*, x, w, {NEAREST} as ds from steps, v where moves and step < 300) group by k, r, step, list_position(ds, list_min(ds)))
    group by k, r, step)),
rest as (select k, r, arg_max(cs, step) as cs from steps group by k, r),
ends as (select k, r, any_value(cs) as cs, sum(w * list_min(ds)) as cost, count(distinct list_position(ds, list_min(ds))) as n_clusters from (select rest.*, x, w, {NEAREST} as ds from rest, v) group by k, r),
best as (select k, r, cs, cost, n_clusters from ends qualify row_number() over (partition by k order by round(cost, 6), r) = 1)"""


def sweep(spark, sf_dir):
    scaled = structure.standardise(imputed(spark, sf_dir), list(FEATURES))
    return scaled, structure.kmeans_sweep(scaled, list(FEATURES))


@query("kmeans_sweep", f"{SWEEP} select cast(k as integer) as k, cast(n_clusters as integer) as n_clusters, round(cost, 6) as cost from best")
def kmeans_sweep(spark, sf_dir):
    from tallyframe.sources.dimensions import small_table

    _, models = sweep(spark, sf_dir)
    rows = [(k, int((model.sizes > 0).sum()), model.cost) for k, model in models.items()]
    return tidy(small_table(spark, rows, "k int, n_clusters int, cost double"))


@query("silhouette_select", f"""{SWEEP},
a as (select k, x, w, list_position(ds, list_min(ds)) as own from (select best.k, x, w, {NEAREST} as ds from best, v)),
sizes as (select k, own, sum(w) as n from a group by k, own),
far as (select p.k, p.x, p.w, p.own, q.own as other, sum(q.w * sqrt({' + '.join(f'pow(p.x[{d}] - q.x[{d}], 2)' for d in AXES)})) as total from a p join a q on p.k = q.k group by all),
s as (select far.k, far.x, far.w, any_value(mine.n) as n, max(total) filter (other = far.own) / greatest(any_value(mine.n) - 1, 1) as inside, min(total / sizes.n) filter (other <> far.own) as outside
  from far join sizes on sizes.k = far.k and sizes.own = other join sizes mine on mine.k = far.k and mine.own = far.own group by far.k, far.x, far.w, far.own),
scores as (select k, sum(w * case when n > 1 and outside is not null and greatest(inside, outside) > 0 then (outside - inside) / greatest(inside, outside) else 0 end) / sum(w) as silhouette from s group by k)
select cast(k as integer) as k, round(silhouette, 6) as silhouette, k = (select k from scores order by round(silhouette, 9) desc, k limit 1) as chosen from scores""")
def silhouette_select(spark, sf_dir):
    return tidy(structure.segment(imputed(spark, sf_dir), "record_id", list(FEATURES)).scores)


DIMENSIONS = 64


def vectors(spark, sf_dir):
    """Embedding components as columns, with the given label as cluster."""
    cells = [F.col("embedding")[i].cast("double").alias(f"d{i}") for i in range(DIMENSIONS)]
    return table(spark, sf_dir, "embeddings").select("vec_id", F.col("label").alias("cluster"), *cells)


COMPONENTS = [f"d{i}" for i in range(DIMENSIONS)]
VECTORS = f"v as (select vec_id, label as cluster, {', '.join(f'cast(embedding[{i + 1}] as double) as d{i}' for i in range(DIMENSIONS))} from embeddings)"


@query("cluster_profile", f"with {VECTORS} select cluster, count(*) as n, {', '.join(f'round(avg({d}), 6) as {d}' for d in COMPONENTS)}, round(count(*) / cast((select count(*) from v) as double), 6) as share from v group by 1")
def cluster_profile(spark, sf_dir):
    return tidy(structure.cluster_profile(vectors(spark, sf_dir), COMPONENTS))


@query("cluster_highlights", f"""with {VECTORS}, m as (select cluster, feature, mean from (select cluster, {', '.join(f'avg({d}) as {d}' for d in COMPONENTS)} from v group by 1) unpivot (mean for feature in ({', '.join(COMPONENTS)}))),
o as (select feature, overall from (select {', '.join(f'avg({d}) as {d}' for d in COMPONENTS)} from v) unpivot (overall for feature in ({', '.join(COMPONENTS)}))),
r as (select m.*, overall, row_number() over (partition by cluster order by abs(mean - overall) desc, m.feature) as position from m join o on o.feature = m.feature)
select cluster, cast(position as integer) as position, feature, round(mean, 6) as mean, round(overall, 6) as overall, case when mean > overall then 'higher' else 'lower' end as direction from r where position <= 4""")
def cluster_highlights(spark, sf_dir):
    return tidy(structure.cluster_highlights(vectors(spark, sf_dir), COMPONENTS))


def axis_sql(name: str, matrix: str, squarings: int = 20) -> str:
    """CTEs that end in `name` (i, x): the eigenvector of the largest eigenvalue of `matrix` (i, j, x), its largest component positive.
    The matrix is squared again and again, scaled by its trace, until only this eigenvector is left in it; the rest shrinks like
    the ratio of the eigenvalues to the power 2^squarings."""
    return f"""{name}_powers as (
  select 0 as step, i, j, x from {matrix}
  union all
  select step, i, j, x / sum(x) filter (i = j) over () as x from (select any_value(a.step) + 1 as step, a.i, b.j, sum(a.x * b.x) as x from {name}_powers a join {name}_powers b on a.j = b.i where a.step < {squarings} group by a.i, b.j)),
{name}_column as (select i, x from {name}_powers where step = {squarings} and j = (select j from {name}_powers where step = {squarings} and i = j order by x desc limit 1)),
{name} as (select i, x / sqrt((select sum(x * x) from {name}_column)) * (select sign(arg_max(x, abs(x))) from {name}_column) as x from {name}_column)"""


PLANE = f"""with recursive {VECTORS},
long as (select vec_id, cast(substr(name, 2) as integer) as i, x from (select * exclude (cluster) from v) unpivot (x for name in ({', '.join(COMPONENTS)}))),
centred as (select vec_id, i, x - avg(x) over (partition by i) as x from long),
cov as (select a.i, b.i as j, sum(a.x * b.x) / (select count(*) from v) as x from centred a join centred b using (vec_id) group by a.i, b.i),
{axis_sql('one', 'cov')},
size as (select sum(p.x * cov.x * q.x) as value from cov join one p on p.i = cov.i join one q on q.i = cov.j),
rest as (select cov.i, cov.j, cov.x - value * p.x * q.x as x from size, cov join one p on p.i = cov.i join one q on q.i = cov.j),
{axis_sql('two', 'rest')}"""


@query("pca_2d", f"{PLANE} select vec_id, round(sum(centred.x * one.x), 6) as axis_1, round(sum(centred.x * two.x), 6) as axis_2 from centred join one using (i) join two using (i) group by vec_id")
def pca_2d(spark, sf_dir):
    return tidy(structure.pca_2d(vectors(spark, sf_dir), "vec_id", COMPONENTS))
