"""Profiles, correlation, association and drift."""

from itertools import combinations

from pyspark.sql import functions as F

from marlstone.functions.columns import rounded
from marlstone.operators.profile import (
    chi_square,
    correlation,
    mutual_information,
    profile,
    profile_categories,
    rank_correlation,
    stability_index,
)
from marlstone.operators.quantiles import quantiles
from marlstone.operators.splits import before
from marlstone.plans.registry import query
from marlstone.sources.tables import read_table, spread

MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _profile_sql(column):
    # Moments in the population form, from power sums around the mean.
    return f"""
select '{column}' as "column", count(*) as n_rows, count(*) - count(x) as n_null, count(distinct x) as n_distinct,
       round(min(x), 4) as "min", round(max(x), 4) as "max", round(avg(x), 4) as mean, round(stddev_samp(x), 4) as stddev,
       round(avg((x - m) ** 3) / var_pop(x) ** 1.5, 4) as skewness, round(kurtosis_pop(x), 4) as kurtosis,
       round(quantile_cont(x, 0.25), 4) as q1, round(quantile_cont(x, 0.5), 4) as median, round(quantile_cont(x, 0.75), 4) as q3
from (select {column} as x, (select avg({column}) from lineitem) as m from lineitem)"""


@query(" union all ".join(_profile_sql(c) for c in MEASURES))
def profile_lineitem(spark, folder):
    return rounded(profile(spread(read_table(spark, folder, "lineitem", MEASURES)), MEASURES, exact_distinct=True), 4)


CATEGORIES = ("l_returnflag", "l_linestatus", "l_shipdate")


@query(
    "with c as ("
    + " union all ".join(
        f"select '{c}' as \"column\", strftime({c}, '%Y-%m-%d %H:%M:%S') as x, count(*) as n from lineitem group by {c}"
        if c == "l_shipdate"
        else f"select '{c}', {c}, count(*) from lineitem group by {c}"
        for c in reversed(CATEGORIES)
    )
    + """)
select "column", sum(n)::bigint as n_rows, coalesce(sum(n) filter (where x is null), 0)::bigint as n_null, count(x) as n_distinct,
       arg_min(x, (-n, x)) as top, max(n) as top_rows, round(ln(sum(n)) - sum(n * ln(n)) / sum(n), 6) as entropy
from c group by "column"
"""
)
def profile_categories_lineitem(spark, folder):
    return rounded(profile_categories(read_table(spark, folder, "lineitem", CATEGORIES), CATEGORIES))


@query("""
with q as (
  select l_returnflag, quantile_cont(l_extendedprice, [0.1, 0.5, 0.99]) as p, quantile_cont(l_quantity, [0.1, 0.5, 0.99]) as k
  from lineitem group by l_returnflag),
s as (select l_returnflag, unnest([1, 2, 3]) as i, p, k from q)
select l_returnflag, 'l_extendedprice' as "column", [0.1, 0.5, 0.99][i]::double as share, round(p[i], 4) as value from s
union all
select l_returnflag, 'l_quantity', [0.1, 0.5, 0.99][i]::double, round(k[i], 4) from s
""")
def quantiles_by_flag_lineitem(spark, folder):
    """The block form of exact quantiles, whatever the size of the table."""
    lines = read_table(spark, folder, "lineitem", ["l_returnflag", "l_extendedprice", "l_quantity"])
    found = quantiles(lines, ["l_extendedprice", "l_quantity"], [0.1, 0.5, 0.99], ["l_returnflag"])
    return rounded(found, 4, ["value"])


@query(
    " union all ".join(
        f"select '{x}' as x, '{y}' as y, round(corr({x}, {y}), 6) as r from lineitem" for x, y in combinations(MEASURES, 2)
    )
)
def correlation_lineitem(spark, folder):
    return rounded(correlation(read_table(spark, folder, "lineitem", MEASURES), MEASURES))


@query("""
with r as (
  select rank() over (order by l_quantity) + (count(*) over (partition by l_quantity) - 1) / 2.0 as a,
         rank() over (order by l_extendedprice) + (count(*) over (partition by l_extendedprice) - 1) / 2.0 as b
  from lineitem)
select 'l_quantity' as x, 'l_extendedprice' as y, round(corr(a, b), 6) as r from r
""")
def rank_correlation_lineitem(spark, folder):
    lines = read_table(spark, folder, "lineitem", ["l_quantity", "l_extendedprice"])
    return rounded(rank_correlation(lines, "l_quantity", "l_extendedprice"))


@query("""
with c as (select o_orderpriority as a, o_orderstatus as b, count(*) as c from orders group by 1, 2),
m as (select *, sum(c) over (partition by a) as ca, sum(c) over (partition by b) as cb, sum(c) over () as n from c)
select 'o_orderpriority' as x, 'o_orderstatus' as y, max(n)::bigint as n,
       round(sum(c / n * ln(c * n / (ca * cb))), 6) as mutual_information,
       round(-sum(c / n * ln(ca / n)), 6) as entropy_x, round(-sum(c / n * ln(cb / n)), 6) as entropy_y
from (select a, b, c::double as c, ca::double as ca, cb::double as cb, n::double as n from m)
""")
def mutual_information_orders(spark, folder):
    orders = read_table(spark, folder, "orders", ["o_orderpriority", "o_orderstatus"])
    return rounded(mutual_information(orders, "o_orderpriority", "o_orderstatus"))


@query("""
with c as (select o_orderpriority as a, o_orderstatus as b, count(*)::double as c from orders group by 1, 2),
ra as (select a, sum(c) as ca from c group by a), rb as (select b, sum(c) as cb from c group by b),
n as (select sum(c) as n, count(distinct a) as ka, count(distinct b) as kb from c),
x as (
  select sum((coalesce(c.c, 0) - ca * cb / n) ** 2 / (ca * cb / n)) as chi2, max(n) as n, max(ka) as ka, max(kb) as kb
  from ra cross join rb cross join n left join c on c.a = ra.a and c.b = rb.b)
select 'o_orderpriority' as x, 'o_orderstatus' as y, n::bigint as n, round(chi2, 6) as chi2, (ka - 1) * (kb - 1) as dof,
       round(sqrt(chi2 / (n * (least(ka, kb) - 1))), 6) as cramers_v
from x
""")
def chi_square_orders(spark, folder):
    orders = read_table(spark, folder, "orders", ["o_orderpriority", "o_orderstatus"])
    return rounded(chi_square(orders, "o_orderpriority", "o_orderstatus"))


@query("""
with q as (select quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) as q from events where ts < timestamp '2024-01-08'),
b as (
  select date_trunc('week', ts)::timestamp as week, ts < timestamp '2024-01-08' as base,
         len(list_filter(q, lambda e: value >= e)) as bin from events, q),
p as (select bin, count(*) / (select count(*) from b where base) as p from b where base group by bin),
w as (select week, count(*) as n from b group by week),
g as (select week, n, bin, p from w cross join p),
c as (select week, bin, count(*) as c from b group by week, bin),
s as (select g.week, g.n, greatest(p, 1e-6) as p, greatest(coalesce(c, 0) / g.n, 1e-6) as q from g left join c using (week, bin))
select week, n, round(sum((q - p) * ln(q / p)), 6) as psi from s group by week, n
""")
def drift_by_week_events(spark, folder):
    events = read_table(spark, folder, "events", ["ts", "value"]).withColumn(
        "week", F.date_trunc("week", "ts").cast("timestamp_ntz")
    )
    base = before(events, "ts", "2024-01-08")
    return rounded(stability_index(base, events, "value", 10, ["week"]))
