"""Cleaning, scaling, binning and encoding. State is learned on the earlier rows and applied to all."""

from pyspark.sql import functions as F

from marlstone.functions.columns import rounded
from marlstone.operators.categories import (
    apply_index,
    apply_target_encode,
    fit_index,
    fit_target_encode,
    hash_features,
)
from marlstone.operators.clean import apply_clip, apply_impute, fit_clip, fit_impute
from marlstone.operators.scale import apply_bins, apply_scale, fit_bins, fit_scale
from marlstone.operators.splits import before, kfold
from marlstone.plans.registry import query
from marlstone.plans.split_queries import NUMBER
from marlstone.sources.tables import read_table, spread

EVENT_CUTOFF = "2024-01-21"


@query("""
with e as (
  select event_id, ts < timestamp '2024-01-21' as train,
         case when event_type <> 'error' then value end as amount,
         case when event_type <> 'error' then value end as median_amount,
         case when event_type <> 'signup' then event_type end as kind
  from events),
m as (select avg(amount) as a, quantile_cont(median_amount, 0.5) as q from e where train),
k as (select kind from e where train and kind is not null group by kind order by count(*) desc, kind limit 1)
select event_id, round(coalesce(amount, (select a from m)), 6) as amount, amount is null as amount_was_null,
       round(coalesce(median_amount, (select q from m)), 6) as median_amount, median_amount is null as median_amount_was_null,
       coalesce(kind, (select kind from k)) as kind, kind is null as kind_was_null
from e
""")
def impute_events(spark, folder):
    events = read_table(spark, folder, "events", ["event_id", "ts", "event_type", "value"])
    known = F.when(F.col("event_type") != "error", F.col("value"))
    gaps = events.select(
        "event_id",
        "ts",
        known.alias("amount"),
        known.alias("median_amount"),
        F.when(F.col("event_type") != "signup", F.col("event_type")).alias("kind"),
    )
    fills = fit_impute(before(gaps, "ts", EVENT_CUTOFF), {"amount": "mean", "median_amount": "median", "kind": "mode"})
    return rounded(apply_impute(gaps.drop("ts"), fills, flag=True))


@query("""
with q as (select quantile_cont(value, 0.05) as lo, quantile_cont(value, 0.95) as hi from events where ts < timestamp '2024-01-21')
select event_id, round(greatest(least(value, hi), lo), 6) as value from events, q
""")
def clip_events(spark, folder):
    events = read_table(spark, folder, "events", ["event_id", "ts", "value"])
    limits = fit_clip(before(events, "ts", EVENT_CUTOFF), ["value"], 0.05, 0.95)
    return rounded(apply_clip(events.select("event_id", "value"), limits))


@query("""
with s as (
  select avg(l_extendedprice) as m, stddev_samp(l_extendedprice) as d, min(l_extendedprice) as lo,
         max(l_extendedprice) - min(l_extendedprice) as w, quantile_cont(l_extendedprice, 0.5) as q2,
         quantile_cont(l_extendedprice, 0.75) - quantile_cont(l_extendedprice, 0.25) as iqr
  from lineitem where l_shipdate < timestamp '2000-01-01')
select l_orderkey, l_linenumber, round((l_extendedprice - m) / d, 6) as l_extendedprice_standard,
       round((l_extendedprice - lo) / w, 6) as l_extendedprice_minmax, round((l_extendedprice - q2) / iqr, 6) as l_extendedprice_robust
from lineitem, s
""")
def scale_lineitem(spark, folder):
    lines = spread(read_table(spark, folder, "lineitem", ["l_orderkey", "l_linenumber", "l_extendedprice", "l_shipdate"]))
    train = before(read_table(spark, folder, "lineitem", ["l_extendedprice", "l_shipdate"]), "l_shipdate", "2000-01-01")
    out = lines.select("l_orderkey", "l_linenumber", "l_extendedprice")
    for method in ("standard", "minmax", "robust"):
        out = apply_scale(out, fit_scale(train, ["l_extendedprice"], method), f"_{method}")
    return rounded(out.drop("l_extendedprice"))


@query("""
with e as (
  select min(c_acctbal) as lo, max(c_acctbal) as hi, quantile_cont(c_acctbal, [0.2, 0.4, 0.6, 0.8]) as q from customer)
select c_custkey, greatest(0, least(7, floor((c_acctbal - lo) / ((hi - lo) / 8))))::int as width_bin,
       ((c_acctbal >= q[1])::int + (c_acctbal >= q[2])::int + (c_acctbal >= q[3])::int + (c_acctbal >= q[4])::int)::int as quantile_bin
from customer, e
""")
def bin_customer(spark, folder):
    customers = read_table(spark, folder, "customer", ["c_custkey", "c_acctbal"])
    wide = apply_bins(customers, "c_acctbal", fit_bins(customers, "c_acctbal", 8, "width"), "width_bin")
    even = apply_bins(wide, "c_acctbal", fit_bins(customers, "c_acctbal", 5, "quantile"), "quantile_bin")
    return even.drop("c_acctbal")


@query("""
with c as (
  select event_type, row_number() over (order by count(*) desc, event_type) - 1 as idx
  from events where ts < timestamp '2024-01-21' and event_type <> 'signup' group by event_type)
select event_id, idx::int as event_type_idx,
       array_to_string(list_transform(range(0, (select count(*) from c)), lambda i: case when i = idx then '1' else '0' end), ' ') as event_type_onehot
from events left join c using (event_type)
""")
def onehot_events(spark, folder):
    events = read_table(spark, folder, "events", ["event_id", "ts", "event_type"])
    # 'signup' is kept out of the fit, so it is a category that was never seen.
    index = fit_index(before(events, "ts", EVENT_CUTOFF).where("event_type <> 'signup'"), "event_type")
    coded = apply_index(events.select("event_id", "event_type"), index, "event_type")
    flags = F.array_join(F.transform("event_type_onehot", lambda x: x.cast("int").cast("string")), " ")
    return coded.select("event_id", F.col("event_type_idx").cast("int").alias("event_type_idx"), flags.alias("event_type_onehot"))


@query(f"""
with o as (
  select o_orderkey, o_orderpriority, o_totalprice, ({NUMBER.format(key='o_orderkey')} % 5)::int as fold from orders),
a as (select o_orderpriority, sum(o_totalprice) as s, count(*) as n from o group by 1),
b as (select o_orderpriority, fold, sum(o_totalprice) as s, count(*) as n from o group by 1, 2),
f as (select fold, sum(o_totalprice) as s, count(*) as n from o group by 1),
w as (select sum(o_totalprice) as s, count(*) as n from o)
select o.o_orderkey, o.fold,
       round((a.s - b.s + 20 * (w.s - f.s) / (w.n - f.n)) / (a.n - b.n + 20), 3) as o_orderpriority_encoded
from o join a using (o_orderpriority) join b on b.o_orderpriority = o.o_orderpriority and b.fold = o.fold
join f on f.fold = o.fold, w
""")
def target_encode_orders(spark, folder):
    orders = kfold(read_table(spark, folder, "orders", ["o_orderkey", "o_orderpriority", "o_totalprice"]), "o_orderkey", 5)
    encodings = fit_target_encode(orders, "o_orderpriority", "o_totalprice", "fold", 20)
    coded = apply_target_encode(orders.select("o_orderkey", "o_orderpriority", "fold"), encodings, "o_orderpriority", "fold")
    return rounded(coded.drop("o_orderpriority"), 3)


@query("""
with p as (
  select event_id, unnest(['event_type=' || event_type, 'user_id=' || user_id, 'props=' || props]) as pair from events),
h as (
  select event_id, (('0x' || substr(md5(pair), 1, 7))::bigint % 32)::int as idx,
         case when ('0x' || substr(md5(pair), 8, 1))::bigint % 2 = 1 then -1.0 else 1.0 end::double as value from p)
select event_id, idx, sum(value)::double as value from h group by event_id, idx
""")
def hash_features_events(spark, folder):
    events = spread(read_table(spark, folder, "events", ["event_id", "event_type", "user_id", "props"]))
    hashed = hash_features(events, ["event_type", "user_id", "props"], 32)
    return hashed.select("event_id", F.explode("hashed").alias("h")).select("event_id", "h.idx", "h.value")
