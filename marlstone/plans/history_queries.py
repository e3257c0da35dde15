"""Time features of entities."""

from marlstone.functions.columns import rounded
from marlstone.operators.history import asof, calendar, entity_aggregate, lags, rolling, sessions
from marlstone.plans.registry import query
from marlstone.sources.tables import read_table


@query("""
select o_orderkey, year(o_orderdate)::int as "year", quarter(o_orderdate)::int as "quarter", month(o_orderdate)::int as "month",
       day(o_orderdate)::int as "day", isodow(o_orderdate)::int as isodow, week(o_orderdate)::int as isoweek, hour(o_orderdate)::int as "hour"
from orders
""")
def calendar_orders(spark, folder):
    return calendar(read_table(spark, folder, "orders", ["o_orderkey", "o_orderdate"]), "o_orderdate").drop("o_orderdate")


@query("""
select user_id, ts, count(value) over w as past_count, round(coalesce(sum(value) over w, 0), 6) as past_sum,
       round(avg(value) over w, 9) as past_mean, round(min(value) over w, 6) as past_min, round(max(value) over w, 6) as past_max
from events
window w as (partition by user_id order by ts range between interval 7 days preceding and interval 1 microsecond preceding)
""")
def rolling_week_events(spark, folder):
    events = read_table(spark, folder, "events", ["user_id", "ts", "value"])
    # Means of cents often end in a 5 at the seventh place, where the order of adding would decide the rounding.
    return rounded(rolling(events, "user_id", "ts", "value", 7 * 86_400), past_mean=9)


MONTH_SQL = """
select distinct l_suppkey, l_shipdate, count(*) over w as past_count, round(coalesce(sum(l_quantity) over w, 0), 6) as past_sum,
       min(l_quantity) over w as past_min, max(l_quantity) over w as past_max
from lineitem
window w as (partition by l_suppkey order by l_shipdate range between interval 30 days preceding and interval 1 microsecond preceding)
"""


def _supplier_month(spark, folder, **options):
    lines = read_table(spark, folder, "lineitem", ["l_suppkey", "l_shipdate", "l_quantity"])
    return rounded(rolling(lines, "l_suppkey", "l_shipdate", "l_quantity", 30 * 86_400, **options).drop("past_mean"))


@query(MONTH_SQL)
def rolling_month_suppliers(spark, folder):
    """What a supplier shipped in the 30 days before each of its shipping days."""
    return _supplier_month(spark, folder)


@query(MONTH_SQL)
def rolling_month_suppliers_sliced(spark, folder):
    """The same in the sliced form, which the size check would choose for busier keys."""
    return _supplier_month(spark, folder, frame_rows=0)


@query("""
select user_id, ts, value, lag(value) over w as value_lag1, round(value - lag(value) over w, 6) as value_change1,
       round((epoch_us(ts) - epoch_us(lag(ts) over w)) / 1e6, 6) as seconds_since1,
       lag(value, 2) over w as value_lag2, round(value - lag(value, 2) over w, 6) as value_change2,
       round((epoch_us(ts) - epoch_us(lag(ts, 2) over w)) / 1e6, 6) as seconds_since2
from events window w as (partition by user_id order by ts)
""")
def lags_events(spark, folder):
    events = read_table(spark, folder, "events", ["event_id", "user_id", "ts", "value"])
    return rounded(lags(events, "user_id", "ts", "value", steps=2, tie="event_id"))


@query("""
with g as (
  select *, case when epoch_us(ts) - epoch_us(lag(ts) over (partition by user_id order by ts)) <= 1800000000 then 0 else 1 end as starts
  from events),
s as (select *, sum(starts) over (partition by user_id order by ts) as session from g)
select user_id, session::bigint as session, min(ts) as session_start, max(ts) as session_end, count(*) as events,
       round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 6) as seconds, round(sum(value), 6) as value_sum
from s group by user_id, session
""")
def sessions_events(spark, folder):
    return rounded(sessions(read_table(spark, folder, "events", ["user_id", "ts", "value"]), "user_id", "ts", 1_800, "value"))


@query("""
select l.event_id, l.user_id, l.ts, r.ts as asof_ts, r.event_id as asof_event_id, r.value as asof_value
from (select * from events where event_type = 'purchase') l
asof left join (select * from events where event_type = 'click') r on l.user_id = r.user_id and l.ts > r.ts
""")
def asof_click_before_purchase(spark, folder):
    events = read_table(spark, folder, "events", ["event_id", "user_id", "ts", "event_type", "value"])
    purchases = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    clicks = events.where("event_type = 'click'").select("event_id", "user_id", "ts", "value")
    return asof(purchases, clicks, "user_id", "ts", "ts", ["event_id", "value"], tie="event_id")


@query("""
with o as (select *, o_orderdate < timestamp '2000-01-01' as past from orders)
select o_custkey, count(*) filter (where past) as n,
       count(*) filter (where past and o_orderdate >= timestamp '2000-01-01' - interval 365 days) as n_last_year,
       round(coalesce(sum(o_totalprice) filter (where past), 0), 6) as total, round(avg(o_totalprice) filter (where past), 6) as mean,
       min(o_totalprice) filter (where past) as smallest, max(o_totalprice) filter (where past) as largest,
       round(stddev_samp(o_totalprice) filter (where past), 6) as spread,
       date_diff('day', max(o_orderdate) filter (where past), timestamp '2000-01-01')::int as days_since_last
from o group by o_custkey
""")
def customer_history_orders(spark, folder):
    orders = read_table(spark, folder, "orders", ["o_custkey", "o_orderdate", "o_totalprice"])
    return rounded(entity_aggregate(orders, "o_custkey", "o_orderdate", "o_totalprice", "2000-01-01"))


@query("""
select l_suppkey, l_shipdate, max(l_extendedprice) as l_extendedprice,
       lag(max(l_extendedprice)) over w as l_extendedprice_lag1,
       round(max(l_extendedprice) - lag(max(l_extendedprice)) over w, 6) as l_extendedprice_change1,
       (epoch_us(l_shipdate) - epoch_us(lag(l_shipdate) over w)) / 1e6 as seconds_since1
from lineitem group by l_suppkey, l_shipdate
window w as (partition by l_suppkey order by l_shipdate)
""")
def lags_suppliers_sliced(spark, folder):
    """A supplier's largest line of a day beside that of its shipping day before, in the sliced form."""
    lines = read_table(spark, folder, "lineitem", ["l_suppkey", "l_shipdate", "l_extendedprice"])
    return rounded(lags(lines, "l_suppkey", "l_shipdate", "l_extendedprice", window_rows=10))


@query("""
with o as (select o_custkey, o_orderdate, max(o_totalprice) as o_totalprice from orders group by 1, 2)
select l.o_orderkey, l.o_custkey, l.o_orderdate, r.o_orderdate as asof_o_orderdate, r.o_totalprice as asof_o_totalprice
from orders l asof left join o r on l.o_custkey = r.o_custkey and l.o_orderdate > r.o_orderdate
""")
def asof_earlier_order_sliced(spark, folder):
    """Each order with the customer's latest order of an earlier day, in the sliced form."""
    orders = read_table(spark, folder, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"])
    return asof(
        orders.drop("o_totalprice"), orders, "o_custkey", "o_orderdate", "o_orderdate", ["o_totalprice"], window_rows=5
    )
