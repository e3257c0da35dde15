"""Streams over the events and documents tables as file sources, run until all that has arrived is done."""

from marlstone.functions.columns import rounded
from marlstone.operators.profile import base_shares
from marlstone.operators.scale import fit_bins
from marlstone.operators.splits import before
from marlstone.plans.model_queries import text_model
from marlstone.plans.registry import query
from marlstone.session import shared_dir
from marlstone.sources.tables import read_table, stream_table
from marlstone.streaming.features import drift_features, run_to_table, score_stream, session_features, window_features

# Only windows and sessions that end before the watermark are final; the SQL says so too.
CLOSED = "(select max(ts) - interval 1 hour from events)"


@query(f"""
select date_trunc('day', ts)::timestamp as window_start, date_trunc('day', ts)::timestamp + interval 1 day as window_end, event_type,
       count(*) as n, round(sum(value), 6) as total, round(avg(value), 9) as mean, min(value) as smallest, max(value) as largest
from events group by 1, 2, 3 having window_end <= {CLOSED}
""")
def stream_daily_windows(spark, folder):
    made = window_features(stream_table(spark, folder, "events"), ["event_type"], "ts", "value", "1 day", "1 hour")
    return rounded(run_to_table(spark, made), mean=9)


@query(f"""
with w as (
  select time_bucket(interval 6 hours, ts) - to_hours(6 * k) as window_start, event_type, value
  from events, range(0, 2) r(k))
select window_start::timestamp as window_start, (window_start + interval 12 hours)::timestamp as window_end, event_type, count(*) as n,
       round(sum(value), 6) as total, round(avg(value), 9) as mean, min(value) as smallest, max(value) as largest
from w group by 1, 2, 3 having window_end <= {CLOSED}
""")
def stream_sliding_windows(spark, folder):
    made = window_features(stream_table(spark, folder, "events"), ["event_type"], "ts", "value", "12 hours", "1 hour", "6 hours")
    return rounded(run_to_table(spark, made), mean=9)


@query(f"""
with g as (
  select *, case when epoch_us(ts) - epoch_us(lag(ts) over (partition by user_id order by ts)) <= 1800000000 then 0 else 1 end as starts
  from events),
s as (select *, sum(starts) over (partition by user_id order by ts) as session from g)
select user_id, min(ts) as session_start, max(ts) as session_end, count(*) as events, round(sum(value), 6) as total
from s group by user_id, session having max(ts) + interval 30 minutes <= {CLOSED}
""")
def stream_sessions(spark, folder):
    made = session_features(stream_table(spark, folder, "events"), ["user_id"], "ts", "value", "30 minutes", "1 hour")
    return rounded(run_to_table(spark, made))


@query(f"""
with q as (select quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) as q from events where ts < timestamp '2024-01-08'),
b as (
  select date_trunc('day', ts)::timestamp as day, ts < timestamp '2024-01-08' as base,
         len(list_filter(q, lambda e: value >= e)) as bin from events, q),
p as (select bin, count(*) / (select count(*) from b where base) as p from b where base group by bin),
w as (select day, count(*) as n from b group by day),
c as (select day, bin, count(*) as c from b group by day, bin),
s as (
  select w.day, w.n, greatest(p, 1e-6) as p, greatest(coalesce(c, 0) / w.n, 1e-6) as q
  from w cross join p left join c on c.day = w.day and c.bin = p.bin)
select day as window_start, day + interval 1 day as window_end, n, round(sum((q - p) * ln(q / p)), 6) as psi
from s group by day, n having day + interval 1 day <= {CLOSED}
""")
def stream_drift(spark, folder):
    events = read_table(spark, folder, "events", ["ts", "value"])
    base = before(events, "ts", "2024-01-08")
    edges = fit_bins(base, "value", 10, "quantile")
    shares = base_shares(base, "value", edges)
    made = drift_features(stream_table(spark, folder, "events").select("ts", "value"), "ts", "value", "1 day", "1 hour", edges, shares)
    return rounded(run_to_table(spark, made))


@query()
def stream_scores(spark, folder):
    """The documents scored as a stream with a saved model; the same rows as ``batch_score_documents``."""
    path = shared_dir(spark, "text-model")
    text_model(spark, folder).write().save(path)
    docs = stream_table(spark, folder, "documents").select("doc_id", "text")
    return rounded(run_to_table(spark, score_stream(docs, path, ["doc_id"])))
