"""Evaluation tables over predictions for every line item, and over neighbour lists and clusters."""

from pyspark.sql import functions as F

from marlstone.evaluate import scores
from marlstone.evaluate.classes import class_report, confusion
from marlstone.evaluate.numbers import regression_report
from marlstone.evaluate.rankings import cluster_report, ranking_report, ranking_summary, silhouette
from marlstone.functions.columns import rounded
from marlstone.models.linear import apply_line, fit_line
from marlstone.models.vectors import assign_nearest, fit_centroids, nearest_neighbours
from marlstone.plans.registry import query
from marlstone.sources.tables import read_table

# The target is "was returned"; the score is a fixed rule that maps the price into (0, 1), so it is the same double
# in any engine. Nearly every row has its own score. The quantity rule has 50 scores with many ties.
BY_PRICE = "l_extendedprice / (l_extendedprice + 30000.0)"
BY_QUANTITY = "l_quantity / 64.0"
SCORED = f"""
s as (
  select l_orderkey, l_linestatus, (l_returnflag = 'R')::int as y, {BY_PRICE} as price_score, {BY_QUANTITY} as quantity_score
  from lineitem)"""


def scored_lines(spark, folder):
    lines = read_table(
        spark, folder, "lineitem", ["l_orderkey", "l_linestatus", "l_returnflag", "l_quantity", "l_extendedprice"]
    )
    return lines.select(
        "l_orderkey",
        "l_linestatus",
        (F.col("l_returnflag") == "R").cast("int").alias("y"),
        F.expr(BY_PRICE).alias("price_score"),
        F.expr(BY_QUANTITY).alias("quantity_score"),
    )


@query("""
with f as (select l_returnflag as y, case when l_extendedprice < 35000 then 'A' when l_extendedprice < 70000 then 'N' else 'R' end as pred from lineitem),
g as (select * from (select distinct y from f) cross join (select distinct pred from f)),
c as (select y, pred, count(*) as n from f group by y, pred)
select y, pred, coalesce(n, 0)::bigint as n from g left join c using (y, pred)
""")
def confusion_lineitem(spark, folder):
    return confusion(_by_price_band(spark, folder), "y", "pred")


def _by_price_band(spark, folder):
    price = F.col("l_extendedprice")
    return read_table(spark, folder, "lineitem", ["l_returnflag", "l_extendedprice"]).select(
        F.col("l_returnflag").alias("y"), F.when(price < 35_000, "A").when(price < 70_000, "N").otherwise("R").alias("pred")
    )


@query("""
with f as (select l_returnflag as y, case when l_extendedprice < 35000 then 'A' when l_extendedprice < 70000 then 'N' else 'R' end as pred from lineitem),
k as (select y as class from f union select pred from f),
c as (
  select class, (select count(*) from f where y = class) as support, (select count(*) from f where pred = class) as predicted,
         (select count(*) from f where y = class and pred = class) as hits from k),
m as (
  select class, case when predicted = 0 then 0 else hits / predicted end as precision,
         case when support = 0 then 0 else hits / support end as recall, support, hits from c),
r as (select *, case when precision + recall = 0 then 0 else 2 * precision * recall / (precision + recall) end as f1 from m)
select 'class' as level, class, round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1, support from r
union all
select 'average', 'macro', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), sum(support)::bigint from r
union all
select 'average', 'micro', round(sum(hits) / sum(support), 6), round(sum(hits) / sum(support), 6), round(sum(hits) / sum(support), 6), sum(support)::bigint from r
union all
select 'average', 'weighted', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
       round(sum(f1 * support) / sum(support), 6), sum(support)::bigint from r
""")
def class_report_lineitem(spark, folder):
    return rounded(class_report(_by_price_band(spark, folder), "y", "pred"))


AUC_SQL = """
with {scored},
r as (
  select *, rank() over (partition by l_linestatus order by {score}) + (count(*) over (partition by l_linestatus, {score}) - 1) / 2.0 as rnk
  from s),
t as (select l_linestatus, sum(y)::bigint as n_pos, (count(*) - sum(y))::bigint as n_neg, sum(rnk) filter (where y = 1) as ranks from r group by l_linestatus)
select l_linestatus, n_pos, n_neg, round((ranks - n_pos::double * (n_pos + 1) / 2) / (n_pos::double * n_neg), 6) as auc from t
"""


@query(AUC_SQL.format(scored=SCORED, score="price_score"))
def auc_by_status_price(spark, folder):
    return rounded(scores.auc(scored_lines(spark, folder), "y", "price_score", ["l_linestatus"]))


@query(AUC_SQL.format(scored=SCORED, score="quantity_score"))
def auc_by_status_quantity(spark, folder):
    return rounded(scores.auc(scored_lines(spark, folder), "y", "quantity_score", ["l_linestatus"]))


@query(f"""
with {SCORED},
c as (select price_score as threshold, sum(y) as pos, count(*) - sum(y) as neg from s group by 1),
t as (
  select threshold, sum(pos) over (order by threshold desc) as tp, sum(neg) over (order by threshold desc) as fp,
         sum(pos) over () as p, sum(neg) over () as n from c)
select round(threshold, 9) as threshold, tp::bigint as tp, fp::bigint as fp, round(tp / p, 6) as tpr, round(fp / n, 6) as fpr from t
""")
def roc_lineitem(spark, folder):
    curve = scores.roc(scored_lines(spark, folder), "y", "price_score")
    return rounded(rounded(curve, 9, ["threshold"]), 6, ["tpr", "fpr"])


@query(f"""
with {SCORED},
c as (select l_linestatus, quantity_score as threshold, sum(y) as pos, count(*) - sum(y) as neg from s group by 1, 2),
t as (
  select l_linestatus, threshold, sum(pos) over w as tp, sum(neg) over w as fp, sum(pos) over (partition by l_linestatus) as p from c
  window w as (partition by l_linestatus order by threshold desc))
select l_linestatus, threshold, round(tp / (tp + fp), 6) as precision, round(tp / p, 6) as recall from t
""")
def pr_curve_by_status(spark, folder):
    return rounded(scores.pr_curve(scored_lines(spark, folder), "y", "quantity_score", ["l_linestatus"]))


@query(f"""
with {SCORED},
c as (select l_linestatus, price_score as x, sum(y) as pos, count(*) - sum(y) as neg from s group by 1, 2),
t as (
  select l_linestatus, pos, sum(pos) over w as tp, sum(neg) over w as fp, sum(pos) over (partition by l_linestatus) as p from c
  window w as (partition by l_linestatus order by x desc))
select l_linestatus, round(sum(pos / p * tp / (tp + fp)), 6) as average_precision from t group by l_linestatus
""")
def average_precision_by_status(spark, folder):
    return rounded(scores.average_precision(scored_lines(spark, folder), "y", "price_score", ["l_linestatus"]))


@query(f"""
with {SCORED},
c as (select *, least(greatest(price_score, 1e-15), 1 - 1e-15) as p from s)
select l_linestatus, count(*) as n, round(avg(y), 6) as base_rate, round(avg(price_score), 6) as mean_score,
       round(avg(-case when y = 1 then ln(p) else ln(1 - p) end), 6) as log_loss, round(avg((price_score - y) ** 2), 6) as brier
from c group by l_linestatus
""")
def probability_report_by_status(spark, folder):
    return rounded(scores.probability_report(scored_lines(spark, folder), "y", "price_score", ["l_linestatus"]))


@query(f"""
with {SCORED}
select greatest(least(floor(price_score * 10), 9), 0)::int as bin, count(*) as n, round(avg(price_score), 6) as mean_score,
       round(avg(y), 6) as positive_rate, round(avg(price_score) - avg(y), 6) as gap
from s group by 1
""")
def calibration_lineitem(spark, folder):
    return rounded(scores.calibration(scored_lines(spark, folder), "y", "price_score"))


@query(f"""
with {SCORED},
t as (select unnest([0.25, 0.5, 0.75])::double as threshold),
c as (
  select threshold, count(*) filter (where quantity_score >= threshold) as called,
         coalesce(sum(y) filter (where quantity_score >= threshold), 0)::bigint as tp, sum(y) as pos, count(*) as n
  from s cross join t group by threshold)
select threshold, called, tp, round(case when called = 0 then 0 else tp / called end, 6) as precision, round(tp / pos, 6) as recall,
       round((called - tp) / (n - pos), 6) as fpr from c
""")
def threshold_report_lineitem(spark, folder):
    return rounded(scores.threshold_report(scored_lines(spark, folder), "y", "quantity_score", [0.25, 0.5, 0.75]))


@query("""
with s as (
  select o_orderkey, (o_orderstatus = 'F')::int as y, floor(o_totalprice / 50000) as score,
         ('0x' || substr(md5(o_orderkey::varchar), 1, 7))::bigint as h from orders),
r as (
  select y, floor((row_number() over (order by score desc, h, o_orderkey) - 1) * 10 / (select count(*) from s))::int + 1 as band from s)
select band, count(*) as n, sum(y)::bigint as positives, round(avg(y), 6) as rate, round(avg(y) / (select avg(y) from s), 6) as lift
from r group by band
""")
def lift_orders(spark, folder):
    orders = read_table(spark, folder, "orders", ["o_orderkey", "o_orderstatus", "o_totalprice"]).select(
        "o_orderkey", (F.col("o_orderstatus") == "F").cast("int").alias("y"), F.floor(F.col("o_totalprice") / 50_000).alias("score")
    )
    return rounded(scores.lift(orders, "o_orderkey", "y", "score"))


@query("""
with l as (select l_returnflag, regr_slope(l_extendedprice, l_quantity) as b, regr_intercept(l_extendedprice, l_quantity) as a from lineitem group by 1),
e as (
  select l_returnflag, l_linestatus, l_extendedprice as y, a + b * l_quantity as p from lineitem join l using (l_returnflag))
select l_linestatus, count(*) as n, round(avg(abs(p - y)), 4) as mae, round(sqrt(avg((p - y) ** 2)), 4) as rmse, round(avg(p - y), 4) as bias,
       round(1 - sum((p - y) ** 2) / (var_pop(y) * count(*)), 4) as r2, round(quantile_cont(abs(p - y), 0.5), 4) as median_ae
from e group by l_linestatus
""")
def regression_report_lineitem(spark, folder):
    lines = read_table(spark, folder, "lineitem", ["l_returnflag", "l_linestatus", "l_quantity", "l_extendedprice"])
    fitted = fit_line(lines, "l_quantity", "l_extendedprice", ["l_returnflag"])
    scored = apply_line(lines, fitted, "l_quantity", ["l_returnflag"])
    return rounded(regression_report(scored, "l_extendedprice", "pred", ["l_linestatus"]), 4)


NEIGHBOURS_SQL = """
v as (select vec_id, label, embedding::double[] as e, sqrt(list_dot_product(embedding::double[], embedding::double[])) as size from embeddings),
p as (
  select q.vec_id as query_id, b.vec_id as base_id, list_dot_product(q.e, b.e) / (q.size * b.size) as similarity,
         (q.label = b.label)::int as rel
  from v q join v b on q.vec_id <> b.vec_id),
n as (select *, row_number() over (partition by query_id order by similarity desc, base_id) as place from p)"""


@query(f"""
with {NEIGHBOURS_SQL},
t as (select *, sum(rel) over (partition by query_id order by place) as hits from n where place <= 10),
w as (select query_id, sum(rel) as wanted from t group by query_id),
i as (select m, sum(1 / log2(j + 1)) as ideal from range(1, 6) a(m) join range(1, 6) b(j) on j <= m group by m),
r as (
  select query_id, sum(rel) / 5.0 as precision, sum(case when rel = 1 then hits / place else 0 end) as ap,
         sum(rel / log2(place + 1)) as dcg, min(place) filter (where rel = 1) as first_hit
  from t where place <= 5 group by query_id)
select count(*) as queries, round(avg(precision), 6) as mean_precision,
       round(avg(case when wanted = 0 then 0 else ap / least(wanted, 5) end), 6) as mean_average_precision,
       round(avg(case when wanted = 0 then 0 else dcg / ideal end), 6) as mean_ndcg, round(avg(coalesce(1 / first_hit, 0)), 6) as mean_reciprocal_rank
from r join w using (query_id) left join i on m = least(wanted, 5)
""")
def ranking_report_embeddings(spark, folder):
    """Does a vector's label occur among its nearest neighbours? Ten are judged, five are reported; what is relevant is counted among the ten."""
    vectors = read_table(spark, folder, "embeddings", ["vec_id", "embedding", "label"])
    return rounded(ranking_summary(ranking_report(judged_neighbours(vectors), "query_id", "base_id", "similarity", "rel", 5), "query_id"))


def judged_neighbours(vectors):
    """Each vector's ten nearest neighbours and whether they have its label."""
    found = nearest_neighbours(vectors, vectors, "vec_id", "embedding", 10)
    labels = vectors.select("vec_id", "label")
    judged = found.join(labels.toDF("query_id", "query_label"), "query_id").join(labels.toDF("base_id", "base_label"), "base_id")
    return judged.withColumn("rel", (F.col("query_label") == F.col("base_label")).cast("int"))


@query(f"""
with {NEIGHBOURS_SQL},
t as (select *, sum(rel) over (partition by query_id order by place) as hits from n where place <= 5),
w as (select v.vec_id as query_id, c.n - 1 as wanted from v join (select label, count(*) as n from v group by label) c on v.label = c.label),
i as (select m, sum(1 / log2(j + 1)) as ideal from range(1, 6) a(m) join range(1, 6) b(j) on j <= m group by m),
r as (
  select query_id, sum(rel) / 5.0 as precision, sum(case when rel = 1 then hits / place else 0 end) as ap,
         sum(rel / log2(place + 1)) as dcg, min(place) filter (where rel = 1) as first_hit
  from t group by query_id)
select count(*) as queries, round(avg(precision), 6) as mean_precision,
       round(avg(case when wanted = 0 then 0 else ap / least(wanted, 5) end), 6) as mean_average_precision,
       round(avg(case when wanted = 0 then 0 else dcg / ideal end), 6) as mean_ndcg, round(avg(coalesce(1 / first_hit, 0)), 6) as mean_reciprocal_rank
from r join w using (query_id) left join i on m = least(wanted, 5)
""")
def ranking_report_all_embeddings(spark, folder):
    """As ``ranking_report_embeddings``, with each query's relevant items counted over the whole table."""
    vectors = read_table(spark, folder, "embeddings", ["vec_id", "embedding", "label"])
    sizes = vectors.groupBy("label").agg((F.count(F.lit(1)) - 1).alias("wanted"))
    wanted = vectors.select(F.col("vec_id").alias("query_id"), "label").join(sizes, "label").select("query_id", "wanted")
    report = ranking_report(judged_neighbours(vectors), "query_id", "base_id", "similarity", "rel", 5, wanted)
    return rounded(ranking_summary(report, "query_id"))


CENTROIDS_SQL = """
x as (select vec_id, label, generate_subscripts(embedding, 1) as d, unnest(embedding)::double as v from embeddings),
c as (select label as pred, d, avg(v) as m from x group by label, d),
g as (select vec_id, label, pred, sum((v - m) ** 2) as distance from x join c using (d) group by vec_id, label, pred),
a as (select vec_id, label, arg_min(pred, (distance, pred)) as pred, min(distance) as distance from g group by vec_id, label)"""


@query(f"""
with {CENTROIDS_SQL},
t as (select pred, label, count(*)::double as n from a group by pred, label),
i as (select sum(n * (n - 1) / 2) as p from t),
r as (select sum(n * (n - 1) / 2) as p, sum(top) as top, count(*) as k, sum(n) as n from (select sum(n) as n, max(n) as top from t group by pred)),
c2 as (select sum(n * (n - 1) / 2) as p, count(*) as k from (select sum(n) as n from t group by label))
select r.n::bigint as n, r.k as clusters, c2.k as classes, round(r.top / r.n, 6) as purity,
       round((i.p - r.p * c2.p / (r.n * (r.n - 1) / 2)) / ((r.p + c2.p) / 2 - r.p * c2.p / (r.n * (r.n - 1) / 2)), 6) as adjusted_rand
from i, r, c2
""")
def cluster_report_embeddings(spark, folder):
    vectors = read_table(spark, folder, "embeddings", ["vec_id", "embedding", "label"])
    assigned = assign_nearest(vectors, fit_centroids(vectors, "embedding", "label"), "embedding")
    return rounded(cluster_report(assigned, "pred", "label"))


@query(f"""
with x as (select vec_id, label, generate_subscripts(embedding, 1) as d, unnest(embedding)::double as v from embeddings),
p as (select vec_id, label, sum(v * v) as sq from x group by vec_id, label),
c as (select label, d, sum(v) as s from x group by label, d),
n as (select label, count(*) as n, sum(sq) as sq from p group by label),
g as (
  select x.vec_id, x.label as mine, c.label as other, sum(x.v * c.s) as dot from x join c on x.d = c.d group by 1, 2, 3),
m as (
  select g.vec_id, mine, other, (n.n * p.sq + n.sq - 2 * dot) / case when mine = other then n.n - 1 else n.n end as gap
  from g join p on p.vec_id = g.vec_id join n on n.label = other),
a as (select vec_id, max(gap) filter (where mine = other) as own, min(gap) filter (where mine <> other) as near from m group by vec_id)
select 'squared_euclidean' as distance, round(avg((near - own) / greatest(near, own)), 6) as silhouette from a
""")
def silhouette_embeddings(spark, folder):
    """How well the labels, taken as clusters, hang together."""
    vectors = read_table(spark, folder, "embeddings", ["embedding", "label"])
    return rounded(spark.createDataFrame([("squared_euclidean", silhouette(vectors, "embedding", "label"))], "distance string, silhouette double"))
