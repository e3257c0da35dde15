"""Fitting and applying models. Fits use the train part of a key split; scores cover all rows."""

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, Tokenizer
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from marlstone.evaluate.classes import class_report
from marlstone.evaluate.scores import auc
from marlstone.functions.columns import rounded
from marlstone.models.bayes import fit_bayes, score_bayes
from marlstone.models.linear import coefficients, fit_line, fit_linear, fit_logistic
from marlstone.models.neighbours import approximate_neighbours, neighbour_recall, pruned_neighbours
from marlstone.models.outside import save_layers, score_outside
from marlstone.models.scoring import batch_score, cross_validate
from marlstone.models.trees import best_split, fit_tree
from marlstone.models.vectors import (
    apply_kmeans,
    assign_nearest,
    assign_nearest_table,
    fit_centroid_table,
    fit_centroids,
    fit_kmeans,
    kmeans_step,
    nearest_neighbours,
    pca,
)
from marlstone.operators.splits import hash_split
from marlstone.plans.evaluation_queries import CENTROIDS_SQL, NEIGHBOURS_SQL
from marlstone.plans.registry import query
from marlstone.plans.split_queries import NUMBER
from marlstone.plans.text_queries import WORDS, documents
from marlstone.sources.tables import read_table, spread

TARGET_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def labelled_documents(spark, folder):
    docs = documents(spark, folder)
    labels = read_table(spark, folder, "labels", ["doc_id", "quality"])
    return hash_split(docs.join(labels, "doc_id"), "doc_id", {"train": 8, "test": 2})


def returned_lines(spark, folder):
    lines = spread(read_table(spark, folder, "lineitem", ["l_orderkey", "l_linenumber", "l_returnflag", *TARGET_FEATURES]))
    return hash_split(lines.withColumn("y", (F.col("l_returnflag") == "R").cast("int")), "l_orderkey", {"train": 8, "test": 2})


@query("""
select l_returnflag, count(*) as n, round(regr_slope(l_extendedprice, l_quantity), 4) as slope,
       round(regr_intercept(l_extendedprice, l_quantity), 4) as intercept, round(regr_r2(l_extendedprice, l_quantity), 6) as r2
from lineitem group by l_returnflag
""")
def line_fit_lineitem(spark, folder):
    lines = read_table(spark, folder, "lineitem", ["l_returnflag", "l_quantity", "l_extendedprice"])
    return rounded(rounded(fit_line(lines, "l_quantity", "l_extendedprice", ["l_returnflag"]), 4, ["slope", "intercept"]), 6, ["r2"])


@query("""
with m as (
  select covar_pop(l_quantity, l_quantity) as aa, covar_pop(l_discount, l_discount) as bb, covar_pop(l_quantity, l_discount) as ab,
         covar_pop(l_quantity, l_extendedprice) as ay, covar_pop(l_discount, l_extendedprice) as cy,
         avg(l_quantity) as a, avg(l_discount) as b, avg(l_extendedprice) as y from lineitem),
w as (select (bb * ay - ab * cy) / (aa * bb - ab * ab) as wa, (aa * cy - ab * ay) / (aa * bb - ab * ab) as wb, * from m)
select 'l_quantity' as term, round(wa, 3) as weight from w
union all select 'l_discount', round(wb, 3) from w
union all select '(intercept)', round(y - wa * a - wb * b, 3) from w
""")
def linear_fit_lineitem(spark, folder):
    features = ["l_quantity", "l_discount"]
    lines = read_table(spark, folder, "lineitem", [*features, "l_extendedprice"])
    weights = coefficients(fit_linear(lines, features, "l_extendedprice"), features)
    return rounded(spark.createDataFrame(list(weights.items()), "term string, weight double"), 3)


@query()
def logistic_scores_lineitem(spark, folder):
    lines = returned_lines(spark, folder)
    model = fit_logistic(lines.where("part = 'train'"), TARGET_FEATURES, "y")
    return rounded(batch_score(lines, model, ["l_orderkey", "l_linenumber", "part", "y"]))


def _tree_scores(spark, folder, kind, **options):
    lines = returned_lines(spark, folder)
    model = fit_tree(lines.where("part = 'train'"), TARGET_FEATURES, "y", kind, **options)
    return rounded(batch_score(lines, model, ["l_orderkey", "l_linenumber", "part", "y"]))


@query()
def tree_scores_lineitem(spark, folder):
    return _tree_scores(spark, folder, "tree", maxDepth=4)


@query()
def forest_scores_lineitem(spark, folder):
    return _tree_scores(spark, folder, "forest", maxDepth=4, numTrees=10)


@query()
def boosted_scores_lineitem(spark, folder):
    return _tree_scores(spark, folder, "boosted", maxDepth=3, maxIter=5)


BAYES_SQL = f"""
d as (
  select doc_id, quality, case when {NUMBER.format(key='doc_id')} % 10 < 8 then 'train' else 'test' end as part, {WORDS} as ws
  from documents join labels using (doc_id)),
w as (select doc_id, quality, part, unnest(ws) as term from d),
c as (select term, count(*) filter (where quality = 0) as n0, count(*) filter (where quality = 1) as n1 from w where part = 'train' group by term),
k as (select count(*) as vocabulary, sum(n0) as n0, sum(n1) as n1 from c),
l as (
  select term, ln((c.n0 + 1.0) / (k.n0 + vocabulary)) as ll0, ln((c.n1 + 1.0) / (k.n1 + vocabulary)) as ll1 from c, k),
s as (select doc_id, sum(ll0) as s0, sum(ll1) as s1 from w join l using (term) group by doc_id),
p as (
  select ln(count(*) filter (where quality = 0) / count(*)) as p0, ln(count(*) filter (where quality = 1) / count(*)) as p1
  from d where part = 'train'),
b as (
  select doc_id, quality, part, p0 + coalesce(s0, 0) as log_0, p1 + coalesce(s1, 0) as log_1
  from d left join s using (doc_id), p)"""


def bayes_scores(spark, folder):
    docs = labelled_documents(spark, folder)
    model = fit_bayes(docs.where("part = 'train'"), "doc_id", "text", "quality")
    return score_bayes(docs, model, "doc_id", "text").join(docs.select("doc_id", "quality", "part"), "doc_id")


@query(f"""
with {BAYES_SQL}
select doc_id, quality, part, round(log_0, 4) as log_0, round(log_1, 4) as log_1, case when log_1 > log_0 then 1 else 0 end as pred,
       round(log_1 - log_0, 4) as log_odds from b
""")
def naive_bayes_documents(spark, folder):
    return rounded(bayes_scores(spark, folder), 4)


@query(f"""
with {BAYES_SQL},
r as (
  select part, quality, rank() over (partition by part order by log_1 - log_0)
         + (count(*) over (partition by part, log_1 - log_0) - 1) / 2.0 as rnk from b),
t as (select part, sum(quality) as p, count(*) - sum(quality) as n, sum(rnk) filter (where quality = 1) as ranks from r group by part)
select part, p::bigint as n_pos, n::bigint as n_neg, round((ranks - p * (p + 1) / 2) / (p * n), 4) as auc from t
""")
def naive_bayes_auc(spark, folder):
    """Split, count words, fit, score and evaluate in one go; the scores are kept, as they are read twice."""
    scored = rounded(bayes_scores(spark, folder).select("part", "quality", "log_odds"), 9).persist()
    return rounded(auc(scored, "quality", "log_odds", ["part"]), 4)


@query(f"""
with {BAYES_SQL},
found as (select quality::varchar as y, case when log_1 > log_0 then '1' else '0' end as pred from b where part = 'test'),
names as (select y as class from found union select pred from found),
told as (
  select class, (select count(*) from found where y = class) as support, (select count(*) from found where pred = class) as predicted,
         (select count(*) from found where y = class and pred = class) as hits from names),
shares as (
  select class, case when predicted = 0 then 0 else hits / predicted end as precision,
         case when support = 0 then 0 else hits / support end as recall, support, hits from told),
marks as (select *, case when precision + recall = 0 then 0 else 2 * precision * recall / (precision + recall) end as f1 from shares)
select 'class' as level, class, round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1, support from marks
union all
select 'average', 'macro', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), sum(support)::bigint from marks
union all
select 'average', 'micro', round(sum(hits) / sum(support), 6), round(sum(hits) / sum(support), 6), round(sum(hits) / sum(support), 6), sum(support)::bigint from marks
union all
select 'average', 'weighted', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
       round(sum(f1 * support) / sum(support), 6), sum(support)::bigint from marks
""")
def naive_bayes_report(spark, folder):
    scored = bayes_scores(spark, folder).where("part = 'test'")
    return rounded(class_report(scored, "quality", "pred"))


@query(f"""
with {CENTROIDS_SQL}
select vec_id, label, pred, round(distance, 6) as pred_distance from a
""")
def nearest_centroid_embeddings(spark, folder):
    vectors = read_table(spark, folder, "embeddings", ["vec_id", "embedding", "label"])
    assigned = assign_nearest(vectors, fit_centroids(vectors, "embedding", "label"), "embedding")
    return rounded(assigned.drop("embedding"))


@query(f"""
with s as (select *, case when {NUMBER.format(key='vec_id')} % 10 < 8 then 'train' else 'test' end as part from embeddings),
x as (select vec_id, label, part, generate_subscripts(embedding, 1) as d, unnest(embedding)::double as v from s),
c as (select label as pred, d, avg(v) as m from x where part = 'train' group by label, d),
g as (select vec_id, label, pred, sum((v - m) ** 2) as distance from x join c using (d) where part = 'test' group by vec_id, label, pred)
select vec_id, label, arg_min(pred, (distance, pred)) as pred, round(min(distance), 6) as pred_distance from g group by vec_id, label
""")
def nearest_centroid_split_embeddings(spark, folder):
    """Centroids of the train part as a table, nearest ones of the test part."""
    vectors = hash_split(read_table(spark, folder, "embeddings", ["vec_id", "embedding", "label"]), "vec_id", {"train": 8, "test": 2})
    centroids = fit_centroid_table(vectors.where("part = 'train'"), "embedding", "label")
    return rounded(assign_nearest_table(vectors.where("part = 'test'"), centroids, "vec_id", "embedding").drop("embedding", "part"))


@query(f"""
with {CENTROIDS_SQL},
t as (select pred as cluster, count(*) as n, sum(distance) as cost from a group by pred),
m as (select a.pred as cluster, x.d, avg(x.v) as m from a join x using (vec_id) group by a.pred, x.d)
select cluster, n, round(cost, 5) as cost, d::int as dim, round(m, 6) as mean from t join m using (cluster)
""")
def kmeans_step_embeddings(spark, folder):
    vectors = read_table(spark, folder, "embeddings", ["vec_id", "embedding", "label"])
    step = kmeans_step(vectors, fit_centroids(vectors, "embedding", "label"), "embedding")
    long = step.select("cluster", "n", "cost", F.posexplode("mean").alias("at", "mean"))
    return rounded(rounded(long.select("cluster", "n", "cost", (F.col("at") + 1).alias("dim"), "mean"), 5, ["cost"]), 6, ["mean"])


@query()
def kmeans_embeddings(spark, folder):
    vectors = read_table(spark, folder, "embeddings", ["vec_id", "embedding", "label"])
    return apply_kmeans(vectors, fit_kmeans(vectors, "embedding", 10), "embedding").drop("embedding")


@query()
def pca_embeddings(spark, folder):
    projected = pca(read_table(spark, folder, "embeddings", ["vec_id", "embedding"]), "vec_id", "embedding", 3)
    return rounded(projected.select("vec_id", *[F.col("projection")[i].alias(f"p{i + 1}") for i in range(3)]), 5)


@query(f"""
with {NEIGHBOURS_SQL}
select query_id, place::int as place, base_id, round(similarity, 6) as similarity from n where place <= 5
""")
def neighbours_embeddings(spark, folder):
    vectors = read_table(spark, folder, "embeddings", ["vec_id", "embedding"])
    return rounded(nearest_neighbours(vectors, vectors, "vec_id", "embedding", 5))


@query(f"""
with {NEIGHBOURS_SQL}
select query_id, place::int as place, base_id, round(similarity, 6) as similarity from n where place <= 5
""")
def pruned_neighbours_embeddings(spark, folder):
    """As ``neighbours_embeddings``, by blocks that the angles leave open."""
    vectors = read_table(spark, folder, "embeddings", ["vec_id", "embedding"])
    return rounded(pruned_neighbours(vectors, vectors, "vec_id", "embedding", 5))


def asked_vectors(spark, folder):
    """All vectors, and those whose id is divisible by 50 as queries."""
    vectors = read_table(spark, folder, "embeddings", ["vec_id", "embedding"])
    return vectors, vectors.where("vec_id % 50 = 0")


@query()
def approximate_neighbours_embeddings(spark, folder):
    """Ten near neighbours of every fiftieth vector by random projections; ``neighbour_recall_embeddings`` tells how many are right."""
    vectors, queries = asked_vectors(spark, folder)
    return rounded(approximate_neighbours(queries, vectors, "vec_id", "embedding", 10))


@query()
def neighbour_recall_embeddings(spark, folder):
    """The approximate search against the exact one."""
    vectors, queries = asked_vectors(spark, folder)
    found = approximate_neighbours(queries, vectors, "vec_id", "embedding", 10)
    return rounded(neighbour_recall(found, nearest_neighbours(queries, vectors, "vec_id", "embedding", 10)))


def _split_sql(feature):
    return f"""
select '{feature}' as feature, threshold, n_left, n_right, round(gini, 9) as gini from (
  select value as threshold, n_left, (n - n_left) as n_right,
         (2.0 * n_left * (p / n_left) * (1 - p / n_left) + 2.0 * (n - n_left) * ((all_p - p) / (n - n_left)) * (1 - (all_p - p) / (n - n_left))) / n as gini
  from (
    select value, sum(c) over w as n_left, sum(pos) over w as p, sum(c) over () as n, sum(pos) over () as all_p
    from (select {feature} as value, count(*)::double as c, count(*) filter (where l_returnflag = 'R')::double as pos from lineitem group by 1)
    window w as (order by value))
  where n_left < n
  order by gini, threshold limit 1)"""


@query(
    "select feature, threshold, n_left::bigint as n_left, n_right::bigint as n_right, gini from ("
    + " union all ".join(f"(select * from ({_split_sql(f)}))" for f in TARGET_FEATURES)
    + ")"
)
def best_split_lineitem(spark, folder):
    """The first split of a decision tree on the whole table, per feature."""
    return rounded(best_split(returned_lines(spark, folder), TARGET_FEATURES, "y"), 9, ["gini"])


def _text_classifier(dims):
    return Pipeline(
        stages=[
            Tokenizer(inputCol="text", outputCol="tokens"),
            HashingTF(inputCol="tokens", outputCol="counts", numFeatures=dims),
            IDF(inputCol="counts", outputCol="features"),
            LogisticRegression(labelCol="label", maxIter=10),
        ]
    )


def text_model(spark, folder):
    """Hashed word weights and a logistic fit for the quality label."""
    train = labelled_documents(spark, folder).where("part = 'train'").withColumn("label", F.col("quality").cast("double"))
    kept = train.select("text", "label").persist()
    try:
        return _text_classifier(1 << 12).fit(kept)
    finally:
        kept.unpersist()


@query()
def batch_score_documents(spark, folder):
    """Score every document with a model fitted on the labelled train part."""
    return rounded(batch_score(documents(spark, folder), text_model(spark, folder), ["doc_id"]))


@query("""
with m as (
  select avg(l_quantity) as mq, stddev_samp(l_quantity) as sq, avg(l_extendedprice) as mp, stddev_samp(l_extendedprice) as sp from lineitem)
select l_orderkey, l_linenumber, l_quantity, l_extendedprice,
       round(1 / (1 + exp(-(0.8 * greatest((l_quantity - mq) / sq, 0) - 0.5 * greatest((l_extendedprice - mp) / sp, 0) + 0.1))), 6) as score
from lineitem, m
""")
def outside_scores_lineitem(spark, folder):
    """A small network whose first layer scales by the table's moments, written to a file and applied by ``predict_batch_udf``."""
    features = ["l_quantity", "l_extendedprice"]
    lines = read_table(spark, folder, "lineitem", ["l_orderkey", "l_linenumber", *features])
    told = lines.agg(*[f(c).alias(f"{f.__name__}_{c}") for f in (F.avg, F.stddev_samp) for c in features]).first()
    means, spreads = [told[f"avg_{c}"] for c in features], [told[f"stddev_samp_{c}"] for c in features]
    first = [[1 / spreads[0], 0.0], [0.0, 1 / spreads[1]]]
    layers = [(first, [-m / s for m, s in zip(means, spreads)], "relu"), ([[0.8], [-0.5]], [0.1], "sigmoid")]
    return rounded(score_outside(lines, save_layers(spark, layers), features, ["l_orderkey", "l_linenumber", *features]), 6, ["score"])


@query()
def cross_validate_documents(spark, folder):
    """Mean area under the ROC curve per penalty, over folds of the labelled documents."""
    docs = labelled_documents(spark, folder).select("doc_id", "text", F.col("quality").cast("double").alias("label"))
    features = Pipeline(stages=_text_classifier(1 << 10).getStages()[:3]).fit(docs).transform(docs).select("doc_id", "label", "features")
    estimator = LogisticRegression(maxIter=10)
    penalties = [0.0, 0.01, 0.1]
    grid = ParamGridBuilder().addGrid(estimator.regParam, penalties).build()
    _, areas = cross_validate(features, estimator, grid, "doc_id")
    return rounded(spark.createDataFrame(list(zip(penalties, areas)), "penalty double, auc double"))
