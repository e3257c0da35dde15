"""Splits, leakage counts and class balance."""

from pyspark.sql import functions as F

from marlstone.operators.leakage import leakage_report, leaked_rows
from marlstone.operators.splits import class_weights, downsample, hash_split, kfold, shared_entities, time_split
from marlstone.plans.registry import query
from marlstone.functions.columns import rounded
from marlstone.sources.tables import read_table

NUMBER = "('0x' || substr(md5({key}::varchar), 1, 7))::bigint"


@query(f"""
select doc_id, case when h % 10 < 7 then 'train' when h % 10 < 8 then 'valid' else 'test' end as part
from (select doc_id, {NUMBER.format(key='doc_id')} as h from documents)
""")
def hash_split_documents(spark, folder):
    docs = read_table(spark, folder, "documents", ["doc_id"])
    return hash_split(docs, "doc_id", {"train": 7, "valid": 1, "test": 2})


@query(f"""
select l_orderkey, l_linenumber, l_partkey, l_suppkey, ({NUMBER.format(key='l_orderkey')} % 5)::int as fold from lineitem
""")
def kfold_lineitem(spark, folder):
    lines = read_table(spark, folder, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])
    return kfold(lines, "l_orderkey", 5)


@query("""
select o_orderkey, case when o_orderdate < timestamp '2000-01-01' then 'train' else 'test' end as part from orders
""")
def time_split_orders(spark, folder):
    return time_split(read_table(spark, folder, "orders", ["o_orderkey", "o_orderdate"]), "o_orderdate", "2000-01-01").drop(
        "o_orderdate"
    )


@query("""
with c as (
  select o_custkey, count(*) filter (where o_orderdate < timestamp '2000-01-01') as n_train,
         count(*) filter (where o_orderdate >= timestamp '2000-01-01') as n_test
  from orders group by o_custkey)
select coalesce(sum(n_test), 0)::bigint as test_rows,
       coalesce(sum(n_test) filter (where n_train > 0), 0)::bigint as test_rows_seen,
       count(*) as test_entities, count(*) filter (where n_train > 0) as test_entities_seen
from c where n_test > 0
""")
def shared_customers_across_time_split(spark, folder):
    orders = read_table(spark, folder, "orders", ["o_custkey", "o_orderdate"])
    return shared_entities(time_split(orders, "o_orderdate", "2000-01-01"), ["o_custkey"])


@query("""
select l_returnflag, count(*) as n, round((select count(*) from lineitem) / ((select count(distinct l_returnflag) from lineitem) * count(*)::double), 6) as weight
from lineitem group by l_returnflag
""")
def class_weights_lineitem(spark, folder):
    return rounded(class_weights(read_table(spark, folder, "lineitem", ["l_returnflag"]), "l_returnflag"))


@query(f"""
select doc_id, quality from labels
where {NUMBER.format(key='doc_id')} < case quality when 1 then 0.25 * 268435456 else 268435456 end
""")
def downsample_labels(spark, folder):
    labels = read_table(spark, folder, "labels", ["doc_id", "quality"])
    return downsample(labels, "doc_id", "quality", {1: 0.25}).select("doc_id", F.col("quality"))


VALUES_SQL = f"""
d as (
  select doc_id, trim(regexp_replace(lower(text), '[\\x20\\x09-\\x0D]+', ' ', 'g')) as v,
         case when {NUMBER.format(key='doc_id')} % 10 < 8 then 'train' else 'test' end as part
  from documents),
t as (select distinct v from d where part = 'train')"""


def split_documents(spark, folder):
    docs = hash_split(read_table(spark, folder, "documents", ["doc_id", "text"]), "doc_id", {"train": 8, "test": 2})
    return docs.where("part = 'train'").drop("part"), docs.where("part = 'test'").drop("part")


@query(f"""
with {VALUES_SQL},
s as (select v, count(*) as n from d where part = 'test' and v is not null group by v)
select coalesce(sum(n), 0)::bigint as test_rows, coalesce(sum(n) filter (where v in (select v from t)), 0)::bigint as test_rows_seen,
       count(*) as test_values, count(*) filter (where v in (select v from t)) as test_values_seen
from s
""")
def leakage_report_documents(spark, folder):
    """How many of the test documents' texts the train part holds too, apart from case and white space."""
    train, test = split_documents(spark, folder)
    return leakage_report(train, test, ["text"])


@query(f"""
with {VALUES_SQL}
select doc_id from d where part = 'test' and v in (select v from t)
""")
def leaked_documents(spark, folder):
    train, test = split_documents(spark, folder)
    return leaked_rows(train, test, ["text"]).select("doc_id")
