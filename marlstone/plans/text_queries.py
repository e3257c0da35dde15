"""Word features of whole texts."""

from marlstone.functions.columns import rounded
from marlstone.operators.text import bag_of_words, tfidf
from marlstone.plans.registry import query
from marlstone.sources.tables import read_table, spread

WORDS = "list_filter(regexp_split_to_array(lower(text), '[^\\p{L}]+'), lambda w: w <> '')"


def documents(spark, folder):
    return spread(read_table(spark, folder, "documents", ["doc_id", "text"]))


@query(f"""
with w as (select doc_id, unnest({WORDS}) as term from documents)
select doc_id, term, count(*) as tf from w group by doc_id, term
""")
def bag_of_words_documents(spark, folder):
    return bag_of_words(documents(spark, folder), "doc_id", "text")


@query(f"""
with w as (select doc_id, {WORDS} as ws from documents),
g as (select doc_id, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) as term from w)
select doc_id, term, count(*) as tf from g group by doc_id, term
""")
def bigrams_documents(spark, folder):
    return bag_of_words(documents(spark, folder), "doc_id", "text", 2)


@query(f"""
with w as (select doc_id, unnest({WORDS}) as term from documents),
t as (select doc_id, term, count(*) as tf from w group by doc_id, term),
d as (select term, count(*) as df from t group by term)
select doc_id, term, tf, df, round(tf * ln(((select count(distinct doc_id) from documents) + 1.0) / (df + 1.0)), 6) as tfidf
from t join d using (term)
""")
def tfidf_documents(spark, folder):
    return rounded(tfidf(documents(spark, folder), "doc_id", "text"))
