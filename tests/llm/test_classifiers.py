import numpy as np
import pytest
from pyspark.sql import functions as F

from marlstone.llm.gam import AdditiveModel, features, fit_quality, score_quality
from marlstone.llm.queries import op6_clause_grammar_toxicity, op7_additive_quality
from marlstone.llm.toxicity import Grammar, choose_stems, fit_grammar, read_clause, score_toxicity
from tests.llm.helpers import table

FOLDER = "/root/testdata/sf0.1"


@pytest.mark.parametrize("query, label, recall, precision", [(op6_clause_grammar_toxicity, "toxic", 0.85, 0.85), (op7_additive_quality, "quality", 0.98, 0.97)])
def test_held_out_accuracy(spark, query, label, recall, precision):
    found = query(spark, FOLDER)
    marked = found.where("held_out").join(spark.read.parquet(f"{FOLDER}/labels.parquet"), "doc_id")
    right = (F.col("predicted") == 1) & (F.col(label) == 1)
    both, said, true = marked.agg(*[F.sum(c.cast("int")) for c in (right, F.col("predicted") == 1, F.col(label) == 1)]).first()
    assert both >= recall * true and both >= precision * said
    assert found.where("score is null or score < 0 or score > 1").count() == 0
    assert found.count() == spark.read.parquet(f"{FOLDER}/documents.parquet").count()


def test_clauses():
    insult = ("idiot", 2.0)
    word = lambda *names: [(n, 0.0) for n in names]
    assert read_clause([insult])["plain"] == 2
    assert read_clause([*word("you"), insult])["targeted"] == 2
    assert read_clause([insult, *word("you")])["targeted"] == 2
    assert read_clause([*word("not", "an"), insult])["negated"] == 2
    assert read_clause([*word("not", "a", "b", "c", "d"), insult])["plain"] == 2
    assert read_clause([*word("he", "said"), insult])["reported"] == 2
    assert read_clause(word("kill", "you"))["threat"] == 1
    assert read_clause(word("not", "kill", "you"))["threat"] == 0
    assert read_clause(word("kill", "a", "b", "c", "d", "e", "you"))["threat"] == 0
    assert sum(read_clause([]).values()) == 0


def test_stems_need_their_number_of_words():
    grammar = Grammar({"scum": (1, 1.0), "bad": (2, 2.0)}, np.ones(5), -1.0)
    sums = grammar.sums(["SCUM here", "badly done", "badly, badder", "", None, "sc um"])
    assert np.allclose(np.expm1(sums).sum(axis=1), [1, 0, 4, 0, 0, 0])
    assert grammar.score([None])[0] == grammar.score(["clean"])[0] < 0.3


def test_stems_are_chosen_by_what_they_add():
    held = [(t, 1, 1, "worthless") for t in range(20)] + [(t, 2, 2, "wor") for t in range(22)] + [(t, 3, 1, "other") for t in range(40, 50)]
    odds = {(1, 1): 5.0, (2, 1): 1.0, (2, 2): 1.5, (3, 1): 4.0}
    cost = {(1, 1): 0.0, (2, 1): 9.0, (2, 2): 9.0, (3, 1): 0.0}
    assert choose_stems(held, odds, cost, 50) == {"worthless": (1, 5.0), "other": (1, 4.0)}


def test_additive_model_finds_steps_and_interactions():
    chance = np.random.default_rng(0)
    columns = [chance.normal(size=4000), chance.normal(size=4000), np.zeros(4000)]
    for label in ((columns[0] > 0.5).astype("f8"), ((columns[0] > 0) ^ (columns[1] > 0)).astype("f8")):
        model = AdditiveModel(columns, label, np.ones(4000))
        assert ((model.score(columns) > 0.5) == label).mean() > 0.93
    one = AdditiveModel(columns, np.ones(4000), np.ones(4000))
    assert (one.score(columns) > 0.99).all()
    assert AdditiveModel([np.zeros(0)] * 2, np.zeros(0), np.zeros(0)).score([np.zeros(1)] * 2)[0] == 0.5
    assert all(len(f) == 3 and np.isfinite(f).all() for f in features([None, "", "Word 1 | #!\n" * 3]))


@pytest.mark.parametrize("fit, score, label", [(fit_grammar, score_toxicity, "toxic"), (fit_quality, score_quality, "quality")])
def test_edges(spark, fit, score, label):
    texts = ["you are scum and trash", "a calm day", None, "", "long " * 3000]
    rows = [(i, f"{texts[i % 5]} {i}" if i % 5 < 2 else texts[i % 5], "x") for i in range(60)] + [(3, "", "x"), (None, "scum", "x")]
    docs = table(spark, rows, "doc_id long, text string, score string")
    labels = table(spark, [(i, 1 - min(i % 5, 1)) for i in range(60)] + [(None, 1), (2, None), (7, 5)], f"doc_id long, {label} int")
    for some in (labels, labels.where(F.col(label) == 1), labels.where(F.lit(False))):
        found = score(docs, fit(docs, some))
        assert found.count() == len(rows) and found.columns[:3] == docs.columns
        assert all(0 <= r[0] <= 1 for r in found.select(F.col(found.columns[-1] + ".score")).collect())
    fitted = fit(docs, labels)
    by_text = {r.text: r[3].score for r in score(docs, fitted).collect()}
    assert by_text["you are scum and trash 0"] > 0.5 > by_text["a calm day 1"]
    assert score(docs.where(F.lit(False)), fitted).count() == 0
