"""Toxicity grammar and quality classifier."""

import pickle

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortkit.llm import quality, toxicity
from cohortkit.llm.labelled import remainder, training_sample
from tests.conftest import rows


def test_grammar_weighs_clauses_by_context():
    lexicon = toxicity.Lexicon({"idiot": 4.0}, {"slur": 4.0}, 1.0, -2.0)
    plain = lexicon.text_score("what an idiot that is")
    assert lexicon.text_score("you idiot") > plain > lexicon.text_score("not an idiot")
    assert lexicon.text_score("someone said he is an idiot") < lexicon.text_score("he is an idiot")
    assert lexicon.text_score("idiotic views") == 0 and lexicon.text_score("slurish") > 0
    assert lexicon.text_score("i will kill time") == 0 < lexicon.text_score("i will kill you")
    assert lexicon.text_score("you. idiot") == plain  # a target in another clause does not count
    assert lexicon.score(None) == lexicon.score("") < 0.5
    assert pickle.loads(pickle.dumps(lexicon)).text_score("you idiot") == lexicon.text_score("you idiot")


def test_composed_machine_multiplies_weights():
    a = toxicity.Transducer.memory(toxicity.NEGATION, 2, toxicity.INSULT, 0.5)
    b = toxicity.Transducer.memory(toxicity.TARGET, 2, toxicity.INSULT, 3.0)
    classes = [toxicity.TARGET, toxicity.NEGATION, toxicity.INSULT, toxicity.OTHER, toxicity.INSULT]
    both = a.compose(b).weights(classes)
    assert both == [x * y for x, y in zip(a.weights(classes), b.weights(classes))] and both[2] == 1.5


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(1)
    word = ["".join(rng.choice(list("abdeghilmnorst"), 5)) for _ in range(300)]
    docs, labels = [], []
    for i in range(240):
        text = [str(w) for w in rng.choice(word, 80)]
        toxic, bad = int(i % 4 == 0), i % 3 == 0
        if toxic:
            for at in rng.integers(0, 80, 4):
                text[at] = str(rng.choice(["zorgon", "vex" + rng.choice(word)]))
        if bad:
            text = [t.upper() + "!!" for t in text]
        docs.append((i, " ".join(text)))
        labels.append((i, int(not bad), toxic))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels + [(None, 1, 1), (0, None, None)], "doc_id long, quality int, toxic int")


def accuracy(scored, labels, label):
    joined = scored.join(labels.filter(F.col(label).isNotNull()), "doc_id").filter("held_out")
    return joined.agg(F.avg((F.col("predicted") == F.col(label)).cast("int"))).first()[0]


def test_sample_leaves_the_held_out_fold_alone(labelled):
    docs, labels = labelled
    sample = training_sample(docs, labels, "toxic", 5, 0, 10)
    assert sample.filter(remainder(F.col("doc_id"), 5) == 0).count() == 0
    assert {r.y: r["count"] for r in sample.groupBy("y").count().collect()} == {0: 10, 1: 10}


def test_toxicity_is_learned(spark, labelled, edge_docs, no_docs):
    docs, labels = labelled
    lexicon = toxicity.learn(docs, labels, 5, 0)
    assert any("zorgon".startswith(s) for s in [*lexicon.words, *lexicon.stems])
    assert accuracy(toxicity.score_texts(docs, lexicon, 5, 0), labels, "toxic") >= 0.9
    for lx in (lexicon, toxicity.learn(docs, labels.limit(0), 5, 0)):
        scored = toxicity.score_texts(edge_docs, lx, 5, 0)
        got = rows(scored, "score", "predicted")
        assert len(got) == edge_docs.count() and all(0 <= s <= 1 and p == int(s >= 0.5) for s, p in got)
    assert toxicity.score_texts(no_docs, lexicon, 5, 0).count() == 0


def test_quality_is_learned(spark, labelled, edge_docs, no_docs):
    docs, labels = labelled
    model = quality.learn(docs, labels, 3, 1)
    assert accuracy(quality.score_texts(docs, model, 3, 1), labels, "quality") >= 0.95
    assert quality.learn(docs, labels.limit(0), 3, 1) is None
    for m in (model, None):
        got = rows(quality.score_texts(edge_docs, m, 3, 1), "score", "predicted")
        assert len(got) == edge_docs.count() and all(0 <= s <= 1 and p == int(s >= 0.5) for s, p in got)
        kept = quality.keep_good(edge_docs, m)
        assert kept.columns == edge_docs.columns and kept.count() == sum(p for _, p in got)
    assert quality.score_texts(no_docs, model, 3, 1).count() == 0


def test_attention_gradients_are_exact():
    rng = np.random.default_rng(0)
    x, at, bag = rng.normal(size=(7, 4)), np.array([0, 3]), np.array([0, 0, 0, 1, 1, 1, 1])
    y, weight = np.array([1.0, 0.0]), np.array([0.5, 0.5])
    model = quality.AttentionMIL.fresh(x, 3, 2, 0)
    grads = model.gradients(model.forward(x, at, bag), at, bag, y, weight)

    def loss():
        p = model.forward(x, at, bag)["y"]
        return float((weight * -(y * np.log(p) + (1 - y) * np.log(1 - p))).sum())

    for name in model.p:
        flat = np.atleast_1d(model.p[name]).copy()
        for i in np.ndindex(flat.shape):
            ends = []
            for step in (1e-6, -1e-6):
                moved = flat.copy()
                moved[i] += step
                model.p[name] = moved.reshape(np.shape(model.p[name]))
                ends.append(loss())
            model.p[name] = flat.reshape(np.shape(model.p[name]))
            assert abs((ends[0] - ends[1]) / 2e-6 - np.atleast_1d(grads[name])[i]) < 1e-6
