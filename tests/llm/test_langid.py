"""Language mixtures against a plain EM, and accuracy on the held-out fold."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortkit.llm import langid
from tests.conftest import rows


def plain_grams(text, k):
    low = "".join(c if c.isalpha() else " " for c in (text or "").lower())
    return [(" " + w + " ")[i : i + k] for w in low.split() for i in range(len(w) + 3 - k)]


@pytest.mark.parametrize("k", [1, 2, 3, 4])
def test_grams_equal_padded_words(k):
    texts = ["It's a test, ÉTÉ!", None, "", "12 - 3", "a", "İx 漢字 b", " lead", "x" * 5000]
    spec = langid.Grams(k, 1 << 20)
    doc, bucket, n = langid.gram_counts(texts, spec)
    for i, t in enumerate(texts):
        want = [g for g in plain_grams(t, k) if g.strip()]
        assert sorted(n[doc == i].tolist()) == sorted(Counter(want).values())
    alone = [langid.gram_counts([t], spec) for t in texts]
    assert [b.tolist() for _, b, _ in alone] == [bucket[doc == i].tolist() for i in range(len(texts))]


def model(seed=0, languages=3, buckets=64):
    rng = np.random.default_rng(seed)
    share = rng.dirichlet(np.full(buckets, 0.3), languages) + 1e-4
    return langid.Mixture([f"l{i}" for i in range(languages)], np.log(share / share.sum(axis=1, keepdims=True)), langid.Grams(3, buckets))


def plain_em(like, n, share, rounds):
    for _ in range(rounds):
        post = [[p * q for p, q in zip(share, row)] for row in like]
        share = [sum(c * r[j] / sum(r) for c, r in zip(n, post)) / sum(n) for j in range(len(share))]
    return share, sum(c * math.log(sum(p * q for p, q in zip(share, row))) for c, row in zip(n, like))


def test_fit_equals_plain_expectation_maximisation():
    m, rng = model(), np.random.default_rng(1)
    docs = [rng.choice(64, size, replace=False) for size in (5, 40, 1, 20)]
    doc, bucket = np.repeat(np.arange(4), [len(d) for d in docs]), np.concatenate(docs)
    n = rng.integers(1, 9, len(bucket))
    start = np.array([[1 / 3] * 3, [0.5, 0.5, 0], [1 / 3] * 3, [0, 0, 1]])
    share, value = m.fit(doc, bucket, n, start, 12, 0.0)
    for i in range(4):
        want, likelihood = plain_em(np.exp(m.log_share[:, bucket[doc == i]]).T.tolist(), n[doc == i].tolist(), start[i].tolist(), 12)
        assert np.allclose(share[i], want) and math.isclose(value[i], likelihood)
    steps = [m.fit(doc, bucket, n, start, r, 0.0)[1] for r in range(6)]
    assert all((b >= a - 1e-9).all() for a, b in zip(steps, steps[1:]))


def test_the_penalised_likelihood_chooses_the_set():
    m, rng = model(), np.random.default_rng(2)
    share = np.exp(m.log_share)
    drawn = [rng.choice(64, 600, p=share[1]), np.concatenate([rng.choice(64, 300, p=share[0]), rng.choice(64, 300, p=share[2])])]
    doc, bucket, n = np.repeat([0, 1], 600), np.concatenate(drawn), np.ones(1200, int)
    got = m.select(doc, bucket, n, 3, 3.0)
    assert got[0].tolist() == [0, 1, 0] and got[1][1] == 0 and abs(got[1][0] - 0.5) < 0.12 and got[2].tolist() == [0, 0, 0]
    assert (m.select(doc, bucket, n, 2, 1e9) > 0).sum(axis=1).tolist() == [1, 1]  # a great penalty leaves one language
    # the sets on the way, scored one by one
    for i in range(2):
        like, c, best = np.exp(m.log_share[:, bucket[doc == i]]).T.tolist(), [1] * 600, []
        s = [1 / 3] * 3
        for kept in (3, 2, 1):
            s, v = plain_em(like, c, s, 40 if kept > 1 else 0)
            best.append((v - kept * 3.0 * math.log(601), sum(x > 0 for x in s)))
            s = langid.drop_smallest(np.array([s]))[0].tolist() if kept > 1 else s
        assert max(best)[1] == (got[i] > 0).sum()


def test_drop_smallest():
    share = np.array([[0.2, 0.3, 0.5], [0.5, 0.0, 0.5], [0.25, 0.25, 0.5]])
    assert np.allclose(langid.drop_smallest(share), [[0, 0.375, 0.625], [1, 0, 0], [1 / 3, 0, 2 / 3]])


def test_held_out_accuracy_and_mixtures(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    m = langid.learn(docs, 5, 0)
    assert m.languages == sorted(m.languages) and len(m.languages) == 4
    got = langid.identify(docs, m, 5, 0).filter("held_out").join(docs, "doc_id")
    assert got.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0] >= 0.95
    long = {r.lang: r.text for r in docs.filter("n_chars > 1500").collect()}
    a, b = sorted(long)[:2]
    both = spark.createDataFrame([(1, long[a][:1500] + "\n" + long[b][:1500])], "doc_id long, text string")
    found = {r.lang: r.share for r in langid.identify(both, m, 5, 0).first().languages}
    assert found.keys() >= {a, b} and min(found[a], found[b]) > 0.25


def test_training_leaves_the_held_out_fold_alone(spark, edge_docs):
    docs = edge_docs.select("doc_id", "text", "lang")
    m = langid.learn(docs, 5, 0)
    held = docs.withColumn("lang", F.when(langid.remainder(F.col("doc_id"), 5) == 0, F.lit("zz")).otherwise(F.col("lang")))
    again = langid.learn(held, 5, 0)
    assert again.languages == m.languages and np.array_equal(again.log_share, m.log_share)


def test_edge_rows(spark, edge_docs, no_docs):
    m = langid.learn(edge_docs, 5, 0)
    got = rows(langid.identify(edge_docs, m, 5, 0), "doc_id", "held_out", "lang_pred", "score")
    assert len(got) == edge_docs.count() and all(0 <= s <= 1 for *_, s in got)
    assert all(p == "und" and s == 0 for d, _, p, s in got if d in (3, 4, 6)) and all(p in m.languages for d, _, p, _ in got if d in (1, 2, 5, 7, 8, 9))
    nothing = langid.learn(no_docs, 5, 0)
    assert nothing.languages == [] and {p for (p,) in rows(langid.identify(edge_docs, nothing, 5, 0), "lang_pred")} == {"und"}
    assert langid.identify(no_docs, m, 5, 0).count() == 0
