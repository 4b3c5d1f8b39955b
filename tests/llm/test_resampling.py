"""CRC of spans, features and importance ranks against plain re-computations."""

import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortkit.llm import crc, resampling
from tests.conftest import rows

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@settings(max_examples=80, deadline=None)
@given(st.binary(max_size=3000), st.lists(st.tuples(st.integers(0, 3000), st.integers(0, 3000)), max_size=20))
def test_span_crcs_equal_zlib(raw, spans):
    data = np.frombuffer(raw, np.uint8)
    spans = [tuple(sorted((a % (len(raw) + 1), b % (len(raw) + 1)))) for a, b in spans]
    start, end = (np.array([s[i] for s in spans], np.int64) for i in (0, 1))
    assert crc.crc32_spans(data, start, end).tolist() == [zlib.crc32(raw[a:b]) for a, b in spans]


def test_long_spans_fold_at_every_length():
    raw = bytes(np.random.default_rng(2).integers(0, 256, 70_000).astype(np.uint8))
    data = np.frombuffer(raw, np.uint8)
    end = np.array([crc.BLOCK * k + d for k in (0, 1, 2, 3, 4, 5, 8, 200) for d in (-1, 0, 1) if crc.BLOCK * k + d >= 0] + [70_000])
    assert crc.crc32_spans(data, np.zeros(len(end), np.int64), end).tolist() == [zlib.crc32(raw[:e]) for e in end]


def words(text):
    return WORD.findall((text or "").translate(LOW))


def features(text, most):
    w = words(text)
    return [" ".join(w[i : i + n]) for n in range(1, most + 1) for i in range(len(w) - n + 1)]


def test_features_equal_regex_words():
    texts = ["The the THE", None, "", "a-b_c d9é x", "É é ß", "x" * 1000 + " " + "漢字" * 300, "@[`{~", "0/9:", "end"]
    for most in (1, 2, 3):
        for arr in (pa.array(texts), pa.array(["cut", *texts, "off"]).slice(1, len(texts))):
            n, bucket, doc = resampling.feature_buckets(arr, resampling.Features(most, 997))
            assert n.tolist() == [len(words(t)) for t in texts]
            for i, t in enumerate(texts):
                assert sorted(bucket[doc == i].tolist()) == sorted(zlib.crc32(f.encode()) % 997 for f in features(t, most))


def brute(docs, target, most=1, buckets=50, seed=2024, least=3, percent=30):
    code = lambda f: zlib.crc32(f.encode()) % buckets
    counts = [np.bincount([code(f) for t in side for f in features(t, most)], minlength=buckets) for side in ([t for _, t in docs], target)]
    (s, t), (a, b) = counts, (float(c.sum()) for c in counts)
    gain = [math.floor(1000 * math.log((t[k] + 1) * (a + buckets) / ((s[k] + 1) * (b + buckets)))) for k in range(buckets)]
    out = []
    for d, text in docs:
        f = features(text, most)
        weight = sum(gain[code(x)] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append([d, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words(text))])
    order = sorted((x for x in out if x[4] >= least), key=lambda x: (-x[3], x[0] is None, x[0] or 0))
    rank = {id(x): i for i, x in enumerate(order[: percent * len(order) // 100], 1)}
    return [(*x[:4], rank.get(id(x))) for x in out]


def test_ranks_equal_brute_force(spark, edge_docs, no_docs):
    rng = np.random.default_rng(3)
    pool = ["".join(rng.choice(list("abcde"), 4)) for _ in range(30)]
    docs = [(i, " ".join(rng.choice(pool, rng.integers(0, 9)))) for i in range(120)]
    docs += [(10, docs[10][1])] * 3 + [(None, "abc abd abe abf")] * 2  # repeated rows and null ids
    docs += [(None if d is None else d + 500, t) for d, t in rows(edge_docs, "doc_id", "text")]
    target = [" ".join(rng.choice(pool[:6], 8)) for _ in range(20)] + [None, ""]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    tf = spark.createDataFrame([(t,) for t in target], "text string")
    for most in (1, 2):
        got = resampling.importance_ranks(df, tf, resampling.Features(most, 50), least_words=3, percent=30)
        names = ("doc_id", "n_features", "weight", "score", "rank")
        assert sorted(rows(got, *names), key=str) == sorted(brute(docs, target, most), key=str)
        assert [dict(got.dtypes)[n] for n in names] == ["bigint"] * 5
    none = spark.createDataFrame([], "text string")
    got = rows(resampling.importance_ranks(df, none, resampling.Features(1, 50), least_words=3, percent=30), "doc_id", "n_features", "weight", "score", "rank")
    assert sorted(got, key=str) == sorted(brute(docs, []), key=str)
    assert resampling.importance_ranks(no_docs, tf).count() == 0


def test_all_ties_are_ranked_apart(spark):
    docs = spark.createDataFrame([(None, "a b c")] * 50, "doc_id long, text string").repartition(5)
    got = sorted(r for (r,) in rows(resampling.importance_ranks(docs, docs, least_words=1, percent=40), "rank") if r is not None)
    assert got == list(range(1, 21))


def test_drawn_rows_keep_their_columns(spark, edge_docs):
    drawn = resampling.resample(edge_docs, edge_docs, least_words=2, percent=50)
    assert drawn.columns == edge_docs.columns
    ranked = rows(resampling.importance_ranks(edge_docs, edge_docs, least_words=2, percent=50).filter("rank IS NOT NULL"), "doc_id")
    assert set(rows(drawn, "doc_id")) == set(ranked) and drawn.count() > 0
