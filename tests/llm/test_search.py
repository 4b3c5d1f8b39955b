"""URL rules, sharding and nearest neighbours."""

import math
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

from cohortkit.llm import ann, queries, sharding, url_filter
from cohortkit.llm.hilbert import hilbert_keys
from tests.conftest import rows

URLS = [
    (1, "http://Example.COM/en/x"), (2, "https://www.example.com/en/"), (3, "http://a.net/es/q?x=/fr/"), (4, "http://net/fr/"),
    (5, None), (6, "no scheme"), (7, "http://com"), (8, "http://com/"), (9, "HTTP://b.EXAMPLE.com/EN/"), (10, "x://y.com?a://b/"),
    (11, "http://example.com:80/en/"), (12, ""), (13, "http://www.www.example.com/en/#t"), (14, "://"), (14, "://"), (None, "http://xcom/a\nb"),
]


def by_hand(url):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, path = rest[:end].lower(), rest[end:]
        path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    best = None
    for rule in queries.URL_RULES:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best)):
            best = rule
    return host, path, best, queries.URL_RULES.get(best, "allow")


def test_url_rules_by_hand(spark):
    pages = spark.createDataFrame([(i, u, "h", "x") for i, u in URLS], "page_id long, url string, html string, host string")
    got = rows(url_filter.judge_urls(pages, queries.URL_RULES), "page_id", "host", "path", "rule", "verdict")
    assert sorted(got, key=str) == sorted([(i, *by_hand(u)) for i, u in URLS], key=str)
    assert url_filter.judge_urls(pages.limit(0), queries.URL_RULES).count() == 0


def test_digest_collisions_are_told_apart(tmp_path, monkeypatch):
    monkeypatch.setattr(url_filter.xxhash, "xxh64_intdigest", lambda k: 7)
    url_filter.DigestArray.save({"a/": "allow", "b/": "block"}, str(tmp_path), "t")
    array = url_filter.DigestArray.open("t", lambda name: str(tmp_path / name))
    found = array.find([b"b/", b"c/", b"a/"])
    assert [array.string(i) if i >= 0 else None for i in found] == [b"b/", None, b"a/"]


def test_shards_are_exact_and_uniform(spark, edge_docs, no_docs):
    got = rows(sharding.shard_rows(sharding.text_facts(edge_docs), 5, blocks=4), "doc_id", "size", "text_crc32", "shard", "slot")
    source = rows(edge_docs, "doc_id", "text")
    raw = [(i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in source]
    assert sorted((r[:3] for r in got), key=str) == sorted(raw, key=str)
    for s in range(5):
        slots = sorted(r[4] for r in got if r[3] == s)
        assert slots == list(range(len(slots))) and len(slots) in (len(got) // 5, len(got) // 5 + 1)
    assert sharding.shard_rows(sharding.text_facts(no_docs), 5).count() == 0


def test_every_matrix_is_as_likely_as_its_assignments(spark):
    """Blocks of 2, 3 and 1 rows into 2 shards of 3: each matrix occurs in proportion to the assignments that give it."""
    n = 20000
    blocks = "array(named_struct('block_', 0, 'n', 2L), named_struct('block_', 1, 'n', 3L), named_struct('block_', 2, 'n', 1L))"
    drawn = spark.range(n).selectExpr("id", f"{blocks} AS blocks", "6L AS rows").select(F.expr(sharding.matrix_sql(2, "id")).alias("m"))
    got = Counter(tuple(x.counts[0] for x in m) for m, in rows(drawn))
    block = [0, 0, 1, 1, 1, 2]
    every = Counter(tuple(sum(block[r] == k for r in first) for k in range(3)) for first in combinations(range(6), 3))
    assert set(got) == set(every)
    for x, ways in every.items():
        p = ways / 20
        assert abs(got[x] - n * p) < 5 * math.sqrt(n * p * (1 - p))


def test_all_assignments_of_a_tiny_table_occur_alike(spark):
    """Four rows, two shards: the 24 orders of the rows over shards and slots, over many seeds."""
    df = spark.createDataFrame([(i, i, i) for i in range(4)], "doc_id long, size long, text_crc32 long").repartition(2)
    got = Counter()
    for seed in range(16):
        got[tuple(d for d, *_ in sorted(rows(sharding.shard_rows(df, 2, seed=seed, blocks=2), "doc_id", "shard", "slot"), key=lambda r: r[1:]))] += 1
    assert len(got) >= 8 and max(got.values()) <= 5  # 16 draws hit 12 of the 24 orders on average


def test_communication_matrix_has_exact_margins(spark):
    blocks = spark.createDataFrame([(0, 100), (1, 3), (2, 57)], "block_ int, n long")
    matrix = dict(rows(sharding.communication_matrix(blocks, 7, seed=3)))
    assert {b: sum(c) for b, c in matrix.items()} == {0: 100, 1: 3, 2: 57}
    assert sorted(sum(c[j] for c in matrix.values()) for j in range(7)) == [22, 23, 23, 23, 23, 23, 23]


def test_hilbert_neighbours_touch():
    for dims, bits in ((2, 4), (3, 2), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        keys = hilbert_keys(grid, bits)
        assert len(set(keys.tolist())) == len(grid)
        assert (np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def brute(vectors, k):
    usable = [(i, np.array(v, float)) for i, v in vectors if v is not None and i is not None and None not in v and np.isfinite(v).all() and any(v)]
    size = max({len(v) for _, v in usable}, key=lambda n: (sum(len(v) == n for _, v in usable), n), default=0)
    usable = [(i, v) for i, v in usable if len(v) == size]
    out = {}
    for q, x in usable:
        if q % 100 == 0:
            near = sorted({(float(np.sqrt(((v - x) ** 2).sum())), i) for i, v in usable if i != q})[:k]
            out[q] = [(r + 1, i) for r, (_, i) in enumerate(near)]
    return out


def test_neighbours_of_edge_vectors(spark):
    rng = np.random.default_rng(2)
    data = [(i, [float(x) for x in np.float32(rng.normal(size=4))]) for i in range(301)]
    data += [(i, data[3][1]) for i in range(400, 520)]  # copies, more than are asked for
    data += [(600, None), (700, [0.0] * 4), (800, [None, 1.0, 1.0, 1.0]), (900, [float("nan")] * 4), (1000, [float("inf")] * 4), (1100, [1.0, 2.0])]
    data += [(None, [1.0, 1.0, 1.0, 1.0]), data[0]]
    df = spark.createDataFrame([(i, v, "x") for i, v in data], "vec_id long, embedding array<float>, rank string")
    got = {}
    for q, r, i, s in rows(ann.nearest(df, lambda c: c % 100 == 0, k=10), "query_id", "rank", "vec_id", "score"):
        got.setdefault(q, []).append((r, i))
    assert {q: sorted(v) for q, v in got.items()} == brute(data, 10)
    assert ann.nearest(df.limit(0), lambda c: c % 100 == 0).count() == 0


def test_recall_on_the_given_vectors(spark, small):
    vectors = spark.read.parquet(f"{small}/embeddings.parquet")
    data = rows(vectors, "vec_id", "embedding")
    want = brute(data, 10)
    got = {}
    for q, r, i in rows(ann.nearest(vectors, lambda c: c % 100 == 0, k=10, cell_rows=16), "query_id", "rank", "vec_id"):
        got.setdefault(q, set()).add(i)
    found = [len(got[q] & {i for _, i in near}) / len(near) for q, near in want.items()]
    assert np.mean(found) >= 0.9
