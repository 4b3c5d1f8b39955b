"""One query per operator, over whole tables with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, decontam, infill, jaccard, langid, packing, quality, resampling, sharding, substrings, token_store, toxicity, url_filter
from .common import table

#: The rules of the url query.
URL_RULES = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block"}


def tokenizer_path() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lexicon = toxicity.learn(docs, table(spark, sf_dir, "labels"), folds=5, held_out=0)
    return toxicity.score_texts(docs, lexicon, folds=5, held_out=0)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"), tokenizer_path(), capacity=2048, end_id=0)
    return packing.pack(pieces, capacity=2048)


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digests(table(spark, sf_dir, "documents"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"), jaccard.Rule(words=3, num=90, den=100))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.learn(docs, table(spark, sf_dir, "labels"), folds=3, held_out=1)
    return quality.score_texts(docs, model, folds=3, held_out=1)


def op8_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.encode_and_read(table(spark, sf_dir, "documents"), tokenizer_path(), end_id=0)


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = sharding.text_facts(table(spark, sf_dir, "documents"))
    return sharding.shard_rows(facts, shards=40).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op10_hilbert_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), lambda i: i % 100 == 0, k=10)


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = resampling.importance_ranks(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), resampling.Features(most=1, buckets=10_000), seed=2024, least_words=20, percent=10)
    return ranked.select("doc_id", "n_features", "weight", "score", "rank")


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.learn(docs, folds=5, held_out=0), folds=5, held_out=0)


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = infill.Infill(seed=7, rate=100, spm=50)
    cut = infill.fill_in_middle(table(spark, sf_dir, "documents"), spec)
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                      F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                      F.sha2(infill.restored(spec).cast("binary"), 256).alias("restored_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_toxicity, op2_best_fit_packing, op3_url_filter, op4_suffix_dedup, op5_jaccard_join, op6_decontamination, op7_quality, op8_token_store,
    op9_sharding, op10_hilbert_neighbours, op11_importance_resampling, op12_language_id, op13_fill_in_middle)}

SQL = {
    "op3_url_filter": r"""
        WITH cut AS (
          SELECT page_id, coalesce(translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
                 coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
          FROM pages),
        rules(rule_host, rule_path, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
          ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
        best AS (
          SELECT page_id, host, path, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
                 max_by(verdict, length(rule_host || rule_path)) AS verdict
          FROM cut JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
          GROUP BY ALL)
        SELECT c.page_id, c.host, c.path, b.rule, coalesce(b.verdict, 'allow') AS verdict
        FROM cut c LEFT JOIN best b USING (page_id)""",
    "op5_jaccard_join": r"""
        WITH RECURSIVE split AS (
          SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        sets AS (
          SELECT doc_id, CASE WHEN coalesce(len(w), 0) = 0 THEN []::VARCHAR[] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                              ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS shingles
          FROM split),
        sized AS (SELECT doc_id, shingles, len(shingles) AS n FROM sets),
        held AS (SELECT doc_id, n, unnest(shingles) AS s FROM sized),
        common AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS c FROM held a JOIN held b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
        near AS (SELECT a, b FROM common WHERE 100 * c >= 90 * (na + nb - c)),
        links AS (SELECT a, b FROM near UNION ALL SELECT b, a FROM near),
        reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
        lowest AS (SELECT a AS doc_id, min(b) AS low FROM reach GROUP BY a)
        SELECT doc_id, n::BIGINT AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id FROM sized LEFT JOIN lowest USING (doc_id)""",
    # crc32 bit by bit from its polynomial, over the distinct words
    "op11_importance_resampling": r"""
        WITH place AS (
          SELECT list_transform(range(256), lambda b: list_reduce([b::BIGINT] || range(8), lambda c, i: xor(c >> 1, (c & 1) * 3988292384))) AS t),
        words AS (
          SELECT of, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w
          FROM (SELECT 's' AS of, doc_id, text FROM documents UNION ALL SELECT 't', item_id, text FROM benchmark)),
        held AS (SELECT of, doc_id, w, count(*) AS n FROM words GROUP BY ALL),
        kinds AS (SELECT DISTINCT w, hex(encode(w)) AS x FROM held),
        coded AS (
          SELECT w, xor(list_reduce([4294967295::BIGINT] || list_transform(range(length(x) // 2), lambda i: ('0x' || substr(x, 2 * i::INT + 1, 2))::BIGINT),
                                    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
          FROM kinds, place),
        placed AS (SELECT of, doc_id, bucket, sum(n)::BIGINT AS n FROM held JOIN coded USING (w) GROUP BY ALL),
        counts AS (SELECT b AS bucket, coalesce(sum(n) FILTER (WHERE of = 's'), 0) AS s, coalesce(sum(n) FILTER (WHERE of = 't'), 0) AS t
                   FROM range(10000) r(b) LEFT JOIN placed ON bucket = b GROUP BY b),
        totals AS (SELECT sum(s)::DOUBLE AS s_all, sum(t)::DOUBLE AS t_all FROM counts),
        gains AS (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (s_all + 10000) / ((s + 1)::DOUBLE * (t_all + 10000))))::BIGINT AS gain FROM counts, totals),
        weights AS (SELECT doc_id, sum(n)::BIGINT AS n_features, floor(sum(n * gain)::DOUBLE / sum(n))::BIGINT AS weight
                    FROM placed JOIN gains USING (bucket) WHERE of = 's' GROUP BY doc_id),
        scored AS (
          SELECT d.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
                 (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296))))::BIGINT AS score
          FROM documents d LEFT JOIN weights USING (doc_id)),
        ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS open FROM scored WHERE n_features >= 20)
        SELECT s.doc_id, n_features, weight, score, r.rank FROM scored s LEFT JOIN ranked r ON r.doc_id = s.doc_id AND r.rank <= (10 * r.open) // 100""",
    "op13_fill_in_middle": r"""
        WITH draws AS (
          SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || doc_id) AS x,
                 regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units FROM documents),
        cuts AS (
          SELECT doc_id, text, len(units) AS n, list_transform(units, lambda u: length(u)) AS sizes,
                 ('0x' || substr(x, 1, 8))::BIGINT % (len(units) + 1) AS c1, ('0x' || substr(x, 9, 8))::BIGINT % (len(units) + 1) AS c2,
                 ('0x' || substr(x, 17, 8))::BIGINT % 100 AS c3, ('0x' || substr(x, 25, 8))::BIGINT % 100 AS c4
          FROM draws),
        lengths AS (
          SELECT doc_id, text, n,
                 CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR c3 >= 100 THEN 'plain'
                      WHEN c4 < 50 THEN 'spm' ELSE 'psm' END AS form,
                 coalesce(list_sum(sizes[1:least(c1, c2)]), 0)::BIGINT AS p, coalesce(list_sum(sizes[1:greatest(c1, c2)]), 0)::BIGINT AS pm
          FROM cuts),
        parts AS (SELECT *, substr(text, 1, p) AS a, substr(text, p + 1, pm - p) AS b, substr(text, pm + 1) AS c FROM lengths)
        SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN p END AS prefix_chars, CASE WHEN form <> 'plain' THEN pm - p END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || a || '<S>' || c || '<M>' || b ELSE '<S>' || c || '<P>' || a || '<M>' || b END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM parts""",
}
