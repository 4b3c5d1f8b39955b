"""The pipeline and its queries: registered names, and each stage against brute force."""

import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from cohortkit.llm import jaccard, quality
from tests.conftest import rows
from tests.llm.test_copies import brute_components, brute_leaks, brute_repeats


def test_all_queries_are_registered():
    names = list(__spark_entry__.queries())
    for n in range(1, 14):
        assert len([x for x in names if x.startswith(f"op{n}_")]) == 1
    assert "pipeline" in names and [s for s, _ in corpus_pipeline.STAGES] == ["quality", "near_copies", "repeated_text", "benchmark", "packing"]


def test_stages_equal_brute_force(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    benchmark = rows(spark.read.parquet(f"{small}/benchmark.parquet"), "item_id", "text")
    stage = dict(corpus_pipeline.STAGES)

    def after(name, df):
        stage[name](spark, df, small).write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    def texts(df):
        return rows(df, "doc_id", "text")

    good = after("quality", docs)
    model = quality.learn(docs, spark.read.parquet(f"{small}/labels.parquet"), 3, 1)
    want = {i for i, t in texts(docs) if model.scores([quality.passage_features(t)])[0] >= 0.5}
    assert good.columns == docs.columns and {i for i, _ in texts(good)} == want and len(want) > 100

    single = after("near_copies", good)
    want = {d for d, n, c in brute_components(texts(good), jaccard.Rule()) if d == c}
    assert single.columns == docs.columns and {i for i, _ in texts(single)} == want

    cut = after("repeated_text", single)
    assert cut.columns == docs.columns
    sizes = {d: n - gone for d, n, gone, _, _ in brute_repeats(texts(single), 50)}
    for i, t in texts(cut):  # a cut inside a character may cost up to three more bytes at each side
        assert sizes[i] - 200 <= len(t.encode()) <= sizes[i]
    assert sum(len(t.encode()) for _, t in texts(cut)) >= 0.999 * sum(sizes.values())

    clean = after("benchmark", cut)
    leaked = {d for d, _ in brute_leaks(texts(cut), benchmark)}
    assert {i for i, _ in texts(clean)} == {i for i, _ in texts(cut)} - leaked

    packed = after("packing", clean)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 0], "<u4") for i, t in texts(clean)}
    covered = dict.fromkeys(ids, 0)
    places = {}
    for d, start, n, crc, s, offset in sorted(rows(packed, "doc_id", "start", "length", "ids_crc32", "sequence_id", "offset")):
        assert start == covered[d] and crc == zlib.crc32(ids[d][start : start + n])
        covered[d] += n
        places.setdefault(s, []).append((offset, n))
    assert covered == {d: len(x) for d, x in ids.items()}
    for mine in places.values():
        at = 0
        for offset, n in sorted(mine):
            assert offset == at
            at += n
        assert at <= 2048


def test_run_applies_all_stages(spark, small):
    assert corpus_pipeline.run(spark, small).count() > 100


def test_run_on_edge_rows_and_on_nothing(spark, edge_docs, no_docs, small, tmp_path):
    """Nulls, repeated rows, very long texts and clashing columns pass all stages; an empty table gives no row."""
    for name, docs in (("edge", edge_docs), ("none", no_docs)):
        base = tmp_path / name
        docs.write.parquet(str(base / "documents.parquet"))
        for t in ("benchmark", "labels"):
            spark.read.parquet(f"{small}/{t}.parquet").write.parquet(str(base / f"{t}.parquet"))
        out = rows(corpus_pipeline.run(spark, str(base)), "doc_id", "piece", "start", "length", "sequence_id", "offset")
        assert (len(out) > 0) == (name == "edge")
        assert all(0 < n <= 2048 and offset + n <= 2048 for _, _, _, n, _, offset in out)
