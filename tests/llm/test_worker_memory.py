"""What a Python worker holds at a time, and keeps from one kind of task to the next."""

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from cohortkit.llm import common, infill, jaccard, packing, quality, substrings, tokens
from cohortkit.llm.queries import tokenizer_path
from cohortkit.llm.shingles import set_id, shingle_set

RULE = jaccard.Rule(words=2)


@pytest.fixture
def tasks(spark, monkeypatch):
    """The functions that Spark would run, each with its schema left out, and documents to make them with."""
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, schema: run)
    monkeypatch.setattr(tokens, "_ENCODERS", {"tokenizer.json": "an encoder with a large memo"})
    return docs, jaccard.first_pass(docs, RULE), quality.keep_good(docs, object())


@pytest.mark.parametrize("which", [1, 2])
def test_pipeline_tasks_free_the_encoders_of_packing(tasks, which):
    assert list(tasks[which](iter([]))) == []
    assert not tokens._ENCODERS


def test_whole_sets_are_handed_back_in_parts(tasks, monkeypatch):
    docs = tasks[0]
    made = []
    monkeypatch.setattr(jaccard, "small_side", lambda df, row_bytes: df)
    monkeypatch.setattr(jaccard, "texts_of", lambda docs, wanted: docs.selectExpr("text AS cid", "text"))
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, schema: made.append(run) or self)
    jaccard.whole_sets(docs, docs.selectExpr("text AS cid"), RULE)
    texts = [f"a{i} b{i} c{i} d{i}" for i in range(3 * jaccard.SETS - 5)]
    ids = [set_id(shingle_set(t, 2)) for t in texts]
    ids[7] = b"another set"
    out = list(made[0](iter([pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), pa.array(texts)], names=["cid", "text"])])))
    assert max(b.num_rows for b in out) <= jaccard.SETS and not tokens._ENCODERS
    low = [x for b in out for x in b.column(1).to_pylist()]
    assert low == [shingle_set(t, 2).astype("<u8").tobytes() for i, t in enumerate(texts) if i != 7]


def test_anchors_are_handed_back_in_parts(tasks, monkeypatch):
    monkeypatch.setattr(substrings.TaskContext, "get", lambda: type("Task", (), {"partitionId": lambda: 0}))
    rng = np.random.default_rng(5)
    texts = ["".join(rng.choice(list("abcdefgh "), 4000)) for _ in range(40)] + ["short", None, "", "ab" * 3000]
    n = len(texts)
    docs = pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array(range(100, 100 + n)), pa.array(texts)], names=["doc_id", "row", "text"])
    run = substrings.ask(substrings.sources(tasks[0]), substrings.Plan(parts=7, batch_bytes=60_000, crowd=3))

    def sent(most):
        monkeypatch.setattr(substrings, "SENT", most)
        return list(run(iter([docs])))

    whole, some, single = sent(1 << 30), sent(8192), sent(1)
    assert len({b for x in whole for b in x.column(0).to_pylist()}) == len(whole) == 3
    assert max(x.num_rows for x in whole) == 7 > max(x.num_rows for x in some) > max(x.num_rows for x in single) == 1
    assert max(x.nbytes for x in some) < 3 * 8192
    held = [[r for x in out for r in x.to_pylist()] for out in (whole, some, single)]
    assert held[0] == held[1] == held[2] and {d for r in held[0] for d in r["docs"]} == {*range(40), n - 1}


def test_cut_texts_are_handed_back_in_slices(tasks, monkeypatch):
    monkeypatch.setattr(infill, "SLICE", 5000)
    texts = [f"{i}\nline é\n" * 40 for i in range(200)] + ["", None, "x" * 20_000, "<P>"]
    n = len(texts)
    docs = pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array(texts), *(pa.array([(7 * i + k) % 101 for i in range(n)]) for k in range(4))], names=["doc_id", "text", "h1", "h2", "h3", "h4"])
    run = infill.fill_in_middle(tasks[0])
    out = list(run(iter([docs, docs.slice(0, 0)])))
    assert max(b.nbytes for b in out if n - 2 not in b.column(0).to_pylist()) < 20_000 < docs.nbytes
    got = [r for b in out for r in b.to_pylist()]
    assert [r["doc_id"] for r in got] == list(range(n)) and [r["n"] for r in got] == [80] * 200 + [0, 0, 1, 1]
    assert [r["output"] for r in got if r["form"] == "plain"] == ["", "", "<P>"]


def test_packing_in_the_pipeline_remembers_fewer_words(spark, tasks, monkeypatch):
    monkeypatch.setattr(tokens, "_ENCODERS", {})
    monkeypatch.setattr(corpus_pipeline, "MEMO_WORDS", 50)
    monkeypatch.setattr(corpus_pipeline, "SLICE", 400)
    monkeypatch.setattr(packing, "pack", lambda pieces, capacity: pieces)
    texts = [" ".join(f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(i, i + 40)) for i in range(0, 600, 5)] + [None, "", "a  b\n c"]
    docs = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])

    def pieces(task):
        return [r for b in task(iter([docs])) for r in b.to_pylist()]

    few = pieces(corpus_pipeline.pack_sequences(spark, tasks[0], ""))
    (enc,) = tokens._ENCODERS.values()
    assert len(enc.memo) + len(enc.memo.older) < 300 < len({w for t in texts if t for w in t.split()})
    tokens.forget_encoders()
    assert few == pieces(packing.token_pieces(tasks[0], tokenizer_path(), corpus_pipeline.CAPACITY, corpus_pipeline.END_ID))


def test_smaller_batches_of_the_session_stay(spark):
    session = spark.newSession()
    for setting, want in (("64m", "1048576"), ("67108864b", "1048576"), ("700k", "700k"), ("1000", "1000"), ("1MB", "1MB"), ("1gb", "1048576")):
        session.conf.set(corpus_pipeline.BYTES_SETTING, setting)
        corpus_pipeline.bounded(lambda spark, docs, sf_dir: docs)(session, None, "")
        assert session.conf.get(corpus_pipeline.BYTES_SETTING) == want


def test_a_stage_hands_few_long_texts_to_a_task(spark):
    held = {k: spark.conf.get(k) for k in (corpus_pipeline.BATCH_SETTING, corpus_pipeline.BYTES_SETTING)}
    docs = spark.range(40).repartition(1).selectExpr("id AS doc_id", "repeat('abcdefgh', 50000) AS text")

    def count(spark, docs, sf_dir):
        return docs.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.num_rows], "size": [b.nbytes]}) for b in batches), "n long, size long")

    try:
        got = corpus_pipeline.bounded(count)(spark, docs, "").collect()
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert sum(r.n for r in got) == 40 and max(r.size for r in got) < 2 * corpus_pipeline.BATCH_BYTES


def test_tasks_give_freed_memory_back(tasks, monkeypatch):
    given = []
    monkeypatch.setattr(common, "give_back", lambda: given.append(1))
    made = [*tasks[1:], packing.token_pieces(tasks[0], tokenizer_path(), 8, 0), substrings.ask(substrings.sources(tasks[0]), substrings.Plan())]
    monkeypatch.setattr(substrings.TaskContext, "get", lambda: type("Task", (), {"partitionId": lambda: 0}))
    for task in made:
        given.clear()
        assert list(task(iter([]))) == [] and len(given) == 2  # at its start and at its end


def test_a_task_gives_memory_back_while_it_runs(monkeypatch):
    given = []
    monkeypatch.setattr(common, "give_back", lambda: given.append(1))
    monkeypatch.setattr(common, "PAUSE", -1)
    assert list(common.lean(iter)([7, 8])) == [7, 8] and len(given) == 4
    assert common.lean_group(str)(9) == "9" and len(given) == 5


def test_freed_memory_goes_back_to_the_system():
    def held():
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * 4096

    common.give_back()
    kept = [[bytes(2000) for _ in range(3)] for _ in range(20_000)]  # small pieces, which glibc keeps below a piece in use
    last = bytes(2000)
    before = held()
    del kept
    common.give_back()
    assert len(last) and held() < before - (60 << 20)
