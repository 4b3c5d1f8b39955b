"""Token ids, blocks and packing, without a session where none is needed."""

import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cohortkit.llm import packing, token_store
from cohortkit.llm.tokens import WordEncoder, slices
from tests.conftest import rows

PATH = public_tokenizers.path("byte_bpe_50k.json")
pieces = st.sampled_from(["a", "Word", "x,", "é", "ß.", " ", "  ", "\n", "\t", "\u00a0", "\u3000", "\x1c", "\x85", "it's", "12", "!!", "|", "<|endoftext|>", "漢字", "😀"])


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


@pytest.fixture(scope="module")
def words():
    return WordEncoder(PATH, memo_words=50)


@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.lists(pieces, max_size=12).map("".join), min_size=1, max_size=4))
def test_word_memo_equals_the_library(library, words, texts):
    ids, bounds = words.encode_column(pa.array([*texts, None]))
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)] + [[]]
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == want
    assert [np.frombuffer(x, words.dtype).tolist() for x in words.encode(texts)] == want[:-1]


def test_slices_cover_all_rows():
    texts = pa.array(["ab" * 50, None, "", "x" * 500, "y"])
    spans = list(slices(texts, 100))
    assert [i for a, b in spans for i in range(a, b)] == list(range(5))
    assert list(slices(pa.array([], pa.string()))) == []


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 5000), max_size=300))
def test_elias_fano_round_trip_and_select(gaps):
    values = np.cumsum([0, *gaps])
    ef = token_store.EliasFano.from_bytes(token_store.EliasFano.encode(values).to_bytes())
    assert [ef.select(i) for i in range(ef.n)] == values.tolist()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(-2**63, 2**63 - 1), max_size=70), st.integers(0, 3))
def test_ids_of_a_block_are_distances_from_its_first(ids, nulls):
    ids = sorted(ids)
    n_null, first, raw = token_store.id_image(pa.array([None] * nulls + ids, pa.int64()))
    ef = token_store.EliasFano.from_bytes(raw)
    assert n_null == nulls and [first + ef.select(i) for i in range(ef.n)] == ids
    near = token_store.id_image(pa.array(range(10**15, 10**15 + 3000)))[2]
    assert len(near) < 3000  # 2 bits an id and the samples, not 64


def test_block_image_round_trip():
    ids = np.arange(1000, dtype="<u2")
    got, ef = token_store.read_image(token_store.block_image(ids, np.array([0, 10, 10, 1000])))
    assert np.array_equal(got, ids) and [ef.select(i) for i in range(ef.n)] == [0, 10, 10, 1000]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 63), min_size=1, max_size=200))
def test_sum_of_squares_fills_without_gaps(lengths):
    lengths = np.array(lengths)
    bins, offsets = packing.sum_of_squares(lengths, 64)
    for b in set(bins.tolist()):
        mine = np.flatnonzero(bins == b)
        mine = mine[np.argsort(offsets[mine])]
        assert offsets[mine].tolist() == (np.cumsum(lengths[mine]) - lengths[mine]).tolist()
        assert lengths[mine].sum() <= 64
    assert len(set(bins.tolist())) <= 2 * -(-lengths.sum() // 64)


def test_cut_points():
    assert packing.cut_points(5, 4) == [(0, 1), (1, 4)]
    assert packing.cut_points(8, 4) == [(0, 4), (4, 4)]
    assert packing.cut_points(1, 4) == [(0, 1)]


def ids_of(library, text):
    return np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")


def test_packing_of_edge_rows(spark, library, edge_docs, no_docs):
    got = rows(packing.pack(packing.token_pieces(edge_docs, PATH, 64, 0), 64), "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
    want = []
    for i, t in rows(edge_docs, "doc_id", "text"):
        ids = ids_of(library, t)
        want += [(i, k, s, n, zlib.crc32(ids[s : s + n])) for k, (s, n) in enumerate(packing.cut_points(len(ids), 64))]
    assert sorted((r[:5] for r in got), key=str) == sorted(want, key=str)
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r[5], []).append((r[6], r[3]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.pack(packing.token_pieces(no_docs, PATH, 64, 0), 64).count() == 0


def test_token_store_of_edge_rows(spark, library, edge_docs, no_docs):
    got = sorted(rows(token_store.encode_and_read(edge_docs, PATH), "start", "doc_id", "n_tokens", "ids_crc32"))
    source = {}
    for i, t in rows(edge_docs, "doc_id", "text"):
        source.setdefault(i, []).append((len(ids_of(library, t)), zlib.crc32(ids_of(library, t))))
    at = 0
    for start, i, n, crc in got:
        assert start == at and (n, crc) in source[i]
        source[i].remove((n, crc))
        at += n
    assert not any(source.values())
    order = [(i is not None, i or 0) for _, i, _, _ in got]
    assert order == sorted(order)  # nulls first, then ascending
    assert token_store.encode_and_read(no_docs, PATH).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 11), max_size=40))
def test_every_piece_goes_where_the_sum_of_squares_is_least(lengths):
    """Each placement against all others: every open gap that fits, and a new sequence."""
    capacity = 12
    bins, offsets = packing.sum_of_squares(np.array(lengths, np.int64), capacity)
    gap: dict[int, int] = {}  # gap of each sequence

    def total(gaps):
        n = [0] * capacity
        for g in gaps:
            n[g] += 1
        return sum(x * x for x in n[1:])

    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        s = lengths[i]
        choices = []
        for b, g in gap.items():
            if g >= s:
                choices.append((total([*(h for c, h in gap.items() if c != b), g - s]), 0, g, b))
        choices.append((total([*gap.values(), capacity - s]), 1, capacity, len(gap)))
        want = min(choices)  # of equal sums an open sequence, the smaller gap, the older sequence
        assert (bins[i], offsets[i]) == (want[3], capacity - want[2])
        gap[int(bins[i])] = want[2] - s
