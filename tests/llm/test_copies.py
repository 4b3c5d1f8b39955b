"""Near copies, repeated strings and benchmark passages against brute force."""

import hashlib
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortkit.llm import decontam, jaccard, substrings, suffixes
from cohortkit.llm.components import components
from cohortkit.llm.shingles import odd_sketch, shingle_set, sketch_difference
from tests.conftest import rows

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def word_set(text, k):
    w = WORD.findall((text or "").encode().translate(LOWER))
    n = min(k, len(w))
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if w else frozenset()


def brute_components(docs, rule):
    """Smallest id of each row's component, by comparing all pairs of sets."""
    sets = [word_set(t, rule.words) for _, t in docs]
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x and y and rule.den * len(x & y) >= rule.num * len(x | y):
                parent[find(a)] = find(b)
    smallest = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            smallest[find(i)] = min(smallest.get(find(i), d), d)
    return [(d, len(sets[i]), smallest.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(docs)]


def test_shingles_equal_word_tuples():
    for text in ("", "A", "a b", "The the THE the", " x\ty\nz  w", "é É a\u00a0b", "a b c d e f a b c"):
        assert len(shingle_set(text, 3)) == len(word_set(text, 3))
    assert np.array_equal(shingle_set("A b C", 3), shingle_set("a B c", 3))


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), max_size=80), st.sets(st.integers(0, 2**64 - 1), max_size=80), st.sampled_from([64, 128, 256]))
def test_sketches_never_overstate_a_difference(a, b, bits):
    x, y = (np.array(sorted(s), np.uint64) for s in (a, b))
    assert sketch_difference(odd_sketch(x, bits), odd_sketch(y, 2 * bits)) <= len(a ^ b)


def test_components_of_a_path_and_a_star(spark):
    edges = [(f"p{i:03d}", f"p{i + 1:03d}") for i in range(40)] + [("s", f"t{i}") for i in range(30)] + [("x", "x")]
    got = dict(rows(components(spark.createDataFrame(edges, "a string, b string")), "v", "root"))
    assert got == {**{f"p{i:03d}": "p000" for i in range(1, 41)}, **{f"t{i}": "s" for i in range(30)}}


def family(n=40, words=60):
    """Near copies of one text, a common passage in unrelated texts, and texts of few words."""
    rng = np.random.default_rng(4)
    base = [f"w{x}" for x in rng.integers(0, 500, words)]
    passage = " ".join(f"p{i}" for i in range(40))
    docs = []
    for i in range(n):
        copy = list(base)
        for at in rng.integers(0, words, i % 3):
            copy[at] = f"edit{i}_{at}"
        docs.append((i, " ".join(copy)))
        docs.append((1000 + i, passage + " " + " ".join(f"u{i}_{j}" for j in range(i % 12))))
    return docs


def test_jaccard_components_equal_brute_force(spark, edge_docs):
    docs = family() + rows(edge_docs, "doc_id", "text")
    for rule in (jaccard.Rule(3, 90, 100), jaccard.Rule(5, 8, 10)):
        df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
        got = rows(jaccard.jaccard_components(df, rule, frequent=3), "doc_id", "n_shingles", "component_id")
        assert sorted(got, key=str) == sorted(brute_components(docs, rule), key=str)


def test_components_of_unlinked_families_and_of_nothing(spark, no_docs):
    """Texts that share most of their words without being linked, chains of links, and one text in very many copies."""
    rng = np.random.default_rng(6)
    base = [f"c{i}" for i in range(50)]
    docs = [(i, " ".join(base[:38] + [f"z{i}_{j}" for j in range(9)])) for i in range(60)]
    docs += [(100 + i, " ".join(base[i : i + 40])) for i in range(10)]
    docs += [(200 + i, " ".join(rng.permutation(base)[:30])) for i in range(20)] + [(300 + i, " ".join(base)) for i in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    for rule, frequent in ((jaccard.Rule(3, 90, 100), 1000), (jaccard.Rule(2, 8, 10), 5)):
        got = rows(jaccard.jaccard_components(df, rule, frequent=frequent), "doc_id", "n_shingles", "component_id")
        assert sorted(got) == sorted(brute_components(docs, rule))
    assert jaccard.jaccard_components(no_docs, jaccard.Rule()).count() == 0


def test_two_sets_meet_at_the_head_of_a_run_of_shared_keys(spark):
    """``prev`` names the key before, so a pair skips the keys behind a shared one, and never its first shared key."""
    rule = jaccard.Rule(1, 8, 10)
    sets = [np.arange(10, 60), np.concatenate([[3], np.arange(10, 59)])]
    low = [(i, len(s), s.astype("<u8").tobytes()) for i, s in enumerate(sets)]
    df = spark.createDataFrame([(i, n, bytearray(x), None, None) for i, n, x in low], "sid long, n int, low binary, often array<long>, own int")
    got = rows(jaccard.keys(df, rule, False), "sid", "key", "prev")
    for i, s in enumerate(sets):
        mine = [(k, p) for j, k, p in got if j == i]
        assert mine == [(int(k), int(p) if n else None) for n, (k, p) in enumerate(zip(s[:11], np.concatenate([[0], s])))]
    one, two = ({k: p for j, k, p in got if j == i} for i in (0, 1))
    assert [k for k in one if k in two and (one[k] is None or one[k] != two[k])] == [10]


def test_one_of_each_group_stays(spark, edge_docs, no_docs):
    rule = jaccard.Rule()
    kept = jaccard.keep_one(edge_docs, rule)
    assert kept.columns == edge_docs.columns
    got = sorted(rows(kept, "doc_id", "text"), key=str)
    docs = rows(edge_docs, "doc_id", "text")
    with_words = {d for d, n, c in brute_components(docs, rule) if n and d == c}
    want = [(d, t) for d, t in {(d, t): 0 for d, t in docs if d in with_words or (d is None and word_set(t, 5) and False)}]
    want += [(d, t) for d, t in docs if not word_set(t, 5)]
    assert got == sorted(want, key=str)
    assert jaccard.keep_one(no_docs, rule).count() == 0


# --- repeated byte strings


def brute_repeats(docs, length):
    """(id, bytes, removed, runs, sha256) by a dictionary of all strings."""
    first = {}
    key = [substrings.LAST if d is None else d for d, _ in docs]
    raw = [(t or "").encode() for _, t in docs]
    for d, b in zip(key, raw):
        for i in range(len(b) - length + 1):
            s = b[i : i + length]
            first[s] = min(first.get(s, d), d)
    out = []
    for (d, _), k, b in zip(docs, key, raw):
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if first[b[i : i + length]] < k:
                gone[i : i + length] = True
        runs = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(b) else 0
        out.append((d, len(b), int(gone.sum()), runs, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest()))
    return out


def repeated_texts():
    rng = np.random.default_rng(8)
    pool = ["".join(rng.choice(list("abcde é"), 30)) for _ in range(12)]
    docs = [(int(i), "".join(pool[j] for j in rng.integers(0, 12, rng.integers(0, 6)))) for i in rng.permutation(60)]
    return docs + [(100, "ab" * 400), (101, "ba" * 300), (102, "a" * 500), (103, "a" * 49), (104, "a" * 50), (104, "x" * 60)]


def test_repeats_equal_brute_force(spark, edge_docs, no_docs):
    docs = repeated_texts() + [(None if d is None else d + 200, t) for d, t in rows(edge_docs, "doc_id", "text") if t is None or len(t) < 5000]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    want = sorted(brute_repeats(docs, 50), key=str)
    for plan in (substrings.Plan(50, 24, 3, batch_bytes=2000), substrings.Plan(50, 20, 2, crowd=1), substrings.Plan(50, 24, 2, hot=1, pieces=1)):
        got = rows(substrings.digests(df, plan), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
        assert sorted(got, key=str) == want
    assert substrings.digests(no_docs).count() == 0


def test_surroundings_of_equal_40_bit_hashes_stay(spark):
    """Two texts around one 24-byte gram that share no window, though 40 bits of the first hash of all their bytes agree."""
    gram = "dsdgfloyyjzqmvyzuopgtizg"
    docs = [(1, "qbcfcsefiglkpeddahxfrulned" + gram + "zuqhuarrfhfvrtgbbbilbtvseq"), (2, "xtgjcamrldylqtabgbegwzbzhf" + gram + "jjevtqcodmgssyzydokqbpxoua")]
    docs += [(3, "kepbnhmahaehkkxumuowwhwewk" + gram + "tqqpnmprgyxiddlkxzlipultdu"), (4, "ucuwttsumwgunvdqldhsshkity" + gram + "edydpjgmcnfpxzwmaualiptseg"), (5, docs[1][1])]
    raw = [np.frombuffer(t.encode(), np.uint8) for _, t in docs]
    first, second = (suffixes.context_keys(x, np.array([26]), 24, 50)[0] for x in raw[:2])
    assert first[0] & np.uint64(2**40 - 1) == second[0] & np.uint64(2**40 - 1) and first[1] != second[1]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = rows(substrings.digests(df, substrings.Plan(50, 24, 2)), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert sorted(got) == sorted(brute_repeats(docs, 50)) and sum(r[2] for r in got) == 76


def test_parts_grow_with_the_texts(spark, no_docs, monkeypatch):
    docs = spark.createDataFrame([(1, "é" * 500), (2, None), (3, "x" * 24)], "doc_id long, text string")
    least = substrings.default_plan(no_docs).parts
    assert substrings.default_plan(docs).parts == least == max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    monkeypatch.setattr(substrings, "PART_BYTES", 10)
    assert substrings.default_plan(docs).parts == max(least, 103)
    monkeypatch.setattr(substrings, "PART_BYTES", 1)
    assert substrings.default_plan(docs).parts == 1024


def test_cut_texts_keeps_other_columns(spark, edge_docs):
    cut = substrings.cut_texts(edge_docs)
    assert cut.columns == edge_docs.columns and cut.count() == edge_docs.count()
    left = {(i, t) for i, t in rows(cut, "doc_id", "text")}
    assert (2, "") in left and (3, None) in left and (5, "short") in left


def test_stages_of_nothing(spark, no_docs, edge_docs):
    bench = spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    assert substrings.cut_texts(no_docs).collect() == [] and decontam.drop_leaks(no_docs, bench).collect() == []
    assert decontam.drop_leaks(edge_docs, bench.limit(0)).count() == edge_docs.count()


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text("ab", min_size=6, max_size=14), min_size=1, max_size=12))
def test_suffix_sort_orders_and_classes(texts):
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    starts, at = [], 0
    for t in texts:
        starts += range(at, at + len(t) - 5)
        at += len(t)
    starts = np.array(starts)
    group = np.sort(np.arange(len(starts)) % 3)
    order = suffixes.sort_suffixes(data, starts, group, 6)
    strings = [bytes(data[s : s + 6]) for s in starts]
    want = sorted(range(len(starts)), key=lambda i: (group[i], strings[i]))
    assert [(group[i], strings[i]) for i in order] == [(group[i], strings[i]) for i in want]
    label = suffixes.equal_classes(data, starts, order, group, 6)
    assert len(set(label.tolist())) == len({(group[i], strings[i]) for i in range(len(starts))})


# --- benchmark passages


def norm(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def brute_leaks(docs, items, shingle=5, least=0.8):
    """Best similarity of each document and item over windows of the item's words; a shorter text is one window."""
    from collections import Counter

    found = {}
    for d, t in docs:
        w = norm(t)
        for i, x in items:
            v = norm(x)
            k = min(shingle, len(v))
            if not v:
                continue
            b = Counter(tuple(v[j : j + k]) for j in range(len(v) - k + 1))
            for s in range(max(1, len(w) - len(v) + 1)):
                u = w[s : s + len(v)]
                a = Counter(tuple(u[j : j + k]) for j in range(len(u) - k + 1))
                sim = sum((a & b).values()) / sum((a | b).values())
                if sim >= least:
                    found[d, i] = max(found.get((d, i), 0), sim)
    return {k: round(v, 9) for k, v in found.items()}


def test_leaks_equal_brute_force(spark, edge_docs, no_docs):
    item = " ".join(f"Item{i % 37}" for i in range(60))
    other = "one two three four five six seven eight nine ten eleven twelve"
    items = [(1, item), (2, other), (3, "tiny one"), (4, None), (5, ""), (6, other), (6, other), (None, "null id item of seven words here")]
    w = item.split()
    edited = w[:30] + ["changed"] + w[31:]
    docs = [(1, "before " + item + " after"), (2, "x y " + " ".join(edited)), (3, " ".join(w[2:])), (4, "a " + other.upper().replace(" ", ", ") + "!"),
            (5, " ".join(w[:40])), (6, "a tiny one here"), (7, item + " " + item), (8, "null id item of seven words here"), (8, "null id item of seven words here")]
    docs += [(None if d is None else d + 100, t) for d, t in rows(edge_docs, "doc_id", "text") if t is None or len(t) < 5000]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(d, i): round(s, 9) for d, i, s in rows(decontam.find_leaks(df, bench), "doc_id", "item_id", "similarity")}
    assert got == brute_leaks(docs, items)
    kept = decontam.drop_leaks(edge_docs, bench)
    assert kept.columns == edge_docs.columns
    assert decontam.find_leaks(no_docs, bench).count() == 0 and decontam.find_leaks(df, bench.limit(0)).count() == 0


def test_texts_shorter_than_the_item_leak(spark):
    w = [f"Item{i % 37}" for i in range(60)]
    few = "one two three four five six seven eight nine".split()
    items = [(1, " ".join(w)), (2, " ".join(few)), (3, "tiny one"), (None, "a null id item of nine words is here"), (5, "same six words in an item"), (5, "same six words in an item too")]
    cuts = [w[1:], w[:-1], w[2:], w[5:-4], w[6:-6], w[:49], w[:30] + w[31:], ["x"] + w[1:-1], few[1:], few[:-1], few[1:-1], few[:4], few[:2] + few[3:], ["tiny"],
            "null id item of nine words is here".split(), "same six words in an".split(), "same six words in an item".split(), []]
    docs = [(i, " ".join(c)) for i, c in enumerate(cuts)] + [(3, None), (None, " ".join(w[1:])), (0, " ".join(w[1:]))]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute_leaks(docs, items)
    assert {(0, 1), (2, 1), (8, 2), (14, None), (None, 1)} <= want.keys()
    size = {i: [len(norm(x)) for j, x in items if j == i] for i, _ in items}
    for limit in (8 << 20, 0):
        got = {(d, i): (round(s, 9), a, n) for d, i, s, a, n in rows(
            decontam.find_leaks(df, bench, broadcast_bytes=limit), "doc_id", "item_id", "similarity", "start", "n_words")}
        assert {k: x[0] for k, x in got.items()} == want
        for (d, i), (_, start, n) in got.items():  # the window has the item's words, or is the whole shorter text
            words = [len(norm(t)) for e, t in docs if e == d]
            assert any(n == m and start + n <= w for m in size[i] for w in words) or (start == 0 and n in words)
    left = {d for d, in rows(decontam.drop_leaks(df, bench), "doc_id")}
    assert left == {d for d, _ in docs} - {d for d, _ in got}


def test_simhash_radius_loses_no_block():
    for width, most in ((8, 2), (16, 1)):
        masks = decontam.flips(width, most)
        assert sorted(masks) == sorted(m for m in range(1 << width) if m.bit_count() <= most)
