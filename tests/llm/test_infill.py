"""Fill-in-the-middle against a plain re-computation, and the exact round trip."""

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortkit.llm import infill
from tests.conftest import rows

LINE = re.compile(r"[^\n]*\n|[^\n]+")
texts = st.lists(st.sampled_from(["a", "\n", "\n\n", "é", "漢", "😀", "\r", " ", "x y", ""]), max_size=14).map("".join)


@settings(max_examples=200, deadline=None)
@given(texts, st.integers(0, 2**32 - 1), st.integers(0, 2**32 - 1))
def test_repeated_capture_equals_a_scan(text, h1, h2):
    units = LINE.findall(text)
    ends = infill.unit_ends(infill.Infill().units(), text)
    assert [len("".join(units[: i + 1])) for i in range(len(units))] == ends
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    assert infill.cut(text, ends, h1, h2) == (len("".join(units[:a])), len("".join(units[:b])))


def test_units_must_cover_the_text():
    with pytest.raises(ValueError):
        infill.unit_ends(infill.Infill(unit="a").units(), "ab")


def brute(doc_id, text, rate, spm):
    text = text or ""
    x = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(x[8 * i : 8 * i + 8], 16) for i in range(4)]
    units = LINE.findall(text)
    a, b = sorted(v % (len(units) + 1) for v in h[:2])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= rate:
        return doc_id, len(units), "plain", None, None, text
    if h[3] % 100 < spm:
        return doc_id, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize(("rate", "spm"), [(100, 50), (60, 20), (0, 50)])
def test_rows_equal_brute_force(spark, edge_docs, no_docs, rate, spm):
    spec = infill.Infill(rate=rate, spm=spm)
    more = [(100 + i, t) for i, t in enumerate(["a\nb\nc", "a\nb\nc", "\n" * 70000, "x" * 300000, "one <M> mark", "<P", "S>\n<S>", "tail\n", "é\n漢字\n\n😀"])]
    docs = spark.createDataFrame(more, "doc_id long, text string").unionByName(edge_docs.select("doc_id", "text"))
    out = infill.fill_in_middle(docs, spec)
    got = rows(out, "doc_id", "n", "form", "prefix_chars", "middle_chars", "output")
    assert sorted(got, key=str) == sorted((brute(d, t, rate, spm) for d, t in rows(docs)), key=str)
    back = rows(out.select("doc_id", infill.restored(spec).alias("text")))
    assert sorted(back, key=str) == sorted(((d, t or "") for d, t in rows(docs)), key=str)
    assert infill.fill_in_middle(no_docs, spec).count() == 0


def test_extra_columns_and_other_marks(spark):
    docs = spark.createDataFrame([(1, "a\nb\n", "x", 5), (2, "<P>c\nd", "y", 6)], "doc_id int, text string, output string, n int")
    spec = infill.Infill(prefix="[pre]", suffix="[suf]", middle="[mid]")
    out = infill.fill_in_middle(docs, spec)
    assert out.schema["doc_id"].dataType.simpleString() == "int" and {f for (f,) in rows(out, "form")} <= {"psm", "spm"}
    assert sorted(rows(out.select("doc_id", infill.restored(spec)))) == [(1, "a\nb\n"), (2, "<P>c\nd")]
    assert out.filter(F.col("output").contains("[mid]")).count() == 2
