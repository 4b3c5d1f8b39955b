"""Fill-in-the-middle texts, cut at units found by one repeated capture.

A text is a sequence of units (lines).  One ``fullmatch`` of ``(unit)*`` by the
regex library keeps every repetition of the group, so the number of units and
the end of each are read from the match; no loop runs over the units.  Two hashed
draws choose the cuts, two more the form:

* ``psm``: prefix sentinel, prefix, suffix sentinel, suffix, middle sentinel, middle;
* ``spm``: suffix sentinel, suffix, prefix sentinel, prefix, middle sentinel, middle;
* ``plain``: the text itself, if it is empty, holds a sentinel, or is not drawn.

Null texts are empty, so plain.  A null id is hashed as no digits at all.  Rows
are transformed one by one: repeated rows give equal rows, an empty table gives
an empty result, texts of any length are cut whole, and other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tokens import slices

#: Bytes of text that are cut at a time; a longer text stands alone.
SLICE = 1 << 20


@dataclass(frozen=True)
class Infill:
    """``rate`` of 100 texts are cut, ``spm`` of 100 of these have the suffix first.

    ``unit`` must match without giving back (possessive), so a match of the
    whole text needs memory for the captured bounds only.
    """

    seed: int = 7
    rate: int = 100
    spm: int = 50
    unit: str = r"[^\n]*+\n|[^\n]++"
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def units(self) -> regex.Pattern:
        return regex.compile(f"({self.unit})*+")

    def marks(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


def unit_ends(pattern: regex.Pattern, text: str) -> list[int]:
    """The end of every unit, in code points."""
    found = pattern.fullmatch(text)
    if found is None:
        raise ValueError("the unit does not cover the whole text")
    return found.ends(1)


def cut(text: str, ends: list[int], first: int, second: int) -> tuple[int, int]:
    """Ends of prefix and middle for two draws, each uniform over the bounds of the units."""
    bounds = len(ends) + 1
    a, b = sorted((first % bounds, second % bounds))
    return (ends[a - 1] if a else 0), (ends[b - 1] if b else 0)


def fill_in_middle(docs: DataFrame, spec: Infill = Infill(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n, form, prefix_chars, middle_chars, output`` of every row; ``n`` units, counts in code points."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern, (p, s, m) = spec.units(), spec.marks()
        for whole in batches:
            for low, high in slices(whole.column(1), SLICE):
                b = whole.slice(low, high - low)
                rows = []
                for text, h1, h2, h3, h4 in zip(*(b.column(i).to_pylist() for i in range(1, 6))):
                    text = text or ""
                    ends = unit_ends(pattern, text)
                    if not text or any(mark in text for mark in (p, s, m)) or h3 % 100 >= spec.rate:
                        rows.append((len(ends), "plain", None, None, text))
                        continue
                    x, y = cut(text, ends, h1, h2)
                    head, mid, tail = text[:x], text[x:y], text[y:]
                    form, parts = ("spm", (s, tail, p, head)) if h4 % 100 < spec.spm else ("psm", (p, head, s, tail))
                    rows.append((len(ends), form, x, y - x, "".join([*parts, m, mid])))
                n, form, x, y, out = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(x, pa.int64()), pa.array(y, pa.int64()), pa.array(out, pa.string())],
                    names=[id_col, "n", "form", "prefix_chars", "middle_chars", "output"])

    kind = docs.schema[id_col].dataType.simpleString()
    digest = F.sha2(F.concat(F.lit(f"{spec.seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]
    rows = docs.select(F.col(id_col), F.col(text_col), *(d.alias(f"h{i}") for i, d in enumerate(draws, 1)))
    return rows.mapInArrow(run, f"`{id_col}` {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(spec: Infill = Infill(), form: str = "form", output: str = "output") -> Column:
    """The text that an output was made of, from the output and its form alone."""
    out, kind = F.col(output), F.col(form)
    chars = lambda lo, hi: F.substring(out, lo, hi - lo)  # noqa: E731  from place lo up to place hi, from 1
    lead, second = (F.when(kind == "psm", F.lit(a)).otherwise(F.lit(b)) for a, b in ((spec.prefix, spec.suffix), (spec.suffix, spec.prefix)))
    at_second, at_middle = F.instr(out, second), F.instr(out, spec.middle)
    one = chars(F.char_length(lead) + 1, at_second)
    two = chars(at_second + F.char_length(second), at_middle)
    mid = chars(at_middle + len(spec.middle), F.char_length(out) + 1)
    return F.when(kind == "plain", out).when(kind == "psm", F.concat(one, mid, two)).otherwise(F.concat(two, mid, one))
