"""Languages of a text as a mixture, by expectation-maximisation over letter n-grams.

Training counts the n-grams of all labelled texts outside the held-out fold, by
language, in ``buckets`` hashed places; smoothed shares are the likelihoods.  A
document is a mixture: each of its n-grams was drawn from one of its languages,
with the document's own proportions.  Expectation-maximisation estimates them,
starting from all languages in equal parts.  Then the language with the smallest
proportion is dropped and the rest is estimated again, down to one language; of
the sets passed, the one with the greatest likelihood less a penalty for each
language stays.

An n-gram is ``gram`` characters of a word with one blank before and behind it;
words are runs of letters of any script, lower-cased.  Whole texts are read.

Null texts and texts without a letter are ``und`` with score 0, and so is every
text if nothing was learned.  Rows with a null id or a null language are not
learned from; ids otherwise play no part, so repeated rows get equal results.  An
empty table gives an empty result, and other columns are not read.  Of languages
equal in proportion the first in text order is named.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh
from .labelled import remainder
from .shingles import mix
from .tokens import slices

UNKNOWN = "und"


@dataclass(frozen=True)
class Grams:
    gram: int = 3
    buckets: int = 1 << 16


@lru_cache(1)
def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def gram_counts(texts: list[str | None], spec: Grams) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, bucket and count of every n-gram that a text holds, ordered by text."""
    points = [np.frombuffer((t or "").lower().encode("utf-32-le", "surrogatepass"), "<u4") for t in texts]
    gap = np.full(spec.gram, 32, np.uint32)  # no n-gram reaches over two texts
    size = np.array([len(p) + spec.gram for p in points], np.int64)
    data = np.concatenate([gap, *(x for p in points for x in (p, gap))])
    doc = np.concatenate([np.zeros(spec.gram, np.int64), np.repeat(np.arange(len(texts)), size)])
    inside = letters()[data]
    keep = inside | np.concatenate([[True], inside[:-1]])  # letters, and the first of other characters
    data, doc, inside = np.where(inside, data, 32)[keep].astype(np.uint64), doc[keep], inside[keep]
    ends = len(data) - spec.gram + 1
    if ends <= 0:
        return (np.zeros(0, np.int64),) * 3
    middle = np.ones(ends, bool)  # blanks stand at the edges only, and not alone
    for i in range(1, spec.gram - 1):
        middle &= inside[i : ends + i]
    if spec.gram < 3:
        middle = inside[:ends] | inside[spec.gram - 1 :]
    h = np.full(ends, spec.gram, np.uint64)
    for i in range(spec.gram):
        h = mix(h * np.uint64(0x100000001B3) + data[i : ends + i])
    at = np.flatnonzero(middle)
    owner = doc[at + ~inside[at]]  # a blank before a text's first word belongs to the text before it
    key, n = np.unique(owner * spec.buckets + (h[at] % np.uint64(spec.buckets)).astype(np.int64), return_counts=True)
    return key // spec.buckets, key % spec.buckets, n


@dataclass
class Mixture:
    """``log_share``: languages x buckets, log likelihoods of an n-gram."""

    languages: list[str]
    log_share: np.ndarray
    spec: Grams

    def starts(self, doc: np.ndarray, docs: int) -> np.ndarray:
        return np.searchsorted(doc, np.arange(docs))

    def fit(self, doc: np.ndarray, bucket: np.ndarray, n: np.ndarray, share: np.ndarray, rounds: int, least: float) -> tuple[np.ndarray, np.ndarray]:
        """Proportions ``docs x languages`` from the start ``share``, and the log likelihoods of the texts.

        Every text has n-grams.  A language whose proportion is 0 keeps it.
        Rounds end when no proportion moves by more than ``least``; texts that
        have come to rest take no part in later ones.
        """
        share, value = share.copy(), np.zeros(len(share))
        top = self.log_share[:, bucket]
        high = top.max(axis=0)
        like = np.exp(top - high).T  # n-grams x languages
        live, d, c, rows = np.arange(len(share)), doc, n.astype(np.float64), like
        for last in [False] * rounds + [True]:
            first = np.searchsorted(d, live)
            total = np.add.reduceat(c, first)
            pi = np.repeat(share[live], np.diff(np.append(first, len(d))), axis=0)
            part = rows * pi
            whole = part.sum(axis=1)
            value[live] = np.add.reduceat(c * np.log(whole), first)
            if last:
                break
            new = np.add.reduceat(part * (c / whole)[:, None], first, axis=0) / total[:, None]
            moved = np.abs(new - share[live]).max(axis=1) > least
            share[live] = new
            if not moved.any():
                break
            if moved.mean() < 0.75:
                stay = np.repeat(moved, np.diff(np.append(first, len(d))))
                live, d, c, rows = live[moved], d[stay], c[stay], rows[stay]
        return share, value + np.add.reduceat(n * high, self.starts(doc, len(share)))

    def select(self, doc: np.ndarray, bucket: np.ndarray, n: np.ndarray, docs: int, penalty: float, rounds: int = 40, least: float = 1e-3) -> np.ndarray:
        """Proportions ``docs x languages``, 0 for languages outside the chosen set; texts without n-grams have none."""
        out = np.zeros((docs, len(self.languages)))
        some, doc = np.unique(doc, return_inverse=True)
        if not len(some) or not len(self.languages):
            return out
        cost = penalty * np.log1p(np.add.reduceat(n, self.starts(doc, len(some))))
        share = np.full((len(some), len(self.languages)), 1 / len(self.languages))
        best, chosen = np.full(len(some), -np.inf), share
        for kept in range(len(self.languages), 0, -1):
            share, value = self.fit(doc, bucket, n, share, rounds if kept > 1 else 0, least)
            value = value - kept * cost
            chosen = np.where((value > best)[:, None], share, chosen)
            best = np.maximum(value, best)
            if kept > 1:
                share = drop_smallest(share)
        out[some] = chosen
        return out

    def detect(self, texts: list[str | None], penalty: float) -> np.ndarray:
        return self.select(*gram_counts(texts, self.spec), len(texts), penalty)


def drop_smallest(share: np.ndarray) -> np.ndarray:
    """Each row without its smallest positive proportion (of equal ones the last); the others sum to 1."""
    order = np.where(share > 0, share, np.inf)[:, ::-1]
    share = share.copy()
    share[np.arange(len(share)), share.shape[1] - 1 - order.argmin(axis=1)] = 0
    total = share.sum(axis=1, keepdims=True)
    return share / np.where(total > 0, total, 1)


def learn(docs: DataFrame, folds: int, held_out: int, spec: Grams = Grams(), smooth: float = 0.5,
          id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Mixture:
    """Counts over all labelled texts outside the held-out fold; each task sends one row a language and bucket at most.

    The model has languages x ``buckets`` places, whatever the number of texts.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for b in batches:
            for lo, hi in slices(b.column(1), 1 << 20):
                lang = b.column(0).slice(lo, hi - lo).to_pylist()
                doc, bucket, n = gram_counts(b.column(1).slice(lo, hi - lo).to_pylist(), spec)
                names, code = np.unique(np.array(lang, object).astype(str), return_inverse=True)
                for i, name in enumerate(names.tolist()):
                    held = counts.setdefault(name, np.zeros(spec.buckets, np.int64))
                    mine = code[doc] == i
                    held += np.bincount(bucket[mine], weights=n[mine], minlength=spec.buckets).astype(np.int64)
        for name, held in counts.items():
            at = np.flatnonzero(held)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(held[at])], names=["lang", "bucket", "n"])

    lang = F.col(lang_col).cast("string").alias("lang")
    fold = remainder(F.col(id_col), folds)
    rows = docs.filter(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull() & (fold != held_out)).select(lang, F.col(text_col).alias("text"))
    table = rows.mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    names = sorted(set(table.column("lang").to_pylist()))
    counts = np.zeros((len(names), spec.buckets))
    if names:
        index = pc.index_in(table.column("lang"), pa.array(names)).to_numpy()
        counts[index, table.column("bucket").to_numpy()] = table.column("n").to_numpy()
    share = (counts + smooth) / (counts.sum(axis=1, keepdims=True) + smooth * spec.buckets)
    return Mixture(names, np.log(share), spec)


def identify(docs: DataFrame, model: Mixture, folds: int, held_out: int, penalty: float = 3.0,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, held_out, lang_pred, score, languages``: the main language, its proportion, and all of them with theirs."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            name, score, every = [], [], []
            for lo, hi in slices(b.column(2), 1 << 20):
                for share in model.detect(b.column(2).slice(lo, hi - lo).to_pylist(), penalty):
                    order = [int(i) for i in np.argsort(-share, kind="stable") if share[i] > 0]
                    name.append(model.languages[order[0]] if order else UNKNOWN)
                    score.append(min(1.0, float(share[order[0]])) if order else 0.0)
                    every.append([{"lang": model.languages[i], "share": float(share[i])} for i in order])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(name, pa.string()), pa.array(score, pa.float64()), pa.array(every, kinds)], names=names)

    kinds = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))
    names = [id_col, *(fresh([id_col], c) for c in ("held_out", "lang_pred", "score", "languages"))]
    kind = docs.schema[id_col].dataType.simpleString()
    held = F.coalesce(remainder(F.col(id_col), folds) == held_out, F.lit(False)).alias(names[1])
    return docs.select(id_col, held, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, {names[1]} boolean, {names[2]} string, {names[3]} double, {names[4]} array<struct<lang: string, share: double>>")
