"""Document quality by gated-attention multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words.  Every passage is encoded
from its letters, marks and repetitions, gated attention weights the passages,
and the weighted passage representation is scored.  Weights are learned from
document labels alone, on a bounded sample.

Null and empty texts are one passage without words.  Rows are scored one by one,
so repeated rows and null ids are no special case.  Without labelled rows of
both kinds every document scores 0.5, so none is rejected.
"""

from __future__ import annotations

import operator
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, lean
from .labelled import remainder, training_sample
from .tokens import forget_encoders

PASSAGE = 48

# classes of bytes: 0 other, then one per group
GROUPS = [range(97, 123), range(65, 91), range(48, 58), b".,;'-", b"!?", b"|", b"#$%&*@^~=<>+\\/_{}[]()\"`:", b"\n\r", range(128, 256)]
CLASS = np.zeros(256, np.uint8)
for _k, _g in enumerate(GROUPS, 1):
    CLASS[list(_g)] = _k
BLANK = np.zeros(256, bool)
BLANK[list(b" \t\n\r\x0b\x0c")] = True
FEATURES = len(GROUPS) + 8


def passage_features(text: str | None) -> np.ndarray:
    """``passages x FEATURES`` of a whole text."""
    raw = (text or "").encode("utf-8", "replace")
    words = raw.split()
    if not words:
        out = np.zeros((1, FEATURES))
        out[0, -1] = 1.0
        return out
    data = np.frombuffer(raw, np.uint8)
    blank = BLANK[data]
    starts = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
    edges = starts[::PASSAGE].copy()
    edges[0] = 0
    size = np.diff(np.append(edges, len(data))).astype(np.float64)
    passage = np.repeat(np.arange(len(edges)), np.diff(np.append(edges, len(data))))
    share = np.bincount(passage * (len(GROUPS) + 1) + CLASS[data], minlength=len(edges) * (len(GROUPS) + 1)).reshape(len(edges), -1)[:, 1:] / size[:, None]
    out = np.zeros((len(edges), FEATURES))
    out[:, : len(GROUPS)] = np.sqrt(share)
    same = np.fromiter(map(operator.eq, words, words[1:] + [b""]), bool, len(words))
    at = np.arange(0, len(words), PASSAGE)
    count = np.diff(np.append(at, len(words))).astype(np.float64)
    base = len(GROUPS)
    out[:, base] = np.add.reduceat(same.astype(np.float64), at) / count
    distinct = np.array([len(set(words[i : i + PASSAGE])) for i in at.tolist()])
    out[:, base + 1] = distinct / count
    upper = (CLASS[data[starts]] == 2).astype(np.float64)
    out[:, base + 2] = np.add.reduceat(upper, at) / count
    out[:, base + 3] = np.log1p(size / count) / 3
    ends = np.append(starts[1:], len(data) + 1) - 2
    out[:, base + 4] = np.add.reduceat((CLASS[data[np.minimum(ends, len(data) - 1)]] >= 5).astype(np.float64), at) / count
    out[:, base + 5] = len(set(words)) / len(words)
    out[:, base + 6] = np.log1p(len(words)) / 10
    return out


@dataclass
class AttentionMIL:
    """tanh encoder, gated attention over passages, logistic head; all parameters in one dictionary."""

    p: dict[str, np.ndarray]
    mean: np.ndarray
    scale: np.ndarray

    @classmethod
    def fresh(cls, x: np.ndarray, hidden: int, gate: int, seed: int) -> AttentionMIL:
        rng = np.random.default_rng(seed)
        d = x.shape[1]
        shape = {"W": (d, hidden), "b": (hidden,), "V": (hidden, gate), "U": (hidden, gate), "w": (gate,), "c": (hidden,), "o": ()}
        p = {k: rng.normal(size=s) / np.sqrt(s[0] if s else 1) if k not in "bo" else np.zeros(s) for k, s in shape.items()}
        return cls(p, x.mean(axis=0), x.std(axis=0) + 1e-3)

    def forward(self, x: np.ndarray, at: np.ndarray, bag: np.ndarray) -> dict[str, np.ndarray]:
        """``at``: first passage of each bag; ``bag``: the bag of each passage."""
        p, f = self.p, {}
        f["x"] = np.clip((x - self.mean) / self.scale, -6, 6)
        f["h"] = np.tanh(f["x"] @ p["W"] + p["b"])
        f["t"] = np.tanh(f["h"] @ p["V"])
        f["g"] = 1 / (1 + np.exp(-f["h"] @ p["U"]))
        s = (f["t"] * f["g"]) @ p["w"]
        e = np.exp(s - np.maximum.reduceat(s, at)[bag])
        f["a"] = e / np.add.reduceat(e, at)[bag]
        f["z"] = np.add.reduceat(f["a"][:, None] * f["h"], at, axis=0)
        f["y"] = 1 / (1 + np.exp(-np.clip(f["z"] @ p["c"] + p["o"], -30, 30)))
        return f

    def gradients(self, f: dict, at: np.ndarray, bag: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        dy = weight * (f["y"] - y)
        dz = dy[:, None] * p["c"]
        da = (dz[bag] * f["h"]).sum(axis=1)
        ds = f["a"] * (da - np.add.reduceat(f["a"] * da, at)[bag])
        dt, dg = ds[:, None] * p["w"] * f["g"] * (1 - f["t"] ** 2), ds[:, None] * p["w"] * f["t"] * f["g"] * (1 - f["g"])
        dh = f["a"][:, None] * dz[bag] + dt @ p["V"].T + dg @ p["U"].T
        dx = dh * (1 - f["h"] ** 2)
        return {"W": f["x"].T @ dx, "b": dx.sum(0), "V": f["h"].T @ dt, "U": f["h"].T @ dg, "w": (f["t"] * f["g"]).T @ ds,
                "c": f["z"].T @ dy, "o": dy.sum()}

    def fit(self, x: np.ndarray, at: np.ndarray, bag: np.ndarray, y: np.ndarray, steps: int, rate: float, decay: float) -> None:
        weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())) / len(y)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.p.items()}
        for t in range(1, steps + 1):
            g = self.gradients(self.forward(x, at, bag), at, bag, y, weight)
            for k in self.p:
                grad = g[k] + decay * self.p[k]
                m[k] = 0.9 * m[k] + 0.1 * grad
                v2[k] = 0.999 * v2[k] + 0.001 * grad**2
                self.p[k] = self.p[k] - rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v2[k] / (1 - 0.999**t)) + 1e-8)

    def scores(self, bags: list[np.ndarray]) -> np.ndarray:
        if not bags:
            return np.zeros(0)
        n = np.array([len(b) for b in bags])
        at = np.concatenate([[0], np.cumsum(n)[:-1]])
        return self.forward(np.concatenate(bags), at, np.repeat(np.arange(len(n)), n))["y"]


def learn(docs: DataFrame, labels: DataFrame, folds: int, held_out: int, label: str = "quality", rows_per_class: int = 1500,
          hidden: int = 16, gate: int = 8, steps: int = 250, seed: int = 5) -> AttentionMIL | None:
    """Fit on at most ``rows_per_class`` training documents of each label (None without both labels).

    The passages of the sample are encoded by Spark tasks; the driver gets their
    features only.
    """

    @lean
    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = [passage_features(t).astype("<f4").tobytes() for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int32()), b.column(2), pa.array(raw, pa.binary())], names=["y", "doc_id", "x"])

    sample = training_sample(docs, labels, label, folds, held_out, rows_per_class)
    rows = sample.select("y", "text", F.col("doc_id").cast("long")).mapInArrow(encode, "y int, doc_id long, x binary").collect()
    rows.sort(key=lambda r: (r.doc_id, r.x))
    if len({r.y for r in rows}) < 2:
        return None
    bags = [np.frombuffer(r.x, "<f4").reshape(-1, FEATURES).astype(np.float64) for r in rows]
    n = np.array([len(b) for b in bags])
    x = np.concatenate(bags)
    model = AttentionMIL.fresh(x, hidden, gate, seed)
    at = np.concatenate([[0], np.cumsum(n)[:-1]])
    model.fit(x, at, np.repeat(np.arange(len(n)), n), np.array([r.y for r in rows], float), steps, rate=0.02, decay=1e-4)
    return model


def score_texts(docs: DataFrame, model: AttentionMIL | None, folds: int, held_out: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, held_out, score, predicted`` of every row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [np.zeros(0)]
            for a in range(0, b.num_rows, 200):
                texts = b.column(2).slice(a, 200).to_pylist()
                out.append(np.full(len(texts), 0.5) if model is None else model.scores([passage_features(t) for t in texts]))
            s = np.concatenate(out)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                                             names=[id_col, held, "score", "predicted"])

    held = fresh([id_col], "held_out")
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(id_col, F.coalesce(remainder(F.col(id_col), folds) == held_out, F.lit(False)).alias(held), F.col(text_col))
    return rows.mapInArrow(run, f"`{id_col}` {kind}, {held} boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: AttentionMIL | None, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score at least 0.5, with all their columns."""
    at = docs.columns.index(text_col)

    @lean
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_encoders()
        for b in batches:
            for a in range(0, b.num_rows, 200):
                part = b.slice(a, 200)
                keep = model.scores([passage_features(t) for t in part.column(at).to_pylist()]) >= 0.5
                yield part.filter(pa.array(keep))

    return docs if model is None else docs.mapInArrow(run, docs.schema)
