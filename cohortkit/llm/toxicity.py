"""Toxicity by a weighted finite-state grammar over clauses.

A clause's words have classes: insult, threat, target, negation and reported
speech.  Memories of negation, report and target run in step as one composed
machine, and one of targets backwards; they weigh a match by its context: an
insult counts more beside a target, less when negated, less in reported speech.
A threat has a fixed weight, counts only if its clause has a target, less when
negated, and as much in reported speech.  There is no insult or threat machine:
these are classes of single words, and a lone insult has its full weight.  The sum
over matched clauses, capped by no list of isolated words, becomes a score by a
logistic curve.

Insult words and stems with their weights are learned: words and word
beginnings that toxic training texts hold significantly more often than clean
ones.  Function words of four languages are fixed.

Null and empty texts match nothing and get the lowest score.  Rows are scored
one by one, so repeated rows and null ids are no special case.  Without toxic
training rows only the fixed words count.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh
from .labelled import remainder, training_sample

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)

#: Function words in English, German, French and Spanish.
WORDS = {
    THREAT: "kill hurt destroy beat burn shoot hang stab töten umbringen verletzen tuer tuez frapper matar golpear destruir",
    TARGET: "you your yourself u they them he she him her du dich dir ihr euch sie er tu toi te vous ils elles lui usted ustedes ellos ellas él",
    NEGATION: "not never no isn't aren't don't nicht kein keine nie niemals ne pas jamais non nunca jamás tampoco",
    REPORT: "said says say wrote called claimed reported quoted quote according sagte schrieb nannte laut dit écrit selon dijo escribió según llamó",
}
FIXED = {w: c for c, ws in WORDS.items() for w in ws.split()}
CLAUSE = re.compile(r"[.!?;:\n]")
TOKEN = re.compile(r"[\w']+")


class Transducer:
    """A finite-state machine over word classes: ``step[state, class]`` and a weight for each arc."""

    def __init__(self, step: np.ndarray, weight: np.ndarray):
        self.step, self.weight = step, weight

    @classmethod
    def memory(cls, trigger: int, span: int, act_on: int, before: float) -> Transducer:
        """Multiplies the weight of ``act_on`` by ``before`` within ``span`` words after ``trigger``."""
        step = np.zeros((span + 1, 6), np.int64)
        weight = np.ones((span + 1, 6))
        for s in range(span + 1):
            step[s] = max(s - 1, 0)
            step[s, trigger] = span
            if s:
                weight[s, act_on] = before
        return cls(step, weight)

    def compose(self, other: Transducer) -> Transducer:
        """Both machines in step; weights multiply."""
        n, m = len(self.step), len(other.step)
        step = self.step[:, None, :] * m + other.step[None, :, :]
        weight = self.weight[:, None, :] * other.weight[None, :, :]
        return Transducer(step.reshape(n * m, 6), weight.reshape(n * m, 6))

    def weights(self, classes: list[int]) -> list[float]:
        state, out = 0, []
        for c in classes:
            out.append(self.weight[state, c])
            state = self.step[state, c]
        return out


def grammar(target: float = 1.5, negated: float = 0.5, reported: float = 0.5) -> tuple[Transducer, Transducer]:
    """The machines read forwards (negation, report, target before) and backwards (target after)."""
    long = 12
    forward = Transducer.memory(NEGATION, 2, INSULT, negated).compose(Transducer.memory(NEGATION, 2, THREAT, negated))
    forward = forward.compose(Transducer.memory(REPORT, long, INSULT, reported)).compose(Transducer.memory(TARGET, 4, INSULT, target))
    return forward, Transducer.memory(TARGET, 4, INSULT, target)


@dataclass
class Lexicon:
    """Learned insult words and stems with weights, the curve, and the machines."""

    words: dict[str, float]
    stems: dict[str, float]
    slope: float = 1.0
    offset: float = -2.0

    def __post_init__(self):
        self.forward, self.backward = grammar()
        self.forward_table, self.backward_table = (
            (m.step.tolist(), m.weight.tolist()) for m in (self.forward, self.backward))
        self.longest = max(map(len, self.stems), default=0)
        self.find = ahocorasick.Automaton()
        for w in {*self.words, *self.stems, *WORDS[THREAT].split()}:
            self.find.add_word(w, len(w))
        if len(self.find):
            self.find.make_automaton()

    def __getstate__(self):
        return (self.words, self.stems, self.slope, self.offset)

    def __setstate__(self, state):
        self.words, self.stems, self.slope, self.offset = state
        self.__post_init__()

    def word_class(self, word: str) -> tuple[int, float]:
        if word in self.words:
            return INSULT, self.words[word]
        for n in range(min(self.longest, len(word)), 0, -1):
            if word[:n] in self.stems:
                return INSULT, self.stems[word[:n]]
        return FIXED.get(word, OTHER), 2.0

    def clause_score(self, clause: str) -> float:
        """The weight of a clause, read once forwards and once backwards."""
        classes, own = [], []
        for m in TOKEN.finditer(clause):
            c, w = self.word_class(m[0])
            classes.append(c)
            own.append(w)
        total = 0.0
        aimed = TARGET in classes
        context = [1.0] * len(classes)
        for (step, weight), order in ((self.forward_table, range(len(classes))), (self.backward_table, range(len(classes) - 1, -1, -1))):
            state = 0
            for i in order:
                context[i] *= weight[state][classes[i]]
                state = step[state][classes[i]]
        for c, w, x in zip(classes, own, context):
            if c == INSULT or c == THREAT and aimed:
                total += w * x
        return total

    def text_score(self, text: str) -> float:
        """The sum over the clauses in which a word of the grammar's core stands."""
        if not len(self.find):
            return 0.0
        low = text.lower()
        total, done = 0.0, -1
        for end, size in self.find.iter(low):
            start = end - size + 1
            if end <= done or start and (low[start - 1].isalnum() or low[start - 1] == "_"):
                continue
            a = max((low.rfind(x, 0, start) for x in ".!?;:\n"), default=-1) + 1
            m = CLAUSE.search(low, start)
            done = m.start() if m else len(low)
            total += self.clause_score(low[a:done])
        return total

    def score(self, text: str | None) -> float:
        x = self.slope * math.log1p(self.text_score(text or "")) + self.offset
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def feature_counts(sample: DataFrame, shortest: int, longest: int) -> DataFrame:
    """``feature, toxic, clean``: contexts of a word (``word=``) or a word's beginning (``stem-``).

    A context is a word with its two neighbours and counts once however many
    texts hold it, so copies of one text are no evidence.
    """
    tokens = F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}_']+"), 0)
    spots = sample.select("y", tokens.alias("w")).select("y", F.expr(
        "explode(transform(w, (x, i) -> named_struct('word', x, 'near', xxhash64(get(w, i - 1), get(w, i + 1)))))").alias("s"))
    spots = spots.select("y", "s.word", "s.near").groupBy("word", "near").agg(F.max("y").alias("y"))
    words = spots.groupBy("word").agg(F.sum("y").alias("toxic"), F.sum(1 - F.col("y")).alias("clean"))
    stems = F.expr(f"transform(filter(sequence({shortest}, {longest}), n -> n < length(word)), n -> concat(substring(word, 1, n), '-'))")
    rows = words.select("toxic", "clean", F.explode(F.concat(F.array(F.concat("word", F.lit("="))), stems)).alias("feature"))
    return rows.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def learn(docs: DataFrame, labels: DataFrame, folds: int, held_out: int, label: str = "toxic", rows_per_class: int = 3000,
          shortest: int = 4, longest: int = 8, purity: float = 0.9, margin: float = 5.0) -> Lexicon:
    """Learn the lexicon and the curve from at most ``rows_per_class`` training texts of each label.

    A feature is kept if at least ``purity`` of its contexts are toxic, and if its
    likelihood ratio is such that fewer than exp(-``margin``) chance features are
    expected among all that were tried.  Of a word and its beginnings the most telling is kept.
    """
    sample = training_sample(docs, labels, label, folds, held_out, rows_per_class).persist()
    counts = None
    try:
        if {r.y for r in sample.select("y").distinct().collect()} != {0, 1}:
            return Lexicon({}, {})
        counts = feature_counts(sample, shortest, longest).persist()
        whole = counts.filter("endswith(feature, '=')").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c")).first()
        base, tried = whole.t / max(whole.t + whole.c, 1), counts.count()
        t, c = F.col("toxic").cast("double"), F.col("clean").cast("double")
        part = lambda o, e: F.when(o > 0, o * F.log(o / e)).otherwise(F.lit(0.0))
        ratio = part(t, (t + c) * base) + part(c, (t + c) * (1 - base))
        pure = counts.withColumn("ratio", ratio).filter((t >= purity * (t + c)) & (F.col("ratio") > math.log(max(tried, 2)) + margin))
        words: dict[str, float] = {}
        stems: dict[str, float] = {}
        begun: set[str] = set()  # beginnings of what is kept
        for r in sorted(pure.collect(), key=lambda r: (-r.ratio, -len(r.feature), r.feature)):
            name, kind = r.feature[:-1], r.feature[-1]
            if not (any(name[:n] in stems for n in range(shortest, len(name) + 1)) or kind == "-" and name in begun):
                weight = math.log((r.toxic + 0.5) / (r.clean + 0.5)) - math.log(base / (1 - base))
                (stems if kind == "-" else words)[name] = weight
                begun.update(name[:n] for n in range(shortest, len(name) + 1))
        lexicon = Lexicon(words, stems)
        scored = sample.select("y", "text").mapInArrow(_measure(lexicon), "y int, s double").collect()
        lexicon.slope, lexicon.offset = _logistic(np.log1p([r.s for r in scored]), np.array([r.y for r in scored], float))
        return lexicon
    finally:
        sample.unpersist()
        if counts is not None:
            counts.unpersist()


def _measure(lexicon: Lexicon):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = [lexicon.text_score(t or "") for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int32()), pa.array(s, pa.float64())], names=["y", "s"])

    return run


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.5) -> tuple[float, float]:
    """Slope and offset by Newton steps on the log loss; both classes weigh the same."""
    w = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    a = np.stack([x, np.ones_like(x)], axis=1)
    beta = np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        grad = a.T @ (w * (p - y)) + ridge * beta
        beta = beta - np.linalg.solve((a * (w * p * (1 - p))[:, None]).T @ a + ridge * np.eye(2), grad)
    return float(max(beta[0], 0.1)), float(beta[1])


def score_texts(docs: DataFrame, lexicon: Lexicon, folds: int, held_out: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, held_out, score, predicted`` of every row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = np.array([lexicon.score(t) for t in b.column(2).to_pylist()], np.float64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                                             names=[id_col, held, "score", "predicted"])

    held = fresh([id_col], "held_out")
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(id_col, F.coalesce(remainder(F.col(id_col), folds) == held_out, F.lit(False)).alias(held), F.col(text_col))
    return rows.mapInArrow(run, f"`{id_col}` {kind}, {held} boolean, score double, predicted int")
