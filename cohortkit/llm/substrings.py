"""Removal of byte strings that a document with a smaller id holds, by hash-compared suffix sorting.

A byte goes if it is covered by a string of ``length`` bytes that also starts in
a document with a smaller id.  Strings are judged on the input.

1. Every window of ``length`` bytes has an anchor, its smallest gram of ``gram``
   bytes; equal windows have equal anchors at the same place.  Anchors meet by
   gram: those seen in one document alone need nothing more (code 0).  If a
   smaller document has the same bytes all around the anchor, all windows there
   are repeated (code 1); 128-bit hashes of these bytes tell.  What is left
   (code 2) needs a closer look.
2. The strings around code-2 anchors meet by gram and are suffix-sorted: prefix
   polynomial hashes and binary search give common extensions, mergesort orders
   the suffixes, equal neighbours are verified byte by byte, and the smallest id
   of each class of equal windows decides.
3. Covered bytes are cut out of each text.

Anchors travel packed by batches: about 21 bytes each.  A gram with many
different surroundings in one batch sends one entry only, and its anchors there
get code 2.  Strings of a gram with very many surroundings in all are compared
by window instead of by gram (an aggregate on the window's hashes, so no task
gets them all).

Null ids count as larger than all others, and equal ids as not smaller.  Null
and empty texts have no bytes.  Texts below ``length`` bytes lose nothing.  An
empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, lean, lean_group, materialize, release, shuffle_partitions
from .suffixes import anchors, context_keys, equal_classes, gram_keys, sort_suffixes, surroundings

LAST = np.iinfo(np.int64).max
#: Bytes of a measured table up to which it is broadcast; larger ones are shuffled.
BROADCAST = 96 << 20
#: Bytes of a gram's hash that travel; equal hashes of different grams only send more strings to the sort.
WIDTH = 5
#: Bytes of text whose anchors one part takes at most on average: some 2.4 million, 210 MB of memory.
PART_BYTES = 32 << 20
#: Bytes of packed anchors that a task hands back at a time, so that neither side holds a large batch.
SENT = 2 << 20


@dataclass(frozen=True)
class Plan:
    """Sizes of the work.

    A batch of texts takes about ten times ``batch_bytes`` of memory, and the
    task of a part about 90 bytes for each of its anchors (one per 14 bytes of
    text, so 49 parts of 1 GB take 140 MB each).  Half the ``batch_bytes`` hold
    half as many surroundings, so ``crowd`` goes with them.
    """

    length: int = 50
    gram: int = 24
    parts: int = 8
    batch_bytes: int = 8 << 20
    #: groups of one part whose strings are sorted apart
    pieces: int = 16
    #: different surroundings of a gram in a batch, beyond which it sends one entry
    crowd: int = 512
    #: surroundings of a gram in all, beyond which its strings are compared by window
    hot: int = 1 << 16


def to_bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)


def sources(docs: DataFrame) -> DataFrame:
    """``doc_id`` (null: the last), ``row`` (a hash that tells rows of one id apart) and ``text``."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(int(LAST))).alias("doc_id"), F.xxhash64("text").alias("row"), "text")


def narrow(x: np.ndarray) -> np.ndarray:
    """The low ``WIDTH`` bytes of each 64-bit number."""
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :WIDTH]


def widen(raw: np.ndarray) -> np.ndarray:
    out = np.zeros((len(raw) // WIDTH, 8), np.uint8)
    out[:, :WIDTH] = raw.reshape(-1, WIDTH)
    return out.view("<u8").reshape(-1)


def changes(x: np.ndarray, order: np.ndarray) -> np.ndarray:
    """True where ``x``, in ``order``, differs from the element before, and at the first."""
    x = x[order]
    return np.concatenate([[True], x[1:] != x[:-1]])


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return ((keys >> np.uint64(40)) % np.uint64(parts)).astype(np.int64)


# --- step 1: anchors meet by gram


def ask(docs: DataFrame, plan: Plan) -> DataFrame:
    """``batch, part, docs, rows, counts, hot, grams, contexts``: one row for each batch of texts and part."""

    def pack(batch: int, ids: np.ndarray, rows: np.ndarray, g: np.ndarray, c: np.ndarray, d: np.ndarray) -> Iterator[pa.RecordBatch]:
        # crowded grams: more different surroundings than ``crowd`` in this batch
        order = np.lexsort((c[:, 1], c[:, 0], g))
        fresh_g = changes(g, order)
        fresh_c = fresh_g | changes(c[:, 0], order) | changes(c[:, 1], order)
        run = np.cumsum(fresh_g) - 1
        crowded = np.zeros(len(g), bool)
        crowded[order] = (np.bincount(run[fresh_c]) > plan.crowd)[run]
        del order, fresh_g, fresh_c, run
        part = part_of(g, plan.parts)
        by_part = np.argsort(part, kind="stable")
        edge = np.searchsorted(part[by_part], np.arange(plan.parts + 1))
        del part
        out: list[tuple] = []
        size = 0
        for p in range(plan.parts):
            at = by_part[edge[p] : edge[p + 1]]
            if len(at):
                who, counts = np.unique(d[at], return_counts=True)
                hot = crowded[at]
                kept = at[~hot]
                # one entry for a crowded gram: its gram, and the surroundings 0
                crowd = np.unique(g[at[hot]])
                out.append((batch, p, ids[who], rows[who], counts.astype("<u4").tobytes(), np.packbits(hot).tobytes(),
                            narrow(g[kept]).tobytes() + narrow(crowd).tobytes(), c[kept].astype("<u8").tobytes()))
                size += 24 * len(who) + 21 * len(at)
            if out and (size >= SENT or p == plan.parts - 1):
                types = [pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
                cols, out, size = [pa.array(x, t) for x, t in zip(zip(*out), types)], [], 0
                yield pa.RecordBatch.from_arrays(cols, names=["batch", "part", "docs", "rows", "counts", "hot", "grams", "contexts"])

    @lean
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rows, held = [], [], []
        size, number = 0, TaskContext.get().partitionId() << 24

        def packed() -> Iterator[pa.RecordBatch]:
            owner = np.repeat(np.arange(len(held)), [len(g) for g, _ in held])
            g, c = (np.concatenate([x[k] for x in held]) for k in range(2))
            who = np.array(ids, np.int64), np.array(rows, np.int64)
            for x in (ids, rows, held):
                x.clear()
            return pack(number, *who, g, c, owner)

        for b in batches:
            for i, r, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                if not t.is_valid:
                    continue
                data = to_bytes(t.as_py())
                if len(data) < plan.length:
                    continue
                place, _, _ = anchors(data, plan.length, plan.gram)
                ids.append(i)
                rows.append(r)
                held.append((gram_keys(data, place, plan.gram), context_keys(data, place, plan.gram, plan.length)))
                size += len(data)
                if size >= plan.batch_bytes:
                    yield from packed()
                    size, number = 0, number + 1
        if held:
            yield from packed()

    return docs.select("doc_id", "row", "text").mapInArrow(
        run, "batch long, part int, docs array<long>, rows array<long>, counts binary, hot binary, grams binary, contexts binary")


def answer(asked: DataFrame, plan: Plan) -> DataFrame:
    """``batch, part, docs, rows, entries, kinds``: the codes of a batch's documents that have any but 0 in a part.

    An entry is the part's number in three bytes, then two bits a code; its kind
    is 1 if it holds a code of 2 or 3, plus 2 if it holds a 1.
    """

    @lean_group
    def decide(pdf: pd.DataFrame) -> pd.DataFrame:
        grams, contexts, crowds, held = [], [], [], []
        for docs, rows, counts, hot, g, c in zip(*(pdf[n] for n in ("docs", "rows", "counts", "hot", "grams", "contexts"))):
            counts = np.frombuffer(counts, "<u4").astype(np.int64)
            hot = np.unpackbits(np.frombuffer(hot, np.uint8), count=int(counts.sum())).astype(bool)
            keys = widen(np.frombuffer(g, np.uint8))
            n = int((~hot).sum())
            grams.append(keys[:n])
            crowds.append(keys[n:])
            contexts.append(np.frombuffer(c, "<u8").reshape(-1, 2))
            held.append((np.asarray(docs, np.int64), np.asarray(rows, np.int64), counts, hot))
        doc = np.concatenate([np.repeat(d, n)[~h] for d, _, n, h in held])
        flat = _codes(np.concatenate(grams), np.concatenate(contexts), doc, np.concatenate(crowds), plan)
        part = np.int32(pdf["part"].iloc[0])
        head = int(part).to_bytes(3, "little")
        out: list[tuple] = []
        at = 0
        for batch, (docs, rows, counts, hot) in zip(pdf["batch"], held):
            mine = np.full(len(hot), 3, np.uint8)
            n = int((~hot).sum())
            mine[~hot] = flat[at : at + n]
            at += n
            four = -(-counts // 4)  # bytes of each document's codes
            wide = np.zeros(int(four.sum()) * 4, np.uint8)
            wide[np.repeat((np.cumsum(four) - four) * 4 - (np.cumsum(counts) - counts), counts) + np.arange(len(mine))] = mine
            raw = (wide.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1).astype(np.uint8).tobytes()
            start = np.cumsum(counts) - counts
            open_, inside = (np.add.reduceat(x.astype(np.int64), start) > 0 for x in (mine >= 2, mine == 1))
            keep = np.flatnonzero(open_ | inside)
            stop = np.cumsum(four)
            entries = [head + raw[a:b] for a, b in zip((stop - four)[keep].tolist(), stop[keep].tolist())]
            kinds = (open_[keep] + 2 * inside[keep]).astype(np.uint8).tobytes()
            out.append((batch, part, docs[keep], rows[keep], entries, kinds))
        return pd.DataFrame(out, columns=["batch", "part", "docs", "rows", "entries", "kinds"])

    return asked.groupBy("part").applyInPandas(
        decide, "batch long, part int, docs array<long>, rows array<long>, entries array<binary>, kinds binary")


def _codes(g: np.ndarray, c: np.ndarray, doc: np.ndarray, crowds: np.ndarray, plan: Plan) -> np.ndarray:
    """The code of each anchor from its gram, surroundings (two columns) and document."""
    order = np.lexsort((doc, c[:, 1], c[:, 0], g))
    code = np.zeros(len(g), np.uint8)
    if len(g):
        new_g = changes(g, order)
        new_c = new_g | changes(c[:, 0], order) | changes(c[:, 1], order)
        g, doc = g[order], doc[order]
        first_c, run_c = np.flatnonzero(new_c), np.cumsum(new_c) - 1
        first_g, run_g = np.flatnonzero(new_g), np.cumsum(new_g) - 1
        inside = doc[first_c][run_c] < doc
        around = np.bincount(run_g[first_c])
        shared = (around > 1) & (np.minimum.reduceat(doc, first_g) < np.maximum.reduceat(doc, first_g))
        hot = np.isin(g[first_g], crowds) | (shared & (around > plan.hot))
        code[order] = np.where(inside, 1, np.where(hot[run_g], 3, np.where(shared[run_g], 2, 0))).astype(np.uint8)
    return code


def merge(answers: DataFrame) -> DataFrame:
    """``doc_id, row, still, inside``: a document's entries with open anchors, and those with code 1, in part order."""

    @lean_group
    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        found: dict[tuple[int, int], tuple[list[bytes], list[bytes]]] = {}
        pdf = pdf.sort_values("part")
        for docs, rows, entries, kinds in zip(pdf["docs"], pdf["rows"], pdf["entries"], pdf["kinds"]):
            for d, r, e, k in zip(docs.tolist(), rows.tolist(), entries, kinds):
                mine = found.setdefault((d, r), ([], []))
                for bit, held in enumerate(mine):
                    if k >> bit & 1 and held[-1:] != [e]:  # repeated rows have the same entries
                        held.append(e)
        d, r = zip(*found) if found else ((), ())
        still, inside = ([b"".join(x[i]) or None for x in found.values()] for i in range(2))
        return pd.DataFrame({"doc_id": np.array(d, np.int64), "row": np.array(r, np.int64), "still": still, "inside": inside})

    merged = answers.groupBy("batch").applyInPandas(join, "doc_id long, row long, still binary, inside binary")
    return merged.dropDuplicates(["doc_id", "row"])


def small_side(answers: DataFrame) -> DataFrame:
    """A written table of codes, with a broadcast hint if its measured size allows one."""
    rows, size = answers.agg(F.count(F.lit(1)), F.sum(F.octet_length("codes"))).first()
    return F.broadcast(answers) if rows * 48 + (size or 0) <= BROADCAST else answers


def read_codes(codes: bytes | None, keys: np.ndarray, parts: int) -> np.ndarray:
    """The codes of a document's anchors, whose keys tell how many of them each part has."""
    out = np.zeros(len(keys), np.uint8)
    if codes:
        part = part_of(keys, parts)
        order = np.argsort(part, kind="stable")
        edge = np.searchsorted(part[order], np.arange(parts + 1)).tolist()
        at = 0
        while at < len(codes):
            p = int.from_bytes(codes[at : at + 3], "little")
            n = edge[p + 1] - edge[p]
            four = np.frombuffer(codes, np.uint8, -(-n // 4), at + 3)
            out[order[edge[p] : edge[p + 1]]] = ((four[:, None] >> np.array([0, 2, 4, 6], np.uint8)) & 3).reshape(-1)[:n]
            at += 3 + len(four)
    return out


# --- step 2: strings around open anchors


def open_strings(docs: DataFrame, plan: Plan) -> DataFrame:
    """``gram, doc_id, row, at, off, windows, hot, bytes`` of each anchor of code 2 or 3."""

    @lean
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for i, r, t, codes in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3)):
                raw = (t.as_py() or "").encode("utf-8", "surrogatepass")
                data = np.frombuffer(raw, np.uint8)
                place, first, count = anchors(data, plan.length, plan.gram)
                keys = gram_keys(data, place, plan.gram)
                code = read_codes(codes.as_py(), keys, plan.parts)
                for k in np.flatnonzero(code >= 2).tolist():
                    s, n = int(first[k]), int(count[k])
                    out.append((int(keys[k].astype(np.int64)), i, r, s, int(place[k]) - s, n, bool(code[k] == 3), raw[s : s + n - 1 + plan.length]))
            cols = list(zip(*out)) if out else [()] * 8
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, types)],
                                             names=["gram", "doc_id", "row", "at", "off", "windows", "hot", "bytes"])

    schema = "gram long, doc_id long, row long, at int, off int, windows int, hot boolean, bytes binary"
    return docs.select("doc_id", "row", "text", "codes").mapInArrow(run, schema)


def repeated_windows(strings: DataFrame, plan: Plan) -> DataFrame:
    """``doc_id, row, low, high``: runs of bytes covered by windows that a smaller id has too."""

    @lean_group
    def decide(pdf: pd.DataFrame) -> pd.DataFrame:
        size = pdf["bytes"].str.len().to_numpy(np.int64)
        data = np.frombuffer(b"".join(pdf["bytes"]), np.uint8)
        begin = np.cumsum(size) - size
        windows = pdf["windows"].to_numpy(np.int64)
        entry = np.repeat(np.arange(len(pdf)), windows)
        step = np.arange(len(entry)) - np.repeat(np.cumsum(windows) - windows, windows)
        starts = begin[entry] + step
        off = pdf["off"].to_numpy(np.int64)[entry] - step
        gram, doc = pdf["gram"].to_numpy(np.int64)[entry], pdf["doc_id"].to_numpy(np.int64)[entry]
        by = np.lexsort((off, gram))  # equal windows have their anchor at the same place
        entry, step, starts, doc = entry[by], step[by], starts[by], doc[by]
        change = np.concatenate([[True], (gram[by][1:] != gram[by][:-1]) | (off[by][1:] != off[by][:-1])])
        group = np.cumsum(change) - 1
        order = sort_suffixes(data, starts, group, plan.length)
        label = equal_classes(data, starts, order, group, plan.length)
        smallest = np.full(int(label[-1]) + 1 if len(label) else 0, LAST)
        np.minimum.at(smallest, label, doc[order])
        again = order[smallest[label] < doc[order]]
        return runs(pdf, entry[again], step[again])

    def runs(pdf: pd.DataFrame, entry: np.ndarray, step: np.ndarray) -> pd.DataFrame:
        by = np.lexsort((step, entry))
        entry, step = entry[by], step[by]
        cut = np.concatenate([[True], (entry[1:] != entry[:-1]) | (step[1:] != step[:-1] + 1)])[: len(entry)]
        first = np.flatnonzero(cut)
        last = np.append(first[1:], len(entry)) - 1 if len(first) else first
        e, at = entry[first], pdf["at"].to_numpy(np.int64)
        return pd.DataFrame({"doc_id": pdf["doc_id"].to_numpy()[e], "row": pdf["row"].to_numpy()[e],
                             "low": (at[e] + step[first]).astype(np.int32), "high": (at[e] + step[last] + plan.length).astype(np.int32)})

    piece = F.pmod(F.xxhash64("gram"), F.lit(plan.parts * plan.pieces)).alias("piece")
    return strings.filter(~F.col("hot")).groupBy(piece).applyInPandas(decide, "doc_id long, row long, low int, high int")


def repeated_hot_windows(strings: DataFrame, plan: Plan) -> DataFrame:
    """The same for strings of hot grams: their windows are told apart by two hashes and the gram, and aggregated.

    Strings of the same grams that other batches sent as ordinary ones have the
    same code, because the code is the gram's.
    """
    window = F.expr(f"transform(sequence(0, windows - 1), i -> named_struct('i', i, 'w', substring(bytes, i + 1, {plan.length})))")
    each = strings.filter("hot").select("doc_id", "row", "at", F.explode(window).alias("x"))
    each = each.select("doc_id", "row", (F.col("at") + F.col("x.i")).alias("low"), F.sha2("x.w", 256).alias("w"))
    lowest = each.groupBy("w").agg(F.min("doc_id").alias("least"))
    again = each.join(lowest, "w").filter("least < doc_id")
    return again.select("doc_id", "row", F.col("low").cast("int").alias("low"), (F.col("low") + plan.length).cast("int").alias("high"))


# --- step 3: cutting


def covered(data: np.ndarray, codes: bytes | None, spans: list | None, plan: Plan) -> np.ndarray:
    """A mask of the bytes that go."""
    change = np.zeros(len(data) + 1, np.int64)
    if codes is not None:
        place, _, _ = anchors(data, plan.length, plan.gram)
        inside = place[read_codes(codes, gram_keys(data, place, plan.gram), plan.parts) == 1]
        low, high = surroundings(len(data), inside, plan.gram, plan.length)
        np.add.at(change, low, 1)
        np.add.at(change, high, -1)
    for low, high in spans or ():
        change[low] += 1
        change[high] -= 1
    return np.cumsum(change[:-1]) > 0


def find_repeats(rows: DataFrame, plan: Plan) -> DataFrame:
    """``doc_id, row, codes, spans`` of the rows of ``sources`` that lose bytes."""
    codes = materialize(merge(answer(ask(rows, plan), plan)), "repeat-codes")
    still = codes.filter("still IS NOT NULL").select("doc_id", "row", F.col("still").alias("codes"))
    strings = materialize(open_strings(rows.join(small_side(still), ["doc_id", "row"]), plan), "repeat-strings")
    found = repeated_windows(strings, plan).unionByName(repeated_hot_windows(strings, plan))
    spans = found.groupBy("doc_id", "row").agg(F.collect_set(F.struct("low", "high")).alias("spans"))
    inside = codes.filter("inside IS NOT NULL").select("doc_id", "row", F.col("inside").alias("codes"))
    out = materialize(inside.join(spans, ["doc_id", "row"], "full"), "repeat-spans")
    release(codes, strings)
    return out


def default_plan(docs: DataFrame, length: int = 50) -> Plan:
    """One part for each ``PART_BYTES`` of text, at least one for each shuffle partition; anchors of about half the length.

    Batches grow with the parts, so that a batch has at least some 150 anchors
    for each part.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(2, shuffle_partitions(docs.sparkSession), -(-size // PART_BYTES))
    return Plan(length=length, gram=max(1, length // 2 - 1), parts=parts, batch_bytes=max(Plan.batch_bytes, 2048 * parts))


def kept_bytes(text: str | None, codes: bytes | None, spans: list | None, plan: Plan) -> tuple[bytes, int, int, int]:
    """What is left of a text, its bytes, and the number of bytes and runs that go."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    if codes is None and spans is None:
        return raw, len(raw), 0, 0
    data = np.frombuffer(raw, np.uint8)
    gone = covered(data, codes, [(s["low"], s["high"]) for s in spans or ()], plan)
    runs = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(gone) else 0
    return data[~gone].tobytes(), len(raw), int(gone.sum()), runs


def digests(docs: DataFrame, plan: Plan | None = None) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row."""
    plan = plan or default_plan(docs)

    @lean
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for t, codes, spans in zip(b.column(1), b.column(2).to_pylist(), b.column(3).to_pylist()):
                kept, n, gone, runs = kept_bytes(t.as_py(), codes, spans, plan)
                out.append((n, gone, runs, hashlib.sha256(kept).hexdigest()))
            n, gone, runs, sha = zip(*out) if out else ((),) * 4
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x, pa.int64()) for x in (n, gone, runs)), pa.array(sha, pa.string())],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    rows = sources(docs)
    joined = rows.join(small_side(find_repeats(rows, plan)), ["doc_id", "row"], "left").select("doc_id", "text", "codes", "spans")
    out = joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return out.withColumn("doc_id", F.when(F.col("doc_id") != F.lit(int(LAST)), F.col("doc_id")))


def cut_texts(docs: DataFrame, plan: Plan | None = None) -> DataFrame:
    """``docs`` with ``text`` cut; half characters at a cut go too, and null stays null."""
    plan = plan or default_plan(docs)
    names = docs.columns
    i, r, codes, spans = (fresh(names, n) for n in ("repeat_id", "repeat_row", "repeat_codes", "repeat_spans"))
    found = find_repeats(sources(docs), plan)
    keys = small_side(found).select(F.col("doc_id").alias(i), F.col("row").alias(r), F.col("codes").alias(codes), F.col("spans").alias(spans))
    joined = docs.join(keys, (F.coalesce(F.col("doc_id").cast("long"), F.lit(int(LAST))) == F.col(i)) & (F.xxhash64("text") == F.col(r)), "left")

    @lean
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [None if not t.is_valid else kept_bytes(t.as_py(), c, s, plan)[0].decode("utf-8", "ignore")
                     for t, c, s in zip(b.column(names.index("text")), b.column(len(names)).to_pylist(), b.column(len(names) + 1).to_pylist())]
            cols = [pa.array(texts, pa.string()) if n == "text" else b.column(k) for k, n in enumerate(names)]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return joined.select(*(F.col(f"`{n}`") for n in names), codes, spans).mapInArrow(run, docs.schema)
