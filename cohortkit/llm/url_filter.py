"""URL rules in a sorted array of 64-bit digests.

Rules are strings ``host/path``.  Their xxhash64 digests are sorted into one
array, which is sent to the executors as a file and memory-mapped there; the
rule strings lie in a second file, in digest order.  A url offers one key for
each of its parent hosts and each path length that a rule has.  All keys of a
batch are probed by one vectorised binary search, and a hit counts only if the
stored string equals the key.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered.
Path: from there up to ``?``, ``#`` or the end.  A null url, or one without
``://``, has an empty host and path and fits no rule.  The longest rule wins,
then the one with the longer host.  What fits no rule gets ``default``.
"""

from __future__ import annotations

import os
import string
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


class DigestArray:
    """Sorted digests with their full strings; equal digests lie side by side."""

    def __init__(self, digests: np.ndarray, ends: np.ndarray, strings: np.ndarray, verdicts: np.ndarray):
        self.digests, self.ends, self.strings, self.verdicts = digests, ends, strings, verdicts

    @staticmethod
    def save(rules: dict[str, str], folder: str, stem: str) -> list[str]:
        """Write ``rules`` (string to allow or block) as four arrays; return the file names."""
        keys = [k.encode() for k in rules]
        digest = np.array([xxhash.xxh64_intdigest(k) for k in keys], np.uint64)
        order = np.argsort(digest, kind="stable")
        keys = [keys[i] for i in order]
        arrays = {
            "digests": digest[order], "ends": np.cumsum([len(k) for k in keys], dtype=np.int64),
            "strings": np.frombuffer(b"".join(keys), np.uint8),
            "verdicts": np.array([list(rules.values())[i] == "allow" for i in order], np.uint8),
        }
        for name, a in arrays.items():
            np.save(os.path.join(folder, f"{stem}-{name}.npy"), a)
        return [f"{stem}-{name}.npy" for name in arrays]

    @classmethod
    def open(cls, stem: str, where=SparkFiles.get) -> DigestArray:
        return cls(*(np.load(where(f"{stem}-{name}.npy"), mmap_mode="r") for name in ("digests", "ends", "strings", "verdicts")))

    def string(self, i: int) -> bytes:
        return self.strings[self.ends[i - 1] if i else 0 : self.ends[i]].tobytes()

    def find(self, keys: list[bytes], digests: np.ndarray | None = None) -> np.ndarray:
        """The index of each key, or -1."""
        if digests is None:
            digests = np.array([xxhash.xxh64_intdigest(k) for k in keys], np.uint64)
        at = np.searchsorted(self.digests, digests)
        out = np.full(len(keys), -1, np.int64)
        near = np.flatnonzero(at < len(self.digests))
        for i in near[self.digests[at[near]] == digests[near]]:
            j = int(at[i])
            while j < len(self.digests) and self.digests[j] == digests[i]:
                if self.string(j) == keys[i]:
                    out[i] = j
                    break
                j += 1
        return out


def split_url(urls: pa.Array) -> tuple[list[str], list[str]]:
    """Host and path of each url."""
    found = pc.extract_regex(urls, r"(?s)^(?:.*?)://(?P<host>[^/?#]*)(?P<path>[^?#]*)")
    host = pc.fill_null(pc.struct_field(found, "host"), "").to_pylist()
    path = pc.fill_null(pc.struct_field(found, "path"), "").to_pylist()
    return [h.translate(LOWER) for h in host], path


def judge(hosts: list[str], paths: list[str], rules: DigestArray, lengths: list[int], default: str) -> pd.DataFrame:
    """Rule and verdict of each url."""
    seen: dict[tuple[str, str], list[tuple[int, int, bytes]]] = {}
    keys: dict[bytes, int] = {}
    for pair in set(zip(hosts, paths)):
        host, path = pair
        offers = []
        at = 0
        while host and at >= 0:
            parent = host[at:]
            for n in lengths:
                if n <= len(path):
                    key = (parent + path[:n]).encode()
                    keys.setdefault(key, len(keys))
                    offers.append((len(parent) + n, len(parent), key))
            at = host.find(".", at) + 1 or -1
        offers.sort(reverse=True)
        seen[pair] = offers
    index = rules.find(list(keys))
    best: dict[tuple[str, str], tuple[str | None, str]] = {}
    for pair, offers in seen.items():
        hit = next((k for *_, k in offers if index[keys[k]] >= 0), None)
        best[pair] = (None, default) if hit is None else (hit.decode(), "allow" if rules.verdicts[index[keys[hit]]] else "block")
    found = [best[p] for p in zip(hosts, paths)]
    return pd.DataFrame({"host": hosts, "path": paths, "rule": [r for r, _ in found], "verdict": [v for _, v in found]})


def judge_urls(pages: DataFrame, rules: dict[str, str], default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``id, host, path, rule, verdict`` of each row; only the two columns are read."""
    spark: SparkSession = pages.sparkSession
    stem = f"url-rules-{uuid.uuid4().hex}"
    folder = tempfile.mkdtemp(prefix="cohortkit-rules-")  # of the driver; Spark hands the files to every executor
    for name in DigestArray.save(rules, folder, stem):
        spark.sparkContext.addFile(os.path.join(folder, name))
    lengths = sorted({len(r) - r.index("/") for r in rules})

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        array = DigestArray.open(stem)
        for batch in batches:
            found = judge(*split_url(batch.column(1)), array, lengths, default)
            text = [pa.array(found[c].tolist(), pa.string()) for c in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), *text], names=[id_col, "host", "path", "rule", "verdict"])

    kind = pages.schema[id_col].dataType.simpleString()
    return pages.select(id_col, F.col(url_col)).mapInArrow(run, f"`{id_col}` {kind}, host string, path string, rule string, verdict string")
