"""Token ids of whole texts, by the ``tokenizers`` library, with a word memo.

The byte-level pre-tokenizer always starts a new piece at a space that is
followed by a non-space character, so a text may be cut there and its parts
encoded one by one.  Each distinct part is encoded once per task by the library
and its ids are remembered; the ids of a text are the joined ids of its parts.
For a plain byte-level BPE a part goes straight to the library's BPE model,
which spares the cost of a whole ``encode`` call per part.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: Fixed value: the split pattern of byte-level BPE.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: A space that white space or the end follows: no cut there.
RUNS = re.compile(r" (?:[\s\x1c-\x1f]|\Z)")
ODD = r" (?:[\s\x0b\x1c-\x1f\x{85}\p{Z}]|\z)"  # the same for Arrow, whose \s is ASCII only


def byte_letters() -> dict[int, str]:
    """The printable letter by which byte-level BPE writes each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


class Memo(dict):
    """Ids of the parts seen so far; an unseen part is encoded when it is first asked for."""

    def __init__(self, encode, older: dict):
        super().__init__()
        self.encode, self.older = encode, older

    def __missing__(self, part: str) -> bytes:
        ids = self.older.get(part)
        if ids is None:
            ids = self.encode(part)
        self[part] = ids
        return ids


class WordEncoder:
    """Encodes texts to little-endian ids (``uint16`` while the vocabulary fits).

    ``memo_words`` bounds the memo: when it is full it becomes the older of two
    generations and a new one begins.  That costs time but changes no result.
    """

    def __init__(self, tokenizer_path: str, memo_words: int = 500_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        spec = json.loads(self.tokenizer.to_str())
        pre = spec.get("pre_tokenizer") or {}
        plain = (
            spec["model"]["type"] == "BPE" and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space")
            and pre.get("use_regex", True) and not spec.get("normalizer") and not spec["model"].get("dropout")
        )
        self.letters = byte_letters()
        self.space = self.letters[32]
        self.tokenize = self.tokenizer.model.tokenize if plain else None
        self.marks = {m: self._model_ids(m) for m in ".,;:!?|"} if plain else {}
        self.memo_words = memo_words
        self.memo = Memo(self._spaced if plain else self._spaced_any, {})

    def _model_ids(self, piece: str) -> bytes:
        """One piece of the split pattern, through the library's BPE model."""
        return array(self.code, [t.id for t in self.tokenize(piece)]).tobytes()

    def _raw(self, piece: str) -> str:
        return piece if piece.isalpha() and piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)

    def _spaced(self, part: str) -> bytes:
        """The ids of a part with the space before it.

        A word, a word and one mark, and these followed by a line's end and a
        word need no split pattern.
        """
        if part.isalpha():
            return self._model_ids(self.space + self._raw(part))
        head, mark = part[:-1], part[-1:]
        if mark in self.marks and head.isalpha():
            return self.memo[head] + self.marks[mark]
        head, line, tail = part.partition("\n")
        if line and head and head[-1:] in self.marks and head[:-1].isalpha():
            if tail.isalpha():
                return self.memo[head] + self._model_ids(self._raw(line)) + self._model_ids(self._raw(tail))
        return b"".join([self._model_ids(self._raw(x)) for x in PIECES.findall(" " + part)])

    def _spaced_any(self, part: str) -> bytes:
        return self._whole([" " + part])[0]

    def _whole(self, texts: list[str]) -> list[bytes]:
        encode = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        return [np.array(e.ids, self.dtype).tobytes() for e in encode(texts, add_special_tokens=False)]

    @staticmethod
    def _parts(text: str) -> list[str]:
        """``text`` cut before each space that a non-space follows; the space is left out."""
        parts = text.split(" ")
        if not RUNS.search(text):
            return parts
        whole = [parts[0]]
        for p in parts[1:]:
            if p and not p[0].isspace():
                whole.append(p)
            else:
                whole[-1] += " " + p
        return whole

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        """The ids of each text as bytes of ``self.dtype``."""
        cut = [self._parts(t) for t in texts]
        heads = self._whole([c.pop(0) for c in cut])  # the only part without a space before it
        out = [head + b"".join(map(self.memo.__getitem__, c)) for head, c in zip(heads, cut)]
        if len(self.memo) > self.memo_words:
            self.memo = Memo(self.memo.encode, dict(self.memo))
        return out

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The joined ids of an Arrow string column and the bounds of its texts (null: empty).

        Parts are cut and told apart by Arrow, so Python sees each distinct part once a call.
        """
        if not len(texts):
            return np.zeros(0, self.dtype), np.zeros(1, np.int64)
        texts = pc.fill_null(texts, "")
        odd = np.flatnonzero(pc.match_substring_regex(texts, ODD).to_numpy(zero_copy_only=False))
        cut = pc.split_pattern(texts, " ")
        first = np.asarray(cut.offsets)[:-1] - cut.offsets[0].as_py()
        parts = cut.flatten()
        coded = parts.dictionary_encode()
        index = np.asarray(coded.indices)
        used = np.ones(len(parts), bool)  # what only heads and odd texts hold is not looked up
        used[first] = False
        for i in odd:
            used[first[i] : first[i + 1] if i + 1 < len(first) else len(parts)] = False
        want = np.bincount(index[used], minlength=len(coded.dictionary)) > 0
        words = coded.dictionary.to_pylist()
        pool = [self.memo[w] if keep else b"" for w, keep in zip(words, want)]
        heads = self._whole(pc.list_element(cut, 0).to_pylist())
        strange = self.encode(texts.take(pa.array(odd)).to_pylist()) if len(odd) else []
        size = np.array([len(x) for x in chain(pool, heads, strange)], np.int64) // self.dtype.itemsize
        begin = np.concatenate([[0], np.cumsum(size)])
        flat = np.frombuffer(b"".join(chain(pool, heads, strange)), self.dtype)
        index = index.astype(np.int64)
        index[first] = len(pool) + np.arange(len(heads))
        length = size[index]
        for k, i in enumerate(odd):  # all ids of an odd text stand at its head
            length[first[i] : first[i + 1] if i + 1 < len(first) else len(parts)] = 0
            index[first[i]] = len(pool) + len(heads) + k
            length[first[i]] = size[index[first[i]]]
        ends = np.cumsum(length)
        ids = flat[np.repeat(begin[index] - ends + length, length) + np.arange(ends[-1])]
        if len(self.memo) > self.memo_words:
            self.memo = Memo(self.memo.encode, dict(self.memo))
        return ids, np.concatenate([[0], ends])[np.append(first, len(parts))]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(tokenizer_path: str, memo_words: int = 500_000) -> WordEncoder:
    """The worker process's encoder for a tokenizer file, kept between tasks."""
    if tokenizer_path not in _ENCODERS:
        _ENCODERS[tokenizer_path] = WordEncoder(tokenizer_path)
    _ENCODERS[tokenizer_path].memo_words = memo_words
    return _ENCODERS[tokenizer_path]


def forget_encoders() -> None:
    """Frees the encoders that earlier tasks left in this worker process: their memos may hold a million words."""
    _ENCODERS.clear()


def slices(texts: pa.Array, chars: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of a string column of about ``chars`` bytes each; a longer text stands alone."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero(np.diff(np.cumsum(size) // chars)) + 1
    bounds = [0, *cuts.tolist(), len(size)]
    return ((a, b) for a, b in zip(bounds, bounds[1:]) if a < b)
