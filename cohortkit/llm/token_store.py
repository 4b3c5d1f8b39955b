"""Token ids in blocks: one concatenated id array with Elias-Fano document bounds.

A block file image holds the ids of consecutive documents and the n + 1 bounds
of these documents as an Elias-Fano sequence: the low bits of each bound in a
packed array, the high bits in unary in a bit vector, with a sample of the
select structure every 64 ones.  So a bound costs about 2 + log2(mean length)
bits and no 64-bit table is kept, neither in the files nor by the reader, which
selects each bound it needs.  Document ids ascend, so they are another such
sequence, of their distances from the block's first id.  Images are rows of Parquet files in ascending
document order, so Spark's committer makes their writing safe on any store.

Null texts count as empty and hold the end id alone.  Null ids sort first.
Repeated ids keep one entry per row, in an arbitrary but fixed order.  An empty
table gives no block.  Other columns are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import scratch_path
from .tokens import encoder, slices

SAMPLE = 64
MAGIC = b"EFT1"
BLOCKS = "part int, block int, n_docs long, n_tokens long, n_null long, first_id long, id_image binary, image binary"


class EliasFano:
    """A non-decreasing sequence of integers in near-minimal space."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n, top = len(values), int(values[-1]) if len(values) else 0
        bits = max(0, (top // max(n, 1)).bit_length() - 1)
        low = np.unpackbits(values.astype("<u8").view(np.uint8).reshape(n, 8), axis=1, bitorder="little")[:, :bits]
        ones = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        high[ones] = 1
        return cls(n, bits, np.packbits(low, bitorder="little").tobytes(), np.packbits(high, bitorder="little").tobytes(),
                   ones[::SAMPLE].astype("<u4"))

    def _low(self, i: int) -> int:
        at = i * self.low_bits
        word = int.from_bytes(self.low[at >> 3 : ((at + self.low_bits) >> 3) + 1], "little")
        return (word >> (at & 7)) & ((1 << self.low_bits) - 1)

    def select(self, i: int) -> int:
        """The value with index ``i``: from the nearest sample, then byte counts."""
        at, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte = at >> 3
        word = self.high[byte] >> (at & 7) << (at & 7)
        while word.bit_count() <= left:
            left -= word.bit_count()
            byte += 1
            word = self.high[byte]
        for _ in range(left):
            word &= word - 1
        one = (byte << 3) + (word & -word).bit_length() - 1
        return ((one - i) << self.low_bits) | self._low(i)

    def to_bytes(self) -> bytes:
        head = struct.pack("<QBQQQ", self.n, self.low_bits, len(self.low), len(self.high), len(self.samples))
        return head + self.low + self.high + self.samples.tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> EliasFano:
        n, bits, low, high, samples = struct.unpack_from("<QBQQQ", raw)
        at = struct.calcsize("<QBQQQ")
        return cls(n, bits, raw[at : at + low], raw[at + low : at + low + high],
                   np.frombuffer(raw, "<u4", samples, at + low + high))


def id_image(ids: pa.Array) -> tuple[int, int, bytes]:
    """How many ids are null (they come first), the first other id, and the Elias-Fano sequence of the distances from it."""
    known = ids.drop_null().to_numpy(zero_copy_only=False).astype(np.int64)
    first = int(known[0]) if len(known) else 0
    return ids.null_count, first, EliasFano.encode(known.view(np.uint64) - np.int64(first).view(np.uint64)).to_bytes()


def block_image(ids: np.ndarray, bounds: np.ndarray) -> bytes:
    """The file image of a block: magic, id width, sizes, bounds, ids."""
    ef = EliasFano.encode(bounds).to_bytes()
    return MAGIC + struct.pack("<BQQ", ids.dtype.itemsize, len(ef), len(ids)) + ef + ids.tobytes()


def read_image(raw: bytes) -> tuple[np.ndarray, EliasFano]:
    """The ids (a view of ``raw``) and the bounds of a block."""
    if raw[:4] != MAGIC:
        raise ValueError("not a token block")
    width, ef, n = struct.unpack_from("<BQQ", raw, 4)
    at = 4 + struct.calcsize("<BQQ")
    return np.frombuffer(raw, f"<u{width}", n, at + ef), EliasFano.from_bytes(raw[at : at + ef])


def write_blocks(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 0, block_chars: int = 8 << 20,
                 id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode ``docs`` and write their blocks to ``path`` in ascending id order.

    Ranges are cut on the id and a row number, so even one id on very many rows
    is split.  A block holds about ``block_chars`` bytes of text; a longer text
    has a block of its own.
    """

    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, made = encoder(tokenizer_path), 0
        for batch in batches:
            part, doc, texts = (batch.column(i) for i in range(3))
            for a, b in slices(texts, block_chars):
                ids, bounds = enc.encode_column(texts.slice(a, b - a))
                bounds = bounds + np.arange(len(bounds))
                whole = np.insert(ids, (bounds[1:] - np.arange(1, len(bounds))), end_id).astype(enc.dtype)
                image = block_image(whole, bounds)
                yield pa.RecordBatch.from_arrays(
                    [part.slice(a, 1), pa.array([made], pa.int32()), pa.array([b - a], pa.int64()), pa.array([len(whole)], pa.int64()),
                     *(pa.array([x], kind) for x, kind in zip(id_image(doc.slice(a, b - a)), (pa.int64(), pa.int64(), pa.binary()))), pa.array([image], pa.binary())],
                    names=["part", "block", "n_docs", "n_tokens", "n_null", "first_id", "id_image", "image"])
                made += 1

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("row"))
    ranged = rows.repartitionByRange("doc_id", "row").sortWithinPartitions("doc_id", "row")
    ranged.select(F.spark_partition_id().alias("part"), "doc_id", "text").mapInArrow(blocks, BLOCKS) \
        .write.option("compression", "zstd").option("parquet.block.size", str(32 << 20)).parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each document, from the files."""
    blocks = spark.read.schema(BLOCKS).parquet(path)

    def documents(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, block, n_null, first, id_images, images = (batch.column(i) for i in range(6))
            for i in range(batch.num_rows):
                ids, bounds = read_image(images[i].as_buffer().to_pybytes())
                places = EliasFano.from_bytes(id_images[i].as_py())
                doc = [None] * n_null[i].as_py() + [first[i].as_py() + places.select(k) for k in range(places.n)]
                start, size, crc, b = [], [], [], bounds.select(0)
                for k in range(1, bounds.n):
                    a, b = b, bounds.select(k)
                    start.append(a)
                    size.append(b - a)
                    crc.append(zlib.crc32(ids[a:b].astype("<u4")))
                n = len(doc)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, part[i].as_py(), np.int32)), pa.array(np.full(n, block[i].as_py(), np.int32)),
                     *(pa.array(c, pa.int64()) for c in (doc, start, size, crc))],
                    names=["part", "block", "doc_id", "local", "n_tokens", "ids_crc32"])

    found = blocks.select("part", "block", "n_null", "first_id", "id_image", "image").mapInArrow(
        documents, "part int, block int, doc_id long, local long, n_tokens long, ids_crc32 long")
    # ids before each part (one row a part), and before each block of a part
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    before = F.sum("tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("part", F.coalesce(before, F.lit(0)).alias("part_base"))
    within = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    bases = blocks.select("part", "block", F.coalesce(within, F.lit(0)).alias("block_base")).join(parts, "part")
    return found.join(bases, ["part", "block"]).select(
        "doc_id", (F.col("part_base") + F.col("block_base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")


def encode_and_read(docs: DataFrame, tokenizer_path: str, end_id: int = 0) -> DataFrame:
    """Write the blocks of ``docs`` to the shared folder and read the documents back."""
    path = scratch_path(docs.sparkSession, "tokens")
    write_blocks(docs, path, tokenizer_path, end_id)
    return read_documents(docs.sparkSession, path)
