"""From raw documents to packed training sequences, in five stages.

Each stage reads all that its predecessor kept, as a Parquet table in the shared
folder, and all but the last return the columns of ``documents``.

* ``quality``: documents that the attention classifier scores below 0.5 go.
* ``near_copies``: of documents linked by a Jaccard similarity of 0.8 or more on
  five-word shingles, directly or through others, the smallest id stays.
* ``repeated_text``: bytes covered by a 50-byte string that a document with a
  smaller id also holds are cut; no document goes.
* ``benchmark``: documents with a passage at least 0.8 similar to a benchmark
  item, on five-word shingles, go.
* ``packing``: the rest is cut into pieces of at most 2048 ids and packed.

Texts are long, so a stage hands at most ``BATCH_ROWS`` of them, and about
``BATCH_BYTES``, to a Python task at a time; a smaller setting of the session stays.

Null texts: quality judges them as empty; the other stages let them through and
packing gives them the end id alone.  An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.llm import decontam, jaccard, packing, quality, substrings
from cohortkit.llm.common import materialize, table
from cohortkit.llm.queries import tokenizer_path

CAPACITY = 2048
END_ID = 0
#: Rows of an Arrow batch; with Spark's default of 10,000 the batches of two tasks take several hundred MB.
BATCH_ROWS = 1000
#: Bytes of an Arrow batch; the JVM holds a batch several times outside its heap, and keeps what its buffers once took.
BATCH_BYTES = 1 << 20
#: Words that packing remembers, and bytes of text that it encodes at a time; the executors are fuller here than in op2.
MEMO_WORDS = 50_000
SLICE = 1 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
BYTES_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def setting_bytes(value: str) -> int:
    """A size as Spark writes it: bytes, or a number with a unit."""
    number, unit = re.fullmatch(r"\s*(-?\d+)\s*([a-z]?)(?:i?b)?\s*", value.lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit if unit and unit != "b" else " ")


def bounded(stage):
    """The stage with Arrow batches of at most ``BATCH_ROWS`` rows and about ``BATCH_BYTES``, its returned frame included."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        held = int(spark.conf.get(BATCH_SETTING))
        if held <= 0 or held > BATCH_ROWS:
            spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))
        if setting_bytes(spark.conf.get(BYTES_SETTING)) > BATCH_BYTES:
            spark.conf.set(BYTES_SETTING, str(BATCH_BYTES))
        return stage(spark, docs, sf_dir)

    return run_stage


@bounded
def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.learn(docs, table(spark, sf_dir, "labels"), folds=3, held_out=1)
    return quality.keep_good(docs, model)


@bounded
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs, jaccard.Rule(words=5, num=8, den=10))


@bounded
def cut_repeated_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = substrings.cut_texts(docs)
    return cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cut


@bounded
def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


@bounded
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(packing.token_pieces(docs, tokenizer_path(), CAPACITY, END_ID, memo_words=MEMO_WORDS, chars=SLICE), CAPACITY)


STAGES = [
    ("quality", drop_low_quality),
    ("near_copies", drop_near_copies),
    ("repeated_text", cut_repeated_text),
    ("benchmark", drop_benchmark_passages),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs


#: The stages learn, sort suffixes and tokenize, so no SQL gives these rows; tests hold them against brute force.
ORACLE_SQL = None
