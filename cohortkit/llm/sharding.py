"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

Three native steps.  Rows lie in blocks.  (1) The matrix of how many rows each
block sends to each shard is drawn from its exact law: block after block, shard
after shard, a hypergeometric count given what shards still need.  (2) Each
block permutes its rows and cuts them by its row of the matrix.  (3) Each shard
permutes what it received.  Every assignment with these shard sizes is equally
likely, and shard sizes differ by at most one.

Only identifiers and checksums move, never the texts.  Null texts count as
empty, null ids and repeated rows are rows like others, an empty table gives an
empty result, and other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortkit.functions.draws import hypergeometric_sql

from .common import materialize

#: Rows that one task ranks at a time, on average.
TASK_ROWS = 1 << 16


def matrix_sql(shards: int, seed: str) -> str:
    """SQL for the rows of the matrix from ``blocks`` (array of ``block_, n``) and ``rows``, all draws from ``seed``.

    A count is a few numbers of state (``functions.draws``); a draw takes about 20
    standard deviations of steps, so the fold costs blocks x shards draws, which
    grow with the square root of the rows in a block.
    """
    u = f"(pmod(xxhash64({seed}, b.block_, j), 9007199254740992L) / 9007199254740992.0D)"
    count = hypergeometric_sql("t.rest", "t.need[j]", "t.take", u)
    return f"""
      aggregate(blocks,
        named_struct('need', transform(sequence(0, {shards - 1}), j -> (rows div {shards}) + IF(j < rows % {shards}, 1L, 0L)),
                     'out', CAST(array() AS ARRAY<STRUCT<block_: INT, counts: ARRAY<BIGINT>>>)),
        (s, b) -> transform(array(
            aggregate(sequence(0, {shards - 1}),
              named_struct('need', s.need, 'rest', aggregate(s.need, 0L, (x, y) -> x + y), 'take', b.n, 'counts', CAST(array() AS ARRAY<BIGINT>)),
              (t, j) -> transform(array({count}),
                 c -> named_struct('need', t.need, 'rest', t.rest - t.need[j], 'take', t.take - c, 'counts', concat(t.counts, array(c))))[0])),
          t -> named_struct('need', zip_with(s.need, t.counts, (x, y) -> x - y),
                            'out', concat(s.out, array(named_struct('block_', b.block_, 'counts', t.counts)))))[0],
        s -> s.out)"""


def communication_matrix(blocks: DataFrame, shards: int, seed: int) -> DataFrame:
    """``block_, counts`` (rows for each shard) from ``block_, n``.

    The draws depend on each other, so they are one fold over the blocks; its
    size is blocks x shards, both parameters.
    """
    folded = blocks.groupBy().agg(F.sort_array(F.collect_list(F.struct("block_", "n"))).alias("blocks"), F.sum("n").alias("rows"))
    return folded.select(F.explode(F.expr(matrix_sql(shards, str(int(seed))))).alias("m")).select("m.block_", "m.counts")


def ranks(df: DataFrame, group: str, order: str, pieces: int) -> DataFrame:
    """``df`` with ``rank_``, gapless from 0 in each ``group``, by ``order`` (uniform in [0, 1)).

    The order is cut into ``pieces`` equal ranges that are ranked apart, so a
    group needs no single task; the rows before a range are counted first.
    """
    piece = F.least(F.floor(F.col(order) * pieces), F.lit(pieces - 1)).cast("int")
    df = df.withColumn("piece_", piece)
    counts = df.groupBy(group, "piece_").agg(F.count(F.lit(1)).alias("c_"))
    before = F.sum("c_").over(Window.partitionBy(group).orderBy("piece_").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select(group, "piece_", F.coalesce(before, F.lit(0)).alias("before_"))
    here = F.row_number().over(Window.partitionBy(group, "piece_").orderBy(order, "row_")) - 1
    ranked = df.withColumn("here_", here).join(counts, [group, "piece_"])
    return ranked.withColumn("rank_", F.col("here_") + F.col("before_")).drop("piece_", "here_", "before_")


def text_facts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32``: UTF-8 bytes plus 16, and the checksum of these bytes."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + 16).cast("long").alias("size"),
                       F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))


def shard_rows(rows: DataFrame, shards: int, seed: int = 17, blocks: int = 64) -> DataFrame:
    """``rows`` with ``shard`` and ``slot`` (gapless from 0 in each shard).

    ``blocks`` bounds the matrix.  Blocks and shards are ranked in as many pieces
    as their rows need, about ``TASK_ROWS`` in each.  Rows and their random orders
    are written first, so a retried task sees the same numbers.
    """
    names = rows.columns
    base = materialize(rows.select(
        *names, F.pmod(F.spark_partition_id(), F.lit(blocks)).alias("block_"), F.monotonically_increasing_id().alias("row_"),
        F.rand(seed).alias("first_"), F.rand(seed + 1).alias("second_")), "shard-rows")
    pieces = -(-base.count() // (min(blocks, shards) * TASK_ROWS)) + 1
    matrix = communication_matrix(base.groupBy("block_").agg(F.count(F.lit(1)).alias("n")), shards, seed)
    ends = F.expr("aggregate(counts, named_struct('sum', 0L, 'out', CAST(array() AS ARRAY<BIGINT>)), "
                  "(s, c) -> named_struct('sum', s.sum + c, 'out', concat(s.out, array(s.sum + c))), s -> s.out)")
    permuted = ranks(base, "block_", "first_", pieces).join(matrix.select("block_", ends.alias("ends_")), "block_")
    shard: Column = F.size(F.filter("ends_", lambda e: e <= F.col("rank_"))).cast("int")
    sent = permuted.select(*names, "row_", "second_", shard.alias("shard"))
    return ranks(sent, "shard", "second_", pieces).select(*names, "shard", F.col("rank_").cast("long").alias("slot"))
