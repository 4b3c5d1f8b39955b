"""Benchmark passages in documents, by SimHash of item-sized word windows.

Words are runs of letters and digits, lower-cased; a shingle is ``shingle``
consecutive words (all words of an item that has fewer).  A window has as many
words as an item, or is the whole text if that has fewer.  Its similarity to the item is the weighted Jaccard of their
shingles, each weighing as often as it occurs: sum of minima / sum of maxima.

1. A window of a shingles can reach ``similarity`` s to an item of m only if at
   least s (a + m) / (1 + s) of its shingles occur in the item.  Windows with so many are
   found from the shingles' positions; no other window is fingerprinted.
2. Windows and items get a 64-bit SimHash.  The bits are cut into ``blocks``
   blocks; fingerprints within ``radius`` differ by at most radius // blocks
   bits in some block, so all items within that distance in a block are indexed
   and the windows probe their own block values.  No pair within ``radius`` is lost.
   Texts shorter than the item skip this step: they meet the item itself.
3. Candidates are verified by the exact similarity of their shingle strings.

All steps are DataFrame functions.  Null texts, and texts or items without a
word, match nothing.  Repeated rows give their pairs once.  Empty tables give an
empty result.  Other columns are not read.  The items, and the windows found, are
broadcast only up to ``broadcast_bytes``, which are measured; beyond that they
are shuffled.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, materialize


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), 0)


def positions(n: Column) -> Column:
    """1..n, empty for n < 1."""
    return F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.expr("CAST(array() AS ARRAY<INT>)"))


def shingle_hashes(w: str, k: int) -> Column:
    return F.transform(positions(F.size(w) - (k - 1)), lambda i: F.xxhash64(*[F.element_at(w, i + j) for j in range(k)]))


def simhash(hashes: str) -> Column:
    """Bit b is set if more than half of the hashes, with repetitions, have it."""
    bit = lambda b: F.when(F.expr(f"2 * size(filter({hashes}, x -> shiftright(x, b_) & 1L = 1L)) > size({hashes})".replace("b_", str(b))), F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))
    out = F.lit(0).cast("long")
    for b in range(64):
        out = out.bitwiseOR(F.shiftleft(bit(b), b))
    return out


def block_value(fp: str, block: Column, width: int) -> Column:
    return F.expr(f"CAST(shiftright({fp}, block_ * {width}) & {(1 << width) - 1}L AS INT)")


def flips(width: int, most: int) -> list[int]:
    """All masks of ``width`` bits with at most ``most`` ones."""
    return [sum(1 << b for b in c) for n in range(most + 1) for c in combinations(range(width), n)]


def weighted_overlap(a: str, b: str) -> Column:
    """Sum over distinct strings of the smaller number of occurrences."""
    repeated = F.expr(f"aggregate(array_distinct({a}), 0, (s, x) -> s + least(size(filter({a}, y -> y = x)), size(filter({b}, y -> y = x))))")
    plain = F.expr(f"size(array_intersect({a}, {b}))")
    return F.when(F.expr(f"size(array_distinct({a})) = size({a}) OR size(array_distinct({b})) = size({b})"), plain).otherwise(repeated)


def find_leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, shingle: int = 5, radius: int = 23, blocks: int = 8,
               broadcast_bytes: int = 8 << 20, id_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``id, item, similarity, start, n_words``: the most similar window of each document and item, ``start`` in words from 0."""
    width = 64 // blocks
    items = benchmark.select(F.col(item_col).alias("item"), F.col(text_col).alias("t")).distinct()
    small = (items.agg(F.sum(F.octet_length("t"))).first()[0] or 0) <= broadcast_bytes
    side = F.broadcast if small else (lambda df: df)
    items = items.select("item", words(F.col("t")).alias("w")).filter("size(w) > 0").withColumn("n", F.size("w")).withColumn("k", F.least("n", F.lit(shingle)))
    sizes = sorted(r.k for r in items.select("k").distinct().collect())  # at most ``shingle`` values
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).filter("t IS NOT NULL")
    keyed = source.withColumn("row", F.xxhash64("t"))

    found = []
    for k in sizes:
        own = items.filter(F.col("k") == k).withColumn("h", shingle_hashes("w", k)).withColumn("m", F.size("h"))
        terms = own.select("item", "m", F.explode("h").alias("h")).distinct()
        need = F.ceil(F.lit(similarity / (1 + similarity)) * (F.least(F.col("len") - (k - 1), F.col("m")) + F.col("m")) - 1e-9)
        cut = keyed.select("id", "row", words(F.col("t")).alias("w"))
        spots = cut.select("id", "row", F.size("w").alias("len"), F.posexplode(shingle_hashes("w", k)).alias("p", "h"))
        hits = materialize(spots.join(side(terms), "h").select("id", "row", "len", "item", "m", "p"), f"leak-hits-{k}")
        enough = hits.groupBy("id", "row", "item", "len").agg(F.countDistinct("p").alias("c"), F.min("m").alias("m")).filter(F.col("c") >= need)
        enough = enough.select(F.col("id").alias("i_"), F.col("row").alias("r_"), F.col("item").alias("t_"))
        hits = hits.join(enough, F.col("id").eqNullSafe(F.col("i_")) & (F.col("row") == F.col("r_")) & F.col("item").eqNullSafe(F.col("t_")), "left_semi")
        first, last = F.greatest(F.col("p") - F.col("m") + 1, F.lit(0)), F.least(F.col("p"), F.greatest(F.col("len") - (k - 1) - F.col("m"), F.lit(0)))
        starts = hits.select("id", "row", "len", "item", "m", "p", F.explode(F.sequence(first, last)).alias("start"))
        starts = starts.groupBy("id", "row", "len", "item", "m", "start").agg(F.countDistinct("p").alias("c")).filter(F.col("c") >= need)
        whole = F.col("len") - (k - 1) < F.col("m")  # the text is shorter than the item, and one window
        of = F.when(whole, F.col("item")).alias("of")
        windows = starts.groupBy("id", "row").agg(F.collect_set(F.struct("start", "m", whole.alias("whole"), of)).alias("windows"))  # few in a document
        windows = materialize(windows.select(F.col("id").alias("i_"), F.col("row").alias("r_"), "windows"), f"leak-windows-{k}")
        size = windows.agg(F.sum(24 + 32 * F.size("windows"))).first()[0] or 0
        texts = keyed.join(F.broadcast(windows) if size <= broadcast_bytes else windows, F.col("id").eqNullSafe(F.col("i_")) & (F.col("row") == F.col("r_")))
        texts = texts.select("id", "row", "t", "windows").dropDuplicates(["id", "row"]).withColumn("w", words(F.col("t")))
        cut = texts.select("id", "w", F.explode("windows").alias("x")).select(
            "id", F.col("x.start").alias("start"), F.expr(f"slice(w, x.start + 1, x.m + {k - 1})").alias("w"), "x.whole", "x.of", (F.col("x.m") + (k - 1)).alias("n"))
        short = cut.filter("whole").select("id", "start", "of", F.col("n").alias("most"), "w")
        short = short.join(side(own.select("item", "n", F.col("w").alias("iw"))), F.col("of").eqNullSafe(F.col("item")) & (F.col("most") == F.col("n")))
        printed = cut.filter("NOT whole").withColumn("h", shingle_hashes("w", k)).withColumn("fp", simhash("h")).select("id", "start", "w", "fp")
        probes = printed.select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block_")) \
            .withColumn("value", block_value("fp", F.col("block_"), width)).withColumn("len", F.size("w"))
        index = own.select("item", F.col("w").alias("iw"), F.col("n").alias("len"), simhash("h").alias("ifp")) \
            .select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block_")) \
            .select("*", block_value("ifp", F.col("block_"), width).alias("own"), F.explode(F.array(*map(F.lit, flips(width, radius // blocks)))).alias("flip")) \
            .select("item", "iw", "len", "ifp", "block_", F.col("own").bitwiseXOR(F.col("flip")).alias("value"))
        near = probes.join(index, ["len", "block_", "value"]).filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("ifp"))) <= radius)
        pairs = near.select("id", "start", "item", "w", "iw").unionByName(short.select("id", "start", "item", "w", "iw")).distinct().withColumn("len", F.size("w"))
        strings = lambda c: F.expr(f"transform(sequence(1, size({c}) - {k - 1}), i -> concat_ws(' ', slice({c}, i, {k})))")
        scored = pairs.withColumn("a", strings("w")).withColumn("b", strings("iw")).withColumn("common", weighted_overlap("a", "b"))
        score = F.col("common") / (F.size("a") + F.size("b") - F.col("common"))
        found.append(scored.select("id", "item", "start", "len", score.alias("s")).filter(F.col("s") >= similarity))
    if not found:
        nothing = docs.select(F.col(id_col), F.lit(None).cast(benchmark.schema[item_col].dataType).alias(item_col))
        return nothing.limit(0).select(id_col, item_col, F.lit(0.0).alias("similarity"), F.lit(0).alias("start"), F.lit(0).alias("n_words"))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    best = every.groupBy("id", "item").agg(F.max(F.struct(F.col("s"), (-F.col("start")).alias("at"), "len")).alias("x"))
    return best.select(F.col("id").alias(id_col), F.col("item").alias(item_col), F.col("x.s").alias("similarity"),
                       (-F.col("x.at")).alias("start"), F.col("x.len").alias("n_words"))


def drop_leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, id_col: str = "doc_id", broadcast_bytes: int = 8 << 20) -> DataFrame:
    """The rows of ``docs`` whose id has no passage similar to an item."""
    leaks = find_leaks(docs, benchmark, similarity=similarity, id_col=id_col, broadcast_bytes=broadcast_bytes)
    mark = fresh(docs.columns, "leak_id")
    ids = materialize(leaks.select(F.col(id_col).alias(mark)).distinct(), "leaks")
    side = F.broadcast(ids) if ids.count() * 16 <= broadcast_bytes else ids
    return docs.join(side, F.col(id_col).eqNullSafe(F.col(mark)), "left_anti")
