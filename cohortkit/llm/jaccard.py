"""Exact Jaccard join on word shingles, with token-combination prefixes.

Texts with one shingle set are one class.  All tokens (shingle hashes) have one
global order: rare ones by hash, then frequent ones by hash.  A token is
frequent if more than ``frequent`` classes hold it near the front of their sets.
Let a set have n tokens, of which a partner must share at least t.

* Rare tokens are indexed singly: the first n - t + 1 tokens of linked sets
  have one in common, and if those of either set are all rare, it is rare.
* A set with fewer rare tokens has frequent ones in its prefix.  They are
  indexed by combinations of two: neighbours in the order, over a prefix so
  extended (2 d + 2 tokens, d the largest difference of linked sets) that the
  differing tokens cannot part all shared neighbours.

Sets that share a key are compared.  First every set meets the hub of each of its
keys, the set with the fewest tokens of its own; components of the links so found
spare all comparisons within them.  Then sets of different components that share
a key meet.  Two sets meet at the first key of every run of keys that they share,
so a pair of near copies meets a few times, not once a key.  Pairs are refused
inside the join by their sizes, by the tokens that no other set has, and by parity
sketches, which never differ in more places than the sets do (for rare keys behind
the join, as these meet ``frequent`` sets at most); what is left is verified on the
sets of the whole texts, which are made once for each class.  So no link between
components is lost, and a large group of near copies costs about its size.  Only
sets that share frequent keys without being linked are tested in pairs, by
comparisons of a few words; such pairs leave no row.

Empty and null texts and texts without words have an empty set, are linked with
nothing and are their own component.  Texts with fewer than ``words`` words have
one shingle, the whole sequence.  Rows with a null id count as texts; they
inherit the smallest id of their component, or null.  An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, lean, materialize, release
from .components import components
from .shingles import mix, odd_sketch, set_id, shingle_set, sketch_difference
from .tokens import forget_encoders

#: Bytes of a measured table up to which it is broadcast; larger ones are shuffled.
BROADCAST = 32 << 20
#: Bits of the sketch that the join itself compares.
BRIEF = 512
#: Rows of an Arrow batch that a task hands back, so that neither side holds a large one.
CHUNK = 1 << 16
#: Whole sets that a task makes before it hands them back; each may take 8 bytes a word.
SETS = 64


@dataclass(frozen=True)
class Rule:
    """``den * intersection >= num * union`` on shingles of ``words`` words."""

    words: int = 5
    num: int = 8
    den: int = 10

    def least_shared(self, n: int) -> int:
        return -(-self.num * n // self.den)

    def prefix(self, n: int) -> int:
        return n - self.least_shared(n) + 1

    def most_different(self, a: int, b: int) -> int:
        return a + b - 2 * -(-self.num * (a + b) // (self.num + self.den))

    def widest(self, n: int) -> int:
        """The largest difference to a linked set of any size."""
        return self.most_different(n, n * self.den // self.num)

    def sketch_bits(self, n: int) -> int:
        return max(64, 1 << (8 * self.widest(n)).bit_length())

    def stored(self, n: int) -> int:
        """Tokens kept in the first pass: the prefix and some room for frequent ones."""
        p = self.prefix(n)
        return min(n, p + p // 6 + 4)

    def linked(self, a: np.ndarray, b: np.ndarray) -> bool:
        shared = len(np.intersect1d(a, b, assume_unique=True))
        return self.den * shared >= self.num * (len(a) + len(b) - shared)


def chunks(arrays: list[pa.Array], names: list[str]) -> Iterator[pa.RecordBatch]:
    """The columns as batches of at most ``CHUNK`` rows."""
    whole = pa.RecordBatch.from_arrays(arrays, names=names)
    for at in range(0, whole.num_rows, CHUNK):
        yield whole.slice(at, CHUNK)


def small_side(df: DataFrame, row_bytes: int) -> DataFrame:
    """``df`` (a written table) with a broadcast hint, if its measured size allows one."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST else df


def first_pass(docs: DataFrame, rule: Rule) -> DataFrame:
    """``doc_id, n, cid, text_hash, sketch, brief, low``: the set's size and id, its sketches and its first tokens."""

    @lean
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_encoders()
        for b in batches:
            rows = []
            for text in b.column(1).to_pylist():
                s = shingle_set(text, rule.words)
                n = len(s)
                if n:
                    brief = np.frombuffer(odd_sketch(s, BRIEF), "<i8").tolist()
                    rows.append((n, set_id(s), odd_sketch(s, rule.sketch_bits(n)), brief, s[: rule.stored(n)].astype("<u8").tobytes()))
                else:
                    rows.append((0, None, None, None, None))
            n, cid, sketch, brief, low = zip(*rows) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int32()), pa.array(cid, pa.binary()), b.column(2), pa.array(sketch, pa.binary()),
                 pa.array(brief, pa.list_(pa.int64())), pa.array(low, pa.binary())],
                names=["doc_id", "n", "cid", "text_hash", "sketch", "brief", "low"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    return rows.mapInArrow(run, f"doc_id {kind}, n int, cid binary, text_hash long, sketch binary, brief array<long>, low binary")


def texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` with the texts of its rows' ``rep`` (id and text hash of one row of a class)."""
    source = docs.select("text", F.col("doc_id").alias("d_"), F.xxhash64("text").alias("h_"))
    return source.join(wanted, F.col("d_").eqNullSafe(F.col("rep.doc_id")) & (F.col("h_") == F.col("rep.text_hash")))


def whole_sets(docs: DataFrame, wanted: DataFrame, rule: Rule) -> DataFrame:
    """``cid, low`` with all tokens of the classes ``wanted`` (``cid, rep``), from their texts."""

    @lean
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_encoders()
        for b in batches:
            for at in range(0, b.num_rows, SETS):
                part = b.slice(at, SETS)
                sets = [shingle_set(t, rule.words) for t in part.column(1).to_pylist()]
                same = [set_id(s) == c for s, c in zip(sets, part.column(0).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).filter(pa.array(same, pa.bool_())), pa.array([s.astype("<u8").tobytes() for s, ok in zip(sets, same) if ok], pa.binary())], names=["cid", "low"])

    texts = texts_of(docs, small_side(wanted, 48))
    return texts.select("cid", "text").mapInArrow(run, "cid binary, low binary").dropDuplicates(["cid"])


def tokens(classes: DataFrame, owner: bool) -> DataFrame:
    """``token`` of the stored tokens, with the ``sid`` that holds it if ``owner``."""

    @lean
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 512):
                low = [np.frombuffer(x, "<i8") for x in b.column(0).slice(at, 512).to_pylist()]
                held = [pa.array(np.concatenate(low))]
                if owner:
                    held.append(b.column(1).slice(at, 512).take(pa.array(np.repeat(np.arange(len(low)), [len(x) for x in low]))))
                yield from chunks(held, names)

    names = ["token", "sid"] if owner else ["token"]
    return classes.select("low", *names[1:]).mapInArrow(run, "token long" + ", sid long" * owner)


def prefix_size(rule: Rule) -> Column:
    """``Rule.prefix`` of the column ``n``."""
    return F.col("n") - F.ceil(F.lit(rule.num) * F.col("n") / F.lit(rule.den)) + 1


def classify(docs: DataFrame, classes: DataFrame, rule: Rule, frequent: int) -> tuple[DataFrame, DataFrame]:
    """The classes with as many tokens as their prefixes need, and their frequent tokens (``sid, often``).

    Where a set's stored tokens hold too few rare ones, the whole set is taken,
    and frequencies are counted again, until all prefixes are known.
    """
    while True:
        counted = tokens(classes, False).groupBy("token").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > frequent)
        often = materialize(counted.select("token"), "frequent")
        held = tokens(classes, True).join(small_side(often, 16), "token")
        lists = materialize(held.groupBy("sid").agg(F.collect_list("token").alias("often")), "frequent-held")
        release(often)
        have = classes.select("sid", "n", (F.octet_length("low") / 8).alias("have")).filter("have < n")
        short = have.join(lists, "sid").filter(F.col("have") - F.size("often") < prefix_size(rule)).select("sid")
        lacking = classes.select("sid", "cid", "rep", "n", "sketch", "brief").join(small_side(materialize(short, "short-ids"), 16), "sid")
        lacking = materialize(lacking, "short-prefixes")
        if lacking.isEmpty():
            release(lacking)
            return classes, lists
        more = lacking.join(whole_sets(docs, lacking.select("cid", "rep"), rule), "cid")
        rest = classes.join(small_side(lacking.select("sid"), 16), "sid", "left_anti")
        old, classes = classes, materialize(rest.unionByName(more.select(*rest.columns)), "classes")
        release(old, lists, lacking)


def own_tokens(classes: DataFrame) -> DataFrame:
    """``sid, own``: how many of its tokens a class shares with no other class whose whole set is stored."""
    whole = classes.filter(F.octet_length("low") == 8 * F.col("n"))
    once = tokens(whole, True).groupBy("token").agg(F.count(F.lit(1)).alias("c"), F.min("sid").alias("sid")).filter("c = 1")
    return once.groupBy("sid").agg(F.count(F.lit(1)).cast("int").alias("own"))


def keys(rows: DataFrame, rule: Rule, pairs: bool) -> DataFrame:
    """``sid, n, most, key, prev``: single rare tokens, or neighbouring frequent tokens where the prefix holds some.

    ``rows`` are classes with ``often`` and ``own``.  ``most`` bounds what the class
    can share with any other of the key: keys of frequent tokens join whole stored
    sets, which lack the tokens of its own.  ``prev`` is the key before this one.
    """

    @lean
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                out, most = [], []
                for n, low, often, own in zip(*(part.column(i).to_pylist() for i in range(1, 5))):
                    s = np.frombuffer(low, "<u8")
                    p = rule.prefix(n)
                    heavy = np.zeros(len(s), bool) if often is None else np.isin(s, np.array(often, np.int64).view(np.uint64))
                    k, bound = s[~heavy][:p], n
                    if pairs:
                        h, bound = s[heavy][: 2 * rule.widest(n) + 2], n - (own or 0)
                        wanted = len(k) < p and bound >= rule.least_shared(n)
                        k = s[:0] if not wanted else mix(mix(h[:-1]) + h[1:]) if len(h) > 1 else mix(h + np.uint64(1))
                    out.append(k)
                    most.append(bound)
                size = np.array([len(k) for k in out])
                key = np.concatenate(out).view(np.int64)
                head = np.zeros(len(key), bool)
                head[(np.cumsum(size) - size)[size > 0]] = True
                owner = pa.array(np.repeat(np.arange(len(out)), size))
                yield from chunks([part.column(0).take(owner), part.column(1).take(owner), pa.array(np.repeat(np.array(most, np.int32), size)), pa.array(key),
                                   pa.array(np.concatenate([key[:1], key[:-1]]), mask=head)], ["sid", "n", "most", "key", "prev"])

    return rows.select("sid", "n", "low", "often", "own").mapInArrow(run, "sid long, n int, most int, key long, prev long")


def shared_keys(classes: DataFrame, lists: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame]:
    """The single and the combined keys that two classes or more have, the latter with brief sketches ``s0..``.

    At most ``frequent`` classes have a single token, so windows may gather these.
    A combination may be in any number of classes: its rows are counted by
    map-side aggregates, and the counts are joined back, which adaptive execution
    may split.  Only sets that are stored whole and are short of rare tokens have
    combinations.
    """
    rows = classes.select("sid", "n", "low").join(lists, "sid", "left").withColumn("own", F.lit(None).cast("int"))
    singles = keys(rows, rule, False).withColumn("c", F.count(F.lit(1)).over(Window.partitionBy("key"))).filter("c > 1").drop("c")
    singles = materialize(singles, "single-keys")
    whole = classes.filter(F.octet_length("low") == 8 * F.col("n")).select("sid", "n", "low")
    rows = whole.join(lists, "sid").filter(F.col("n") - F.size("often") < prefix_size(rule)).join(own_tokens(classes), "sid", "left")
    pairs = materialize(keys(rows, rule, True), "pair-keys")
    several = pairs.groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("key")
    brief = classes.select("sid", *(F.col("brief")[i].alias(f"s{i}") for i in range(BRIEF // 64)))
    shared = materialize(pairs.join(several, "key").join(brief, "sid"), "shared-pair-keys")
    release(pairs)
    return singles, shared


def may_link(rule: Rule):
    """Sizes, and what both sets can share at most, do not rule a link of ``n, most`` and ``n2, most2`` out."""
    sizes = (F.col("n") * rule.den >= F.col("n2") * rule.num) & (F.col("n2") * rule.den >= F.col("n") * rule.num)
    return sizes & (F.least("most", "most2") * (rule.num + rule.den) >= (F.col("n") + F.col("n2")) * rule.num)


def brief_differences(rule: Rule):
    """The brief sketches ``s0.. / z0..`` differ in no more places than linked sets may."""
    places = sum((F.bit_count(F.col(f"s{i}").bitwiseXOR(F.col(f"z{i}"))) for i in range(BRIEF // 64)), F.lit(0))
    size = F.col("n") + F.col("n2")
    return places <= size - 2 * F.ceil(size * rule.num / F.lit(rule.num + rule.den) - 1e-9)


def meeting(rule: Rule) -> Column:
    """The rows of two sets at one key (the second's columns end in 2): the first of a run of shared keys, and not refused by sizes."""
    return (~F.col("prev").eqNullSafe(F.col("prev2")) | F.col("prev").isNull()) & may_link(rule)


def refuse_by_sketch(pairs: DataFrame, classes: DataFrame, rule: Rule) -> DataFrame:
    """Pairs ``a, b`` whose sketches do not rule a link out."""

    @lean
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            na, nb, sa, sb = (b.column(i).to_pylist() for i in range(2, 6))
            keep = [sketch_difference(x, y) <= rule.most_different(i, j) for i, j, x, y in zip(na, nb, sa, sb)]
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = classes.select(F.col("sid").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    two = classes.select(F.col("sid").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    rows = pairs.join(one, "a").join(two, "b").select("a", "b", "na", "nb", "sa", "sb")
    return rows.mapInArrow(run, "a long, b long")


def verify(docs: DataFrame, pairs: DataFrame, classes: DataFrame, rule: Rule) -> DataFrame:
    """The pairs ``a, b`` (a written table, which goes) that are linked.

    The set of every class in a pair is made once, from one text.  A pair takes
    the set of ``a`` along to the task of ``b``, whose set is sent there once.
    """

    @lean
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_encoders()
        for b in batches:
            for cid, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                s = shingle_set(text, rule.words)
                if set_id(s) == cid:
                    yield pa.RecordBatch.from_arrays([pa.array([cid], pa.binary()), pa.array([s.view(np.int64)], pa.list_(pa.int64()))], names=["cid", "set"])

    held = pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct()
    wanted = materialize(classes.select("sid", "cid", "rep").join(held, "sid"), "pair-classes")
    texts = texts_of(docs, small_side(wanted.select("cid", "rep"), 48)).select("cid", "text")
    made = texts.mapInArrow(run, "cid binary, set array<long>").join(wanted.select("sid", "cid"), "cid").dropDuplicates(["sid"])
    sets = materialize(made.select("sid", "set"), "pair-sets")
    one, two = (sets.select(F.col("sid").alias(c), F.col("set").alias(f"set_{c}")) for c in "ab")
    common = F.size(F.array_intersect("set_a", "set_b"))
    linked = common * rule.den >= (F.size("set_a") + F.size("set_b") - common) * rule.num
    links = materialize(pairs.join(one, "a").join(two, "b").filter(linked).select("a", "b"), "links")
    release(wanted, sets, pairs)
    return links


def jaccard_classes(docs: DataFrame, rule: Rule, frequent: int = 24) -> tuple[DataFrame, DataFrame]:
    """Rows ``doc_id, n_shingles, cid, text_hash`` and the components ``cid, root`` of the classes that are not their own root."""
    sets = materialize(first_pass(docs, rule), "shingle-sets")
    classes = sets.filter("n > 0").groupBy("cid").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("rep"), F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("brief").alias("brief"), F.first("low").alias("low"))
    classes = materialize(classes.withColumn("sid", F.monotonically_increasing_id()), "classes")
    rows = materialize(sets.select("doc_id", F.col("n").alias("n_shingles"), "cid", "text_hash"), "shingle-rows")
    release(sets)
    classes, lists = classify(docs, classes, rule, frequent)
    singles, combined = shared_keys(classes, lists, rule)
    release(lists)
    plain = [("sid", "sid2"), ("n", "n2"), ("most", "most2"), ("prev", "prev2")]
    sketched = plain + [(f"s{i}", f"z{i}") for i in range(BRIEF // 64)]
    by_key = Window.partitionBy("key")

    def hub(cols: list[tuple[str, str]]) -> Column:
        return F.max(F.struct((F.col("most") - F.col("n")).alias("rank"), *(F.col(c).alias(d) for c, d in cols)))

    def ends(met: DataFrame) -> DataFrame:
        return met.select(F.least("sid", "sid2").alias("a"), F.greatest("sid", "sid2").alias("b"))

    def linked(one: DataFrame, two: DataFrame) -> DataFrame:
        pairs = ends(one).unionByName(ends(two)).distinct()
        return verify(docs, materialize(refuse_by_sketch(pairs, classes, rule), "pairs"), classes, rule)

    # each set meets the hub of each of its keys
    other = F.col("sid") != F.col("sid2")
    star = singles.withColumn("hub", hub(plain).over(by_key)).select("*", "hub.*").filter(other & meeting(rule))
    hubs = combined.groupBy("key").agg(hub(sketched).alias("hub")).select("key", *(F.col(f"hub.{d}") for _, d in sketched))
    links = linked(star, combined.join(hubs, "key").filter(other & meeting(rule) & brief_differences(rule)))

    # sets of different components that share a key
    roots = components(links)
    apart = F.col("root") < F.col("root2")

    def placed(rows: DataFrame) -> DataFrame:
        return rows.join(roots.withColumnRenamed("v", "sid"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))

    def second(rows: DataFrame, cols: list[tuple[str, str]]) -> DataFrame:
        return rows.select(F.col("key").alias("key2"), F.col("root").alias("root2"), *(F.col(c).alias(d) for c, d in cols))

    mixed = (F.min("root").over(by_key) != F.max("root").over(by_key)).alias("mixed")
    split = materialize(placed(singles).select("*", mixed).filter("mixed").drop("mixed"), "split-singles")
    several = placed(combined).groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi").select("key")
    crowd = materialize(placed(combined).join(several, "key"), "split-pairs")
    release(singles, combined, roots)
    one = split.join(second(split, plain), (F.col("key") == F.col("key2")) & apart & meeting(rule))
    two = crowd.join(second(crowd, sketched), (F.col("key") == F.col("key2")) & apart & meeting(rule) & brief_differences(rule))
    late = linked(one, two)
    found = components(links.unionByName(late))
    named = classes.select("sid", "cid")
    both = found.join(named.withColumnRenamed("sid", "v"), "v").join(named.select(F.col("sid").alias("root"), F.col("cid").alias("root_cid")), "root")
    out = materialize(both.select("cid", F.col("root_cid").alias("root")), "class-roots")
    release(split, crowd, links, late, classes, found)
    return rows, out


def jaccard_components(docs: DataFrame, rule: Rule, frequent: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_shingles, component_id`` of every row."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows, found = jaccard_classes(source, rule, frequent)
    placed = rows.join(found, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    smallest = placed.filter("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    out = placed.join(smallest, "root", "left")
    return out.select(F.col("doc_id").alias(id_col), F.col("n_shingles").cast("long").alias("n_shingles"),
                      F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def keep_one(docs: DataFrame, rule: Rule, frequent: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the row with the smallest id stays.

    Rows with an empty set all stay.  Of rows with one id and one text that are
    to stay, one does.  The rows that go are found by id and text hash, so texts
    are shuffled only when the list of these rows is too large to broadcast.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows, found = jaccard_classes(source, rule, frequent)
    placed = rows.filter("cid IS NOT NULL").join(found, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")
    stays = placed.groupBy("root").agg(F.min(place).alias("stays"))
    each = placed.select("root", place.alias("place")).groupBy("root", "place").agg(F.count(F.lit(1)).alias("copies"))
    gone = each.join(stays, "root").select("place.doc_id", "place.text_hash", "copies", (F.col("place") == F.col("stays")).alias("stays"))
    listed = materialize(gone.filter(~F.col("stays") | (F.col("copies") > 1)), "near-copies")
    release(rows, found)
    names = docs.columns
    d, h, again = (fresh(names, n) for n in ("copy_id", "copy_hash", "copy_again"))
    side = small_side(listed.select(F.col("doc_id").alias(d), F.col("text_hash").alias(h), F.col("stays").alias(again)), 40)
    joined = docs.join(side, F.col(id_col).eqNullSafe(F.col(d)) & (F.xxhash64(text_col) == F.col(h)), "left")
    first = joined.filter(F.col(again)).dropDuplicates([d, h])
    return joined.filter(F.col(again).isNull()).unionByName(first).select(*(F.col(f"`{n}`") for n in names))
