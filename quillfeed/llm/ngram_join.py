"""N-gram Jaccard self-join with a count-vector R-tree (operator 8).

A document's set holds the 64-bit hashes of its distinct word n-grams. Hashes
fall into ``GROUPS`` groups; the counts per group are a point, and the sum of
the coordinate minima of two points bounds the overlap of their sets.

1. Documents with equal sets are one class (one row from here on).
2. Two sets of the wanted similarity share one of their first
   ``n - ceil(t * n) + 1`` n-grams in any fixed order (the prefix filter). Each
   class is listed under these n-grams; classes under the same one are a block.
   Frequent n-grams come last in the order, so they seldom head a block; which
   ones are frequent is taken from a sample (one document in SAMPLE_EVERY, a list of
   bounded length) and changes only the size of the blocks, never the links.
3. Two rounds compare each block's members with one hub of the block. A pair
   whose bound reaches the needed overlap is verified on the real sets, and links
   are joined into components. A group of near copies becomes a star of links,
   not all its pairs.
4. What is still in different components meets in the R-tree of its block: members
   are packed by size into leaves with the largest counts of their points; only
   leaves, then points, whose bound reaches the needed overlap are taken. All
   pairs that survive are verified, first by a second, finer count vector with
   about as many groups as the set has members. A large block is cut into tiles: the members
   of the hub's component stay in one tile each, the others visit every tile. A
   pair that shares several blocks is taken in the one its first n-grams name.

Verification fetches sets only of documents in surviving pairs, found by a
Bloom filter of fixed size in front of the text scan. Nothing is capped: every
pair in different components that the bounds allow is verified.

Defined results: null text, or one without words, has an empty set and links
with nothing; rows with a null doc_id link with nothing and have a null
component; rows with one doc_id and different texts are different members;
extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillfeed.session import cut_lineage

SIZE = 3
PERCENT = 90
GROUPS = 128
SAMPLE_EVERY = 16  # one document in so many, about, tells which n-grams are frequent
FREQUENT = 3  # sampled documents that hold a frequent n-gram
FREQUENT_MOST = 1_000_000  # n-grams in the broadcast list
HEADS = 6  # smallest block keys of a class that decide which block owns a pair
TILE = 2_048
LEAF = 32
SMALL = 24  # blocks up to this many members are compared directly
BLOOM_WORDS = 1 << 17  # 64-bit words: 1 MB
SET_SCHEMA = "doc_id long, n int, cls long, prefix array<long>, counts binary, fine binary"
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_TABLE = bytes.maketrans(_UPPER, _LOWER)
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
CACHE_WORDS = 200_000
SLICE = 500  # texts turned into Python objects at a time


class Shingler:
    """Sorted distinct n-gram hashes of texts, with a bounded cache of word hashes."""

    def __init__(self, size: int = SIZE):
        self.size = size
        self.cache: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()
        if not words:
            return np.empty(0, np.uint64)
        cache = self.cache
        if len(cache) > CACHE_WORDS:
            cache.clear()
        try:
            ids = [cache[w] for w in words]
        except KeyError:
            for w in words:
                if w not in cache:
                    cache[w] = xxhash.xxh3_64_intdigest(w)
            ids = [cache[w] for w in words]
        h = np.array(ids, dtype=np.uint64)
        size = min(self.size, len(h))
        out = np.full(len(h) - size + 1, size, dtype=np.uint64)
        for k in range(size):
            out = (out ^ h[k:len(h) - size + 1 + k]) * _M1
            out ^= out >> np.uint64(29)
        out *= _M2
        out ^= out >> np.uint64(32)
        return np.unique(out)


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n + (-percent * n) // 100 + 1 if n else 0


def class_of(hashes: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(hashes.tobytes()) - (1 << 63)


def needed(a, b, percent: int = PERCENT):
    """Smallest overlap with which sets of sizes a and b are linked."""
    return -(-percent * (a + b) // (100 + percent))


def group_counts(hashes: np.ndarray, groups: int) -> bytes:
    """Counts over ``groups`` groups, in the narrowest type that holds them."""
    counts = np.bincount((hashes & np.uint64(groups - 1)).astype(np.int64), minlength=groups)
    return counts.astype(np.uint8 if counts.max() < 1 << 8 else np.uint16 if counts.max() < 1 << 16 else np.uint32).tobytes()


def fine_counts(hashes: np.ndarray) -> bytes:
    """Counts over about as many groups as the set has members, a byte each;
    empty if one does not fit a byte."""
    groups = 1 << max(5, (len(hashes) - 1).bit_length() - 1)
    counts = group_counts(hashes, groups)
    return counts if len(counts) == groups else b""


def read_counts(data: bytes) -> np.ndarray:
    """The GROUPS counts written by :func:`group_counts`."""
    return np.frombuffer(data, f"<u{len(data) // GROUPS}").astype(np.int64)


def fine_overlap(a: bytes, b: bytes) -> int | None:
    """Bound of the overlap by the summed minima of two fine count vectors (the
    longer one folded to the shorter one's groups); None if one is missing."""
    if not a or not b:
        return None
    x, y = (np.frombuffer(v, np.uint8).astype(np.int64) for v in (a, b))
    g = min(len(x), len(y))
    return int(np.minimum(x.reshape(-1, g).sum(axis=0), y.reshape(-1, g).sum(axis=0)).sum())


def coarse_overlap(a: bytes, b: bytes) -> int:
    return int(np.minimum(read_counts(a), read_counts(b)).sum())


def document_sets(docs: DataFrame, frequent: np.ndarray, size: int, percent: int) -> DataFrame:
    """Per row: size of the set, its class, prefix and group counts."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)  # at most FREQUENT_MOST longs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, often = Shingler(size), shared.value
        for batch in (b.slice(a, SLICE) for b in batches for a in range(0, b.num_rows, SLICE)):
            n, cls, prefix, counts, fine = [], [], [], [], []
            for text in batch.column(1).to_pylist():
                h = shingles(text)
                n.append(len(h))
                if not len(h):
                    cls.append(None)
                    prefix.append([])
                    counts.append(b"")
                    fine.append(b"")
                    continue
                fine.append(fine_counts(h))
                cls.append(class_of(h))
                counts.append(group_counts(h, GROUPS))
                p = prefix_length(len(h), percent)
                if len(often):
                    at = np.searchsorted(often, h)
                    at[at == len(often)] = 0
                    is_often = often[at] == h
                    h = np.concatenate([h[~is_often][:p], h[is_often][:p]])
                prefix.append(h[:p].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int32()), pa.array(cls, pa.int64()), pa.array(prefix, pa.list_(pa.int64())),
                 pa.array(counts, pa.binary()), pa.array(fine, pa.binary())],
                names=["doc_id", "n", "cls", "prefix", "counts", "fine"])

    return docs.mapInArrow(run, SET_SCHEMA)


def frequent_ngrams(docs: DataFrame, size: int) -> np.ndarray:
    """Sorted hashes of n-grams that FREQUENT or more of the sampled documents hold,
    at most FREQUENT_MOST of them. Only the order of prefixes depends on them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(size)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(shingles(text).view(np.int64))], names=["h"])

    sample = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE_EVERY)) == 0).select("text")
    counted = sample.mapInArrow(run, "h long").groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= FREQUENT)
    top = counted.orderBy(F.col("n").desc(), "h").limit(FREQUENT_MOST).select("h")
    return np.sort(top.toArrow().column("h").to_numpy().astype(np.int64).view(np.uint64))


# -- verification ----------------------------------------------------------------
def fetch_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """cls and set of the documents whose doc_id may be among ``wanted`` (column
    rep); a Bloom filter of BLOOM_WORDS words lets few others through."""
    key = F.col("rep")
    word = F.pmod(F.xxhash64(key), F.lit(BLOOM_WORDS))
    mask = _mask(F.xxhash64(key, F.lit(1)))
    # At most BLOOM_WORDS rows of two longs: the broadcast has a fixed bound.
    bits = wanted.select(word.alias("word"), mask.alias("mask")).groupBy("word").agg(F.bit_or("mask").alias("bits"))
    mine = F.pmod(F.xxhash64("doc_id"), F.lit(BLOOM_WORDS))
    own = _mask(F.xxhash64("doc_id", F.lit(1)))
    near = docs.join(F.broadcast(bits), mine == F.col("word")).where(F.col("bits").bitwiseAND(own) == own).select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(size)
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                sets = [shingles(t) for t in batch.column(0).slice(a, 500).to_pylist()]
                sets = [s for s in sets if len(s)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([class_of(s) for s in sets], pa.int64()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
                    names=["cls", "hashes"])

    return near.mapInArrow(run, "cls long, hashes array<long>")


def _mask(h):
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(4)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def bounded(pairs: DataFrame, classes: DataFrame, percent: int, vector: str) -> DataFrame:
    """The pairs whose sizes, and whose bound by the count vectors in column
    ``vector`` (counts or fine), allow the needed overlap."""
    point = classes.select("cls", "n", vector)
    overlap = fine_overlap if vector == "fine" else coarse_overlap
    both = pairs.join(point.toDF("a", "na", "fa"), "a").join(point.toDF("b", "nb", "fb"), "b").select("a", "b", "na", "nb", "fa", "fb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for na, nb, fa, fb in zip(*(batch.column(i).to_pylist() for i in range(2, 6))):
                if 100 * min(na, nb) < percent * max(na, nb):
                    keep.append(False)
                    continue
                most = overlap(fa, fb)
                keep.append(most is None or most >= needed(na, nb, percent))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def verify(pairs: DataFrame, classes: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) of ``pairs`` that are linked: first by the fine count
    vectors' bound, then on the real sets."""
    pairs = cut_lineage(bounded(pairs, classes, percent, "fine"))
    ids = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    wanted = cut_lineage(ids.join(classes.select("cls", "rep"), "cls"))
    sets = cut_lineage(fetch_sets(docs, wanted, size).join(wanted.select("cls"), "cls", "left_semi"))
    left = pairs.join(sets.select(F.col("cls").alias("a"), F.col("hashes").alias("ha")), "a")
    both = left.join(sets.select(F.col("cls").alias("b"), F.col("hashes").alias("hb")), "b")
    common = F.size(F.array_intersect("ha", "hb"))
    total = F.size("ha") + F.size("hb") - common
    return both.where(100 * common >= percent * total).select("a", "b").distinct()


# -- components --------------------------------------------------------------------
def components(edges: DataFrame) -> DataFrame:
    """cls and comp (the smallest class reachable) of all classes in ``edges``:
    smallest label of the neighbours, then label of the label, until nothing changes."""
    both = cut_lineage(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    labels = cut_lineage(both.groupBy(F.col("a").alias("cls")).agg(F.min("b").alias("m")).select(
        "cls", F.least("cls", "m").alias("comp")))
    while True:
        near = both.join(labels.select(F.col("cls").alias("b"), "comp"), "b").groupBy(F.col("a").alias("cls")).agg(F.min("comp").alias("m"))
        step = cut_lineage(labels.join(near, "cls").select("cls", F.least("comp", "m").alias("comp"), F.col("comp").alias("old")))
        jump = step.select(F.col("cls").alias("comp"), F.col("comp").alias("far"))
        new = cut_lineage(step.join(jump, "comp").select("cls", F.least("comp", "far").alias("comp"), "old"))
        changed = new.where("comp <> old").limit(1).count()
        labels = new.select("cls", "comp")
        if not changed:
            return labels


# -- blocks --------------------------------------------------------------------------
def hub_pairs(members: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (hub, member) of ``members`` (cls, hub) that the bounds allow."""
    pairs = members.where("cls <> hub").select(F.least("cls", "hub").alias("a"), F.greatest("cls", "hub").alias("b")).distinct()
    return bounded(pairs, classes, percent, "counts")


def owned(key, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether block ``key`` is the one that takes the pairs of rows with these
    heads: the smallest head that both have is the owner, and without one every
    block that they share takes the pair."""
    common = (a[:, :, None] == b[:, None, :]).any(axis=2)
    owner = np.where(common, a, np.iinfo(np.int64).max).min(axis=1)
    return ~common.any(axis=1) | (owner == key)


def tree_pairs(ids, comps, sizes, counts, asks, heads, key, percent: int = PERCENT) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one block tile in different components that the R-tree's
    bounds allow. ``asks`` marks the rows that search (the others are only found)."""
    order = np.argsort(sizes, kind="stable")
    starts = np.arange(0, len(order), LEAF)
    leaf_max = np.maximum.reduceat(counts[order], starts, axis=0)
    leaf_low, leaf_high = sizes[order][starts], sizes[order][np.minimum(starts + LEAF, len(order)) - 1]
    node = np.arange(0, len(starts), 16)
    node_max = np.maximum.reduceat(leaf_max, node, axis=0)
    node_low, node_high = np.minimum.reduceat(leaf_low, node), np.maximum.reduceat(leaf_high, node)
    one_comp = np.array([comps[order[s:s + LEAF]].min() if comps[order[s:s + LEAF]].min() == comps[order[s:s + LEAF]].max() else 0 for s in starts])

    def fits(q, low, high, top):
        size = sizes[q]
        ok = (100 * low <= 100 * (100 * size // percent)) & (100 * high >= percent * size)
        smallest = np.maximum(low, -(-percent * size // 100))
        return ok & ((100 + percent) * np.minimum(counts[q], top).sum(axis=1) >= percent * (size + smallest))

    out = []
    for q in np.flatnonzero(asks):
        for k in np.flatnonzero(fits(q, node_low, node_high, node_max)):
            span = slice(16 * k, 16 * k + 16)
            leaves = 16 * k + np.flatnonzero(fits(q, leaf_low[span], leaf_high[span], leaf_max[span]) & (one_comp[span] != comps[q]))
            for leaf in leaves:
                x = order[leaf * LEAF:(leaf + 1) * LEAF]
                x = x[(comps[x] != comps[q]) & (~asks[x] | (ids[x] > ids[q]))]
                if len(x):
                    x = x[fits(q, sizes[x], sizes[x], counts[x])]
                    x = x[owned(key, heads[x], heads[[q]].repeat(len(x), axis=0))]
                    out.append((np.full(len(x), q), x))
    return out


def block_pairs(members: DataFrame, classes: DataFrame, labels: DataFrame, percent: int, tile: int = TILE,
                small_block: int = SMALL) -> DataFrame:
    """All pairs of one block in different components that the bounds allow."""
    placed = members.select("key", "cls", "hub").join(labels, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    hubs = labels.select(F.col("cls").alias("hub"), F.col("comp").alias("hub_comp"))
    placed = cut_lineage(placed.join(hubs, "hub", "left").withColumn("hub_comp", F.coalesce("hub_comp", "hub")))
    stats = cut_lineage(placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("rows"))
                        .where("lo <> hi").select("key", F.ceil(F.col("rows") / tile).cast("int").alias("tiles")))
    open_ = placed.join(stats, "key").select("key", "cls", "comp", "tiles", (F.col("comp") != F.col("hub_comp")).alias("asks"))
    home = F.pmod(F.xxhash64("cls"), F.col("tiles")).cast("int")
    spread = open_.withColumn("home", home).withColumn(
        "tile", F.explode(F.when(F.col("asks"), F.sequence(F.lit(0), F.col("tiles") - 1)).otherwise(F.array("home"))))
    keys = members.groupBy("cls").agg(F.array_sort(F.collect_set("key")).alias("k"))  # at most the class's prefix
    heads = [F.coalesce(F.get("k", F.lit(i)), F.get("k", F.lit(0))).alias(f"h{i}") for i in range(HEADS)]
    points = cut_lineage(classes.select("cls", "n", "counts").join(keys, "cls").select("cls", "n", "counts", *heads))
    full = spread.join(points, "cls").select(
        "key", "tile", "cls", "comp", "n", "counts", "asks", (F.col("tile") == F.col("home")).alias("here"),
        *[f"h{i}" for i in range(HEADS)])
    dealt = full.repartition("key", "tile").sortWithinPartitions("key", "tile", "cls")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for frame in frames:
            frame = pd.concat([rest, frame], ignore_index=True) if rest is not None else frame
            if frame.empty:
                continue
            last = ((frame["key"] == frame["key"].iat[-1]) & (frame["tile"] == frame["tile"].iat[-1])).to_numpy()
            yield compare(frame[~last])
            rest = frame[last]
        if rest is not None:
            yield compare(rest)

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"a": [], "b": []}, dtype="int64")
        if len(frame) < 2:
            return empty
        key, part = frame["key"].to_numpy(), frame["tile"].to_numpy()
        ids, comps, sizes = frame["cls"].to_numpy(), frame["comp"].to_numpy(), frame["n"].to_numpy().astype(np.int64)
        counts = np.stack([read_counts(c) for c in frame["counts"]])
        asks, here = frame["asks"].to_numpy(), frame["here"].to_numpy()
        heads = frame[[f"h{i}" for i in range(HEADS)]].to_numpy()
        edges = np.flatnonzero((key[1:] != key[:-1]) | (part[1:] != part[:-1])) + 1
        starts, ends = np.array([0, *edges]), np.array([*edges, len(frame)])
        small = ends - starts <= small_block
        group = np.repeat(np.arange(len(starts)), ends - starts)
        found = []
        # All small blocks at once: each row against the row `shift` places on.
        for shift in range(1, int((ends - starts)[small].max(initial=0))):
            i = np.flatnonzero((group[:-shift] == group[shift:]) & small[group[shift:]])
            j = i + shift
            # A visitor is compared with the rows at home here, and not a second time with another visitor.
            i, j = (x[(comps[i] != comps[j]) & (here[i] | here[j]) & (asks[i] | asks[j])] for x in (i, j))
            big, less = np.maximum(sizes[i], sizes[j]), np.minimum(sizes[i], sizes[j])
            ok = 100 * less >= percent * big
            i, j = i[ok], j[ok]
            ok = owned(key[i], heads[i], heads[j])
            i, j = i[ok], j[ok]
            ok = (100 + percent) * np.minimum(counts[i], counts[j]).sum(axis=1) >= percent * (sizes[i] + sizes[j])
            found.append((ids[i[ok]], ids[j[ok]]))
        for a, b in zip(starts[~small], ends[~small]):
            s = slice(a, b)
            for i, j in tree_pairs(ids[s], comps[s], sizes[s], counts[s], asks[s], heads[s], key[a], percent):
                ok = here[s][i] | here[s][j]
                found.append((ids[s][i[ok]], ids[s][j[ok]]))
        if not found:
            return empty
        a, b = (np.concatenate(x) for x in zip(*found))
        return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)}).drop_duplicates()

    return dealt.mapInPandas(run, "a long, b long").distinct()


# -- the join --------------------------------------------------------------------------
def link_classes(docs: DataFrame, size: int = SIZE, percent: int = PERCENT, tile: int = TILE, small_block: int = SMALL) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(row sets: doc_id, n, cls), (classes) and (labels: cls, comp) of ``docs`` (doc_id, text)."""
    docs = docs.selectExpr("cast(doc_id as long) doc_id", "text")
    rows = cut_lineage(document_sets(docs, frequent_ngrams(docs, size), size, percent))
    linked = rows.where("doc_id is not null and cls is not null")
    reps = linked.groupBy("cls").agg(F.min("doc_id").alias("rep"))
    classes = cut_lineage(linked.join(reps.withColumnRenamed("cls", "__cls"), (F.col("cls") == F.col("__cls")) & (F.col("doc_id") == F.col("rep")))
                          .select("cls", "rep", "n", "prefix", "counts", "fine"))
    listed = classes.select(F.explode("prefix").alias("key"), "cls")
    shared = cut_lineage(listed.groupBy("key").agg(F.min("cls").alias("hub"), F.max("cls").alias("far")).where("hub < far"))
    members = cut_lineage(listed.join(shared, "key"))

    links = cut_lineage(verify(cut_lineage(hub_pairs(members, classes, percent)), classes, docs, size, percent))
    labels = components(links)
    # A second hub for the members the first one did not reach.
    open_ = members.join(labels, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    first = labels.select(F.col("cls").alias("hub"), F.col("comp").alias("hub_comp"))
    apart = cut_lineage(open_.join(first, "hub", "left").where(F.col("comp") != F.coalesce("hub_comp", "hub"))
                        .select("key", "cls"))
    second = cut_lineage(apart.groupBy("key").agg(F.min(F.struct(F.xxhash64("cls").alias("h"), "cls")).alias("m"))
                         .select("key", F.col("m.cls").alias("hub")))
    pairs = cut_lineage(hub_pairs(apart.join(second, "key"), classes, percent))
    links = cut_lineage(links.unionByName(verify(pairs, classes, docs, size, percent)))
    labels = components(links)

    pairs = cut_lineage(block_pairs(members, classes, labels, percent, tile, small_block))
    links = links.unionByName(verify(pairs, classes, docs, size, percent))
    return rows.select("doc_id", "n", "cls"), classes, components(links)


def near_duplicates(docs: DataFrame, size: int = SIZE, percent: int = PERCENT, tile: int = TILE,
                    small_block: int = SMALL) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable by links)
    of each row of ``docs`` (doc_id, text)."""
    rows, classes, labels = link_classes(docs, size, percent, tile, small_block)
    named = classes.groupBy("cls").agg(F.min("rep").alias("rep")).join(labels, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    named = cut_lineage(named)
    smallest = named.groupBy("comp").agg(F.min("rep").alias("component_id"))
    by_class = cut_lineage(named.join(smallest, "comp").select("cls", "component_id"))
    # A row without a class (empty set or null id) is its own component.
    plain = rows.where("cls is null or doc_id is null").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    found = rows.where("cls is not null and doc_id is not null").join(by_class, "cls").select("doc_id", "n", "component_id")
    return found.unionByName(plain).select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id")



def filter_documents(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """``docs`` with all columns, one document (the smallest doc_id) of each
    component. Rows that share a doc_id count as one document, of which the row
    with the smallest text stays; rows with a null doc_id all stay."""
    found = near_duplicates(docs, size, percent)
    stays = cut_lineage(found.where("doc_id = component_id").select(F.col("doc_id").alias("__id")).distinct())
    names = [f"`{c}`" for c in docs.columns]
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    whole = F.struct("text", *[F.col(f"`{c}`") for c in others]).alias("__row")
    kept = docs.join(stays, F.col("doc_id").cast("long") == F.col("__id"), "left_semi").select("doc_id", whole)
    kept = kept.groupBy("doc_id").agg(F.min("__row").alias("__row"))
    kept = kept.select("doc_id", "__row.text", *[F.col(f"__row.`{c}`") for c in others]).select(*names)
    return kept.unionByName(docs.where("doc_id is null").select(*names))
