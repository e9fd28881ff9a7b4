"""Conversation prefix trie by ternary search trees over range shards (operator 11).

A node of the trie is a distinct sequence of a conversation's first d turns. The
conversations that start with it are its members.

1. Distinct turns (role, text) are sorted and numbered; a conversation becomes
   the array of its turns' numbers.
2. The arrays are sorted and dealt by range of (array, conv_id) into shards, so a
   sequence that many conversations share may fill several shards. Each shard
   inserts its distinct sequences into a ternary search tree, medians first, and
   an iterative traversal adds up members, leaves and savings.
3. Only nodes on the path of a shard's first or last sequence can exist in another
   shard. They leave the shard as partial rows and are merged: neighbouring shards
   hold the same node where their facing sequences agree to that depth. What is
   known only after the merge (is it a leaf, what does it save) is added along the
   paths, so the work is a few rows per shard and depth.

A shard holds about ``shard_turns`` turns. One conversation's turn numbers are held
as one array, as its text would be. SHA-256 is sequential: the ids of conversations
that end at one node are hashed in one task, but streamed there in pieces, never
held together.

Defined results: null role or text is empty; null turns come first and turns with
equal number are ordered by role, then text; repeated rows are turns of their own;
rows without conv_id take no part; extra columns are ignored; an empty table gives
no rows (not even a root).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillfeed.session import cut_lineage

SHARD_TURNS = 200_000
PIECE = 600  # conversation ids in a piece of an id list
OUT_ROWS = 20_000  # rows that a shard hands back at once
THROUGH, FIRST, LAST = 0, 1, 2  # sides of a shard: on both paths, on the first, on the last
NODE_SCHEMA = (
    "kind int, shard int, depth int, side int, parent_side int, turn long, words long, conv_id long, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long, piece int, ends string"
)
INNER, EDGE, ENDS = 0, 1, 2  # kinds of rows: complete node, partial node, piece of a partial node's id list
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


class TernaryTree:
    """Ternary search tree over integer symbols. Node i has the symbol ``sym[i]``,
    smaller and larger symbols of the same place below ``lo[i]`` and ``hi[i]``, and
    what follows the symbol below ``eq[i]`` (-1: none). Node 0 is the root, the
    empty prefix; its followers hang below ``eq[0]``."""

    def __init__(self):
        self.sym, self.lo, self.eq, self.hi, self.up = [None], [-1], [-1], [-1], [-1]

    def _node(self, symbol: int, up: int) -> int:
        for column, value in zip((self.sym, self.lo, self.eq, self.hi, self.up), (symbol, -1, -1, -1, up)):
            column.append(value)
        return len(self.sym) - 1

    def insert(self, symbols: list[int]) -> list[int]:
        """The nodes of all prefixes, the root first; ``up`` of a node is its prefix's node."""
        sym, lo, eq, hi = self.sym, self.lo, self.eq, self.hi
        at, path = 0, [0]
        for s in symbols:
            here, links, parent = eq[at], eq, at
            while here >= 0 and sym[here] != s:
                links, parent = (lo, here) if s < sym[here] else (hi, here)
                here = links[here]
            if here < 0:
                here = self._node(s, at)
                links[parent] = here
            at = here
            path.append(at)
        return path

    def path(self, symbols: list[int]) -> list[int]:
        """The nodes of all prefixes of an inserted sequence, the root first."""
        out = [0]
        for s in symbols:
            here = self.eq[out[-1]]
            while self.sym[here] != s:
                here = self.lo[here] if s < self.sym[here] else self.hi[here]
            out.append(here)
        return out

    def downwards(self) -> list[int]:
        """All nodes, each after its prefix."""
        out, todo = [], [0]
        while todo:
            at = todo.pop()
            out.append(at)
            todo.extend(x for x in (self.eq[at], self.lo[at], self.hi[at]) if x >= 0)
        return out


def medians_first(n: int) -> Iterator[int]:
    """0 .. n-1, the middle of each range before its halves."""
    todo = [(0, n)]
    while todo:
        a, b = todo.pop()
        if a < b:
            middle = (a + b) // 2
            yield middle
            todo += [(a, middle), (middle + 1, b)]


def shard_rows(shard: int, sequences: list[tuple[list[int], list[int]]], members: list[list[int]]) -> Iterator[tuple]:
    """Rows of NODE_SCHEMA of one shard: sorted distinct ``sequences`` of (turn
    numbers, words of each) and the ascending conversation ids of each."""
    tree = TernaryTree()
    end: dict[int, int] = {}  # node -> number of the sequence that ends there
    words: dict[int, int] = {0: 0}
    for i in medians_first(len(sequences)):
        symbols, n_words = sequences[i]
        path = tree.insert(symbols)
        end[path[-1]] = i
        words.update(zip(path[1:], n_words))
    order = tree.downwards()
    n = len(order)
    depth = [0] * n
    n_convs, least, children = [0] * n, [None] * n, [0] * n
    leaves, saved = [0] * n, [0] * n
    first, last = tree.path(sequences[0][0]), tree.path(sequences[-1][0])
    shared = 0
    while shared < min(len(first), len(last)) and first[shared] == last[shared]:
        shared += 1
    side = {x: THROUGH if d < shared else FIRST for d, x in enumerate(first)}
    side |= {x: THROUGH if d < shared else LAST for d, x in enumerate(last)}
    for x in order[1:]:
        depth[x] = depth[tree.up[x]] + 1
    for x in reversed(order):  # every node after the nodes below it
        if x in end:
            ids = members[end[x]]
            n_convs[x] += len(ids)
            least[x] = ids[0] if least[x] is None else min(ids[0], least[x])
        if x not in side:
            leaves[x] += not children[x]
            saved[x] += (n_convs[x] - 1) * words[x]
        if x:
            up = tree.up[x]
            n_convs[up] += n_convs[x]
            least[up] = least[x] if least[up] is None else min(least[up], least[x])
            leaves[up] += leaves[x]
            saved[up] += saved[x]
            children[up] += x not in side  # those on a path are counted after the merge
    for x in order:
        up = tree.up[x]
        ids = members[end[x]] if x in end else []
        above = side.get(up) if x else None
        if x not in side:
            digest = hashlib.sha256()
            for a in range(0, len(ids), PIECE):
                digest.update((("," if a else "") + ",".join(map(str, ids[a:a + PIECE]))).encode())
            yield (INNER, shard, depth[x], None, above, None, None, least[x], least[up] if above is None else None,
                   n_convs[x], children[x], leaves[x], saved[x], None, digest.hexdigest())
            continue
        yield (EDGE, shard, depth[x], side[x], above, tree.sym[x], words[x], least[x], None,
               n_convs[x], children[x], leaves[x], saved[x], None, None)
        for k, a in enumerate(range(0, len(ids), PIECE)):
            yield (ENDS, shard, depth[x], side[x], None, None, None, None, None, None, None, None, None, k,
                   ",".join(map(str, ids[a:a + PIECE])))


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One shard: its rows come sorted by (turns, conv_id)."""
    shard = TaskContext.get().partitionId()
    sequences, members, last = [], [], None
    for batch in batches:
        for conv, turns, words in zip(batch.column("conv_id").to_pylist(), batch.column("turns"), batch.column("words")):
            turns = turns.as_py()
            if turns != last:
                sequences.append((turns, words.as_py()))
                members.append([])
                last = turns
            members[-1].append(conv)
    if not sequences:
        return
    schema = pa.schema([(c, {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}[t])
                        for c, t in (x.split() for x in NODE_SCHEMA.split(", "))])
    rows = []
    for row in shard_rows(shard, sequences, members):
        rows.append(row)
        if len(rows) >= OUT_ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), schema.types)], schema=schema)
            rows = []
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), schema.types)], schema=schema)


def encoded_turns(conversations: DataFrame) -> DataFrame:
    """conv_id and ``turns``, an array of (turn, id, words) in the order of the
    conversation. Equal (role, text) have equal ids, in the order of (role, text)."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).where("conv_id is not null")
    # The role's length first: no two (role, text) give the same string.
    spelt = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    bits = 256
    while True:
        key = F.unhex(F.sha2(spelt, bits)).alias("key")
        distinct = rows.select(key, "role", "text").distinct()
        distinct = distinct.repartitionByRange("role", "text").sortWithinPartitions("role", "text")
        dictionary = cut_lineage(distinct.select(
            "key", F.monotonically_increasing_id().alias("id"),
            F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words")))
        if bits == 512 or dictionary.groupBy("key").count().where("count > 1").isEmpty():
            break
        bits = 512
    turns = rows.select("conv_id", "turn", key).join(dictionary, "key").select("conv_id", F.struct("turn", "id", "words").alias("t"))
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def rebuilt_conversations(conversations: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """conv_id, turns, words: the first h turns of conversation c - c % every, then
    c's own turns after its first h, with h = crc32(c) % most."""
    own = cut_lineage(encoded_turns(conversations))
    heads = own.select(F.col("conv_id").alias("base"), F.slice("turns", 1, most).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    own = own.select("conv_id", "turns", h.alias("h"), F.expr(f"conv_id - conv_id % {every}L").alias("base"))
    joined = own.join(heads.where(F.col("base") % every == 0), "base", "left")
    both = F.expr("concat(slice(coalesce(head, slice(turns, 1, 0)), 1, h), slice(turns, h + 1, size(turns)))")
    return joined.select("conv_id", both.alias("t")).select(
        "conv_id", F.col("t.id").alias("turns"), F.col("t.words").alias("words"))


def _streamed_sha(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per (depth, node) the hash of its pieces, which come in order."""
    at, digest = None, None

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([at[0]], pa.int32()), pa.array([at[1]], pa.int64()), pa.array([digest.hexdigest()])],
            names=["depth", "node", "ends_sha256"])

    for batch in batches:
        for depth, node, ends in zip(*(batch.column(c).to_pylist() for c in ("depth", "node", "ends"))):
            if (depth, node) != at:
                if at:
                    yield out()
                at, digest = (depth, node), hashlib.sha256()
                digest.update(ends.encode())
            else:
                digest.update(b"," + ends.encode())
    if at:
        yield out()


def merged_edges(edges: DataFrame, ends: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The partial rows of all shards as (shard, depth, side, node), where a node of
    several shards has one number per depth, and the merged nodes."""
    # A shard's row at its front meets the row at the back of the shard before it.
    shards = edges.select("shard").distinct()
    before = shards.withColumn("before", F.lag("shard").over(Window.orderBy("shard")))  # one row per shard
    front = edges.where(F.col("side") != LAST).select("shard", "depth", "turn").join(before, "shard")
    back = edges.where(F.col("side") != FIRST).select(F.col("shard").alias("before"), "depth", F.col("turn").alias("turn_before"))
    along = Window.partitionBy("shard").orderBy("depth")
    met = front.join(back, ["before", "depth"], "left").withColumn(
        "same", F.min(F.coalesce(F.when(F.col("depth") == 0, F.col("before").isNotNull()).otherwise(
            F.col("turn") == F.col("turn_before")), F.lit(False))).over(along))
    rows = edges.join(met.select("shard", "depth", "same"), ["shard", "depth"], "left")
    starts = (F.col("side") == LAST) | ~F.coalesce("same", F.lit(False))
    across = Window.partitionBy("depth").orderBy("shard", "side")
    rows = cut_lineage(rows.withColumn("starts", starts).withColumn("node", F.sum(F.col("starts").cast("long")).over(across)))

    # Children on a path are counted once, by the row that starts them.
    upper = rows.select("shard", (F.col("depth") + 1).alias("depth"), F.col("side").alias("parent_side"), F.col("node").alias("parent_node"))
    owners = rows.where("starts and depth > 0").join(upper, ["shard", "depth", "parent_side"])
    below = owners.groupBy((F.col("depth") - 1).alias("depth"), F.col("parent_node").alias("node")).agg(F.count(F.lit(1)).alias("more"))
    total = rows.groupBy("depth", "node").agg(
        F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.sum("n_children").alias("inner"),
        F.max("words").alias("words"))
    total = total.join(below, ["depth", "node"], "left").withColumn("n_children", F.col("inner") + F.coalesce("more", F.lit(0)))
    own = total.select("depth", "node", "n_convs", "conv_id", "n_children", (F.col("n_children") == 0).cast("long").alias("leaf"),
                       ((F.col("n_convs") - 1) * F.col("words")).alias("saving"))
    own = cut_lineage(own)

    # What a merged node is worth itself is added at its first row and summed up each path.
    worth = rows.join(own.select("depth", "node", "leaf", "saving"), ["depth", "node"])
    worth = worth.select("shard", "depth", "side", "node", "n_leaves", "saved_tokens",
                         *(F.when(F.col("starts"), F.col(c)).otherwise(0).alias(c) for c in ("leaf", "saving")))
    whole = Window.partitionBy("shard").orderBy(F.col("depth").desc()).rangeBetween(Window.unboundedPreceding, 0)
    one = Window.partitionBy("shard", "side").orderBy(F.col("depth").desc()).rangeBetween(Window.unboundedPreceding, 0)
    for c in ("leaf", "saving"):
        worth = worth.withColumn(f"{c}_below", F.when(F.col("side") == THROUGH, F.sum(c).over(whole)).otherwise(F.sum(c).over(one)))
    subtree = worth.groupBy("depth", "node").agg(F.sum(F.col("n_leaves") + F.col("leaf_below")).alias("n_leaves"),
                                                 F.sum(F.col("saved_tokens") + F.col("saving_below")).alias("saved_tokens"))
    parents = rows.where("starts").join(upper, ["shard", "depth", "parent_side"], "left").select("depth", "node", "parent_node")
    named = own.select(F.col("depth") + 1, F.col("node"), F.col("conv_id")).toDF("depth", "parent_node", "parent_conv_id")
    pieces = ends.join(rows.select("shard", "depth", "side", "node"), ["shard", "depth", "side"])
    pieces = pieces.select("depth", "node", "shard", "piece", "ends").repartition("depth", "node")
    hashes = pieces.sortWithinPartitions("depth", "node", "shard", "piece").mapInArrow(
        _streamed_sha, "depth int, node long, ends_sha256 string")
    merged = (own.join(subtree, ["depth", "node"]).join(parents, ["depth", "node"]).join(named, ["depth", "parent_node"], "left")
              .join(hashes, ["depth", "node"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY_SHA))))
    return rows.join(own.select("depth", "node", F.col("conv_id").alias("least")), ["depth", "node"]).select(
        "shard", "depth", "side", "least"), merged.select(COLUMNS)


def prefix_trie(sequences: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """All trie nodes of ``sequences`` (conv_id, turns, words), see COLUMNS."""
    sequences = cut_lineage(sequences)
    size = sequences.agg(F.sum(F.size("turns")).alias("n"), F.count(F.lit(1)).alias("rows")).first()
    shards = max(1, -(-((size.n or 0) + size.rows) // shard_turns))
    dealt = sequences.repartitionByRange(shards, "turns", "conv_id").sortWithinPartitions("turns", "conv_id")
    nodes = cut_lineage(dealt.mapInArrow(_shards, NODE_SCHEMA))
    edges = nodes.where(F.col("kind") == EDGE).drop("kind", "parent_conv_id", "piece", "ends")
    ends = nodes.where(F.col("kind") == ENDS).select("shard", "depth", "side", "piece", "ends")
    rows, merged = merged_edges(edges, ends)
    # A complete node below a path takes its parent's smallest member from the merge.
    above = rows.select("shard", (F.col("depth") + 1).alias("depth"), F.col("side").alias("parent_side"), "least")
    inner = nodes.where(F.col("kind") == INNER).withColumnRenamed("ends", "ends_sha256")
    known = inner.where("parent_side is null")
    hanging = inner.where("parent_side is not null").drop("parent_conv_id").join(above, ["shard", "depth", "parent_side"])
    hanging = hanging.withColumnRenamed("least", "parent_conv_id")
    out = known.select(COLUMNS).unionByName(hanging.select(COLUMNS)).unionByName(merged)
    return out.withColumn("depth", F.col("depth").cast("long"))


def conversation_trie(conversations: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The prefix trie of the rebuilt conversations."""
    return prefix_trie(rebuilt_conversations(conversations), shard_turns)
