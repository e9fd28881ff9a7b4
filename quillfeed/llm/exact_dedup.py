"""Exact dedup by deterministic block naming (operator 12).

A document's text without the characters of ``[\\x20\\x09-\\x0D]`` is cut into
blocks of ``block`` bytes. The distinct blocks are sorted and get integer names;
then the names of adjacent pairs are named the same way, level by level, until
each document has one name. The last block of an odd sequence is paired with
NO_NAME. A name stands for exactly one sequence of blocks at its level, so
(level, name) is a document's identity, free of collisions.

* A block's content is shuffled once, to where it is sorted and named, after the
  copies within a task are merged. Names go back by a 128-bit digest of the
  block; the name table proves that no digest stands for two blocks, otherwise
  the digests are taken again with another seed.
* Sequences are kept as one row per (document row, position), so a long document
  is spread like any other. A pair is two neighbouring rows merged by a grouped
  maximum, and each level halves the rows.
* No group of equal documents is gathered: groups are counted and their best row
  picked by aggregates that merge within each task, and every document finds its
  group by a join, which Spark splits where one group is hot.

Defined results: null text is empty; empty texts are equal to one another. Of
equal texts the row with the most code points in the original text stays, then
the one with the smallest doc_id (null ids last), then the first one read; of
repeated rows therefore one is kept. ``keep_id`` is null where the row that stays
has no id. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillfeed.session import cut_lineage

BLOCK = 1_024  # bytes in a block
NO_NAME = -1  # stands in for the missing second name of an odd sequence
DIGEST = 16  # bytes of a block's digest
SLICE = 4_000_000  # bytes that a task hands back at once
SPACE = b" \t\n\x0b\x0c\r"


def digest(block: bytes, seed: int) -> bytes:
    return hashlib.blake2b(block, digest_size=DIGEST, key=seed.to_bytes(4, "little")).digest()


def normalised(text: str | None) -> bytes:
    return (text or "").encode().translate(None, SPACE)


def blocks_of(data: bytes, block: int) -> list[bytes]:
    """The blocks of ``data``; the empty text is one empty block."""
    return [data[i:i + block] for i in range(0, max(1, len(data)), block)]


def _signatures(block: int, seed: int, name: Callable[[bytes, int], bytes]):
    """Per document the digests of its blocks, end to end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, size = 0, 0
            n_chars, sha, sig = [], [], []
            for at, text in enumerate(batch.column("text"), 1):
                text = text.as_py()
                data = normalised(text)
                n_chars.append(len(text or ""))
                sha.append(hashlib.sha256(data).hexdigest())
                sig.append(b"".join(name(b, seed) for b in blocks_of(data, block)))
                size += len(sig[-1]) + 100
                if size >= SLICE or at == batch.num_rows:
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("row").slice(start, len(sig)), batch.column("doc_id").slice(start, len(sig)),
                         pa.array(n_chars, pa.int64()), pa.array(sha, pa.string()), pa.array(sig, pa.binary())],
                        names=["row", "doc_id", "n_chars", "text_sha256", "sig"])
                    start, size, n_chars, sha, sig = at, 0, [], [], []

    return run


def _blocks(block: int, seed: int, name: Callable[[bytes, int], bytes]):
    """Digest and content of the blocks, copies within a slice merged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(found: set[tuple[bytes, bytes]]) -> pa.RecordBatch:
            keys, contents = zip(*found)
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(contents, pa.binary())],
                                              names=["key", "content"])

        for batch in batches:
            found: set[tuple[bytes, bytes]] = set()
            size = 0
            for text in batch.column("text"):
                for b in blocks_of(normalised(text.as_py()), block):
                    found.add((name(b, seed), b))
                    size += len(b)
                if size >= SLICE:
                    yield out(found)
                    found, size = set(), 0
            if found:
                yield out(found)

    return run


def named(values: DataFrame, *by: str) -> DataFrame:
    """The distinct ``values``, dealt by hash, sorted by the columns ``by`` and
    numbered within each part: an integer ``name`` each. Written, so that every
    reader sees the same names."""
    numbered = values.distinct().sortWithinPartitions(*by).withColumn("name", F.monotonically_increasing_id())
    return cut_lineage(numbered.drop("content"))


def _block_names(docs: DataFrame, block: int, seed: int, name) -> DataFrame | None:
    """(key, name) per distinct block; None if two blocks share a digest."""
    names = named(docs.select("text").mapInArrow(_blocks(block, seed, name), "key binary, content binary"), "content")
    return names if names.groupBy("key").count().where("count > 1").isEmpty() else None


def identities(docs: DataFrame, block: int = BLOCK, name: Callable[[bytes, int], bytes] = digest) -> DataFrame:
    """row, doc_id, n_chars, text_sha256, level, name: rows with the same (level,
    name) have the same text, and others a different one."""
    docs = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    seed = 0
    while (names := _block_names(docs, block, seed, name)) is None:
        seed += 1
    signed = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").mapInArrow(
        _signatures(block, seed, name), "row long, doc_id long, n_chars long, text_sha256 string, sig binary")
    signed = cut_lineage(signed)
    most = signed.agg(F.max(F.octet_length("sig"))).first()[0] or 0
    left = F.expr(f"cast(octet_length(sig) div {DIGEST} as int)")
    at = signed.select("row", left.alias("left"), F.posexplode(F.sequence(F.lit(0), left - 1)).alias("pos", "i"), "sig")
    at = at.select("row", "left", "pos", F.substring("sig", F.col("i") * DIGEST + 1, F.lit(DIGEST)).alias("key"))
    # One row per document and position, with the name of what stands there.
    seq = at.join(names, "key").select("row", "left", "pos", "name")
    done, level = [], 0
    longest = most // DIGEST
    while longest > 1:
        # Neighbours meet; a document with one name left passes through once more.
        place = F.col("pos") % 2
        pairs = seq.groupBy("row", "left", F.floor(F.col("pos") / 2).cast("int").alias("pos")).agg(
            F.max(F.when(place == 0, F.col("name"))).alias("a"),
            F.coalesce(F.max(F.when(place == 1, F.col("name"))), F.lit(NO_NAME)).alias("b"))
        pairs = cut_lineage(pairs)
        done.append(pairs.where("left = 1").select("row", F.lit(level).alias("level"), F.col("a").alias("name")))
        pairs = pairs.where("left > 1")
        names = named(pairs.select("a", "b"), "a", "b")
        seq = pairs.join(names, ["a", "b"]).select("row", F.expr("(left + 1) div 2").cast("int").alias("left"), "pos", "name")
        longest = (longest + 1) // 2
        level += 1
    done.append(seq.select("row", F.lit(level).alias("level"), "name"))
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    return signed.drop("sig").join(found, "row")


def dedup_documents(docs: DataFrame, block: int = BLOCK, name: Callable[[bytes, int], bytes] = digest) -> DataFrame:
    """One row per document: row, doc_id, keep_id, group_size, kept, text_sha256,
    level, name. ``row`` numbers the rows of ``docs`` as they were read."""
    found = cut_lineage(identities(docs, block, name))
    # The largest of (length, id from the smallest, row from the first); a null id comes last.
    order = F.struct("n_chars", F.bitwise_not("doc_id").alias("id"), F.bitwise_not("row").alias("row"))
    groups = cut_lineage(found.groupBy("level", "name").agg(F.count(F.lit(1)).alias("group_size"), F.max(order).alias("best")))
    groups = groups.select("level", "name", "group_size", F.bitwise_not("best.id").alias("keep_id"),
                           F.bitwise_not("best.row").alias("keep_row"))
    out = found.join(groups, ["level", "name"])
    return out.select("row", "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
                      "text_sha256", "level", "name")


def filter_documents(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    numbered = cut_lineage(docs.withColumn("__row", F.monotonically_increasing_id()))
    judged = dedup_documents(numbered.select(F.col("__row").alias("doc_id"), "text"), block)
    return numbered.join(judged.where("kept").select(F.col("doc_id").alias("__row")), "__row", "left_semi").drop("__row")
