"""Line dedup by a log-template tree (operator 1).

Every line is placed in a tree of fixed depth: by its number of tokens, then by
its first ``DEPTH`` tokens; tokens with a digit are variable and stand as
``<*>``. A line is cut into ``SEGMENTS`` runs of tokens, or one token a segment if
it has fewer, and two lines of a leaf are alike if at least ``SIMILAR`` of their
segments are the same; one share for all lengths. Segments are kept as hashes, so
a line takes the same room whatever its length.

A template is a leaf with some places left out; the line of the smallest document
among those that agree in all other places stands for it. A line that has a
template whose first line is alike, and belongs to a document with a smaller
doc_id, recurs and is dropped. Places are ``GROUPS`` groups of neighbouring
segments; as many are left out as segments may differ, in every combination, so two
alike lines always share a template. Lines of up to ``GROUPS`` tokens that share one
are alike; of longer ones the segments are compared with those of the first line.
Lines of fewer than ``MIN_TOKENS`` tokens are too short for the tree and recur only
as they are.

Scale: lines are first reduced to distinct masked lines (partial aggregation),
so a hot line is one row. A line is listed under each of its templates, that is
under its leaf and its places with every allowed set of variable ones left out,
with its smallest and largest doc_id, which are aggregated per template. A line is
compared with the first lines of its templates only, and a leaf of any size is
spread over all tasks. The join that brings the decisions back to the
documents can be split at a hot line (adaptive skew join). Texts are shuffled
once, by doc_id.

Defined results: null text is empty; lines of fewer than ``MIN_TOKENS`` tokens
and ``MIN_CHARS`` characters stay; rows with the same doc_id are one
document; rows with a null doc_id take no part and stay whole; a row whose text
is emptied keeps its row, with empty text; extra columns are kept; an empty
table gives an empty table.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillfeed.session import cut_lineage

DEPTH = 3
SEGMENTS = 16
GROUPS = 8  # places of a template
SIMILAR = 0.75  # share of the segments that alike lines have in common
MIN_TOKENS = 4
MIN_CHARS = 10  # shorter lines of fewer than MIN_TOKENS tokens stay
LONGEST = (DEPTH + 1) * SEGMENTS  # from here on no segment lies inside the leading tokens
SLICE = 500  # texts turned into Python objects at a time
_DIGIT = re.compile(rb"[0-9]")
_SEGS = [f"s{i}" for i in range(SEGMENTS)]
LINE_SCHEMA = "doc_id long, key long, leaf long, n int, " + ", ".join(f"{s} int" for s in _SEGS)
DROPPED = "__dropped_keys"
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def masked_tokens(line: bytes) -> list[bytes]:
    """The line's tokens, those with a digit as ``<*>`` unless that would leave
    less than half of them."""
    tokens = line.split()
    if not _DIGIT.search(line):
        return tokens
    masked = [b"<*>" if _DIGIT.search(t) else t for t in tokens]
    return masked if 2 * masked.count(b"<*>") <= len(masked) else tokens


def compared_tokens(line: bytes) -> list[bytes] | None:
    """The tokens by which a line is compared: masked ones, and those of a line too
    short for the tree as they are; None if the line takes no part."""
    tokens = masked_tokens(line)
    if len(tokens) >= MIN_TOKENS:
        return tokens
    tokens = line.split()
    return tokens if len(b" ".join(tokens).decode("utf-8", "surrogatepass")) >= MIN_CHARS else None


def line_key(tokens: list[bytes]) -> int:
    return xxhash.xxh3_64_intdigest(b" ".join(tokens)) - (1 << 63)


def leaf_of(tokens: list[bytes]) -> int:
    return xxhash.xxh3_64_intdigest(b"%d " % len(tokens) + b" ".join(tokens[:DEPTH])) - (1 << 63)


def segments_of(tokens: list[bytes]) -> list[int]:
    """A non-zero 32-bit hash per segment; 0 fills up a line with fewer tokens."""
    n = len(tokens)
    m = min(n, SEGMENTS)
    out = [((xxhash.xxh3_64_intdigest(b" ".join(tokens[i * n // m:(i + 1) * n // m])) & 0xFFFFFFFE) + 1) - (1 << 31) for i in range(m)]
    return [x or 1 for x in out] + [0] * (SEGMENTS - m)


def text_lines(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split(b"\n")


def document_lines(docs: DataFrame) -> DataFrame:
    """A row per document and distinct masked line, see LINE_SCHEMA."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(a, SLICE) for b in batches for a in range(0, b.num_rows, SLICE)):
            ids, keys, leaves, sizes, segs = array("q"), array("q"), array("q"), array("i"), array("i")
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen = set()
                for line in text_lines(text):
                    tokens = compared_tokens(line)
                    key = None if tokens is None else line_key(tokens)
                    if key is not None and key not in seen:
                        seen.add(key)
                        ids.append(doc_id)
                        keys.append(key)
                        leaves.append(leaf_of(tokens))
                        sizes.append(len(tokens))
                        segs.extend(segments_of(tokens))
            by_segment = np.array(segs, dtype=np.int32).reshape(-1, SEGMENTS).T.copy()
            cols = [np.array(c, dtype=np.int64) for c in (ids, keys, leaves)] + [np.array(sizes, dtype=np.int32), *by_segment]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["doc_id", "key", "leaf", "n", *_SEGS])

    usable = docs.selectExpr("cast(doc_id as long) doc_id", "text").where("doc_id is not null")
    return usable.mapInArrow(run, LINE_SCHEMA)


def variable_segments(n: int) -> int:
    """How many segments of alike lines of ``n`` tokens may differ."""
    m = min(n, SEGMENTS)
    return m - math.ceil(SIMILAR * m)


def group_of_segment(n: int) -> list[int]:
    """The place that each segment of a line of ``n`` tokens belongs to."""
    m = min(n, SEGMENTS)
    g = min(m, GROUPS)
    return [i * g // m for i in range(m)]


@lru_cache(maxsize=None)
def left_out(n: int) -> list[tuple[int, ...]]:
    """The sets of places that templates of lines of ``n`` tokens leave out; places
    inside the leading tokens are the same in a whole leaf and stay."""
    m = min(n, SEGMENTS)
    free = sorted({g for i, g in enumerate(group_of_segment(n)) if (i + 1) * n // m > DEPTH})
    return list(combinations(free, min(variable_segments(n), len(free))))


def template_keys(leaf: np.ndarray, n: int, segments: np.ndarray) -> np.ndarray:
    """The templates of each line (a row of ``segments``): one per set of places
    left out. From LONGEST tokens on, all lengths leave out the same sets."""
    place = np.arange(1, SEGMENTS + 1, dtype=np.uint64) * _M1
    mixed = _mix(segments.astype(np.int64).view(np.uint64) + place)
    total = leaf.astype(np.int64).view(np.uint64) + mixed.sum(axis=1, dtype=np.uint64)
    groups = np.array(group_of_segment(n))
    by_group = [mixed[:, np.flatnonzero(groups == g)].sum(axis=1, dtype=np.uint64) for g in range(groups.max() + 1)]
    keys = []
    for k, out in enumerate(left_out(min(n, LONGEST))):
        key = total + np.uint64(((k + 1) * int(_M2)) % (1 << 64))
        for g in out:
            key = key - by_group[g]
        keys.append(_mix(key))
    return np.stack(keys, axis=1).view(np.int64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _M2
    x = (x ^ (x >> np.uint64(29))) * _M1
    return x ^ (x >> np.uint64(32))


def leaf_templates(lines: DataFrame) -> DataFrame:
    """key, template, lo, hi: a row per template of each distinct line whose leaf
    has another one; ``lines`` has key, leaf, n, lo, hi and the segments."""
    sizes = cut_lineage(lines.groupBy("leaf").agg(F.count(F.lit(1)).alias("size")).where("size > 1"))
    placed = cut_lineage(lines.join(sizes, "leaf").select("leaf", "key", "lo", "hi", "n", *_SEGS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(a, SLICE) for b in batches for a in range(0, b.num_rows, SLICE)):
            leaf, key, lo, hi, n, *segs = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            length, segs = np.minimum(n, LONGEST), np.stack(segs, axis=1)
            for x in np.unique(length):
                at = length == x
                keys = template_keys(leaf[at], int(x), segs[at])
                each = keys.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in (key[at].repeat(each), keys.ravel(), lo[at].repeat(each), hi[at].repeat(each))],
                    names=["key", "template", "lo", "hi"])

    return placed.mapInArrow(run, "key long, template long, lo long, hi long")


def recurring_lines(lines: DataFrame) -> DataFrame:
    """key and ``keeper`` (the document that keeps the line) of all masked lines
    that stand in more than one document, or are alike the first line of a template
    of theirs that stands in another one."""
    distinct = cut_lineage(lines.groupBy("key").agg(
        F.max("leaf").alias("leaf"), F.max("n").alias("n"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"),
        *[F.max(s).alias(s) for s in _SEGS]))
    alike = leaf_templates(distinct)
    spread = cut_lineage(alike.groupBy("template").agg(F.min("lo").alias("keeper"), F.max("hi").alias("hi")).where("keeper < hi"))
    shared = cut_lineage(alike.select("key", "lo", "template").join(spread.select("template", "keeper"), "template"))
    first = shared.where("lo = keeper").groupBy("template").agg(F.min("key").alias("first"))
    pairs = shared.join(first, "template").where("key <> first").groupBy("key", "first").agg(F.min("keeper").alias("keeper"))
    mine = distinct.select("key", "n", *_SEGS)
    theirs = distinct.select(F.col("key").alias("first"), *[F.col(s).alias(f"first_{s}") for s in _SEGS])
    # Segments past the end of a short line are 0 in both and count for neither.
    same = sum(((F.col(s) == F.col(f"first_{s}")) & (F.col(s) != 0)).cast("int") for s in _SEGS)
    need = F.ceil(F.least(F.col("n"), F.lit(SEGMENTS)) * SIMILAR)
    by_template = pairs.join(mine, "key").join(theirs, "first").where(same >= need).select("key", "keeper")
    by_line = distinct.where("lo < hi").select("key", F.col("lo").alias("keeper"))
    return by_line.unionByName(by_template).groupBy("key").agg(F.min("keeper").alias("keeper"))


def mark_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the keys of the lines to drop in each row (null: none)."""
    lines = cut_lineage(document_lines(docs))
    recurring = cut_lineage(recurring_lines(lines))
    dropped = lines.select("doc_id", "key").join(recurring, "key").where("doc_id <> keeper")
    by_doc = cut_lineage(dropped.groupBy(F.col("doc_id").alias("__id")).agg(F.collect_set("key").alias(DROPPED)))
    return docs.join(by_doc, docs["doc_id"].cast("long") == by_doc["__id"], "left").drop(by_doc["__id"])


def strip_text(text: str | None, keys) -> tuple[str, int, int]:
    """Text without the lines of those keys, its number of lines before, and of dropped ones."""
    lines = text_lines(text)
    if keys is None:
        return text or "", len(lines), 0
    drop, kept = set(keys), []
    for line in lines:
        tokens = compared_tokens(line)
        if tokens is None or line_key(tokens) not in drop:
            kept.append(line)
    return b"\n".join(kept).decode("utf-8", "surrogatepass"), len(lines), len(lines) - len(kept)


def dedup_lines(docs: DataFrame) -> DataFrame:
    """doc_id, text without dropped lines, n_lines, n_dropped of each row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(a, SLICE) for b in batches for a in range(0, b.num_rows, SLICE)):
            rows = [strip_text(t, k) for t, k in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            cols = list(zip(*rows)) if rows else [()] * 3
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.int64(), pa.int64())))],
                names=["doc_id", "text", "n_lines", "n_dropped"])

    marked = mark_lines(docs.selectExpr("cast(doc_id as long) doc_id", "text"))
    return marked.select("doc_id", "text", DROPPED).mapInArrow(run, "doc_id long, text string, n_lines long, n_dropped long")


def filter_documents(docs: DataFrame, n_chars_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with all columns, dropped lines gone from ``text`` and the
    character count following; rows that lost all their text go."""
    names = docs.columns
    at = names.index("text")
    chars_at = names.index(n_chars_col) if n_chars_col in names else None
    marked = mark_lines(docs).select(*[F.col(f"`{c}`") for c in names], DROPPED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(a, SLICE) for b in batches for a in range(0, b.num_rows, SLICE)):
            texts = [strip_text(t, k) for t, k in zip(batch.column(at).to_pylist(), batch.column(len(names)).to_pylist())]
            stay = [not dropped or bool(text.strip()) for text, _, dropped in texts]
            batch = batch.select(list(range(len(names)))).filter(pa.array(stay, pa.bool_()))
            new = [t if d else None for (t, _, d), s in zip(texts, stay) if s]
            cols = list(batch.columns)
            old = cols[at].to_pylist()
            cols[at] = pa.array([o if t is None else t for o, t in zip(old, new)], batch.schema.field(at).type)
            if chars_at is not None:
                counts = cols[chars_at].to_pylist()
                cols[chars_at] = pa.array([c if t is None else len(t) for c, t in zip(counts, new)], batch.schema.field(chars_at).type)
            yield pa.RecordBatch.from_arrays(cols, schema=batch.schema)

    return marked.mapInArrow(run, docs.schema)

