"""Cross-tokenizer alignment by sparse token-byte incidence matrices (operator 13).

Space + text is encoded by two tokenizers, A (a byte-level vocabulary file) and B
(a sentencepiece model, which adds the space itself). Each encoding is a matrix in
CSR form with a row per token, a column per byte and a one where the token holds
the byte. Gustavson's row products of A and the transpose of B give every pair of
tokens that overlap, with the number of shared bytes. Offsets where a token of
both ends cut the bytes into groups; the products of the token-group matrices
link all tokens of a group.

* Texts are taken in slices of about ``SLICE`` bytes whose matrices are block
  diagonal, so the product of many short texts is one pass over flat arrays.
* Slices are gathered into chunks of about ``CHUNK`` bytes. A chunk's row holds a
  CSR matrix documents x (A id, B id) with the number of links. The corpus-wide
  counts of id pairs are summed from the chunks' distinct pairs, joined back to
  them (a pair of ids that every chunk holds is one row per chunk, and Spark splits
  that join), and multiplied with the chunk's matrix. Links themselves are never
  shuffled.
* A group's links are counted from row lengths (the symbolic phase of the
  product); ``token_links`` lists them in slices, however large a group is.

Defined results: null and empty texts, and texts whose tokens do not spell their
bytes (such as those with U+2581), have no tokens: zeros and an empty string.
Null and repeated ids are rows of their own; extra columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillfeed.llm.packing import _byte_of_char
from quillfeed.session import cut_lineage

SLICE = 1_000_000  # bytes of text whose matrices are multiplied at once
CHUNK = 8_000_000  # bytes of text in a chunk
CHUNK_DOCS = 20_000  # documents in a chunk at most
LINKS_OUT = 200_000  # links handed back at once
SHIFT = 20  # an id pair's key: A id << SHIFT | B id
NUMBERS = ["n_a", "n_b", "n_groups", "n_links", "n_group_links"]
CHUNK_SCHEMA = ("chunk long, doc_id array<long>, " + ", ".join(f"{c} array<long>" for c in NUMBERS)
                + ", groups_sha256 array<string>, pairs binary, start binary, pair binary, links binary")
RESULT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
          "groups_sha256 string, n_group_links long")


class Csr:
    """A sparse matrix by rows: row i has the columns ``indices[indptr[i]:indptr[i + 1]]``
    with the values ``data`` at the same places."""

    def __init__(self, indptr: np.ndarray, indices: np.ndarray, data: np.ndarray, columns: int):
        self.indptr, self.indices, self.data, self.columns = indptr, indices, data, columns

    @classmethod
    def runs(cls, lengths: np.ndarray) -> Csr:
        """Row i holds the ``lengths[i]`` columns that follow those of row i - 1."""
        indptr = np.concatenate([[0], np.cumsum(lengths)])
        n = int(indptr[-1])
        return cls(indptr, np.arange(n, dtype=np.int32), np.ones(n, np.int32), n)

    @classmethod
    def labels(cls, label: np.ndarray, columns: int) -> Csr:
        """Row i holds the one column ``label[i]``."""
        n = len(label)
        return cls(np.arange(n + 1), label, np.ones(n, np.int32), columns)

    def rows(self) -> np.ndarray:
        """The row of each value."""
        return np.repeat(np.arange(len(self.indptr) - 1, dtype=np.int32), np.diff(self.indptr))

    def transpose(self) -> Csr:
        rows = self.rows()
        if (self.indices[1:] < self.indices[:-1]).any():
            order = np.argsort(self.indices, kind="stable")
            rows, data = rows[order], self.data[order]
        else:
            data = self.data
        indptr = np.concatenate([[0], np.cumsum(np.bincount(self.indices, minlength=self.columns))])
        return Csr(indptr, rows, data, len(self.indptr) - 1)

    def row_sizes(self, other: Csr) -> np.ndarray:
        """Symbolic phase of ``self @ other``: for each row the values that Gustavson's
        product visits, which is its size where no two of them share a column."""
        visits = np.concatenate([[0], np.cumsum(np.diff(other.indptr)[self.indices])])
        return np.diff(visits[self.indptr])

    def part(self, a: int, b: int) -> Csr:
        """Rows a to b - 1."""
        lo, hi = self.indptr[a], self.indptr[b]
        return Csr(self.indptr[a:b + 1] - lo, self.indices[lo:hi], self.data[lo:hi], self.columns)

    def multiply(self, other: Csr) -> Csr:
        """``self @ other``: each value in row i scales the row of ``other`` that its
        column names, and equal columns of row i are added up."""
        sizes = np.diff(other.indptr)[self.indices]
        row, at, value = self.rows(), other.indptr[self.indices], self.data
        if (sizes != 1).any():
            row, value = np.repeat(row, sizes), np.repeat(value, sizes)
            at = np.arange(len(row)) + np.repeat(at - (np.cumsum(sizes) - sizes), sizes)
        column, value = other.indices[at], value * other.data[at]
        if ((row[1:] == row[:-1]) & (column[1:] < column[:-1])).any():
            order = np.lexsort((column, row))
            row, column, value = row[order], column[order], value[order]
        new = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (column[1:] != column[:-1]))[:len(row)])
        row, column = row[new], column[new]
        value = np.add.reduceat(value, new) if len(new) else value[:0]
        n = len(self.indptr) - 1
        indptr = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n))])
        return Csr(indptr, column, value, other.columns)


class Vocabulary:
    """The bytes of every id: id i has ``length[i]`` bytes from ``flat[start[i]]`` on."""

    def __init__(self, spelt: list[bytes]):
        self.length = np.array([len(x) for x in spelt], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.flat = np.frombuffer(b"".join(spelt), np.uint8)

    def spell(self, ids: np.ndarray, tokens: Csr) -> np.ndarray:
        """The bytes of ``ids``, whose token-byte matrix is ``tokens``."""
        return self.flat[np.arange(len(tokens.indices)) + np.repeat(self.start[ids] - tokens.indptr[:-1], np.diff(tokens.indptr))]


@lru_cache(maxsize=2)
def byte_level(path: str):
    """encode(text) -> array of ids of the byte-level file at ``path`` with added
    tokens as plain text, and its vocabulary. The merges of such a file come in the
    order of their ids, so the rank encoder gives the same ids."""
    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
    added = {t["content"] for t in spec.get("added_tokens", [])}
    ids = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in merges]
    if (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel" or spec.get("normalizer") or ids != sorted(ids):
        raise ValueError(f"{path} is not a byte-level vocabulary in the order of its merges")
    byte_of = _byte_of_char()
    spelt = {i: bytes(byte_of[c] for c in token) for token, i in vocab.items() if token not in added}
    coder = tiktoken.Encoding("alignment", pat_str=public_tokenizers.PATTERN,
                              mergeable_ranks={b: i for i, b in spelt.items()}, special_tokens={})

    def encode(text: str) -> np.ndarray:
        return coder.encode_to_numpy(text, disallowed_special=())

    return encode, Vocabulary([spelt.get(i, b"") for i in range(max(spelt) + 1)])


@lru_cache(maxsize=2)
def pieces(path: str):
    """encode(texts) -> arrays of ids of the sentencepiece model, and its vocabulary."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)

    def spelt(i: int) -> bytes:
        piece = model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(array("I", ids), np.uint32) for ids in model.encode(texts, num_threads=1)]

    return encode, Vocabulary([spelt(i) for i in range(model.get_piece_size())])


class Slice:
    """The tokens of some texts, end to end, and the links between them."""

    def __init__(self, texts: list[str | None], path_a: str, path_b: str):
        encode_a, words_a = byte_level(path_a)
        encode_b, words_b = pieces(path_b)
        texts = [t or "" for t in texts]
        none = np.empty(0, np.int64)
        sides = [[encode_a(" " + t) if t else none for t in texts], encode_b(texts)]
        data = [(" " + t).encode() if t else b"" for t in texts]
        n_bytes = np.array([len(d) for d in data], np.int64)
        right = np.ones(len(texts), bool)
        for ids, words in zip(sides, (words_a, words_b)):
            right &= _spells(ids, words, data, n_bytes)
        for side in sides:
            side[:] = [ids if r else none for ids, r in zip(side, right.tolist())]
        self.n_a, self.n_b = (np.array([len(x) for x in y], np.int64) for y in sides)
        self.a, self.b = (np.concatenate([none, *y]).astype(np.int64) for y in sides)
        self.doc_a, self.doc_b = (np.repeat(np.arange(len(texts)), n) for n in (self.n_a, self.n_b))
        self.bytes_a, self.bytes_b = Csr.runs(words_a.length[self.a]), Csr.runs(words_b.length[self.b])
        # Offsets where both end cut the bytes into groups.
        ends_a, ends_b = self.bytes_a.indptr[1:], self.bytes_b.indptr[1:]
        end_a, end_b = np.zeros((2, len(self.bytes_a.indices) + 1), bool)
        end_a[ends_a], end_b[ends_b] = True, True
        self.last_a, self.last_b = end_b[ends_a], end_a[ends_b]  # tokens that close a group
        self.group_a, self.group_b = (np.cumsum(x) - x for x in (self.last_a, self.last_b))
        cuts = np.flatnonzero(self.last_a)
        self.groups_a, self.groups_b = Csr.labels(self.group_a, len(cuts)), Csr.labels(self.group_b, len(cuts))
        self.n_groups = np.bincount(self.doc_a[cuts], minlength=len(texts))

    def overlaps(self) -> Csr:
        """A tokens x B tokens: the bytes they share."""
        return self.bytes_a.multiply(self.bytes_b.transpose())

    def n_group_links(self) -> np.ndarray:
        """Per text the number of pairs of tokens in one group."""
        sizes = self.groups_a.row_sizes(self.groups_b.transpose())
        return np.bincount(self.doc_a, weights=sizes, minlength=len(self.n_a)).astype(np.int64)

    def shared_groups(self, most: int = LINKS_OUT) -> Iterator[tuple[int, Csr]]:
        """A tokens x B tokens with a one where they share a group, in parts of whole
        rows (the first row's number with each) of about ``most`` links."""
        other = self.groups_b.transpose()
        upto = np.cumsum(self.groups_a.row_sizes(other))
        a = 0
        while a < len(upto):
            b = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + most, "right")))
            yield a, self.groups_a.part(a, b).multiply(other)
            a = b

    def spelt_groups(self) -> list[str]:
        """Per text the hash of its groups' ids, ``a,a|b;a|b,b``."""
        before = np.append(0, np.flatnonzero(self.last_b) + 1)[self.group_a]  # B tokens in earlier groups
        after = np.append(np.flatnonzero(self.last_a) + 1, 0)[self.group_b]  # A tokens up to this group
        size = max(self.a.max(initial=0), self.b.max(initial=0)) + 1
        spelt = _numerals(1 << int(size).bit_length())
        words = np.empty(len(self.a) + len(self.b), np.int64)
        words[np.arange(len(self.a)) + before] = self.a * 3 + self.last_a  # "," or "|"
        words[np.arange(len(self.b)) + after] = self.b * 3 + 2 * self.last_b  # "," or ";"
        words = spelt[words]
        out, at = [], 0
        for n in (self.n_a + self.n_b).tolist():
            out.append(hashlib.sha256(b"".join(words[at:at + n].tolist())[:-1]).hexdigest() if n else "")
            at += n
        return out


@lru_cache(maxsize=2)
def _numerals(n: int) -> np.ndarray:
    """The digits of 0 .. n-1 with ``,``, ``|`` and ``;`` behind each."""
    out = np.empty(3 * n, object)
    out[:] = [f"{i}{sign}".encode() for i in range(n) for sign in ",|;"]
    return out


def _spells(ids: list[np.ndarray], words: Vocabulary, data: list[bytes], n_bytes: np.ndarray) -> np.ndarray:
    """For each text whether its tokens' bytes, end to end, are its own."""
    flat = np.concatenate([np.empty(0, np.int64), *ids]).astype(np.int64)
    tokens = Csr.runs(words.length[flat])
    upto = tokens.indptr[np.cumsum([len(x) for x in ids])] if ids else n_bytes
    right = np.diff(upto, prepend=0) == n_bytes
    if right.all():  # the usual case: equal lengths throughout
        wrong = np.flatnonzero(words.spell(flat, tokens) != np.frombuffer(b"".join(data), np.uint8))
        right[np.searchsorted(upto, wrong, "right")] = False
        return right
    return np.array([r and len(x) == 0 or r and words.spell(f := x.astype(np.int64), Csr.runs(words.length[f])).tobytes() == d
                     for r, x, d in zip(right, ids, data)])


def _sliced(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[list, list, int]]:
    """(ids, texts, bytes) of about ``most`` bytes each."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            texts.append(text.as_py())
            ids.append(doc)
            size += len(texts[-1] or "") + 50
            if size >= most:
                yield ids, texts, size
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts, size


def _narrow(x: np.ndarray) -> bytes:
    """Four bytes a value; a chunk has fewer pairs and links than that holds."""
    return x.astype("<u4").tobytes()


def _chunks(path_a: str, path_b: str):
    """One row per chunk, see CHUNK_SCHEMA."""

    def row(number: int, docs: list, columns: dict[str, list], keys: list, at: list, links: list) -> pa.RecordBatch:
        keys, at, links = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (keys, at, links))
        pairs, pair = np.unique(keys, return_inverse=True)
        start = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=len(docs)))])
        values = [number, docs, *(columns[c] for c in NUMBERS), columns["groups_sha256"],
                  pairs.astype("<i8").tobytes(), _narrow(start), _narrow(pair), _narrow(links)]
        kinds = [pa.int64(), *[pa.list_(pa.int64())] * (len(NUMBERS) + 1), pa.list_(pa.string()), *[pa.binary()] * 4]
        names = [x.split()[0] for x in CHUNK_SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, size = TaskContext.get().partitionId() << 32, 0
        docs: list = []
        columns: dict[str, list] = {c: [] for c in [*NUMBERS, "groups_sha256"]}
        keys, at, links = [], [], []
        for ids, texts, n in _sliced(batches, SLICE):
            s = Slice(texts, path_a, path_b)
            overlap = s.overlaps()
            a = overlap.rows()
            # Links per document and id pair.
            both = np.sort((s.doc_a[a] << 2 * SHIFT) | (s.a[a] << SHIFT) | s.b[overlap.indices])
            new = np.flatnonzero(np.append(True, both[1:] != both[:-1])[:len(both)])
            key, doc = both & ((1 << 2 * SHIFT) - 1), both >> 2 * SHIFT
            keys.append(key[new])
            at.append(doc[new] + len(docs))
            links.append(np.diff(np.append(new, len(key))))
            for c, v in zip(NUMBERS, (s.n_a, s.n_b, s.n_groups, np.bincount(doc, minlength=len(ids)), s.n_group_links())):
                columns[c] += v.tolist()
            columns["groups_sha256"] += s.spelt_groups()
            docs += ids
            size += n
            if size >= CHUNK or len(docs) >= CHUNK_DOCS:
                yield row(number, docs, columns, keys, at, links)
                number, size, docs, keys, at, links = number + 1, 0, [], [], [], []
                columns = {c: [] for c in columns}
        if docs:
            yield row(number, docs, columns, keys, at, links)

    return run


def _distinct_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk, pairs, pair, links in zip(*(batch.column(c).to_pylist() for c in ("chunk", "pairs", "pair", "links"))):
            key = np.frombuffer(pairs, "<i8")
            n = np.bincount(np.frombuffer(pair, "<u4"), np.frombuffer(links, "<u4"), len(key)).astype(np.int64)
            for i in range(0, len(key), LINKS_OUT):
                part = slice(i, i + LINKS_OUT)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key[part]), chunk)), pa.array(key[part]), pa.array(n[part])],
                                                 names=["chunk", "key", "n"])


def _weighed(chunks: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
    """The chunk's matrix times the counts, and times the marks of the best pairs."""
    out = []
    counts = counts.sort_values("key")
    known = counts["key"].to_numpy(np.int64)
    for r in chunks.itertuples(index=False):
        at = np.searchsorted(known, np.frombuffer(r.pairs, "<i8"))
        start, pair = np.frombuffer(r.start, "<u4").astype(np.int64), np.frombuffer(r.pair, "<u4")
        links = np.frombuffer(r.links, "<u4").astype(np.int64)
        frame = {"doc_id": pd.array(r.doc_id, dtype="Int64")} | {c: getattr(r, c) for c in [*NUMBERS, "groups_sha256"]}
        for name, weight in (("count_sum", "n"), ("n_best", "best")):
            w = counts[weight].to_numpy(np.int64)[at][pair] * links
            frame[name] = np.diff(np.concatenate([[0], np.cumsum(w)])[start])
        out.append(pd.DataFrame(frame))
    names = [x.split()[0] for x in RESULT.split(", ")]
    return pd.concat(out)[names] if out else pd.DataFrame(columns=names)


def align_documents(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per document, see RESULT."""
    docs = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    chunks = cut_lineage(docs.mapInArrow(_chunks(path_a, path_b), CHUNK_SCHEMA))
    pairs = chunks.select("chunk", "pairs", "pair", "links").mapInArrow(_distinct_pairs, "chunk long, key long, n long")
    counts = cut_lineage(pairs.groupBy("key").agg(F.sum("n").alias("n")).withColumn(
        "b", F.col("key").bitwiseAND(F.lit((1 << SHIFT) - 1))))
    best = cut_lineage(counts.groupBy("b").agg(F.max("n").alias("most")))
    weighed = counts.join(best, "b").select("key", "n", (F.col("n") == F.col("most")).cast("int").alias("best"))
    mine = pairs.select("chunk", "key").join(weighed, "key")
    return chunks.groupBy("chunk").cogroup(mine.groupBy("chunk")).applyInPandas(_weighed, RESULT)


def token_links(docs: DataFrame, path_a: str, path_b: str, kind: str = "overlap") -> DataFrame:
    """One row per link: doc_id, the places and ids of both tokens, and the bytes
    they share (``overlap``) or 1 (``group``: they stand in the same group)."""
    docs = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts, _ in _sliced(batches, SLICE):
            s = Slice(texts, path_a, path_b)
            first_a, first_b = (np.cumsum(n) - n for n in (s.n_a, s.n_b))
            for above, part in ([(0, s.overlaps())] if kind == "overlap" else s.shared_groups()):
                a = part.rows() + above
                for i in range(0, len(a), LINKS_OUT):
                    x, y, w = a[i:i + LINKS_OUT], part.indices[i:i + LINKS_OUT], part.data[i:i + LINKS_OUT]
                    doc = s.doc_a[x]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([ids[d] for d in doc.tolist()], pa.int64()), pa.array(x - first_a[doc], pa.int64()),
                         pa.array(y - first_b[doc], pa.int64()), pa.array(s.a[x], pa.int64()), pa.array(s.b[y], pa.int64()),
                         pa.array(w, pa.int64())],
                        names=["doc_id", "a_at", "b_at", "a_id", "b_id", "weight"])

    return docs.mapInArrow(run, "doc_id long, a_at long, b_at long, a_id long, b_id long, weight long")
