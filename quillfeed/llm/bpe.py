"""Byte-level BPE encoding and decoding (operator 2).

Each match of the split pattern ("piece") is encoded on its own. A segment tree
over the piece's byte positions holds, at every inner node, the leftmost minimum
pair rank below it; the root names the next merge. A merge rewrites the ranks
of the merged pair and of its live left neighbour, and clears the swallowed
position: three point updates of logarithmic cost each.

Short pieces (almost all) are encoded many at a time: their trees are the rows
of one numpy array, and each step performs one merge in every tree that still
has one. Long pieces use the same tree one at a time, so a text without white
space costs n log n.

Work is row-local (``mapInArrow``). Each Python worker keeps a cache of encoded
pieces; it is emptied when it holds ``CACHE_PIECES`` pieces, which changes the
time, never the result. The vocabulary file is read by its path on each worker.

Defined results: null text is encoded as the empty text (no ids); a null doc_id
passes through; repeated rows give repeated results; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

CACHE_PIECES = 600_000
BATCH_BYTES = 64  # pieces up to this long are encoded together
NONE = np.iinfo(np.int64).max  # rank of a position that starts no pair
ENCODED_SCHEMA = "doc_id long, ids array<int>, decoded binary"
DIGEST_SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class ByteBpe:
    """A rank vocabulary with vectorised pair lookup."""

    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.split = regex.compile(pattern).findall
        self.bytes_of: list[bytes] = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.bytes_of[rank] = token
        self.decimal = [str(i) for i in range(len(self.bytes_of))]
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        # Every way to put a token together from two tokens: (left, right) -> token.
        keys, out = [], []
        width = self.width = len(self.bytes_of)
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left * width + right)
                    out.append(rank)
        order = np.argsort(np.array(keys, dtype=np.int64))
        self.pair_keys = np.array(keys, dtype=np.int64)[order]
        self.pair_ranks = np.array(out, dtype=np.int64)[order]
        self.pairs = dict(zip(keys, out))
        self.cache: dict[str, tuple[int, ...]] = {}

    def pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each joined pair, NONE where the vocabulary has no such token."""
        key = left * self.width + right
        at = np.searchsorted(self.pair_keys, key)
        at[at == len(self.pair_keys)] = 0
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NONE)

    # -- many short pieces ---------------------------------------------------
    def encode_short(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """Encode pieces of 1 to BATCH_BYTES bytes; rows of a power-of-two width."""
        out: list[tuple[int, ...]] = [()] * len(pieces)
        by_width: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            by_width.setdefault(1 << max(1, (len(p) - 1).bit_length()), []).append(i)
        for width, members in by_width.items():
            ids = self._trees([pieces[i] for i in members], width)
            for i, row in zip(members, ids):
                out[i] = row
        return out

    def _trees(self, pieces: list[bytes], width: int) -> list[tuple[int, ...]]:
        n = len(pieces)
        lengths = np.array([len(p) for p in pieces])
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), dtype=np.uint8).reshape(n, width)
        token = self.byte_ids[raw]
        pos = np.arange(width)
        token[pos[None, :] >= lengths[:, None]] = -1
        after = np.tile(pos + 1, (n, 1))  # next live position, `width` at the end
        after[after >= lengths[:, None]] = width
        before = np.tile(pos - 1, (n, 1))
        # tree[:, width + p] is the leaf of position p; a node holds rank * width + position,
        # so a minimum is the leftmost position of the smallest rank.
        tree = np.full((n, 2 * width), NONE, dtype=np.int64)
        rank = np.full((n, width), NONE, dtype=np.int64)
        rank[:, :-1] = self.pair_rank(token[:, :-1], token[:, 1:])
        rank[(pos[None, :] + 1) >= lengths[:, None]] = NONE
        tree[:, width:] = np.where(rank == NONE, NONE, rank * width + pos)
        lo = width // 2
        while lo:
            tree[:, lo:2 * lo] = np.minimum(tree[:, 2 * lo:4 * lo:2], tree[:, 2 * lo + 1:4 * lo:2])
            lo //= 2

        def update(rows, at, values):
            node = width + at
            tree[rows, node] = values
            node = node >> 1
            while node[0]:
                tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
                node = node >> 1

        def ranked(rows, left, right):
            """Leaf values of pairs (left, right); NONE where one of them is no live position."""
            ok = (left >= 0) & (right < width)
            r = self.pair_rank(token[rows, np.where(ok, left, 0)], token[rows, np.where(ok, right, 0)])
            return np.where(ok & (r != NONE), r * width + left, NONE)

        rows = np.flatnonzero(tree[:, 1] != NONE)
        while len(rows):
            best = tree[rows, 1]
            at = best % width
            right = after[rows, at]
            token[rows, at] = best // width
            token[rows, right] = -1
            beyond = after[rows, right]
            after[rows, at] = beyond
            has = beyond < width
            before[rows[has], beyond[has]] = at[has]
            update(rows, right, np.full(len(rows), NONE))
            update(rows, at, ranked(rows, at, beyond))
            left = before[rows, at]
            has = left >= 0
            if has.any():
                update(rows[has], left[has], ranked(rows[has], left[has], at[has]))
            rows = rows[tree[rows, 1] != NONE]
        live = token >= 0
        flat, ends = token[live].tolist(), np.cumsum(live.sum(axis=1)).tolist()
        return [tuple(flat[a:b]) for a, b in zip([0, *ends[:-1]], ends)]

    # -- one long piece --------------------------------------------------------
    def encode_long(self, piece: bytes) -> tuple[int, ...]:
        n = len(piece)
        width = 1 << max(1, (n - 1).bit_length())
        token = self.byte_ids[np.frombuffer(piece, dtype=np.uint8)]
        leaves = np.full(width, NONE, dtype=np.int64)
        if n > 1:
            r = self.pair_rank(token[:-1], token[1:])
            leaves[:n - 1] = np.where(r == NONE, NONE, r * width + np.arange(n - 1))
        levels = [leaves]
        while len(levels[-1]) > 1:
            levels.append(np.minimum(levels[-1][::2], levels[-1][1::2]))
        tree = [int(NONE), *(v for level in reversed(levels) for v in level.tolist())]
        token = token.tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        none, pairs, base = int(NONE), self.pairs, self.width

        def update(at, value):
            node = width + at
            tree[node] = value
            node >>= 1
            while node:
                a, b = tree[2 * node], tree[2 * node + 1]
                tree[node] = a if a < b else b
                node >>= 1

        def ranked(left, right):
            r = pairs.get(token[left] * base + token[right])
            return none if r is None else r * width + left

        while tree[1] != none:
            rank, at = divmod(tree[1], width)
            right = after[at]
            beyond = after[right]
            token[at], token[right] = rank, -1
            after[at] = beyond
            update(right, none)
            if beyond < n:
                before[beyond] = at
                update(at, ranked(at, beyond))
            else:
                update(at, none)
            left = before[at]
            if left >= 0:
                update(left, ranked(left, at))
        return tuple(t for t in token if t >= 0)

    # -- texts -------------------------------------------------------------------
    def encode_texts(self, texts: list[str]) -> Iterator[list[int]]:
        """The ids of each text. The unknown pieces of all texts are encoded in one go."""
        cache = self.cache
        pieces = [self.split(text) for text in texts]
        new = {p for doc in pieces for p in doc if p not in cache}
        if new:
            if len(cache) + len(new) > CACHE_PIECES:
                cache.clear()
                new = {p for doc in pieces for p in doc}
            self._learn(new)
        for doc in pieces:
            yield list(chain.from_iterable(map(cache.__getitem__, doc)))

    def _learn(self, pieces) -> None:
        cache, ranks, short, keys = self.cache, self.ranks, [], []
        for p in pieces:
            data = p.encode("utf-8", "surrogatepass")
            whole = ranks.get(data)
            if whole is not None:  # merging always ends in the whole piece's own token
                cache[p] = (whole,)
            elif len(data) <= BATCH_BYTES:
                short.append(data)
                keys.append(p)
            else:
                cache[p] = self.encode_long(data)
        for a in range(0, len(short), 8192):
            cache.update(zip(keys[a:a + 8192], self.encode_short(short[a:a + 8192])))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(maxsize=4)
def vocabulary(path: str, pattern: str) -> ByteBpe:
    return ByteBpe(path, pattern)


def _chunks(texts: list[str], chars: int = 400_000) -> Iterator[list[str]]:
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t)
        if size >= chars:
            yield part
            part, size = [], 0
    if part:
        yield part


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids and the bytes decoded from those ids, a row per row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path, pattern)
        for batch in batches:
            start = 0
            for texts in _chunks([t or "" for t in batch.column(1).to_pylist()]):
                ids = list(bpe.encode_texts(texts))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(texts)), pa.array(ids, pa.list_(pa.int32())),
                     pa.array([bpe.decode(x) for x in ids], pa.binary())], names=["doc_id", "ids", "decoded"])
                start += len(texts)

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, ENCODED_SCHEMA)


def digest_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encode and decode as :func:`encode_documents`, but only digests of the ids
    and of the decoded bytes leave the Python worker."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path, pattern)
        for batch in batches:
            n, id_sha, text_sha = [], [], []
            for texts in _chunks([t or "" for t in batch.column(1).to_pylist()]):
                for ids in bpe.encode_texts(texts):
                    n.append(len(ids))
                    id_sha.append(hashlib.sha256(",".join(map(bpe.decimal.__getitem__, ids)).encode()).hexdigest())
                    text_sha.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(id_sha, pa.string()),
                 pa.array(text_sha, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, DIGEST_SCHEMA)
