"""Packing documents into fixed-length token sequences (operator 10).

First-fit decreasing over a tournament tree of bin capacities, run on its own
in randomised groups of documents:

* every document is tokenised and followed by one end id; a longer document
  gives whole sequences and one remainder;
* a group's remainders go, longest first, each into the first sequence with
  enough room. The tree keeps the largest free capacity below each node, so the
  first fitting sequence is found by one walk from the root;
* what space is left is closed by cutting pieces of the last sequences into the
  gaps of the first ones; the one sequence left over is split at powers of two,
  which need no padding.

A group holds about ``group_tokens`` tokens however large the input is: the
number of groups follows the input's bytes, and rows are dealt to groups by a
seeded random number, so no key, source or repeated id can fill one group. One
shuffle moves the token ids, two bytes each where the vocabulary allows it.

Defined results: null text is empty and gives one piece that holds only the end
id; null and repeated doc_ids are packed row by row; extra columns are ignored;
an empty table gives no pieces.
"""

from __future__ import annotations

import json
import re
import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEQUENCE = 2048
GROUP_TOKENS = 1_000_000
SEED = 20
PIECE_SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


class TournamentTree:
    """Free capacity per bin; each inner node holds the largest below it."""

    def __init__(self, bins: int, capacity: int):
        self.width = 1 << max(0, (max(1, bins) - 1).bit_length())
        self.tree = [capacity] * (2 * self.width)

    def first_fit(self, size: int) -> int:
        """The first bin with room for ``size``; its capacity falls by that."""
        tree, node = self.tree, 1
        while node < self.width:
            node *= 2
            if tree[node] < size:
                node += 1
        tree[node] -= size
        at = node - self.width
        node >>= 1
        while node:
            a, b = tree[2 * node], tree[2 * node + 1]
            best = a if a > b else b
            if tree[node] == best:
                break
            tree[node] = best
            node >>= 1
        return at


def pack(lengths: list[int], sequence: int = SEQUENCE) -> list[list[tuple[int, int, int]]]:
    """Sequences as lists of (document, start, length) for documents of these lengths."""
    full: list[list[tuple[int, int, int]]] = []
    rest = []
    for doc, n in enumerate(lengths):
        whole = n - n % sequence
        full.extend([(doc, a, sequence)] for a in range(0, whole, sequence))
        if n % sequence:
            rest.append((n - whole, doc, whole))
    rest.sort(key=lambda x: (-x[0], x[1]))
    tree = TournamentTree(len(rest), sequence)
    bins: list[list[tuple[int, int, int]]] = []
    for size, doc, start in rest:
        at = tree.first_fit(size)
        if at == len(bins):
            bins.append([])
        bins[at].append((doc, start, size))
    # Close the gaps of the first bins with pieces of the last ones.
    used = [sum(p[2] for p in b) for b in bins]
    i, j = 0, len(bins) - 1
    while i < j:
        gap = sequence - used[i]
        if not gap:
            i += 1
            continue
        doc, start, size = bins[j].pop()
        take = min(gap, size)
        bins[i].append((doc, start, take))
        used[i] += take
        used[j] -= take
        if take < size:
            bins[j].append((doc, start + take, size - take))
        if not bins[j]:
            j -= 1
    bins = bins[:j + 1] if bins else []
    if bins and used[j] < sequence:
        bins.extend(_at_powers(bins.pop(), used[j]))
    return full + bins


def _at_powers(pieces: list[tuple[int, int, int]], total: int) -> list[list[tuple[int, int, int]]]:
    """Cut one sequence into sequences whose lengths are powers of two."""
    out, queue = [], list(reversed(pieces))
    for bit in range(total.bit_length() - 1, -1, -1):
        room = total & (1 << bit)
        if not room:
            continue
        part = []
        while room:
            doc, start, size = queue.pop()
            take = min(room, size)
            part.append((doc, start, take))
            room -= take
            if take < size:
                queue.append((doc, start + take, size - take))
        out.append(part)
    return out


def _byte_of_char() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: printable
    bytes stand for themselves, the others for the characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=2)
def encoder(path: str):
    """encode(text) -> ids of the vocabulary file at ``path``, and the largest id.

    A byte-level BPE file whose merges come in the order of their ids is the
    same thing as a rank table, and is run by the faster rank encoder; any other
    file, and a text that spells one of the file's added tokens, is run as it is."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
    vocab = model["vocab"]
    ids = [vocab.get(a + b, -1) for a, b in merges]
    largest = max([*vocab.values(), *(t["id"] for t in spec.get("added_tokens", []))])
    added = [t["content"] for t in spec.get("added_tokens", [])]
    whole = lru_cache(maxsize=1)(lambda: _file_tokenizer(path))  # read where a text needs it

    def as_file(text: str) -> list[int]:
        return whole().encode(text, add_special_tokens=False).ids

    if (pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and not spec.get("normalizer")
            and all(a < b for a, b in zip([-1, *ids], ids))):
        import public_tokenizers
        import tiktoken

        byte_of = _byte_of_char()
        ranks = {bytes(byte_of[c] for c in token): i for token, i in vocab.items() if token not in added}
        plain = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                  special_tokens={})
        spelt = re.compile("|".join(map(re.escape, added))) if added else None

        def encode(text: str) -> list[int]:
            return as_file(text) if spelt and spelt.search(text) else plain.encode_ordinary(text)

        return encode, largest
    return as_file, largest


def _file_tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def pack_documents(docs: DataFrame, path: str, end_id: int = 1, sequence: int = SEQUENCE,
                   group_tokens: int = GROUP_TOKENS, seed: int = SEED) -> DataFrame:
    """One row per piece, see PIECE_SCHEMA. ``sequence_id`` is the group's number
    times 2**32 plus the sequence's number in its group."""
    docs = docs.selectExpr("cast(doc_id as long) doc_id", "text")
    size = docs.agg(F.sum(F.octet_length("text")).alias("b"), F.count(F.lit(1)).alias("n")).first()
    groups = max(1, -(-((size.b or 0) // 3 + size.n) // group_tokens))  # about three bytes a token

    def encode(batches):
        to_ids, largest = encoder(path)
        kind = "<u2" if max(largest, end_id) < 1 << 16 else "<u4"
        for batch in batches:
            rows, size, start = [], 0, 0
            for at, text in enumerate(batch.column(2).to_pylist(), 1):
                rows.append(np.array([*to_ids(text or ""), end_id], dtype=kind).tobytes())
                size += len(rows[-1])
                if size >= 4_000_000 or at == batch.num_rows:
                    n = len(rows)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(start, n), batch.column(1).slice(start, n),
                         pa.array(rows, pa.binary()), pa.array([int(kind[-1])] * n, pa.int32())],
                        names=["grp", "doc_id", "ids", "width"])
                    rows, size, start = [], 0, at

    def one_group(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["doc_id", "ids"], na_position="first", kind="stable")
        docs_ids = [np.frombuffer(b, dtype=f"<u{w}") for b, w in zip(part["ids"], part["width"])]
        names = [None if pd.isna(x) else int(x) for x in part["doc_id"]]
        rows = []
        for number, pieces in enumerate(pack([len(x) for x in docs_ids], sequence)):
            offset = 0
            for doc, start, length in pieces:
                data = docs_ids[doc][start:start + length].astype("<u4").tobytes()
                rows.append((names[doc], start, length, zlib.crc32(data), len(docs_ids[doc]),
                             (int(key[0]) << 32) + number, offset))
                offset += length
        out = pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                                          "offset"])
        return out.astype({"doc_id": "Int64"})

    dealt = docs.select(F.floor(F.rand(seed) * groups).cast("long").alias("grp"), "doc_id", "text")
    ids = dealt.mapInArrow(encode, "grp long, doc_id long, ids binary, width int")
    return ids.groupBy("grp").applyInPandas(one_group, PIECE_SCHEMA)
