"""Exact dedup by naming, the conversation trie, cross-tokenizer alignment."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from quillfeed.llm import alignment, exact_dedup, prefix_trie

PATH_A, PATH_B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
SPACE = re.compile(r"[\x20\x09-\x0D]")


# ---- operator 12 -----------------------------------------------------------------

def brute_dedup(docs):
    """docs: (doc_id, text) in the order read -> per row (doc_id, keep_id, size, kept, sha)."""
    groups = defaultdict(list)
    for row, (doc, text) in enumerate(docs):
        groups[SPACE.sub("", text or "")].append((-len(text or ""), doc is None, doc or 0, row))
    out = []
    for row, (doc, text) in enumerate(docs):
        flat = SPACE.sub("", text or "")
        best = min(groups[flat])
        keep = docs[best[3]][0]
        out.append((doc, keep, len(groups[flat]), best[3] == row, hashlib.sha256(flat.encode()).hexdigest()))
    return out


def dedup_rows(df, **more):
    found = exact_dedup.dedup_documents(df, **more).orderBy("row").collect()
    return [(r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in found]


def named_docs():
    rng = random.Random(5)
    docs = [(0, None), (1, ""), (2, " \t\n\x0b\x0c\r"), (3, "a b c"), (4, "abc"), (5, "ab c "), (6, "abc "), (7, " abc"),
            (7, "abc"), (None, "abc and more"), (None, "abc and more"), (8, "abcandmore"), (9, "é" * 50), (10, "é" * 50 + "e"),
            (11, "x" * 20_000), (12, " " + "x" * 20_000), (13, "x" * 19_999), (14, "x" * 20_001), (-5, "A b C"), (15, "abd")]
    words = ["".join(rng.choices("ab", k=3)) for _ in range(6)]
    docs += [(100 + i, " ".join(rng.choices(words, k=rng.randint(1, 6)))) for i in range(300)]
    docs += [(500 + i, "one of very many copies of a text") for i in range(200)]
    return docs


@pytest.mark.parametrize("block", [1, 7, 1024])
def test_exact_dedup_matches_brute_force(spark, block):
    docs = named_docs() if block > 1 else [(i, (t or "")[:40]) for i, t in named_docs()]
    data = [(i, t, "x", 1, -1) for i, t in docs]
    df = spark.createDataFrame(data, "doc_id long, text string, name string, row int, level int").coalesce(1)
    assert dedup_rows(df, block=block) == brute_dedup(docs)


def test_exact_dedup_takes_other_digests_when_two_blocks_share_one(spark):
    """The first digests say nothing; every block would have the same name."""
    def weak(block, seed):
        return b"\0" * 16 if seed == 0 else exact_dedup.digest(block, seed)

    docs = [(1, "aa"), (2, "ab"), (3, "a a"), (4, "b" * 40)]
    df = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    assert dedup_rows(df, block=16, name=weak) == brute_dedup(docs)


def test_exact_dedup_empty_table_and_filter(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert exact_dedup.dedup_documents(empty).count() == 0
    docs = named_docs()
    df = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(docs)], "doc_id long, text string, n_chars int").coalesce(1)
    kept = exact_dedup.filter_documents(df)
    assert kept.columns == df.columns
    want = [k for k, r in enumerate(brute_dedup(docs)) if r[3]]
    # Repeated and null ids stand for rows here: the first of equal ones in the order read stays.
    sizes = Counter(SPACE.sub("", t or "") for _, t in docs)
    assert kept.count() == len(sizes) == len(want)
    assert {SPACE.sub("", r.text or "") for r in kept.collect()} == set(sizes)


def test_names_are_the_same_for_any_split_of_the_input(spark):
    docs = [(i, t) for i, (_, t) in enumerate(named_docs())]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = {r[0]: r[1:] for r in brute_dedup(docs)}
    for parts in (1, 5):
        got = exact_dedup.dedup_documents(df.repartition(parts), block=8).collect()
        assert {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got} == want


# ---- operator 11 -----------------------------------------------------------------

def brute_trie(rows):
    """rows: (conv_id, turn, role, text) -> set of node tuples."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    original = {c: [x[2:] for x in sorted(v)] for c, v in turns.items()}
    rebuilt = {}
    for c, own in original.items():
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = tuple(original.get(base, [])[:h] + own[h:])
    members = defaultdict(list)
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        worth = (len(m) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += worth
    out = []
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(rebuilt[c]) == len(p))))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def trie_rows(df, **more):
    return sorted(map(tuple, prefix_trie.conversation_trie(df, **more).select(prefix_trie.COLUMNS).collect()), key=str)


def conversations():
    rng = random.Random(11)
    rows = [(1, None, None, None), (1, 0, "user", "a  b c"), (1, 0, "assistant", ""), (1, 0, "user", "a  b c"), (2, 5, "", None),
            (None, 0, "user", "nobody"), (-3, 1, "user", "minus"), (-23, 1, "user", "minus"), (0, -1, "user", "zero"), (0, 2, "user", "two"),
            (21, 0, "user", "only turn"), (41, 0, "user", "x"), (1000, 0, "user", "x")]
    for c in range(60, 260):
        rows += [(c, k, rng.choice(["user", "assistant"]), rng.choice(["yes", "no it is", ""])) for k in range(rng.randint(1, 7))]
    rows += [(c, k, "user", f"the same {k}") for c in range(300, 700) for k in range(6)]  # many copies
    rows += [(720, k, "user", f"long {k // 2}") for k in range(300)] + [(740, k, "user", f"long {k // 2}") for k in range(280)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("shard_turns", [40, 900, 200_000])
def test_trie_matches_brute_force_however_it_is_sharded(spark, shard_turns):
    rows = conversations()
    data = [(*r, 1, "x", 0) for r in rows]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string, depth int, turns string, h int")
    got = trie_rows(df, shard_turns=shard_turns)
    assert got == brute_trie(rows)
    assert any(r[2] is None and r[1] == 0 for r in got)


def test_trie_of_turnless_conversations_and_empty_table(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert prefix_trie.conversation_trie(spark.createDataFrame([], schema)).count() == 0
    turnless = [c for c in range(21, 39) if zlib.crc32(str(c).encode()) % 4 >= 1]
    rows = [(c, 0, "user", "taken away") for c in turnless]  # conversation 20 is absent
    df = spark.createDataFrame(rows, schema)
    assert trie_rows(df) == brute_trie(rows)
    assert prefix_trie.conversation_trie(df).count() == 1


def test_ternary_tree_is_balanced_by_medians():
    tree = prefix_trie.TernaryTree()
    for i in prefix_trie.medians_first(1000):
        tree.insert([i])
    assert sorted(prefix_trie.medians_first(7)) == list(range(7))

    def height(at):
        deepest, todo = 0, [(at, 1)]
        while todo:
            x, d = todo.pop()
            deepest = max(deepest, d)
            todo += [(y, d + 1) for y in (tree.lo[x], tree.hi[x]) if y >= 0]
        return deepest

    assert height(tree.eq[0]) == 10  # 1000 < 2 ** 10
    deep = prefix_trie.TernaryTree()
    deep.insert([7] * 50_000)  # no recursion
    assert len(deep.downwards()) == 50_001


def test_ids_ending_at_one_node_are_hashed_in_pieces(spark):
    rows = [(c, 0, "user", "hello") for c in range(2000, 2000 + 4 * prefix_trie.PIECE)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert trie_rows(df, shard_turns=2 * prefix_trie.PIECE) == brute_trie(rows)


# ---- operator 13 -----------------------------------------------------------------

def brute_alignment(docs):
    """Per document the tokens, groups and overlapping pairs, by the libraries."""
    file = Tokenizer.from_file(PATH_A)
    file.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=PATH_B)
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in printable)}

    def piece(i):
        p = model.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if re.fullmatch("<0x..>", p) else p.replace("▁", " ").encode()

    out = []
    for _, text in docs:
        a = file.encode(" " + text, add_special_tokens=False).ids if text else []
        b = model.encode(text) if text else []
        raw = (" " + text).encode() if text else b""
        spans = []
        for ids, spell in ((a, lambda i: bytes(byte_of[c] for c in file.id_to_token(i))), (b, piece)):
            at, found = 0, []
            for i in ids:
                found.append((at, at + len(spell(i))))
                at += len(spell(i))
            spans.append((found, b"".join(map(spell, ids)) == raw))
        if not (spans[0][1] and spans[1][1]):
            out.append(([], [], [], [], []))
            continue
        sa, sb = spans[0][0], spans[1][0]
        both = sorted({e for _, e in sa} & {e for _, e in sb})
        group = lambda e: next(k for k, x in enumerate(both) if e <= x)
        ga, gb = [group(e) for _, e in sa], [group(e) for _, e in sb]
        links = [(i, j, min(x[1], y[1]) - max(x[0], y[0])) for i, x in enumerate(sa) for j, y in enumerate(sb)
                 if min(x[1], y[1]) > max(x[0], y[0])]
        shared = [(i, j) for i, x in enumerate(ga) for j, y in enumerate(gb) if x == y]
        groups = [([a[i] for i, g in enumerate(ga) if g == k], [b[j] for j, g in enumerate(gb) if g == k]) for k in range(len(both))]
        out.append((a, b, groups, links, shared))
    return out


TEXTS = [
    None, "", " ", "  ", "a", "\n", "Hello  world!\n\n it's 2024", "é中文 ñandú 🙂 ퟿", "x" * 300, "ab" * 90, "\t\n \r", "don't stop",
    "<|endoftext|> plain <s> </s> <unk> <0x41>", "under▁score", "▁", "a\x00b", "﻿bom", "é combined", "the the the of the",
    "schöne Übergrößenträger", "    indented    code\n        more", "٣٤٥ ٦", "𝔘𝔫𝔦𝔠𝔬𝔡𝔢", "word " * 60,
]


def test_alignment_matches_the_libraries_and_brute_force(spark):
    docs = [*enumerate(TEXTS), (3, "repeated id"), (None, "no id"), (None, None)]
    brute = brute_alignment(docs)
    count = Counter((a[i], b[j]) for a, b, _, links, _ in brute for i, j, _ in links)
    best = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    want = []
    for (doc, _), (a, b, groups, links, shared) in zip(docs, brute):
        pairs = [(a[i], b[j]) for i, j, _ in links]
        spelt = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        want.append((doc, len(a), len(b), len(groups), len(links), sum(count[p] == best[p[1]] for p in pairs),
                     sum(count[p] for p in pairs), hashlib.sha256(spelt.encode()).hexdigest() if a else "", len(shared)))
    data = [(i, t, "x", 5) for i, t in docs]
    df = spark.createDataFrame(data, "doc_id long, text string, chunk string, n_a int").repartition(3)
    got = [tuple(r) for r in alignment.align_documents(df, PATH_A, PATH_B).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("kind", ["overlap", "group"])
def test_links_themselves(spark, kind, monkeypatch):
    docs = [(i, t) for i, t in enumerate(TEXTS)]
    want = []
    for (doc, _), (a, b, _, links, shared) in zip(docs, brute_alignment(docs)):
        for i, j, n in links if kind == "overlap" else [(i, j, 1) for i, j in shared]:
            want.append((doc, i, j, a[i], b[j], n))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = [tuple(r) for r in alignment.token_links(df, PATH_A, PATH_B, kind).collect()]
    assert sorted(got) == sorted(want)


def test_alignment_of_an_empty_table_and_of_empty_texts(spark):
    schema = "doc_id long, text string"
    assert alignment.align_documents(spark.createDataFrame([], schema), PATH_A, PATH_B).count() == 0
    got = alignment.align_documents(spark.createDataFrame([(1, None), (2, "")], schema), PATH_A, PATH_B).collect()
    assert sorted(tuple(r) for r in got) == [(i, 0, 0, 0, 0, 0, 0, "", 0) for i in (1, 2)]


def test_sparse_products_equal_dense_ones():
    rng = np.random.default_rng(4)
    for _ in range(20):
        n, k, m = rng.integers(1, 9, 3)
        x, y = ((rng.random(s) < 0.4) * rng.integers(1, 5, s) for s in ((n, k), (k, m)))

        def csr(d):
            at = [np.flatnonzero(r) for r in d]
            return alignment.Csr(np.concatenate([[0], np.cumsum([len(a) for a in at])]), np.concatenate(at).astype(np.int64),
                                 np.concatenate([r[a] for r, a in zip(d, at)]), d.shape[1])

        def dense(c):
            out = np.zeros((len(c.indptr) - 1, c.columns), int)
            out[c.rows(), c.indices] = c.data
            return out

        assert (dense(csr(x).multiply(csr(y))) == x @ y).all()
        assert (dense(csr(x).transpose()) == x.T).all()
        assert (csr(x).row_sizes(csr(y)) == ((x > 0).astype(int) @ (y > 0).astype(int)).sum(1)).all()
        parts = [dense(csr(x).part(a, a + 1)) for a in range(n)]
        assert (np.concatenate(parts) == x).all()


def test_chunks_and_slices_do_not_change_the_result(spark, monkeypatch):
    docs = [(i, f"{t} {i % 7}") for i, t in enumerate(TEXTS * 4) if t]
    df = spark.createDataFrame(docs, "doc_id long, text string").coalesce(2)
    want = sorted(map(tuple, alignment.align_documents(df, PATH_A, PATH_B).collect()))
    for name, value in (("SLICE", 200), ("CHUNK", 700)):
        monkeypatch.setattr(alignment, name, value)
    chunked = df.mapInArrow(alignment._chunks(PATH_A, PATH_B), alignment.CHUNK_SCHEMA)
    assert sorted(map(tuple, alignment.align_documents(df, PATH_A, PATH_B).collect())) == want
    assert chunked.count() > 4
