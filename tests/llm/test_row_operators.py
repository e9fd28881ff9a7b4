"""Operators that work row by row: BPE, licences, quality rules, toxicity."""

import base64
import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

from quillfeed.llm import bpe, licenses, quality, toxicity

PATH = P.path("byte_bpe_multi_50k.tiktoken")
TEXTS = [
    None, "", " ", "a", "Hello  world!\n\n it's 2024", "é中文 ñandú 🙂", "x" * 3000, "ab" * 5000, "\t\n \r", "don't stop",
    "<|endoftext|> plain", "word " * 400,
]


def rows_of(spark, texts, extra=False):
    data = [(i, t) for i, t in enumerate(texts)]
    if extra:
        return spark.createDataFrame([(i, t, "x", 1) for i, t in data], "doc_id long, text string, n_words string, score int")
    return spark.createDataFrame(data, "doc_id long, text string")


def test_bpe_matches_the_reference_library_and_round_trips(spark):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    plain = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: r for r in bpe.encode_documents(rows_of(spark, TEXTS, True), PATH, P.PATTERN).collect()}
    for i, t in enumerate(TEXTS):
        assert got[i].ids == plain.encode_ordinary(t or "")
        assert bytes(got[i].decoded) == (t or "").encode()
    digests = {r.doc_id: r for r in bpe.digest_documents(rows_of(spark, TEXTS), PATH, P.PATTERN).collect()}
    for i, t in enumerate(TEXTS):
        ids = plain.encode_ordinary(t or "")
        assert digests[i].n_tokens == len(ids)
        assert digests[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_bpe_long_and_short_pieces_agree():
    vocabulary = bpe.vocabulary(PATH, P.PATTERN)
    rng = np.random.default_rng(3)
    for n in (1, 2, 3, 17, 64):
        piece = bytes(rng.choice(list(b"abcdetion"), n).tolist())
        assert vocabulary.encode_short([piece])[0] == vocabulary.encode_long(piece)


def brute_licences(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    found = []
    for t in licenses.BASE_TEMPLATES:
        k = t.key_words
        found += [(i, t.label) for i in range(len(words) - len(k) + 1) if words[i:i + len(k)] == k]
    return len(words), sorted(found)


def test_licence_base_places_match_brute_force(spark):
    texts = TEXTS + [
        "Released under the MIT License. UNDER THE MIT LICENSE", "Apache License, Version 2.0", "CC BY-NC 4.0 cc-by-nc",
        "under the under the mit license", "under the MİT license and the Kelvin K", "cc by", "écc by nc",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    ]
    got = {r.doc_id: r for r in licenses.scan_documents(rows_of(spark, texts, True)).collect()}
    for i, t in enumerate(texts):
        n, found = brute_licences(t)
        assert got[i].n_words == n
        assert sorted((m.start, m.label) for m in got[i].matches if m.base) == found
    assert got[len(texts) - 1].labels == ["mit"]
    assert licenses.scan_documents(rows_of(spark, []) if False else spark.createDataFrame([], "doc_id long, text string")).count() == 0


def brute_matches(text, templates, min_score):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    found = []
    for t in templates:
        k, full = t.key_words, t.words
        for i in range(len(words) - len(k) + 1):
            if words[i:i + len(k)] == k:
                start = i - t.key_at
                score = sum(0 <= start + j < len(words) and words[start + j] == x for j, x in enumerate(full)) / len(full)
                if t.base or score >= min_score:
                    found.append((t.label, t.base, start, round(score, 9)))
    return sorted(found)


def test_licence_templates_match_brute_force(spark):
    rng = np.random.default_rng(5)
    texts = [None, "", "license " * 500, "the under mit license by cc nc " * 40]
    for t in licenses.TEMPLATES:
        w = t.words
        texts += [t.text, " ".join(reversed(w)), "x " + t.text.upper() + " " + t.text, t.key + " " + t.key, " ".join(w[:-1]),
                  " ".join(x for i, x in enumerate(w) if i != len(w) // 2), " ".join(w[len(w) // 2:])]
        shuffled = list(w)
        rng.shuffle(shuffled)
        texts.append(" ".join(shuffled) + " by under the software")
    texts += texts[:6]  # repeated rows
    for rare in (1, 2, 3, 9):
        frame = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, words int").coalesce(2)
        rows = licenses.scan_documents(frame, rare=rare).collect()
        assert len(rows) == len(texts)
        for r in rows:
            got = sorted((m.label, m.base, m.start, round(m.score, 9)) for m in r.matches)
            want = brute_matches(texts[r.doc_id], licenses.TEMPLATES, licenses.MIN_SCORE)
            assert got == want, (rare, texts[r.doc_id])
            assert r.labels == sorted({m[0] for m in want})


def test_licence_postings_are_intersected(spark):
    frequency = {"license": 90, "under": 50, "the": 1000, "mit": 3}
    t = licenses.Template("mit", "released under the mit license", "under the mit license")
    assert licenses.postings([t], frequency) == [[("mit", 3), ("under", 1), ("license", 4)]]
    plan = licenses.scan_documents(rows_of(spark, ["under the mit license"]))._jdf.queryExecution().executedPlan().toString()
    assert "array_intersect" in plan and "Python" not in plan and "Exchange" not in plan


def brute_quality(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = text.split("\n")
    dup = sum(1 for i, x in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", x) and x in lines[:i])
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    counts = Counter(grams)
    covered = {j for i, g in enumerate(grams) if counts[g] > 1 for j in range(i, i + 5)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered))


def test_quality_counts_match_brute_force(spark):
    texts = TEXTS + ["a b c d e f a b c d e g", "same line\nsame line\n\n\nsame line", "x # * $ y\x0bz  w", "1 2 3 4 5 1 2 3 4 5 1 2 3 4 5"]
    got = {r.doc_id: r for r in quality.judge_documents(rows_of(spark, texts, True)).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        want = brute_quality(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.base_failed and r.kept)


def test_quality_removes_lines_first_and_then_judges_the_loss():
    prose = "The committee met on Monday, and it approved the plan for the new bridge over the river."
    nav = "Home | News | Sport | Weather | Travel | Shop"
    kept = quality.judge_text(f"{nav}\n{prose}")
    assert kept[6] and kept[8] == 1 and nav not in kept[10]
    assert not quality.judge_text(f"{nav}\n{nav.replace('Home', 'Start')}\nA short but honest line of prose, here.")[6]
    assert quality.line_failure("BUY!! NOW!! CHEAP!!") == "punctuation"
    assert quality.line_failure("Please accept cookies to go on.") == "boilerplate"
    assert quality.line_failure("") is None and quality.line_failure(prose) is None


def test_quality_boilerplate_needs_whole_words_and_most_of_the_line():
    for line in ("The virus spread more slowly.", "Children who read more books do better.", "They read more books now.",
                 "The parliament debated the new privacy policy of the government on Monday."):
        assert quality.line_failure(line) is None
    clean = "In the second year the virus spread more slowly than many of the doctors had feared."
    assert quality.judge_text(clean)[6] and quality.judge_text(clean)[10] == clean
    for line in ("Read more", "Read more about us", "\u00a9 2020 Example. All rights reserved.", "Click here to sign up for our newsletter",
                 "Privacy Policy / Terms of Use"):
        assert quality.line_failure(line) == "boilerplate"


def test_quality_filter_keeps_columns(spark):
    docs = spark.createDataFrame([(1, None, "a", 0), (2, "one two three four five six seven eight nine ten.", "b", 50)],
                                 "doc_id long, text string, kept string, n_chars long")
    out = quality.filter_documents(docs)
    assert out.columns == docs.columns
    assert [tuple(r) for r in out.collect()] == [(2, "one two three four five six seven eight nine ten.", "b", 50)]


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(1)
    calm = ["river", "bridge", "garden", "letter", "window", "summer", "paper", "music", "coffee", "market", "school", "yellow"]
    rude = ["idiot", "scumbag", "worthless"]
    texts, labels = [], []
    for i in range(900):
        words = list(rng.choice(calm, 40))
        if i % 4 == 0:
            words[int(rng.integers(40))] = rude[i // 4 % 3]
        texts.append(" ".join(words))
        labels.append(int(i % 4 == 0))
    return toxicity.train(texts, labels)


def test_toxicity_finds_seen_and_misspelt_words(model):
    score = model.scorer()
    base = "river bridge garden letter window summer paper music coffee market school yellow "
    clean, rude, misspelt, long = score([base * 3, base + "idiot", base + "worthlesss", base * 50 + "scumbag " + base * 50])
    assert clean < 0.3 <= rude and misspelt >= 0.3 and long >= 0.3
    assert score([None])[0] == score([""])[0] and 0 <= score([""])[0] <= 1


def test_toxicity_without_both_classes_scores_the_share():
    assert toxicity.train([], []).scorer()(["x"])[0] < 0.01
    assert toxicity.train(["a", "b"], [1, 1]).scorer()(["x"])[0] > 0.99


def test_toxicity_learns_only_from_allowed_rows(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"text {i}", "de") for i in range(40)] + [(None, None, None)], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    seen = {}
    monkeypatch.setattr(toxicity, "train", lambda texts, y: seen.update(zip(texts, y)) or toxicity.Model(np.zeros((1, 2), np.float32), 0.0))
    model = toxicity.fit(docs, labels)
    import zlib
    assert set(seen) == {f"text {i}" for i in range(40) if zlib.crc32(str(i).encode()) % 4 != 2}
    assert toxicity.score_documents(docs, model).count() == 41
    assert toxicity.filter_documents(docs, model, 0.6).columns == docs.columns


def test_toxicity_learns_from_a_thousand_rows():
    rng = np.random.default_rng(8)
    syllables = [a + b for a in "bdfgklmnprstv" for b in ("an", "er", "is", "on", "ul")]
    marks = ["stupid", "worthless", "disgusting", "pathetic", "scum"]
    texts, labels = [], []
    for i in range(1_400):
        words = ["".join(rng.choice(syllables, rng.integers(1, 4))) for _ in range(rng.integers(40, 160))]
        y = int(i % 8 == 0)
        for _ in range(3 * y):
            words[rng.integers(len(words))] = str(rng.choice(marks))
        texts.append(" ".join(words))
        labels.append(y)
    score = toxicity.train(texts[:1_000], labels[:1_000]).scorer()
    got, y = np.array(score(texts[1_000:])), np.array(labels[1_000:])
    ranks = got.argsort(kind="stable").argsort() + 1.0
    auc = (ranks[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (len(y) - y.sum()))
    assert auc > 0.95
    assert ((got >= toxicity.THRESHOLD) & (y == 1)).sum() >= 0.8 * y.sum()
    assert ((got >= toxicity.THRESHOLD) & (y == 0)).sum() <= 0.05 * (len(y) - y.sum())


def test_toxicity_passes_over_texts_beyond_its_bound(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "train", lambda texts, labels, **kw: seen.append((sorted(texts, key=len), sorted(labels))))
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 4 != 2]
    first = spark.createDataFrame([(i,) for i in ids], "doc_id long").selectExpr("doc_id").orderBy(F.xxhash64("doc_id")).first().doc_id
    docs = spark.createDataFrame([(i, "z" * 5_000 if i == first else "ab") for i in ids], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, toxic int")
    toxicity.fit(docs, labels, max_chars=1_000)
    assert len(seen) == 1 and len(seen[0][0]) == len(ids) - 1 and max(map(len, seen[0][0])) == 2
    empty = spark.createDataFrame([], "doc_id long, text string")
    toxicity.fit(empty, labels)
    assert seen[1] == ([], [])
