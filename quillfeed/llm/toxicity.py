"""Toxicity classifier over subword bags (operator 6).

A word is the mean of the vectors of its character n-grams and of itself (hashed
buckets), a window of words is the mean of its words, and a linear softmax over
that mean gives the window's two class scores. Vectors and softmax are trained
jointly in numpy by Adagrad. Training joins a document's windows by log-sum-exp;
its score comes from the window with the largest margin, so a short insult in a
long text is not averaged away and many harmless windows do not add up. A share
of the sample is kept from training to turn margins into calibrated
probabilities. Words that were never seen, such as misspellings, share the vectors of the n-grams
they have in common with seen ones.

Training: at most ``max_docs`` labelled rows, those with the smallest hash of
their doc_id among the rows that may be learnt from, passing over texts that would
take the sample beyond ``max_chars`` characters (a bounded, documented sample; the texts are
fetched by a broadcast of at most that many ids). Scoring
is row-local over every whole text; the model is two floats a bucket.

Defined results: null or empty text has no windows and gets the bias score; a
null doc_id is never held out; without labelled rows of both classes every score
is the share of label 1 (0 without labels); repeated rows are scored each on
their own; extra columns are ignored by :func:`score_documents` and kept by
:func:`filter_documents`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_DOCS = 10_000
MAX_CHARS = 50_000_000
BUCKETS = 1 << 17
DIM = 8
WINDOW = 16
NGRAMS = (3, 4, 5)
SCALE = 16.0
CACHE_WORDS = 500_000
THRESHOLD = 0.3
MIN_DOCS = 3  # buckets of fewer documents than this stay neutral
MIN_STEPS = 400  # a small sample is gone through more often
START = 1e-4  # first sum of squares of a bucket's gradients; one document's gradient is about 1e-5
CALIBRATE = 0.2  # share of the sample kept for the calibration
_LOOKALIKE = str.maketrans("013457@$", "oieastas")
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
SCORE_SCHEMA = "doc_id long, score double"


def words_of(text: str) -> list[str]:
    """Lower-cased words; a run of one repeated word counts once."""
    return [w for w, _ in groupby(text.lower().split())]


def _core(word: str) -> str:
    """The word between edge marks, without outer punctuation, digits and signs
    that stand for letters replaced."""
    if not word.isalpha():
        word = (_EDGE.sub("", word) or word).translate(_LOOKALIKE)
    return f"<{word}>"


def ngram_buckets(words: list[str], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(word number, bucket) of every character n-gram of every word, and of
    every word as a whole."""
    cores = [_core(w) for w in words]
    codes = np.frombuffer("".join(cores).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64) + np.uint64(1)
    lengths = np.array([len(c) for c in cores], dtype=np.int64)
    ends = np.cumsum(lengths)
    word = np.repeat(np.arange(len(cores)), lengths)
    at = np.arange(len(codes))
    left = ends[word] - at  # characters from here to the word's end
    powers = np.cumprod(np.full(int(lengths.max()), _FACTOR, dtype=np.uint64))
    numbers, hashes = [np.arange(len(cores))], [np.add.reduceat(codes * powers[left - 1], ends - lengths)]
    for n in NGRAMS:
        h = np.zeros(max(0, len(codes) - n + 1), dtype=np.uint64)
        for k in range(n):
            h += codes[k:len(codes) - n + 1 + k] * powers[n - 1 - k] if len(h) else h
        inside = left[:len(h)] >= n
        numbers.append(word[:len(h)][inside])
        hashes.append(h[inside] + np.uint64(n))
    h = np.concatenate(hashes)
    h ^= h >> np.uint64(29)
    h *= _MIX
    return np.concatenate(numbers), ((h >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


@dataclass
class Model:
    """Per bucket and class the product of its vector and the softmax weights
    (all that scoring needs), and the class biases."""

    weights: np.ndarray
    bias: float
    window: int = WINDOW
    slope: float = 1.0  # the calibration's
    shift: float = 0.0

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Mean over each word's n-grams of the margin between the classes."""
        margin = (self.weights[:, 1] - self.weights[:, 0]).astype(np.float64)
        number, bucket = ngram_buckets(words, len(margin))
        return np.bincount(number, weights=margin[bucket]) / np.bincount(number)

    def margin(self, word_scores: np.ndarray) -> float:
        """The largest of the windows' margins; the bias alone without words."""
        if not len(word_scores):
            return self.bias
        return float(window_means(word_scores, self.window).max()) * SCALE + self.bias

    def scorer(self):
        """texts -> probabilities of label 1, with a bounded cache of word scores."""
        cache: dict[str, float] = {}

        def score(texts: list[str | None]) -> list[float]:
            docs = [words_of(t or "") for t in texts]
            new = list({w for words in docs for w in words if w not in cache})
            if len(cache) + len(new) > CACHE_WORDS:
                cache.clear()
                new = list({w for words in docs for w in words})
            for a in range(0, len(new), 20_000):
                part = new[a:a + 20_000]
                cache.update(zip(part, self.word_scores(part).tolist()))
            return [float(_sigmoid(self.slope * self.margin(np.array([cache[w] for w in words])) + self.shift)) for words in docs]

        return score


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60, 60)))


def window_means(values: np.ndarray, window: int) -> np.ndarray:
    """Sums over consecutive windows, over the window's size (a short last
    window counts as if filled with words of score 0)."""
    return np.add.reduceat(values, np.arange(0, len(values), window)) / window


def _by_word(words: list[str], part: int = 20_000) -> tuple[np.ndarray, np.ndarray]:
    """All words' buckets, word after word, and how many each word has."""
    flat, counts = [], []
    for a in range(0, len(words), part):
        number, bucket = ngram_buckets(words[a:a + part])
        flat.append(bucket[np.argsort(number, kind="stable")].astype(np.int32))
        counts.append(np.bincount(number))
    return np.concatenate(flat), np.concatenate(counts)


def train(texts: list[str], labels: list[int], epochs: int = 10, batch: int = 64, rate: float = 0.08,
          decay: float = 1e-6, seed: int = 7) -> Model:
    """Fit bucket vectors and softmax jointly on whole documents."""
    y = np.array(labels, dtype=np.float64)
    if not len(y) or y.min() == y.max():
        share = min(max(float(y.mean()) if len(y) else 0.0, 1e-6), 1 - 1e-6)
        return Model(np.zeros((1, 2), np.float32), float(np.log(share / (1 - share))))
    vocabulary: dict[str, int] = {}
    docs = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words_of(t or "")], dtype=np.int32) for t in texts]
    if not vocabulary:
        return train([], [])
    del texts
    flat, counts = _by_word(list(vocabulary))
    first = np.cumsum(counts) - counts
    del vocabulary
    seen_in = np.zeros(BUCKETS, dtype=np.int64)  # documents per bucket
    for d in docs:
        t = np.unique(d)
        n, ends = counts[t], np.cumsum(counts[t])
        seen_in[np.unique(flat[np.repeat(first[t] - (ends - n), n) + np.arange(ends[-1] if len(t) else 0)])] += 1
    rare = seen_in < MIN_DOCS
    rng = np.random.default_rng(seed)
    vectors = np.zeros((BUCKETS, DIM))  # what was never learnt stays neutral
    softmax = rng.normal(0, 0.5, (DIM, 2))
    bias = np.array([2.5, -2.5])
    g_vec, g_soft, g_bias = np.full(BUCKETS, START), np.full((DIM, 2), 1e-2), np.full(2, 1e-2)
    order = np.arange(len(docs))
    apart = order[rng.random(len(docs)) < CALIBRATE]  # not trained on, but calibrated on
    order = np.setdiff1d(order, apart)
    for _ in range(max(epochs, -(-MIN_STEPS * batch // max(1, len(order))))):
        rng.shuffle(order)
        for a in range(0, len(order), batch):
            picked = [i for i in order[a:a + batch] if len(docs[i])]
            if not picked:
                continue
            tokens = np.concatenate([docs[i] for i in picked])
            types, inverse = np.unique(tokens, return_inverse=True)
            n = counts[types]
            ends = np.cumsum(n)
            at = np.repeat(first[types] - (ends - n), n) + np.arange(ends[-1])
            buckets = flat[at]
            direction = softmax[:, 1] - softmax[:, 0]
            margin = vectors @ direction
            word_margin = np.add.reduceat(margin[buckets], ends - n) / n
            token_margin = word_margin[inverse]
            # Windows never cross documents.
            lengths = np.array([len(docs[i]) for i in picked])
            n_win = -(-lengths // WINDOW)
            doc_start = np.cumsum(lengths) - lengths
            win_first = np.cumsum(n_win) - n_win
            win_doc = np.repeat(np.arange(len(picked)), n_win)
            win_start = doc_start[win_doc] + (np.arange(n_win.sum()) - win_first[win_doc]) * WINDOW
            z = np.add.reduceat(token_margin, win_start) / WINDOW * SCALE + (bias[1] - bias[0])
            top = np.maximum.reduceat(z, win_first)
            e = np.exp(z - top[win_doc])
            total = np.add.reduceat(e, win_first)
            p = _sigmoid(top + np.log(total))
            delta = (p - y[picked]) / len(picked)
            d_win = delta[win_doc] * e / total[win_doc]
            win_len = np.diff(np.append(win_start, len(tokens)))
            d_token = np.repeat(d_win, win_len) * SCALE / WINDOW
            d_word = np.bincount(inverse, weights=d_token, minlength=len(types)) / n
            d_margin = np.bincount(buckets, weights=np.repeat(d_word, n), minlength=BUCKETS)
            d_margin[rare] = 0
            used = np.flatnonzero(d_margin)
            d_margin = d_margin[used]
            d_direction = vectors[used].T @ d_margin
            d_soft = np.stack([-d_direction, d_direction], axis=1)
            d_bias = np.array([-d_win.sum(), d_win.sum()])
            d_vec = d_margin[:, None] * direction[None, :] + decay * vectors[used]
            g_vec[used] += (d_vec ** 2).sum(axis=1)
            vectors[used] -= rate * d_vec / np.sqrt(g_vec[used])[:, None]
            g_soft += d_soft ** 2
            softmax -= rate * d_soft / np.sqrt(g_soft)
            g_bias += d_bias ** 2
            bias -= rate * d_bias / np.sqrt(g_bias)
    model = Model((vectors @ softmax).astype(np.float32), float(bias[1] - bias[0]))
    margin = (model.weights[:, 1] - model.weights[:, 0]).astype(np.float64)
    words = np.add.reduceat(margin[flat], first) / counts
    model.slope, model.shift = calibrate(np.array([model.margin(words[docs[i]]) for i in apart]), y[apart])
    return model


def calibrate(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve through held-back margins, with
    Platt's smoothed targets (Newton steps)."""
    pos, neg = int((y == 1).sum()), int((y == 0).sum())
    if not pos or not neg:
        return 1.0, 0.0
    target = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x = np.stack([margins, np.ones_like(margins)], axis=1)
    theta = np.array([1.0, 0.0])

    def loss(t):
        z = x @ t
        return float((np.logaddexp(0, z) - target * z).sum())

    for _ in range(100):
        p = _sigmoid(x @ theta)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (p - target))
        size = 1.0
        while size > 1e-6 and loss(theta - size * step) > loss(theta):
            size /= 2
        theta = theta - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return (float(theta[0]), float(theta[1])) if theta[0] > 0 else (1.0, 0.0)


def held_out(doc_id="doc_id"):
    """True for rows never learnt from: crc32 of the id's text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_docs: int = MAX_DOCS,
        max_chars: int = MAX_CHARS) -> Model:
    """Train on at most ``max_docs`` labelled rows that are not held out, in the order of
    their ids' hashes; a text with which the whole texts would hold more than
    ``max_chars`` is passed over."""
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
        .where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out())
        .groupBy("doc_id").agg(F.max("y").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs)
    )
    wanted = {r.doc_id: r.y for r in chosen.collect()}
    if not wanted:
        return train([], [])
    spark = docs.sparkSession
    ids = spark.createDataFrame([(i, at) for at, i in enumerate(wanted)], "doc_id long, at long")
    texts = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .join(F.broadcast(ids), "doc_id")  # at most max_docs ids
        .groupBy("doc_id", "at").agg(F.min("text").alias("text")).persist()
    )
    total, fitting = 0, []
    for r in texts.select("at", F.length("text").alias("n")).orderBy("at").collect():
        if total + (r.n or 0) <= max_chars:
            total += r.n or 0
            fitting.append(r.at)
    rows = texts.where(F.col("at").isin(fitting)).select("doc_id", "text").toArrow().sort_by("doc_id")
    texts.unpersist()
    return train(rows.column("text").to_pylist(), [wanted[i] for i in rows.column("doc_id").to_pylist()])


def scored(score, texts: pa.Array) -> list[float]:
    out: list[float] = []
    for a in range(0, len(texts), 200):
        out += score(texts.slice(a, 200).to_pylist())
    return out


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score for each row of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS * 8 bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = shared.value.scorer()
        for batch in batches:
            values = scored(score, batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.float64())], names=["doc_id", "score"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, SCORE_SCHEMA)


def filter_documents(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` that score below ``threshold``, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = shared.value.scorer()
        for batch in (b.slice(a, 1_000) for b in batches for a in range(0, b.num_rows, 1_000)):
            yield batch.filter(pa.array([s < threshold for s in scored(score, batch.column(at))], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
