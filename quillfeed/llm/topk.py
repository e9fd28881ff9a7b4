"""Exact top-k search by inner product, block at a time (operator 9).

Every component of a vector is a term. Candidates are dealt into units of
neighbouring ids, one row of a table each, that hold their vectors as an integer
matrix (the forward index), cut into blocks of consecutive ids. A block's
summary holds the largest and the smallest value of every term in it. For a
query the sum over the terms of the larger of ``q * max`` and ``q * min`` bounds
every score in the block.

1. Unit summaries give every query the unit with the largest bound. It is
   searched first, which gives the query a k-th score to start from.
2. Every other unit is searched for the queries whose bound for it reaches that
   score. In a unit each query takes the blocks in the order of their bounds,
   scores them through the forward index, and stops when a bound falls below its
   k-th score so far.

Queries and candidates meet as (query block, unit) pairs: a stated query set
against all rows, in blocks. A task holds one block of queries and one unit at a
time, and a pair returns only scores that can still be among the k best. The
bounds stay in their tasks: the first step returns a query's best unit of each
task, the second computes the bounds again and returns a row only for pairs that
have to be searched.

Defined results: vectors that are null, have a null or non-finite component or a
null vec_id take no part; vectors of different lengths are compared as if the
shorter were filled with zeros (an empty vector scores 0 with all); rows that
share a vec_id are one row (the largest vector), and never their own candidate;
fewer than k candidates give fewer rows; scores beyond a long are limited to its
range; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillfeed.session import cut_lineage

UNIT = 1_024  # candidates in a unit, about
BLOCK = 128  # candidates in a block of a unit
QUERY_BLOCK = 1_024  # queries in a block, about
LOW = -(2 ** 63)
UNIT_SCHEMA = "unit long, n int, dim int, kind string, ids binary, data binary, top binary, low binary"
HITS = "query_id long, vec_id long, score long"
PAIRS = "q_unit long, unit long, wanted binary, floors binary"


def quantised(vectors: DataFrame, factor: int = 256) -> DataFrame:
    """vec_id and floor(factor * x) as doubles of the vectors that take part."""
    v = F.transform("embedding", lambda x: F.floor(x.cast("double") * factor).cast("double"))
    usable = (F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
              & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(usable)
    return rows.select("vec_id", v.alias("v")).groupBy("vec_id").agg(F.max("v").alias("v"))


def numbered(rows: DataFrame, size: int) -> DataFrame:
    """``rows`` with a unit number. The ids' value range is cut into equal
    ranges, one per ``size`` rows; a range that holds more than twice its share
    is divided further by the ids' hash."""
    stats = rows.agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("lo"), F.max("vec_id").alias("hi")).first()
    n, lo, hi = max(1, -(-stats.n // size)), stats.lo or 0, stats.hi or 0
    width = max(1, -(-(hi - lo + 1) // n))
    rows = rows.withColumn("range", F.expr(f"(vec_id - {lo}L) div {width}L"))
    parts = rows.groupBy("range").agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / (2 * size))).cast("long").alias("parts"))
    rows = rows.join(parts, "range")
    return rows.select((F.col("range") * (1 << 20) + F.pmod(F.xxhash64("vec_id"), F.col("parts"))).alias("unit"), "vec_id", "v")


def _kind(m: np.ndarray) -> str:
    most = np.abs(m).max(initial=0)
    return "<i2" if most < 2 ** 15 else "<i4" if most < 2 ** 31 else "<f8"


def units(rows: DataFrame, block: int) -> DataFrame:
    """One row per unit of ``rows`` (unit, vec_id, v), see UNIT_SCHEMA;
    ``top`` and ``low`` have a line per block."""

    def build(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("vec_id")
        m = np.zeros((len(part), max((len(r) for r in part["v"]), default=0)))
        for i, r in enumerate(part["v"]):
            m[i, :len(r)] = r
        at = np.arange(0, len(m), block)
        kind = _kind(m)
        return pd.DataFrame([{
            "unit": int(key[0]), "n": len(m), "dim": m.shape[1], "kind": kind,
            "ids": part["vec_id"].to_numpy("<i8").tobytes(), "data": m.astype(kind).tobytes(),
            "top": np.maximum.reduceat(m, at, axis=0).tobytes(), "low": np.minimum.reduceat(m, at, axis=0).tobytes()}])

    return rows.groupBy("unit").applyInPandas(build, UNIT_SCHEMA)


def _matrix(data: bytes, kind: str, rows: int, dim: int) -> np.ndarray:
    return np.frombuffer(data, dtype=kind).astype(np.float64).reshape(rows, dim)


def _same_width(*ms: np.ndarray) -> list[np.ndarray]:
    dim = max(m.shape[1] for m in ms)
    return [m if m.shape[1] == dim else np.pad(m, ((0, 0), (0, dim - m.shape[1]))) for m in ms]


def scores(q: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Integer inner products as int64: in doubles where they are exact there,
    else in Python integers."""
    if np.abs(q).max(initial=0) * np.abs(d).max(initial=0) * max(1, q.shape[1]) < 2 ** 53:
        return (q @ d.T).astype(np.int64)
    as_int = np.vectorize(int, otypes=[object])
    exact = as_int(q).dot(as_int(d).T)
    return np.clip(exact, LOW, 2 ** 63 - 1).astype(np.int64)


def bounds(q: np.ndarray, top: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Per query and block the summed term maxima, an upper bound of every score
    in the block (with a margin for the rounding of doubles)."""
    b = np.maximum(q, 0) @ top.T + np.minimum(q, 0) @ low.T
    size = np.abs(q) @ np.maximum(np.abs(top), np.abs(low)).T
    return b + size * 1e-12


def search(q_ids: np.ndarray, q: np.ndarray, floor: np.ndarray, ids: np.ndarray, d: np.ndarray, top: np.ndarray,
           low: np.ndarray, k: int, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query number, id and score of candidates that may be among the k best of
    their query: ``floor`` has the k-th score known so far (LOW: none)."""
    q, d, top, low = _same_width(q, d, top, low)
    limit = bounds(q, top, low)
    order = np.argsort(-limit, axis=1, kind="stable")
    best = np.full((len(q), k), LOW, dtype=np.int64)  # the k best scores seen, ascending
    best[:, 0] = floor
    out = []
    rows = np.arange(len(q))
    for turn in range(order.shape[1]):
        at = order[:, turn]
        open_ = (limit[rows, at] >= best[:, 0]) | (best[:, 0] == LOW)
        if not open_.any():
            break
        for b in np.unique(at[open_]):
            mine = np.flatnonzero(open_ & (at == b))
            span = slice(b * block, (b + 1) * block)
            s = scores(q[mine], d[span])
            own = q_ids[mine][:, None] == ids[span][None, :]
            good = (s >= best[mine, :1]) & ~own
            i, j = np.nonzero(good)
            out.append((mine[i], ids[span][j], s[i, j]))
            both = np.concatenate([best[mine], np.where(own, LOW, s)], axis=1)
            best[mine] = np.partition(both, both.shape[1] - k, axis=1)[:, -k:]
            best[mine] = np.sort(best[mine], axis=1)
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    i, ids_, s = (np.concatenate(x) for x in zip(*out))
    keep = s >= np.maximum(best[i, 0], floor[i])
    i, ids_, s = i[keep], ids_[keep], s[keep]
    # The k best of each query: equal scores in the order of ids.
    o = np.lexsort((ids_, -s if s.min(initial=0) > LOW else -s.astype(np.float64), i))
    i, ids_, s = i[o], ids_[o], s[o]
    first = np.searchsorted(i, i, side="left")
    keep = np.arange(len(i)) - first < k
    return i[keep], ids_[keep], s[keep]


def top_k(vectors: DataFrame, k: int = 5, query_every: int = 50, unit: int = UNIT, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score of the k best candidates of every row whose
    vec_id is divisible by ``query_every``."""
    rows = cut_lineage(quantised(vectors))
    docs = cut_lineage(units(numbered(rows, unit), block))
    queries = numbered(rows.where(F.col("vec_id") % query_every == 0), QUERY_BLOCK)
    asked = cut_lineage(units(queries, block).select(
        F.col("unit").alias("q_unit"), F.col("n").alias("q_n"), F.col("dim").alias("q_dim"), F.col("kind").alias("q_kind"),
        F.col("ids").alias("q_ids"), F.col("data").alias("q_data")))

    def query_of(r) -> tuple[np.ndarray, np.ndarray]:
        return np.frombuffer(r.q_ids, "<i8"), _matrix(r.q_data, r.q_kind, r.q_n, r.q_dim)

    def summary_of(r) -> tuple[np.ndarray, np.ndarray]:
        n = -(-r.n // block)
        return _matrix(r.top, "<f8", n, r.dim), _matrix(r.low, "<f8", n, r.dim)

    def best_units(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Per query the unit with the largest bound among those of this task that
        follow each other under its query block."""
        at, ids, bound, unit = None, None, None, None
        for frame in frames:
            for r in frame.itertuples(index=False):
                if r.q_unit != at:
                    if at is not None:
                        yield pd.DataFrame({"q_unit": at, "query_id": ids, "bound": bound, "unit": unit})
                    at, (ids, q) = r.q_unit, query_of(r)
                    bound, unit = np.full(len(ids), -np.inf), np.full(len(ids), r.unit)
                wide, top, low = _same_width(q, *summary_of(r))
                b = bounds(wide, top, low).max(axis=1)
                better = (b > bound) | ((b == bound) & (r.unit > unit))
                bound, unit = np.where(better, b, bound), np.where(better, r.unit, unit)
        if at is not None:
            yield pd.DataFrame({"q_unit": at, "query_id": ids, "bound": bound, "unit": unit})

    def reached(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Pairs in which a query's bound reaches its k-th score so far, with those
        queries and scores; a query's home unit has been searched."""
        for frame in frames:
            for r in frame.itertuples(index=False):
                ids, q = query_of(r)
                q, top, low = _same_width(q, *summary_of(r))
                floor = np.frombuffer(r.all_floors, "<i8")
                go = (bounds(q, top, low).max(axis=1) >= floor) | (floor == LOW)
                go &= np.frombuffer(r.homes, "<i8") != r.unit
                if go.any():
                    yield pd.DataFrame([{"q_unit": r.q_unit, "unit": r.unit, "wanted": ids[go].tobytes(), "floors": floor[go].tobytes()}])

    def hits(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Search each pair for its wanted queries."""
        for frame in frames:
            for r in frame.itertuples(index=False):
                ids, q = query_of(r)
                wanted = np.frombuffer(r.wanted, "<i8")
                floor = np.frombuffer(r.floors, "<i8")
                by = np.argsort(wanted)
                at = np.searchsorted(wanted[by], ids)
                at[at == len(wanted)] = 0
                mine = np.flatnonzero(wanted[by][at] == ids) if len(wanted) else np.empty(0, np.int64)
                if not len(mine):
                    continue
                i, vec, s = search(ids[mine], q[mine], floor[by][at[mine]], np.frombuffer(r.ids, "<i8"),
                                   _matrix(r.data, r.kind, r.n, r.dim), *summary_of(r), k, block)
                yield pd.DataFrame({"query_id": ids[mine][i], "vec_id": vec, "score": s})

    # Query blocks times units: the stated query set against all rows, in blocks.
    # A task writes a row per query, not per query and unit.
    summaries = docs.select("unit", "n", "dim", "top", "low")
    partial = asked.crossJoin(summaries).mapInPandas(best_units, "q_unit long, query_id long, bound double, unit long")
    home = cut_lineage(partial.groupBy("q_unit", "query_id").agg(F.max(F.struct("bound", "unit"))["unit"].alias("home")))

    def packed(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        """One row of a query block's queries for one unit (at most a block's)."""
        return pd.DataFrame([{"q_unit": int(key[0]), "unit": int(key[1]), "wanted": part["query_id"].to_numpy("<i8").tobytes(),
                              "floors": np.full(len(part), LOW, "<i8").tobytes()}])

    def aligned(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        """A query block's k-th scores and home units in the order of its ids."""
        part = part.sort_values("query_id")
        return pd.DataFrame([{"q_unit": int(key[0]), "all_floors": part["kth"].to_numpy("<i8").tobytes(),
                              "homes": part["home"].to_numpy("<i8").tobytes()}])

    def searched(pairs: DataFrame) -> DataFrame:
        return pairs.join(asked, "q_unit").join(docs, "unit").mapInPandas(hits, HITS)

    first = cut_lineage(searched(home.groupBy("q_unit", F.col("home").alias("unit")).applyInPandas(packed, PAIRS)))
    floors = first.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("kth"))
    state = home.join(floors, "query_id", "left").withColumn("kth", F.coalesce("kth", F.lit(LOW).cast("long")))
    state = state.groupBy("q_unit").applyInPandas(aligned, "q_unit long, all_floors binary, homes binary")
    rest = searched(cut_lineage(asked.join(state, "q_unit").crossJoin(summaries).mapInPandas(reached, PAIRS)))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = first.unionByName(rest).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
