"""Dedup, ordering and scoring of articles (SRT1, SRT2, WIN1, WIN2, AGG2, AGG3, PRJ30).

Article frames carry at least ``url_hash``, ``publisher_id``, ``publish_time``
(timestamp) and ``ord`` (input ordinal used as the deterministic tiebreak).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillfeed import config
from quillfeed.functions.scoring import recency
from quillfeed.operators.windows import group_row_number


def dedup_by_url_hash(df: DataFrame, key: str = "url_hash", ts: str = "publish_time", ord_col: str = "ord",
                      group_cols: tuple = ()) -> DataFrame:
    """SRT2: one row per ``key``. The reference sorts newest first and keeps the
    dict position of the first copy but the content of the last, so:

    * ``pos_ts`` / ``pos_ord`` - time and ordinal of the newest copy (position)
    * every other column        - taken from the oldest copy (content)
    * ``n_copies``              - how many copies were merged

    Ties on time resolve by input ordinal exactly like a stable sort: the
    position copy is the earliest ordinal among the newest, the content copy
    the latest ordinal among the oldest. One hash aggregate with map-side
    partial aggregation, so a hot key collapses before the shuffle.
    """
    payload = [c for c in df.columns if c != key and c not in group_cols]
    ts_c, ord_c = F.col(ts), F.col(ord_col)
    agg = df.groupBy(*group_cols, key).agg(
        F.max_by(F.struct(ts_c.alias("t"), ord_c.alias("o")), F.struct(ts_c, -ord_c)).alias("_pos"),
        F.min_by(F.struct(*payload), F.struct(ts_c, -ord_c)).alias("_rec"),
        F.count(F.lit(1)).alias("n_copies"),
    )
    return agg.select(
        *group_cols,
        key,
        F.col("_pos.t").alias("pos_ts"),
        F.col("_pos.o").alias("pos_ord"),
        *[F.col(f"_rec.{c}").alias(c) for c in payload],
        "n_copies",
    )


def add_variety(df: DataFrame, publisher: str = "publisher_id", strategy: str = "range", group_cols: tuple = ()) -> DataFrame:
    """WIN1: the k-th article of a publisher in output order (newest position
    first) gets variety 2**k (first = 2). Skew-safe numbering by default."""
    numbered = group_row_number(
        df, [*group_cols, publisher], [F.col("pos_ts").desc(), F.col("pos_ord").asc()], out="variety_rank", strategy=strategy
    )
    return numbered.withColumn("variety", F.pow(F.lit(2.0), F.col("variety_rank").cast("double")))


def add_score(df: DataFrame, as_of: _dt.datetime = config.AS_OF, ts: str = "publish_time") -> DataFrame:
    """PRJ30 + WIN2: score = recency(publish_time of the kept content) * variety.
    Lower is better; the feed order stays by position, not by score. 2**k beyond
    1023 is +Infinity, written as null by the JSON sink (as in the reference)."""
    return df.withColumn("recency", recency(F.col(ts), as_of)).withColumn(
        "score", F.col("recency") * F.col("variety")
    )


def newest_first(df: DataFrame, group_cols: tuple = ()) -> DataFrame:
    """SRT1: global output order (range-partitioned sort, no single-task window)."""
    return df.orderBy(*group_cols, F.col("pos_ts").desc(), F.col("pos_ord").asc())


def rank_articles(df: DataFrame, as_of: _dt.datetime = config.AS_OF, strategy: str = "range", sort: bool = True,
                  group_cols: tuple = ()) -> DataFrame:
    """SRT2 -> WIN1 -> WIN2 -> SRT1 (section 3.1 step 11); ``group_cols`` (e.g.
    locale) make one independent feed per group inside the same job."""
    d = dedup_by_url_hash(df, group_cols=group_cols)
    out = add_score(add_variety(d, strategy=strategy, group_cols=group_cols), as_of=as_of)
    return newest_first(out, group_cols) if sort else out


def popularity_bounds(df: DataFrame, col: str = "pop_score") -> DataFrame:
    """AGG2: one-row frame of global min/max (partial aggregates per task, one tiny final merge)."""
    return df.agg(F.min(col).alias("_pop_min"), F.max(col).alias("_pop_max"))


def normalize_popularity(df: DataFrame, col: str = "pop_score", out: str | None = None,
                         pop_range: float = config.POP_SCORE_RANGE, group_cols: tuple = ()) -> DataFrame:
    """AGG3: max(range * (x-min)/(max-min), 1.0); 1.0 when max == min.

    Without ``group_cols`` the bounds are scalar subqueries over AGG2: Spark
    merges them into one global aggregate (partial per task, one tiny final
    merge) and inlines the two values - no join and no single-partition window.
    With ``group_cols`` (one run per locale) the bounds are one row per group,
    joined back by an equi join; AQE turns it into a broadcast from the
    measured size of the (tiny) bounds stage - no extra job to prove it."""
    out = out or col
    x = F.col(col)
    if group_cols:
        b = df.groupBy(*group_cols).agg(F.min(col).alias("_pop_min"), F.max(col).alias("_pop_max"))
        df = df.join(b, list(group_cols), "left")
        lo, hi = F.col("_pop_min"), F.col("_pop_max")
    else:
        b = popularity_bounds(df, col)
        lo, hi = b.select("_pop_min").scalar(), b.select("_pop_max").scalar()
    norm = F.when(hi == lo, F.lit(1.0)).otherwise(F.lit(float(pop_range)) * ((x - lo) / (hi - lo)))
    res = df.withColumn(out, F.greatest(norm, F.lit(1.0)))
    return res.drop("_pop_min", "_pop_max") if group_cols else res
