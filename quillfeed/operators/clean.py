"""Cleaning and validation of feed entries into articles (PRJ8-28, FLT1-6).

``entries_to_articles`` is the whole per-entry mapping of the reference as one
projection + filter over a DataFrame of feed items joined with their
publisher: every step is a JVM column expression, so the stage stays inside
whole-stage codegen and scales with the number of entries.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillfeed import config
from quillfeed.functions import text as TX
from quillfeed.functions import urls as U
from quillfeed.functions.images import pick_image
from quillfeed.functions.scoring import ts_literal
from quillfeed.functions.timeparse import parse_feed_time
from quillfeed.session import cut_lineage


def _nz(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def pick_link(link: Column, url: Column) -> Column:
    """PRJ11: link, else url, else NULL (FLT3 drops NULL)."""
    return F.coalesce(_nz(link), _nz(url))


def drop_home_links(df: DataFrame, col: str = "link", min_path: int = config.MIN_LINK_PATH) -> DataFrame:
    """FLT4: path shorter than ``min_path`` characters (the link is a home page)."""
    return df.where(F.length(U.url_path(F.col(col))) >= min_path)


def in_time_window(ts: Column, content_type: Column, as_of: _dt.datetime, max_age_days: int = config.MAX_AGE_DAYS,
                   slack_hours: int = config.FUTURE_SLACK_HOURS) -> Column:
    """FLT6: products always pass; others need as_of+slack-max_age <= ts <= as_of+slack (inclusive)."""
    hi = ts_literal(as_of + _dt.timedelta(hours=slack_hours))
    lo = ts_literal(as_of + _dt.timedelta(hours=slack_hours) - _dt.timedelta(days=max_age_days))
    t = ts.cast("timestamp")
    return F.coalesce(content_type == "product", F.lit(False)) | ((t >= lo) & (t <= hi))


def time_window_keep(ts: Column, content_type: Column, as_of: _dt.datetime, max_age_days: int = config.MAX_AGE_DAYS,
                     slack_hours: int = config.FUTURE_SLACK_HOURS) -> Column:
    """FLT5 + FLT6 as one predicate that reads the time once:
    |t - mid| <= half-width of the window (inclusive), any parsed time for
    products, NULL (dropped) when the time did not parse."""
    hi = as_of + _dt.timedelta(hours=slack_hours)
    lo = hi - _dt.timedelta(days=max_age_days)
    epoch = _dt.datetime(1970, 1, 1)
    lo_us = (lo - epoch) // _dt.timedelta(microseconds=1)
    hi_us = (hi - epoch) // _dt.timedelta(microseconds=1)
    mid2 = lo_us + hi_us  # compare 2*t with lo+hi to stay in integers
    half2 = hi_us - lo_us
    limit = F.when(F.coalesce(content_type == "product", F.lit(False)), F.lit(4_000_000_000_000_000_000)).otherwise(F.lit(half2))
    return F.abs(F.unix_micros(ts.cast("timestamp")) * 2 - F.lit(mid2)) <= limit


BROADCAST_WORDS = 200_000  # entries of a word list, some 10 MB


def raw_time() -> Column:
    """PRJ12: the first date of an entry that is not empty (no fall-through)."""
    return F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in ("updated", "published", "feed_updated", "feed_published")])


def rejected_times(items: DataFrame) -> DataFrame:
    """PRJ13 side output: per feed and date text that no layout fits, the number of
    entries lost to it (FLT5); a NULL text counts the entries without any date."""
    r = items.select("feed_url", raw_time().alias("raw"))
    return r.where(parse_feed_time(F.col("raw")).isNull()).groupBy("feed_url", "raw").agg(F.count(F.lit(1)).alias("n"))


def flag_listed_words(rows: DataFrame, key: str, text: str, words: DataFrame) -> DataFrame:
    """FLT2 with a list of any size: per row of ``rows`` (one per ``key``) that holds a
    listed word or phrase, the number of different ones and the first by name.

    ``words(word)`` is cut into words like the texts; a phrase matches where its words
    follow one another. Each text is cut once; its distinct words, and its word
    sequences of the lengths that phrases of the list have, meet the list in one
    equality join: the list is broadcast up to BROADCAST_WORDS entries, by its
    count, and sorted and merged beyond. The texts' side never is, however small
    Spark takes it to be before its words are dealt out."""
    listed = words.select(F.array_join(TX.words_of(F.col("word")), " ").alias("entry")).where("entry <> ''").distinct()
    listed = cut_lineage(listed.withColumn("size", F.size(F.split("entry", " "))))
    counts = {r["size"]: r["count"] for r in listed.groupBy("size").count().collect()}  # by the words of a phrase
    sizes = sorted(counts)
    small = sum(counts.values()) <= BROADCAST_WORDS
    listed = F.broadcast(listed.select("entry")) if small else listed.select("entry").hint("merge")
    cut = rows.select(F.col(key).alias("_key"), TX.words_of(F.col(text)).alias("w"))

    def grams(w: Column, n: int) -> Column:
        if n == 1:
            return F.array_distinct(w)
        starts = F.when(F.size(w) >= n, F.sequence(F.lit(1), F.size(w) - (n - 1))).otherwise(F.array().cast("array<int>"))
        return F.array_distinct(F.transform(starts, lambda i: F.array_join(F.slice(w, i, n), " ")))

    every = F.flatten(F.array(*[grams(F.col("w"), n) for n in sizes])) if sizes else F.array().cast("array<string>")
    hits = cut.select("_key", F.explode(every).alias("entry")).join(listed, "entry")
    return hits.groupBy(F.col("_key").alias(key)).agg(F.count(F.lit(1)).alias("n_listed"), F.min("entry").alias("first_listed"))


def entries_to_articles(
    items: DataFrame,
    as_of: _dt.datetime,
    profanity=(),
    min_path: int = config.MIN_LINK_PATH,
    max_age_days: int = config.MAX_AGE_DAYS,
    time_filter: bool = True,
) -> DataFrame:
    """Map feed items (with publisher columns) to articles, dropping invalid ones.

    Expected item columns: title, link, url, updated, published, feed_updated,
    feed_published, description, image, urlToImage, media_content,
    media_thumbnail, summary, content_html, enclosures, item_category, plus the
    two publisher attributes the rules read: content_type (FLT6, PRJ26) and
    site_url (PRJ19). Other publisher columns present (category, ids, names,
    channels, locale, ...) pass through unchanged.
    """
    a = items.where(F.length(F.col("title")) > 0)  # FLT1
    # PRJ9 + PRJ10, titles decoded twice; plain values are left alone
    t = F.col("title")
    marked = F.instr(t, "<") + F.instr(t, "&") > 0
    a = a.withColumn("title", F.when(marked, TX.title_text(t)).otherwise(t))
    if profanity:
        a = a.where(~TX.contains_listed_word(F.col("title"), profanity))  # FLT2
    a = a.withColumn("link", pick_link(F.col("link"), F.col("url"))).where(F.col("link").isNotNull())  # PRJ11/FLT3
    a = a.where(F.length(U.url_path(F.col("link"))) >= min_path)  # FLT4
    a = a.withColumn("publish_time", parse_feed_time(raw_time()))  # PRJ12 (first non-empty, no fall-through) + PRJ13
    if time_filter:  # FLT5 + FLT6 (a caller that materialises the rows first applies it afterwards)
        a = a.where(time_window_keep(F.col("publish_time"), F.col("content_type"), as_of, max_age_days))
    raw_img = pick_image(
        F.col("image"), F.col("urlToImage"), F.col("media_content"), F.col("media_thumbnail"),
        F.col("summary"), F.col("content_html"),
    )  # PRJ22-24
    resolved = F.when(
        (raw_img != "") & (U.url_netloc(raw_img) == ""), U.resolve_against(F.col("site_url"), raw_img)
    ).otherwise(raw_img)  # PRJ19 (join against the site when there is no host)
    img = F.when((raw_img != "") & (F.length(U.url_path(raw_img)) < 4), F.lit("")).otherwise(resolved)
    passthrough = [c for c in ("category", "publisher_id", "publisher_name", "channels", "creative_instance_id",
                               "ord", "pos", "locale", "feed_url", "site_url", "og_images", "max_entries")
                   if c in items.columns]
    return a.select(
        "title",
        "link",
        "publish_time",
        img.alias("img"),
        F.when(_nz(F.col("description")).isNull(), F.lit(""))
        .when(F.instr(F.col("description"), "<") + F.instr(F.col("description"), "&") > 0, TX.html_to_text(F.col("description")))
        .otherwise(F.col("description")).alias("description"),
        F.col("content_type"),
        F.when(F.col("content_type") == "audio", F.col("enclosures")).alias("enclosures"),  # PRJ26
        F.when(F.col("content_type") == "product", F.col("item_category")).alias("offers_category"),
        *passthrough,
    )


def close_redirects(redirects: DataFrame) -> DataFrame:
    """(src, final) of every URL of ``redirects(src, dst, status)``: the end of its
    chain, null where the chain meets a failed response (status outside 200-399)
    or runs in a circle.

    Repeated fetches of a URL collapse to the lowest status, then the smallest
    target. Pointer jumping doubles the distance each row has gone, so a chain of
    n hops is closed after about log2(n) joins; when a round closes no further
    row, what is left are circles and chains into them."""
    one = redirects.groupBy("src").agg(F.min_by(F.struct("dst", "status"), F.struct("status", "dst")).alias("_r"))
    ok = F.coalesce(F.col("_r.status").between(200, 399), F.lit(False))
    t = cut_lineage(one.select(
        "src", F.when(ok, F.coalesce("_r.dst", "src")).alias("to"), (~ok | F.col("_r.dst").isNull()).alias("closed")))
    left = None
    while True:
        step = t.select(F.col("src").alias("to"), F.col("to").alias("_next"), F.col("closed").alias("_end"))
        open_ = t.where("not closed").join(step, "to", "left").select(
            "src", F.when(F.col("_end").isNull(), F.col("to")).otherwise(F.col("_next")).alias("to"),
            F.coalesce("_end", F.lit(True)).alias("closed"))
        t = cut_lineage(t.where("closed").unionByName(open_))
        now = t.where("not closed").count()
        if not now or now == left:
            return t.select("src", F.when(F.col("closed"), F.col("to")).alias("final"))
        left = now


def resolve_urls(articles: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """JOI3 + FLT7 + PRJ16 + PRJ17: each link becomes the end of its redirect chain
    (a link without a redirect row is final); links whose chain fails or is
    circular are dropped. Then hash the resolved URL and percent-encode its path.
    The links are joined once, with the closed redirect table."""
    a = articles.withColumn("_u", F.col("link"))
    if redirects is not None:
        closed = close_redirects(redirects).select(F.col("src").alias("_u"), "final", F.lit(True).alias("_moved"))
        a = a.join(closed, "_u", "left").where("_moved is null or final is not null")
        a = a.withColumn("_u", F.coalesce("final", "_u")).drop("final", "_moved")
    return (
        a.withColumn("url_hash", U.url_hash(F.col("_u")))
        .withColumn("url", U.reencode_url(F.col("_u")))
        .drop("_u", "link")
    )


def scrub_strings(df: DataFrame, skip=("url", "url_hash", "img", "padded_img", "publisher_id")) -> DataFrame:
    """PRJ8 over every string column in one projection (never fails a row).
    Values without ``<`` or ``&`` cannot change, so the regexes only run on
    values that contain one of them."""
    def scrub(c):
        return F.when(F.instr(c, "<") + F.instr(c, "&") > 0, TX.scrub_html(c)).otherwise(c)

    return df.select(*[
        scrub(F.col(f.name)).alias(f.name)
        if f.dataType.simpleString() == "string" and f.name not in skip else F.col(f.name)
        for f in df.schema.fields
    ])
