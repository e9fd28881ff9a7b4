"""Relational store as DataFrame snapshots (SET4-12, JOI4, JOI9-13, QRY1-6, AGG4, AGG9-11).

Each write returns the next snapshot of a table; ``sinks.publish_snapshot``
writes it to a new directory and flips a pointer, so a path being read is
never overwritten. Surrogate ids are ``xxhash64`` of the natural key (PRJ35),
so re-running a load produces the same ids and insert-or-get is idempotent.

Table schemas (see SURVEY section 1.2):

* publisher(id, name, url, favicon_url, cover_url, background_color, enabled, score, created, modified)
* feed(id, url, url_hash, publisher_id, category, enabled, og_images, max_entries)
* locale(id, name, locale) ; channel(id, name)
* feed_locale(id, feed_id, locale_id, rank) ; feed_locale_channel(feed_locale_id, channel_id)
* article(id, article_key, url_hash, title, publish_time, img, padded_img, category, description,
  content_type, creative_instance_id, url, pop_score, score, feed_id, created, modified)
* article_cache_record(article_id, locale_id, cache_hit)
* external_article_classification(article_id, channels, raw_data)
* feed_update_record(feed_id, last_build_time, last_build_timedelta)
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillfeed.functions.scoring import seconds_between, ts_literal
from quillfeed.functions.urls import article_key as _article_key
from quillfeed.session import cut_lineage


def surrogate_id(*cols) -> Column:
    """PRJ35 re-aimed: deterministic 64-bit id from the natural key."""
    return F.xxhash64(*[F.col(c) if isinstance(c, str) else c for c in cols])


def first_writer(df: DataFrame, key: list[str], order: list[Column | str]) -> DataFrame:
    """One row per key: the first by ``order`` (hash aggregate with ``min_by``,
    partial per task, so a hot key is collapsed before the shuffle)."""
    payload = [c for c in df.columns if c not in key]
    ordering = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    return df.groupBy(*key).agg(F.min_by(F.struct(*payload), ordering).alias("_r")).select(*key, "_r.*")


def insert_new(existing: DataFrame | None, incoming: DataFrame, key: list[str]) -> DataFrame:
    """SET4/SET5 core: rows of ``incoming`` whose key is absent are appended;
    existing rows are never updated (first writer wins)."""
    if existing is None:
        return incoming
    fresh = incoming.join(existing.select(*key), key, "left_anti")
    return existing.unionByName(fresh.select(*existing.columns))


# --- SET6: nested publishers -> six tables -------------------------------------
def normalize_publishers(pubs: DataFrame, existing: dict[str, DataFrame] | None = None,
                         as_of: _dt.datetime | None = None) -> dict[str, DataFrame]:
    """Load global publisher records (one row per publisher_id with
    ``locales: array<struct<locale, channels, rank>>`` and an ``ord``) into
    publisher, feed, locale, channel, feed_locale and feed_locale_channel.

    publisher is keyed by site url, feed by url_hash (= publisher_id), locale
    by code, channel by name; feed_locale by (feed, locale, rank) with an
    empty rank stored as the column default 0; bridge rows are distinct."""
    ex = existing or {}
    now = ts_literal(as_of) if as_of else F.current_timestamp()
    # six tables derive from the same (small) nested frame: materialise it once
    pubs = cut_lineage(pubs)

    p = first_writer(pubs, ["site_url"], ["ord"]).select(
        surrogate_id("site_url").alias("id"),
        F.col("publisher_name").alias("name"),
        F.col("site_url").alias("url"),
        "favicon_url", "cover_url", "background_color", "enabled",
        F.col("score").cast("double").alias("score"),
        now.alias("created"), now.alias("modified"),
    )
    publisher = insert_new(ex.get("publisher"), p, ["url"])

    f = first_writer(pubs, ["publisher_id"], ["ord"]).select(
        surrogate_id("publisher_id").alias("id"),
        F.col("feed_url").alias("url"),
        F.col("publisher_id").alias("url_hash"),
        "site_url", "category", "enabled",
    )
    f = f.join(publisher.select(F.col("url").alias("site_url"), F.col("id").alias("publisher_id")), "site_url", "left")
    f = f.select("id", "url", "url_hash", "publisher_id", "category", "enabled",
                 F.lit(False).alias("og_images"), F.lit(20).alias("max_entries"))
    feed = insert_new(ex.get("feed"), f, ["url_hash"])

    loc_rows = pubs.select("publisher_id", "ord", F.posexplode("locales").alias("lpos", "l")).select(
        "publisher_id", "ord", "lpos", F.col("l.locale").alias("locale"),
        F.coalesce(F.col("l.rank"), F.lit(0)).alias("rank"), F.col("l.channels").alias("channels"),
    )
    loc = loc_rows.select("locale").distinct().select(
        surrogate_id("locale").alias("id"), F.col("locale").alias("name"), "locale")
    locale = insert_new(ex.get("locale"), loc, ["locale"])

    ch_rows = loc_rows.select("publisher_id", "locale", "rank", F.explode("channels").alias("name"))
    ch = ch_rows.select(F.trim("name").alias("name")).distinct().select(surrogate_id("name").alias("id"), "name")
    channel = insert_new(ex.get("channel"), ch, ["name"])

    fl = loc_rows.select(
        surrogate_id("publisher_id").alias("feed_id"), surrogate_id("locale").alias("locale_id"), "rank"
    ).distinct().select(surrogate_id("feed_id", "locale_id", "rank").alias("id"), "feed_id", "locale_id", "rank")
    feed_locale = insert_new(ex.get("feed_locale"), fl, ["feed_id", "locale_id", "rank"])

    flc = ch_rows.select(
        surrogate_id(surrogate_id("publisher_id"), surrogate_id("locale"), F.col("rank")).alias("feed_locale_id"),
        surrogate_id(F.trim("name")).alias("channel_id"),
    ).distinct()
    feed_locale_channel = insert_new(ex.get("feed_locale_channel"), flc, ["feed_locale_id", "channel_id"])

    return {
        "publisher": publisher, "feed": feed, "locale": locale, "channel": channel,
        "feed_locale": feed_locale, "feed_locale_channel": feed_locale_channel,
    }


# --- JOI10 / AGG4: channels of a feed in a locale ------------------------------
def feed_locale_channels(t: dict[str, DataFrame]) -> DataFrame:
    """(feed_id, locale_id, channels) with channels = sorted distinct names over
    every feed_locale row of that pair (three-way join + AGG4)."""
    fl = t["feed_locale"].select(F.col("id").alias("feed_locale_id"), "feed_id", "locale_id")
    named = fl.join(t["feed_locale_channel"], "feed_locale_id", "left").join(
        t["channel"].select(F.col("id").alias("channel_id"), "name"), "channel_id", "left")
    return named.groupBy("feed_id", "locale_id").agg(F.sort_array(F.collect_set("name")).alias("channels"))


def feeds_by_locale(t: dict[str, DataFrame]) -> DataFrame:
    """QRY1 for every locale at once (locale is a column, no per-locale loop):
    feeds that exist in the locale (JOI9), their channels there (JOI10, AGG4)
    and their publisher (JOI11); constants as the reference writes them."""
    ch = feed_locale_channels(t)
    loc = t["locale"].select(F.col("id").alias("locale_id"), "locale")
    feed = t["feed"].select(F.col("id").alias("feed_id"), F.col("url").alias("feed_url"), "url_hash",
                            F.col("publisher_id").alias("pub_id"), "category", "og_images", "max_entries")
    pub = t["publisher"].select(F.col("id").alias("pub_id"), F.col("name").alias("publisher_name"),
                                F.col("url").alias("site_url"))
    return (
        ch.join(loc, "locale_id").join(feed, "feed_id").join(pub, "pub_id", "left")
        .select(
            "locale", "feed_url", "publisher_name", "category", "site_url", "og_images", "max_entries",
            F.lit("").alias("creative_instance_id"), F.lit("article").alias("content_type"),
            F.col("url_hash").alias("publisher_id"), "channels",
        )
    )


def publishers_with_locales(t: dict[str, DataFrame]) -> DataFrame:
    """QRY2 for every (publisher url, locale): one row per feed of the publisher
    with ``locales`` = [{locale, channels, rank}] of that feed in that locale."""
    fl = t["feed_locale"].select(F.col("id").alias("feed_locale_id"), "feed_id", "locale_id", "rank")
    names = fl.join(t["feed_locale_channel"], "feed_locale_id", "left").join(
        t["channel"].select(F.col("id").alias("channel_id"), "name"), "channel_id", "left"
    ).groupBy("feed_locale_id", "feed_id", "locale_id", "rank").agg(F.sort_array(F.collect_list("name")).alias("channels"))
    loc = t["locale"].select(F.col("id").alias("locale_id"), "locale")
    per_feed = names.join(loc, "locale_id").groupBy("feed_id", "locale").agg(
        F.sort_array(F.collect_list(F.struct("rank", "locale", "channels"))).alias("locales"))
    feed = t["feed"].select(F.col("id").alias("feed_id"), F.col("url").alias("feed_url"), "category", "enabled",
                            F.col("url_hash").alias("publisher_id"), F.col("publisher_id").alias("pub_id"))
    pub = t["publisher"].select(F.col("id").alias("pub_id"), F.col("name").alias("publisher_name"),
                                F.col("url").alias("site_url"), "favicon_url", "cover_url", "background_color", "score")
    return per_feed.join(feed, "feed_id").join(pub, "pub_id").select(
        "site_url", "locale", "publisher_name", "feed_url", "category", "enabled", "favicon_url", "cover_url",
        "background_color", "score", "publisher_id",
        F.transform("locales", lambda x: F.struct(x["locale"].alias("locale"), x["channels"].alias("channels"),
                                                  x["rank"].alias("rank"))).alias("locales"),
    )


def channel_names(t: dict[str, DataFrame]) -> DataFrame:
    """QRY6 / AGG11 / SRT3: distinct channel names, sorted."""
    return t["channel"].select("name").distinct().orderBy("name")


# --- articles: JOI4, SET7, SET12, JOI12, QRY3-5 ---------------------------------
def with_article_key(df: DataFrame) -> DataFrame:
    """PRJ18: url_hash + sha256(trim(title)) kept as its own column (T7)."""
    return df.withColumn("article_key", _article_key(F.col("url_hash"), F.col("title")))


ARTICLE_FIELDS = ("title", "publish_time", "img", "padded_img", "category", "description", "content_type",
                  "creative_instance_id", "url", "url_hash", "pop_score", "score")


def split_known(incoming: DataFrame, article: DataFrame) -> tuple[DataFrame, DataFrame]:
    """JOI4 + FLT16: (new, known). Known = the key is stored *and* the stored
    row has a non-empty img; everything else is processed as new."""
    usable = article.where(F.coalesce(F.col("img"), F.lit("")) != "").select("article_key")
    known = incoming.join(usable, "article_key", "left_semi")
    new = incoming.join(usable, "article_key", "left_anti")
    return new, known


def with_stored(incoming: DataFrame, article: DataFrame, columns) -> DataFrame:
    """JOI4 + FLT16 in one pass: ``incoming`` with ``_stored``, the listed columns of
    the stored article of the same key that has an image, NULL where there is none."""
    usable = article.where(F.coalesce(F.col("img"), F.lit("")) != "").select("article_key", F.struct(*columns).alias("_stored"))
    return incoming.join(usable, "article_key", "left")


def upsert_articles(article: DataFrame | None, incoming: DataFrame, feed: DataFrame, as_of: _dt.datetime) -> DataFrame:
    """SET7 + SET12 as one full outer join on article_key.

    * hit: title, publish_time, description, pop_score and score take the new
      values; img and padded_img only when the new img is non-empty; modified = as_of
    * miss: inserted with created = modified = as_of and feed_id looked up by
      the feed's url_hash (= the article's publisher_id)
    * untouched stored rows pass through unchanged.
    Several incoming copies of one key: the last by ``ord`` is applied.
    The feeds are sorted and merged with the articles, never broadcast: their files
    look small, and a broadcast takes every feed's hash through the driver."""
    now = ts_literal(as_of)
    inc = incoming
    if "ord" in inc.columns:
        payload = [c for c in inc.columns if c != "article_key"]
        inc = inc.groupBy("article_key").agg(
            F.max_by(F.struct(*payload), F.col("ord")).alias("_r")).select("article_key", "_r.*")
    feeds = feed.select(F.col("url_hash").alias("publisher_id"), F.col("id").alias("feed_id"))
    inc = inc.join(feeds.hint("merge"), "publisher_id", "left")
    new_rows = inc.select(
        surrogate_id("article_key").alias("id"), "article_key", *ARTICLE_FIELDS, "feed_id",
        now.alias("created"), now.alias("modified"),
    )
    if article is None:
        return new_rows
    o = article.alias("o")
    n = new_rows.alias("n")
    j = o.join(n, F.col("o.article_key") == F.col("n.article_key"), "full_outer")
    hit = F.col("o.article_key").isNotNull() & F.col("n.article_key").isNotNull()
    only_new = F.col("o.article_key").isNull()
    new_img = F.coalesce(F.col("n.img"), F.lit("")) != ""
    cols = []
    for c in article.columns:
        oc, nc = F.col(f"o.{c}"), F.col(f"n.{c}")
        if c in ("title", "publish_time", "description", "pop_score", "score"):
            v = F.when(hit, nc).when(only_new, nc).otherwise(oc)
        elif c in ("img", "padded_img"):
            v = F.when(hit & new_img, nc).when(hit, oc).when(only_new, nc).otherwise(oc)
        elif c == "modified":
            v = F.when(hit, now).when(only_new, nc).otherwise(oc)
        else:
            v = F.when(only_new, nc).otherwise(oc)
        cols.append(v.alias(c))
    return j.select(*cols)


def remaining_articles(article: DataFrame, published_keys: DataFrame) -> DataFrame:
    """JOI12 (QRY4): stored articles whose key is not in the published list.
    An anti join, which - unlike ``NOT IN`` - is not emptied by a NULL key."""
    return article.join(published_keys.select("article_key").where(F.col("article_key").isNotNull()),
                        "article_key", "left_anti")


def attach_article_channels(articles: DataFrame, t: dict[str, DataFrame], locale: str | None = None) -> DataFrame:
    """Channels of each article's feed: in one locale (QRY3) or across all locales (QRY4)."""
    ch = feed_locale_channels(t)
    if locale is not None:
        lid = t["locale"].where(F.col("locale") == locale).select(F.col("id").alias("locale_id"))
        ch = ch.join(lid, "locale_id", "left_semi")
    ch = ch.groupBy("feed_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("channels")))).alias("channels"))
    return articles.join(ch, "feed_id", "left").withColumn(
        "channels", F.coalesce(F.col("channels"), F.array().cast("array<string>")))


ARTICLE_RECORD = ("title", "publish_time", "img", "category", "description", "content_type", "publisher_id",
                  "publisher_name", "channels", "creative_instance_id", "url", "url_hash", "pop_score",
                  "padded_img", "score")


def _article_records(found: DataFrame, t: dict[str, DataFrame], locale: str | None) -> DataFrame:
    feed = t["feed"].select(F.col("id").alias("feed_id"), F.col("url_hash").alias("publisher_id"),
                            F.col("publisher_id").alias("_pub"))
    pub = t["publisher"].select(F.col("id").alias("_pub"), F.col("name").alias("publisher_name"))
    a = found.drop("publisher_id").join(feed, "feed_id", "left").join(pub, "_pub", "left")  # JOI11
    a = attach_article_channels(a, t, locale)  # JOI10 (+ AGG4)
    return a.select("article_key", *ARTICLE_RECORD)


def stored_articles(article: DataFrame, keys: DataFrame, t: dict[str, DataFrame], locale: str) -> DataFrame:
    """QRY3 for a set of looked-up keys: stored rows with a non-empty image
    (JOI4 + FLT16) returned as feed records, publisher via the feed (JOI11),
    channels of the feed in ``locale`` (JOI10)."""
    usable = article.where(F.coalesce(F.col("img"), F.lit("")) != "")
    found = usable.join(keys.select("article_key").distinct(), "article_key", "left_semi")
    return _article_records(found, t, locale)


def remaining_with_channels(article: DataFrame, published_keys: DataFrame, t: dict[str, DataFrame]) -> DataFrame:
    """QRY4: stored articles not published this run (JOI12), with channels of
    their feed across all locales."""
    return _article_records(remaining_articles(article, published_keys), t, None)


def article_with_external(articles: DataFrame, external: DataFrame) -> DataFrame:
    """QRY5 + JOI13: first classification row per article, left joined (T12:
    an article without one keeps NULL external columns instead of failing)."""
    first = external.groupBy("article_id").agg(
        F.min_by(F.struct("channels", "raw_data"), F.col("raw_data")).alias("_x"))
    return articles.join(first.withColumnRenamed("article_id", "id"), "id", "left").select(
        articles["*"], F.col("_x.channels").alias("external_channels"), F.col("_x.raw_data").alias("raw_data"))


# --- cache records: SET8, SET9, AGG9, AGG10 -------------------------------------
def insert_cache_records(cache: DataFrame | None, keys: DataFrame) -> DataFrame:
    """SET8: one (article_id, locale_id) record with cache_hit 0 when absent."""
    fresh = keys.select("article_id", "locale_id").distinct().withColumn("cache_hit", F.lit(0))
    return insert_new(cache, fresh, ["article_id", "locale_id"])


def increment_cache_hits(cache: DataFrame, hits: DataFrame) -> DataFrame:
    """SET9: +1 per lookup hit on an existing record (hits counted per key first)."""
    n = hits.groupBy("article_id", "locale_id").agg(F.count(F.lit(1)).alias("_n"))
    return cache.join(n, ["article_id", "locale_id"], "left").select(
        "article_id", "locale_id", (F.col("cache_hit") + F.coalesce(F.col("_n"), F.lit(0))).cast("int").alias("cache_hit"))


def cache_hit_percent(article: DataFrame, cache: DataFrame, since: Column,
                      feed_locale: DataFrame | None = None, locale: DataFrame | None = None) -> DataFrame:
    """AGG9 (per locale, when ``feed_locale``/``locale`` are given) or AGG10
    (global): count(cache records of today's articles) / count(today's articles) * 100.

    Counts *records*, not summed hits (T6). NULL when there are no articles.
    Everything is semi joins + counts: no id list goes through the driver."""
    today = article.where(F.col("created") >= since).select(F.col("id").alias("article_id"), "feed_id")
    if feed_locale is None:
        n_art = today.agg(F.count(F.lit(1)).alias("total_articles"))
        hits = cache.join(today, "article_id", "left_semi").agg(F.count("cache_hit").alias("cache_hits"))
        out = n_art.select("total_articles", hits.select("cache_hits").scalar().alias("cache_hits"))
        return out.withColumn(
            "hit_pct", F.when(F.col("total_articles") > 0, F.col("cache_hits") / F.col("total_articles") * 100.0))
    in_locale = today.join(feed_locale.select("feed_id", "locale_id").distinct(), "feed_id")
    n_art = in_locale.groupBy("locale_id").agg(F.count(F.lit(1)).alias("total_articles"))
    hits = cache.join(in_locale.select("article_id", "locale_id"), ["article_id", "locale_id"], "left_semi") \
        .groupBy("locale_id").agg(F.count("cache_hit").alias("cache_hits"))
    out = n_art.join(hits, "locale_id", "left").withColumn("cache_hits", F.coalesce("cache_hits", F.lit(0)))
    if locale is not None:
        out = out.join(locale.select(F.col("id").alias("locale_id"), "locale"), "locale_id")
    return out.withColumn(
        "hit_pct", F.when(F.col("total_articles") > 0, F.col("cache_hits") / F.col("total_articles") * 100.0))


# --- SET10 external classes ---------------------------------------------------
def insert_external_classes(existing: DataFrame | None, incoming: DataFrame, article: DataFrame) -> DataFrame:
    """SET10 + PRJ32: rows for stored articles only (semi on the article key),
    raw_data as ``[{name: confidence}]`` JSON; one row per article."""
    ids = article.select(F.col("id").alias("article_id"), "article_key")
    rows = incoming.join(ids, "article_key").select(
        "article_id", "channels",
        F.to_json(F.transform("predictions", lambda x: F.create_map(x["name"], x["confidence"]))).alias("raw_data"),
    )
    rows = first_writer(rows, ["article_id"], ["raw_data"])
    return insert_new(existing, rows, ["article_id"])


# --- SET11 / TOP6 feed high-water mark -----------------------------------------
def latest_build(records: DataFrame, key: str = "feed_id", ts: str = "last_build_time") -> DataFrame:
    """TOP6: newest record per feed; equal times go to the largest other columns."""
    payload = [c for c in records.columns if c != key]
    return records.groupBy(key).agg(F.max_by(F.struct(*payload), F.struct(ts, *[c for c in payload if c != ts])).alias("_r")).select(key, "_r.*")


def feed_high_water(existing: DataFrame | None, builds: DataFrame, as_of: _dt.datetime) -> DataFrame:
    """SET11: keep the max last_build_time per feed and its lag in seconds
    (as_of - build time); insert when absent, ignore older or equal builds."""
    b = builds.groupBy("feed_id").agg(F.max("last_build_time").alias("_t"))
    lag = seconds_between(as_of, F.col("_t"))
    new = b.select("feed_id", F.col("_t").alias("last_build_time"), lag.alias("last_build_timedelta"))
    if existing is None:
        return new
    j = existing.alias("o").join(new.alias("n"), "feed_id", "full_outer")
    newer = F.col("o.last_build_time").isNull() | (F.col("n.last_build_time") > F.col("o.last_build_time"))
    take = F.col("n.last_build_time").isNotNull() & newer
    return j.select(
        "feed_id",
        F.when(take, F.col("n.last_build_time")).otherwise(F.col("o.last_build_time")).alias("last_build_time"),
        F.when(take, F.col("n.last_build_timedelta")).otherwise(F.col("o.last_build_timedelta")).alias("last_build_timedelta"),
    )
