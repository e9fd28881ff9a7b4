"""Enrichment joins: popularity, predicted channels, taxonomy channels, images.

Network lookups of the reference are re-aimed as joins against tables that
already hold the responses (popularity counters, prediction candidates,
classifier output, image/page metadata).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillfeed import config
from quillfeed.functions.images import cdn_url, is_large_image, is_small_image, is_video_url
from quillfeed.functions.scoring import dampen_popularity


# --- popularity (AGG1, JOI5, PRJ29) -------------------------------------------
def popularity_sums(counters: DataFrame, key: str = "url", value: str = "score") -> DataFrame:
    """AGG1: sum of per-source counters per URL (partial sums map-side)."""
    return counters.groupBy(key).agg(F.sum(value).alias("pop_raw"))


def attach_popularity(
    articles: DataFrame,
    sums: DataFrame,
    key: str = "url",
    cutoff: float = config.POP_SCORE_CUTOFF,
    exponent: float = config.POP_SCORE_EXPONENT,
) -> DataFrame:
    """JOI5 + PRJ29: left join on URL; no counters -> 1.0 (a real 0 stays 0);
    then the dampening curve above the cutoff."""
    j = articles.join(sums, key, "left")
    raw = F.coalesce(F.col("pop_raw"), F.lit(1.0))
    return j.withColumn("pop_raw", raw).withColumn("pop_score", dampen_popularity(raw, cutoff, exponent))


# --- predicted channels (TOP2, FLT9, PRJ31, JOI6) ------------------------------
def top_prediction(cands: DataFrame, key: str = "url") -> DataFrame:
    """TOP2: highest confidence per article; ties -> earliest ``ord`` (stable sort order)."""
    best = F.max_by(
        F.struct(F.col("name"), F.col("confidence")),
        F.struct(F.col("confidence"), -F.col("ord")),
    )
    return cands.groupBy(key).agg(best.alias("_best")).select(
        key, F.col("_best.name").alias("pred_name"), F.col("_best.confidence").alias("pred_confidence")
    )


def _arr(values) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def prediction_gate(
    channels: Column,
    title: Column,
    description: Column,
    default_channels=config.PRED_DEFAULT_CHANNELS,
    min_text_len: int = config.MIN_TEXT_LEN,
) -> Column:
    """True when the article must keep its channels without asking for a prediction."""
    text_len = F.length(F.concat(F.coalesce(description, F.lit("")), F.coalesce(title, F.lit(""))))
    return F.coalesce(F.arrays_overlap(channels, _arr(default_channels)), F.lit(False)) | (text_len < min_text_len)


def apply_prediction(
    articles: DataFrame,
    top: DataFrame,
    key: str = "url",
    default_channels=config.PRED_DEFAULT_CHANNELS,
    augment_channels=config.PRED_AUGMENT_CHANNELS,
    excluded_channels=config.PRED_EXCLUDED_CHANNELS,
    threshold: float = config.PRED_CONFIDENCE_THRESHOLD,
    min_text_len: int = config.MIN_TEXT_LEN,
    only: Column | None = None,
) -> DataFrame:
    """JOI6 + FLT9 + PRJ31, for all articles or those where ``only`` holds: keep channels unless the gate passes and the best
    prediction is confident and not excluded; then the prediction replaces the
    channels, keeping (after it) the article's augment channels in article order."""
    j = articles.join(top, key, "left")
    ch = F.col("channels")
    keep = (
        prediction_gate(ch, F.col("title"), F.col("description"), default_channels, min_text_len)
        | F.col("pred_name").isNull()
        | F.col("pred_name").isin(*excluded_channels)
        | (F.col("pred_confidence") < threshold)
    )
    if only is not None:
        keep = ~only | keep
    aug = F.array_intersect(ch, _arr(augment_channels))
    new = F.concat(F.array(F.col("pred_name")), aug)
    return j.withColumn("channels", F.when(keep, ch).otherwise(new))


# --- taxonomy channels (SRC7, JOI7, JOI8, FLT10, SET3, QRY7) -------------------
def default_taxonomy_rules(spark) -> DataFrame:
    """The default (channel, pattern) rule table (``config.TAXONOMY_RULES``)."""
    rows = [(ch, pat) for ch, pats in config.TAXONOMY_RULES.items() for pat in pats]
    return spark.createDataFrame(rows, "channel string, pattern string")


def expand_taxonomy(taxonomy: DataFrame, rules: DataFrame) -> DataFrame:
    """JOI7: (category, channel) pairs. ``prefix*`` rules match every taxonomy
    line starting with the prefix, plain rules map their exact text, ``~`` rules
    are skipped. Each category is listed under all its prefixes, so both kinds of
    rule are equality joins."""
    cat = taxonomy.select(F.trim(F.col("value")).alias("category")).where(F.col("category") != "").distinct()
    r = rules.select("channel", "pattern").where(~F.startswith(F.col("pattern"), F.lit("~")))
    prefix = r.where(F.endswith(F.col("pattern"), F.lit("*"))).select(
        "channel", F.expr("substring(pattern, 1, length(pattern) - 1)").alias("prefix")
    )
    exact = r.where(~F.endswith(F.col("pattern"), F.lit("*"))).select(F.col("pattern").alias("category"), "channel")
    starts = F.transform(F.sequence(F.lit(0), F.length("category")), lambda n: F.substring(F.col("category"), F.lit(1), n))
    by_prefix = cat.withColumn("prefix", F.explode(starts)).join(prefix, "prefix").select("category", "channel")
    return by_prefix.unionByName(exact).distinct()


def classification_channels(
    classes: DataFrame,
    mapping: DataFrame,
    key: str = "article_key",
    floor: float = config.CLASSIFICATION_FLOOR,
) -> DataFrame:
    """FLT10 + JOI8 + SET3: categories at or above the floor, trimmed, mapped to
    channels, de-duplicated per article (sorted for a stable order). Articles
    whose categories all fall out get an empty array.

    One pass: classes left-join the mapping (small, AQE broadcasts it by its
    measured size) and ``collect_set`` keeps only surviving channels (NULLs are
    skipped), partially aggregated per task before the shuffle on the key."""
    c = classes.select(key, F.trim(F.col("name")).alias("category"), "confidence")
    j = c.join(mapping.select("category", "channel"), "category", "left")
    kept = F.when(F.col("confidence") >= floor, F.col("channel"))
    return j.groupBy(key).agg(F.sort_array(F.collect_set(kept)).alias("ext_channels"))


def external_channels(
    articles: DataFrame,
    ext: DataFrame,
    key: str = "article_key",
    default_channels=config.EXT_DEFAULT_CHANNELS,
    augment_channels=config.EXT_AUGMENT_CHANNELS,
    min_text_len: int = config.MIN_TEXT_LEN,
) -> DataFrame:
    """QRY7: gated external channels; augment channels of the article appended
    after the classifier's channels. Gated or unclassified articles get [] (T14)."""
    j = articles.join(ext, key, "left")
    gated = prediction_gate(F.col("channels"), F.col("title"), F.col("description"), default_channels, min_text_len)
    found = F.coalesce(F.col("ext_channels"), F.array().cast("array<string>"))
    aug = F.array_intersect(F.col("channels"), _arr(augment_channels))
    return j.withColumn(
        "ext_channels", F.when(gated, F.array().cast("array<string>")).otherwise(F.concat(found, aug))
    )


# --- images (FLT11-13, PRJ28, JOI14) -------------------------------------------
def apply_image_rules(
    articles: DataFrame,
    image_meta: DataFrame,
    page_meta: DataFrame | None = None,
    og_col: str = "og_images",
    min_size: int = config.MIN_IMAGE_SIZE,
    large_bytes: int = config.LARGE_IMAGE_BYTES,
    cdn_base: str = "https://cdn.example.invalid/cache",
) -> DataFrame:
    """FLT11-13, JOI14 and PRJ28 in the reference's order.

    1. ``image_meta(url, width, height, bytes, cached)`` of the article's image:
       a video suffix, no readable size or both sides < ``min_size`` blank img;
    2. og:image from ``page_meta(url, og_image)`` replaces img when img is now
       empty or the publisher forces open-graph images (``og_col``);
    3. padded_img = img; a large original image (> ``large_bytes``) uses the CDN
       copy when it was cached, otherwise img and padded_img are both blanked."""
    m = image_meta.select(
        F.col("url").alias("img"), F.col("width").alias("_w"), F.col("height").alias("_h"),
        F.col("bytes").alias("_b"), F.col("cached").alias("_cached"),
    )
    a = articles.join(m, "img", "left")
    has_img = F.coalesce(F.col("img"), F.lit("")) != ""
    unusable = is_video_url(F.col("img")) | is_small_image(F.col("_w"), F.col("_h"), min_size)
    a = a.withColumn("_large", has_img & is_large_image(F.col("_b"), large_bytes))
    a = a.withColumn("img", F.when(~has_img | unusable, F.lit("")).otherwise(F.col("img")))
    if page_meta is not None:
        a = a.join(page_meta.select("url", "og_image"), "url", "left")
        force = F.coalesce(F.col(og_col), F.lit(False)) if og_col in a.columns else F.lit(False)
        use_og = ((F.col("img") == "") | force) & (F.coalesce(F.col("og_image"), F.lit("")) != "")
        a = a.withColumn("img", F.when(use_og, F.col("og_image")).otherwise(F.col("img"))).drop("og_image")
    cached = F.coalesce(F.col("_cached"), F.lit(False))
    large = F.col("_large")
    padded = F.when(large & cached, cdn_url(F.col("img"), cdn_base)).when(large, F.lit("")).otherwise(F.col("img"))
    img = F.when(large & ~cached, F.lit("")).otherwise(F.col("img"))
    return a.withColumn("padded_img", padded).withColumn("img", img).drop("_w", "_h", "_b", "_cached", "_large")
