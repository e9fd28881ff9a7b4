"""Icons, covers and background colours (JOI15, FLT17, TOP3-5, AGG14-16, PRJ34).

Network scraping and image decoding are re-aimed: pages are an HTML table,
icon candidates a table of (domain, class, ord, url, width, height, ...)
with the sizes already known, and images a pixel table (image_id, x, y, r, g,
b, a). Everything is grouped aggregation keyed by domain or image; no window
spans a whole table and no pairwise comparison is made.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillfeed import config
from quillfeed.functions import urls as U
from quillfeed.functions.colors import rgb_hex
from quillfeed.session import cut_lineage

TAG_RE = r"(?is)<(?:link|meta|a)\b[^>]*>"


def _attr(tag, name: str):
    return F.regexp_extract(tag, r"""(?is)\b""" + name + r"""\s*=\s*["']([^"']*)["']""", 1)


# --- fixed values: candidate classes, in the order the candidates are listed ---
LINK_RELS = ("manifest", "apple-touch-icon", "icon", "shortcut icon")
META_PROPERTIES = ("og:image", "og:image:url", "twitter:image", "image")
CLASSES = (*LINK_RELS, *META_PROPERTIES, "link")
# ---------------------------------------------------------------------------
CLASS_ROOM = 1 << 32  # positions in a page, below the class in ``pos``


def page_candidates(pages: DataFrame, key: str = "page_id", url_col: str = "url", with_links: bool = False) -> DataFrame:
    """JOI15: page HTML -> (key, class, class_rank, pos, url, page_url) rows, one scan of the HTML.

    ``<link rel=manifest>`` (rank 0), ``<link rel=apple-touch-icon|icon>``
    (rank 1), ``<meta property=og:image|og:image:url|twitter:image|image
    content>`` (rank 2). ``shortcut icon`` links, which only the favicon choice
    takes, and with ``with_links`` the ``<a href>`` targets (class "link") have
    rank 3. ``pos`` orders a page's rows by class as listed in ``CLASSES``, then by
    place in the page. References are resolved against the page URL (PRJ19)."""
    tag = F.col("tag")
    tags = pages.select(key, F.col(url_col).alias("page_url"),
                        F.posexplode(F.regexp_extract_all("html", F.lit(TAG_RE), 0)).alias("place", "tag"))
    rel, prop = F.lower(F.trim(_attr(tag, "rel"))), F.lower(_attr(tag, "property"))
    kind = F.lower(F.regexp_extract(tag, r"^<([A-Za-z]+)", 1))
    cls = F.when((kind == "link") & rel.isin(*LINK_RELS), rel).when((kind == "meta") & prop.isin(*META_PROPERTIES), prop)
    if with_links:
        cls = cls.when(kind == "a", F.lit("link"))
    rows = tags.select(key, "page_url", "place", cls.alias("class"),
                       F.when(kind == "meta", _attr(tag, "content")).otherwise(_attr(tag, "href")).alias("href"))
    listed = F.array_position(F.array(*[F.lit(c) for c in CLASSES]), F.col("class")) - 1
    rank = (F.when(F.col("class") == "manifest", 0).when(F.col("class").isin("apple-touch-icon", "icon"), 1)
            .when(F.col("class").isin(*META_PROPERTIES), 2).otherwise(3))
    return rows.where(F.col("class").isNotNull() & (F.col("href") != "")).select(
        key, "class", rank.alias("class_rank"), (listed * CLASS_ROOM + F.col("place")).alias("pos"),
        U.resolve_against(F.col("page_url"), F.col("href")).alias("url"), "page_url")


def manifest_icons(cands: DataFrame, manifests: DataFrame, key: str = "page_id") -> DataFrame:
    """Candidates whose manifest rows are replaced by the icons inside: the page's
    first manifest is looked up in ``manifests(url, content)`` and each
    ``icons[].src`` becomes a row, resolved against the page URL. A manifest
    that is missing or no JSON gives none."""
    first = cands.where(F.col("class") == "manifest").groupBy(key).agg(
        F.min_by(F.struct("url", "page_url"), F.col("pos")).alias("_m")).select(key, "_m.*")
    icons = F.from_json("content", "icons array<struct<src:string>>")["icons"]
    rows = first.join(manifests.select("url", "content"), "url").select(
        key, "page_url", F.posexplode(icons).alias("place", "icon")).where(F.coalesce(F.col("icon.src"), F.lit("")) != "")
    rows = rows.select(key, F.lit("manifest").alias("class"), F.lit(0).alias("class_rank"), F.col("place").cast("long").alias("pos"),
                       U.resolve_against(F.col("page_url"), F.col("icon.src")).alias("url"), "page_url")
    return cands.where(F.col("class") != "manifest").unionByName(rows)


def valid_icons(cands: DataFrame, min_side: int = config.ICON_MIN_SIDE) -> DataFrame:
    """FLT17: drop .svg, unreadable (no size), all-white, or both sides < min_side."""
    return cands.where(
        ~F.lower(F.col("url")).endswith(".svg")
        & F.col("width").isNotNull() & F.col("height").isNotNull()
        & ~F.coalesce(F.col("all_white"), F.lit(False))
        & ~((F.col("width") < min_side) & (F.col("height") < min_side))
    )


def best_icon(cands: DataFrame, key: str = "domain") -> DataFrame:
    """TOP3: first non-empty class in preference order; inside it the largest
    min(width, height); ties -> the last candidate. One ``max_by`` per domain."""
    order = F.struct(-F.col("class_rank"), F.least("width", "height"), F.col("ord"))
    return cands.groupBy(key).agg(F.max_by(F.struct("url", "width", "height", "class"), order).alias("_b")) \
        .select(key, "_b.*")


def first_by_source(cands: DataFrame, key: str = "domain", rank_col: str = "source_rank") -> DataFrame:
    """TOP4 / TOP5 core: the candidate of the most preferred source per domain
    (ties -> first ``ord``)."""
    return cands.groupBy(key).agg(
        F.min_by(F.struct(*[c for c in cands.columns if c != key]), F.struct(rank_col, "ord")).alias("_b")
    ).select(key, "_b.*")


def cover_choice(service: DataFrame, icons: DataFrame, logos: DataFrame, metas: DataFrame,
                 min_side: int = config.ICON_MIN_SIDE) -> DataFrame:
    """TOP4: icon service > best page icon > logo service > page metadata image
    > NULL, per domain. The service counts only where its 128 icon is readable and
    its 256 icon, the one taken, has a side of ``min_side``; a logo needs one too."""
    big = (F.col("width") >= min_side) | (F.col("height") >= min_side)
    svc = service.groupBy("domain").agg(
        F.max(F.when((F.col("size") == 256) & big, F.col("url"))).alias("url"),
        F.bool_or((F.col("size") == 128) & F.col("width").isNotNull() & F.col("height").isNotNull()).alias("_readable"),
    ).where("_readable").select("domain", F.lit(0).alias("source_rank"), F.lit(0).alias("ord"), "url")
    best = best_icon(valid_icons(icons)).select("domain", F.lit(2).alias("source_rank"), F.lit(0).alias("ord"), "url")
    logo = logos.where(big).select("domain", F.lit(3).alias("source_rank"), F.lit(0).alias("ord"), "url")
    meta = metas.select("domain", F.lit(4).alias("source_rank"), "ord", "url")
    allc = svc.unionByName(best).unionByName(logo).unionByName(meta).where(F.col("url").isNotNull())
    return first_by_source(allc).select("domain", F.col("url").alias("cover_url"), "source_rank")


def favicon_choice(service: DataFrame, page_icons: DataFrame, domains: DataFrame) -> DataFrame:
    """TOP5 (documented intent, T10): icon service > link rel=icon > shortcut
    icon > apple-touch-icon > ``/favicon.ico``; resolved against the domain and
    kept only when it is an https URL (PRJ19, PRJ21)."""
    svc = service.select("domain", F.lit(0).alias("source_rank"), F.lit(0).alias("ord"), F.col("url").alias("href"))
    rank = F.when(F.col("class") == "icon", 1).when(F.col("class") == "shortcut icon", 2) \
        .when(F.col("class") == "apple-touch-icon", 3)
    pg = page_icons.select("domain", rank.alias("source_rank"), F.col("pos").alias("ord"), F.col("url").alias("href")) \
        .where(F.col("source_rank").isNotNull())
    dflt = domains.select("domain", F.lit(4).alias("source_rank"), F.lit(0).alias("ord"), F.lit("/favicon.ico").alias("href"))
    allc = svc.unionByName(pg).unionByName(dflt).where(F.col("href").isNotNull() & (F.col("href") != ""))
    allc = allc.withColumn("url", U.resolve_against(U.ensure_https_www(F.col("domain")), F.col("href")))
    allc = allc.where(U.is_https_url(F.col("url")))
    return first_by_source(allc).select("domain", F.col("url").alias("favicon_url"), "source_rank")


# --- pixels: AGG14, AGG15, AGG16 ---------------------------------------------
def color_stats(pixels: DataFrame, key: str = "image_id", tolerance: int = config.MONOCHROME_STD) -> DataFrame:
    """AGG14 + AGG15: population std of R, G, B over pixels with alpha != 0;
    monochromatic when int(std) <= tolerance for all three; transparent when
    any alpha < 255."""
    opaque = F.col("a") != 0
    agg = pixels.groupBy(key).agg(
        F.stddev_pop(F.when(opaque, F.col("r"))).alias("std_r"),
        F.stddev_pop(F.when(opaque, F.col("g"))).alias("std_g"),
        F.stddev_pop(F.when(opaque, F.col("b"))).alias("std_b"),
        (F.min("a") < 255).alias("transparent"),
    )
    mono = F.lit(True)
    for c in ("std_r", "std_g", "std_b"):
        mono = mono & (F.floor(F.coalesce(F.col(c), F.lit(float("nan")))) <= tolerance)
    return agg.withColumn("monochromatic", F.coalesce(mono, F.lit(False)))


def edge_colors(pixels: DataFrame, key: str = "image_id", alpha_min: int = config.EDGE_ALPHA_MIN) -> DataFrame:
    """The first sufficiently opaque pixel seen from each edge: per row from the
    left and right, per column from the top and bottom (four grouped
    min_by/max_by), with the collection sequence of the reference (rows first,
    left before right, then columns, top before bottom)."""
    dims = pixels.groupBy(key).agg((F.max("y") + 1).alias("h"))
    op = pixels.where(F.col("a") >= alpha_min)
    rgb = F.struct("r", "g", "b")
    rows = op.groupBy(key, "y").agg(F.min_by(rgb, F.col("x")).alias("first"), F.max_by(rgb, F.col("x")).alias("last"))
    cols = op.groupBy(key, "x").agg(F.min_by(rgb, F.col("y")).alias("first"), F.max_by(rgb, F.col("y")).alias("last"))
    rows = rows.select(key, F.explode(F.array(
        F.struct((F.col("y") * 2).cast("long").alias("seq"), F.col("first").alias("c")),
        F.struct((F.col("y") * 2 + 1).cast("long").alias("seq"), F.col("last").alias("c")))).alias("e"))
    cols = cols.join(dims, key).select(key, F.explode(F.array(
        F.struct((F.col("h") * 2 + F.col("x") * 2).cast("long").alias("seq"), F.col("first").alias("c")),
        F.struct((F.col("h") * 2 + F.col("x") * 2 + 1).cast("long").alias("seq"), F.col("last").alias("c")))).alias("e"))
    return rows.unionByName(cols).select(key, "e.seq", "e.c.r", "e.c.g", "e.c.b")


PLACE_ROOM = 1 << 21  # collection places of an image's edge colours: 2 * (width + height) at most


def background_color(pixels: DataFrame, key: str = "image_id") -> DataFrame:
    """AGG16: white for a transparent monochromatic image, else the upper median
    (index n // 2) of the edge colours sorted by RGB vector length, ties in
    collection order.

    Squared length and collection place make one number per edge colour (below
    2^39, exact in a double), and the median is an exact percentile of the group, no
    window: merged within each task first, with one count per number. The upper
    median is the lower one of the negated numbers."""
    place = (F.col("r") * F.col("r") + F.col("g") * F.col("g") + F.col("b") * F.col("b")).cast("long") * PLACE_ROOM + F.col("seq")
    e = cut_lineage(edge_colors(pixels, key).withColumn("place", place))
    middle = e.groupBy(key).agg((-F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY -place)")).cast("long").alias("place"))
    med = e.join(middle, [key, "place"]).select(key, rgb_hex(F.col("r"), F.col("g"), F.col("b")).alias("edge_hex"))
    st = color_stats(pixels, key)
    return st.join(med, key, "left").select(
        key, "transparent", "monochromatic",
        F.when(F.col("transparent") & F.col("monochromatic"), F.lit("#FFFFFF")).otherwise(F.col("edge_hex")).alias("background_color"),
    )
