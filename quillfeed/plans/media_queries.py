"""Registered queries of the image, icon and colour rules (PRJ19, PRJ22-24, PRJ26,
JOI15, FLT17, TOP3-5, AGG14-16, PRJ34). The driver tables hold no such inputs, so
markup and pixels are derived from their rows; every class and fallback occurs, and
the SQL states what must come out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillfeed import config
from quillfeed.functions.colors import fade_to_brighter
from quillfeed.operators import clean, icons
from quillfeed.plans import standins as S
from quillfeed.plans.icons_build import build_icons
from quillfeed.plans.registry import register
from quillfeed.sources.tables import read_table

# --- AGG14-16 + PRJ34: pixels ------------------------------------------------------------
# A hundred events are an image of ten by ten pixels. Every fourth image is nearly of one colour, every third opaque.
PIXELS_SQL = """
SELECT event_id // 100 AS image_id, CAST(event_id % 10 AS INTEGER) AS x, CAST(event_id // 10 % 10 AS INTEGER) AS y,
       CAST(CASE WHEN event_id // 100 % 4 = 0 THEN 200 + user_id % 5 ELSE user_id * 37 % 256 END AS INTEGER) AS r,
       CAST(CASE WHEN event_id // 100 % 4 = 0 THEN 180 ELSE event_id * 101 % 256 END AS INTEGER) AS g,
       CAST(CASE WHEN event_id // 100 % 4 = 0 THEN 90 + event_id % 3 ELSE event_id * 7 % 256 END AS INTEGER) AS b,
       CASE WHEN event_id // 100 % 3 = 0 THEN 255 WHEN event_type = 'error' THEN 0 WHEN event_type = 'signup' THEN 100
            WHEN event_type = 'click' THEN 230 ELSE 255 END AS a
FROM events"""


def event_pixels(spark: SparkSession, base: str) -> DataFrame:
    e = read_table(spark, base, "events")
    i, flat = F.col("event_id"), F.expr("event_id div 100 % 4") == 0
    kind = F.col("event_type")
    return e.select(
        F.expr("event_id div 100").alias("image_id"), (i % 10).cast("int").alias("x"), F.expr("event_id div 10 % 10").cast("int").alias("y"),
        F.when(flat, F.col("user_id") % 5 + 200).otherwise(F.col("user_id") * 37 % 256).cast("int").alias("r"),
        F.when(flat, F.lit(180)).otherwise(i * 101 % 256).cast("int").alias("g"),
        F.when(flat, i % 3 + 90).otherwise(i * 7 % 256).cast("int").alias("b"),
        F.when(F.expr("event_id div 100 % 3") == 0, 255).when(kind == "error", 0).when(kind == "signup", 100)
        .when(kind == "click", 230).otherwise(255).alias("a"))


PIXEL_COLORS_SQL = f"""
WITH p AS ({PIXELS_SQL}),
s AS (SELECT image_id, min(a) < 255 AS transparent,
             coalesce(floor(stddev_pop(r) FILTER (a <> 0)) <= {config.MONOCHROME_STD} AND floor(stddev_pop(g) FILTER (a <> 0)) <= {config.MONOCHROME_STD}
                      AND floor(stddev_pop(b) FILTER (a <> 0)) <= {config.MONOCHROME_STD}, false) AS monochromatic,
             max(y) + 1 AS h FROM p GROUP BY image_id),
o AS (SELECT image_id, x, y, {{'r': r, 'g': g, 'b': b}} AS c FROM p WHERE a >= {config.EDGE_ALPHA_MIN}),
e AS (SELECT image_id, 2 * y AS seq, arg_min(c, x) AS c FROM o GROUP BY image_id, y
      UNION ALL SELECT image_id, 2 * y + 1, arg_max(c, x) FROM o GROUP BY image_id, y
      UNION ALL SELECT o.image_id, 2 * any_value(s.h) + 2 * x, arg_min(c, y) FROM o JOIN s ON s.image_id = o.image_id GROUP BY o.image_id, x
      UNION ALL SELECT o.image_id, 2 * any_value(s.h) + 2 * x + 1, arg_max(c, y) FROM o JOIN s ON s.image_id = o.image_id GROUP BY o.image_id, x),
n AS (SELECT image_id, c, row_number() OVER (PARTITION BY image_id ORDER BY sqrt(c.r * c.r + c.g * c.g + c.b * c.b), seq) AS k,
             count(*) OVER (PARTITION BY image_id) AS n FROM e),
m AS (SELECT s.image_id, transparent, monochromatic,
             CASE WHEN transparent AND monochromatic THEN {{'r': 255, 'g': 255, 'b': 255}} ELSE n.c END AS c,
             transparent AND monochromatic AS white
      FROM s LEFT JOIN n ON n.image_id = s.image_id AND k = n // 2 + 1)
SELECT image_id, transparent, monochromatic,
       CASE WHEN white THEN '#FFFFFF' ELSE printf('#%02x%02x%02x', c.r, c.g, c.b) END AS background_color,
       printf('#%02X%02X%02X', CAST(floor(c.r + 0.12 * (255 - c.r)) AS INTEGER), CAST(floor(c.g + 0.12 * (255 - c.g)) AS INTEGER),
              CAST(floor(c.b + 0.12 * (255 - c.b)) AS INTEGER)) AS faded
FROM m"""


@register("pixel_colors", PIXEL_COLORS_SQL)
def pixel_colors(spark: SparkSession, base: str) -> DataFrame:
    """Per image: transparent, monochromatic, the upper median of its edge colours
    (or white), and that colour faded."""
    c = icons.background_color(event_pixels(spark, base))
    return c.withColumn("faded", fade_to_brighter(F.col("background_color")))


# --- JOI15, FLT17, TOP3-5, PRJ19: icons of pages ---------------------------------------------
# Head markup of a page by its id; {d} is its domain. Then the sizes of the images that it names, the icon service's and
# the logo service's answers, and what must be chosen: cover and favicon.
ICON_CASES = (
    # Icons inside the manifest come first, the one with the larger smaller side.
    ('<link rel="manifest" href="/site.json"><link rel="icon" href="/i.png"><meta property="og:image" content="/og.png">',
     {"m1.png": (60, 60), "m2.png": (90, 80), "i.png": (200, 200)}, (), None, "m2.png", "i.png"),
    # A vector image is no candidate; a reference without a scheme takes the page's.
    ('<link rel="icon" href="/i.svg"><link rel="apple-touch-icon" href="//www.{d}/a.png">',
     {"i.svg": (300, 300), "a.png": (120, 120)}, (), None, "a.png", "i.svg"),
    # Open graph where the page has no icon.
    ('<meta property="og:image" content="/big/og.png"><meta name="x" content="/no.png">', {"big/og.png": (400, 300)}, (), None, "big/og.png", "favicon.ico"),
    # Both sides too small, or all white: the logo service.
    ('<link rel="icon" href="/i.png"><link rel="icon" href="/w.png">', {"i.png": (16, 48), "w.png": "white"}, (), "logo.png", "logo.png", "i.png"),
    # The icon service wins where both of its sizes answer.
    ('<link rel="icon" href="/i.png">', {"i.png": (99, 99)}, ((128, 128), (256, 256)), "logo.png", "s256.png", "s256.png"),
    # Its 128 icon can not be read: the page's icon.
    ('<link rel="icon" href="/i.png">', {"i.png": (99, 20)}, ((128, None), (256, 256)), None, "i.png", "s256.png"),
    # Nothing at all.
    ("", {}, (), None, None, "favicon.ico"),
    # Only the favicon takes a shortcut icon.
    ('<link REL="Shortcut Icon" href="ico/s.ico">', {"ico/s.ico": (64, 64)}, (), None, None, "ico/s.ico"),
    # Equal sizes: the last; the favicon takes the first icon.
    ('<link rel="icon" href="/i1.png"><link rel="icon" href="/i2.png"><meta property="twitter:image" content="/t.png">',
     {"i1.png": (70, 80), "i2.png": (90, 70), "t.png": (500, 500)}, (), None, "i2.png", "i1.png"),
    # No readable image, but the page names one.
    ('<link rel="apple-touch-icon" href="/gone.png"><meta property="og:image:url" content="./og.png">', {}, (), None, "og.png", "gone.png"),
)
_N = len(ICON_CASES)


def _case(values: list):
    out = F.lit(None)
    for k, v in enumerate(values):
        out = F.when(F.col("page_id") % _N == k, v).otherwise(out)
    return out


def icon_tables(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """The inputs of the icon build, one domain per page."""
    p = read_table(spark, base, "pages").select(
        "page_id", "html", F.concat(F.lit("p"), F.col("page_id").cast("string"), F.lit(".example.com")).alias("domain"))
    site = F.concat(F.lit("https://www."), F.col("domain"))
    head = F.concat(F.lit("<head>"), F.replace(_case([F.lit(c[0]) for c in ICON_CASES]), F.lit("{d}"), F.col("domain")))
    pages = p.select("domain", F.concat(site, F.lit("/")).alias("url"), F.replace("html", F.lit("<head>"), head).alias("html"))
    sizes = "array<struct<path:string,width:int,height:int,all_white:boolean>>"

    def rows(case) -> str:
        return ", ".join(f"named_struct('path', '{path}', 'width', {s[0] if s != 'white' else 90}, 'height', {s[1] if s != 'white' else 90}, "
                         f"'all_white', {str(s == 'white').lower()})" for path, s in case[1].items())

    sized = p.select(site.alias("site"), F.explode(_case([F.expr(f"array({rows(c)})").cast(sizes) for c in ICON_CASES])).alias("s"))
    sized = sized.select(F.concat("site", F.lit("/"), "s.path").alias("url"), "s.width", "s.height", "s.all_white")
    service = p.select("domain", site.alias("site"), F.explode(_case([
        F.array(*[F.struct(F.lit(size).alias("size"), F.lit(side).cast("int").alias("side")) for size, side in c[2]])
        .cast("array<struct<size:int,side:int>>") for c in ICON_CASES])).alias("s"))
    service = service.select("domain", "s.size", F.concat("site", F.lit("/s"), F.col("s.size").cast("string"), F.lit(".png")).alias("url"),
                             F.col("s.side").alias("width"), F.col("s.side").alias("height"))
    logos = p.where(_case([F.lit(c[3] is not None) for c in ICON_CASES])).select(
        "domain", F.concat(site, F.lit("/logo.png")).alias("url"), F.lit(200).alias("width"), F.lit(40).alias("height"))
    manifests = p.where(F.col("page_id") % _N == 0).select(
        F.concat(site, F.lit("/site.json")).alias("url"), F.lit('{"name": "x", "icons": [{"src": "/m1.png"}, {"sizes": "1x1"}, {"src": "m2.png"}]}').alias("content"))
    corner = F.explode(F.sequence(F.lit(0), F.lit(3)))
    pixels = p.where(F.col("page_id") % _N == 2).select(F.concat(site, F.lit("/big/og.png")).alias("image_url"), "page_id", corner.alias("k"))
    pixels = pixels.select("image_url", (F.col("k") % 2).alias("x"), F.expr("k div 2").cast("int").alias("y"), (F.col("page_id") % 256).cast("int").alias("r"),
                           F.lit(90).alias("g"), (F.col("page_id") * 7 % 256).cast("int").alias("b"), F.lit(255).alias("a"))
    return {"pages": pages, "icon_sizes": sized, "service_icons": service, "logos": logos, "manifests": manifests, "pixels": pixels}


def _chosen(at: int) -> str:
    return f"CASE page_id % {_N} " + " ".join(f"WHEN {k} THEN site || '/{c[at]}'" for k, c in enumerate(ICON_CASES) if c[at]) + " END"


PAGE_ICONS_SQL = f"""
SELECT 'p' || CAST(page_id AS VARCHAR) || '.example.com' AS domain, {_chosen(4)} AS cover_url, {_chosen(5)} AS favicon_url,
       CASE page_id % {_N} WHEN 2 THEN printf('#%02x%02x%02x', CAST(page_id % 256 AS INTEGER), 90, CAST(page_id * 7 % 256 AS INTEGER)) END AS background_color
FROM (SELECT page_id, 'https://www.p' || CAST(page_id AS VARCHAR) || '.example.com' AS site FROM pages)"""


@register("page_icons", PAGE_ICONS_SQL)
def page_icons(spark: SparkSession, base: str) -> DataFrame:
    """Entry 3 over whole pages with icon markup written into their heads: cover,
    its background colour and favicon of every domain."""
    t = icon_tables(spark, base)
    b = build_icons(t["pages"], t["icon_sizes"], t["service_icons"], t["logos"], t["pixels"], manifests=t["manifests"])
    return t["pages"].select("domain").join(b.covers, "domain", "left").join(b.favicons, "domain", "left").select(
        "domain", "cover_url", "favicon_url", "background_color")


# --- PRJ19, PRJ22-24, PRJ26: images of entries ---------------------------------------------------
# The image an entry must get, by event_id % 10; {i} is its id and {site} is https://pub<user>.example.com.
ENTRY_IMAGES = ("https://img.example/{i}.jpg", "https://img.example/u{i}.jpg", "https://img.example/w{i}.jpg", "https://img.example/t{i}.jpg",
                "{site}/s/{i}.png", "https://c.example/{i}.gif", "", "", "//cdn.example/{i}.png", "{site}/i/{i}.png")
ENTRY_IMAGES_SQL = (
    "SELECT event_id, replace(replace(CASE event_id % 10 "
    + " ".join(f"WHEN {k} THEN '{x}'" for k, x in enumerate(ENTRY_IMAGES))
    + " END, '{i}', CAST(event_id AS VARCHAR)), '{site}', 'https://pub' || CAST(user_id AS VARCHAR) || '.example.com') AS img, "
    "CASE WHEN user_id % 10 <> 0 AND user_id % 3 = 0 THEN 'https://audio.example/' || CAST(event_id AS VARCHAR) END AS enclosure, "
    "CASE WHEN user_id % 10 = 0 THEN 'offer ' || CAST(event_id AS VARCHAR) END AS offers_category "
    "FROM events WHERE event_type IN ('view', 'click', 'purchase')")


def pictured_items(spark: SparkSession, base: str) -> DataFrame:
    """Feed items that carry an image in one of the six places, or none that counts."""
    it = S.feed_items(spark, base)
    i, k = F.col("ord").cast("string"), F.col("ord") % 10

    def url(before: str, after: str):
        return F.concat(F.lit(before), i, F.lit(after))

    def media(*rows):
        return F.array(*[F.struct(u.alias("url"), F.lit(w).cast("string").alias("width")) for u, w in rows])

    wide = media((url("https://img.example/n", ".jpg"), "90"), (url("https://img.example/w", ".jpg"), "300"), (url("https://img.example/l", ".jpg"), "300"),
                 (url("https://img.example/x", ".jpg"), "wide"))
    kind = F.when(F.col("content_type") == "product", "product").when(F.col("publisher_id").cast("long") % 3 == 0, "audio").otherwise("article")
    changed = {
        "image": F.when(k == 0, url("https://img.example/", ".jpg")).when(k == 1, F.lit("")),
        "urlToImage": F.when(k.isin(0, 1), url("https://img.example/u", ".jpg")),
        "media_content": F.when(k == 2, wide).when(k == 3, F.array().cast("array<struct<url:string,width:string>>")),
        "media_thumbnail": F.when(k.isin(2, 3), media((url("https://img.example/t", ".jpg"), None))),
        # A relative source is joined to the site, one with a host stays; a path of less than four characters counts as none.
        "summary": F.when(k == 4, F.concat(F.lit("<p>x<img alt='a' src='/s/"), i, F.lit(".png'></p>"))).when(k == 6, F.lit("<p>no image</p>"))
        .when(k == 7, F.lit("<img src='/a'>")).when(k == 9, F.concat(F.lit('<img class="c" src="../i/'), i, F.lit('.png">'))),
        "content_html": F.when(k == 5, F.concat(F.lit("<img alt=none><IMG SRC=\"https://c.example/"), i, F.lit('.gif">'))).when(
            k == 8, F.concat(F.lit("<img src='//cdn.example/"), i, F.lit(".png'>"))),
        "enclosures": F.array(F.struct(url("https://audio.example/", "").alias("url"), F.lit("audio/mpeg").alias("type"))),
        "item_category": url("offer ", ""), "content_type": kind,
        "site_url": F.concat("site_url", F.when(k == 9, "/news/").otherwise("")),
    }
    return it.withColumns(changed)


@register("entry_images", ENTRY_IMAGES_SQL)
def entry_images(spark: SparkSession, base: str) -> DataFrame:
    """The image of every entry (first of six places, widest medium, first ``img``
    with a source, resolved against the site), enclosures of audio, offers of products."""
    a = clean.entries_to_articles(pictured_items(spark, base), as_of=config.AS_OF)
    return a.select(F.col("ord").alias("event_id"), "img", F.col("enclosures")[0]["url"].alias("enclosure"), "offers_category")
