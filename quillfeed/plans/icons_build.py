"""Entry 3: covers, favicons and background colours.

SRC8 domains -> JOI15 page candidates -> FLT17 -> TOP3 best icon -> TOP4 cover
-> TOP5 favicon -> AGG16 background colour (+ PRJ34 fade) -> SNK7 lookups.
Network fetches are re-aimed as tables: ``pages(domain, url, html)``,
``manifests(url, content)``, ``icon_sizes(url, width, height, all_white)``,
``service_icons``, ``logos(domain, url, width, height)`` and
``pixels(image_url, x, y, r, g, b, a)``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillfeed.functions.colors import fade_to_brighter
from quillfeed.operators import icons


@dataclass
class IconsBuild:
    candidates: DataFrame   # JOI15 rows per domain
    covers: DataFrame       # domain -> cover_url, background_color (SNK7 cover lookup)
    favicons: DataFrame     # domain -> favicon_url (SNK7 favicon lookup)


def build_icons(pages: DataFrame, icon_sizes: DataFrame, service_icons: DataFrame, logos: DataFrame,
                pixels: DataFrame, fade: bool = False, manifests: DataFrame | None = None) -> IconsBuild:
    domains = pages.select("domain").distinct()
    cands = icons.page_candidates(pages, key="domain")
    if manifests is not None:
        cands = icons.manifest_icons(cands, manifests, key="domain")
    else:
        cands = cands.where(F.col("class") != "manifest")  # the manifest itself is no icon
    sized = cands.join(icon_sizes, "url", "left").withColumnRenamed("pos", "ord")
    metas = cands.where(F.col("class_rank") == 2).select("domain", F.col("pos").alias("ord"), "url")
    svc = service_icons.select("domain", "size", "url", "width", "height")
    covers = icons.cover_choice(svc, sized.where(F.col("class_rank") <= 2), logos, metas)
    bg = icons.background_color(pixels.withColumnRenamed("image_url", "image_id")) \
        .select(F.col("image_id").alias("cover_url"), "background_color")
    covers = covers.join(bg, "cover_url", "left")
    if fade:
        covers = covers.withColumn("background_color", fade_to_brighter(F.col("background_color")))
    favs = icons.favicon_choice(
        service_icons.where(F.col("size") == 256).select("domain", "url"),
        cands.where(F.col("class").isin("icon", "shortcut icon", "apple-touch-icon")).select("domain", "class", "pos", "url"),
        domains,
    )
    return IconsBuild(candidates=cands, covers=covers.select("domain", "cover_url", "background_color"),
                      favicons=favs.select("domain", "favicon_url"))
