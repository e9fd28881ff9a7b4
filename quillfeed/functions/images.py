"""Image column expressions (PRJ22-24, PRJ27-28, FLT11-13)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillfeed import config

IMG_SRC_RE = r"""(?is)<img\b[^>]*?\ssrc\s*=\s*["']([^"']*)"""
A_HREF_ATTR_RE = r"""(?is)<a\b[^>]*?\shref\s*=\s*["']([^"']*)"""


def widest(arr: Column, width_field: str = "width") -> Column:
    """PRJ23: element with the largest int(width or 0); ties keep the first element.

    A fold over the array: the accumulator is replaced only by a strictly wider
    element, so the first of equals survives (like Python ``max``). NULL for an
    empty or NULL array."""

    def w(e):
        return F.coalesce(e[width_field].try_cast("int"), F.lit(0))  # a bad width counts as none

    return F.aggregate(
        arr,
        F.try_element_at(arr, F.lit(1)),
        lambda acc, x: F.when(w(x) > w(acc), x).otherwise(acc),
    )


def first_tag_attr(html: Column, pattern: str = IMG_SRC_RE) -> Column:
    """PRJ24: first ``<img>`` with a ``src`` (or another tag/attribute pattern); '' when none."""
    return F.regexp_extract(F.coalesce(html, F.lit("")), pattern, 1)


def pick_image(
    image: Column,
    url_to_image: Column,
    media_content: Column,
    media_thumbnail: Column,
    summary: Column,
    content_html: Column,
) -> Column:
    """PRJ22: image > urlToImage > widest media_content > widest media_thumbnail
    > first img in summary > first img in content > ''."""
    return F.coalesce(
        F.nullif(image, F.lit("")),
        F.nullif(url_to_image, F.lit("")),
        F.nullif(widest(media_content)["url"], F.lit("")),
        F.nullif(widest(media_thumbnail)["url"], F.lit("")),
        F.nullif(first_tag_attr(summary), F.lit("")),
        F.nullif(first_tag_attr(content_html), F.lit("")),
        F.lit(""),
    )


def is_video_url(img: Column) -> Column:
    """FLT12: case-sensitive suffix check against the video extensions."""
    cond = F.lit(False)
    for ext in config.VIDEO_EXTENSIONS:
        cond = cond | F.endswith(img, F.lit(ext))
    return F.coalesce(cond, F.lit(False))


def is_small_image(width: Column, height: Column, min_size: int = config.MIN_IMAGE_SIZE) -> Column:
    """FLT11: unreadable (no size) or both sides below ``min_size``."""
    return width.isNull() | height.isNull() | ((width < min_size) & (height < min_size))


def is_large_image(nbytes: Column, limit: int = config.LARGE_IMAGE_BYTES) -> Column:
    """FLT13: more than ``limit`` bytes."""
    return F.coalesce(nbytes > limit, F.lit(False))


def cdn_url(img: Column, base: str, suffix: str = ".jpg.pad") -> Column:
    """PRJ27: CDN location of a cached image, named by sha256 of its URL."""
    return F.concat(F.lit(base.rstrip("/") + "/"), F.sha2(img, 256), F.lit(suffix))
