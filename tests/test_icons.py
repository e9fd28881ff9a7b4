"""Icons, covers and colours against plain-Python restatements."""

import math
import random

from pyspark.sql import functions as F

from quillfeed.functions.colors import fade_to_brighter
from quillfeed.operators import icons

CAND = "domain string, class string, class_rank int, ord int, url string, width int, height int, all_white boolean"


def test_best_icon_class_order_size_and_ties(spark):
    rows = [
        ("d1", "apple-touch-icon", 1, 0, "https://d1/a.png", 180, 180, False),
        ("d1", "icon", 1, 1, "https://d1/b.png", 180, 200, False),  # tie on min side -> last wins
        ("d1", "og:image", 2, 2, "https://d1/og.png", 1200, 600, False),
        ("d2", "manifest", 0, 0, "https://d2/m.svg", 512, 512, False),  # svg dropped
        ("d2", "manifest", 0, 1, "https://d2/white.png", 512, 512, True),  # all white dropped
        ("d2", "icon", 1, 2, "https://d2/tiny.png", 16, 16, False),  # too small
        ("d2", "og:image", 2, 3, "https://d2/og.png", 600, 300, False),
    ]
    df = spark.createDataFrame(rows, CAND)
    got = {r["domain"]: r["url"] for r in icons.best_icon(icons.valid_icons(df)).collect()}
    assert got == {"d1": "https://d1/b.png", "d2": "https://d2/og.png"}


def test_page_candidates(spark):
    html = ('<html><head><link rel="icon" href="/fav.png"><link rel="manifest" href="m.json">'
            '<meta property="og:image" content="//cdn.x.org/og.jpg"><meta name="twitter:image" content="https://t/no.png">'
            '<meta property="twitter:image" content="https://t/i.png"><link rel="apple-touch-icon" href="../t.png">'
            '</head><body><a href="/a">a</a></body></html>')
    p = spark.createDataFrame([(1, "https://x.org/en/page.html", html)], "page_id long, url string, html string")
    got = sorted((r["class"], r["url"]) for r in icons.page_candidates(p).collect())
    assert got == [("apple-touch-icon", "https://x.org/t.png"), ("icon", "https://x.org/fav.png"), ("manifest", "https://x.org/en/m.json"),
                   ("og:image", "https://cdn.x.org/og.jpg"), ("twitter:image", "https://t/i.png")]


def test_candidates_listed_by_class_then_place(spark):
    html = '<link rel="icon" href="/1.png"><link rel="apple-touch-icon" href="/2.png"><link rel="icon" href="/3.png">'
    p = spark.createDataFrame([(1, "https://x.org/", html)], "page_id long, url string, html string")
    got = [r["url"] for r in icons.page_candidates(p).orderBy("pos").collect()]
    assert got == ["https://x.org/2.png", "https://x.org/1.png", "https://x.org/3.png"]


def test_manifest_icons(spark):
    html = '<link rel="manifest" href="m.json"><link rel="manifest" href="other.json"><link rel="icon" href="/i.png">'
    p = spark.createDataFrame([(1, "https://x.org/en/", html), (2, "https://y.org/", html)], "page_id long, url string, html string")
    m = spark.createDataFrame([("https://x.org/en/m.json", '{"icons": [{"src": "a.png"}, {"sizes": "1x1"}, {"src": "/b.png"}]}'),
                               ("https://x.org/en/other.json", '{"icons": [{"src": "no.png"}]}'),
                               ("https://y.org/m.json", "not json")], "url string, content string")
    got = icons.manifest_icons(icons.page_candidates(p), m).orderBy("page_id", "pos").select("page_id", "class", "url").collect()
    assert [tuple(r) for r in got] == [
        (1, "manifest", "https://x.org/en/a.png"), (1, "manifest", "https://x.org/b.png"), (1, "icon", "https://x.org/i.png"),
        (2, "icon", "https://y.org/i.png")]


def test_favicon_and_cover_fallbacks(spark):
    svc = spark.createDataFrame([("b.example.com", "https://icons/b.png")], "domain string, url string")
    page = spark.createDataFrame([("a.example.com", "shortcut icon", 0, "/s.ico"), ("a.example.com", "apple-touch-icon", 1, "/t.png")],
                                 "domain string, class string, pos int, url string")
    doms = spark.createDataFrame([("a.example.com",), ("b.example.com",), ("c.example.com",)], "domain string")
    fav = {r["domain"]: r["favicon_url"] for r in icons.favicon_choice(svc, page, doms).collect()}
    assert fav == {"a.example.com": "https://www.a.example.com/s.ico", "b.example.com": "https://icons/b.png",
                   "c.example.com": "https://www.c.example.com/favicon.ico"}
    service = spark.createDataFrame([
        ("a", 256, "https://s/a256.png", 256, 40), ("a", 128, "https://s/a128.png", 20, 20),
        ("b", 256, "https://s/b256.png", 40, 40), ("b", 128, "https://s/b128.png", 128, 128),
        ("c", 256, "https://s/c256.png", 256, 256), ("c", 128, "https://s/c128.png", None, None)],
                                    "domain string, size int, url string, width int, height int")
    ic = spark.createDataFrame([("b", "icon", 1, 0, "https://b/i.png", 64, 64, False)], CAND)
    logos = spark.createDataFrame([("c", "https://logo/c.png", 40, 64), ("d", "https://logo/d.png", 40, 40)],
                                  "domain string, url string, width int, height int")
    metas = spark.createDataFrame([("c", 0, "https://c/og.png"), ("d", 0, "https://d/og.png")], "domain string, ord int, url string")
    cov = {r["domain"]: r["cover_url"] for r in icons.cover_choice(service, ic, logos, metas).collect()}
    assert cov == {"a": "https://s/a256.png", "b": "https://b/i.png", "c": "https://logo/c.png", "d": "https://d/og.png"}


def _py_background(px, w, h):
    """Reference semantics on a dict {(x, y): (r, g, b, a)}."""
    vals = [px[(x, y)] for y in range(h) for x in range(w)]
    transparent = min(v[3] for v in vals) < 255
    opaque = [v for v in vals if v[3] != 0]

    def std(i):
        xs = [v[i] for v in opaque]
        m = sum(xs) / len(xs)
        return math.sqrt(sum((x - m) ** 2 for x in xs) / len(xs))

    if transparent and opaque and all(int(std(i)) <= 85 for i in range(3)):
        return "#FFFFFF"

    def walk(x, y, dx, dy):
        while 0 <= x < w and 0 <= y < h:
            if not px[(x, y)][3] < 255 * 0.8:
                return px[(x, y)]
            x += dx
            y += dy
        return None

    cols = []
    for y in range(h):
        cols += [walk(0, y, 1, 0), walk(w - 1, y, -1, 0)]
    for x in range(w):
        cols += [walk(x, 0, 0, 1), walk(x, h - 1, 0, -1)]
    cols = [c for c in cols if c is not None]
    if not cols:
        return None
    cols.sort(key=lambda c: math.sqrt(c[0] ** 2 + c[1] ** 2 + c[2] ** 2))
    c = cols[len(cols) // 2]
    return "#" + "".join(hex(int(v))[2:].zfill(2) for v in c[:3])


def test_background_color_matches_python(spark):
    rnd = random.Random(5)
    rows, expected = [], {}
    for img in range(6):
        w, h = rnd.randint(2, 6), rnd.randint(2, 6)
        px = {}
        for y in range(h):
            for x in range(w):
                a = rnd.choice([0, 100, 255, 255, 255]) if img % 2 else 255
                base = rnd.choice([(250, 250, 250), (10, 20, 30), (200, 0, 0), (0, 0, 200)])
                px[(x, y)] = (*base, a) if img != 4 else (rnd.randint(0, 255), rnd.randint(0, 255), rnd.randint(0, 255), a)
                rows.append((img, x, y, *px[(x, y)]))
        expected[img] = _py_background(px, w, h)
    df = spark.createDataFrame(rows, "image_id int, x int, y int, r int, g int, b int, a int")
    got = {r["image_id"]: r["background_color"] for r in icons.background_color(df).collect()}
    assert got == expected


def test_fade_color(spark):
    df = spark.createDataFrame([("#000000",), ("#FF8000",), ("#123456",)], "c string")
    got = [r[0] for r in df.select(fade_to_brighter(F.col("c"))).collect()]

    def py(hx):
        t = [int(hx[i:i + 2], 16) for i in (1, 3, 5)]
        f = [min(255, max(0, int(c + 0.12 * (255 - c)))) for c in t]
        return "#{:02X}{:02X}{:02X}".format(*f)

    assert got == [py(x) for x in ("#000000", "#FF8000", "#123456")]
