"""Icons plan (entry 3), health plan (entry 4) and the default taxonomy rules."""

import datetime as dt
import os
import tempfile
import time

from quillfeed.operators import enrich
from quillfeed.plans.health import health_status, status_document
from quillfeed.plans.icons_build import build_icons


def test_icons_plan(spark):
    html_a = ('<html><head><link rel="apple-touch-icon" href="/touch.png"><link rel="icon" href="/fav.ico">'
              '<meta property="og:image" content="https://a.example.com/og.jpg"></head></html>')
    html_b = '<html><head><link rel="shortcut icon" href="/s.ico"></head></html>'
    pages = spark.createDataFrame([("a.example.com", "https://www.a.example.com/", html_a),
                                   ("b.example.com", "https://www.b.example.com/", html_b)],
                                  "domain string, url string, html string")
    sizes = spark.createDataFrame([("https://www.a.example.com/touch.png", 180, 180, False),
                                   ("https://www.a.example.com/fav.ico", 32, 32, False)],
                                  "url string, width int, height int, all_white boolean")
    svc = spark.createDataFrame([("b.example.com", 256, "https://icons/b256.png", 256, 256),
                                 ("b.example.com", 128, "https://icons/b128.png", 128, 128)],
                                "domain string, size int, url string, width int, height int")
    logos = spark.createDataFrame([], "domain string, url string, width int, height int")
    px = [("https://www.a.example.com/touch.png", x, y, 10, 20, 30, 255) for x in range(3) for y in range(3)]
    pixels = spark.createDataFrame(px, "image_url string, x int, y int, r int, g int, b int, a int")
    b = build_icons(pages, sizes, svc, logos, pixels)
    covers = {r["domain"]: (r["cover_url"], r["background_color"]) for r in b.covers.collect()}
    assert covers == {"a.example.com": ("https://www.a.example.com/touch.png", "#0a141e"),
                      "b.example.com": ("https://icons/b256.png", None)}
    favs = {r["domain"]: r["favicon_url"] for r in b.favicons.collect()}
    assert favs == {"a.example.com": "https://www.a.example.com/fav.ico", "b.example.com": "https://icons/b256.png"}


def test_health_plan(spark):
    d = tempfile.mkdtemp(prefix="qf-pub-")
    for n in ("feed.json", "feed.en_GB.json", "feed.de_DE.json", "feed.fr_FR.json", "feed.es_ES.json"):
        open(os.path.join(d, n), "w").write("[]")
    old = time.time() - 4 * 3600
    os.utime(os.path.join(d, "feed.es_ES.json"), (old, old))
    st = health_status(spark, d, ["", "en_GB", "de_DE", "fr_FR", "es_ES"], dt.datetime.utcnow())
    doc = status_document(st).collect()
    assert len(doc) == 1 and doc[0]["status"] == "success"  # 4 fresh of 5 >= floor(4.0)
    assert doc[0]["files"]["feed.es_ES.json"]["expired"] is True


def test_default_taxonomy_rules(spark):
    tax = spark.createDataFrame([("/Sports/Soccer",), ("/Travel & Transportation/Tourist Destinations/Beaches",),
                                 ("/News/Weather",)], "value string")
    m = {(r["category"], r["channel"]) for r in enrich.expand_taxonomy(tax, enrich.default_taxonomy_rules(spark)).collect()}
    assert ("/Sports/Soccer", "Sports") in m and ("/News/Weather", "Weather") in m
    assert ("/Travel & Transportation/Tourist Destinations/Beaches", "Lifestyle") in m
    assert ("/Travel & Transportation/Tourist Destinations/Beaches", "Travel") in m
