"""Expected values of the reference's enrichment tests (FIXTURES.md section 6)."""

from pyspark.sql import functions as F

from quillfeed.operators import enrich

ART = "url string, title string, description string, channels array<string>"
CAND = "url string, ord long, name string, confidence double"
LONG_TITLE = "A sufficiently long article title"


def _predict(spark, channels, preds, title=LONG_TITLE, description="desc"):
    a = spark.createDataFrame([("u", title, description, channels)], ART)
    c = spark.createDataFrame([("u", i, n, conf) for i, (n, conf) in enumerate(preds)], CAND)
    out = enrich.apply_prediction(a, enrich.top_prediction(c))
    return out.first()["channels"]


def test_default_channel_unchanged(spark):
    assert _predict(spark, ["Fun"], [("Sports", 0.99)]) == ["Fun"]


def test_short_text_unchanged(spark):
    assert _predict(spark, ["channel1"], [("Sports", 0.99)], title="short", description="") == ["channel1"]


def test_excluded_and_low_confidence_ignored(spark):
    assert _predict(spark, ["channel1"], [("Crime", 0.9)]) == ["channel1"]
    assert _predict(spark, ["channel1"], [("Sports", 0.45)]) == ["channel1"]


def test_replace_and_augment(spark):
    assert _predict(spark, ["channel1", "channel2"], [("Sports", 0.9)]) == ["Sports"]
    assert set(_predict(spark, ["Politics", "Top Sources"], [("Sports", 0.9)])) == {"Sports", "Top Sources"}
    assert set(_predict(spark, ["Top News", "Top Sources"], [("Sports", 0.9)])) == {"Sports", "Top News", "Top Sources"}


def test_top_prediction_tie_keeps_first(spark):
    c = spark.createDataFrame([("u", 0, "A", 0.95), ("u", 1, "B", 0.95), ("u", 2, "C", 0.5)], CAND)
    assert enrich.top_prediction(c).first()["pred_name"] == "A"


def test_popularity_sum_and_default(spark):
    counters = spark.createDataFrame([("u1", "a", 1.0), ("u1", "b", 2.0)], "url string, source string, score double")
    arts = spark.createDataFrame([("u1",), ("u2",)], "url string")
    out = {r["url"]: r["pop_score"] for r in enrich.attach_popularity(arts, enrich.popularity_sums(counters)).collect()}
    assert out == {"u1": 3.0, "u2": 1.0}


def test_popularity_dampening(spark):
    counters = spark.createDataFrame([("u", "a", 1300.0)], "url string, source string, score double")
    arts = spark.createDataFrame([("u",)], "url string")
    got = enrich.attach_popularity(arts, enrich.popularity_sums(counters)).first()["pop_score"]
    assert abs(got - (299 + (1 + 1300 - 300) ** (2 / 3))) < 1e-9


def test_taxonomy_prefix_exact_skip(spark):
    tax = spark.createDataFrame([(" /Sports/Soccer ",), ("/Sports",), ("/News/Weather",), ("/Travel/X",)], "value string")
    rules = spark.createDataFrame(
        [("Sports", "/Sports*"), ("Weather", "/News/Weather"), ("Lifestyle", "~Travel"), ("Econ", "/Econ/Exact")],
        "channel string, pattern string",
    )
    m = {(r["category"], r["channel"]) for r in enrich.expand_taxonomy(tax, rules).collect()}
    assert m == {("/Sports/Soccer", "Sports"), ("/Sports", "Sports"), ("/News/Weather", "Weather"), ("/Econ/Exact", "Econ")}
    classes = spark.createDataFrame(
        [("a", 0, " /Sports/Soccer", 0.5), ("a", 1, "/Sports", 0.9), ("a", 2, "/News/Weather", 0.1), ("b", 0, "/News/Weather", 0.19)],
        "article_key string, ord long, name string, confidence double",
    )
    ext = {r["article_key"]: r["ext_channels"] for r in enrich.classification_channels(classes, enrich.expand_taxonomy(tax, rules)).collect()}
    assert ext == {"a": ["Sports"], "b": []}


def test_image_rules(spark):
    arts = spark.createDataFrame(
        [("u1", "http://i/big.jpg"), ("u2", "http://i/small.jpg"), ("u3", "http://i/none.jpg"), ("u4", ""), ("u5", "http://i/clip.mp4")],
        "url string, img string",
    )
    meta = spark.createDataFrame(
        [("http://i/big.jpg", 500, 500, 10, True), ("http://i/small.jpg", 200, 200, 10, True),
         ("http://i/clip.mp4", 800, 800, 10, True)],
        "url string, width int, height int, bytes long, cached boolean",
    )
    out = {r["url"]: r["img"] for r in enrich.apply_image_rules(arts, meta).collect()}
    assert out == {"u1": "http://i/big.jpg", "u2": "", "u3": "", "u4": "", "u5": ""}
    big = spark.createDataFrame([("u", "http://i/huge.jpg")], "url string, img string")
    m2 = spark.createDataFrame([("http://i/huge.jpg", 900, 900, 2_000_000, True)], "url string, width int, height int, bytes long, cached boolean")
    r = enrich.apply_image_rules(big, m2, cdn_base="https://cdn/x").first()
    assert r["img"] == "http://i/huge.jpg" and r["padded_img"].startswith("https://cdn/x/") and r["padded_img"].endswith(".jpg.pad")
    assert F is not None
