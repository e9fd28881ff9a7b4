"""Defaults that must equal the reference's for matching results.

Fixed values (taken from the reference's configuration, kept here together):
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

# --- fixed values -----------------------------------------------------------
POP_SCORE_CUTOFF = 300
POP_SCORE_EXPONENT = 2 / 3
POP_SCORE_RANGE = 100
PRED_DEFAULT_CHANNELS = ("Fun",)
PRED_AUGMENT_CHANNELS = ("Top Sources", "Top News", "World News", "US News", "Culture")
PRED_CONFIDENCE_THRESHOLD = 0.9
PRED_EXCLUDED_CHANNELS = ("Crime",)
EXT_AUGMENT_CHANNELS = ("Crypto", "Culture", "Top News", "Top Sources")
EXT_DEFAULT_CHANNELS = ("Fun",)
CLASSIFICATION_FLOOR = 0.2
MIN_TEXT_LEN = 20
MIN_IMAGE_SIZE = 400
LARGE_IMAGE_BYTES = 1_000_000
MAX_FEED_BYTES = 10_000_000
DEFAULT_MAX_ENTRIES = 20
MIN_LINK_PATH = 4
FUTURE_SLACK_HOURS = 1
MAX_AGE_DAYS = 60
FRESHNESS_HOURS = 3
FRESHNESS_FRACTION = 0.8
VIDEO_EXTENSIONS = (
    ".mp4", ".avi", ".mov", ".wmv", ".flv", ".mkv", ".webm", ".mpg", ".mpeg",
    ".3gp", ".ogg", ".ogv", ".rm", ".swf", ".vob",
)
PROFANITY_CUSTOM_WORDS = ("vibrators", "hedonistic")  # added to the (external) word list
COLOR_FADE = 0.12
ICON_MIN_SIDE = 50
MONOCHROME_STD = 85
EDGE_ALPHA_MIN = 204
# ---------------------------------------------------------------------------

# Stand-in clock for every query over the driver tables (events span January 2024).
AS_OF = _dt.datetime(2024, 2, 1, 0, 0, 0)
AS_OF_SQL = "TIMESTAMP '2024-02-01 00:00:00'"


# --- fixed values: channel -> external taxonomy rules ------------------------
# "prefix*" matches every taxonomy line starting with the prefix, a plain entry
# is an exact category, "~X" entries are skipped.
TAXONOMY_RULES = {
    "Business": [
        "/Business & Industrial/Business*",
        "/Finance*",
        "/News/Business News*",
        "/People & Society/Social Sciences/Economics",
    ],
    "Cars": ["/Autos & Vehicles/Motor Vehicles*"],
    "Celebrities": ["/Arts & Entertainment/Celebrities & Entertainment News"],
    "Education": [
        "/Jobs & Education/Education*",
        "/Reference/General Reference/Educational Resources",
    ],
    "Entertainment": ["/Arts & Entertainment*"],
    "Fashion": ["/Beauty & Fitness/Fashion & Style*"],
    "Film and TV": [
        "/Arts & Entertainment/Movies*",
        "/Arts & Entertainment/Entertainment Industry/Film & TV Industry",
        "/Arts & Entertainment/Events & Listings/Film Festivals",
        "/Arts & Entertainment/TV & Video*",
    ],
    "Food": [
        "/Food & Drink*",
        "/Arts & Entertainment/Events & Listings/Food & Beverage Events",
    ],
    "Gaming": ["/Games/Computer & Video Games*"],
    "Health": [
        "/Health*",
        "/Beauty & Fitness/Fitness*",
        "/Food & Drink/Cooking & Recipes/Healthy Eating",
        "/News/Health News",
        "/People & Society/Social Sciences/Psychology",
    ],
    "Home": [
        "/Home & Garden*",
        "/Computers & Electronics/Consumer Electronics/Home Automation",
    ],
    "Lifestyle": [
        "~Travel",
        "/Arts & Entertainment/Visual Art & Design/Architecture",
        "/Arts & Entertainment/Visual Art & Design/Design",
        "/Home & Garden/Home & Interior Decor",
        "/Shopping/Luxury Goods",
        "/Travel & Transportation/Tourist Destinations*",
        "/Food & Drink/Restaurants/Fine Dining",
        "/Beauty & Fitness/Fashion & Style/Fashion Designers & Collections",
    ],
    "Music": [
        "/Arts & Entertainment/Music*",
        "/Arts & Entertainment/Events & Listings/Concerts & Music Festivals",
    ],
    "Politics": ["/News/Politics*"],
    "Science": ["/Science*"],
    "Sports": ["/Sports*", "/News/Sports News"],
    "Technology": [
        "/Computers & Electronics*",
        "/Internet & Telecom*",
        "/News/Technology News",
        "/Online Communities/Social Networks",
        "/Science/Computer Science/Machine Learning & Artificial Intelligence",
        "/Business & Industrial/Aerospace & Defense/Space Technology",
    ],
    "Travel": [
        "/Travel & Transportation/Luggage & Travel Accessories*",
        "/Travel & Transportation/Specialty Travel*",
        "/Travel & Transportation/Tourist Destinations*",
        "/Travel & Transportation/Travel Agencies & Services*",
    ],
    "Weather": ["/News/Weather"],
    "World News": ["/News/World News*"],
    "*Offers": ["/Shopping/Consumer Resources/Coupons & Discount Offers"],
    "*Adult": ["/Adult"],
    "*Sensitive": ["/Sensitive Subjects*"],
    "*Religion": ["/People & Society/Religion & Belief"],
}
# ---------------------------------------------------------------------------
