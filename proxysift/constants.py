"""Fixed values of the data model."""

from __future__ import annotations

import math

# --- fixed values: results depend on these exact texts and numbers ------------------

WORD_ERROR = "word_error"
SCORE_ERROR = -1.0
NO_DOMAIN = "None"
NO_VALUE = "-"
NO_METHOD = "null"
UNKNOWN_CONTENT_TYPE = "unknown_content_type"
UNKNOWN_RESPONSE_CODE = "unknown_response_code"
OWN_DOMAIN = "intel"

ENTROPY_CUTS = (
    0.0, 0.3, 0.6, 0.9, 1.2, 1.5, 1.8, 2.1, 2.4, 2.7,
    3.0, 3.3, 3.6, 3.9, 4.2, 4.5, 4.8, 5.1, 5.4, math.inf,
)

TOP_LEVEL_DOMAINS = ("com", "org", "net", "int", "edu", "gov", "mil")

COUNTRY_CODES = (
    "", "ac", "ad", "ae", "af", "ag", "ai", "al", "am", "an", "ao", "aq", "ar", "as", "at",
    "au", "aw", "ax", "az", "ba", "bb", "bd", "be", "bf", "bg", "bh", "bi", "bj", "bm", "bn",
    "bo", "bq", "br", "bs", "bt", "bv", "bw", "by", "bz", "ca", "cc", "cd", "cf", "cg", "ch",
    "ci", "ck", "cl", "cm", "cn", "co", "cr", "cu", "cv", "cw", "cx", "cy", "cz", "de", "dj",
    "dk", "dm", "do", "dz", "ec", "ee", "eg", "eh", "er", "es", "et", "eu", "fi", "fj", "fk",
    "fm", "fo", "fr", "ga", "gb", "gd", "ge", "gf", "gg", "gh", "gi", "gl", "gm", "gn", "gp",
    "gq", "gr", "gs", "gt", "gu", "gw", "gy", "hk", "hm", "hn", "hr", "ht", "hu", "id", "ie",
    "il", "im", "in", "io", "iq", "ir", "is", "it", "je", "jm", "jo", "jp", "ke", "kg", "kh",
    "ki", "km", "kn", "kp", "kr", "krd", "kw", "ky", "kz", "la", "lb", "lc", "li", "lk", "lr",
    "ls", "lt", "lu", "lv", "ly", "ma", "mc", "md", "me", "mg", "mh", "mk", "ml", "mm", "mn",
    "mo", "mp", "mq", "mr", "ms", "mt", "mu", "mv", "mw", "mx", "my", "mz", "na", "nc", "ne",
    "nf", "ng", "ni", "nl", "no", "np", "nr", "nu", "nz", "om", "pa", "pe", "pf", "pg", "ph",
    "pk", "pl", "pm", "pn", "pr", "ps", "pt", "pw", "py", "qa", "re", "ro", "rs", "ru", "rw",
    "sa", "sb", "sc", "sd", "se", "sg", "sh", "si", "sj", "sk", "sl", "sm", "sn", "so", "sr",
    "ss", "st", "su", "sv", "sx", "sy", "sz", "tc", "td", "tf", "tg", "th", "tj", "tk", "tl",
    "tm", "tn", "to", "tp", "tr", "tt", "tv", "tw", "tz", "ua", "ug", "uk", "us", "uy", "uz",
    "va", "vc", "ve", "vg", "vi", "vn", "vu", "wf", "ws", "ye", "yt", "za", "zm", "zw",
)

FIELD_COUNT = 31
HEAD_SEPARATOR = "--"
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ssZ"
ZONES = {"EST": "America/New_York", "UTC": "UTC"}

# Position of the timestamp in the parsed record, by log source.
TIMESTAMP_INDEX = {
    "Proxy": 0, "BlueCoat": 0, "Infobox": 4, "FireEye": 4, "Panlogs": 4, "Snare": 7,
}
DEFAULT_TIMESTAMP_INDEX = 4

STAGE_PARSER = "parser"
STAGE_TIME = "convertToTargetTZ"
ERROR_QUOTES = "Unbalanced quotes"
ERROR_COLUMNS = f"Columns != {FIELD_COUNT}"
ERROR_TIME = "Invalid timestamp"

PARTITION_COLUMN = "event_date"
INVALID_SUFFIX = "_invalid"

TOPIC_COUNT = 20
MAX_ITERATIONS = 1000
ALPHA = 0.5
BETA = 0.5
SCORE_THRESHOLD = 0.5

# ------------------------------------------------------------------------------------

# A lookup table is broadcast only when its measured size stays below this.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
