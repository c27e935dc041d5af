"""Edge cases of every column function."""

import math
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from proxysift import constants as C
from proxysift import functions as P


def test_country_codes():
    codes = C.COUNTRY_CODES
    assert list(codes) == sorted(codes)
    assert len(codes) == len(set(codes)) == 254
    assert {"", "ac", "an", "eu", "krd", "su", "tp", "uk", "us", "de", "zw"} <= set(codes)
    assert not {"bl", "mf", "um", "com", "arpa"} & set(codes)


DOMAINS = {
    "blog.shop.com": ("shop", "blog"),
    "www.shop.co.uk": ("co", "www.shop"),
    "portal.com.au.": ("portal", "None"),
    "www.portal.com.au": ("portal", "www"),
    "a.b.c.com.au": ("c", "a.b"),
    "com.uk": ("None", "None"),
    "localhost": ("None", "None"),
    "10.1.2.3": ("None", "None"),
    "a.com:443": ("None", "None"),
    "A.COM": ("None", "None"),
    "1.2.3.4.in-addr.arpa": ("None", "None"),
    "...": ("None", "None"),
    "": ("None", "None"),
    ".com": ("", "None"),
    "a..com": ("", "a"),
    "..com": ("", ""),
    "site.krd": ("site", "None"),
    "com.com": ("com", "None"),
    "uk.com": ("uk", "None"),
    "com": ("None", "None"),
    None: (None, None),
}


def test_domain_and_subdomain(evaluate):
    hosts = list(DOMAINS)
    found = zip(
        evaluate(hosts, "string", P.extract_domain),
        evaluate(hosts, "string", P.extract_subdomain),
    )
    assert dict(zip(hosts, found)) == DOMAINS


def test_label_arrays(evaluate):
    hosts = ["a.b.com", "a.b.com.", "...", "", ".com", "a..b"]
    labels = [["a", "b", "com"], ["a", "b", "com"], [], [""], ["", "com"], ["a", "", "b"]]
    assert evaluate(hosts, "string", P.host_labels) == labels
    assert evaluate(hosts, "string", P.label_count) == [len(x) for x in labels]


def test_label_strips(evaluate):
    arrays = [["a", "co", "uk"], ["a", "com"], ["uk"], [""], ["a", "krd"], []]
    assert evaluate(arrays, "array<string>", P.strip_country_code) == [
        ["a", "co"], ["a", "com"], [], [], ["a"], [],
    ]
    assert evaluate(arrays, "array<string>", P.strip_top_level_domain) == [
        ["a", "co", "uk"], ["a"], ["uk"], [""], ["a", "krd"], [],
    ]


def test_entropy(evaluate):
    texts = ["", "aaaa", "ab", "abcd", None, "ab\nab", "ü€ü€"]
    values = evaluate(texts, "string", P.string_entropy)
    assert values[:5] == [0.0, 0.0, 1.0, 2.0, None]
    assert values[5] == pytest.approx(1.521928, abs=1e-6)
    assert values[6] == 1.0


def _entropy(text):
    return -sum(n / len(text) * math.log2(n / len(text)) for n in Counter(text).values())


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"], max_codepoint=0xFFFF), min_size=1), min_size=1, max_size=20))
def test_entropy_against_brute_force(evaluate, texts):
    values = evaluate(texts, "string", P.string_entropy)
    assert values == pytest.approx([_entropy(text) for text in texts], abs=1e-9)


def test_entropy_bin(evaluate):
    values = [0.0, 0.3, 0.31, 5.4, 5.5, math.nan, -1.0, math.inf, None]
    assert evaluate(values, "double", P.entropy_bin) == [0, 1, 2, 18, 19, -1, 0, 19, None]
    assert evaluate([3.0], "double", lambda x: P.entropy_bin(x, (1.0, 2.0))) == [-1]


def test_log_bins(evaluate):
    assert evaluate([0.0, 1.0, 7.0, 8.0, 0.25, -3.0, None], "double", P.log_bin) == [0, 0, 2, 3, -2, 0, None]
    assert evaluate([1000.0, 999.0], "double", lambda x: P.log_bin(x, 10))[1] == 2
    powers = [2**n for n in range(62)]
    assert evaluate(powers, "bigint", P.log_bin) == list(range(62))
    assert evaluate([1.0, 5.0, 0.0, 8.0], "double", P.ceil_log2) == [0, 3, -2147483648, 3]


def test_hour(evaluate):
    times = ["07:10", "7", "+5:0", "-3:1", "x:1", " 5:1", "", "5.5:1", "99:00", None, "1e1:0", "+:1"]
    assert evaluate(times, "string", P.hour_of) == [7, 7, 5, -3, None, None, None, None, 99, None, None, None]
    assert evaluate(["07-10"], "string", lambda x: P.hour_of(x, "-")) == [7]


def test_content_group_and_code(evaluate):
    types = ["image/png", "-", "/", "//", "", "/png", "a/b/c"]
    unknown = "unknown_content_type"
    assert evaluate(types, "string", P.content_group) == ["image", "-", unknown, unknown, "", "", "a"]
    assert evaluate(["200", None], "string", P.response_code) == ["200", "unknown_response_code"]


def test_popularity(evaluate):
    def popularity(x):
        return P.popularity_class(x, x.isin("shop", "intel"))

    assert evaluate(["intel", "shop", "x", None], "string", popularity) == [2, 1, 0, 0]
    no_owner = evaluate(["intel"], "string", lambda x: P.popularity_class(x, F.lit(True), ""))
    assert no_owner == [1]


SPLITS = {
    'a "b  c" "d" e': ["a", '"b c"', '"d"', "e"],
    'a "b c': None,
    'a " b': ["a", '"', "b"],
    ' x" y "z q': ['x" y "z', "q"],
    '"a b" "c d"': ['"a b"', '"c d"'],
    '"" x': ['""', "x"],
    '"a "b': ['"a "b'],
    "a\tb c": ["a\tb", "c"],
}


def test_quoted_split(evaluate):
    assert evaluate(list(SPLITS), "string", P.split_quoted) == list(SPLITS.values())
    by_bar = evaluate(['a|"b|c"||d'], "string", lambda x: P.split_quoted(x, "|"))
    assert by_bar == [["a", '"b c"', "d"]]


def _split_by_hand(line):
    fields, is_open = [], False
    for token in (token for token in line.split(" ") if token):
        if is_open:
            fields[-1] += " " + token
        else:
            fields.append(token)
        is_open ^= token.startswith('"') != token.endswith('"')
    return None if is_open else fields


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text('"ab -', min_size=1), min_size=1, max_size=40))
def test_quoted_split_against_fold(evaluate, lines):
    assert evaluate(lines, "string", P.split_quoted) == [_split_by_hand(line) for line in lines]


def test_long_line(evaluate):
    line = "x " + '"' + "a  " * 20000 + 'b" y'
    fields = evaluate([line], "string", P.split_quoted)[0]
    assert [len(f) for f in fields] == [1, 40003, 1]


def test_head_split(evaluate):
    heads = [["a--b", "c"], ["--", "c"], ["a----", "c"], ["a---", "c"], ["--a"], ["a", "b--c"], ["a--b--"]]
    assert evaluate(heads, "array<string>", P.head_split) == [
        ["a", "b", "c"], ["c"], ["a", "c"], ["a", "-", "c"], ["", "a"], ["a", "b--c"], ["a", "b"],
    ]


def test_text_helpers(evaluate):
    assert evaluate(["", " \t", "\x01 ", "a", " a "], "string", P.has_text) == [False, False, False, True, True]
    assert evaluate(['a""b""', None], "string", lambda x: P.replace_all(x, '""', "''")) == ["a''b''", None]
    raw = ["-", "", "x", "12", "12.5", "99999999999"]
    assert evaluate(raw, "string", P.convert_field) == [None, None, "x", "12", "12.5", "99999999999"]
    assert evaluate(raw, "string", lambda x: P.convert_field(x, "int")) == [None, None, None, 12, None, None]
    assert evaluate(raw, "string", lambda x: P.convert_field(x, "bigint"))[-1] == 99999999999


TIMES = {
    "2018-07-01T12:00:00+0000": ("2018-07-01T08:00:00.000-04:00", 1530446400),
    "2018-07-01T12:00:00Z": ("2018-07-01T08:00:00.000-04:00", 1530446400),
    "2018-01-01T12:00:00-05:00": ("2018-01-01T12:00:00.000-05:00", 1514826000),
    "2018-01-01T12:00:00+0530": ("2018-01-01T01:30:00.000-05:00", 1514788200),
    # one hour apart on both sides of the end of summer time
    "2018-11-04T05:30:00+0000": ("2018-11-04T01:30:00.000-04:00", 1541309400),
    "2018-11-04T06:30:00+0000": ("2018-11-04T01:30:00.000-05:00", 1541313000),
    "1969-12-31T23:59:59+0000": ("1969-12-31T18:59:59.000-05:00", -1),
    "2018-02-30T12:00:00+0000": (None, None),
    "2018-07-01 12:00:00+0000": (None, None),
    "2018-07-01T12:00:00": (None, None),
    "not-a-time": (None, None),
}


def test_time_conversion(evaluate):
    texts = list(TIMES)
    est = evaluate(texts, "string", lambda x: P.iso_text(P.parse_time(x)))
    epoch = evaluate(texts, "string", lambda x: P.epoch_seconds(P.parse_time(x)))
    assert dict(zip(texts, zip(est, epoch))) == TIMES
    utc = evaluate(texts[:3], "string", lambda x: P.iso_text(P.parse_time(x), "UTC"))
    assert utc == ["2018-07-01T12:00:00.000+00:00"] * 2 + ["2018-01-01T17:00:00.000+00:00"]


def test_other_time_layout(evaluate):
    texts = ["01/07/2018 12:00:00 +0000", "01/07/2018 12:00:00 -05:00", "x"]
    moments = evaluate(
        texts, "string", lambda x: P.epoch_seconds(P.parse_time(x, "dd/MM/yyyy HH:mm:ss Z"))
    )
    assert moments == [1530446400, 1530464400, None]


def test_unsupported_zone(spark):
    with pytest.raises(ValueError, match="CET"):
        P.iso_text(F.col("x"), "CET")


def test_event_date(evaluate):
    texts = ["2018-07-01T12:00:00+0000", "2018-07-01", "2018-13-01T", "x", None]
    assert evaluate(texts, "string", P.event_date) == ["20180701", "20180701", None, None, None]


def test_vectors(spark, evaluate):
    assert evaluate([[0.5, 0.25]], "array<float>", P.widen) == [[0.5, 0.25]]
    df = spark.createDataFrame([([1, 4], [2.0, 3.5])], "i array<int>, v array<double>")
    vector = df.select(P.sparse_vector(6, F.col("i"), F.col("v")).alias("f")).first().f
    assert vector.toArray().tolist() == [0, 2.0, 0, 0, 3.5, 0]
    pair = spark.createDataFrame([([0.5, 0.5], [0.2, 0.4])], "a array<double>, b array<double>")
    assert pair.select(P.dot(F.col("a"), F.col("b"), 2).alias("d")).first().d == pytest.approx(0.3)
