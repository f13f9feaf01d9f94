import math
from datetime import date, datetime, timezone
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loadstone.functions import decode as D

# Text and its value scaled by 10^5; what lies beyond the fifth place is cut.
NUMERIC_CASES = [
    ("7", 700000), ("42.5", 4250000), ("3.00009", 300009), (".6", 60000), (".", 0), ("8.", 800000),
    ("0.0000099", 0), ("2.718281828", 271828), (".999999", 99999), ("12345678.1234567", 1234567812345),
]
NUMERIC_CASES += [(f"-{text}", -value) for text, value in NUMERIC_CASES]


def test_numeric_cases(decoded):
    got = decoded(lambda x: D.decode_numeric(x, 18, 5), [t for t, _ in NUMERIC_CASES])
    assert [int(v.scaleb(5)) for v in got] == [n for _, n in NUMERIC_CASES]


def test_numeric_edges(decoded):
    texts = ["", "-", "+1", "1e3", "1E3", "1.2.3", "1-2", "5.", "-.", " 3700.0014 ", "٣", "0.019", "-0.019"]
    got = decoded(lambda x: D.decode_numeric(x, 9, 2), texts)
    assert got == [None] * 7 + [
        Decimal("5.00"),
        Decimal("0.00"),
        Decimal("3700.00"),
        None,
        Decimal("0.01"),
        Decimal("-0.01"),
    ]


def test_numeric_scale_zero_and_overflow(decoded):
    got = decoded(lambda x: D.decode_numeric(x, 3, 0), [".9", "-.9", "999.9", "1000", "-999"])
    assert got == [Decimal(0), Decimal(0), Decimal(999), None, Decimal(-999)]


def test_int64_cases(decoded):
    texts = [f"{sign}{7 ** n}" for n in range(0, 22, 3) for sign in ("", "-")]
    assert decoded(D.decode_int64, texts) == [int(t) for t in texts]


def test_int64_edges(decoded):
    texts = ["", " ", "+5", "5.7", "5.", "-", "--1", "1-2", "\t42 \x01", "5\x7f", "5L", "٣", "0x1"]
    got = decoded(D.decode_int64, texts)
    assert got == [None] * 8 + [42] + [None] * 4
    limits = ["9223372036854775807", "-9223372036854775808", "9223372036854775808", "9" * 20]
    assert decoded(D.decode_int64, limits) == [2**63 - 1, -(2**63), None, None]


def test_float64(decoded):
    texts = ["1.5", " -2e3 ", "1d", "1e999", "NaN", "-Infinity", "nan", "inf", "infinity", "x", "", " "]
    got = decoded(D.decode_float64, texts)
    assert got[:4] == [1.5, -2000.0, 1.0, math.inf]
    assert math.isnan(got[4]) and got[5] == -math.inf
    assert got[6:] == [None] * 6


def test_string(decoded):
    assert decoded(D.decode_string, ["", " ", " a ", "þ"]) == [None, " ", " a ", "þ"]
    assert decoded(lambda x: D.decode_string(x, 2), ["", "a", "äöü", " bc"]) == [None, "a", "äö", " b"]


def test_date(decoded):
    texts = ["2012-03-05", " 2012-03-05\t", "2012-3-5", "2021-02-31", "2012-03-05T1", "201234-1-1", ""]
    assert decoded(D.decode_date, texts) == [date(2012, 3, 5)] * 2 + [None] * 5
    assert decoded(lambda x: D.decode_date(x, "MM/dd/yyyy"), ["03/05/2012", "2012-03-05"]) == [
        date(2012, 3, 5),
        None,
    ]
    assert decoded(lambda x: D.decode_date(x, "yyyyMMdd"), ["20120305"]) == [date(2012, 3, 5)]


def epoch_hour(decoder):
    return lambda x: F.floor(F.unix_seconds(decoder(x)) / 3600)


def test_offsets(decoded):
    """An offset of n hours and 45 minutes, as seconds before or after noon in UTC."""
    noon = int(datetime(2023, 7, 9, 12, tzinfo=timezone.utc).timestamp())
    for sign, mark in ((1, "+"), (-1, "-")):
        texts = [f"2023-07-09 12:00:00{mark}{n:02d}:45" for n in range(14)]
        got = decoded(lambda x: F.unix_seconds(D.decode_ts_offset(x)), texts)
        assert got == [noon - sign * (n * 3600 + 2700) for n in range(14)]


def test_zones(decoded):
    cases = [("UTC+00:00", 12), ("UTC+01:00", 11), ("UTC-07:00", 19), ("UTC-08:00", 20)]
    texts = [f"2020-04-17 12:08:57 {zone}" for zone, _ in cases]
    hours = decoded(epoch_hour(D.decode_ts_zoned), texts)
    assert [h % 24 for h in hours] == [hour for _, hour in cases]


def test_zone_and_local_patterns_agree(decoded):
    zoned = decoded(
        lambda x: F.unix_seconds(D.decode_ts_zoned(x, "yyyy-MM-dd HH:mm:ssz")),
        ["2006-01-02 03:04:05+00:00", "2006-01-02 03:04:05Z"],
    )
    local = decoded(
        lambda x: F.unix_seconds(D.decode_ts_local(x, "Etc/GMT")), ["2006-01-02 03:04:05"]
    )
    assert zoned == local * 2


def test_local_daylight_saving(decoded):
    """A gap moves forward, an overlap takes the earlier offset; by both routes."""
    texts = ["2020-03-08 02:30:00", "2020-11-01 01:30:00", "2020-07-01 00:00:00"]
    instants = [datetime(2020, 3, 8, 8, 30), datetime(2020, 11, 1, 6, 30), datetime(2020, 7, 1, 5)]
    decoder = lambda x: D.decode_ts_local(x, "America/Chicago").cast("string")
    assert decoded(decoder, texts) == [str(i) for i in instants]
    padded = [f" {t} " for t in texts]
    assert decoded(decoder, padded) == [str(i) for i in instants]


@pytest.mark.parametrize(
    "zone,hours",
    [("UTC", 0), ("Z", 0), ("GMT+8", -8), ("+05:00", -5), ("UTC-03:00", 3), ("Etc/GMT+5", 5), ("EST", 5)],
)
def test_kinds_of_zones(decoded, zone, hours):
    texts = ["2012-03-10 18:02:35", " 2012-03-10 18:02:35"]
    got = decoded(lambda x: F.unix_seconds(D.decode_ts_local(x, zone)), texts)
    assert got == [int(datetime(2012, 3, 10, 18, 2, 35, tzinfo=timezone.utc).timestamp()) + hours * 3600] * 2


def test_local_rejects(decoded):
    texts = ["", "2012-03-10", "2012-03-10 24:00:00", "2021-02-31 00:00:00", "2012-03-10 18:02:5Z"]
    assert decoded(lambda x: D.decode_ts_local(x, "Asia/Tokyo"), texts) == [None] * 5


def test_offset_rejects(decoded):
    texts = ["2012-03-10 18:02:35", "2012-03-10 18:02:35+0100", "2012-03-10 18:02:35 +01:00", "x"]
    assert decoded(D.decode_ts_offset, texts) == [None] * 4


def test_fraction_is_kept(decoded):
    got = decoded(
        lambda x: D.decode_ts_local(x, "UTC", "yyyy-MM-dd HH:mm:ss.SSS").cast("string"),
        ["2012-03-10 18:02:35.987"],
    )
    assert got == ["2012-03-10 18:02:35.987"]


def test_session_zone_does_not_matter(spark, decoded):
    texts = ["2020-03-08 02:30:00", " 2020-03-08 02:30:00"]
    seconds = lambda x: F.unix_seconds(D.decode_ts_local(x, "UTC"))
    in_utc = decoded(seconds, texts)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert decoded(seconds, texts) == in_utc
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def numeric_model(text, precision, scale):
    """The rule of decode_numeric, character by character."""
    t = text.strip("".join(map(chr, range(33))))
    digits = t[1:] if t.startswith("-") else t
    if not digits or set(digits) - set("0123456789.") or digits.count(".") > 1:
        return None
    whole, _, fraction = digits.partition(".")
    scaled = int((whole or "0") + fraction[:scale].ljust(scale, "0"))
    if scaled >= 10**precision:
        return None
    return Decimal(-scaled if t.startswith("-") else scaled).scaleb(-scale)


NUMBER_LIKE = st.text(alphabet="0123456789.-+eE \t\x7f٣x", max_size=12)


@pytest.mark.parametrize("precision,scale", [(5, 2), (10, 0), (18, 5)])
@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts=st.lists(NUMBER_LIKE, min_size=200, max_size=300))
def test_numeric_property(decoded, precision, scale, texts):
    got = decoded(lambda x: D.decode_numeric(x, precision, scale), texts)
    assert got == [numeric_model(t, precision, scale) for t in texts]


def int_model(text):
    t = text.strip("".join(map(chr, range(33))))
    digits = t[1:] if t.startswith("-") else t
    if not digits or set(digits) - set("0123456789"):
        return None
    return int(t)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts=st.lists(NUMBER_LIKE, min_size=200, max_size=300))
def test_int_property(decoded, texts):
    assert decoded(D.decode_int64, texts) == [int_model(t) for t in texts]


DATE_LIKE = st.text(alphabet="0123456789-", min_size=8, max_size=11) | st.dates(
    date(1600, 1, 1), date(2200, 1, 1)
).map(str).flatmap(lambda s: st.sampled_from([s, s + " ", s[:-1], s + "T", s.replace("-0", "-")]))


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts=st.lists(DATE_LIKE, min_size=200, max_size=300))
def test_date_routes_agree(decoded, texts):
    """The quick route never differs from the pattern parser."""
    quick = decoded(D.decode_date, texts)
    parsed = decoded(lambda x: F.try_to_date(D.trimmed(x), "yyyy-MM-dd"), texts)
    assert quick == parsed
