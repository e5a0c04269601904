"""Single-value casts, one case per value."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquery.functions import addresses, dates, shapes
from docquery.functions.registry import BUILT_IN, CastRegistry, FieldCast

STRICT = "strict_date_optional_time"
DAY = dt.datetime(2026, 8, 11)


def value(spark, column, ddl="v string", data=None):
    return spark.createDataFrame([(data,)], ddl).select(column(F.col("v"))).first()[0]


def loaded_date(spark, text, format=None, mode="default"):
    return value(spark, lambda c: F.date_format(dates.load_date(c, format, mode=mode), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), data=text)


@pytest.mark.parametrize(
    "text, format, expected",
    [
        ("2026-08-11T00:00:00.000Z", STRICT, "2026-08-11T00:00:00.000000"),
        ("2026-08-11T01:02:03.456Z", None, "2026-08-11T01:02:03.456000"),
        ("2026-08-11", None, "2026-08-11T00:00:00.000000"),
        ("2026-08-11", "yyyy-MM-dd", "2026-08-11T00:00:00.000000"),
        ("2026-08-11T01:02:03Z", "strict_date_time_no_millis", "2026-08-11T01:02:03.000000"),
        ("2026-08-11T01:02:03.456789Z", "strict_date_optional_time_nanos", "2026-08-11T01:02:03.456789"),
        ("2026-08-11T01:02:03.456789Z", "epoch_millis||yyyy-MM-dd'T'HH:mm:ss.SSSSSSZ", "2026-08-11T01:02:03.456789"),
        ("2026-08-11T01:02:03.456789Z", STRICT, None),
        ("2026-08-11T01:02:03.456+02:00", STRICT, None),
        ("2026-8-11", None, None),
        ("2026-02-30", None, None),
        ("2026-08-11T25:00:00.000Z", None, None),
        ("not a date", None, None),
        ("0", None, None),
        ("2026-08-11", "date_optional_time", None),
        ("2026-08-11", f"date_optional_time||{STRICT}", "2026-08-11T00:00:00.000000"),
        (None, None, None),
    ],
)
def test_load_date(spark, text, format, expected):
    assert loaded_date(spark, text, format) == expected


def test_whole_seconds_load_by_default_but_not_in_exact_mode(spark):
    assert loaded_date(spark, "2026-08-11T00:00:00Z") == "2026-08-11T00:00:00.000000"
    assert loaded_date(spark, "2026-08-11T00:00:00Z", mode="exact") is None


@pytest.mark.parametrize(
    "number, format, expected",
    [(0, None, 0), (1500, "epoch_millis", 1_500_000), (-1, "epoch_second", -1_000_000), (7, STRICT, None), (2**62, None, None)],
)
def test_load_epoch(spark, number, format, expected):
    out = value(spark, lambda c: F.unix_micros(dates.load_date(c, format, T.LongType())), "v bigint", number)
    assert out == expected


@pytest.mark.parametrize(
    "moment, format, expected",
    [
        (DAY, STRICT, "2026-08-11T00:00:00Z"),
        (DAY, None, "2026-08-11T00:00:00Z"),
        (DAY.replace(microsecond=437000), None, "2026-08-11T00:00:00.437Z"),
        (DAY, "strict_date_time", "2026-08-11T00:00:00.000Z"),
        (DAY.replace(microsecond=999999), "strict_date_time_no_millis", "2026-08-11T00:00:00Z"),
        (DAY.replace(microsecond=123), "strict_date_optional_time_nanos", "2026-08-11T00:00:00.000123Z"),
        (DAY, "epoch_millis||" + STRICT, 1786406400000),
        (DAY, "epoch_second", 1786406400),
        (None, None, None),
    ],
)
def test_dump_date(spark, moment, format, expected):
    moment = moment and moment.replace(tzinfo=dt.timezone.utc)
    assert value(spark, lambda c: dates.dump_date(c, format), "v timestamp", moment) == expected


def test_dump_day(spark):
    out = value(spark, lambda c: dates.dump_date(c, None, T.DateType()), "v date", dt.date(2026, 8, 11))
    assert out == "2026-08-11"


@pytest.mark.parametrize(
    "text, version, digits, dumped",
    [
        ("127.0.0.1", 4, "7F000001", "127.0.0.1"),
        ("255.255.255.255", 4, "FFFFFFFF", "255.255.255.255"),
        ("::", 6, "0" * 32, "::"),
        ("::1", 6, "0" * 31 + "1", "::1"),
        ("1::", 6, "0001" + "0" * 28, "1::"),
        ("2001:DB8::8a2e:370:7334", 6, "20010DB80000000000008A2E03707334", "2001:db8::8a2e:370:7334"),
        ("2001:db8:0:1:1:1:1:1", 6, "20010DB8000000010001000100010001", "2001:db8:0:1:1:1:1:1"),
        ("2001:0:0:1:0:0:0:1", 6, "20010000000000010000000000000001", "2001:0:0:1::1"),
        ("2001:db8:0:0:1:0:0:1", 6, "20010DB8000000000001000000000001", "2001:db8::1:0:0:1"),
        ("1:2:3:4:5:6:7:8", 6, "00010002000300040005000600070008", "1:2:3:4:5:6:7:8"),
        ("::ffff:1.2.3.4", 6, "0" * 20 + "FFFF01020304", "::ffff:1.2.3.4"),
        ("1:2:3:4:5:6:7::", 6, "0001000200030004000500060007" + "0000", "1:2:3:4:5:6:7:0"),
    ],
)
def test_ip(spark, text, version, digits, dumped):
    address = value(spark, addresses.load_ip, data=text)
    assert (address.version, bytes(address.bytes).hex().upper()) == (version, digits)
    assert value(spark, lambda c: addresses.dump_ip(addresses.load_ip(c)), data=text) == dumped


@pytest.mark.parametrize(
    "text",
    ["", "256.1.1.1", "1.2.3", "1.2.3.4.5", "1.2.3.4 ", ":::", "1::2::3", "1:2:3:4:5:6:7", "1:2:3:4:5:6:7:8:9", "g::1",
     "12345::", "1:2:3:4::5:6:7:8", ":1", "1:", "::1.2.3.256", "host", None],
)
def test_no_ip(spark, text):
    assert value(spark, addresses.load_ip, data=text) is None


@pytest.mark.parametrize(
    "text, expected", [("cmF3", b"raw"), ("", b""), ("cmF3IQ==", b"raw!"), ("cmF3I", None), ("cm F3", None), ("c*F3", None), (None, None)]
)
def test_binary(spark, text, expected):
    out = value(spark, shapes.load_binary, data=text)
    assert (None if out is None else bytes(out)) == expected


def test_binary_is_dumped_in_one_line(spark):
    raw = bytes(range(256)) * 3
    assert "\n" not in value(spark, shapes.dump_binary, "v binary", bytearray(raw))


def variant(spark, json, column):
    return spark.createDataFrame([(json,)], "j string").select(F.parse_json("j").alias("v")).select(column(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "json, expected",
    [
        ('{"lat": 1.2, "lon": 3.4}', (1.2, 3.4)),
        ('{"lat": 1, "lon": 3}', (1.0, 3.0)),
        ('"1.2,3.4"', None),
        ("[3.4, 1.2]", None),
        ('{"lat": 1.2}', None),
        ('{"lat": 1.2, "lon": 3.4, "alt": 5}', None),
        ("null", None),
    ],
)
def test_geo(spark, json, expected):
    out = variant(spark, json, lambda c: shapes.load_geo(c, T.VariantType()))
    assert (None if out is None else tuple(out)) == expected


@pytest.mark.parametrize(
    "json, expected",
    [
        ('{"gte": 1, "lte": 10}', (1, 10)),
        ('{"gte": 1.5, "lte": 2.5}', None),
        ('{"gte": "1", "lte": "2"}', None),
        ('{"gte": 1}', None),
        ('{"gt": 1, "lte": 2}', None),
        ('{"gte": 1, "lte": 2, "boost": 3}', None),
        ("7", None),
    ],
)
def test_int_range(spark, json, expected):
    out = variant(spark, json, lambda c: shapes.load_int_range(c, T.VariantType()))
    assert (None if out is None else tuple(out)) == expected


@pytest.mark.parametrize(
    "json, format, expected",
    [
        ('{"gte": "2026-08-01", "lte": "2026-08-11"}', "strict_date", (dt.date(2026, 8, 1), dt.date(2026, 8, 11))),
        ('{"gte": 0, "lte": 86400000}', None, (dt.date(1970, 1, 1), dt.date(1970, 1, 2))),
        ('{"gte": "soon", "lte": "2026-08-11"}', None, None),
        ('{"lte": "2026-08-11"}', None, None),
        ('{"gte": 0, "lte": 0, "zone": "Z"}', None, None),
    ],
)
def test_date_range(spark, json, format, expected):
    out = variant(spark, json, lambda c: shapes.load_date_range(c, T.VariantType(), format))
    assert (None if out is None else tuple(out)) == expected


def test_registry_prefers_inherited_casts():
    mine = FieldCast({"type": "date"}, lambda c, t, f: c, lambda c, t, f: c)
    scaled = FieldCast({"type": "scaled_float"}, lambda c, t, f: c, lambda c, t, f: c)
    inheriting = CastRegistry([mine, scaled], inherit=BUILT_IN)
    assert inheriting.find({"type": "date"}) is BUILT_IN.find({"type": "date"})
    assert inheriting.find({"type": "scaled_float", "scaling_factor": 100}) is scaled
    assert CastRegistry([mine]).find({"type": "date"}) is mine
    assert BUILT_IN.find({"type": "text"}) is None and BUILT_IN.find(None) is None
