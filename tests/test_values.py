import pytest
from pyspark.sql import functions as F

from tidemark.functions import values


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "ms, millis, instant",
    [
        (1693598277000, "2023-09-01T19:57:57.000Z", "2023-09-01T19:57:57Z"),
        (1616775646886, "2021-03-26T16:20:46.886Z", "2021-03-26T16:20:46.886Z"),
        # 02:30 does not exist on this day in the session's zone.
        (1615689000120, "2021-03-14T02:30:00.120Z", "2021-03-14T02:30:00.120Z"),
        (-1, "1969-12-31T23:59:59.999Z", "1969-12-31T23:59:59.999Z"),
        ((1690221043 << 32) + 2, "+230044595-11-16T04:53:29.730Z", "+230044595-11-16T04:53:29.730Z"),
    ],
)
def test_times_as_text(spark, ms, millis, instant):
    assert one(spark, values.iso_millis(F.lit(ms))) == millis
    assert one(spark, values.iso_instant(F.lit(ms))) == instant


def test_document_time(spark):
    raw = values.document_time(F.lit(394), F.lit(1381162128))
    assert one(spark, values.iso_millis(raw)) == "2023-09-01T19:57:56.752Z"
    assert one(spark, values.document_time(F.lit(394), F.lit(7), "seconds")) == 394000


@pytest.mark.parametrize(
    "text, kind, expected",
    [
        ("12345678901234567890123", "integer", "12345678901234567890123"),
        ("null", "integer", None),
        ("", "number", None),
        ("1.50", "number", "1.50"),
        ("AQID", "binary", "010203"),
        ("2024-01-02T03:04:05", "timestamp", "2024-01-02T03:04:05.000000"),
        ("2024-01-02T03:04:05.1", "timestamp", "2024-01-02T03:04:05.100000"),
        ("2024-01-02T03:04:05.1234567", "timestamp", "2024-01-02T03:04:05.1234567"),
        ("2024-01-02 03:04:05", "timestamp", "2024-01-02 03:04:05"),
        ("2024-01-02T03:04:05.12 +02:00", "timestamptz", "2024-01-02T03:04:05.120000+02:00"),
        ("2024-01-02T03:04:05.1234567 Z", "timestamptz", "2024-01-02T03:04:05.123456Z"),
        ("2024-01-02T03:04:05", "timestamptz", "2024-01-02T03:04:05.000000Z"),
        ("", "timestamptz", None),
        ("later", "timestamptz", "later"),
        ("as is", "string", "as is"),
    ],
)
def test_stored_bounds(spark, text, kind, expected):
    assert one(spark, values.stored_bound(F.lit(text), kind)) == expected


@pytest.mark.parametrize("kind", ["integer", "number"])
def test_numbers_that_do_not_parse_fail(spark, kind):
    with pytest.raises(Exception, match="not a number: x1"):
        one(spark, values.stored_bound(F.lit("x1"), kind))


def test_ids_as_text_and_back(spark):
    plain, uuid = F.lit(b"\x01\x02\x03\x04"), F.unhex(F.lit("00112233445566778899AABBCCDDEEFF"))
    assert one(spark, values.id_to_text(plain, "binData", F.lit(0))) == "AQIDBA=="
    assert one(spark, values.id_to_text(uuid, "binData", F.lit(4))) == "00112233-4455-6677-8899-aabbccddeeff"
    assert one(spark, values.id_to_text(F.lit(15), "long")) == "15"
    assert one(spark, values.text_to_binary_id(F.lit("AQIDBA=="))) == b"\x01\x02\x03\x04"
    assert one(spark, values.text_to_binary_id(F.lit("00112233-4455-6677-8899-aabbccddeeff"))).hex().startswith("001122")


def test_token_and_event_positions(spark):
    assert tuple(one(spark, values.token_position(F.lit("8264BEB9F3000000012B0229296E04")))) == (1690221043, 1)
    assert tuple(one(spark, values.event_position(F.lit(1692651270999), F.lit(2)))) == (1692651270, 2)
    with pytest.raises(Exception, match="event without ord"):
        one(spark, values.event_position(F.lit(1), F.lit(None)))
