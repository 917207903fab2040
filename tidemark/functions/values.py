"""Text forms of times, ids, tokens and stored bounds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The calendar repeats every 400 years of this many milliseconds.
CYCLE_MS = 146_097 * 86_400_000


def _div(number: Column, by: int) -> Column:
    """Whole-number division that rounds down."""
    divisor = F.lit(by).cast("bigint")
    return F.call_function("div", number - F.pmod(number, divisor), divisor)


def utc_text(ms: Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ss.SSSZ`` of milliseconds within the first 400 years from 1970."""
    # A time without zone keeps the session's zone out, and one microsecond more makes it show its fraction.
    micros = F.pmod(ms, F.lit(CYCLE_MS)) * 1000 + 1
    moment = F.timestamp_add("MICROSECOND", micros, F.lit("1970-01-01").cast("timestamp_ntz"))
    return F.concat(F.translate(F.substring(moment.cast("string"), 1, 23), " ", "T"), F.lit("Z"))


def iso_millis(ms: Column) -> Column:
    """Epoch milliseconds as UTC text, always with three fraction digits; years past 9999 carry a plus."""
    ms = ms.cast("bigint")
    near = utc_text(ms)
    year = F.format_string("%04d", F.substring(near, 1, 4).cast("bigint") + _div(ms, CYCLE_MS) * 400)
    far = F.concat(F.regexp_replace(year, r"^(\d{5,})$", "+$1"), F.substring(near, 5, 20))
    return F.when(ms.between(0, CYCLE_MS - 1), near).otherwise(far)


def iso_instant(ms: Column) -> Column:
    """Epoch milliseconds as UTC text, the fraction only when it is not zero."""
    return F.regexp_replace(iso_millis(ms), r"\.000Z$", "Z")


def document_time(seconds: Column, increment: Column, unit: str = "raw") -> Column:
    """Epoch milliseconds of an internal (seconds, increment) time.

    ``raw`` reads the whole 64-bit value as milliseconds, as the source connector does;
    ``seconds`` uses the seconds only.
    """
    if unit == "seconds":
        return seconds.cast("bigint") * 1000
    return F.shiftleft(seconds.cast("bigint"), 32) + increment.cast("bigint")


def stored_bound(text: Column, logical_type: str) -> Column:
    """A stored bound as canonical text for its column type.

    Times that do not parse stay as they are; numbers that do not parse are an error.
    """
    blank = text.isNull() | (text == "") | (text == "null")
    wrong = F.raise_error(F.concat(F.lit("not a number: "), text)).cast("string")
    if logical_type == "integer":
        return F.when(~blank, F.coalesce(text.try_cast("decimal(38,0)").cast("string"), wrong))
    if logical_type == "number":
        # Through double only to check the form: the digits are kept.
        return F.when(~blank, F.when(text.try_cast("double").isNotNull(), text).otherwise(wrong))
    if logical_type == "binary":
        return F.hex(F.unbase64(text))
    if logical_type == "timestamp":
        form = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,6})?$"
        parsed = F.when(text.rlike(form), text.try_cast("timestamp_ntz"))
        return F.coalesce(_micros(parsed), text)
    if logical_type == "time":
        form = r"^\d{2}:\d{2}:\d{2}(\.\d{1,6})?$"
        parsed = F.when(text.rlike(form), F.concat(F.lit("1970-01-01T"), text).try_cast("timestamp_ntz"))
        return F.when(text == "", F.lit(None)).otherwise(F.coalesce(F.substring(_micros(parsed), 12, 15), text))
    if logical_type == "timestamptz":
        joined = F.regexp_replace(F.trim(text), r"\s+(?=[+\-]|Z)", "")
        form = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{0,9})?([+\-]\d{2}:\d{2}|Z)?$"
        offset = F.regexp_extract(joined, r"([+\-]\d{2}:\d{2}|Z)$", 1)
        zone = F.when(offset == "", F.lit("Z")).otherwise(offset)
        local = F.when(joined.rlike(form), F.regexp_replace(joined, r"([+\-]\d{2}:\d{2}|Z)$", ""))
        parsed = local.try_cast("timestamp_ntz")
        return F.when(text == "", F.lit(None)).otherwise(F.coalesce(F.concat(_micros(parsed), zone), text))
    return text


def _micros(timestamp: Column) -> Column:
    return F.date_format(timestamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def id_to_text(value: Column, id_type: str, subtype: Column | None = None) -> Column:
    """Stored text of a document id: hex, number or string as they are; bytes as UUID or base64."""
    if id_type != "binData":
        return value.cast("string")
    encoded = F.base64(value)
    if subtype is None:
        return encoded
    return F.when(subtype == 4, uuid_text(F.lower(F.hex(value)))).otherwise(encoded)


def uuid_text(hex32: Column) -> Column:
    return F.regexp_replace(hex32, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def text_to_binary_id(text: Column) -> Column:
    """Bytes of a stored binary id, given as UUID or as base64."""
    is_uuid = text.rlike("(?i)^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")
    # Each branch sees only text of its own form, so neither fails on the other one.
    from_uuid = F.unhex(F.replace(F.when(is_uuid, text), F.lit("-"), F.lit("")))
    return F.coalesce(from_uuid, F.unbase64(F.when(~is_uuid, text)))


def token_position(token: Column) -> Column:
    """(seconds, order) read from the two 32-bit words after a resume token's type byte."""
    return F.struct(
        F.conv(F.substring(token, 3, 8), 16, 10).cast("bigint").alias("seconds"),
        F.conv(F.substring(token, 11, 8), 16, 10).cast("int").alias("ord"),
    )


def event_position(ts_ms: Column, order: Column) -> Column:
    """(seconds, order) of a change event; a missing part is an error."""
    return F.struct(
        F.coalesce(_div(ts_ms, 1000), F.raise_error(F.lit("event without ts_ms")).cast("bigint")).alias(
            "seconds"
        ),
        F.coalesce(order.cast("int"), F.raise_error(F.lit("event without ord")).cast("int")).alias("ord"),
    )
