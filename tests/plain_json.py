"""Extended JSON read value by value: the brute force that the rewriting of texts is tested against."""

import base64
import datetime as dt
import json
from typing import Any

from tidemark.functions.extjson import DROPPED, WRAPPERS
from tidemark.functions.values import CYCLE_MS


class _Dropped:
    """Marks a value that has no output form: left out of objects, null in arrays."""


def plain_text(text: str, time_unit: str = "raw") -> str:
    # The hook sees inner objects before outer ones. Text after the value is ignored, as when Spark parses it.
    decoder = json.JSONDecoder(object_hook=lambda fields: _readable(fields, time_unit))
    value, _ = decoder.raw_decode(text.lstrip())
    return json.dumps(value, ensure_ascii=False, separators=(",", ":"), default=lambda _: None)


def _readable(fields: dict[str, Any], unit: str) -> Any:
    """The plain value; null for a wrapper whose content can't be read, so that one bad value doesn't fail the job."""
    try:
        return _plain(fields, unit)
    except (ArithmeticError, AttributeError, KeyError, TypeError, ValueError):
        return None


def _plain(fields: dict[str, Any], unit: str) -> Any:
    tag = next((key[1:] for key in fields if key[:1] == "$"), None)
    if tag is None or not (tag in WRAPPERS or tag in ("scope", "options")):
        if _Dropped in fields.values():
            return {name: value for name, value in fields.items() if value is not _Dropped}
        return fields
    inner = fields.get("$" + tag)
    match tag:
        case "numberInt" | "numberLong":
            return int(inner)
        case "numberDouble" | "numberDecimal":
            number = float(inner)
            return number if number - number == 0 else str(inner)
        case "date":
            return _iso(_date_ms(inner))
        case "timestamp":
            return _iso(inner["t"] * 1000 if unit == "seconds" else (inner["t"] << 32) + inner["i"])
        case "binary":
            return inner["base64"] if isinstance(inner, dict) else inner
        case "uuid":
            return base64.b64encode(bytes.fromhex(inner.replace("-", ""))).decode()
        case "regularExpression":
            return _pattern(inner["pattern"], inner.get("options", ""))
        case "regex" | "options":
            return _pattern(fields["$regex"], fields.get("$options", ""))
        case "code" | "scope":
            if "$scope" not in fields:
                return inner
            return {"code": fields["$code"], "scope": fields["$scope"]}
        case _:
            return _Dropped if WRAPPERS[tag] in DROPPED else inner


def _pattern(pattern: str, options: str) -> str:
    return f"({options}){pattern}" if options.strip() else pattern


def _date_ms(value: int | str) -> int:
    if isinstance(value, int):
        return value
    moment = dt.datetime.fromisoformat(value)
    moment = moment if moment.tzinfo else moment.replace(tzinfo=dt.timezone.utc)
    return (moment - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(milliseconds=1)


def _iso(ms: int) -> str:
    # Years repeat in cycles of 400, so that times past the year 9999 can be shown too.
    cycles, rest = divmod(ms, CYCLE_MS)
    moment = dt.datetime(1970, 1, 1) + dt.timedelta(milliseconds=rest)
    year = moment.year + 400 * cycles
    return (f"+{year}" if year > 9999 else f"{year:04d}") + moment.isoformat(timespec="milliseconds")[4:] + "Z"
