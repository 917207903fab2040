"""Extended JSON held in variants: type names, plain values and text forms.

A document field is either a plain JSON value or a one-entry wrapper such as ``{"$oid": "…"}``. Top-level
fields are read with variant functions. Objects and arrays that hold wrappers inside are rewritten as text.
"""

from __future__ import annotations

import functools
import operator
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.values import document_time, iso_millis

# Wrapper key -> type name of the value, as the source database names it.
WRAPPERS = {
    "oid": "objectId",
    "date": "date",
    "timestamp": "timestamp",
    "binary": "binData",
    "uuid": "binData",
    "regularExpression": "regex",
    "regex": "regex",
    "symbol": "symbol",
    "code": "javascript",
    "numberInt": "int",
    "numberLong": "long",
    "numberDouble": "double",
    "numberDecimal": "decimal",
    "minKey": "minKey",
    "maxKey": "maxKey",
    "undefined": "undefined",
    "dbPointer": "dbPointer",
}

# First word of a plain value's shape -> type name; whole numbers that fit are int.
PLAIN = {
    "VOID": "null",
    "BOOLEAN": "boolean",
    "STRING": "string",
    "BIGINT": "long",
    "DECIMAL": "double",
    "DOUBLE": "double",
    "FLOAT": "double",
    "ARRAY": "array",
    "OBJECT": "object",
}

# Type name -> discovered JSON type; every other name is a string.
JSON_TYPES = {
    "boolean": "boolean",
    "int": "number",
    "long": "number",
    "double": "number",
    "decimal": "number",
    "array": "array",
    "object": "object",
    "javascriptWithScope": "object",
    "null": "null",
}

# Values of these types are left out of the output.
DROPPED = ("minKey", "maxKey", "undefined", "dbPointer")

DROPPED_KEYS = tuple(key for key, name in WRAPPERS.items() if name in DROPPED)

# Wrappers whose values are read as text without the rewrite.
NATIVE_KEYS = ("oid", "date", "timestamp", "number", *DROPPED_KEYS)

# The start of a shape that tells the type.
START = r"^(OBJECT<`[$]code`: STRING, `[$]scope`|OBJECT<`[$][A-Za-z]+`|[A-Z]+)"
KINDS = {
    **PLAIN,
    **{f"OBJECT<`${key}`": name for key, name in WRAPPERS.items()},
    "OBJECT<`$code`: STRING, `$scope`": "javascriptWithScope",
}


def _map(entries: dict[str, str]) -> Column:
    return F.expr("map(" + ", ".join(f"'{key}', '{value}'" for key, value in entries.items()) + ")")


def get(value: Column, path: str, data_type: str = "string") -> Column:
    return F.try_variant_get(value, path, data_type)


def _start(value: Column) -> Column:
    return F.regexp_extract(F.schema_of_variant(value), START, 1)


def kind_of(value: Column) -> Column:
    """Type name of a value, plain whole numbers as long; null when the field is missing."""
    return F.when(value.isNotNull(), F.coalesce(_map(KINDS)[_start(value)], F.lit("object")))


def type_name(value: Column) -> Column:
    """Type name of a field value as the source database calls it; null when the field is missing."""
    kind = kind_of(value)
    return F.when((kind == "long") & get(value, "$", "int").isNotNull(), F.lit("int")).otherwise(kind)


def json_type(value: Column) -> Column:
    """Discovered JSON type of a field value; null when the field is missing."""
    types = {start: JSON_TYPES.get(kind, "string") for start, kind in KINDS.items()}
    return F.when(value.isNotNull(), F.coalesce(_map(types)[_start(value)], F.lit("object")))


def json_type_of_shape(shape: Column) -> Column:
    """Discovered JSON type of a value from the text of its shape."""
    types = {start: JSON_TYPES.get(kind, "string") for start, kind in KINDS.items()}
    return F.coalesce(_map(types)[F.regexp_extract(shape, START, 1)], F.lit("object"))


def shape_members(shape: str) -> list[tuple[str, str]]:
    """Name and shape of each member of an object, from the text of its shape; names may be in backquotes."""
    if not shape.startswith("OBJECT<"):
        return []
    parts, depth, quoted, low = [], 0, False, len("OBJECT<")
    for at in range(low, len(shape)):
        letter = shape[at]
        quoted ^= letter == "`"
        if quoted:
            continue
        depth += (letter == "<") - (letter == ">")
        if (letter == "," and not depth) or depth < 0:
            parts.append(shape[low:at].strip())
            low = at + 1
    members = []
    for part in filter(None, parts):
        if part[0] == "`":
            # A backquote in a name is doubled.
            end = re.match(r"`((?:[^`]|``)*)`(?!`)", part)
            name, rest = end[1].replace("``", "`"), part[end.end() :]
        else:
            name, _, rest = part.partition(":")
            rest = ":" + rest
        members.append((name, rest[1:].strip()))
    return members


def json_type_of_name(name: Column) -> Column:
    return F.when(name.isNotNull(), F.coalesce(_map(JSON_TYPES)[name], F.lit("string")))


def epoch_ms(value: Column) -> Column:
    """Milliseconds of a ``$date``: a number, a wrapped number or ISO text."""
    iso = get(value, "$.$date").try_cast("timestamp")
    return F.coalesce(
        get(value, "$.$date", "bigint"),
        get(value, "$.$date.$numberLong").try_cast("bigint"),
        F.unix_millis(iso),
    )


def shape_is(shape: Column, *keys: str) -> Column:
    """Whether the shape of a value is that of a wrapper whose key starts with one of ``keys``."""
    return functools.reduce(operator.or_, (shape.startswith(f"OBJECT<`${key}") for key in keys))


def foreign(shape: Column) -> Column:
    """Whether a value has no reading as text of its own: objects, arrays and the rarer wrappers."""
    nested = shape.startswith("OBJECT<") | shape.startswith("ARRAY<")
    return nested & ~shape_is(shape, *NATIVE_KEYS)


def time_ms(value: Column, shape: Column, time_unit: str = "raw") -> Column:
    """Epoch milliseconds of dates and internal times, null for all other values."""
    ticks = document_time(get(value, "$.$timestamp.t", "bigint"), get(value, "$.$timestamp.i", "bigint"), time_unit)
    return F.when(shape_is(shape, "date"), epoch_ms(value)).when(shape_is(shape, "timestamp"), ticks)


def number_text(value: Column) -> Column:
    return F.coalesce(
        get(value, "$.$numberLong"),
        get(value, "$.$numberInt"),
        get(value, "$.$numberDouble"),
        get(value, "$.$numberDecimal"),
    )


def as_text(value: Column, shape: Column, ms: Column, plain: Column) -> Column:
    """String form of a top-level value from its shape, its milliseconds and its wrapper-free form."""
    return (
        F.when(shape == "STRING", get(value, "$"))
        .when(shape_is(shape, "oid"), get(value, "$.$oid"))
        .when(ms.isNotNull(), iso_millis(ms))
        .when(shape_is(shape, "number"), number_text(value))
        .when(~shape_is(shape, *DROPPED_KEYS), get(plain, "$"))
    )


def as_number(value: Column, data_type: str = "double") -> Column:
    """Numeric value of a plain or wrapped number; text that holds a number counts, other values are null.

    Whole types cut fractions off, of wrapped numbers as of plain ones.
    """
    text = number_text(value)
    return F.coalesce(get(value, "$", data_type), text.try_cast(data_type), text.try_cast("double").try_cast(data_type))


def as_boolean(value: Column) -> Column:
    return get(value, "$", "boolean")


def as_array(value: Column, text: Column) -> Column:
    """Arrays as they are; any other value, also null, becomes the only element of an array.

    ``text`` is the value's JSON before the rewrite, which keeps arrays arrays.
    """
    wrapped = F.parse_json(F.concat(F.lit("["), F.to_json(value), F.lit("]")))
    return F.when(value.isNull() | text.startswith("["), value).otherwise(wrapped)


def has_form(text: Column) -> Column:
    """Whether a value, given as JSON text before the rewrite, has an output form."""
    return ~functools.reduce(operator.or_, (text.startswith(f'{{"${key}"') for key in DROPPED_KEYS))


# Marks that JSON texts hold nowhere: around wrappers, for a value that is left out, for a backslash or a quote in a string.
_EDGE, _GONE, _SLASH, _QUOTE = "\x01", "\x02", "\x03", "\x04"

# With these marks, a string is what stands between two quotes. Nothing here makes the matcher recurse over long texts.
_STRING = '"[^"]*+"'
_FLAT = rf'[^"{{}}]*+(?:{_STRING}[^"{{}}]*+)*+'

# Wrappers whose plain value stands in them as it is. Decimal numbers only where the text is the shortest one of its value.
_LEAVES = (
    rf'\{{\s*+"\$(?:oid|symbol)"\s*+:\s*+({_STRING})\s*+\}}',
    r'\{\s*+"\$number(?:Int|Long)"\s*+:\s*+"(-?(?:0|[1-9][0-9]*))"\s*+\}',
    r'\{\s*+"\$number(?:Double|Decimal)"\s*+:\s*+"(-?(?:0|[1-9][0-9]{0,9})\.[0-9]{0,2}[1-9])"\s*+\}',
)

# A wrapper with at most one object inside, as all have once the leaves are replaced.
_KEY = "|".join([*WRAPPERS, "scope", "options"])
_WRAPPER = rf'\{{\s*+"\$(?:{_KEY})"\s*+:{_FLAT}(?:\{{{_FLAT}\}}{_FLAT})?+\}}'
_SCOPED = rf'\{{\s*+"\$code"\s*+:\s*+({_STRING})\s*+,\s*+"\$scope"\s*+:'


def has_wrappers(texts: Column) -> Column:
    """Whether a JSON text may hold wrappers."""
    return F.coalesce(texts.contains('"$'), F.lit(False))


def _hidden(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\\\"), F.lit(_SLASH)), F.lit('\\"'), F.lit(_QUOTE))


def _shown(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit(_QUOTE), F.lit('\\"')), F.lit(_SLASH), F.lit("\\\\"))


def native_texts(texts: Column) -> Column:
    """JSON texts with the wrappers of ids, symbols and most numbers replaced by their plain values."""
    return _shown(functools.reduce(lambda text, leaf: F.regexp_replace(text, leaf, "$1"), _LEAVES, _hidden(texts)))


def plain_texts(texts: Column, time_unit: str = "raw") -> Column:
    """JSON texts with every wrapper inside replaced by its plain value; null stays null.

    The text is cut at its wrappers; each of these is read as a variant and written as its plain value, and the pieces are
    joined again. A value that can't be read becomes null, a value without an output form is left out of objects and is
    null in arrays.
    """
    text = functools.reduce(lambda text, leaf: F.regexp_replace(text, leaf, "$1"), _LEAVES, _hidden(texts))
    text = F.regexp_replace(text, _SCOPED, '{"code":$1,"scope":')
    pieces = F.split(F.regexp_replace(text, _WRAPPER, f"{_EDGE}$0{_EDGE}"), _EDGE)

    def read(piece: Column, place: Column) -> Column:
        value = F.when(place % 2 == 1, F.try_parse_json(_shown(piece)))
        key = F.regexp_extract(piece, r'^\{\s*+"\$(\w+)', 1)
        return F.struct(piece.alias("text"), value.alias("value"), key.alias("key"))

    def written(piece: Column) -> Column:
        return F.when(piece["value"].isNull(), piece["text"]).otherwise(_plain(piece["key"], piece["value"], time_unit))

    text = F.array_join(F.transform(F.transform(pieces, read), written), "")
    # Members whose value is left out, those after another member and those that stand first.
    rest = F.regexp_replace(text, rf',\s*+"[^"{_GONE}]*+"\s*+:\s*+{_GONE}', "")
    rest = F.regexp_replace(rest, rf'"[^"{_GONE}]*+"\s*+:\s*+{_GONE}\s*+,?+', "")
    rest = F.replace(rest, F.lit(_GONE), F.lit("null"))
    return _shown(F.when(text.contains(_GONE), rest).otherwise(text))


def _quoted(text: Column) -> Column:
    """A text as JSON, null as well."""
    listed = F.to_json(F.array(text), {"ignoreNullFields": "false"})
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def _plain(key: Column, value: Column, time_unit: str) -> Column:
    """The JSON text of what a wrapper stands for, with hidden backslashes and quotes."""

    def raw(name: str) -> Column:
        return F.to_json(get(value, f"$.${name}", "variant"))

    number = F.coalesce(get(value, "$.$numberInt"), get(value, "$.$numberLong"))
    whole = F.when(number.rlike(r"^\s*[+-]?[0-9]+\s*$"), F.trim(number).try_cast("decimal(38,0)").cast("string"))
    time = get(value, "$.$timestamp.t", "bigint"), get(value, "$.$timestamp.i", "bigint")
    uuid = F.replace(get(value, "$.$uuid"), F.lit("-"), F.lit(""))
    binary = F.coalesce(get(value, "$.$binary.base64"), F.when(F.schema_of_variant(get(value, "$.$binary", "variant")) == "STRING", get(value, "$.$binary")))
    pattern = F.coalesce(get(value, "$.$regularExpression.pattern"), get(value, "$.$regex"))
    options = F.coalesce(get(value, "$.$regularExpression.options"), get(value, "$.$options"), F.lit(""))
    scoped = F.concat(F.lit('{"code":'), raw("code"), F.lit(',"scope":'), raw("scope"), F.lit("}"))
    text = (
        F.when(key == "date", _quoted(iso_millis(_nested_ms(value))))
        .when(key == "timestamp", _quoted(iso_millis(document_time(*time, time_unit))))
        .when(key.isin("numberInt", "numberLong"), whole)
        .when(key.isin("numberDouble", "numberDecimal"), _decimal(F.coalesce(get(value, "$.$numberDouble"), get(value, "$.$numberDecimal"))))
        .when(key == "binary", _quoted(binary))
        .when(key == "uuid", _quoted(F.when(uuid.rlike("^([0-9a-fA-F]{2})*$"), F.base64(F.unhex(uuid)))))
        .when(
            key.isin("regularExpression", "regex", "options"),
            _quoted(F.when(F.trim(options) != "", F.concat(F.lit("("), options, F.lit(")"), pattern)).otherwise(pattern)),
        )
        .when(key.isin("code", "scope"), F.coalesce(scoped, raw("code")))
        .when(key.isin(*DROPPED_KEYS), F.lit(_GONE))
        .otherwise(F.coalesce(raw("oid"), raw("symbol")))
    )
    return F.coalesce(_hidden(text), F.lit("null"))


def member(name: Column, value: Column, declared: Column) -> Column:
    """A member of an object as JSON text, its plain value read as the declared type."""
    nested = F.to_json(value)
    text = (
        F.when(declared == "string", _quoted(get(value, "$")))
        .when(declared == "number", F.to_json(get(value, "$", "double").cast("variant")))
        .when(declared == "integer", get(value, "$", "bigint").cast("string"))
        .when(declared == "boolean", get(value, "$", "boolean").cast("string"))
        .when((declared == "array") & ~nested.startswith("["), F.concat(F.lit("["), nested, F.lit("]")))
        .otherwise(nested)
    )
    return F.concat(_quoted(name), F.lit(":"), F.coalesce(text, F.lit("null")))


def _nested_ms(value: Column) -> Column:
    """Milliseconds of a date inside a value: a number, or ISO text of the years to 9999, in UTC unless it names a zone."""
    text = get(value, "$.$date")
    zoned = text.rlike(r"T.*(Z|[+-][0-9:]+)$")
    rest = F.when(zoned, F.lit("")).when(text.contains("T") | text.contains(" "), F.lit("Z")).otherwise(F.lit("T00:00:00Z"))
    iso = F.when(text.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}"), F.concat(text, rest).try_cast("timestamp"))
    return F.coalesce(get(value, "$.$date", "bigint"), F.unix_millis(iso))


def _decimal(text: Column) -> Column:
    """A number as JSON: the shortest digits of its double; what is no finite number stays text."""
    number = text.try_cast("double")
    digits = F.regexp_replace(number.cast("decimal(38,21)").cast("string"), r"(\.[0-9]+?)0+$", "$1")
    near = (number == 0) | F.abs(number).between(1e-4, 1e16)
    odd = F.isnan(number) | (F.abs(number) == float("inf"))
    return F.when(number.isNull(), F.lit("null")).when(odd, _quoted(text)).when(near, digits).otherwise(number.cast("string"))
