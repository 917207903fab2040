"""Schema discovery and normalisation of JSON documents."""

from __future__ import annotations

import functools
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import extjson
from tidemark.names import DOCUMENT_ID, ID_TYPES, PACKED, TEXT_SUFFIX
from tidemark.operators.ranges import random_rows

# Declared JSON type -> column type; other declared types are taken as Spark numeric types.
NUMERIC = {"number": "double", "integer": "bigint"}


def discover_shapes(df: DataFrame, document: str, by: Sequence[str] = ()) -> DataFrame:
    """The distinct shapes of documents, nested values included, with the number of documents of each: (by…, shape, documents).

    Documents are counted by the text of their shape inside map tasks, whatever the number of their fields. Numbers with a
    fraction are one type, or else each precision would be a shape of its own.
    """
    shape = F.regexp_replace(F.schema_of_variant(F.parse_json(document)), r"DECIMAL\(\d+,\d+\)", "DOUBLE")
    return df.select(*by, shape.alias("shape")).groupBy(*by, "shape").agg(F.count("*").alias("documents"))


def shape_fields(shapes: DataFrame) -> DataFrame:
    """The top-level fields of each shape, one row each: all columns but the shape, field, type.

    Runs over the few distinct shapes, so a Python function may cut their texts.
    """
    others = [f for f in shapes.schema.fields if f.name != "shape"]
    schema = T.StructType([*others, T.StructField("field", T.StringType()), T.StructField("start", T.StringType())])
    names = [f.name for f in others]

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            members = frame.assign(member=[extjson.shape_members(shape) for shape in frame["shape"]]).explode("member").dropna(subset=["member"])
            yield members[names].assign(field=members["member"].str[0], start=members["member"].str[1])

    found = shapes.mapInPandas(cut, schema)
    return found.select(*names, "field", extjson.json_type_of_shape(F.col("start")).alias("type"))


def discover_schema(df: DataFrame, document: str, by: Sequence[str] = ()) -> DataFrame:
    """Top-level fields with their JSON type, from the given (sampled) documents.

    A field seen with several types gets the most frequent one, the first by name among equals. Documents are counted by
    shape first, and only the distinct shapes are taken apart.
    """
    typed = shape_fields(discover_shapes(df, document, by))
    counted = typed.groupBy(*by, "field", "type").agg(F.sum("documents").alias("documents"))
    best = F.min(F.struct(-F.col("documents"), "type"))
    return counted.groupBy(*by, "field").agg(
        best["type"].alias("type"),
        F.sum("documents").alias("documents"),
        F.count("*").alias("types"),
    )


def sample_documents(df: DataFrame, size: int | None = None, seed: int = 7) -> DataFrame:
    """The documents to discover a schema from: all of them, or ``size`` of them at random where that is asked for.

    A field that only documents outside a sample have is not discovered.
    """
    return df if size is None else random_rows(df, size, seed)


def _fields(document: str, names: Sequence[str]) -> Column:
    """The named top-level fields as variants; only these are kept while parsing, and bad JSON is an error.

    The fields of the result are called by their place, for names may differ by case only.
    """
    schema = T.StructType([T.StructField(name, T.VariantType()) for name in names])
    placed = T.StructType([T.StructField(f"f{place}", T.VariantType()) for place in range(len(names))])
    return F.from_json(document, schema, {"mode": "FAILFAST"}).cast(placed)


def id_type(document: str) -> Column:
    return extjson.type_name(_fields(document, [DOCUMENT_ID])["f0"])


def discover_packed(df: DataFrame, document: str, by: Sequence[str] = ()) -> DataFrame:
    """Schemaless discovery: only ``_id`` and the most frequent type of it, the first by name among equals.

    No documents, no rows.
    """
    kind = extjson.json_type(_fields(document, [DOCUMENT_ID])["f0"])
    counted = df.select(*by, kind.alias("type")).groupBy(*by, "type").agg(F.count("*").alias("n"))
    best = F.min(F.struct(-F.col("n"), "type"))
    found = counted.groupBy(*by).agg(F.lit(DOCUMENT_ID).alias("field"), best.alias("best"))
    return found.where("best is not null").select(*by, "field", "best.type")


def id_type_census(df: DataFrame, document: str, by: Sequence[str] = ()) -> DataFrame:
    """Documents per type of ``_id``, and whether that type can be resumed."""
    supported = F.lower("id_type").isin(*[name.lower() for name in ID_TYPES])
    return (
        df.select(*by, id_type(document).alias("id_type"))
        .groupBy(*by, "id_type")
        .agg(F.count("*").alias("documents"))
        .withColumn("supported", F.coalesce(supported, F.lit(False)))
    )


def normalize(
    df: DataFrame,
    document: str,
    fields: Mapping[str, str],
    keep: Sequence[str] = (),
    time_unit: str = "raw",
    rewrite: bool = True,
) -> DataFrame:
    """Typed columns for the declared top-level ``fields``; all other fields are left out.

    ``fields`` maps names to string, number, integer, boolean, object or array (or a Spark numeric type). Objects
    and arrays become variants with everything inside kept; a value that is no array becomes the only element
    of a declared array. A name with the text suffix asks for that field as text. ``rewrite=False`` leaves nested
    values as they are, for documents that are known to hold no wrappers inside.
    """
    names = [name.removesuffix(TEXT_SUFFIX) for name in fields]
    declared = list(fields.values())
    at = range(len(names))
    text = [i for i in at if declared[i] == "string"]
    nested = [i for i in at if declared[i] in ("object", "array")]

    def columns(prefix: str, which: Sequence[int], make) -> list[Column]:
        return [make(i).alias(f"{prefix}{i}") for i in which]

    # Each step is a projection of its own, so that no later expression repeats an earlier one.
    place = {name: i for i, name in enumerate(dict.fromkeys(names))}
    rows = df.select(*keep, _fields(document, list(place)).alias("_v"))
    rows = rows.select(*keep, *columns("_f", at, lambda i: F.col("_v")[f"f{place[names[i]]}"]))
    rows = rows.select("*", *columns("_s", text, lambda i: F.schema_of_variant(f"_f{i}")))
    rows = rows.select(
        "*",
        *columns("_m", text, lambda i: extjson.time_ms(F.col(f"_f{i}"), F.col(f"_s{i}"), time_unit)),
        *columns("_j", text, lambda i: F.when(extjson.foreign(F.col(f"_s{i}")), F.to_json(F.col(f"_f{i}")))),
        *columns("_j", nested, lambda i: F.to_json(F.col(f"_f{i}"))),
    )
    plain = {i: F.col(f"_f{i}") for i in [*text, *nested]}
    if rewrite and plain:
        rows, plain = _rewritten(rows, plain, time_unit)

    def final(i: int, name: str) -> Column:
        value, json = F.col(f"_f{i}"), F.col(f"_j{i}")
        if i in text:
            column = extjson.as_text(value, F.col(f"_s{i}"), F.col(f"_m{i}"), plain[i])
        elif i in nested:
            kept = F.when(extjson.has_form(json), plain[i])
            column = extjson.as_array(kept, json) if declared[i] == "array" else kept
        elif declared[i] == "boolean":
            column = extjson.as_boolean(value)
        else:
            column = extjson.as_number(value, NUMERIC.get(declared[i], declared[i]))
        return column.alias(name)

    return rows.select(*keep, *[final(i, name) for i, name in enumerate(fields)])


def _rewritten(rows: DataFrame, plain: dict[int, Column], time_unit: str) -> tuple[DataFrame, dict[int, Column]]:
    """Replaces values that may hold wrappers by their wrapper-free form.

    Ids, symbols and numbers are replaced first. What still holds wrappers then is rewritten as one text per row, an array
    of these values; rows without any have null there.
    """
    order = list(plain)
    found = {i: extjson.has_wrappers(F.col(f"_j{i}")) for i in order}
    native = [F.when(found[i], extjson.native_texts(F.col(f"_j{i}"))).alias(f"_n{i}") for i in order]
    rows = rows.select("*", *native)
    asked = {i: extjson.has_wrappers(F.col(f"_n{i}")) for i in order}
    parts = F.concat_ws(",", *[F.when(asked[i], F.col(f"_n{i}")).otherwise(F.lit("null")) for i in order])
    some = functools.reduce(lambda a, b: a | b, asked.values())
    text = F.when(some, F.concat(F.lit("["), parts, F.lit("]")))
    rows = rows.select("*", extjson.plain_texts(text, time_unit).alias("_t"))
    rows = rows.select("*", F.parse_json("_t").alias("_p")).drop("_t")
    at = {i: F.variant_get("_p", f"$[{place}]", "variant") for place, i in enumerate(order)}
    return rows, {i: F.when(asked[i], at[i]).when(found[i], F.parse_json(f"_n{i}")).otherwise(plain[i]) for i in order}


def pack(df: DataFrame, document: str, keep: Sequence[str] = (), time_unit: str = "raw") -> DataFrame:
    """Schemaless form: ``_id`` as text and the whole document, with plain values, as one variant.

    Only documents with wrappers of the rarer types are cut at their wrappers.
    """
    text = F.when(extjson.has_wrappers(F.col(document)), extjson.native_texts(F.col(document))).otherwise(F.col(document))
    rows = df.select(*keep, text.alias("_n"))
    asked = F.when(extjson.has_wrappers(F.col("_n")), F.col("_n"))
    packed = rows.select(*keep, F.coalesce(extjson.plain_texts(asked, time_unit), F.col("_n")).alias("_t"))
    packed = packed.select(*keep, F.parse_json("_t").alias(PACKED))
    return packed.select(*keep, F.try_variant_get(PACKED, "$._id", "string").alias(DOCUMENT_ID), PACKED)
