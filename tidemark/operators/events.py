"""Change events: selection, positions, rows and change metadata."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import extjson
from tidemark.functions.predicates import key_after
from tidemark.functions.values import event_position, iso_instant
from tidemark.names import CURSOR, CURSOR_STRIDE, DELETED_AT, DOCUMENT_ID, PACKED, UPDATED_AT
from tidemark.operators.documents import normalize, pack
from tidemark.operators.joins import lookup
from tidemark.operators.ranges import with_dense_number

# Envelope of one change event; the images are JSON texts, the key is the JSON text of the document id.
ENVELOPE = (
    "key string, before string, after string, "
    "source struct<db: string, collection: string, ts_ms: bigint, ord: int, snapshot: string>, op string"
)
UPSERTS = ("c", "i", "u")


def parse_envelopes(df: DataFrame, value: str = "value", key: str | None = None) -> DataFrame:
    """Envelopes from JSON text, as a message log holds them; ``key`` is the column with the event's key JSON."""
    body = F.from_json(F.col(value).cast("string"), ENVELOPE)
    parsed = df.select(body.alias("_e"), *([F.col(key).cast("string").alias("_k")] if key else []))
    columns = [F.col(f"_e.{name}") for name in ("before", "after", "source", "op")]
    # The key message is {"id": "<JSON text of the document id>"}.
    id_text = F.get_json_object("_k", "$.id") if key else F.col("_e.key")
    return parsed.select(id_text.alias("key"), *columns)


def include_streams(events: DataFrame, streams: DataFrame) -> DataFrame:
    """Events of the configured (namespace, stream) pairs, named by database and collection in the events."""
    wanted = streams.select("namespace", "stream").distinct()
    named = events.withColumns({"namespace": F.col("source.db"), "stream": F.col("source.collection")})
    return lookup(named, wanted, ["namespace", "stream"], "left_semi")


def with_position(events: DataFrame) -> DataFrame:
    return events.withColumn("position", event_position(F.col("source.ts_ms"), F.col("source.ord")))


def latest_position(events: DataFrame) -> tuple[int, int] | None:
    """The target of a bounded run: the last position at its start."""
    top = with_position(events).agg(F.max("position").alias("top")).first()["top"]
    return top and tuple(top)


def position_literal(position: Sequence[int]) -> Column:
    seconds, order = position
    return F.struct(F.lit(seconds).cast("bigint").alias("seconds"), F.lit(order).cast("int").alias("ord"))


def bounded(events: DataFrame, target: Sequence[int], after: Sequence[int] | None = None) -> DataFrame:
    """Events after a stored position up to and including the target; the target doesn't hold back snapshot events."""
    ms, at = F.col("source.ts_ms"), F.col("position")
    snapshot = F.col("source.snapshot").isin("true", "last")
    # The first filter is implied by the second, and plain enough for the reader to skip files by. It names the
    # snapshot events in another way, or else the optimizer would fold both into one that readers cannot use.
    near = (ms < (target[0] + 1) * 1000) | (F.col("source.snapshot") != "false")
    kept = snapshot | (at <= position_literal(target))
    if after is not None:
        near, kept = near & (ms >= after[0] * 1000), kept & (at > position_literal(after))
    return with_position(events.where(near)).where(kept)


def key_id(key: Column) -> Column:
    """Document id from the event key, in the text form that the same id has in a document's row.

    Object ids as hex, wrapped numbers as digits, binary ids and UUIDs as base64, dates as ISO text, plain text without
    its quotes. Text that is no JSON, and wrappers of types that no id has, stay as they are.
    """
    value = F.try_parse_json(key)
    shape = F.schema_of_variant(value)
    uuid = F.base64(F.unhex(F.replace(extjson.get(value, "$.$uuid"), F.lit("-"), F.lit(""))))
    binary = F.coalesce(extjson.get(value, "$.$binary.base64"), extjson.get(value, "$.$binary"))
    form = extjson.as_text(value, shape, extjson.time_ms(value, shape), F.lit(None).cast("variant"))
    wrapped = F.coalesce(form, F.when(extjson.shape_is(shape, "binary"), binary), F.when(extjson.shape_is(shape, "uuid"), uuid))
    return F.when(F.ltrim(key).startswith("{"), F.coalesce(wrapped, key)).otherwise(F.coalesce(extjson.get(value, "$"), key))


def _images(events: DataFrame) -> DataFrame:
    """Adds the document image of each event and whether the event deletes."""
    known = F.col("op").isin(*UPSERTS, "d")
    failure = F.raise_error(F.concat(F.lit("unsupported change operation: "), F.coalesce("op", F.lit("null"))))
    op = F.when(known, F.col("op")).otherwise(failure.cast("string"))
    gone = (op == "d") | (F.col("before").isNull() & F.col("after").isNull())
    only_id = F.to_json(F.struct(key_id(F.col("key")).alias(DOCUMENT_ID)))
    image = F.when(gone, F.coalesce("before", only_id)).otherwise(F.coalesce("after", "before"))
    return events.withColumns({"_image": image, "_gone": gone})


def events_to_rows(
    events: DataFrame,
    fields: Mapping[str, str] | None = None,
    keep: Sequence[str] = (),
    time_unit: str = "raw",
) -> DataFrame:
    """Rows of one stream from its change events, stamped with update and delete times.

    With declared ``fields`` the rows are typed columns; without, ``_id`` and the packed document. Unknown
    operations fail the job; filter them out first with :func:`known_events` to set them aside instead.
    """
    stamped = with_position(_images(events)).withColumn("_ms", F.col("source.ts_ms"))
    carried = list(dict.fromkeys([*keep, "position", "_gone", "_ms"]))
    if fields is None:
        rows = pack(stamped, "_image", carried, time_unit)
    else:
        rows = normalize(stamped, "_image", fields, carried, time_unit)
    rows = rows.withColumn(UPDATED_AT, iso_instant(F.col("_ms")))
    return rows.withColumn(DELETED_AT, F.when(F.col("_gone"), F.col(UPDATED_AT))).drop("_gone", "_ms")


def events_by_stream(events: DataFrame, fields: DataFrame, keep: Sequence[str] = (), time_unit: str = "raw") -> DataFrame:
    """Records of the events of all streams in one plan, each with the fields that its own stream declares.

    ``fields`` has a row for each declared field: namespace, stream, field, type. The fields of a stream travel as a map
    that is joined to its events, so one write partitioned by namespace and stream serves any number of streams. Types are
    those of :func:`documents.normalize`; a declared field that a document lacks is left out. A stream without declared
    fields gives empty records.

    Columns: the kept ones, namespace, stream, position, data (a variant), and the update and delete times.
    """
    named = fields.select("namespace", "stream", F.struct("field", F.lower("type").alias("type")).alias("_field"))
    declared = named.groupBy("namespace", "stream").agg(F.map_from_entries(F.collect_set("_field")).alias("_declared"))
    stamped = with_position(_images(events))
    stamped = stamped.withColumns({"namespace": F.col("source.db"), "stream": F.col("source.collection")})
    carried = list(dict.fromkeys([*keep, "namespace", "stream", "position", "_gone"]))
    rows = lookup(stamped.select(*carried, F.col("source.ts_ms").alias("_ms"), "_image"), declared, ["namespace", "stream"], "left")
    image = F.when(F.col("_declared").isNotNull(), F.col("_image"))
    text = F.when(extjson.has_wrappers(image), extjson.plain_texts(image, time_unit)).otherwise(image)
    members = F.map_entries(F.from_json(text, "map<string, variant>", {"mode": "FAILFAST"}))
    rows = rows.withColumn("_members", members)
    shown = F.filter("_members", lambda m: F.map_contains_key("_declared", m["key"]))
    parts = F.transform(shown, lambda m: extjson.member(m["key"], m["value"], F.element_at("_declared", m["key"])))
    record = F.concat(F.lit("{"), F.array_join(parts, ","), F.lit("}"))
    updated = iso_instant(F.col("_ms"))
    return rows.select(
        *[c for c in carried if c != "_gone"],
        F.parse_json(F.coalesce(record, F.lit("{}"))).alias(PACKED),
        updated.alias(UPDATED_AT),
        F.when(F.col("_gone"), updated).alias(DELETED_AT),
    )


def document_rows(documents: DataFrame, fields: Mapping[str, str] | None, time_unit: str = "raw") -> DataFrame:
    """Rows of a collection snapshot, typed or packed like the rows of its change events."""
    if fields is None:
        return pack(documents, "document", time_unit=time_unit)
    return normalize(documents, "document", fields, time_unit=time_unit)


def known_events(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Events with a known operation, and the others."""
    known = F.coalesce(F.col("op").isin(*UPSERTS, "d"), F.lit(False))
    return events.where(known), events.where(~known)


def with_cursor(rows: DataFrame, order: Sequence[str], emitted_at: dt.datetime) -> DataFrame:
    """Adds the cursor: seconds of the run's start times a fixed stride, plus a counter from 1 in row order."""
    numbered = with_dense_number(rows, order, "_number")
    return numbered.withColumn(CURSOR, F.lit(_cursor_start(emitted_at)).cast("bigint") + F.col("_number")).drop("_number")


def stamp_snapshot(
    rows: DataFrame, emitted_at_ms: int, order: Sequence[str] = (DOCUMENT_ID,), incremental: bool = True
) -> DataFrame:
    """Change metadata of snapshot rows; rows of full-refresh streams get none."""
    if not incremental:
        return rows
    return with_cursor(_stamped(rows, emitted_at_ms), order, _moment(emitted_at_ms))


def _moment(ms: int) -> dt.datetime:
    return dt.datetime.fromtimestamp(ms // 1000, dt.timezone.utc)


def _stamped(rows: DataFrame, emitted_at_ms: int) -> DataFrame:
    return rows.withColumns({UPDATED_AT: iso_instant(F.lit(emitted_at_ms)), DELETED_AT: F.lit(None).cast("string")})


def chunked_snapshot(
    rows: DataFrame,
    emitted_at_ms: int,
    chunk_rows: int,
    after: str | None = None,
    incremental: bool = True,
    order: str = DOCUMENT_ID,
) -> DataFrame:
    """Rows of a collection snapshot after a stored id, with change metadata and the number of the chunk of each row.

    The chunks follow the order of the ids as text, so the last id of a chunk is where a later run can go on.
    """
    rest = rows if after is None else rows.where(key_after(rows, [order], (after,)))
    numbered = with_dense_number(rest, [order], "_number")
    chunk = F.call_function("div", F.col("_number") - 1, F.lit(chunk_rows).cast("bigint"))
    chunked = _stamped(numbered, emitted_at_ms) if incremental else numbered
    if incremental:
        chunked = chunked.withColumn(CURSOR, F.lit(_cursor_start(_moment(emitted_at_ms))).cast("bigint") + F.col("_number"))
    return chunked.withColumn("chunk", chunk).drop("_number")


def _cursor_start(emitted_at: dt.datetime) -> int:
    return int(emitted_at.replace(tzinfo=emitted_at.tzinfo or dt.timezone.utc).timestamp()) * CURSOR_STRIDE
