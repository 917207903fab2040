"""One query per operator. Every query reads whole tables; ranges and bounds are what the operator is for."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from tidemark.functions import extjson, values
from tidemark.functions.predicates import cutoff, key_range
from tidemark.names import CURSOR, DELETED_AT, UPDATED_AT
from tidemark.operators import catalog, documents, events, increment, merge, ranges
from tidemark.operators import snapshot as snap
from tidemark.operators.buckets import BucketTable
from tidemark.plans import collections as collection_plans
from tidemark.plans import state as states
from tidemark.plans import tables as table_plans
from tidemark.session import shared_dir
from tidemark.streaming import changes as change_streams
from tidemark.streaming.once import newest_only
from tidemark.streaming.resume import append_log, resume_run
from tidemark.workload import inputs
from tidemark.workload.inputs import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

NOW = dt.datetime(2000, 6, 15, 13, 30)
EMITTED = dt.datetime(2024, 2, 1)
ORDER_FIELDS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _day(column: str) -> F.Column:
    """A time as text, the same in every engine."""
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias(column)


def _orders(df: DataFrame) -> DataFrame:
    return df.select(*[_day(c) if c == "o_orderdate" else c for c in df.columns])


def _text(value: dt.datetime | None) -> F.Column:
    return F.lit(value and value.strftime("%Y-%m-%dT%H:%M:%S.%f"))


# -- ranges ------------------------------------------------------------------------------------------------------


@query
def keyset_range(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    keys = ["l_orderkey", "l_linenumber"]
    return lines.where(key_range(lines, keys, (10, 2), ranges.max_key(lines, keys)))


@query
def snapshot_full(spark, sf_dir):
    return _orders(snap.snapshot(table(spark, sf_dir, "orders"), ORDER_FIELDS).rows)


@query
def snapshot_resume(spark, sf_dir):
    read = snap.snapshot_range(table(spark, sf_dir, "orders"), ["o_custkey", "o_totalprice"], ["o_orderkey"], (100,))
    return read.rows


@query
def split_cover(spark, sf_dir):
    """Cuts a table into ranges by one scan; the totals show gaps, overlaps and wrong numbers."""
    orders, keys = table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"]
    cuts = ranges.split_points(orders, keys, 8)
    parts = ranges.split_ranges(cuts)
    held = F.array(*[key_range(orders, keys, low, high).cast("int") for low, high in parts])
    numbered = ranges.with_range(orders, keys, cuts)
    placed = numbered.select("o_orderkey", "range", held.alias("held"))
    own = (F.get("held", F.col("range")) == 1) & (F.aggregate("held", F.lit(0), lambda a, b: a + b) == 1)
    return placed.agg(
        F.count("*").alias("n_rows"),
        F.sum("o_orderkey").alias("key_sum"),
        F.min("o_orderkey").alias("first_key"),
        F.max("o_orderkey").alias("last_key"),
        F.bool_and(own).alias("same_numbers"),
    )


@query
def split_sketch(spark, sf_dir):
    """Cuts a table by stored sketches of its parts, which are merged; ranges are even, without gap or overlap."""
    orders, keys = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), ["o_orderkey"]
    older = F.col("o_orderdate") < F.lit("1997-01-01")
    parts = [ranges.key_sketch(orders.where(part), "o_orderkey") for part in (older, ~older)]
    cuts = ranges.sketch_points(ranges.merge_sketches(parts[0].unionByName(parts[1])), 8)
    held = F.array(*[key_range(orders, keys, low, high).cast("int") for low, high in ranges.split_ranges(cuts)])
    placed = ranges.with_range(orders.select("o_orderkey", held.alias("held")), keys, cuts)
    own = (F.get("held", F.col("range")) == 1) & (F.aggregate("held", F.lit(0), lambda a, b: a + b) == 1)
    counts = placed.groupBy("range").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"), F.bool_and(own).alias("own"))
    return counts.agg(
        F.sum("n").alias("n_rows"),
        F.sum("keys").alias("key_sum"),
        F.count("*").alias("n_ranges"),
        F.bool_and("own").alias("same_numbers"),
        (F.max("n") * 8 <= F.sum("n") * 1.05).alias("even"),
    )


def _chunks(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return ranges.chunk_scan(orders, ["o_orderkey"], 1000, (100,))


@query
def chunk_scan(spark, sf_dir):
    return _chunks(spark, sf_dir)


@query
def checkpoints(spark, sf_dir):
    return ranges.checkpoints(_chunks(spark, sf_dir), ["o_orderkey"]).withColumnRenamed("rows", "n_rows")


@query
def sample_rows(spark, sf_dir):
    return snap.sample_rows(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), 256, 0.5, ["o_orderkey"])


@query
def sample_first(spark, sf_dir):
    return snap.sample_rows(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), 1024, keys=["o_orderkey"])


@query
def sample_check(spark, sf_dir):
    """A random sample has the size asked for, holds rows of the table only, and none of them twice."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    sample = snap.sample_rows(orders, 256, 0.5, ["o_orderkey"])
    known = sample.join(orders.withColumn("known", F.lit(1)), ["o_orderkey", "o_totalprice"], "left")
    return known.agg(
        F.count("*").alias("n_rows"), F.count("known").alias("n_known"), F.countDistinct("o_orderkey").alias("n_keys")
    )


# -- cursor ------------------------------------------------------------------------------------------------------


@query
def max_cursor(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    top = increment.max_cursor(orders, "o_orderdate")
    before = increment.max_cursor(orders, "o_orderdate", cutoff(orders, "o_orderdate", NOW))
    # The bounds as one row over the table they came from.
    return orders.agg(F.count("*").alias("n_rows")).select("n_rows", _text(top).alias("top"), _text(before).alias("before"))


@query
def cursor_increment(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    read = increment.cursor_increment(orders, ORDER_FIELDS, "o_orderdate", "1996-05-01T00:00:00")
    return _orders(read.rows).withColumn("next_cursor", _text(read.state["cursor"]))


@query
def cursor_cutoff(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    limit = cutoff(orders, "o_orderdate", NOW)
    read = increment.cursor_increment(orders, ORDER_FIELDS, "o_orderdate", "1996-05-01T00:00:00", cutoff=limit)
    return _orders(read.rows).withColumn("next_cursor", _text(read.state["cursor"]))


@query
def time_cursor(spark, sf_dir):
    """Increments by a time of the day, as text: all after a stored one, and none where today is left out."""
    timed = table(spark, sf_dir, "events").select("event_id", F.date_format("ts", "HH:mm:ss.SSSSSS").alias("at"))
    every = increment.cursor_increment(timed, ["event_id"], "at", "06:30:00")
    limit = cutoff(timed, "at", NOW, logical_type="time")
    none = increment.cursor_increment(timed, ["event_id"], "at", "06:30:00", cutoff=limit)
    rows = every.rows.withColumn("today", F.lit("in")).unionByName(none.rows.withColumn("today", F.lit("out")))
    return rows.withColumns({"next_cursor": F.lit(every.state["cursor"]), "next_without": F.lit(none.state["cursor"])})


@query
def snapshot_cursor(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    limit = cutoff(orders, "o_orderdate", NOW)
    read = snap.snapshot_with_cursor(orders, ORDER_FIELDS, "o_orderdate", ["o_orderkey"], (100,), limit)
    return _orders(read.rows).withColumn("next_cursor", _text(read.state["cursor"]))


@query
def snapshot_nokey_cursor(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    limit = cutoff(lines, "l_shipdate", NOW)
    read = snap.snapshot_with_cursor(lines, ["l_orderkey", "l_linenumber", "l_shipdate"], "l_shipdate", cutoff=limit)
    return read.rows.select("l_orderkey", "l_linenumber", _day("l_shipdate")).withColumn(
        "next_cursor", _text(read.state["cursor"])
    )


# -- change table ------------------------------------------------------------------------------------------------


def _version(spark, sf_dir) -> int:
    return increment.max_cursor(inputs.order_changes(spark, sf_dir), "sys_change_version")


@query
def ct_snapshot(spark, sf_dir):
    version = _version(spark, sf_dir)
    read = snap.versioned_snapshot(table(spark, sf_dir, "orders"), ["o_totalprice"], version, ["o_orderkey"], (100,))
    return read.rows.withColumn("ct_version", F.lit(read.state["ct_version"]))


@query
def ct_snapshot_nokey(spark, sf_dir):
    version = _version(spark, sf_dir)
    read = snap.versioned_snapshot(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_partkey", "l_quantity"], version)
    return read.rows.withColumn("ct_version", F.lit(read.state["ct_version"]))


@query
def net_changes(spark, sf_dir):
    return increment.net_changes(inputs.order_changes(spark, sf_dir), ["o_orderkey"], 1200)


def _order_increment(spark, sf_dir, few_changes=None):
    read = increment.change_increment(
        inputs.order_changes(spark, sf_dir),
        inputs.current_orders(spark, sf_dir),
        ORDER_FIELDS,
        ["o_orderkey"],
        since=1200,
        next_version=_version(spark, sf_dir),
        now=dt.datetime(2024, 1, 1, 0, 0, 0, 250_000),
        few_changes=few_changes,
    )
    return _orders(read.rows).withColumn("ct_version", F.lit(read.state["ct_version"]))


@query
def ct_increment(spark, sf_dir):
    return _order_increment(spark, sf_dir)


@query
def ct_increment_many(spark, sf_dir):
    """As if the changed keys were too many for a broadcast."""
    return _order_increment(spark, sf_dir, few_changes=False)


# -- change events -----------------------------------------------------------------------------------------------


def _user_rows(change_events: DataFrame) -> DataFrame:
    return events.events_to_rows(change_events, inputs.USER_FIELDS, keep=["event_id"])


@query
def cdc_rows(spark, sf_dir):
    rows = _user_rows(inputs.change_events(spark, sf_dir))
    return rows.select("event_id", "_id", "user", "value", "kind", F.to_json("props").alias("props"), UPDATED_AT, DELETED_AT)


@query
def cdc_packed(spark, sf_dir):
    rows = events.events_to_rows(inputs.change_events(spark, sf_dir), keep=["event_id"])
    return rows.select(
        "event_id",
        "_id",
        extjson.get(F.col("data"), "$.user", "bigint").alias("user"),
        extjson.get(F.col("data"), "$.value", "double").alias("value"),
        extjson.get(F.col("data"), "$.extra").alias("extra"),
        extjson.get(F.col("data"), "$.props.k", "bigint").alias("props_k"),
        DELETED_AT,
    )


@query
def cdc_lookup(spark, sf_dir):
    images = increment.current_images(inputs.change_events(spark, sf_dir), inputs.user_documents(spark, sf_dir), ["key"])
    return _user_rows(images).select("event_id", "_id", "user", "value", "kind", DELETED_AT)


@query
def cdc_cursor(spark, sf_dir):
    change_events = events.with_position(inputs.change_events(spark, sf_dir)).select("event_id", "position")
    ordered = change_events.select("event_id", "position.seconds", "position.ord")
    return events.with_cursor(ordered, ["seconds", "ord", "event_id"], EMITTED)


@query
def event_key_id(spark, sf_dir):
    """Keys of all forms: object ids, wrapped numbers, quoted text, bytes, UUIDs and plain numbers."""
    keyed = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        """case event_type when 'signup' then concat('{"$oid":"', lpad(lower(hex(event_id)), 24, '0'), '"}')
             when 'click' then concat('{"$numberLong":"', event_id, '"}')
             when 'view' then concat('"', event_type, event_id, '"')
             when 'purchase' then concat('{"$binary":{"base64":"', base64(cast(event_type as binary)), '","subType":"00"}}')
             else if(event_id % 2 = 0, cast(event_id as string),
                     concat('{"$uuid":"00000000-0000-0000-0000-', lpad(lower(hex(event_id)), 12, '0'), '"}')) end as key""",
    )
    return keyed.select("event_id", events.key_id(F.col("key")).alias("_id"))


@query
def event_position(spark, sf_dir):
    at = events.with_position(inputs.change_events(spark, sf_dir))
    stored = events.position_literal((1705708800, 2))
    return at.select(
        "event_id",
        "position.seconds",
        "position.ord",
        (F.col("position") >= stored).alias("reached"),
        (F.col("position") == stored).alias("same"),
    )


@query
def event_include(spark, sf_dir):
    kept = events.include_streams(inputs.change_events(spark, sf_dir), inputs.streams(spark, sf_dir))
    return kept.select("event_id", "namespace", "stream")


@query
def events_by_stream(spark, sf_dir):
    """The records of all streams at once; some streams declare no fields."""
    change_events = inputs.change_events(spark, sf_dir)
    records = events.events_by_stream(change_events, inputs.stream_fields(spark, sf_dir), ["event_id"])
    data = F.col("data")
    return records.select(
        "event_id",
        "namespace",
        "stream",
        F.size(F.from_json(F.to_json(data), "map<string, string>")).alias("n_fields"),
        extjson.get(data, "$._id").alias("_id"),
        extjson.get(data, "$.user", "bigint").alias("user"),
        extjson.get(data, "$.value", "double").alias("value"),
        F.to_json(F.variant_get(data, "$.kind", "variant")).alias("kind"),
        extjson.get(data, "$.props.k", "bigint").alias("props_k"),
        UPDATED_AT,
        DELETED_AT,
    )


@query
def bounded_changes(spark, sf_dir):
    change_events = inputs.change_events(spark, sf_dir)
    kept = events.bounded(change_events, events.latest_position(change_events), after=(1704400000, 2))
    return kept.select("event_id", "position.seconds", "position.ord", "op")


@query
def bounded_target(spark, sf_dir):
    """A run that stops inside the log."""
    kept = events.bounded(inputs.change_events(spark, sf_dir), (1705708800, 2), after=(1704400000, 2))
    return kept.select("event_id", "position.seconds", "position.ord", "op")


def _applied(changes: DataFrame, base: DataFrame) -> DataFrame:
    return merge.apply_changes(base, changes, ["_id"], ["position", "event_id"])


def _changes(spark, sf_dir, change_events: DataFrame) -> DataFrame:
    rows = _user_rows(change_events)
    return rows.select("event_id", "position", "_id", "user", "value", "kind", UPDATED_AT, DELETED_AT)


@query
def apply_changes(spark, sf_dir):
    return _applied(_changes(spark, sf_dir, inputs.change_events(spark, sf_dir)), inputs.user_base(spark, sf_dir))


@query
def apply_changes_hard(spark, sf_dir):
    changes = _changes(spark, sf_dir, inputs.change_events(spark, sf_dir))
    base = inputs.user_base(spark, sf_dir)
    merged = merge.apply_changes(base, changes, ["_id"], ["position", "event_id"], hard=True)
    return merged.drop(DELETED_AT)


@query
def apply_replay(spark, sf_dir):
    """All changes, then the older half of them again on what was folded: nothing is rolled back."""
    changes = _changes(spark, sf_dir, inputs.change_events(spark, sf_dir))
    base = inputs.user_base(spark, sf_dir)
    placed = base.withColumns({c: F.lit(None).cast(changes.schema[c].dataType) for c in ("event_id", "position")})
    folded = _applied(changes, placed.select(*changes.columns))
    return _applied(changes.where("position.seconds < 1705708800"), folded).select(*base.columns)


def _run_folder(spark, name):
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query
def apply_buckets(spark, sf_dir):
    """The same on a stored table in key buckets: the older changes, then the newer ones."""
    changes = _changes(spark, sf_dir, inputs.change_events(spark, sf_dir))
    base = inputs.user_base(spark, sf_dir)
    placed = base.withColumns({c: F.lit(None).cast(changes.schema[c].dataType) for c in ("event_id", "position")})
    stored = BucketTable(spark, _run_folder(spark, "apply_buckets"), ["_id"], 16)
    stored.create(placed.select(*changes.columns))
    older = F.col("position.seconds") < 1705708800
    for part in (older, ~older):
        stored.apply(changes.where(part), ["position", "event_id"])
    return stored.read().select(*base.columns)


@query
def stream_resume(spark, sf_dir):
    """Two bounded runs over a stored log: up to a position, and from there to the end."""
    folder = _run_folder(spark, "stream_resume")
    change_events = inputs.change_events(spark, sf_dir)
    append_log(change_events, f"{folder}/log")
    schema = events.with_position(change_events).schema
    for until in ((1705708800, 2), None):
        resume_run(spark, f"{folder}/log", schema, f"{folder}/out", f"{folder}/state", "app", "log", until)
    read = spark.read.schema(schema.add("batch", IntegerType())).parquet(f"{folder}/out")
    return read.select("event_id", "position.seconds", "position.ord", F.col("batch").alias("run"))


@query
def stream_once(spark, sf_dir):
    """A stream that delivers every event twice and in any order: only what is newer than all before is stored."""
    schema = table(spark, sf_dir, "events").schema
    streams = [spark.readStream.schema(schema).parquet(f"{sf_dir}/events*.parquet") for _ in range(2)]
    twice = streams[0].unionByName(streams[1]).repartition(spark.sparkContext.defaultParallelism)
    changes = _changes(spark, sf_dir, inputs.envelopes(twice)).select("*", "position.*").drop("position")
    keys, order = ["_id"], ["seconds", "ord", "event_id"]
    run = _run_folder(spark, "stream_once")
    newest = newest_only(changes, keys, order)
    change_streams.store_changes(newest, f"{run}/changes", f"{run}/progress", keys, order).awaitTermination()
    stored = change_streams.stored_changes(spark, f"{run}/changes", changes.schema)
    return change_streams.current(inputs.user_base(spark, sf_dir), stored, keys, order)


@query
def stream_apply(spark, sf_dir):
    """The same through a stream: batches of stored changes, merged with the base when read."""
    schema = table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1000).parquet(f"{sf_dir}/events*.parquet")
    # Files may be few; parsing is spread over all cores.
    stream = stream.repartition(spark.sparkContext.defaultParallelism)
    changes = _changes(spark, sf_dir, inputs.envelopes(stream))
    run = _run_folder(spark, "stream_apply")
    keys, order = ["_id"], ["position", "event_id"]
    change_streams.store_changes(changes, f"{run}/changes", f"{run}/progress", keys, order).awaitTermination()
    stored = change_streams.stored_changes(spark, f"{run}/changes", changes.schema)
    return change_streams.current(inputs.user_base(spark, sf_dir), stored, keys, order)


# -- documents ---------------------------------------------------------------------------------------------------


def _normal(spark, sf_dir, *names, keep=("event_id",)):
    fields = {n: inputs.DOCUMENT_FIELDS[n] for n in names} if names else inputs.DOCUMENT_FIELDS
    return documents.normalize(inputs.documents(spark, sf_dir), "document", fields, keep)


@query
def discover_schema(spark, sf_dir):
    found = documents.discover_schema(inputs.documents(spark, sf_dir), "document", ["event_type"])
    return found.withColumnsRenamed({"documents": "n_documents", "types": "n_types"})


@query
def discover_shapes(spark, sf_dir):
    """Distinct shapes with their top-level fields, as counted before any document is taken apart."""
    shapes = documents.discover_shapes(inputs.documents(spark, sf_dir), "document", ["event_type"])
    named = documents.shape_fields(shapes.withColumn("number", F.xxhash64("shape")))
    fields = F.array_join(F.array_sort(F.collect_list(F.concat("field", F.lit(":"), "type"))), ",").alias("fields")
    listed = named.groupBy("event_type", "number", "documents").agg(fields)
    return listed.groupBy("event_type", "fields").agg(F.sum("documents").alias("n_documents"))


@query
def discover_schema_all(spark, sf_dir):
    """Over all documents as one collection; one field has conflicting types."""
    found = documents.discover_schema(inputs.documents(spark, sf_dir), "document")
    return found.withColumnsRenamed({"documents": "n_documents", "types": "n_types"})


@query
def discover_schema_sample(spark, sf_dir):
    """From a sample: the fields that every document has."""
    docs = documents.sample_documents(inputs.documents(spark, sf_dir), 400)
    found = documents.discover_schema(docs, "document")
    return found.where("types = 1").select("field", "type", (F.col("documents") == 400).alias("in_all"))


@query
def discover_schemaless(spark, sf_dir):
    return documents.discover_packed(inputs.documents(spark, sf_dir), "document", ["event_type"])


@query
def id_type_census(spark, sf_dir):
    census = documents.id_type_census(inputs.id_documents(spark, sf_dir), "document", ["event_type"])
    return census.withColumnRenamed("documents", "n_documents")


@query
def normalize_docs(spark, sf_dir):
    return _normal(spark, sf_dir).select(
        "event_id",
        "_id",
        "user",
        "at",
        "clock",
        "price",
        F.to_json("tags").alias("tags"),
        extjson.get(F.col("more"), "$.seen").alias("more_seen"),
        extjson.get(F.col("more"), "$.list[0]", "bigint").alias("more_first"),
        extjson.get(F.col("props"), "$.k", "bigint").alias("props_k"),
    )


@query
def snapshot_docs(spark, sf_dir):
    rows = _normal(spark, sf_dir, "_id", "user", "price", keep=())
    return events.stamp_snapshot(rows, 1706745600125)


@query
def snapshot_docs_plain(spark, sf_dir):
    """Documents of a full refresh: rows without change metadata."""
    rows = _normal(spark, sf_dir, "_id", "user", "price", keep=())
    return events.stamp_snapshot(rows, 1706745600125, incremental=False)


@query
def snapshot_docs_resume(spark, sf_dir):
    """The rest of a snapshot after a stored id, in chunks."""
    rows = _normal(spark, sf_dir, "_id", "user", "price", keep=())
    return events.chunked_snapshot(rows, 1706745600125, 100, after=f"{250:024x}")


@query
def value_types(spark, sf_dir):
    """One value of every type in the form that rows have it in."""
    typed = documents.normalize(inputs.value_documents(spark, sf_dir), "document", inputs.VALUE_FIELDS, ["event_id"])
    return typed.select(
        "event_id",
        *[n for n, kind in inputs.VALUE_FIELDS.items() if kind not in ("object", "array")],
        F.to_json("list").alias("list"),
        extjson.get(F.col("scoped"), "$.code").alias("scoped_code"),
        extjson.get(F.col("scoped"), "$.scope.id", "bigint").alias("scoped_id"),
        extjson.get(F.col("inside"), "$.at").alias("inside_at"),
        extjson.get(F.col("inside"), "$.n", "int").alias("inside_n"),
        F.variant_get(F.col("inside"), "$.gone", "variant").isNull().alias("inside_gone"),
    )


@query
def array_wrap(spark, sf_dir):
    """Declared arrays: some values are arrays, some are not, missing ones stay missing."""
    wrapped = documents.normalize(
        inputs.documents(spark, sf_dir), "document", {"tags": "array", "user": "array", "none": "array"}, ["event_id"]
    )
    return wrapped.select("event_id", *[F.to_json(c).alias(c) for c in ("tags", "user", "none")])


@query
def force_string(spark, sf_dir):
    fields = {"props_aibyte_transform": "string", "user_aibyte_transform": "string", "tags_aibyte_transform": "string"}
    return documents.normalize(inputs.documents(spark, sf_dir), "document", fields, ["event_id"])


@query
def pack_docs(spark, sf_dir):
    packed = documents.pack(inputs.documents(spark, sf_dir), "document", ["event_id"])
    data = F.col("data")
    return packed.select(
        "event_id",
        "_id",
        extjson.get(data, "$._id").alias("data_id"),
        extjson.get(data, "$.user", "bigint").alias("user"),
        extjson.get(data, "$.at").alias("at"),
        extjson.get(data, "$.price", "double").alias("price"),
        extjson.get(data, "$.more.seen").alias("more_seen"),
        extjson.get(data, "$.props.k", "bigint").alias("props_k"),
    )


@query
def collection_stats(spark, sf_dir):
    stats = catalog.collection_stats(table(spark, sf_dir, "documents"), ["text"], ["source"])
    return catalog.estimate(stats, 2).withColumnsRenamed({"rows": "n_rows", "bytes": "n_bytes"})


@query
def chunk_size(spark, sf_dir):
    """Chunk sizes of conversations by role, of the empty text that some have not, and of nothing at all."""
    turns = table(spark, sf_dir, "conversations")
    stats = catalog.collection_stats(turns, ["text"], ["role"])
    return stats.select(
        "role",
        catalog.chunk_rows(F.col("rows"), F.col("bytes")).alias("chunk"),
        catalog.chunk_rows(F.col("rows"), F.lit(0)).alias("chunk_no_bytes"),
        catalog.chunk_rows(F.col("bytes"), F.col("rows")).alias("chunk_tiny_rows"),
        catalog.chunk_rows(F.lit(None), F.lit(None)).alias("chunk_unknown"),
    )


# -- metadata ----------------------------------------------------------------------------------------------------


def _joined(*names):
    return [F.array_join(n, ",").alias(n) for n in names]


@query
def discover_tables(spark, sf_dir):
    """Default discovery, and discovery of a named namespace with its upper-case form."""
    found = inputs.meta_tables(spark, sf_dir)
    every = catalog.list_tables(found).withColumn("asked", F.lit("all"))
    return every.unionByName(catalog.list_tables(found, ["dbo"]).withColumn("asked", F.lit("dbo")))


@query
def discover_columns(spark, sf_dir):
    known = catalog.list_tables(inputs.meta_tables(spark, sf_dir))
    return catalog.list_columns(inputs.meta_columns(spark, sf_dir), known)


@query
def type_map(spark, sf_dir):
    typed = catalog.map_types(inputs.meta_columns(spark, sf_dir))
    return typed.select("namespace", "table", "column", "ordinal", "logical_type", "spark_type")


def _keys(spark, sf_dir):
    known = catalog.list_tables(inputs.meta_tables(spark, sf_dir))
    physical = catalog.primary_keys(inputs.key_usage(spark, sf_dir), inputs.key_constraints(spark, sf_dir), known)
    clustered = catalog.clustered_keys(**inputs.system_tables(spark, sf_dir), known=known)
    return known, physical, clustered


@query
def discover_pk(spark, sf_dir):
    return _keys(spark, sf_dir)[1].select("namespace", "table", *_joined("primary_key"))


@query
def discover_clustered(spark, sf_dir):
    return _keys(spark, sf_dir)[2].select("namespace", "table", *_joined("clustered_key"))


def _effective(spark, sf_dir):
    known, physical, clustered = _keys(spark, sf_dir)
    return known, catalog.effective_keys(known, physical, inputs.logical_keys(spark, sf_dir), clustered)


@query
def effective_pk(spark, sf_dir):
    return _effective(spark, sf_dir)[1].select("namespace", "table", *_joined("primary_key"))


@query
def ordered_column(spark, sf_dir):
    return _effective(spark, sf_dir)[1].select("namespace", "table", "ordered_column")


@query
def catalog_rel(spark, sf_dir):
    built = catalog.build_catalog(*_effective(spark, sf_dir), change_tracking=True)
    lists = _joined("sync_modes", "primary_key", "added_columns")
    return built.select("namespace", "table", *lists, "resumable", "source_cursor")


def _document_catalog(spark, sf_dir, packed):
    found = documents.discover_schema(inputs.documents(spark, sf_dir), "document", ["event_type"])
    built = catalog.build_document_catalog(found, ["event_type"], packed)
    shown = F.transform("fields", lambda f: F.concat(f["field"], F.lit(":"), f["type"]))
    return built.select(
        "event_type",
        F.array_join(shown, ",").alias("fields"),
        *_joined("sync_modes", "primary_key"),
        "cursor_field",
        "source_cursor",
        "resumable",
    )


@query
def catalog_doc(spark, sf_dir):
    return _document_catalog(spark, sf_dir, packed=False)


@query
def catalog_doc_packed(spark, sf_dir):
    return _document_catalog(spark, sf_dir, packed=True)


@query
def discover_collections(spark, sf_dir):
    return catalog.list_collections(inputs.collection_list(spark, sf_dir))


# -- planning ----------------------------------------------------------------------------------------------------


@query
def plan_sync(spark, sf_dir):
    """Retention alone: which stored versions are older than what the tables still keep."""
    streams = inputs.tracked_streams(spark, sf_dir)
    return streams.select("stream", "stored_version", table_plans.expired().alias("expired"))


@query
def plan_sync_ct(spark, sf_dir):
    planned = table_plans.tracking_reads(inputs.tracked_streams(spark, sf_dir))
    return planned.select("stream", "rule", "read", "after_key", "since_version", "next_version")


@query
def plan_sync_cursor(spark, sf_dir):
    planned = table_plans.cursor_reads(inputs.cursor_streams(spark, sf_dir))
    return planned.select("stream", "rule", "read", "after_key", "after_cursor")


def _selection(spark, sf_dir, valid=True):
    return collection_plans.snapshot_selection(
        inputs.collection_streams(spark, sf_dir), inputs.collection_states(spark, sf_dir), valid
    )


@query
def snapshot_selection(spark, sf_dir):
    kept = _selection(spark, sf_dir).withColumn("offset", F.lit("valid"))
    lost = _selection(spark, sf_dir, False).withColumn("offset", F.lit("invalid"))
    return kept.unionByName(lost).drop("sync_mode")


@query
def sync_phases(spark, sf_dir):
    kept = collection_plans.phases(_selection(spark, sf_dir)).withColumn("offset", F.lit("valid"))
    lost = collection_plans.phases(_selection(spark, sf_dir, False)).withColumn("offset", F.lit("invalid"))
    return kept.unionByName(lost)


@query
def offset_check(spark, sf_dir):
    """Per user: the log is kept from a day on, the stored position is that of the last purchase."""
    log = events.with_position(inputs.change_events(spark, sf_dir)).withColumn("stream", F.col("key"))
    kept = log.where(F.col("position.seconds") >= 1705000000)
    purchases = table(spark, sf_dir, "events").where("event_type = 'purchase'").select("event_id")
    stored = log.join(purchases, "event_id", "left_semi").groupBy("stream").agg(F.max("position").alias("stored"))
    checked = collection_plans.offset_check(kept, stored, ["stream"])
    return checked.select(
        "stream", F.col("stored.seconds").alias("stored"), F.col("oldest.seconds").alias("oldest"), "valid"
    )


@query
def latest_state(spark, sf_dir):
    return states.latest_state(inputs.state_log(spark, sf_dir)).select(
        "namespace", "stream", "batch", "status", "cursor", "schema_enforced"
    )


# -- values ------------------------------------------------------------------------------------------------------


@query
def state_values(spark, sf_dir):
    """Stored bounds of all types, one of each per order, with blank and unreadable ones among them."""
    stored = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "if(o_orderstatus = 'P', 'null', cast(o_custkey as string)) as whole",
        "if(o_orderstatus = 'P', '', cast(cast(o_totalprice as decimal(18,2)) as string)) as number",
        "base64(cast(o_orderpriority as binary)) as bytes",
        """case o_orderstatus when 'O' then date_format(o_orderdate, "yyyy-MM-dd'T'HH:mm:ss")
             when 'P' then date_format(o_orderdate, "yyyy-MM-dd'T'HH:mm:ss'.25'") else 'soon' end as local""",
        """case o_orderstatus when 'O' then date_format(o_orderdate, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS' +02:00'")
             when 'P' then date_format(o_orderdate, "yyyy-MM-dd'T'HH:mm:ss'.1234567'") else 'later' end as zoned""",
    )
    kinds = {"whole": "integer", "number": "number", "bytes": "binary", "local": "timestamp", "zoned": "timestamptz"}
    return stored.select("o_orderkey", *[values.stored_bound(F.col(n), kind).alias(n) for n, kind in kinds.items()])


@query
def id_text(spark, sf_dir):
    """Ids of all types as stored text, and binary ids back from it."""
    ids = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "unhex(lpad(lower(hex(event_id)), 32, '0')) as bytes",
        "if(event_type = 'click', 4, 0) as subtype",
    )
    stored = values.id_to_text(F.col("bytes"), "binData", F.col("subtype"))
    texts = ids.select("event_id", values.id_to_text(F.col("event_id"), "long").alias("long_id"), stored.alias("binary_id"))
    return texts.withColumn("bytes", F.lower(F.hex(values.text_to_binary_id(F.col("binary_id")))))


@query
def token_time(spark, sf_dir):
    tokens = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        f"concat('82', lpad(hex(div({inputs.MS}, 1000)), 8, '0'), lpad(hex(event_id % 1000 + 1), 8, '0'), '2B0229296E04') as token",
    )
    at = values.token_position(F.col("token"))
    return tokens.select("event_id", at["seconds"].alias("seconds"), at["ord"].alias("ord"))
