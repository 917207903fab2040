"""Whole runs: plan the next read of every stream, write its rows, then store its state.

Rows of one read go to ``<out>/<namespace>/<stream>/batch=<n>``. The state row follows the rows, so a run that
dies in between writes the same batch again. Large snapshots are cut into key ranges or chunks, each of them a batch and
a checkpoint of its own.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import json
import threading
import warnings
from collections.abc import Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.predicates import bound, cutoff
from tidemark.names import CURSOR, DELETED_AT, DOCUMENT_ID, ID_TYPES
from tidemark.operators import events, increment, ranges
from tidemark.operators.catalog import chunk_rows as chunk_size
from tidemark.operators import snapshot as snap
from tidemark.operators.documents import id_type_census
from tidemark.operators.merge import latest_per_key
from tidemark.plans.collections import phases, snapshot_selection
from tidemark.plans.state import append_state, compact_state, read_state, text
from tidemark.plans.tables import cursor_reads, tracking_reads, with_state
from tidemark.session import children, remove

#: Streams that are read at the same time, so that a small one leaves no cluster idle.
AT_ONCE = 4
#: A state log of more files than this is compacted by the run that finds it so.
STATE_FILES = 64

# Two jobs must not append to one folder at the same time.
_APPENDING = threading.Lock()


class SyncError(Exception):
    """The settings or the stored state do not allow the read."""


@dataclasses.dataclass(frozen=True)
class Table:
    """A configured table: its rows now and what is known about it.

    ``keys`` are unique and order the resumable reads; without them, and for views, reads are whole. For change
    tracking, ``version`` is captured before ``rows`` and ``changes`` are read.
    """

    namespace: str
    stream: str
    rows: DataFrame
    fields: Sequence[str]
    keys: Sequence[str] = ()
    view: bool = False
    full_refresh: bool = False
    cursor: str | None = None
    changes: DataFrame | None = None
    version: int | None = None
    min_valid_version: int | None = None


@dataclasses.dataclass(frozen=True)
class Collection:
    """A configured collection: its documents as JSON text, and its declared fields unless it is packed."""

    namespace: str
    stream: str
    documents: DataFrame
    fields: Mapping[str, str] | None = None
    full_refresh: bool = False


@dataclasses.dataclass(frozen=True)
class Store:
    """Where rows and states go."""

    spark: SparkSession
    out: str
    state: str

    def folder(self, namespace: str, stream: str) -> str:
        return f"{self.out}/{namespace}/{stream}"

    def write(self, namespace: str, stream: str, batch: int, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(f"{self.folder(namespace, stream)}/batch={batch}")

    def save(self, namespace: str, stream: str, batch: int, rows: DataFrame | None, **state: Any) -> None:
        if rows is not None:
            self.write(namespace, stream, batch, rows)
        self.note([{"namespace": namespace, "stream": stream, "batch": batch, **state}])

    def note(self, states: Sequence[Mapping[str, Any]]) -> None:
        with _APPENDING:
            append_state(self.spark, self.state, states)

    def tidy(self) -> None:
        """Keeps the state log short."""
        if sum(name.endswith(".parquet") for name in children(self.spark, self.state)) > STATE_FILES:
            with _APPENDING:
                compact_state(self.spark, self.state)

    def batches(self) -> dict[tuple[str, str], int]:
        """The next batch number of every stream that was saved before."""
        latest = read_state(self.spark, self.state).select("namespace", "stream", "batch").collect()
        return {(row["namespace"], row["stream"]): row["batch"] + 1 for row in latest}


def reset(store: Store, namespace: str, stream: str) -> None:
    """Forgets where a stream stopped: its next read starts over."""
    store.save(namespace, stream, store.batches().get((namespace, stream), 0), None, status=None)


def current_rows(store: Store, namespace: str, stream: str, keys: Sequence[str]) -> DataFrame:
    """The newest row of every key of a replicated table, deleted ones with their delete time."""
    rows = store.spark.read.option("mergeSchema", "true").parquet(store.folder(namespace, stream))
    order = ["batch", CURSOR] if CURSOR in rows.columns else ["batch"]
    return latest_per_key(rows, keys, order).drop("batch")


# -- tables ------------------------------------------------------------------------------------------------------

TRACKING_MODE = (
    "namespace string, stream string, is_view boolean, ordered_column string, primary_key array<string>, "
    "tracked boolean, object_known boolean, min_valid_version bigint, current_version bigint"
)
CURSOR_MODE = (
    "namespace string, stream string, is_view boolean, ordered_column string, full_refresh boolean, "
    "cursor_field string, columns array<string>, max_key array<string>, max_cursor string"
)


def plan_tables(store: Store, tables: Sequence[Table], tracking: bool, fail_expired: bool = False) -> DataFrame:
    """The next read of every table, one row each."""
    latest = read_state(store.spark, store.state)
    if tracking:
        known = [(*_name(t), list(t.keys), t.changes is not None, t.min_valid_version is not None) for t in tables]
        rows = [(*k, t.min_valid_version, t.version) for k, t in zip(known, tables)]
        return tracking_reads(with_state(store.spark.createDataFrame(rows, TRACKING_MODE), latest), fail_expired)
    rows = [(*_name(t), t.full_refresh, t.cursor, t.rows.columns, *_bounds(t)) for t in tables]
    streams = with_state(store.spark.createDataFrame(rows, CURSOR_MODE), latest)
    return cursor_reads(streams.withColumn("cursor_known", F.array_contains("columns", F.col("stored_cursor_field"))))


def _name(t: Table) -> tuple[str, str, bool, str | None]:
    return t.namespace, t.stream, t.view, t.keys[0] if t.keys else None


def _bounds(t: Table) -> tuple[list[str] | None, str | None]:
    """Largest key or cursor as stored text, whichever decides whether the table has anything new."""
    if t.full_refresh:
        top = ranges.max_key(t.rows, t.keys) if t.keys else None
        return top and [text(v) for v in top], None
    return None, text(increment.max_cursor(t.rows, t.cursor)) if t.cursor else None


def sync_tables(
    store: Store,
    tables: Sequence[Table],
    now: dt.datetime,
    tracking: bool = False,
    exclude_today: bool = False,
    pieces: int = 1,
    fail_expired: bool = False,
    at_once: int = AT_ONCE,
) -> list[Row]:
    """One run over all tables, ``at_once`` of them at a time; returns what was read.

    Each read is a Spark job over all of the cluster. ``pieces`` is the number of checkpoints per snapshot: each piece
    filters on the key, so ask for several only where the source can seek on it, as a database with an index or files
    sorted by the key can. The pieces of a table are read in order. A table that fails doesn't keep others from their end.
    """
    plan = plan_tables(store, tables, tracking, fail_expired).collect()
    found = {(row["namespace"], row["stream"]): row for row in plan}
    wrong = [row["stream"] for row in plan if row["read"] == "no_cursor"]
    if wrong:
        raise SyncError(f"no cursor chosen for {wrong}")
    batches = store.batches()

    def read(t: Table) -> None:
        row, batch = found[t.namespace, t.stream], batches.get((t.namespace, t.stream), 0)
        if row["read"] == "done":
            return
        run = _tracking_run(t, row, now, pieces) if tracking else _cursor_run(t, row, now, exclude_today, pieces)
        for number, (rows, state) in enumerate(run, batch):
            store.save(t.namespace, t.stream, number, rows, **state)

    _all(read, tables, at_once)
    store.tidy()
    return plan


def _all(work, streams: Sequence[Any], at_once: int) -> None:
    """Works on all streams, some at a time; fails with the first error when all have ended."""
    with ThreadPoolExecutor(at_once) as pool:
        for done in [pool.submit(work, stream) for stream in streams]:
            done.result()


Piece = tuple[DataFrame | None, dict[str, Any]]


def _typed(df: DataFrame, keys: Sequence[str], stored: Sequence[str] | None) -> ranges.Key | None:
    """A stored key with the types of its columns."""
    if stored is None:
        return None
    one = df.sparkSession.range(1).select(*[bound(df, k, v).alias(k) for k, v in zip(keys, stored)])
    return tuple(one.first())


def _pieces(t: Table, stored: Sequence[str] | None, pieces: int) -> Iterator[tuple[DataFrame, ranges.Key]]:
    """Key ranges of a resumable snapshot in order, up to the largest key at its start; none for no rows."""
    upper = ranges.max_key(t.rows, t.keys)
    lower = _typed(t.rows, t.keys, stored)
    if upper is None or lower == upper:
        return
    points = ranges.split_points(t.rows, t.keys, pieces) if pieces > 1 else []
    for low, high in ranges.split_ranges(points, lower, upper):
        yield snap.snapshot_range(t.rows, t.fields, t.keys, low, high).rows, high


def _cursor_run(t: Table, row: Row, now: dt.datetime, exclude_today: bool, pieces: int) -> Iterator[Piece]:
    limit = cutoff(t.rows, t.cursor, now) if exclude_today and t.cursor else None
    read = row["read"]
    if read == "whole":
        yield snap.snapshot(t.rows, t.fields).rows, {"status": "completed"}
    elif read == "keyed":
        for rows, high in _pieces(t, row["after_key"], pieces):
            yield rows, {"status": "checkpoint", "key_name": list(t.keys), "key": [text(v) for v in high]}
    elif read == "increment":
        got = increment.cursor_increment(t.rows, t.fields, t.cursor, row["after_cursor"], cutoff=limit)
        yield got.rows, {"status": "cursor", "cursor_field": t.cursor, "cursor": text(got.state["cursor"])}
    else:
        # A resumed snapshot keeps the cursor bound of its first start.
        resumed = row["after_key"] is not None
        upper = row["stored_cursor"] if resumed else increment.max_cursor(t.rows, t.cursor, limit)
        if upper is None:
            return  # nothing to read, and no state: the next run starts over
        done = {"status": "cursor", "cursor_field": t.cursor, "cursor": text(upper)}
        if read == "whole_cursor":
            yield snap.snapshot_with_cursor(t.rows, t.fields, t.cursor, cutoff=limit, upper=upper).rows, done
            return
        visible = dataclasses.replace(t, rows=snap.visible(t.rows, t.cursor, limit))
        for rows, high in _pieces(visible, row["after_key"], pieces):
            key = {"key_name": list(t.keys), "key": [text(v) for v in high]}
            yield rows, {**done, **key, "status": "checkpoint"}
        yield None, done


def _tracking_run(t: Table, row: Row, now: dt.datetime, pieces: int) -> Iterator[Piece]:
    version = row["next_version"]
    done = {"status": "tracking", "ct_version": version}
    unchanged = F.lit(None).cast("string").alias(DELETED_AT)
    if row["read"] == "changes":
        got = increment.change_increment(t.changes, t.rows, t.fields, t.keys, row["since_version"], version, now)
        yield got.rows, done
    elif row["read"] == "whole":
        yield snap.versioned_snapshot(t.rows, t.fields, version).rows.select("*", unchanged), done
    else:
        for rows, high in _pieces(t, row["after_key"], pieces):
            key = {"key_name": list(t.keys), "key": [text(v) for v in high]}
            yield rows.select("*", unchanged), {**done, **key, "status": "checkpoint"}
        yield None, done


# -- collections -------------------------------------------------------------------------------------------------

# The state row that holds the position in the change log, shared by all collections.
OFFSET = ("", "")

# Stored when the log was empty: everything that ever comes is after it.
START = (0, 0)


def sync_collections(
    store: Store,
    collections: Sequence[Collection],
    log: DataFrame,
    now: dt.datetime,
    fail_invalid: bool = True,
    chunk_rows: int | None = None,
    bounds: tuple[Any, Any] | None = None,
    at_once: int = AT_ONCE,
) -> str:
    """One run over all collections and their common change log; returns the order of its phases.

    ``bounds`` are the last and the first position of the log where they are known without reading it, as of a log in
    folders by day (``streaming.resume.log_bounds``). ``at_once`` collections are read and written at a time.

    Snapshots are taken in chunks of ``chunk_rows``, by default of about one GiB. Each chunk is a batch, with a state row
    that names its last id, after which the next run goes on if this one dies. The position of the log is stored before
    the first snapshot, so that changes made meanwhile are read by later runs.
    """
    spark = store.spark
    # The newest state of all streams, a row each.
    known = read_state(spark, store.state)
    rows = known.collect()
    latest = spark.createDataFrame(rows, known.schema)
    states = {(row["namespace"], row["stream"]): row for row in rows}
    batches = {name: row["batch"] + 1 for name, row in states.items()}
    offset = tuple(json.loads(states[OFFSET]["offset"])) if OFFSET in states else None
    # Both ends of the log before anything is read: events that come later belong to the next run.
    target, oldest = _ends(log) if bounds is None else bounds
    valid = offset is None or offset == START or (oldest is not None and oldest <= offset)
    if not valid and fail_invalid:
        raise SyncError("the change log no longer holds the stored position")

    names = [(c.namespace, c.stream, "full_refresh" if c.full_refresh else "incremental") for c in collections]
    streams = spark.createDataFrame(names, "namespace string, stream string, sync_mode string")
    selection = snapshot_selection(streams, latest, valid)
    chosen = {(row["namespace"], row["stream"]): row for row in selection.collect()}
    order = phases(selection).first()["phases"]
    first_run = offset is None or not valid
    kept = target or (offset if valid and offset else START)
    if first_run:
        store.save(*OFFSET, batches.get(OFFSET, 0), None, status="offset", offset=json.dumps(kept))
        batches[OFFSET] = batches.get(OFFSET, 0) + 1

    def snapshot(c: Collection) -> None:
        state = states.get((c.namespace, c.stream)) if valid and not c.full_refresh else None
        _snapshot(store, c, now, batches, state, chunk_rows)

    _all(snapshot, [c for c in collections if c.full_refresh], at_once)
    following = [c for c in collections if not c.full_refresh]
    for phase in order.split(", "):
        if phase == "snapshot":
            _all(snapshot, [c for c in following if chosen[c.namespace, c.stream]["snapshot"]], at_once)
        elif not first_run and target is not None:
            started = [c for c in following if chosen[c.namespace, c.stream]["started"]]
            _changes(store, started, log, offset, target, now, batches, states, at_once)
    if not first_run:
        store.save(*OFFSET, batches.get(OFFSET, 0), None, status="offset", offset=json.dumps(kept))
    store.tidy()
    return order


def _ends(log: DataFrame) -> tuple[tuple[int, int] | None, tuple[int, int] | None]:
    """The last and the first position of the log, by one pass over it."""
    at = events.with_position(log).agg(F.max("position").alias("last"), F.min("position").alias("first")).first()
    return tuple(tuple(at[end]) if at[end] is not None else None for end in ("last", "first"))


def _snapshot(
    store: Store, c: Collection, now: dt.datetime, batches: dict, state: Row | None, chunk_rows: int | None
) -> None:
    """Reads a collection, or the rest of it, in chunks; rows of full-refresh collections carry no change metadata."""
    census = id_type_census(c.documents, "document").collect()
    unsupported = sorted(str(row["id_type"]) for row in census if not row["supported"])
    if unsupported:
        raise SyncError(f"ids of {c.namespace}.{c.stream} are {unsupported}; supported are {list(ID_TYPES)}")
    if len(census) > 1:
        warnings.warn(f"ids of {c.namespace}.{c.stream} have several types")
    if chunk_rows is None:
        stats = c.documents.agg(F.count("*").alias("rows"), F.sum(F.octet_length("document")).alias("bytes"))
        chunk_rows = stats.select(chunk_size(F.col("rows"), F.col("bytes"))).first()[0]
    name, complete = (c.namespace, c.stream), "FULL_REFRESH" if c.full_refresh else "COMPLETE"
    resumed = state is not None and state["status"] == "IN_PROGRESS"
    after = state["key"][0] if resumed else None
    rows = events.document_rows(c.documents, c.fields)
    chunks = events.chunked_snapshot(rows, int(_utc(now).timestamp() * 1000), chunk_rows, after, not c.full_refresh)
    # Staged by chunk, so that writing a chunk reads nothing but itself.
    staged = f"{store.out}/_staged/{c.namespace}/{c.stream}"
    chunks.write.mode("overwrite").partitionBy("chunk").parquet(staged)
    read = store.spark.read.schema(chunks.schema).parquet(staged)
    # One row per chunk.
    found = read.groupBy("chunk").agg(F.max(DOCUMENT_ID).alias("last")).orderBy("chunk").collect()
    kind = census[0]["id_type"] if len(census) == 1 else None
    for place, row in enumerate(found, 1):
        status = complete if place == len(found) or c.full_refresh else "IN_PROGRESS"
        own = read.where(F.col("chunk") == row["chunk"]).drop("chunk")
        state = {"status": status, "key_name": [DOCUMENT_ID], "key": [row["last"]], "id_type": kind}
        store.save(*name, batches.get(name, 0), own, **state)
        batches[name] = batches.get(name, 0) + 1
    if resumed and not found:
        store.save(*name, batches[name], None, status=complete, key_name=[DOCUMENT_ID], key=[after], id_type=kind)
        batches[name] += 1
    remove(store.spark, staged)


def _changes(
    store: Store, started: Sequence[Collection], log: DataFrame, offset, target, now: dt.datetime, batches: dict, states: dict, at_once: int
) -> None:
    """Rows of all started collections; the log is read once and dealt out by collection.

    Events with an unknown operation are set aside in a folder of their own. The states of all collections are stored
    together when all rows are written; a collection that is still in its snapshot keeps its place there.
    """
    spark = store.spark
    names = spark.createDataFrame([(c.namespace, c.stream) for c in started], "namespace string, stream string")
    kept = events.include_streams(events.bounded(log, target, offset), names)
    kept = kept.select("key", "before", "after", "source", "op", "namespace", "stream")
    number = batches.get(OFFSET, 0)
    staged = f"{store.out}/_log/batch={number}"
    kept.write.mode("overwrite").partitionBy("namespace", "stream").parquet(staged)
    schema = f"{events.ENVELOPE}, namespace string, stream string"
    known, unknown = events.known_events(spark.read.schema(schema).parquet(staged))
    if not unknown.isEmpty():
        unknown.write.mode("overwrite").parquet(f"{store.out}/_unknown/batch={number}")
        warnings.warn(f"change events with unknown operations were set aside in {store.out}/_unknown/batch={number}")
    saved = []

    def change(c: Collection) -> None:
        name = (c.namespace, c.stream)
        own = known.where((F.col("namespace") == c.namespace) & (F.col("stream") == c.stream))
        rows = events.events_to_rows(own, c.fields)
        flat = rows.select("*", "position.seconds", "position.ord").drop("position")
        stamped = events.with_cursor(flat, ["seconds", "ord", DOCUMENT_ID], _utc(now)).drop("seconds", "ord")
        store.write(*name, batches.get(name, 0), stamped)
        before = states.get(name)
        place = {"status": "COMPLETE", "key_name": [DOCUMENT_ID]}
        if before is not None and before["status"] == "IN_PROGRESS":
            place = {"status": "IN_PROGRESS", "key_name": [DOCUMENT_ID], "key": before["key"], "id_type": before["id_type"]}
        saved.append({"namespace": c.namespace, "stream": c.stream, "batch": batches.get(name, 0), **place})
        batches[name] = batches.get(name, 0) + 1

    _all(change, started, at_once)
    if saved:
        store.note(saved)
    remove(store.spark, staged)


def _utc(moment: dt.datetime) -> dt.datetime:
    return moment if moment.tzinfo else moment.replace(tzinfo=dt.timezone.utc)
