"""Current-state tables in key buckets: applying changes rewrites the buckets that they touch, and no others."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.names import DELETED_AT
from tidemark.operators.merge import apply_last, latest_per_key
from tidemark.session import children, remove, settle

_MANIFEST = "schema string, buckets int, written array<struct<bucket: int, version: bigint>>"


@dataclass(frozen=True)
class BucketTable:
    """A stored table whose rows are dealt out by a hash of their keys.

    Folder ``data/version=<v>/bucket=<b>`` holds a bucket as version v left it; ``versions/<v>`` says for each bucket in
    which version it was written last. The latter is written after the data, and a version without it does not exist: a
    run that dies before leaves the table as it was, and its successor writes the same folders again.

    Choose ``buckets`` so that one holds some hundred megabytes; it is fixed when the table is created. One run at a time
    may write.
    """

    spark: SparkSession
    path: str
    keys: Sequence[str]
    buckets: int = 256

    def version(self) -> int | None:
        """The newest version, None for a table that was not created yet. Folders are listed, nothing is read."""
        found = [int(name) for name in children(self.spark, f"{self.path}/versions") if name.isdigit()]
        # A folder without its success mark is what a dying run left.
        done = (v for v in sorted(found, reverse=True) if "_SUCCESS" in children(self.spark, f"{self.path}/versions/{v}"))
        return next(done, None)

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, by default the newest one."""
        found = self._manifest(self._known(version))
        return self._rows(found, found["written"]).drop("bucket")

    def create(self, rows: DataFrame) -> int:
        """Writes the first version; keys must be unique."""
        if self.version() is not None:
            raise ValueError(f"{self.path} exists")
        schema = rows.schema.json()
        return self._commit(self._dealt(rows), 0, {"schema": schema, "buckets": self.buckets, "written": {}}, None)

    def apply(self, changes: DataFrame, order: Sequence[str], deleted: str = DELETED_AT, hard: bool = False) -> int:
        """Writes the next version, with the last change of every changed key, and returns its number.

        As with ``merge.apply_changes``, stored rows that are newer by ``order`` stay, so changes may come again or late.
        The numbers of the touched buckets reach the driver, at most as many as there are buckets.
        """
        current = self._known(None)
        found = self._manifest(current)
        last = settle(self._dealt(latest_per_key(changes, self.keys, order)))
        touched = sorted(row["bucket"] for row in last.select("bucket").distinct().collect())
        if not touched:
            return current
        held = {bucket: found["written"][bucket] for bucket in touched if bucket in found["written"]}
        base = self._rows(found, held)
        merged = apply_last(base, last, [*self.keys, "bucket"], order, deleted, hard)
        return self._commit(merged, current + 1, found, touched)

    def vacuum(self, keep: int = 1) -> None:
        """Removes what only versions before the newest ``keep`` ones need."""
        newest = self._known(None)
        first = max(0, newest - keep + 1)
        needed = {(b, v) for number in range(first, newest + 1) for b, v in self._manifest(number)["written"].items()}
        for name in children(self.spark, f"{self.path}/data"):
            version = int(name.removeprefix("version="))
            for part in children(self.spark, f"{self.path}/data/{name}"):
                if part.startswith("bucket=") and version <= newest and (int(part.removeprefix("bucket=")), version) not in needed:
                    remove(self.spark, f"{self.path}/data/{name}/{part}")
        for number in range(first):
            remove(self.spark, f"{self.path}/versions/{number}")

    def _known(self, version: int | None) -> int:
        newest = self.version()
        if newest is None or (version is not None and version > newest):
            raise ValueError(f"{self.path} has no version {'' if version is None else version}".rstrip())
        return newest if version is None else version

    def _dealt(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("bucket", bucket_of(self.keys, self.buckets))

    def _manifest(self, version: int) -> dict:
        """What a version says: the schema, the number of buckets, and in which version each was written last."""
        row = self.spark.read.schema(_MANIFEST).json(f"{self.path}/versions/{version}").first()
        return {"schema": row["schema"], "buckets": row["buckets"], "written": {b: v for b, v in row["written"]}}

    def _rows(self, found: dict, written: dict[int, int]) -> DataFrame:
        """The rows of some buckets, with their number."""
        schema = T.StructType.fromJson(json.loads(found["schema"])).add("bucket", T.IntegerType())
        if found["buckets"] != self.buckets:
            raise ValueError(f"{self.path} has {found['buckets']} buckets")
        if not written:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.path}/data/version={v}/bucket={b}" for b, v in written.items()]
        reader = self.spark.read.schema(schema).option("basePath", f"{self.path}/data")
        return reader.parquet(*paths).select(*schema.names)

    def _commit(self, rows: DataFrame, version: int, before: dict, touched: Sequence[int] | None) -> int:
        folder = f"{self.path}/data/version={version}"
        # Rows of a bucket meet in few files; adaptive execution cuts large buckets and merges small ones.
        rows.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(folder)
        names = (name for name in children(self.spark, folder) if name.startswith("bucket="))
        written = {b: v for b, v in before["written"].items() if touched is not None and b not in touched}
        written |= {int(name.removeprefix("bucket=")): version for name in names}
        row = self.spark.createDataFrame([(before["schema"], self.buckets, sorted(written.items()))], _MANIFEST)
        row.coalesce(1).write.mode("overwrite").json(f"{self.path}/versions/{version}")
        return version


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
