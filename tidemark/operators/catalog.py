"""Table and collection discovery over metadata DataFrames (one row per table, column or index column)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.names import (
    CHUNK_BYTES,
    CHUNK_ROWS,
    CURSOR,
    DELETED_AT,
    DOCUMENT_ID,
    PACKED,
    SYSTEM_COLLECTIONS,
    SYSTEM_SCHEMAS,
    UPDATED_AT,
)

TABLE = ["namespace", "table"]

# Source type name (upper case) -> logical type. Names win over type codes.
NAMED_TYPES = {
    "VARBINARY": "binary",
    "BINARY": "binary",
    "DATETIME": "timestamp",
    "DATETIME2": "timestamp",
    "SMALLDATETIME": "timestamp",
    "DATE": "date",
    "DATETIMEOFFSET": "timestamptz",
    "TIME": "time",
    "GEOMETRY": "geometry",
    "GEOGRAPHY": "geography",
    "MONEY": "double",
    "SMALLMONEY": "double",
    "HIERARCHYID": "hierarchy",
}

# Type code name -> logical type; REAL depends on its precision, unlisted codes are opaque.
CODED_TYPES = {
    "BIT": "boolean",
    "BOOLEAN": "boolean",
    "TINYINT": "short",
    "SMALLINT": "short",
    "INTEGER": "int",
    "BIGINT": "long",
    "FLOAT": "float",
    "DOUBLE": "double",
    "NUMERIC": "decimal",
    "DECIMAL": "decimal",
    "CHAR": "string",
    "VARCHAR": "string",
    "LONGVARCHAR": "string",
    "NCHAR": "string",
    "NVARCHAR": "string",
    "LONGNVARCHAR": "string",
    "DATE": "date",
    "TIME": "time",
    "TIMESTAMP": "timestamp",
    "BINARY": "binary",
    "VARBINARY": "binary",
    "LONGVARBINARY": "binary",
    "BLOB": "binary",
    "CLOB": "clob",
    "NCLOB": "clob",
    "TIME_WITH_TIMEZONE": "timetz",
    "TIMESTAMP_WITH_TIMEZONE": "timestamptz",
    "NULL": "null",
    "SQLXML": "xml",
}

# Below this precision a REAL has four bytes.
REAL_PRECISION = 25

# Logical type -> Spark type; logical types that are not listed are read as text.
SPARK_TYPES = {
    "boolean": "boolean",
    "short": "smallint",
    "int": "int",
    "long": "bigint",
    "float": "float",
    "double": "double",
    "date": "date",
    "timestamp": "timestamp_ntz",
    "timestamptz": "timestamp",
    "binary": "binary",
    "null": "void",
}


def _map(entries: dict[str, str]) -> Column:
    return F.expr("map(" + ", ".join(f"'{key}', '{value}'" for key, value in entries.items()) + ")")


def list_tables(tables: DataFrame, namespaces: Sequence[str] = ()) -> DataFrame:
    """Tables and views of the named namespaces, each also in upper case; without names, of all but system ones."""
    if namespaces:
        wanted = sorted({*namespaces, *(name.upper() for name in namespaces)})
        kept = tables.where(F.col("namespace").isin(wanted))
    else:
        kept = tables.where(~F.col("namespace").isin(*SYSTEM_SCHEMAS))
    kind = F.coalesce("type", F.lit(""))
    return kept.select(*TABLE, kind.alias("type"), (F.upper(kind) == "VIEW").alias("is_view")).dropDuplicates()


def list_columns(columns: DataFrame, tables: DataFrame) -> DataFrame:
    """Columns of known tables, once per name; pseudo-columns (no ordinal) come before all others."""
    details = [c for c in columns.columns if c not in (*TABLE, "column", "ordinal")]
    # Nulls are the smallest, so the pseudo-column wins over a column of the same name.
    first = F.min(F.struct("ordinal", *details)).alias("_first")
    known = columns.join(tables.select(*TABLE).distinct(), TABLE, "left_semi")
    return known.groupBy(*TABLE, "column").agg(first).select(*TABLE, "column", "_first.*")


def primary_keys(
    key_usage: DataFrame, constraints: DataFrame, tables: DataFrame, namespaces: Sequence[str] = ()
) -> DataFrame:
    """Primary key columns per known table in position order, of its first complete constraint by name."""
    if namespaces:
        key_usage = key_usage.where(F.col("namespace").isin(*namespaces))
    primary = constraints.where(F.col("constraint_type") == "PRIMARY KEY").select("namespace", "constraint")
    rows = key_usage.join(primary, ["namespace", "constraint"])
    return _first_complete(rows, tables, "constraint", "position", "primary_key")


def clustered_keys(
    schemas: DataFrame,
    tables: DataFrame,
    indexes: DataFrame,
    index_columns: DataFrame,
    columns: DataFrame,
    known: DataFrame,
    namespaces: Sequence[str] = (),
) -> DataFrame:
    """Key columns of the unique clustered index per known table, from the five system tables."""
    schema = schemas.select("schema_id", F.col("name").alias("namespace"))
    if namespaces:
        schema = schema.where(F.col("namespace").isin(*namespaces))
    table = tables.select("schema_id", "object_id", F.col("name").alias("table"))
    index = indexes.where((F.col("type") == 1) & F.col("is_unique")).select(
        "object_id", "index_id", F.col("name").alias("index")
    )
    part = index_columns.where(~F.col("is_included_column")).select("object_id", "index_id", "column_id", "key_ordinal")
    column = columns.select("object_id", "column_id", F.col("name").alias("column"))
    rows = (
        table.join(schema, "schema_id")
        .join(index, "object_id")
        .join(part, ["object_id", "index_id"])
        .join(column, ["object_id", "column_id"])
    )
    return _first_complete(rows, known, "index", "key_ordinal", "clustered_key")


def _first_complete(rows: DataFrame, tables: DataFrame, group: str, position: str, name: str) -> DataFrame:
    """Ordered column names of the first group by name whose rows all have a position and a column.

    The database allows a few dozen columns per key, so the collected lists are short.
    """
    complete = F.bool_and(F.col(position).isNotNull() & F.col("column").isNotNull())
    ordered = F.transform(F.sort_array(F.collect_list(F.struct(position, "column"))), lambda pair: pair["column"])
    groups = rows.groupBy(*TABLE, group).agg(complete.alias("_complete"), ordered.alias(name)).where("_complete")
    best = groups.groupBy(*TABLE).agg(F.min_by(name, group).alias(name))
    return best.join(tables.select(*TABLE).distinct(), TABLE, "left_semi")


def effective_keys(tables: DataFrame, physical: DataFrame, logical: DataFrame, clustered: DataFrame) -> DataFrame:
    """Key choice per table.

    The primary key is the physical one, else the one the user declared, else none. The ordered column for
    resumable reads is that of a one-column clustered index, else the first primary key column, else none.
    """
    joined = (
        tables.select(*TABLE)
        .distinct()
        .join(physical.select(*TABLE, F.col("primary_key").alias("_physical")), TABLE, "left")
        .join(logical.select(*TABLE, F.col("primary_key").alias("_logical")), TABLE, "left")
        .join(clustered.select(*TABLE, "clustered_key"), TABLE, "left")
    )
    some = {c: F.when(F.size(c) > 0, F.col(c)) for c in ("_physical", "_logical")}
    chosen = F.coalesce(some["_physical"], some["_logical"])
    lone = F.when(F.size("clustered_key") == 1, F.element_at("clustered_key", 1))
    return joined.select(*TABLE, chosen.alias("primary_key"), lone.alias("_lone")).select(
        *TABLE, "primary_key", F.coalesce("_lone", F.element_at("primary_key", 1)).alias("ordered_column")
    )


def logical_type(type_name: Column, code: Column, precision: Column) -> Column:
    real = F.when(precision < REAL_PRECISION, F.lit("float")).otherwise(F.lit("double"))
    by_code = F.when(code == "REAL", real).otherwise(_map(CODED_TYPES)[code])
    return F.coalesce(_map(NAMED_TYPES)[F.upper(type_name)], by_code, F.lit("opaque"))


def map_types(columns: DataFrame) -> DataFrame:
    """Adds logical and Spark types to columns given by type name, code name, precision and scale."""
    logical = logical_type(F.col("type_name"), F.col("type_code"), F.col("precision"))
    decimal = F.concat(
        F.lit("decimal("), F.coalesce("precision", F.lit(38)), F.lit(","), F.coalesce("scale", F.lit(0)), F.lit(")")
    )
    spark = F.when(F.col("logical_type") == "decimal", decimal).otherwise(
        F.coalesce(_map(SPARK_TYPES)[F.col("logical_type")], F.lit("string"))
    )
    return columns.withColumn("logical_type", logical).withColumn("spark_type", spark)


def table_schema(typed_columns: DataFrame, namespace: str, table: str) -> T.StructType:
    """Read schema of one table, as wide as the table itself."""
    one = typed_columns.where((F.col("namespace") == namespace) & (F.col("table") == table))
    rows = one.orderBy(F.asc_nulls_first("ordinal")).select("column", "spark_type").collect()
    return T.StructType([T.StructField(row["column"], T.DataType.fromDDL(row["spark_type"])) for row in rows])


def build_catalog(tables: DataFrame, keys: DataFrame, change_tracking: bool) -> DataFrame:
    """What each table offers: tables with a key also incremental and resumable reads.

    With change tracking, such tables get the soft-delete column, and no cursor has to be chosen for them.
    """
    has_key = F.col("primary_key").isNotNull()
    tracked = has_key & F.lit(change_tracking)
    modes = F.when(has_key, F.array(F.lit("full_refresh"), F.lit("incremental"))).otherwise(F.array(F.lit("full_refresh")))
    return tables.select(*TABLE).distinct().join(keys.select(*TABLE, "primary_key"), TABLE, "left").select(
        *TABLE,
        modes.alias("sync_modes"),
        F.coalesce("primary_key", F.array().cast("array<string>")).alias("primary_key"),
        has_key.alias("resumable"),
        tracked.alias("source_cursor"),
        F.when(tracked, F.array(F.lit(DELETED_AT))).otherwise(F.array().cast("array<string>")).alias("added_columns"),
    )


def list_collections(collections: DataFrame, kinds: Sequence[str] = ("collection",)) -> DataFrame:
    """Collections that are not the database's own, of the given kinds (all kinds when empty)."""
    own = F.lit(False)
    for prefix in SYSTEM_COLLECTIONS:
        own = own | F.col("name").startswith(prefix)
    kept = collections.where(~own)
    return kept.where(F.col("type").isin(*kinds)) if kinds else kept


# Columns every document stream gets besides its own fields.
METADATA_FIELDS = {UPDATED_AT: "string", DELETED_AT: "string", CURSOR: "integer"}


def build_document_catalog(fields: DataFrame, by: Sequence[str], packed: bool = False) -> DataFrame:
    """One row per collection: its columns with types, both sync modes, ``_id`` as key and the default cursor.

    Packed collections keep only ``_id`` of the found fields and get the column with the whole document. One
    row of the result holds the columns of one collection, so lists are as long as its schema is wide.
    """
    added = {**({PACKED: "object"} if packed else {}), **METADATA_FIELDS}
    kept = fields.where(F.col("field") == DOCUMENT_ID) if packed else fields
    own = F.sort_array(F.collect_list(F.struct("field", "type")))
    constant = F.array(*[F.struct(F.lit(k).alias("field"), F.lit(v).alias("type")) for k, v in added.items()])
    return kept.groupBy(*by).agg(own.alias("_own")).select(
        *by,
        F.concat("_own", constant).alias("fields"),
        F.array(F.lit("full_refresh"), F.lit("incremental")).alias("sync_modes"),
        F.array(F.lit(DOCUMENT_ID)).alias("primary_key"),
        F.lit(CURSOR).alias("cursor_field"),
        F.lit(True).alias("source_cursor"),
        F.lit(True).alias("resumable"),
    )


def collection_stats(df: DataFrame, content: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows and bytes per collection, counted inside map tasks first; a collection without rows has none."""
    size = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in content), F.lit(0)).cast("bigint")
    return df.groupBy(*by).agg(F.count("*").alias("rows"), F.sum(size).alias("bytes"))


def chunk_rows(rows: Column, size: Column) -> Column:
    """Rows per chunk of about one GiB; the default where sizes are unknown, zero or below one byte per row."""
    target, default = F.lit(CHUNK_BYTES).cast("bigint"), F.lit(CHUNK_ROWS).cast("bigint")
    per_row = F.call_function("div", size.cast("bigint"), F.nullif(rows.cast("bigint"), F.lit(0).cast("bigint")))
    chunk = F.call_function("div", target, F.nullif(per_row, F.lit(0).cast("bigint")))
    return F.when(chunk > 0, chunk).otherwise(default)


def estimate(stats: DataFrame, factor: float = 1.0) -> DataFrame:
    """Expected rows and bytes of a snapshot, the bytes scaled by how much the output form grows."""
    return stats.withColumns({"estimated_rows": F.col("rows"), "estimated_bytes": (F.col("bytes") * factor).cast("bigint")})


def spark_tables(spark: SparkSession, database: str) -> DataFrame:
    """Tables of a Spark database in the form :func:`list_tables` reads."""
    rows = [(t.namespace[0] if t.namespace else "", t.name, t.tableType) for t in spark.catalog.listTables(database)]
    return spark.createDataFrame(rows, "namespace string, `table` string, type string")
