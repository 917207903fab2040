"""Logs, documents and metadata that the operators read, derived by Spark from all rows of the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import spread

# Epoch milliseconds of a time without zone, independent of the session's zone.
MS = (
    "unix_date(cast(ts as date)) * 86400000L + hour(ts) * 3600000L + minute(ts) * 60000L"
    " + cast(floor(extract(second from ts) * 1000) as bigint)"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# -- change table over orders ------------------------------------------------------------------------------------


def order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item is a change of its order: version from the ship date, operation from the return flag."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey as o_orderkey",
        "cast(datediff(l_shipdate, date'1995-01-01') as bigint) as sys_change_version",
        "case l_returnflag when 'R' then 'd' when 'A' then 'U' else 'I' end as sys_change_operation",
    )


def current_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders table now: finished orders were purged."""
    return table(spark, sf_dir, "orders").where("o_orderstatus <> 'F'")


# -- change events over events -----------------------------------------------------------------------------------

USER_DOC = (
    """concat('{"_id":{"$oid":"', lpad(lower(hex(user_id)), 24, '0'), '"},"user":{"$numberLong":"', user_id,"""
    """ '"},"value":', value, ',"kind":"', event_type, '","props":', props, ',"extra":"x"}')"""
)
USER_FIELDS = {"_id": "string", "user": "integer", "value": "number", "kind": "string", "props": "object"}


def envelopes(events: DataFrame) -> DataFrame:
    """Events as change events of user documents; works on batches and streams.

    Signups create, errors delete, all else updates. Some updates lost both images, some deletes have one.
    """
    known = events.selectExpr(
        "*",
        "get_json_object(props, '$.k') as k",
        "case event_type when 'signup' then 'c' when 'error' then 'd' else 'u' end as op",
        f"{USER_DOC} as doc",
        f"{MS} as ms",
    )
    return known.selectExpr(
        "event_id",
        """concat('{"$oid":"', lpad(lower(hex(user_id)), 24, '0'), '"}') as key""",
        "case when op = 'd' and k >= 50 then doc end as before",
        "case when op <> 'd' and not (event_type = 'view' and k < 10) then doc end as after",
        "named_struct('db', 'app', 'collection', concat('nation_', user_id % 25), 'ts_ms', ms,"
        " 'ord', cast(event_id % 4 + 1 as int), 'snapshot', 'false') as source",
        "op",
    )


def change_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelopes(spread(table(spark, sf_dir, "events")))


def streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Configured streams: the collections of all regions but one."""
    return table(spark, sf_dir, "nation").where("n_regionkey <> 3").selectExpr(
        "'app' as namespace", "lower(n_name) as stream"
    )


def stream_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared fields of the streams, which differ by region; those of two regions declare none."""
    kinds = [
        {"_id": "string", "user": "integer"},
        {"_id": "string", "value": "number", "kind": "array"},
        {"value": "number", "props": "object", "kind": "string", "missing": "string"},
    ]
    lists = [", ".join(f"struct('{name}' as field, '{kind}' as type)" for name, kind in fields.items()) for fields in kinds]
    cases = " ".join(f"when {region} then array({fields})" for region, fields in enumerate(lists))
    return table(spark, sf_dir, "nation").selectExpr("'app' as namespace", "lower(n_name) as stream", f"inline(case n_regionkey {cases} end)")


def user_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current user documents; those of one market segment are gone."""
    return table(spark, sf_dir, "customer").where("c_mktsegment <> 'BUILDING'").selectExpr(
        """concat('{"$oid":"', lpad(lower(hex(c_custkey)), 24, '0'), '"}') as key""",
        """concat('{"_id":{"$oid":"', lpad(lower(hex(c_custkey)), 24, '0'), '"},"user":{"$numberLong":"', c_custkey,
           '"},"value":', c_acctbal, ',"kind":"now","props":{"segment":"', c_mktsegment, '"}}') as document""",
    )


def user_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replicated users before the changes."""
    return table(spark, sf_dir, "customer").selectExpr(
        "lpad(lower(hex(c_custkey)), 24, '0') as _id",
        "c_custkey as user",
        "c_acctbal as value",
        "'base' as kind",
        "cast(null as string) as _ab_cdc_updated_at",
        "cast(null as string) as _ab_cdc_deleted_at",
    )


# -- documents over events ---------------------------------------------------------------------------------------

DOCUMENT = (
    """concat('{"_id":{"$oid":"', lpad(lower(hex(event_id)), 24, '0'), '"},"user":{"$numberLong":"', user_id,"""
    """ '"},"at":{"$date":', ms, '},"clock":{"$timestamp":{"t":', shiftright(ms, 32), ',"i":', ms & 4294967295L,"""
    """ '}},"price":{"$numberDecimal":"', value, '"},"tags":',"""
    """ case when event_type in ('click', 'view') then concat('["', event_type, '"]') else concat('"', event_type, '"') end,"""
    """ ',"more":{"seen":{"$date":', ms, '},"list":[{"$numberLong":"', user_id, '"}]},"props":', props, '}')"""
)
DOCUMENT_FIELDS = {
    "_id": "string",
    "user": "integer",
    "at": "string",
    "clock": "string",
    "price": "number",
    "tags": "array",
    "more": "object",
    "props": "object",
}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed = spread(table(spark, sf_dir, "events")).selectExpr("*", f"{MS} as ms")
    return timed.selectExpr("event_id", "event_type", f"{DOCUMENT} as document")


# One value of each rarer type, by the name of its field.
VALUES = {
    "day": """concat('{"$date":', ms, '}')""",
    "far": """'{"$date":{"$numberLong":"253402300800000"}}'""",
    "bytes": """concat('{"$binary":{"base64":"', base64(cast(event_type as binary)), '","subType":"00"}}')""",
    "uuid": """concat('{"$uuid":"00000000-0000-0000-0000-', lpad(lower(hex(event_id)), 12, '0'), '"}')""",
    "pattern": """concat('{"$regularExpression":{"pattern":"^', event_type, '","options":"i"}}')""",
    "symbol": """concat('{"$symbol":"', event_type, '"}')""",
    "code": """concat('{"$code":"f(', event_id, ')"}')""",
    "scoped": """concat('{"$code":"g()","$scope":{"scope":1,"id":{"$numberLong":"', event_id, '"}}}')""",
    "low": """'{"$minKey":1}'""",
    "high": """'{"$maxKey":1}'""",
    "unset": """'{"$undefined":true}'""",
    "whole": """concat('{"$numberInt":"', event_id, '"}')""",
    "cut": """concat('{"$numberDouble":"', event_id, '.75"}')""",
    "exact": """concat('{"$numberDecimal":"', event_id, '.75"}')""",
    "truth": "string(event_id % 2 = 0)",
    "none": "'null'",
    "inside": """concat('{"at":{"$date":', ms, '},"n":{"$numberInt":"5"},"gone":{"$minKey":1}}')""",
    "list": """concat('[{"$date":', ms, '},{"$symbol":"s"},{"$maxKey":1}]')""",
}
VALUE_FIELDS = {
    **{name: "string" for name in ("day", "far", "bytes", "uuid", "pattern", "symbol", "code", "low", "high", "unset", "none")},
    "scoped": "object",
    "whole": "integer",
    "cut": "integer",
    "exact": "number",
    "truth": "boolean",
    "inside": "object",
    "list": "array",
}


def value_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a value of every type."""
    timed = spread(table(spark, sf_dir, "events")).selectExpr("*", f"{MS} as ms")
    fields = ", ',', ".join(f"""'"{name}":', {value}""" for name, value in VALUES.items())
    return timed.selectExpr("event_id", f"concat('{{', {fields}, '}}') as document")


def id_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose ids differ in type from one event type to the next, and within one of them."""
    hexed = "lpad(lower(hex(event_id)), 24, '0')"
    return table(spark, sf_dir, "events").selectExpr(
        "event_type",
        f"""concat('{{"_id":', case event_type
              when 'signup' then concat('{{"$oid":"', {hexed}, '"}}')
              when 'click' then concat('{{"$numberLong":"', event_id, '"}}')
              when 'view' then concat('"', {hexed}, '"')
              when 'purchase' then concat('{{"$date":', event_id, '}}')
              else if(value < 30, cast(event_id as string), '{{"$binary":{{"base64":"AQIDBA==","subType":"00"}}}}') end,
            ',"value":', value, '}}') as document""",
    )


# -- metadata over customer --------------------------------------------------------------------------------------

# (name, type name, type code, precision, scale): one column per kind of type.
COLUMN_KINDS = [
    ("id", "bigint", "BIGINT", 19, 0),
    ("amount", "decimal", "DECIMAL", 18, 4),
    ("price", "money", "DECIMAL", 19, 4),
    ("ratio", "real", "REAL", 24, None),
    ("wide", "float", "REAL", 53, None),
    ("title", "nvarchar", "NVARCHAR", 200, None),
    ("born", "date", "DATE", 10, None),
    ("seen", "datetime2", "TIMESTAMP", 27, 7),
    ("zoned", "datetimeoffset", "OTHER", 34, 7),
    ("clock", "time", "TIME", 16, 7),
    ("blob", "varbinary", "VARBINARY", 8000, None),
    ("shape", "geometry", "VARBINARY", None, None),
    ("node", "hierarchyid", "VARBINARY", 892, None),
    ("flag", "bit", "BIT", 1, None),
    ("odd", "sql_variant", "OTHER", 0, None),
]


def meta_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table or view per customer, in namespaces by market segment."""
    return table(spark, sf_dir, "customer").selectExpr(
        "case c_mktsegment when 'MACHINERY' then 'sys' when 'BUILDING' then 'dbo' when 'AUTOMOBILE' then 'DBO'"
        " else lower(c_mktsegment) end as namespace",
        "c_name as `table`",
        "case when c_nationkey < 3 then 'view' when c_nationkey < 6 then 'VIEW' when c_nationkey < 24 then 'TABLE' end as type",
        "c_nationkey",
        "c_acctbal",
    )


def meta_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All kinds of columns for every table, a pseudo-column, and one name that comes twice."""

    def entry(ordinal, name, type_name, code, precision, scale):
        parts = [ordinal, f"'{name}'", f"'{type_name}'", f"'{code}'", precision, scale]
        shown = ["cast(null as int)" if p is None else str(p) for p in parts]
        return "named_struct('ordinal', {}, 'column', {}, 'type_name', {}, 'type_code', {}, 'precision', {}, 'scale', {})".format(
            *shown
        )

    rows = [entry(i + 1, *kind) for i, kind in enumerate(COLUMN_KINDS)]
    rows += [entry(None, "rowguid", "nvarchar", "NVARCHAR", 36, None), entry(99, "rowguid", "int", "INTEGER", 10, 0)]
    return meta_tables(spark, sf_dir).selectExpr("namespace", "`table`", f"inline(array({', '.join(rows)}))")


def key_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key columns: one or two per table by nation; some tables also have a key without positions."""
    return meta_tables(spark, sf_dir).selectExpr(
        "namespace",
        "`table`",
        """inline(concat(
             case when c_nationkey < 8 then array(named_struct('constraint', concat('pk_', `table`), 'position', 1, 'column', 'id'))
                  when c_nationkey < 16 then array(
                    named_struct('constraint', concat('pk_', `table`), 'position', 2, 'column', 'amount'),
                    named_struct('constraint', concat('pk_', `table`), 'position', 1, 'column', 'title'))
                  else array() end,
             case when c_acctbal < 3000 then array(
                    named_struct('constraint', concat('a_', `table`), 'position', cast(null as int), 'column', 'born'))
                  else array() end))""",
    )


def key_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of one nation are only unique, not primary."""
    usage = key_usage(spark, sf_dir).select("namespace", "table", "constraint").distinct()
    nation = meta_tables(spark, sf_dir).select("namespace", "table", "c_nationkey")
    return usage.join(nation, ["namespace", "table"]).selectExpr(
        "namespace", "constraint", "if(c_nationkey = 7, 'UNIQUE', 'PRIMARY KEY') as constraint_type"
    )


def logical_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys declared by the user, for tables with a high balance."""
    return meta_tables(spark, sf_dir).where("c_acctbal > 5000").selectExpr(
        "namespace", "`table`", "array('title', 'id') as primary_key"
    )


def system_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The five system tables behind clustered indexes; each table has up to two indexes."""
    own = meta_tables(spark, sf_dir).selectExpr("*", "cast(substr(`table`, 10) as bigint) as object_id")
    schemas = own.selectExpr("abs(xxhash64(namespace)) as schema_id", "namespace as name").distinct()
    index = own.selectExpr(
        "object_id",
        "c_nationkey",
        """inline(array(
             named_struct('index_id', 1, 'name', 'ix_main', 'type', if(c_nationkey < 20, 1, 2), 'is_unique', c_nationkey > 2),
             named_struct('index_id', 2, 'name', 'ix_side', 'type', 2, 'is_unique', true)))""",
    )
    parts = index.selectExpr(
        "object_id",
        "index_id",
        """inline(array(
             named_struct('column_id', 1, 'key_ordinal', 1, 'is_included_column', false),
             named_struct('column_id', 2, 'key_ordinal', 2, 'is_included_column', c_nationkey < 10)))""",
    )
    columns = own.selectExpr(
        "object_id", "inline(array(named_struct('column_id', 1, 'name', 'born'), named_struct('column_id', 2, 'name', 'id')))"
    )
    return {
        "schemas": schemas,
        "tables": own.selectExpr("abs(xxhash64(namespace)) as schema_id", "object_id", "`table` as name"),
        "indexes": index.drop("c_nationkey"),
        "index_columns": parts,
        "columns": columns,
    }


def collection_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One collection or view per part, some of them the database's own."""
    return table(spark, sf_dir, "part").selectExpr(
        "concat(case p_type when 'ECONOMY' then 'system.' when 'PROMO' then 'oplog.' else '' end, 'c', p_partkey) as name",
        "if(p_size > 40, 'view', 'collection') as type",
    )


# -- stream settings and states over customer --------------------------------------------------------------------


def tracked_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stream per customer for the change-tracking decisions; every rule is met."""
    return table(spark, sf_dir, "customer").selectExpr(
        "'app' as namespace",
        "c_name as stream",
        "c_custkey % 17 = 0 as is_view",
        "case when c_custkey % 4 = 1 or c_custkey % 3 > 0 then 'id' end as ordered_column",
        "slice(array('id', 'part'), 1, cast(c_custkey % 3 as int)) as primary_key",
        "c_custkey % 5 <> 0 as tracked",
        "c_custkey % 23 <> 0 as object_known",
        "10L as min_valid_version",
        "60L as current_version",
        "case when c_custkey % 7 = 0 then 'none' when c_custkey % 13 = 0 then 'null'"
        " when c_custkey % 19 = 0 then 'bad' else 'ok' end as state",
        "case when c_custkey % 8 = 1 then 60 else c_custkey % 70 end as stored_version",
        "case when c_custkey % 11 = 0 then 'id' end as stored_key_name",
        "case when c_custkey % 11 = 0 then cast(c_custkey as string) end as stored_key",
    )


def cursor_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stream per customer for the cursor decisions; every rule is met."""
    return table(spark, sf_dir, "customer").selectExpr(
        "'app' as namespace",
        "c_name as stream",
        "c_custkey % 17 = 0 as is_view",
        "case when c_custkey % 4 = 1 or c_custkey % 3 > 0 then 'id' end as ordered_column",
        "c_custkey % 2 = 0 as full_refresh",
        "case when c_custkey % 31 <> 0 then 'changed' end as cursor_field",
        "c_custkey % 29 <> 0 as cursor_known",
        "case when c_custkey % 7 = 0 then 'none' when c_custkey % 13 = 0 then 'null' else 'ok' end as state",
        "c_custkey % 9 = 0 as completed",
        "case when c_custkey % 11 = 0 then 'id' end as stored_key_name",
        "case when c_custkey % 11 = 0 then c_custkey % 19 end as stored_key",
        "3L as max_key",
        "case when c_custkey % 23 <> 0 then 'changed' end as stored_cursor_field",
        "c_custkey % 19 as stored_cursor",
        "3L as max_cursor",
    )


def collection_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_mktsegment as namespace",
        "c_name as stream",
        "if(c_nationkey < 20, 'incremental', 'full_refresh') as sync_mode",
    )


def collection_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored states of the streams that have a positive balance."""
    return table(spark, sf_dir, "customer").where("c_acctbal > 2500").selectExpr(
        "c_mktsegment as namespace",
        "c_name as stream",
        "if(c_acctbal > 6000, 'COMPLETE', 'IN_PROGRESS') as status",
    )


def state_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A state row per event: each user is a stream whose progress was saved again and again."""
    return table(spark, sf_dir, "events").selectExpr(
        "'app' as namespace",
        "cast(user_id as string) as stream",
        "event_id as batch",
        "ts as saved_at",
        "event_type as status",
        "cast(value as string) as cursor",
        "case when event_type = 'click' then false end as schema_enforced",
    )
