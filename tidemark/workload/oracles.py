"""The SQL that each query is checked against, over the same tables."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

DAY = "strftime({0}, '%Y-%m-%dT%H:%M:%S.%f')"
ORDER_DAY = DAY.format("o_orderdate") + " AS o_orderdate"
ORDER_FIELDS = f"o_orderkey, o_custkey, o_orderstatus, o_totalprice, {ORDER_DAY}"
HEX = "lpad(lower(to_hex({0})), 24, '0')"
SECONDS = "strftime(make_timestamp(CAST({0} AS BIGINT) * 1000), '%Y-%m-%dT%H:%M:%S')"
MILLIS = "lpad(CAST({0} % 1000 AS VARCHAR), 3, '0')"
ISO_MILLIS = f"{SECONDS} || '.' || {MILLIS} || 'Z'"
ISO_INSTANT = f"{SECONDS} || CASE WHEN {{0}} % 1000 = 0 THEN '' ELSE '.' || {MILLIS} END || 'Z'"

# -- ranges ------------------------------------------------------------------------------------------------------

ORACLES["keyset_range"] = """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey > 10 OR (l_orderkey = 10 AND l_linenumber > 2)"""

ORACLES["snapshot_full"] = f"SELECT {ORDER_FIELDS} FROM orders"

ORACLES["snapshot_resume"] = "SELECT o_custkey, o_totalprice, o_orderkey FROM orders WHERE o_orderkey > 100"

ORACLES["split_cover"] = """
SELECT count(*) AS n_rows, CAST(sum(o_orderkey) AS BIGINT) AS key_sum, min(o_orderkey) AS first_key,
       max(o_orderkey) AS last_key, TRUE AS same_numbers
FROM orders"""

ORACLES["split_sketch"] = """
SELECT count(*) AS n_rows, CAST(sum(o_orderkey) AS BIGINT) AS key_sum, 8 AS n_ranges, TRUE AS same_numbers, TRUE AS even
FROM orders"""

CHUNKS = """
SELECT o_orderkey, o_totalprice, (row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 AS chunk
FROM orders WHERE o_orderkey > 100"""

ORACLES["chunk_scan"] = CHUNKS

ORACLES["checkpoints"] = f"""
SELECT chunk, count(*) AS n_rows, max(o_orderkey) AS last_key,
       CASE WHEN chunk = max(chunk) OVER () THEN 'COMPLETE' ELSE 'IN_PROGRESS' END AS status
FROM ({CHUNKS}) GROUP BY chunk"""

ORACLES["sample_first"] = "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 1024"

ORACLES["sample_check"] = """
SELECT least(count(*), 256) AS n_rows, least(count(*), 256) AS n_known, least(count(*), 256) AS n_keys FROM orders"""

# -- cursor ------------------------------------------------------------------------------------------------------

ORACLES["max_cursor"] = f"""
SELECT count(*) AS n_rows, {DAY.format("max(o_orderdate)")} AS top,
       {DAY.format("max(o_orderdate) FILTER (o_orderdate < TIMESTAMP '2000-06-15')")} AS before
FROM orders"""

ORACLES["cursor_increment"] = f"""
SELECT {ORDER_FIELDS}, (SELECT {DAY.format("max(o_orderdate)")} FROM orders) AS next_cursor
FROM orders WHERE o_orderdate > TIMESTAMP '1996-05-01'"""

ORACLES["cursor_cutoff"] = f"""
SELECT {ORDER_FIELDS},
       (SELECT {DAY.format("max(o_orderdate)")} FROM orders WHERE o_orderdate < TIMESTAMP '2000-06-15') AS next_cursor
FROM orders WHERE o_orderdate > TIMESTAMP '1996-05-01' AND o_orderdate < TIMESTAMP '2000-06-15'"""

ORACLES["time_cursor"] = """
WITH t AS (SELECT event_id, strftime(ts, '%H:%M:%S.%f') AS "at" FROM events)
SELECT event_id, "at", 'in' AS today, (SELECT max("at") FROM t) AS next_cursor, '06:30:00' AS next_without
FROM t WHERE "at" > '06:30:00'"""

ORACLES["snapshot_cursor"] = f"""
SELECT {ORDER_FIELDS},
       (SELECT {DAY.format("max(o_orderdate)")} FROM orders WHERE o_orderdate < TIMESTAMP '2000-06-15') AS next_cursor
FROM orders WHERE o_orderkey > 100 AND o_orderdate < TIMESTAMP '2000-06-15'"""

ORACLES["snapshot_nokey_cursor"] = f"""
SELECT l_orderkey, l_linenumber, {DAY.format("l_shipdate")} AS l_shipdate,
       (SELECT {DAY.format("max(l_shipdate)")} FROM lineitem WHERE l_shipdate < TIMESTAMP '2000-06-15') AS next_cursor
FROM lineitem WHERE l_shipdate < TIMESTAMP '2000-06-15'"""

# -- change table ------------------------------------------------------------------------------------------------

VERSION = "CAST(datediff('day', TIMESTAMP '1995-01-01', l_shipdate) AS BIGINT)"
LAST_VERSION = f"(SELECT max({VERSION}) FROM lineitem)"

# Of several changes in one version, updates win over inserts and both over deletes.
NET = f"""
SELECT l_orderkey AS o_orderkey, {VERSION} AS sys_change_version,
       CASE l_returnflag WHEN 'R' THEN 'D' WHEN 'A' THEN 'U' ELSE 'I' END AS sys_change_operation
FROM lineitem WHERE {VERSION} > 1200
QUALIFY row_number() OVER (
    PARTITION BY l_orderkey
    ORDER BY {VERSION} DESC, CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END) = 1"""

ORACLES["ct_snapshot"] = f"""
SELECT o_totalprice, o_orderkey, {LAST_VERSION} AS ct_version FROM orders WHERE o_orderkey > 100"""

ORACLES["ct_snapshot_nokey"] = f"""
SELECT l_orderkey, l_partkey, l_quantity, {LAST_VERSION} AS ct_version FROM lineitem"""

ORACLES["net_changes"] = NET

ORACLES["ct_increment"] = f"""
WITH net AS ({NET}), now AS (SELECT * FROM orders WHERE o_orderstatus <> 'F')
SELECT coalesce(o.o_orderkey, n.o_orderkey) AS o_orderkey, o_custkey, o_orderstatus, o_totalprice, {ORDER_DAY},
       CASE WHEN sys_change_operation = 'D' THEN '2024-01-01T00:00:00.250' END AS _ab_cdc_deleted_at,
       sys_change_version, {LAST_VERSION} AS ct_version
FROM net n LEFT JOIN now o ON o.o_orderkey = n.o_orderkey"""

ORACLES["ct_increment_many"] = ORACLES["ct_increment"]

# -- change events -----------------------------------------------------------------------------------------------

# lost: both images are missing; shown: an image is there; gone: the row is deleted.
EVENTS = f"""
e0 AS (
    SELECT *, epoch_us(ts) // 1000 AS ms, CAST(json_extract(props, '$.k') AS BIGINT) AS k, {HEX.format("user_id")} AS _id,
           event_id % 4 + 1 AS ord,
           CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op
    FROM events),
e1 AS (SELECT *, ms // 1000 AS seconds, event_type = 'view' AND k < 10 AS lost FROM e0),
e AS (
    SELECT *, op = 'd' OR lost AS gone, CASE WHEN op = 'd' THEN k >= 50 ELSE NOT lost END AS shown,
           {ISO_INSTANT.format("ms")} AS stamp
    FROM e1),
r AS (
    SELECT event_id, seconds, ord, k, _id, shown, gone,
           CASE WHEN shown THEN user_id END AS user, CASE WHEN shown THEN value END AS value,
           CASE WHEN shown THEN event_type END AS kind, stamp AS _ab_cdc_updated_at,
           CASE WHEN gone THEN stamp END AS _ab_cdc_deleted_at
    FROM e)"""

ORACLES["cdc_rows"] = f"""
WITH {EVENTS}
SELECT event_id, _id, user, value, kind, CASE WHEN shown THEN '{{"k":' || k || '}}' END AS props,
       _ab_cdc_updated_at, _ab_cdc_deleted_at
FROM r"""

ORACLES["cdc_packed"] = f"""
WITH {EVENTS}
SELECT event_id, _id, user, value, CASE WHEN shown THEN 'x' END AS extra, CASE WHEN shown THEN k END AS props_k,
       _ab_cdc_deleted_at
FROM r"""

ORACLES["cdc_lookup"] = f"""
WITH {EVENTS}, now AS (SELECT c_custkey, c_acctbal FROM customer WHERE c_mktsegment <> 'BUILDING')
SELECT event_id, _id,
       CASE WHEN op = 'u' THEN c_custkey WHEN shown THEN user_id END AS user,
       CASE WHEN op = 'u' THEN c_acctbal WHEN shown THEN value END AS value,
       CASE WHEN op = 'u' AND c_custkey IS NOT NULL THEN 'now' WHEN op <> 'u' AND shown THEN event_type END AS kind,
       CASE WHEN op = 'd' OR (op = 'u' AND c_custkey IS NULL) THEN stamp END AS _ab_cdc_deleted_at
FROM e LEFT JOIN now ON c_custkey = user_id"""

ORACLES["cdc_cursor"] = f"""
WITH {EVENTS}
SELECT event_id, seconds, ord,
       170674560000000000 + row_number() OVER (ORDER BY seconds, ord, event_id) AS _ab_cdc_cursor
FROM e"""

ORACLES["event_key_id"] = f"""
SELECT event_id,
       CASE WHEN event_type = 'signup' THEN {HEX.format("event_id")} WHEN event_type = 'view' THEN event_type || event_id
            WHEN event_type = 'purchase' THEN base64(encode(event_type))
            WHEN event_type = 'error' AND event_id % 2 = 1 THEN base64(unhex(lpad(lower(to_hex(event_id)), 32, '0')))
            ELSE CAST(event_id AS VARCHAR) END AS _id
FROM events"""

ORACLES["event_position"] = f"""
WITH {EVENTS}
SELECT event_id, seconds, ord, seconds > 1705708800 OR (seconds = 1705708800 AND ord >= 2) AS reached,
       seconds = 1705708800 AND ord = 2 AS same
FROM e"""

ORACLES["event_include"] = """
SELECT event_id, 'app' AS namespace, 'nation_' || (user_id % 25) AS stream
FROM events JOIN nation ON lower(n_name) = 'nation_' || (user_id % 25)
WHERE n_regionkey <> 3"""

ORACLES["events_by_stream"] = f"""
WITH {EVENTS},
n AS (SELECT r.*, user_id, event_type, e.value AS amount, lower(n_name) AS stream, n_regionkey AS region
      FROM r JOIN e USING (event_id) JOIN nation ON lower(n_name) = 'nation_' || (user_id % 25))
SELECT event_id, 'app' AS namespace, stream,
       CASE WHEN region = 0 THEN CASE WHEN shown THEN 2 ELSE 1 END WHEN region = 1 THEN CASE WHEN shown THEN 3 ELSE 1 END
            WHEN region = 2 AND shown THEN 3 ELSE 0 END AS n_fields,
       CASE WHEN region < 2 THEN n._id END AS _id, CASE WHEN region = 0 THEN user END AS user,
       CASE WHEN region IN (1, 2) AND shown THEN amount END AS value,
       CASE WHEN region = 1 THEN '["' || kind || '"]' WHEN region = 2 THEN '"' || kind || '"' END AS kind,
       CASE WHEN region = 2 AND shown THEN k END AS props_k, _ab_cdc_updated_at, _ab_cdc_deleted_at
FROM n"""

ORACLES["bounded_changes"] = f"""
WITH {EVENTS}
SELECT event_id, seconds, ord, op FROM e WHERE seconds > 1704400000 OR (seconds = 1704400000 AND ord > 2)"""

ORACLES["bounded_target"] = f"""
WITH {EVENTS}
SELECT event_id, seconds, ord, op FROM e
WHERE (seconds > 1704400000 OR (seconds = 1704400000 AND ord > 2))
  AND (seconds < 1705708800 OR (seconds = 1705708800 AND ord <= 2))"""

APPLIED = f"""
WITH {EVENTS},
last AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY _id ORDER BY seconds DESC, ord DESC, event_id DESC) = 1),
base AS (SELECT {HEX.format("c_custkey")} AS _id, c_custkey AS user, c_acctbal AS value, 'base' AS kind FROM customer)
SELECT _id, user, value, kind, _ab_cdc_updated_at, _ab_cdc_deleted_at FROM last
UNION ALL
SELECT _id, user, value, kind, NULL, NULL FROM base WHERE _id NOT IN (SELECT _id FROM last)"""

ORACLES["apply_changes"] = APPLIED

ORACLES["apply_changes_hard"] = f"""
SELECT _id, user, value, kind, _ab_cdc_updated_at FROM ({APPLIED}) WHERE _ab_cdc_deleted_at IS NULL"""

ORACLES["apply_replay"] = APPLIED

ORACLES["stream_apply"] = APPLIED

ORACLES["apply_buckets"] = APPLIED

ORACLES["stream_once"] = APPLIED

ORACLES["stream_resume"] = f"""
WITH {EVENTS}
SELECT event_id, seconds, ord, CASE WHEN seconds < 1705708800 OR (seconds = 1705708800 AND ord <= 2) THEN 0 ELSE 1 END AS run
FROM e"""

# -- documents ---------------------------------------------------------------------------------------------------

DOCS = f"""
d AS (
    SELECT *, epoch_us(ts) // 1000 AS ms, CAST(json_extract(props, '$.k') AS BIGINT) AS k, {HEX.format("event_id")} AS _id
    FROM events)"""
AT = ISO_MILLIS.format("ms")
TAGS = """'["' || event_type || '"]'"""
LISTED = "event_type IN ('click', 'view')"

# The fields of a document with their types; tags is an array in some documents only.
FIELDS = """(VALUES ('_id', 'string'), ('user', 'number'), ('at', 'string'), ('clock', 'string'), ('price', 'number'),
                    ('more', 'object'), ('props', 'object'), ('tags', NULL)) AS f(field, kind)"""

ORACLES["discover_schema"] = f"""
SELECT event_type, field,
       coalesce(kind, CASE WHEN {LISTED} THEN 'array' ELSE 'string' END) AS type, count(*) AS n_documents, 1 AS n_types
FROM events, {FIELDS} GROUP BY ALL"""

ORACLES["discover_shapes"] = f"""
SELECT event_type, fields, count(*) AS n_documents FROM (
    SELECT event_id, event_type,
           string_agg(field || ':' || coalesce(kind, CASE WHEN {LISTED} THEN 'array' ELSE 'string' END), ',' ORDER BY field) AS fields
    FROM events, {FIELDS} GROUP BY event_id, event_type)
GROUP BY ALL"""

ORACLES["discover_schema_all"] = f"""
SELECT field,
       coalesce(any_value(kind), CASE WHEN count(*) FILTER ({LISTED}) >= count(*) FILTER (NOT {LISTED}) THEN 'array'
                                      ELSE 'string' END) AS type,
       count(*) AS n_documents, CASE WHEN field = 'tags' THEN 2 ELSE 1 END AS n_types
FROM events, {FIELDS} GROUP BY field"""

ORACLES["discover_schema_sample"] = f"""
SELECT field, any_value(kind) AS type, TRUE AS in_all FROM events, {FIELDS} WHERE field <> 'tags' GROUP BY field"""

ORACLES["discover_schemaless"] = "SELECT event_type, '_id' AS field, 'string' AS type FROM events GROUP BY event_type"

ORACLES["id_type_census"] = """
SELECT event_type,
       CASE event_type WHEN 'signup' THEN 'objectId' WHEN 'click' THEN 'long' WHEN 'view' THEN 'string'
            WHEN 'purchase' THEN 'date' ELSE CASE WHEN value < 30 THEN 'int' ELSE 'binData' END END AS id_type,
       count(*) AS n_documents, event_type <> 'purchase' AS supported
FROM events GROUP BY ALL"""

ORACLES["normalize_docs"] = f"""
WITH {DOCS}
SELECT event_id, _id, user_id AS user, {AT} AS at, {AT} AS clock, value AS price, {TAGS} AS tags,
       {AT} AS more_seen, user_id AS more_first, k AS props_k
FROM d"""

ORACLES["snapshot_docs"] = f"""
WITH {DOCS}
SELECT _id, user_id AS user, value AS price, '2024-02-01T00:00:00.125Z' AS _ab_cdc_updated_at,
       CAST(NULL AS VARCHAR) AS _ab_cdc_deleted_at,
       170674560000000000 + row_number() OVER (ORDER BY _id) AS _ab_cdc_cursor
FROM d"""

ORACLES["snapshot_docs_plain"] = f"WITH {DOCS} SELECT _id, user_id AS user, value AS price FROM d"

ORACLES["snapshot_docs_resume"] = f"""
WITH {DOCS},
rest AS (SELECT *, row_number() OVER (ORDER BY _id) AS n FROM d WHERE _id > printf('%024x', 250))
SELECT _id, user_id AS user, value AS price, '2024-02-01T00:00:00.125Z' AS _ab_cdc_updated_at,
       CAST(NULL AS VARCHAR) AS _ab_cdc_deleted_at, 170674560000000000 + n AS _ab_cdc_cursor, (n - 1) // 100 AS chunk
FROM rest"""

ORACLES["value_types"] = f"""
WITH {DOCS}
SELECT event_id, {AT} AS day, '+10000-01-01T00:00:00.000Z' AS far, base64(encode(event_type)) AS bytes,
       base64(unhex(lpad(lower(to_hex(event_id)), 32, '0'))) AS uuid, '(i)^' || event_type AS pattern, event_type AS symbol,
       'f(' || event_id || ')' AS code, CAST(NULL AS VARCHAR) AS low, CAST(NULL AS VARCHAR) AS high,
       CAST(NULL AS VARCHAR) AS unset, CAST(NULL AS VARCHAR) AS none, event_id AS whole, event_id AS cut,
       event_id + 0.75::DOUBLE AS exact, event_id % 2 = 0 AS truth, '["' || {AT} || '","s",null]' AS list,
       'g()' AS scoped_code, event_id AS scoped_id, {AT} AS inside_at, 5 AS inside_n, TRUE AS inside_gone
FROM d"""

ORACLES["array_wrap"] = f"""
SELECT event_id, {TAGS} AS tags, '[' || user_id || ']' AS user, CAST(NULL AS VARCHAR) AS none FROM events"""

ORACLES["force_string"] = f"""
WITH {DOCS}
SELECT event_id, '{{"k":' || k || '}}' AS props_aibyte_transform, CAST(user_id AS VARCHAR) AS user_aibyte_transform,
       CASE WHEN {LISTED} THEN {TAGS} ELSE event_type END AS tags_aibyte_transform
FROM d"""

ORACLES["pack_docs"] = f"""
WITH {DOCS}
SELECT event_id, _id, _id AS data_id, user_id AS user, {AT} AS at, value AS price, {AT} AS more_seen, k AS props_k FROM d"""

ORACLES["collection_stats"] = """
SELECT source, count(*) AS n_rows, CAST(sum(strlen(text)) AS BIGINT) AS n_bytes, count(*) AS estimated_rows,
       CAST(2 * sum(strlen(text)) AS BIGINT) AS estimated_bytes
FROM documents GROUP BY source"""

ORACLES["chunk_size"] = """
SELECT role, CAST(1073741824 // (sum(strlen(text)) // count(*)) AS BIGINT) AS chunk, 1000000 AS chunk_no_bytes,
       1000000 AS chunk_tiny_rows, 1000000 AS chunk_unknown
FROM conversations GROUP BY role"""

# -- metadata ----------------------------------------------------------------------------------------------------

TABLES = """
t AS (
    SELECT CASE c_mktsegment WHEN 'MACHINERY' THEN 'sys' WHEN 'BUILDING' THEN 'dbo' WHEN 'AUTOMOBILE' THEN 'DBO'
                ELSE lower(c_mktsegment) END AS namespace,
           c_name AS "table", c_nationkey AS n, c_acctbal AS bal,
           CASE WHEN n < 3 THEN 'view' WHEN n < 6 THEN 'VIEW' WHEN n < 24 THEN 'TABLE' ELSE '' END AS type
    FROM customer),
known AS (SELECT * FROM t WHERE namespace <> 'sys')"""

ORACLES["discover_tables"] = f"""
WITH {TABLES}
SELECT namespace, "table", type, upper(type) = 'VIEW' AS is_view, 'all' AS asked FROM known
UNION ALL
SELECT namespace, "table", type, upper(type) = 'VIEW', 'dbo' FROM t WHERE namespace IN ('dbo', 'DBO')"""

COLUMNS = """
(VALUES (1, 'id', 'bigint', 'BIGINT', 19, 0, 'long', 'bigint'),
        (2, 'amount', 'decimal', 'DECIMAL', 18, 4, 'decimal', 'decimal(18,4)'),
        (3, 'price', 'money', 'DECIMAL', 19, 4, 'double', 'double'),
        (4, 'ratio', 'real', 'REAL', 24, NULL, 'float', 'float'),
        (5, 'wide', 'float', 'REAL', 53, NULL, 'double', 'double'),
        (6, 'title', 'nvarchar', 'NVARCHAR', 200, NULL, 'string', 'string'),
        (7, 'born', 'date', 'DATE', 10, NULL, 'date', 'date'),
        (8, 'seen', 'datetime2', 'TIMESTAMP', 27, 7, 'timestamp', 'timestamp_ntz'),
        (9, 'zoned', 'datetimeoffset', 'OTHER', 34, 7, 'timestamptz', 'timestamp'),
        (10, 'clock', 'time', 'TIME', 16, 7, 'time', 'string'),
        (11, 'blob', 'varbinary', 'VARBINARY', 8000, NULL, 'binary', 'binary'),
        (12, 'shape', 'geometry', 'VARBINARY', NULL, NULL, 'geometry', 'string'),
        (13, 'node', 'hierarchyid', 'VARBINARY', 892, NULL, 'hierarchy', 'string'),
        (14, 'flag', 'bit', 'BIT', 1, NULL, 'boolean', 'boolean'),
        (15, 'odd', 'sql_variant', 'OTHER', 0, NULL, 'opaque', 'string'),
        (NULL, 'rowguid', 'nvarchar', 'NVARCHAR', 36, NULL, 'string', 'string'),
        (99, 'rowguid', 'int', 'INTEGER', 10, 0, 'int', 'int'))
AS c(ordinal, "column", type_name, type_code, precision, scale, logical_type, spark_type)"""

ORACLES["discover_columns"] = f"""
WITH {TABLES}
SELECT namespace, "table", "column", ordinal, type_name, type_code, precision, scale
FROM known, {COLUMNS} WHERE ordinal IS DISTINCT FROM 99"""

ORACLES["type_map"] = f"""
WITH {TABLES}
SELECT namespace, "table", "column", ordinal, logical_type, spark_type FROM t, {COLUMNS}"""

KEYS = f"""
{TABLES},
k AS (
    SELECT *,
           CASE WHEN n < 7 THEN 'id' WHEN n BETWEEN 8 AND 15 THEN 'title,amount' END AS physical,
           CASE WHEN bal > 5000 THEN 'title,id' END AS logical,
           CASE WHEN n BETWEEN 3 AND 9 THEN 'born' WHEN n BETWEEN 10 AND 19 THEN 'born,id' END AS clustered,
           coalesce(physical, logical) AS primary_key,
           CASE WHEN clustered = 'born' THEN 'born' ELSE split_part(primary_key, ',', 1) END AS ordered_column
    FROM known)"""

ORACLES["discover_pk"] = f"""
WITH {KEYS} SELECT namespace, "table", physical AS primary_key FROM k WHERE physical IS NOT NULL"""

ORACLES["discover_clustered"] = f"""
WITH {KEYS} SELECT namespace, "table", clustered AS clustered_key FROM k WHERE clustered IS NOT NULL"""

ORACLES["effective_pk"] = f'WITH {KEYS} SELECT namespace, "table", primary_key FROM k'

ORACLES["ordered_column"] = f'WITH {KEYS} SELECT namespace, "table", ordered_column FROM k'

ORACLES["catalog_rel"] = f"""
WITH {KEYS}
SELECT namespace, "table",
       CASE WHEN primary_key IS NULL THEN 'full_refresh' ELSE 'full_refresh,incremental' END AS sync_modes,
       coalesce(primary_key, '') AS primary_key,
       CASE WHEN primary_key IS NULL THEN '' ELSE '_ab_cdc_deleted_at' END AS added_columns,
       primary_key IS NOT NULL AS resumable, primary_key IS NOT NULL AS source_cursor
FROM k"""

DOCUMENT_CATALOG = """
SELECT event_type, {fields} || '_ab_cdc_updated_at:string,_ab_cdc_deleted_at:string,_ab_cdc_cursor:integer' AS fields,
       'full_refresh,incremental' AS sync_modes, '_id' AS primary_key, '_ab_cdc_cursor' AS cursor_field,
       TRUE AS source_cursor, TRUE AS resumable
FROM events GROUP BY event_type"""

ORACLES["catalog_doc"] = DOCUMENT_CATALOG.format(
    fields="'_id:string,at:string,clock:string,more:object,price:number,props:object,tags:' || "
    f"CASE WHEN {LISTED} THEN 'array' ELSE 'string' END || ',user:number,'"
)

ORACLES["catalog_doc_packed"] = DOCUMENT_CATALOG.format(fields="'_id:string,data:object,'")

ORACLES["discover_collections"] = """
SELECT 'c' || p_partkey AS name, 'collection' AS type FROM part
WHERE p_type NOT IN ('ECONOMY', 'PROMO') AND p_size <= 40"""

# -- planning ----------------------------------------------------------------------------------------------------

TRACKED = """
s AS (
    SELECT c_name AS stream, c_custkey AS n,
           CASE WHEN n % 7 = 0 THEN 'none' WHEN n % 13 = 0 THEN 'null' WHEN n % 19 = 0 THEN 'bad' ELSE 'ok' END AS state,
           CASE WHEN n % 8 = 1 THEN 60 ELSE n % 70 END AS stored_version,
           n % 23 <> 0 AND stored_version < 10 AS expired,
           n % 4 = 1 OR n % 3 > 0 AS ordered,
           CASE WHEN n % 17 = 0 OR NOT ordered THEN 'whole' ELSE 'keyed' END AS start
    FROM customer),
ruled AS (
    SELECT *, CASE WHEN state = 'null' THEN 0 WHEN state <> 'ok' THEN 1 WHEN expired THEN 2
                   WHEN n % 11 = 0 AND NOT ordered THEN 3 WHEN n % 11 = 0 THEN 4
                   WHEN n % 3 = 0 OR n % 5 = 0 THEN 5 WHEN stored_version = 60 THEN 6 ELSE 7 END AS rule
    FROM s),
read AS (
    SELECT *, CASE WHEN rule IN (0, 6) OR (rule = 5 AND stored_version = 60) THEN 'done' WHEN rule IN (1, 2) THEN start
                   WHEN rule IN (3, 5) THEN 'whole' WHEN rule = 4 THEN 'keyed' ELSE 'changes' END AS read
    FROM ruled)"""

ORACLES["plan_sync"] = f"WITH {TRACKED} SELECT stream, stored_version, expired FROM s"

ORACLES["plan_sync_ct"] = f"""
WITH {TRACKED}
SELECT stream, rule, read, CASE WHEN rule = 4 THEN CAST(n AS VARCHAR) END AS after_key,
       CASE WHEN read = 'changes' THEN stored_version END AS since_version,
       CASE WHEN rule = 4 THEN stored_version WHEN read <> 'done' THEN 60 END AS next_version
FROM read"""

ORACLES["plan_sync_cursor"] = """
WITH s AS (
    SELECT c_name AS stream, c_custkey AS n,
           CASE WHEN n % 7 = 0 THEN 'none' WHEN n % 13 = 0 THEN 'null' ELSE 'ok' END AS state,
           n % 17 = 0 OR NOT (n % 4 = 1 OR n % 3 > 0) AS unordered, n % 2 = 0 AS full_refresh, n % 31 <> 0 AS chosen
    FROM customer),
ruled AS (
    SELECT *, CASE WHEN state = 'null' THEN 0 WHEN state = 'none' AND full_refresh THEN 1
                   WHEN state = 'none' AND NOT chosen THEN 2 WHEN state = 'none' THEN 3
                   WHEN full_refresh AND unordered THEN 4 WHEN full_refresh THEN 5 WHEN n % 11 = 0 THEN 6
                   WHEN n % 23 = 0 THEN 7 WHEN n % 29 = 0 THEN 8 WHEN n % 19 = 3 THEN 9 ELSE 10 END AS rule
    FROM s),
read AS (
    SELECT *, CASE WHEN rule IN (0, 7, 9) THEN 'done'
                   WHEN rule = 1 THEN CASE WHEN unordered THEN 'whole' ELSE 'keyed' END
                   WHEN rule IN (2, 3, 6, 8) AND NOT chosen THEN 'no_cursor'
                   WHEN rule IN (3, 6, 8) THEN CASE WHEN unordered THEN 'whole_cursor' ELSE 'keyed_cursor' END
                   WHEN rule = 4 THEN CASE WHEN n % 9 = 0 THEN 'done' ELSE 'whole' END
                   WHEN rule = 5 THEN CASE WHEN n % 11 = 0 AND n % 19 = 3 THEN 'done' ELSE 'keyed' END
                   ELSE 'increment' END AS read
    FROM ruled)
SELECT stream, rule, read,
       CASE WHEN rule IN (5, 6) AND read IN ('keyed', 'keyed_cursor') AND n % 11 = 0 THEN n % 19 END AS after_key,
       CASE WHEN read = 'increment' THEN n % 19 END AS after_cursor
FROM read"""

SELECTION = """
s AS (
    SELECT c_mktsegment AS namespace, c_name AS stream, o.offset,
           CASE WHEN o.offset = 'valid' AND c_acctbal > 6000 THEN 'COMPLETE'
                WHEN o.offset = 'valid' AND c_acctbal > 2500 THEN 'IN_PROGRESS' END AS status
    FROM customer, (VALUES ('valid'), ('invalid')) AS o("offset") WHERE c_nationkey < 20)"""

ORACLES["snapshot_selection"] = f"""
WITH {SELECTION}
SELECT namespace, stream, status, status IS DISTINCT FROM 'COMPLETE' AS snapshot, status IS NOT NULL AS started, s.offset
FROM s"""

ORACLES["sync_phases"] = f"""
WITH {SELECTION}
SELECT CASE WHEN count(status) = 0 THEN 'snapshot, changes'
            WHEN count(*) FILTER (status IS DISTINCT FROM 'COMPLETE') = 0 THEN 'changes' ELSE 'changes, snapshot' END AS phases,
       count(*) FILTER (status IS DISTINCT FROM 'COMPLETE') AS snapshots, count(status) AS started_streams, s.offset
FROM s GROUP BY s.offset"""

ORACLES["offset_check"] = f"""
WITH {EVENTS},
stored AS (
    SELECT _id, seconds, ord FROM e WHERE event_type = 'purchase'
    QUALIFY row_number() OVER (PARTITION BY _id ORDER BY seconds DESC, ord DESC) = 1),
oldest AS (
    SELECT _id, seconds, ord FROM e WHERE seconds >= 1705000000
    QUALIFY row_number() OVER (PARTITION BY _id ORDER BY seconds, ord) = 1)
SELECT '{{"$oid":"' || s._id || '"}}' AS stream, s.seconds AS stored, o.seconds AS oldest,
       coalesce(o.seconds < s.seconds OR (o.seconds = s.seconds AND o.ord <= s.ord), FALSE) AS valid
FROM stored s LEFT JOIN oldest o ON o._id = s._id"""

ORACLES["latest_state"] = """
SELECT 'app' AS namespace, CAST(user_id AS VARCHAR) AS stream, event_id AS batch, event_type AS status,
       CAST(value AS VARCHAR) AS cursor, event_type <> 'click' AS schema_enforced
FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1"""

# -- values ------------------------------------------------------------------------------------------------------

ORACLES["state_values"] = """
WITH o AS (SELECT *, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS t FROM orders)
SELECT o_orderkey,
       CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS VARCHAR) END AS whole,
       CASE WHEN o_orderstatus <> 'P' THEN CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) END AS number,
       hex(o_orderpriority) AS bytes,
       CASE o_orderstatus WHEN 'O' THEN t || '.000000' WHEN 'P' THEN t || '.250000' ELSE 'soon' END AS local,
       CASE o_orderstatus WHEN 'O' THEN t || '.000000+02:00' WHEN 'P' THEN t || '.123456Z' ELSE 'later' END AS zoned
FROM o"""

ORACLES["id_text"] = """
WITH i AS (SELECT event_id, event_type, lpad(lower(to_hex(event_id)), 32, '0') AS bytes FROM events)
SELECT event_id, CAST(event_id AS VARCHAR) AS long_id,
       CASE WHEN event_type = 'click'
            THEN bytes[1:8] || '-' || bytes[9:12] || '-' || bytes[13:16] || '-' || bytes[17:20] || '-' || bytes[21:32]
            ELSE base64(unhex(bytes)) END AS binary_id,
       bytes
FROM i"""

ORACLES["token_time"] = """
SELECT event_id, epoch_us(ts) // 1000000 AS seconds, event_id % 1000 + 1 AS ord FROM events"""
