import json

import pytest
from pyspark.sql import functions as F

from tidemark.functions import extjson
from tidemark.operators import documents

from plain_json import plain_text

# One field per type of the source database, in canonical form.
FIELDS = {
    "f_bool": True,
    "f_int": 1,
    "f_long": {"$numberLong": "2"},
    "f_double": 3.5,
    "f_decimal": {"$numberDecimal": "4.25"},
    "f_time": {"$timestamp": {"t": 394, "i": 1381162128}},
    "f_date": {"$date": {"$numberLong": "1693598277000"}},
    "f_date_text": {"$date": "2023-09-01T19:57:57.5Z"},
    "f_binary": {"$binary": {"base64": "dGVzdA==", "subType": "00"}},
    "f_uuid": {"$uuid": "00112233-4455-6677-8899-aabbccddeeff"},
    "f_symbol": {"$symbol": "sym"},
    "f_string": 'te"xt',
    "f_oid": {"$oid": "64f24244f95155351c4185b1"},
    "f_js": {"$code": "code()"},
    "f_scope": {"$code": "code2()", "$scope": {"scope": "kept", "other": 1}},
    "f_regex": {"$regularExpression": {"pattern": "pat", "options": "i"}},
    "f_regex_plain": {"$regularExpression": {"pattern": "pat", "options": ""}},
    "f_null": None,
    "f_min": {"$minKey": 1},
    "f_object": {"key": "v", "at": {"$date": {"$numberLong": "5"}}, "gone": {"$maxKey": 1}},
    "f_array": [1, {"$oid": "aa"}, [{"$numberLong": "7"}], {"$minKey": 1}],
}
TYPES = {
    "f_bool": "boolean",
    "f_int": "int",
    "f_long": "long",
    "f_double": "double",
    "f_decimal": "decimal",
    "f_time": "timestamp",
    "f_date": "date",
    "f_date_text": "date",
    "f_binary": "binData",
    "f_uuid": "binData",
    "f_symbol": "symbol",
    "f_string": "string",
    "f_oid": "objectId",
    "f_js": "javascript",
    "f_scope": "javascriptWithScope",
    "f_regex": "regex",
    "f_regex_plain": "regex",
    "f_null": "null",
    "f_min": "minKey",
    "f_object": "object",
    "f_array": "array",
}
TEXTS = {
    "f_bool": "true",
    "f_int": "1",
    "f_long": "2",
    "f_double": "3.5",
    "f_decimal": "4.25",
    "f_time": "2023-09-01T19:57:56.752Z",
    "f_date": "2023-09-01T19:57:57.000Z",
    "f_date_text": "2023-09-01T19:57:57.500Z",
    "f_binary": "dGVzdA==",
    "f_uuid": "ABEiM0RVZneImaq7zN3u/w==",
    "f_symbol": "sym",
    "f_string": 'te"xt',
    "f_oid": "64f24244f95155351c4185b1",
    "f_js": "code()",
    "f_scope": '{"code":"code2()","scope":{"other":1,"scope":"kept"}}',
    "f_regex": "(i)pat",
    "f_regex_plain": "pat",
    "f_null": None,
    "f_min": None,
    "f_object": '{"at":"1970-01-01T00:00:00.005Z","key":"v"}',
    "f_array": '[1,"aa",[7],null]',
}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(json.dumps(FIELDS),)], "document string")


def test_type_names(docs):
    fields = docs.sparkSession.tvf.variant_explode(F.col("_v").outer())
    found = docs.select(F.parse_json("document").alias("_v")).lateralJoin(fields).select("key", extjson.type_name(F.col("value")))
    assert {k: t for k, t in found.collect()} == TYPES


def test_everything_as_text(docs):
    row = documents.normalize(docs, "document", dict.fromkeys(FIELDS, "string")).first()
    assert row.asDict() == TEXTS


def test_declared_types_and_projection(docs):
    declared = {"f_decimal": "number", "f_long": "integer", "f_bool": "boolean", "f_object": "object", "f_missing": "string"}
    df = documents.normalize(docs, "document", declared)
    assert df.columns == list(declared)
    row = df.withColumn("f_object", F.to_json("f_object")).first()
    assert tuple(row) == (4.25, 2, True, '{"at":"1970-01-01T00:00:00.005Z","key":"v"}', None)


def test_arrays_are_wrapped(docs):
    declared = ["f_array", "f_object", "f_int", "f_null", "f_missing", "f_min", "f_string"]
    df = documents.normalize(docs, "document", dict.fromkeys(declared, "array"))
    row = df.select(*[F.to_json(c) for c in declared]).first()
    assert tuple(row) == (
        '[1,"aa",[7],null]',
        '[{"at":"1970-01-01T00:00:00.005Z","key":"v"}]',
        "[1]",
        "[null]",
        None,
        None,
        '["te\\"xt"]',
    )


def test_forced_text(docs):
    declared = {"f_object_aibyte_transform": "string", "f_int_aibyte_transform": "string", "f_missing_aibyte_transform": "string"}
    row = documents.normalize(docs, "document", declared).first()
    assert tuple(row) == (TEXTS["f_object"], "1", None)


def test_packed(spark):
    text = '{"_id":{"$oid":"ab"},"n":{"$numberLong":"5"},"deep":[{"d":{"$date":7}}]}"'  # the stray quote is ignored
    docs = spark.createDataFrame([(text,), ('{"_id":3,"x":1}',)], "document string")
    packed = documents.pack(docs, "document").select("_id", F.to_json("data"))
    assert [tuple(r) for r in packed.collect()] == [
        ("ab", '{"_id":"ab","deep":[{"d":"1970-01-01T00:00:00.007Z"}],"n":5}'),
        ("3", '{"_id":3,"x":1}'),
    ]


def test_without_rewrite_no_python_runs(docs):
    df = documents.normalize(docs, "document", {"f_object": "object", "f_min": "object", "f_oid": "string"}, rewrite=False)
    assert "ArrowEvalPython" not in df._jdf.queryExecution().executedPlan().toString()
    row = df.select(F.to_json("f_object").contains("$date"), "f_min", "f_oid").first()
    assert tuple(row) == (True, None, FIELDS["f_oid"]["$oid"])


def test_bad_documents_fail(spark):
    docs = spark.createDataFrame([("{broken",)], "document string")
    with pytest.raises(Exception):
        documents.normalize(docs, "document", {"a": "string"}).collect()


def test_discovery_takes_the_most_frequent_type(spark, rows):
    texts = ['{"_id":1,"total":1,"tie":1}', '{"_id":2,"total":"x","tie":"y"}', '{"_id":3,"total":2,"other":null}', "{}"]
    docs = spark.createDataFrame([(t,) for t in texts], "document string")
    found = documents.discover_schema(docs, "document").select("field", "type", "documents", "types")
    assert rows(found) == [
        ("_id", "number", 3, 1),
        ("other", "null", 1, 1),
        ("tie", "number", 2, 2),
        ("total", "number", 3, 2),
    ]


def test_empty_collections_have_no_schema(spark):
    docs = spark.createDataFrame([], "document string")
    assert documents.discover_schema(docs, "document").count() == 0
    assert documents.discover_packed(docs, "document").count() == 0


def test_id_census(spark, rows):
    texts = ['{"_id":1}', '{"_id":{"$oid":"a"}}', '{"_id":{"$oid":"b"}}', '{"_id":1.5}', '{"x":1}']
    docs = spark.createDataFrame([(t,) for t in texts], "document string")
    assert rows(documents.id_type_census(docs, "document")) == [
        ("double", 1, False),
        ("int", 1, True),
        ("objectId", 2, True),
        (None, 1, False),
    ]


def test_documents_are_sampled(spark):
    docs = spark.range(1000).selectExpr("concat('{\"_id\":', id, '}') as document")
    assert documents.sample_documents(docs, 10).count() == 10


def test_wrapped_numbers_lose_their_fraction_like_plain_ones(spark):
    texts = ['{"a":3.7}', '{"a":{"$numberDouble":"3.7"}}', '{"a":{"$numberDecimal":"3.0"}}', '{"a":{"$numberLong":"3"}}', '{"a":"x"}']
    docs = spark.createDataFrame([(t,) for t in texts], "document string")
    assert [r[0] for r in documents.normalize(docs, "document", {"a": "integer"}).collect()] == [3, 3, 3, 3, None]


def test_names_that_differ_by_case(spark):
    docs = spark.createDataFrame([('{"Name":"A","name":"a","NAME":1}',)], "document string")
    df = documents.normalize(docs, "document", {"Name": "string", "name": "string", "NAME": "integer"})
    assert tuple(df.first()) == ("A", "a", 1)


def test_values_that_cannot_be_read_are_null(spark):
    inside = ['{"$date":"10000-01-01T00:00:00Z"}', '{"$date":"soon"}', '{"$numberInt":"x"}', '{"$binary":{}}', '{"$uuid":5}', '{"$date":5}']
    docs = spark.createDataFrame([(f'{{"a":[{",".join(inside)}]}}',)], "document string")
    row = documents.normalize(docs, "document", {"a": "array"}).select(F.to_json("a")).first()
    assert row[0] == '[null,null,null,null,null,"1970-01-01T00:00:00.005Z"]'


def test_the_whole_scope_of_code_is_kept(spark):
    docs = spark.createDataFrame([('{"a":{"$code":"f","$scope":{"x":{"$numberInt":"1"},"scope":2}}}',)], "document string")
    row = documents.normalize(docs, "document", {"a": "object"}).select(F.to_json("a")).first()
    assert json.loads(row[0]) == {"code": "f", "scope": {"x": 1, "scope": 2}}


def test_simple_wrappers_are_replaced_as_text(spark):
    values = ['{"$oid":"ab"}', '{ "$symbol" : "a\\"}b" }', '{"$numberLong":"-5"}', '{"$numberInt":"0"}', '{"$numberDouble":"2.25"}', '"{\\"$oid\\":\\"x\\"}"']
    odd = ['{"$numberDouble":"1e400"}', '{"$numberDouble":"2.50"}', '{"$numberDouble":"NaN"}', '{"$numberLong":"05"}', '{"$date":1}']
    docs = spark.createDataFrame([(v,) for v in values + odd], "v string")
    found = [r[0] for r in docs.select(extjson.native_texts(F.col("v"))).collect()]
    assert found == ['"ab"', '"a\\"}b"', "-5", "0", "2.25", values[5], *odd]
    # The same value as when read, for every one of them.
    assert [json.loads(f) for f in found[:6]] == [json.loads(plain_text(v)) for v in values]


def test_schemaless_discovery_takes_the_most_frequent_id_type(spark, rows):
    texts = ['{"_id":1}', '{"_id":"a"}', '{"_id":"b"}']
    docs = spark.createDataFrame([(t,) for t in texts], "document string")
    assert rows(documents.discover_packed(docs, "document")) == [("_id", "string")]
    assert rows(documents.discover_packed(docs.limit(0), "document")) == []


ODD = [
    {"$date": "2020-02-29"}, {"$date": "2020-02-29T23:59:59"}, {"$date": "2020-02-29T23:59:59.123456+05:30"}, {"$date": -1}, {"$date": None},
    {"$date": {"$numberLong": "253402300800000"}}, {"$date": "never"}, {"$timestamp": {"t": 1, "i": 2}}, {"$timestamp": {"t": 1}},
    {"$binary": {"subType": "04", "base64": "AQID"}}, {"$binary": "AQID", "$type": "00"}, {"$binary": {}}, {"$uuid": "00112233-4455-6677-8899-aabbccddeeff"},
    {"$uuid": "xyz"}, {"$regularExpression": {"options": "im", "pattern": 'a{2}"\\'}}, {"$regex": "^{x}$", "$options": ""}, {"$options": "x", "$regex": "b"},
    {"$regularExpression": {"options": "i"}}, {"$code": 'f = "{\\"a\\": 1}";\n' * 50}, {"$code": "g", "$scope": {"a": [{"$oid": "x"}], "b": {"c": {"$minKey": 1}}}},
    {"$minKey": 1}, {"$maxKey": 1}, {"$undefined": True}, {"$dbPointer": {"$ref": "a.b", "$id": {"$oid": "ff"}}}, {"$symbol": 'q"\\'}, {"$oid": "aa"},
    {"$numberInt": "+7"}, {"$numberLong": "007"}, {"$numberLong": "x"}, {"$numberDouble": "NaN"}, {"$numberDouble": "-Infinity"}, {"$numberDouble": "1e400"},
    {"$numberDouble": "12345678.9"}, {"$numberDouble": "0.00012"}, {"$numberDouble": "-0.0"}, {"$numberDecimal": "2.50"}, {"$numberDecimal": "1234567890.12345678901234"},
    {"$numberDouble": "5"}, {"$numberDouble": "soon"}, "$date", '{"$date":5}', "\\", '"', ",", ":", "a{", None, True, 1.5, [], {}, "Ünïcode\u0001\u2028",
]


def test_every_wrapper_against_reading(spark):
    import random

    rng = random.Random(1)

    def value(depth):
        if depth and rng.random() < 0.4:
            return [value(depth - 1) for _ in range(rng.randint(0, 4))]
        if depth and rng.random() < 0.5:
            return {rng.choice(["a", "b", 'q"', "c,", ":", "$x", "\\", "d{"]): value(depth - 1) for _ in range(rng.randint(0, 4))}
        return rng.choice(ODD)

    texts = [json.dumps(x, **how) for x in ODD for how in ({}, {"separators": (",", ":"), "ensure_ascii": False}, {"indent": 1})]
    texts += [json.dumps(value(4), indent=rng.choice([None, 2])) for _ in range(1500)]
    docs = spark.createDataFrame([(n, t, u) for n, t in enumerate(texts) for u in ("raw", "seconds")], "n int, v string, unit string")
    text = F.when(F.col("unit") == "raw", extjson.plain_texts(F.col("v"))).otherwise(extjson.plain_texts(F.col("v"), "seconds"))
    for n, unit, found in docs.select("n", "unit", text).collect():
        assert json.loads(found) == json.loads(plain_text(texts[n], unit)), texts[n]


def test_long_strings_and_many_escapes(spark):
    long = {"a": {"$code": 'x = "\\n";\n' * 20000}, "b": ['"' * 50000, {"$date": 5}], "c": [{"$date": n} for n in range(3000)]}
    docs = spark.createDataFrame([(json.dumps(long),)], "v string")
    found = docs.select(extjson.plain_texts(F.col("v"))).first()[0]
    assert json.loads(found) == json.loads(plain_text(json.dumps(long)))


def test_no_python_runs(docs):
    for df in (documents.normalize(docs, "document", dict.fromkeys(FIELDS, "string")), documents.pack(docs, "document")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan


def test_fields_of_shapes(spark):
    names = ["a", "b c", "d`e", "f:g", "h,i", "j<k>", "$l", "`", "", "ünï", "m.n", "7"]
    texts = [json.dumps({n: v for n in names}) for v in ODD + [{"x": {"y": [1.25, "z"]}}, [[1], {"a": None}]]] + ["{}", "5", "[1]"]
    docs = spark.createDataFrame([(t,) for t in texts], "document string")
    fields = spark.tvf.variant_explode(F.col("v").outer())
    each = docs.select(F.parse_json("document").alias("v")).where("schema_of_variant(v) like 'OBJECT%'").lateralJoin(fields)
    want = each.where("key is not null").groupBy("key", extjson.json_type(F.col("value")).alias("type")).count()
    shapes = documents.shape_fields(documents.discover_shapes(docs, "document"))
    got = shapes.groupBy("field", "type").agg(F.sum("documents").alias("count"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() > 30


def test_shapes_are_counted_before_they_are_taken_apart(spark):
    docs = spark.range(3000).selectExpr("""concat('{"_id":', id, ',"p":', id, '.', id % 97, if(id % 3 = 0, ',"q":"x"}', '}')) as document""")
    shapes = documents.discover_shapes(docs, "document")
    assert sorted(r["documents"] for r in shapes.collect()) == [1000, 2000]
    assert documents.shape_fields(shapes).count() == 5
