"""Schemas compiled to columns."""

import json

import pytest
from pyspark.sql import functions as F

from stratalith.functions.schemas import by_shape, json_faults, shape_of

FILE = {
    "$schema": "https://json-schema.org/draft/2020-12/schema",
    "type": "object",
    "required": ["path", "size", "source"],
    "additionalProperties": False,
    "properties": {
        "path": {"$ref": "#/$defs/path"},
        "size": {"type": "integer", "minimum": 0},
        "language": {"type": ["string", "null"], "minLength": 2},
        "source": {"oneOf": [{"$ref": "#/$defs/loose"}, {"$ref": "#/$defs/packed"}]},
        "tags": {"type": "array", "minItems": 1, "maxItems": 3, "uniqueItems": True, "items": {"enum": ["a", "b", 3, None, {"x": [1, 2]}]}},
        "at": {"type": "string", "format": "date-time"},
        "pair": {"prefixItems": [{"type": "string"}, {"type": "number", "exclusiveMaximum": 1.5}], "items": {"type": "boolean"}},
        "extra": {"type": "object", "propertyNames": {"pattern": "^[a-z]+$"}, "minProperties": 1, "additionalProperties": {"type": "integer", "multipleOf": 5}},
    },
    "if": {"required": ["language"], "properties": {"language": {"const": "ru"}}},
    "then": {"required": ["tags"]},
    "else": {"not": {"required": ["at"]}},
    "$defs": {
        "path": {"type": "string", "pattern": "^[^/].*[^/]$", "maxLength": 9},
        "loose": {"type": "object", "required": ["kind"], "properties": {"kind": {"const": "loose"}}, "additionalProperties": False},
        "packed": {"allOf": [{"type": "object"}, {"required": ["kind", "package"]}], "properties": {"kind": {"const": "packed"}}},
    },
}
OK = {"path": "a/b", "size": 3, "source": {"kind": "loose"}}


@pytest.fixture(scope="module")
def judge(spark):
    def judge(*documents, schema=FILE):
        texts = [d if isinstance(d, str) or d is None else json.dumps(d) for d in documents]
        df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
        return [r.f for r in df.select("k", json_faults(schema, F.col("t")).alias("f")).sort("k").collect()]

    return judge


def test_valid(judge):
    assert judge(OK, OK | {"language": None}, OK | {"size": 3.0}, OK | {"tags": ["a", 3, None, {"x": [1, 2]}][:3]}, OK | {"source": {"kind": "packed", "package": 1, "more": 2}}) == [[]] * 5
    assert judge(OK | {"language": "ru", "tags": ["b"], "at": "2024-02-03T04:05:06.7+02:00"}, OK | {"pair": ["x", 1, True]}, OK | {"extra": {"k": 10}}, OK | {"path": "äöüäöüäöü"}) == [[]] * 4


def test_faults_have_paths(judge):
    assert judge([], "no json", None, '"x"', "{}") == [["$: type"], ["$: not JSON"], ["$: not JSON"], ["$: type"], ["$: required path", "$: required size", "$: required source"]]
    assert judge(OK | {"size": -1, "path": "/", "more": {"deep": 1}}) == [["$.more: not allowed", "$.path: pattern", "$.size: minimum"]]
    assert judge(OK | {"size": 3.5}, OK | {"size": "3"}, OK | {"size": None}, OK | {"path": "äöüäöüäöüä"}) == [["$.size: type"], ["$.size: type"], ["$.size: type"], ["$.path: maxLength"]]
    assert judge(OK | {"source": {"kind": "packed"}}, OK | {"source": 3}, OK | {"language": "x"}, OK | {"language": 5}) == [["$.source: oneOf"], ["$.source: oneOf"], ["$.language: minLength"], ["$.language: type"]]
    assert judge(OK | {"tags": []}, OK | {"tags": ["a", "a"]}, OK | {"tags": ["a", "z", True, {"x": [2, 1]}]}) == [["$.tags: minItems"], ["$.tags: uniqueItems"], ["$.tags: maxItems", "$.tags[1]: enum", "$.tags[2]: enum", "$.tags[3]: enum"]]
    assert judge(OK | {"pair": [1, 1.5, True, 0]}) == [["$.pair[0]: type", "$.pair[1]: exclusiveMaximum", "$.pair[3]: type"]]
    assert judge(OK | {"extra": {"A": 5, "b": 6, "c": "x"}}, OK | {"extra": {}}) == [["$.extra.A: pattern", "$.extra.b: multipleOf", "$.extra.c: type"], ["$.extra: minProperties"]]
    assert judge(OK | {"language": "ru"}, OK | {"at": "2024-02-03T04:05:06Z"}, OK | {"language": "ru", "tags": ["a"], "at": "2024-13-03T04:05:06Z"}) == [["$: required tags"], ["$: not"], ["$.at: format date-time"]]


def test_what_is_unknown_raises(spark):
    for schema in ({"colour": 3}, {"type": "string", "format": "colour"}, {"$ref": "other.json"}, {"$ref": "#/$defs/a", "$defs": {"a": {"items": {"$ref": "#/$defs/a"}}}}, {"propertyNames": {"type": "string"}}):
        with pytest.raises(ValueError):
            json_faults(schema, F.lit("{}"))


def test_status_documents(judge):
    """A closed status document with an optional part."""
    run = {"type": "object", "required": ["result", "completed_at"], "additionalProperties": False, "properties": {"result": {"enum": ["success", "failure"]}, "completed_at": {"type": "string", "format": "date-time"}}}
    status = {
        "type": "object", "required": ["release", "last_run"], "additionalProperties": False,
        "properties": {"release": {"type": ["string", "null"]}, "last_run": {"anyOf": [{"type": "null"}, run]}, "retry": {"type": "object", "required": ["release"]}},
        "if": {"properties": {"last_run": {"type": "object", "properties": {"result": {"const": "failure"}}, "required": ["result"]}}}, "then": {"required": ["retry"]},
    }
    done = {"result": "success", "completed_at": "2024-01-01T00:00:00Z"}
    assert judge({"release": None, "last_run": done}, {"release": "1", "last_run": done | {"result": "failure"}}, {"release": "1", "last_run": done | {"x": 1}}, {"last_run": None, "other": 1}, schema=status) == [
        [], ["$: required retry"], ["$.last_run: anyOf"], ["$.other: not allowed", "$: required release"],
    ]


def test_dispatch_by_shape(spark):
    shapes = {"counts": {"type": "object", "required": ["counts"]}, "list": {"type": "array", "items": {"type": "integer"}}}
    docs = spark.createDataFrame([(1, '{"counts": {"n": 4}}'), (2, "[1, 2, 3]"), (3, '["x"]'), (4, None), (5, "bad")], "k int, t string")
    doc = F.try_parse_json("t")
    stats = by_shape(doc, {
        "counts": (shapes["counts"], {"n": F.try_variant_get(doc, "$.counts.n", "long")}),
        "list": (shapes["list"], {"items": F.size(F.try_variant_get(doc, "$", "array<long>")), "first": F.try_variant_get(doc, "$[0]", "long")}),
    })
    got = {r.k: (r.name, r.stats) for r in docs.select("k", shape_of(doc, shapes).alias("name"), stats.alias("stats")).collect()}
    assert got == {1: ("counts", {"n": 4.0}), 2: ("list", {"items": 3.0, "first": 1.0}), 3: (None, {}), 4: (None, {}), 5: (None, {})}


def test_a_document_is_read_once(spark):
    """A document that costs much to make is made once, however many rules judge it; its whole schema is not made for one kind."""
    from stratalith.functions import schemas

    schema = {"type": "object", "required": ["a"], "properties": {"a": {"type": ["array", "object"], "items": {"type": "integer"}, "minProperties": 1}}}
    texts = ['{"a":[1,"x"]}', '{"a":{}}', '{"a":{"b":1}}', '{"a":3}', "[]", "{", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = df.select("i", schemas.json_faults(schema, F.col("t")).alias("f"))
    plan = found._jdf.queryExecution().analyzed().toString()
    assert plan.count("try_parse_json(t#") == 1
    assert [r.f for r in found.orderBy("i").collect()] == [["$.a[1]: type"], ["$.a: minProperties"], [], ["$.a: type"], ["$: type"], ["$: not JSON"], ["$: not JSON"]]
