"""Fields of landed records against a plain walk over the parsed JSON."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stopover.schema import FULL_ENVELOPE
from stopover.sources.drift import record_shapes, schema_drift, shape_paths
from tests.landed import write_golden

COLUMNS = ["path", "type", "state", "first_day", "last_day", "records"]


def drift(spark, base, schema, **options):
    rows = schema_drift(shape_paths(record_shapes(spark, str(base), **options)), schema)
    return sorted((tuple(r) for r in rows.select(*COLUMNS).collect()), key=repr)


def put(base, day, text, name="a.json"):
    (base / day).mkdir(parents=True, exist_ok=True)
    (base / day / name).write_text(text)


def test_states(spark, tmp_path):
    put(tmp_path, "2031-01-01", '{"a": 1, "b": {"c": "x"}, "n": null}\nno json\n{"a": 2.5, "l": [1]}\n')
    put(tmp_path, "2031-01-02", '{"a": "one", "b": {"c": 7, "new `field`": [{"x.y": true}]}}\n')
    assert drift(spark, tmp_path, "a bigint, b struct<c:string>, l array<bigint>, gone double") == [
        ("a", "bigint", "read", "2031-01-01", "2031-01-01", 1),
        ("a", "double", "other type", "2031-01-01", "2031-01-01", 1),
        ("a", "string", "other type", "2031-01-02", "2031-01-02", 1),
        ("b", "object", "read", "2031-01-01", "2031-01-02", 2),
        ("b.c", "bigint", "read", "2031-01-02", "2031-01-02", 1),
        ("b.c", "string", "read", "2031-01-01", "2031-01-01", 1),
        ("b.new `field`", "array", "not read", "2031-01-02", "2031-01-02", 1),
        ("b.new `field`.x.y", "boolean", "not read", "2031-01-02", "2031-01-02", 1),
        ("gone", "double", "never found", None, None, 0),
        ("l", "array", "read", "2031-01-01", "2031-01-01", 1),
        ("n", "void", "not read", "2031-01-01", "2031-01-01", 1)]


def test_landed_responses_have_fields_that_come_and_go(spark, tmp_path):
    rows = {(path, kind): (state, first, last, n) for path, kind, state, first, last, n in
            drift(spark, write_golden(tmp_path), FULL_ENVELOPE)}
    assert rows["data.itineraries.legs.carriers.operating", "array"] == (
        "read", "2031-07-03", "2031-07-03", 1)
    assert rows["data.itineraries", "array"] == ("read", "2031-07-01", "2031-07-03", 3)
    assert rows["data.messages", "array"][0] == "not read"
    assert rows["data.itineraries.tags", "array"][0] == "never found"
    assert not [row for row in rows.values() if row[0] == "other type"]


def test_whole_files_and_nothing(spark, tmp_path):
    put(tmp_path, "2031-01-01", '[\n{"a": 1},\n{"b": [[{"c": 2}]]}\n]')
    assert [r[:2] for r in drift(spark, tmp_path, "a bigint", multi_line=True)] == [
        ("a", "bigint"), ("b", "array"), ("b.c", "bigint")]
    put(tmp_path / "none", "2031-01-01", "")
    assert drift(spark, tmp_path / "none", "a int") == [("a", "bigint", "never found", None, None, 0)]


names = st.text(st.characters(codec="utf-8", exclude_characters="\x00", exclude_categories=["Cs"]),
                min_size=1, max_size=4)
leaves = st.one_of(st.booleans(), st.integers(-5, 5), st.text(max_size=3))
values = st.recursive(leaves, lambda inner: st.dictionaries(names, inner, max_size=3), max_leaves=8)


def walk(value, prefix=""):
    for name, inner in value.items():
        kind = {bool: "boolean", int: "bigint", str: "string", dict: "object"}[type(inner)]
        yield f"{prefix}{name}", kind
        if isinstance(inner, dict):
            yield from walk(inner, f"{prefix}{name}.")


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.dictionaries(names, values, max_size=3), min_size=1, max_size=30))
def test_paths_are_those_of_a_plain_walk(spark, tmp_path_factory, records):
    base = tmp_path_factory.mktemp("drift")
    put(base, "2031-01-01", "\n".join(map(json.dumps, records)))
    want = {}
    for record in records:
        for field in {*walk(record)}:
            want[field] = want.get(field, 0) + 1
    got = shape_paths(record_shapes(spark, str(base))).groupBy("path", "type").agg(
        F.sum("records").alias("n")).collect()
    assert {(r.path, r.type): r.n for r in got} == want
