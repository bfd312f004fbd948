import json
import gzip
import os
from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stopover.operators.flatten import explode_itineraries, flatten_segments
from stopover.schema import FULL_ENVELOPE, align_to, describe_paths, has_path, schema_paths
from stopover.sources.snapshots import (
    accepted, discover_snapshots, latest_itineraries, merge_report,
    missing_snapshots, outcome_report, read_id_lists, read_snapshots, rejected, snapshot_report,
    passing_over, snapshot_states, union_by_name, unreadable_files,
)
from tests.landed import envelope, itinerary, land, leg


def values(df):
    return sorted(tuple(r) for r in df.collect())


def test_one_scan_tags_day_and_search_date(spark, landing):
    rows = read_snapshots(spark, landing).select("fetch_date", "search_date").collect()
    assert sorted(rows, key=str) == [
        ("2031-07-01", None), ("2031-07-02", None), ("2031-07-03", "2031-07-24")]


def test_folder_named_like_a_partition_is_a_day_too(spark, tmp_path):
    base = land(tmp_path / "p", "fetch_date=2025-04-01", "a.json", envelope([]))
    assert values(read_snapshots(spark, base).select("fetch_date")) == [("2025-04-01",)]


def test_empty_day_neither_breaks_the_merge_nor_adds_rows(spark, landing):
    records = accepted(read_snapshots(spark, landing))
    assert records.count() == 3
    assert flatten_segments(records).count() == 41
    assert flatten_segments(records).where("fetch_date = '2031-07-01'").count() == 0


def test_full_schema_reads_drifting_fields(spark, landing):
    records = read_snapshots(spark, landing, FULL_ENVELOPE)
    legs = records.select(
        "fetch_date", F.explode(F.flatten("data.itineraries.legs")).alias("leg"))
    operated = legs.where("leg.carriers.operating is not null").select(
        "fetch_date", F.col("leg.carriers.operating")[0]["name"])
    assert values(operated) == [("2031-07-03", "Carrier X")]


def test_report_tells_the_failed_search(spark, landing):
    report = snapshot_report(accepted(read_snapshots(spark, landing)))
    assert values(report) == [
        ("2031-07-01", 1, 0, "failure", True),
        ("2031-07-02", 1, 10, "incomplete", False),
        ("2031-07-03", 1, 10, "incomplete", False)]


def test_missing_days(spark, landing):
    expected = spark.createDataFrame([("2031-07-02",), ("2031-07-04",)], "fetch_date string")
    found = accepted(read_snapshots(spark, landing))
    assert values(missing_snapshots(expected, found)) == [("2031-07-04",)]
    assert values(snapshot_states(expected, found)) == [
        ("2031-07-01", 0, "failure", "empty"), ("2031-07-02", 10, "incomplete", "full"),
        ("2031-07-03", 10, "incomplete", "full"), ("2031-07-04", 0, "", "missing")]


def test_faults_are_set_aside_with_their_reason(spark, landing, tmp_path):
    base = tmp_path / "landed"
    (base / "2031-07-02" / "cut.json").write_text('{"status": true, "data": {"itin')
    wrong = envelope([itinerary("x", [leg("l", ["A", "B"])])])
    wrong["data"]["itineraries"][0]["legs"][0]["durationInMinutes"] = "long"
    land(base, "2031-07-03", "wrong_type.json", wrong)
    land(base, "undated", "data.json", envelope([]))
    land(base, "2025-13-45", "no_such_day.json", envelope([]))
    (base / "2031-07-01" / "bare.json").write_text('{"message": "no body"}\n')
    snapshots = read_snapshots(spark, landing)
    assert flatten_segments(accepted(snapshots)).count() == 41
    found = rejected(snapshots).select(
        F.element_at(F.split("file_path", "/"), -1), "reason", F.col("record").isNotNull())
    assert values(found) == [
        ("bare.json", "no result body", False),
        ("cut.json", "malformed record", True),
        ("data.json", "folder is not a date", False),
        ("no_such_day.json", "folder is not a date", False),
        ("wrong_type.json", "malformed record", True)]
    assert tuple(merge_report(snapshots).first()) == (3, 5, True)
    assert rejected(snapshots).count() == 5
    assert values(outcome_report(snapshots)) == [
        ("2031-07-01", "accepted", 1), ("2031-07-01", "no result body", 1),
        ("2031-07-02", "accepted", 1), ("2031-07-02", "malformed record", 1),
        ("2031-07-03", "accepted", 1), ("2031-07-03", "malformed record", 1),
        ("none", "folder is not a date", 2)]


def test_discovery_lists_days_without_reading(spark, landing, tmp_path):
    land(tmp_path / "landed", "undated", "data.json", envelope([]))
    land(tmp_path / "landed", "2031-07-02", "second.json", envelope([]))
    found = discover_snapshots(spark, landing)
    assert sorted(map(tuple, found.collect()), key=str) == [
        ("2031-07-01", 1), ("2031-07-02", 2), ("2031-07-03", 1), (None, 1)]
    assert "content" not in found._jdf.queryExecution().executedPlan().toString()


def test_unreadable_file_fails_the_job_or_is_left_out_whole(spark, landing, tmp_path):
    """A file cut off in the middle gives no half result."""
    lines = (tmp_path / "landed" / "2031-07-02" / "result.json").read_bytes()
    packed = gzip.compress(os.urandom(64).hex().encode().join([lines] * 300), 1)
    broken = tmp_path / "landed" / "2031-07-02" / "cut off.json.gz"
    broken.write_bytes(packed[:len(packed) // 2])
    (tmp_path / "landed" / "2031-07-03" / "none.json.gz").write_bytes(b"this is not compressed")

    def rows(exclude):
        read = read_snapshots(spark, landing, files="*.json*", exclude=exclude)
        return flatten_segments(accepted(read)).count()

    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        rows([])
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        passing_over(rows, most=1)
    found, lost = passing_over(rows, most=2)
    assert found == 41
    told = unreadable_files(spark, lost).collect()
    assert sorted(unquote(r.file_path).rsplit("/", 1)[1] for r in told) == [
        "cut off.json.gz", "none.json.gz"]
    assert {r.reason for r in told} == {"file cannot be read"}
    with pytest.raises(ZeroDivisionError):
        passing_over(lambda bad: 1 // 0, most=5)


def test_days_are_read_without_the_others(spark, landing, tmp_path):
    land(tmp_path / "landed", "fetch_date=2031-08-01", "a.json", envelope([]))
    some = read_snapshots(spark, landing, days=["2031-07-02", "2031-08-01"])
    assert len(some.inputFiles()) == 2
    assert {r.fetch_date for r in some.collect()} == {"2031-07-02", "2031-08-01"}


def test_second_file_of_a_day_counts_once(spark, tmp_path):
    base = tmp_path / "twice"
    one = itinerary("a", [leg("a", ["X", "Y"])], "100")
    again = itinerary("a", [leg("a", ["X", "Y"])], "200")
    land(base, "2025-01-01", "1.json", envelope([one, itinerary("b", [])]))
    land(base, "2025-01-01", "2.json", envelope([again]))
    land(base, "2025-01-02", "1.json", envelope([one]))
    for name, when in (("2025-01-01/1.json", 1000), ("2025-01-01/2.json", 2000)):
        os.utime(base / name, (when, when))
    kept = latest_itineraries(explode_itineraries(accepted(read_snapshots(spark, str(base)))))
    assert values(kept.select("fetch_date", "itinerary_id", F.regexp_extract(
        "formattedPrice", r"\d+", 0))) == [
        ("2025-01-01", "a", "200"), ("2025-01-01", "b", "100"), ("2025-01-02", "a", "100")]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2, "copies are cut before the shuffle too"


def test_itineraries_without_id_are_copies_only_if_alike(spark, tmp_path):
    base, two = tmp_path / "noid", [leg("a", ["X", "Y"])]
    land(base, "2025-01-01", "1.json", envelope([itinerary(None, two, "1")]),
         envelope([itinerary(None, two, "2"), itinerary(None, [], "2")]))
    land(base, "2025-01-01", "2.json", envelope([itinerary(None, two, "2")]))
    kept = latest_itineraries(explode_itineraries(accepted(read_snapshots(spark, str(base)))))
    assert values(kept.select(F.regexp_extract("formattedPrice", r"\d+", 0), F.size("legs"))) == [
        ("1", 1), ("2", 0), ("2", 1)]


def test_filter_on_the_day_leaves_other_files_unread(spark, landing):
    day = read_snapshots(spark, landing).where("fetch_date = '2031-07-02'").select("data")
    assert len(day.collect()) == 1 and len(day.inputFiles()) == 3
    scan = day._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert scan.metrics().apply("numFiles").value() == 1


def test_multi_line_files(spark, tmp_path):
    base = tmp_path / "pretty"
    (base / "2025-01-01").mkdir(parents=True)
    made = envelope([itinerary("a", [leg("a", ["X", "Y", "Z"])])])
    (base / "2025-01-01" / "one.json").write_text(json.dumps(made, indent=2))
    (base / "2025-01-01" / "list.json").write_text(json.dumps([made, made], indent=2))
    records = accepted(read_snapshots(spark, str(base), multi_line=True))
    assert flatten_segments(records).count() == 6


def test_nothing_valid(spark, tmp_path):
    base = land(tmp_path / "none", "undated", "a.json", envelope([]))
    assert tuple(merge_report(read_snapshots(spark, base)).first()) == (0, 1, False)


def test_id_lists(spark, tmp_path):
    path = tmp_path / "ids.csv"
    path.write_text("[30, 10, 20]\n[]\n\n")
    assert values(read_id_lists(spark, str(path))) == [(0, 30), (1, 10), (2, 20)]
    path.write_text("[30, 10\n")
    with pytest.raises(Exception, match="MALFORMED"):
        read_id_lists(spark, str(path)).collect()


def test_union_by_name_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([("y",)], "b string")
    c = spark.createDataFrame([(2.5, 3)], "c double, a int")
    got = union_by_name([a, b, c])
    assert got.columns == ["a", "b", "c"]
    assert sorted(map(tuple, got.collect()), key=str) == [
        (1, "x", None), (3, None, 2.5), (None, "y", None)]


def test_schema_paths_and_lookup(spark):
    df = spark.createDataFrame([], "a int, s struct<l:array<array<struct<x:int>>>,m:string>")
    assert [p for p, _, _ in schema_paths(df.schema)] == ["a", "s", "s.l", "s.l.x", "s.m"]
    assert has_path(df, "s.l.x") and not has_path(df, "l.x")


def test_describe_paths_counts_values_at_every_depth(spark):
    df = spark.createDataFrame(
        [(1, [{"x": 1, "y": None}, {"x": 2, "y": [5, None]}, None]), (None, None)],
        "a int, l array<struct<x:int,y:array<int>>>")
    assert {r.path: r.present for r in describe_paths(df).collect()} == {
        "a": 1, "l": 1, "l.x": 2, "l.y": 1}
    none = describe_paths(df.where("false")).collect()
    assert {r.present for r in none} == {0}


def test_align_adds_nested_nulls_and_keeps_null_structs(spark):
    df = spark.createDataFrame(
        [(1, [{"id": "a"}, None]), (2, None)], "k int, legs array<struct<id:string>>")
    want = T.StructType.fromDDL(
        "legs array<struct<id:string,carriers:struct<operating:array<struct<name:string>>>>>, "
        "k bigint, extra double")
    got = align_to(df, want)
    assert [f.dataType.simpleString() for f in got.schema] == [
        f.dataType.simpleString() for f in want]
    assert [r.asDict(True) for r in got.orderBy("k").collect()] == [
        {"legs": [{"id": "a", "carriers": None}, None], "k": 1, "extra": None},
        {"legs": None, "k": 2, "extra": None}]
