import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stopover.functions.stops import stop_count, stop_count_from_text
from stopover.functions.text import crew_message, path_part
from stopover.operators.flatten import (
    explode_itineraries, explode_legs, explode_records, explode_segments, flatten_segments,
    with_record_count,
)
from stopover.operators.summary import (
    LEG_KEYS, PRICE_KEYS, SEGMENT_ORDER, distinct_segments, first_by_position, last_by_position,
    ordered_codes, summarise_legs, summarise_segments,
)
from stopover.schema import SEGMENT_COLUMNS, SUMMARY_COLUMNS
from stopover.sources.snapshots import accepted, read_snapshots, snapshot_report
from tests.landed import MARK, envelope, golden_summary, itinerary, land, leg


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def records(spark, base):
    return accepted(read_snapshots(spark, base))


def land_cases(base, *itineraries):
    return land(base, "2025-01-01", "a.json", envelope(list(itineraries)))


def test_golden_summary_from_nested_legs(spark, landing):
    legs = explode_legs(explode_itineraries(records(spark, landing)))
    summary = summarise_legs(legs)
    assert summary.columns == SUMMARY_COLUMNS
    assert sorted(map(tuple, summary.collect())) == golden_summary()
    assert "Exchange" not in summary._jdf.queryExecution().executedPlan().toString()


def test_golden_summary_from_flat_segments(spark, landing):
    segments = flatten_segments(records(spark, landing))
    for keys, order in ((LEG_KEYS, ["seg_pos"]),
                        (PRICE_KEYS, SEGMENT_ORDER)):
        for rows in (segments, segments.repartition(7).orderBy(F.rand(1))):
            got = summarise_segments(rows, keys, order).select(*SUMMARY_COLUMNS).collect()
            assert sorted(map(tuple, got)) == golden_summary()


def test_golden_segments(spark, landing):
    segments = flatten_segments(records(spark, landing))
    distinct = distinct_segments(segments.union(segments), SEGMENT_COLUMNS)
    assert distinct.columns == [*SEGMENT_COLUMNS, "layover"]
    assert distinct.schema["layover"].dataType.simpleString() == "int"
    assert distinct.count() == 41 and values(distinct.select("layover").distinct()) == [(0,)]


def test_segment_times_are_not_the_legs(spark, landing):
    third = flatten_segments(records(spark, landing)).where(
        "itinerary_id = 'it-0-2'").orderBy("seg_pos")
    rows = third.select("departure", "seg_departure", "duration", "flightNumber").collect()
    assert [tuple(r) for r in rows] == [
        ("2031-07-02T21:10:00", "2031-07-02T21:10:00", 1500, "100"),
        ("2031-07-02T21:10:00", "2031-07-03T07:30:00", 1500, "205"),
        ("2031-07-02T21:10:00", "2031-07-03T10:45:00", 1500, "205")]


def test_stops(spark, tmp_path):
    cases = {
        "direct": ["A", "B"],
        "stop is an end point": ["A", "X", "A", "B"],
        "stop visited twice": ["A", "X", "Y", "X", "B"],
        "round": ["A", "X", "A"],
        "null in between": ["A", None, "X", "B"],
        "null at the end": ["A", "X", None],
        "null at the start": [None, "X", "B"],
    }
    base = land_cases(tmp_path / "c", *[itinerary(n, [leg(n, c)]) for n, c in cases.items()])
    expected = {
        "direct": ("A", "B", "", 0),
        "stop is an end point": ("A", "B", "X", 1),
        "stop visited twice": ("A", "B", "X, Y", 2),
        "round": ("A", "A", "X", 1),
        "null in between": ("A", "B", "X", 1),
        "null at the end": ("A", None, "X", 1),
        "null at the start": (None, "B", "X", 1),
    }
    legs = explode_legs(explode_itineraries(records(spark, base)))
    segments = flatten_segments(records(spark, base))
    for summary in (summarise_legs(legs, ["itinerary_id"]),
                    summarise_segments(segments, LEG_KEYS, ["seg_pos"])):
        got = {r.itinerary_id: (r.origin, r.destination, r.layover, r.numStops)
               for r in summary.collect()}
        assert got == expected


def test_return_trip_gives_a_row_per_leg(spark, tmp_path):
    out, back = leg("out", ["A", "X", "B"]), leg("back", ["B", "A"], "2025-02-01T10:00:00")
    base = land_cases(tmp_path / "r", itinerary("i", [out, back]))
    legs = explode_legs(explode_itineraries(records(spark, base)))
    got = summarise_legs(legs, ["leg_id", "leg_pos"]).select("leg_id", "leg_pos", "layover")
    assert values(got) == [("back", 1, ""), ("out", 0, "X")]


def test_equal_price_and_departure(spark, tmp_path):
    """By price, two itineraries become one row; by leg, both stay."""
    base = land_cases(tmp_path / "e", itinerary("1", [leg("1", ["A", "B", "C"])]),
                      itinerary("2", [leg("2", ["A", "X", "C"])]))
    segments = flatten_segments(records(spark, base))
    merged = summarise_segments(segments, PRICE_KEYS, SEGMENT_ORDER)
    assert [(r.origin, r.destination, r.layover, r.numStops) for r in merged.collect()] == [
        ("A", "C", "B, X", 2)]
    apart = summarise_segments(segments, LEG_KEYS, ["seg_pos"]).select("itinerary_id", "layover")
    assert values(apart) == [("1", "B"), ("2", "X")]


def test_empty_lists_give_no_row_unless_outer(spark, tmp_path):
    base = land_cases(tmp_path / "o", itinerary("none", []), itinerary("one", [leg("l", ["A"])]))
    land(tmp_path / "o", "2025-01-02", "a.json", envelope([], "failure"))
    envelopes = records(spark, base)
    itineraries = explode_itineraries(envelopes)
    assert itineraries.count() == 2 and explode_itineraries(envelopes, outer=True).count() == 3
    legs = explode_legs(itineraries)
    assert legs.count() == 1 and explode_legs(itineraries, outer=True).count() == 2
    assert explode_segments(legs).count() == 0
    assert explode_segments(legs, outer=True).count() == 1
    assert summarise_legs(legs).count() == 0


def test_flat_summary_against_plain_python(spark):
    """A third of all rows in one group, positions in no order, nulls among the codes."""
    made, rng = [], random.Random(7)
    for group, size in [(0, 900)] + [(g, rng.randint(1, 12)) for g in range(1, 300)]:
        for pos in rng.sample(range(10_000), size):
            made.append((str(group), pos, rng.choice("ABCDEFG"), rng.choice([*"ABCDEFG", None]),
                         str(pos)))
    columns = ("fetch_date string, pos int, originCode string, destinationCode string, "
               "flightNumber string")
    rng.shuffle(made)
    segments = spark.createDataFrame(made, columns).repartition(6).selectExpr(
        "*", "'p' formattedPrice", "'d' departure", "1L duration", "'m' marketingCarrier",
        "'o' operatingCarrier")
    expected = []
    for group in {m[0] for m in made}:
        rows = sorted((m for m in made if m[0] == group), key=lambda m: m[1])
        origin, destination = rows[0][2], rows[-1][3]
        stops = list(dict.fromkeys(
            m[3] for m in rows if m[3] is not None and m[3] not in (origin, destination)))
        expected.append((group, rows[0][4], origin, destination, ", ".join(stops), len(stops)))
    got = summarise_segments(segments, ["fetch_date"], ["pos"]).select(
        "fetch_date", "flightNumber", "origin", "destination", "layover", "numStops")
    assert values(got) == sorted(expected, key=repr)


def test_ordered_codes_skips_nulls_and_keeps_repeats(spark, tmp_path):
    base = land_cases(tmp_path / "oc", itinerary("i", [leg("l", ["A", "X", None, "X", "B"])]))
    rows = ordered_codes(flatten_segments(records(spark, base)).repartition(5)).collect()
    assert [r.layovers for r in rows] == [["X", "X", "B"]]


def test_stop_counts(spark):
    df = spark.createDataFrame([([],), (["A"],), (["A", "B"],), (None,)], "stops array<string>")
    counts = [r[0] for r in df.select(stop_count(F.col("stops"))).collect()]
    assert counts == [0, 1, 2, None]
    text = spark.createDataFrame([("",), ("A",), ("A, B",), (None,)], "t string")
    counts = [r[0] for r in text.select(stop_count_from_text(F.col("t"))).collect()]
    assert counts == [0, 1, 2, None]


def test_record_list(spark):
    df = spark.createDataFrame(
        [(3, [("C1", "Ann"), ("C2", "Bo")]), (0, [])],
        "number int, people array<struct<craft:string,name:string>>")
    assert values(with_record_count(df).select("number", "listed")) == [(0, 0), (3, 2)]
    text = explode_records(df).select(crew_message(F.col("name"), F.col("craft")))
    assert values(text) == [("Ann is currently in space flying on the C1! Hello! :)",),
                            ("Bo is currently in space flying on the C2! Hello! :)",)]


def test_path_part(spark):
    df = spark.createDataFrame([("a/2025-01-01/f.json",), ("f",)], "p string")
    assert [tuple(r) for r in df.select(
        path_part(F.col("p"), -2), path_part(F.col("p"), -1)).collect()] == [
        ("2025-01-01", "f.json"), (None, "f")]


def test_price_keeps_its_no_break_space(spark, landing):
    prices = explode_itineraries(records(spark, landing)).select("formattedPrice").collect()
    assert all(p[0].startswith(MARK) for p in prices)


codes = st.lists(st.sampled_from(["A", "B", "C", "D", None]), min_size=2, max_size=7)


@settings(max_examples=8, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(legs=st.lists(codes, min_size=1, max_size=8), parts=st.integers(1, 5))
def test_nested_and_flat_agree_on_any_legs(spark, tmp_path_factory, legs, parts):
    """Row order and partitions do not matter; no stops exactly where the text is empty."""
    base = land_cases(tmp_path_factory.mktemp("any"), *[
        itinerary(str(i), [leg(str(i), c)]) for i, c in enumerate(legs)])
    nested = summarise_legs(
        explode_legs(explode_itineraries(records(spark, base))), ["itinerary_id"])
    segments = flatten_segments(records(spark, base)).repartition(parts)
    expected = []
    for i, c in enumerate(legs):
        stops = list(dict.fromkeys(x for x in c[1:] if x is not None and x not in (c[0], c[-1])))
        expected.append((str(i), c[0], c[-1], ", ".join(stops), len(stops)))
    columns = ["itinerary_id", "origin", "destination", "layover", "numStops"]
    for summary in (nested, summarise_segments(segments, LEG_KEYS, ["seg_pos"])):
        assert values(summary.select(*columns)) == sorted(expected, key=repr)
        assert summary.where("(layover = '') != (numStops = 0) or numStops < 0").isEmpty()


def test_first_and_last_by_position(spark):
    df = spark.createDataFrame(
        [("g", 2, "b"), ("g", 1, None), ("g", 3, "c"), ("h", 1, "x")], "k string, p int, v string")
    assert values(first_by_position(df, ["k"], "v", ["p"], "first")) == [("g", None), ("h", "x")]
    assert values(last_by_position(df, ["k"], "v", ["p"], "last")) == [("g", "c"), ("h", "x")]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_null_lists_count_as_none(spark, tmp_path, ansi):
    base = tmp_path / "null"
    failed = envelope([])
    failed["data"]["itineraries"] = None
    land(base, "2031-01-01", "a.json", failed, failed)
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        report = snapshot_report(records(spark, str(base))).collect()
        assert [(r.records, r.itineraries, r.is_empty) for r in report] == [(2, 0, True)]
        row = spark.range(1).select(
            stop_count(F.lit(None).cast("array<string>")).alias("stops"),
            stop_count_from_text(F.lit(None).cast("string")).alias("text")).first()
        assert (row.stops, row.text) == (None, None)
        people = spark.createDataFrame([(None,)], "people array<struct<name:string>>")
        assert with_record_count(people).first().listed is None
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
