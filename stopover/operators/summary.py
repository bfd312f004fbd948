"""Itinerary summary: one row per leg, from nested legs or from flat segments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopover.functions.stops import intermediate_stops, layover_text, stop_count
from stopover.operators.distinct import distinct_rows
from stopover.schema import SUMMARY_COLUMNS

#: What tells one leg of one itinerary from another.
LEG_KEYS = ["fetch_date", "itinerary_id", "leg_id", "leg_pos"]

#: What tells the versions of an itinerary apart that lie in several files or records of a day.
#: Positions begin anew in every record, so the content counts as well.
COPY_KEYS = ["file_path", "itinerary_pos", "itinerary_hash"]

#: The looser identity by price text and departure, under which unlike
#: itineraries of one day may fall together.
PRICE_KEYS = ["fetch_date", "formattedPrice", "departure"]

#: Order of all segments of a day, as they stand in its files.
SEGMENT_ORDER = ["file_path", "itinerary_pos", "itinerary_id", "leg_pos", "seg_pos"]

def summarise_legs(legs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Summary of each row's ``segments`` array; a narrow job without a shuffle.

    Legs without segments give no row. ``carry`` names further columns to keep,
    such as the leg's keys.
    """
    first = F.get("segments", F.lit(0))
    last = F.get("segments", F.size("segments") - 1)
    summary = legs.where(F.size("segments") > 0).withColumns({
        "flightNumber": first["flightNumber"],
        "marketingCarrier": first["marketingCarrier"]["name"],
        "operatingCarrier": first["operatingCarrier"]["name"],
        "origin": first["origin"]["displayCode"],
        "destination": last["destination"]["displayCode"],
        "_visited": F.col("segments.destination.displayCode"),
    })
    return _with_stops(summary).select(*(carry or []), *SUMMARY_COLUMNS)


def summarise_groups(
    segments: DataFrame, keys: list[str], position: list[str], carry: list[str]
) -> DataFrame:
    """End points and stops per group of ``keys``, and ``carry`` of its first segment.

    No group is gathered: a first aggregation leaves one row per group and
    airport, with the places where that airport comes first and last, and
    begins before anything is shuffled. A leg, which has as many places as the array
    it came from, is one row from the start, and is shuffled once.
    """
    of_legs = set(LEG_KEYS) <= set(keys) and position == ["seg_pos"]
    by = _by_leg if of_legs else _by_airport
    return _with_stops(by(segments, keys, position, carry))


def _by_leg(
    segments: DataFrame, keys: list[str], position: list[str], carry: list[str]
) -> DataFrame:
    """``_by_airport`` for legs: the airport of every place, copies of it once."""
    head, end = F.struct(*position, "originCode", *carry), F.struct(*position, "destinationCode")
    grouped = segments.groupBy(*keys).agg(
        F.min(head).alias("_head"), F.max(end).alias("_end"),
        F.sort_array(F.collect_set(end)).alias("_seen"))
    return grouped.select(
        *keys,
        *[F.col(f"_head.{c}").alias(c) for c in carry],
        F.col("_head.originCode").alias("origin"),
        F.col("_end.destinationCode").alias("destination"),
        F.array_distinct("_seen.destinationCode").alias("_visited"),
    )


def _by_airport(
    segments: DataFrame, keys: list[str], position: list[str], carry: list[str]
) -> DataFrame:
    airports = segments.groupBy(*keys, F.col("destinationCode").alias("_code")).agg(
        F.min(F.struct(*position, "originCode", *carry)).alias("_head"),
        F.max(F.struct(*position)).alias("_last"),
    )
    first = F.struct(*[F.col(f"_head.{p}") for p in position])
    grouped = airports.groupBy(*keys).agg(
        F.min("_head").alias("_head"),
        F.max(F.struct("_last", "_code")).alias("_end"),
        F.sort_array(F.collect_list(F.struct(first.alias("_first"), "_code"))).alias("_seen"),
    )
    return grouped.select(
        *keys,
        *[F.col(f"_head.{c}").alias(c) for c in carry],
        F.col("_head.originCode").alias("origin"),
        F.col("_end._code").alias("destination"),
        F.col("_seen._code").alias("_visited"),
    )


def summarise_segments(segments: DataFrame, keys: list[str], position: list[str]) -> DataFrame:
    """The summary from flat segments, grouped by ``keys``, in order of ``position``."""
    of_first = [c for c in SUMMARY_COLUMNS if c in segments.columns and c not in keys]
    further = [k for k in keys if k not in SUMMARY_COLUMNS]
    groups = summarise_groups(segments, keys, position, of_first)
    return groups.select(*further, *SUMMARY_COLUMNS)


def _with_stops(groups: DataFrame) -> DataFrame:
    stops = intermediate_stops(F.col("_visited"), F.col("origin"), F.col("destination"))
    return (
        groups.withColumn("_stops", stops)
        .withColumn("layover", layover_text(F.col("_stops")))
        .withColumn("numStops", stop_count(F.col("_stops")))
        .drop("_visited", "_stops")
    )


def first_by_position(
    segments: DataFrame, keys: list[str], value: str, position: list[str], name: str
) -> DataFrame:
    """The value at the lowest position of each group."""
    return segments.groupBy(*keys).agg(F.min_by(value, F.struct(*position)).alias(name))


def last_by_position(
    segments: DataFrame, keys: list[str], value: str, position: list[str], name: str
) -> DataFrame:
    """The value at the highest position of each group."""
    return segments.groupBy(*keys).agg(F.max_by(value, F.struct(*position)).alias(name))


def ordered_codes(segments: DataFrame) -> DataFrame:
    """All destinations of a leg in order, nulls left out.

    The groups are legs, which came out of one array of one record each, so a
    list is never longer than what one row held before. Copies of a leg are
    gathered once.
    """
    entry = F.when(F.col("destinationCode").isNotNull(), F.struct("seg_pos", "destinationCode"))
    copies = [c for c in COPY_KEYS if c in segments.columns]
    return segments.groupBy(*LEG_KEYS, *copies).agg(
        F.sort_array(F.collect_set(entry))["destinationCode"].alias("layovers"))


def distinct_segments(segments: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct rows of ``columns``, with the constant ``layover`` 0."""
    alike = [c for c in ("fetch_date", "departure") if c in columns]
    return distinct_rows(segments.select(*columns), alike).withColumn("layover", F.lit(0))
