"""From envelopes to itineraries, legs and segments.

Each level keeps the position of the element in its array, so that order needs
no guessing later, and the ids that tell an itinerary and a leg apart; a hash of
its content tells versions of an itinerary apart. No step
shuffles. A record without elements gives no row, as an explode does; with
``outer`` it gives one row of nulls.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_LINEAGE = ["fetch_date", "search_date", "file_path", "landed_at"]


def _kept(df: DataFrame, columns: list[str]) -> list[str]:
    return [c for c in columns if c in df.columns]


def explode_itineraries(envelopes: DataFrame, outer: bool = False) -> DataFrame:
    generate = F.posexplode_outer if outer else F.posexplode
    return envelopes.select(
        *_kept(envelopes, _LINEAGE),
        generate("data.itineraries").alias("itinerary_pos", "itinerary"),
    ).select(
        *_kept(envelopes, _LINEAGE),
        F.col("itinerary.id").alias("itinerary_id"),
        "itinerary_pos",
        F.xxhash64("itinerary.id", "itinerary.price.formatted", "itinerary.legs")
        .alias("itinerary_hash"),
        F.col("itinerary.price.formatted").alias("formattedPrice"),
        F.col("itinerary.legs").alias("legs"),
    )


def explode_legs(itineraries: DataFrame, outer: bool = False) -> DataFrame:
    generate = F.posexplode_outer if outer else F.posexplode
    carried = [c for c in itineraries.columns if c != "legs"]
    return itineraries.select(*carried, generate("legs").alias("leg_pos", "leg")).select(
        *carried,
        F.col("leg.id").alias("leg_id"),
        "leg_pos",
        F.col("leg.departure").alias("departure"),
        F.col("leg.arrival").alias("arrival"),
        F.col("leg.durationInMinutes").alias("duration"),
        F.col("leg.segments").alias("segments"),
    )


def explode_segments(legs: DataFrame, outer: bool = False) -> DataFrame:
    generate = F.posexplode_outer if outer else F.posexplode
    carried = [c for c in legs.columns if c != "segments"]
    return legs.select(*carried, generate("segments").alias("seg_pos", "segment"))


def flatten_segments(envelopes: DataFrame) -> DataFrame:
    """The flat segment table: ten columns of the segment and its leg, keys, own times.

    ``departure``, ``arrival`` and ``duration`` are the leg's; the segment's
    own times are ``seg_departure`` and ``seg_arrival``.
    """
    return segment_columns(explode_segments(explode_legs(explode_itineraries(envelopes))))


def segment_columns(segments: DataFrame) -> DataFrame:
    """The needed fields of exploded segments, as columns."""
    return segments.select(
        *[c for c in segments.columns if c != "segment"],
        F.col("segment.flightNumber").alias("flightNumber"),
        F.col("segment.marketingCarrier.name").alias("marketingCarrier"),
        F.col("segment.operatingCarrier.name").alias("operatingCarrier"),
        F.col("segment.origin.displayCode").alias("originCode"),
        F.col("segment.destination.displayCode").alias("destinationCode"),
        F.col("segment.departure").alias("seg_departure"),
        F.col("segment.arrival").alias("seg_arrival"),
    )


def explode_records(responses: DataFrame, records: str = "people") -> DataFrame:
    """One row per entry of a record list, all other columns carried along."""
    carried = [c for c in responses.columns if c != records]
    return responses.select(*carried, F.inline(records))


def with_record_count(responses: DataFrame, records: str = "people") -> DataFrame:
    """Add the number of entries the list really has, next to the declared one."""
    return responses.withColumn("listed", F.array_size(records))
