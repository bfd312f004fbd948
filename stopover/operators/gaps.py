"""Gaps between consecutive rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stopover.functions.times import gap_minutes, local_time, minutes_between
from stopover.operators.numbering import following, same_keys
from stopover.operators.summary import COPY_KEYS, LEG_KEYS
from stopover.session import staged


def lead_in_order(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    values: dict[str, str],
    spread: bool = True,
) -> DataFrame:
    """Add, per group of ``keys``, values of the next row in ``order``.

    ``values`` maps new column names to the columns they are read from. The
    ``order`` columns should be unique within a group; ties come in any order.

    Rows are cut into ranges, whatever the size of a group, and the last row of
    a range takes its values from the first row of the next one. A caller who
    knows that no group is large may ask for a plain window with ``spread=False``.
    """
    if spread:
        return _lead_over_ranges(df, keys, order, values)
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumns({n: F.lead(c).over(window) for n, c in values.items()})


def _lead_over_ranges(
    df: DataFrame, keys: list[str], order: list[str], values: dict[str, str]
) -> DataFrame:
    # Written out, since the first rows of the ranges are needed beside all rows.
    ahead = following(df, keys, order, {f"_{n}": c for n, c in values.items()})
    rows = staged(ahead, "ranges", "zstd")
    # One row per range, so never more rows than there are shuffle partitions.
    heads = rows.where("_first").select(
        F.lag("_range").over(Window.orderBy("_range")).alias("_before"),
        F.struct(*keys).alias("_head"),
        F.struct(*[F.col(c).alias(n) for n, c in values.items()]).alias("_values"))
    joined = rows.join(
        F.broadcast(heads.where("_before is not null")),
        F.col("_last") & (F.col("_range") == F.col("_before")) & same_keys(keys, "_head"), "left")
    return joined.select(*df.columns, *[
        F.when(F.col("_last"), F.col(f"_values.{n}")).otherwise(F.col(f"_{n}")).alias(n)
        for n in values])


def flight_gaps(segments: DataFrame, order: list[str], spread: bool = True) -> DataFrame:
    """Minutes from a segment's arrival to the next departure under its flight number.

    Runs over all itineraries and days; ``order`` starts with the departure
    and goes on with what makes it unique. Text times are parsed as local times.
    """
    ahead = lead_in_order(
        segments, ["flightNumber"], order,
        {"next_departure": "departure", "next_arrival": "arrival"}, spread)
    gap = gap_minutes(local_time(F.col("arrival")), local_time(F.col("next_departure")))
    return ahead.withColumn("layover_duration", gap)


def leg_connections(legs: DataFrame) -> DataFrame:
    """Wait at each stop of a leg, from its ``segments`` array; no shuffle.

    One row per segment that has a successor.
    """
    return _connections(legs.select(
        *LEG_KEYS,
        F.col("segments.destination.displayCode").alias("_airports"),
        F.col("segments.arrival").alias("_arrivals"),
        F.col("segments.departure").alias("_departures"),
    ))


def segment_connections(segments: DataFrame, spread: bool = True) -> DataFrame:
    """The same from flat segments, whatever the length of a leg: each looks at the next one.

    Copies of a segment count once. ``spread`` is that of ``lead_in_order``.
    """
    copies = [c for c in COPY_KEYS if c in segments.columns]
    places = ["seg_pos", "destinationCode", "seg_arrival", "seg_departure"]
    once = segments.select(*LEG_KEYS, *copies, *places).distinct()
    ahead = lead_in_order(once, [*LEG_KEYS, *copies], places,
                          {"next_pos": "seg_pos", "next_departure": "seg_departure"}, spread)
    minutes = minutes_between(
        local_time(F.col("seg_arrival")), local_time(F.col("next_departure")))
    return ahead.where("next_pos is not null").select(
        *LEG_KEYS, "seg_pos", F.col("destinationCode").alias("airport"), minutes.alias("minutes"))


def _connections(legs: DataFrame) -> DataFrame:
    stops = F.size("_airports") - 1
    waits = F.arrays_zip(
        F.slice("_airports", 1, stops).alias("airport"),
        F.slice("_arrivals", 1, stops).alias("arrival"),
        F.slice("_departures", 2, stops).alias("departure"),
    )
    rows = legs.where(F.size("_airports") > 1).select(
        *LEG_KEYS, F.posexplode(waits).alias("seg_pos", "wait"))
    minutes = minutes_between(
        local_time(F.col("wait.arrival")), local_time(F.col("wait.departure")))
    return rows.select(
        *LEG_KEYS, "seg_pos", F.col("wait.airport").alias("airport"), minutes.alias("minutes"))
