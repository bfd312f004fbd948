"""Column functions on the stops of a leg."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what separates two stops in the layover text.
SEPARATOR = ", "


def intermediate_stops(visited: Column, origin: Column, destination: Column) -> Column:
    """Airports visited on the way, end points and nulls excluded, each once, in order."""
    return F.array_except(visited, F.array(origin, destination, F.lit(None)))


def layover_text(stops: Column) -> Column:
    return F.array_join(stops, SEPARATOR)


def stop_count(stops: Column) -> Column:
    """Number of stops; null for a null list, 0 exactly where the text is empty."""
    return F.when(layover_text(stops) == "", F.lit(0)).otherwise(F.array_size(stops))


def stop_count_from_text(layover: Column) -> Column:
    """The same number, from the layover text alone."""
    return F.when(layover == "", F.lit(0)).otherwise(F.array_size(F.split(layover, SEPARATOR)))
