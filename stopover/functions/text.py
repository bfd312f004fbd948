"""Column functions on paths and messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Message template and greeting.
MESSAGE = "%s is currently in space flying on the %s! %s"
GREETING = "Hello! :)"


def path_part(path: Column, index: int) -> Column:
    """Part of a path by position, from the end if negative; null if there is none."""
    return F.try_element_at(F.split(path, "/"), F.lit(index))


def crew_message(name: Column, craft: Column, greeting: str = GREETING) -> Column:
    return F.format_string(MESSAGE, name, craft, F.lit(greeting))
