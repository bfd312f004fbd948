"""Incremental runs over a landing folder.

Two are file streams that end when caught up, without state: every record is shaped
on its own. The third compares the files with those of its last run, and so sees
files that were replaced under their old path or removed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopover.operators.flatten import explode_itineraries, explode_legs, flatten_segments
from stopover.operators.summary import LEG_KEYS, summarise_legs
from stopover.schema import ENVELOPE
from stopover.session import staged
from stopover.sources.manifest import open_manifest
from stopover.sources.sinks import drop_days, replace_snapshots
from stopover.sources.snapshots import (
    CORRUPT, JSON_FILES, accepted, latest_itineraries, list_versions, plain_path, read_snapshots,
    with_lineage,
)


# By default a file whose time lies a week before the newest one is passed over.
MAX_FILE_AGE = "36500d"


def stream_snapshots(
    spark: SparkSession, base: str, schema: str = ENVELOPE, max_files: int | None = None
) -> DataFrame:
    """The landing folder as a stream, with the same columns as a batch read."""
    reader = (
        spark.readStream.schema(f"{schema}, {CORRUPT} string")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", JSON_FILES)
        .option("maxFileAge", MAX_FILE_AGE)
    )
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return with_lineage(reader.json(base))


def ingest_new_files(
    spark: SparkSession,
    base: str,
    target: str,
    checkpoint: str,
    schema: str = ENVELOPE,
    shape: Callable[[DataFrame], DataFrame] = lambda s: flatten_segments(accepted(s)),
    max_files: int | None = None,
    partition_by: tuple[str, ...] = ("fetch_date",),
) -> None:
    """Append what the files landed since the last run hold, each file once.

    With ``shape=rejected`` and no partition column, and a target and checkpoint
    of its own, the same keeps the records set aside. A file replaced under its
    old path is not seen again; ``sync_days`` sees it.
    """
    query = (
        shape(stream_snapshots(spark, base, schema, max_files))
        .writeStream.format("parquet")
        .partitionBy(*partition_by)
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def summarised_days(records: DataFrame) -> DataFrame:
    """Summary by leg of the latest version of each itinerary, with the keys of the leg."""
    legs = explode_legs(latest_itineraries(explode_itineraries(accepted(records))))
    return summarise_legs(legs, [c for c in LEG_KEYS if c != "fetch_date"])


def refresh_days(
    spark: SparkSession,
    base: str,
    target: str,
    checkpoint: str,
    max_files: int | None = None,
) -> None:
    """Rewrite the summary of every day that got new files, from all files of that day.

    A second file of a day may repeat itineraries, which appending would
    double. A run that fails half-way is repeated with the same result.
    """

    def rewrite(batch: DataFrame, _: int) -> None:
        folder = F.regexp_replace(plain_path(F.col("file_path")), "/[^/]+$", "")
        # Folders of days: as many as days have new files, not as many as rows.
        days = [row[0] for row in
                batch.where("fetch_date is not null").select(folder).distinct().collect()]
        if days:
            replace_snapshots(
                summarised_days(read_snapshots(batch.sparkSession, days)), target)

    query = (
        stream_snapshots(spark, base, max_files=max_files)
        .writeStream.foreachBatch(rewrite)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def file_changes(listing: DataFrame, known: DataFrame) -> DataFrame:
    """``fetch_date, file_path, change``: files that are new, changed or vanished.

    Both tables have a row per file; a file is the same if its length and time are.
    """
    before = known.select("file_path", F.struct("length", "modified").alias("before"),
                          F.col("fetch_date").alias("_day"))
    now = listing.select("file_path", F.struct("length", "modified").alias("now"), "fetch_date")
    change = (
        F.when(F.col("before").isNull(), "new").when(F.col("now").isNull(), "vanished")
        .when(F.col("before") != F.col("now"), "changed"))
    return now.join(before, "file_path", "full").select(
        F.coalesce("fetch_date", "_day").alias("fetch_date"), "file_path", change.alias("change"),
    ).where("change is not null")


def sync_days(
    spark: SparkSession,
    base: str,
    target: str,
    manifest: str,
    schema: str = ENVELOPE,
    shape: Callable[[DataFrame], DataFrame] = summarised_days,
    files: str = JSON_FILES,
) -> DataFrame:
    """Bring ``target`` up to the files that are below ``base`` now; returns what changed.

    A day is rewritten, from all of its files, if any of them is new, was replaced
    under its path, or is gone; a day without rows is removed, other days stay untouched.
    ``manifest`` holds the versions (path, length, time) that ``target`` is made of, by day.
    It is written last: a run that fails half-way is repeated with the same result, and
    a file replaced while a run reads it is taken up by the next one. Files in
    folders that are no dates are passed over. Without changes nothing is read or written.
    """
    listing = staged(
        list_versions(spark, base, files).where("fetch_date is not null"), "listing")
    changes = staged(file_changes(listing, open_manifest(spark, manifest)), "changes")
    # Here and below the driver holds days, not files.
    changed = sorted(row[0] for row in changes.select("fetch_date").distinct().collect())
    if not changed:
        return changes
    there = listing.where(F.col("fetch_date").isin(changed))
    alive = sorted(row[0] for row in there.select("fetch_date").distinct().collect())
    filled: set[str] = set()
    if alive:
        rows = staged(shape(read_snapshots(
            spark, base, schema, files=files, days=alive)), "days")
        replace_snapshots(rows, target)
        filled = {row[0] for row in rows.select("fetch_date").distinct().collect()}
    drop_days(spark, target, [day for day in changed if day not in filled])
    if alive:
        replace_snapshots(there.select("file_path", "length", "modified", "fetch_date"), manifest)
    drop_days(spark, manifest, [day for day in changed if day not in alive])
    return changes
