"""A table of the landed files, by day, that grows by new days only.

A landing folder has a folder per day and any number of files in each. Spark lists
all of them before a scan, on the driver. The manifest keeps what was listed: a run
lists the day folders, and the files of those days alone that it doesn't have yet, a
few days at a time. So the driver holds the days and the files of a few of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopover.sources.sinks import replace_snapshots
from stopover.sources.snapshots import (
    DATE, JSON_FILES, existing_folders, list_versions, plain_path,
)

MANIFEST = "file_path string, length bigint, modified timestamp, fetch_date string"
# Days whose files are listed in one go.
DAYS_AT_ONCE = 50


def open_manifest(spark: SparkSession, manifest: str) -> DataFrame:
    """``file_path, length, modified, fetch_date``; empty if nothing was written yet."""
    if not existing_folders(spark, f"{manifest}/fetch_date=*"):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(manifest)


def days_of(spark: SparkSession, folder: str) -> dict[str, list[str]]:
    """Day folders below ``folder``, by day; other folders and impossible dates are passed over."""
    names = [path.rsplit("/", 1) for path in existing_folders(spark, f"{folder}/*")]
    found = spark.createDataFrame(
        [(f"{parent}/{name}", name.removeprefix("fetch_date=")) for parent, name in names],
        "folder string, day string")
    days: dict[str, list[str]] = {}
    good = F.col("day").rlike(f"^{DATE}$") & F.col("day").try_cast("date").isNotNull()
    for row in found.where(good).select("day", plain_path(F.col("folder"))).collect():
        days.setdefault(row[0], []).append(row[1])
    return days


def extend_manifest(
    spark: SparkSession, base: str, manifest: str, again: list[str] | None = None,
    newest: int = 1, files: str = JSON_FILES,
) -> list[str]:
    """Add the days below ``base`` that ``manifest`` lacks; returns the days that were listed.

    The ``newest`` days that it has are listed again, since they may have been
    landing still, and so are those of ``again``. Files that came to other days
    meanwhile are not noticed; ``sync_days`` looks at all files. A day is written when
    it has been listed, so a run that fails half-way goes on where it stopped.
    """
    there, known = days_of(spark, base), sorted(days_of(spark, manifest))
    wanted = (set(there) - set(known)) | set(known[max(len(known) - newest, 0):]) | {*(again or [])}
    listed = sorted(wanted & set(there))
    for start in range(0, len(listed), DAYS_AT_ONCE):
        folders = [f for day in listed[start:start + DAYS_AT_ONCE] for f in there[day]]
        found = list_versions(spark, folders, files).where("fetch_date is not null")
        replace_snapshots(
            found.select("file_path", "length", "modified", "fetch_date"), manifest)
    return listed


def discovered(spark: SparkSession, manifest: str) -> DataFrame:
    """Days of the manifest with their number of files and bytes."""
    return open_manifest(spark, manifest).groupBy("fetch_date").agg(
        F.count("*").alias("files"), F.sum("length").alias("bytes"))
