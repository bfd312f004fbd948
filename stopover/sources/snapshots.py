"""Dated snapshot folders of JSON search responses: one scan for all of them.

Layout: ``<base>/<fetch date>/<file>.json``; a folder named
``fetch_date=<fetch date>`` is taken as well. The day comes from the path, so
no read per day and no union is needed. Spark lists the files of the whole
landing folder before a scan; a filter on ``fetch_date`` leaves other days'
files unread, and a list of days leaves their folders unlisted.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from typing import TypeVar
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stopover.functions.text import path_part
from stopover.schema import ENVELOPE

# Fixed value: form of a fetch date.
DATE = r"\d{4}-\d{2}-\d{2}"

CORRUPT = "_corrupt_record"
JSON_FILES = "*.json"
ACCEPTED = "accepted"

#: Types of the lineage columns, ``fetch_date`` aside.
LINEAGE = "search_date string, file_path string, landed_at timestamp"


def _date_or_null(text: Column) -> Column:
    return F.when(text.rlike(f"^{DATE}$") & text.try_cast("date").isNotNull(), text)


def folder_date(path: Column) -> Column:
    """Fetch date of a file: the name of its folder, or null if that is no date."""
    return _date_or_null(F.regexp_replace(path_part(path, -2), "^fetch_date=", ""))


def lineage() -> list[Column]:
    """``fetch_date`` (folder), ``search_date`` (file name) and the file's path and time."""
    path = F.col("_metadata.file_path")
    return [
        folder_date(path).alias("fetch_date"),
        _date_or_null(F.regexp_replace(path_part(path, -1), r"\.json$", "")).alias("search_date"),
        path.alias("file_path"),
        F.col("_metadata.file_modification_time").alias("landed_at"),
    ]


def with_lineage(records: DataFrame) -> DataFrame:
    return records.select("*", *lineage())


def plain_path(encoded: Column) -> Column:
    """A file path as readers take it, from the encoded one of the file metadata."""
    decoded = F.url_decode(F.regexp_replace(encoded, r"\+", "%2B"))
    return F.regexp_replace(decoded, r"([\[\]{}*?\\])", r"\\$1")


def read_snapshots(
    spark: SparkSession,
    base: str | list[str],
    schema: str = ENVELOPE,
    multi_line: bool = False,
    files: str = JSON_FILES,
    exclude: list[str] | None = None,
    days: list[str] | None = None,
    larger_than: int | None = None,
) -> DataFrame:
    """All records below ``base``, with lineage; malformed ones carry their text.

    ``files`` is a pattern for the file names that count. With ``multi_line`` a
    file is parsed as a whole by one task, so files must be small; the default
    splits files by line. With ``days`` only the folders of those days, which
    must exist, are listed and read. A file that cannot be read fails the
    job; ``exclude`` names such files (as in ``file_path``), see ``passing_over``.
    ``larger_than`` leaves out files of no more bytes than that.
    """
    folders = [base] if isinstance(base, str) else base
    if days is not None:
        folders = [f"{folder}/{{{day},fetch_date={day}}}" for folder in folders for day in days]
    records = (
        spark.read.schema(f"{schema}, {CORRUPT} string")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", files)
        .option("multiLine", multi_line)
        .json(folders)
    )
    # The file source looks at such filters before it opens a file.
    if larger_than is not None:
        records = records.where(F.col("_metadata.file_size") > larger_than)
    if exclude:
        named = {form for path in exclude for form in (path, unquote(path))}
        records = records.where(~F.col("_metadata.file_path").isin(*sorted(named)))
    return with_lineage(records)


Result = TypeVar("Result")


def unreadable_path(error: BaseException) -> str | None:
    """Path of the file that an error says cannot be read, by its condition; None for others."""
    cause = getattr(error, "java_exception", None) or getattr(error, "_origin", None)
    while cause is not None:
        if "getCondition" in dir(cause) and str(cause.getCondition()).startswith("FAILED_READ_FILE"):
            path = cause.getMessageParameters().get("path")
            # Told with an empty host, which the path of a record has not.
            return re.sub("^([a-z0-9+]+:)///", r"\1/", path) if path else None
        cause = cause.getCause()
    return None


def passing_over(
    action: Callable[[list[str]], Result], most: int
) -> tuple[Result, list[str]]:
    """Run ``action``, leaving out files that cannot be read; returns them too.

    ``action`` gets the files to leave out and reads strictly. If it fails on a
    file, that file is left out as a whole and the action is run again, so no
    file counts half. Beyond ``most`` such files the failure stands, and so does
    any other failure: a store that is down must not cost data. Where there may be
    many such files, ``batches.read_apart`` finds them in one run.
    """
    unreadable: list[str] = []
    while True:
        try:
            return action(unreadable), unreadable
        except Exception as error:
            path = unreadable_path(error)
            if path is None or path in unreadable or len(unreadable) >= most:
                raise
            unreadable.append(path)


def unreadable_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Files left out, in the form of ``rejected``."""
    return lost_files(spark.createDataFrame([(path,) for path in paths], "file_path string"))


def lost_files(files: DataFrame) -> DataFrame:
    """The same for a table of files (``file_path``)."""
    return files.select("file_path", F.lit("file cannot be read").alias("reason"),
                        F.lit(None).cast("string").alias("record"))


def outcome() -> Column:
    """What becomes of a record: accepted, or the reason why it is not."""
    return (
        F.when(F.col(CORRUPT).isNotNull(), "malformed record")
        .when(F.col("fetch_date").isNull(), "folder is not a date")
        .when(F.col("data").isNull(), "no result body")
        .otherwise(ACCEPTED)
    )


def accepted(snapshots: DataFrame) -> DataFrame:
    """Records that can be used. A failed search, with no itineraries, is one."""
    return snapshots.where(outcome() == ACCEPTED).drop(CORRUPT)


def rejected(snapshots: DataFrame) -> DataFrame:
    """The other records, each with its file, the reason and, if malformed, the text."""
    return snapshots.select(
        "file_path", outcome().alias("reason"), F.col(CORRUPT).alias("record"),
    ).where(F.col("reason") != ACCEPTED)


def list_versions(
    spark: SparkSession, base: str | list[str], files: str = JSON_FILES
) -> DataFrame:
    """``file_path, fetch_date, length, modified`` of the files below ``base``.

    No file is opened: the binary-file source gives one row per file, and its
    content column is not selected. Files of no bytes are passed over.
    """
    found = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", files)
        .load(base)
    )
    path = F.col("_metadata.file_path")
    return found.select(
        path.alias("file_path"), folder_date(path).alias("fetch_date"), "length",
        F.col("modificationTime").alias("modified"))


def list_files(spark: SparkSession, base: str, files: str = JSON_FILES) -> DataFrame:
    """``file_path, fetch_date`` of the files below ``base``; no file is opened."""
    return list_versions(spark, base, files).select("file_path", "fetch_date")


def existing_folders(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that a pattern matches, on whatever file system it names."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [status.getPath().toString() for status in system.globStatus(path) or []]


def discover_snapshots(spark: SparkSession, base: str, files: str = JSON_FILES) -> DataFrame:
    """Fetch dates below ``base``, with the number of files.

    Folders that are no dates come out as one null date.
    """
    return list_files(spark, base, files).groupBy("fetch_date").agg(F.count("*").alias("files"))


def snapshot_report(snapshots: DataFrame) -> DataFrame:
    """Per day: records, itineraries, statuses told by the search, and whether it is empty."""
    found = F.coalesce(F.array_size("data.itineraries"), F.lit(0))
    return (
        snapshots.groupBy("fetch_date")
        .agg(
            F.count("*").alias("records"),
            F.sum(found.cast("bigint")).alias("itineraries"),
            F.array_join(F.sort_array(F.collect_set("data.context.status")), ", ").alias("status"),
        )
        .withColumn("is_empty", F.col("itineraries") == 0)
    )


def snapshot_states(expected: DataFrame, snapshots: DataFrame) -> DataFrame:
    """The report with a row for each expected day too: full, empty or missing."""
    both = expected.join(snapshot_report(snapshots), "fetch_date", "full")
    return both.select(
        "fetch_date",
        F.coalesce("itineraries", F.lit(0)).alias("itineraries"),
        F.coalesce("status", F.lit("")).alias("status"),
        F.when(F.col("is_empty"), "empty").when(~F.col("is_empty"), "full")
        .otherwise("missing").alias("state"),
    )


def outcome_report(snapshots: DataFrame) -> DataFrame:
    """Records per day and outcome, in one scan: accepted, or the reason for the reject."""
    return snapshots.groupBy(
        F.coalesce("fetch_date", F.lit("none")).alias("fetch_date"),
        outcome().alias("outcome"),
    ).agg(F.count("*").alias("records"))


def missing_snapshots(expected: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Days of ``expected`` that no accepted record belongs to."""
    return expected.join(snapshots.select("fetch_date").distinct(), "fetch_date", "left_anti")


def merge_report(snapshots: DataFrame) -> DataFrame:
    """One row: records kept and rejected, and whether there is anything to merge."""
    kept = F.count_if(outcome() == ACCEPTED)
    return snapshots.agg(
        kept.alias("kept"),
        F.count_if(outcome() != ACCEPTED).alias("rejected"),
        (kept > 0).alias("has_data"),
    )


def latest_itineraries(itineraries: DataFrame) -> DataFrame:
    """Keep one copy of an itinerary per day: that of the file landed last.

    Within a file the earlier position counts, then the smaller hash of the
    content, so that the choice is the same in every run. Itineraries without
    an id are copies only if they are alike in full. Spark cuts each group to
    its first row before the shuffle as well as after it, so a day landed many
    times over sends few rows per itinerary.
    """
    content = F.when(F.col("itinerary_id").isNull(), F.col("itinerary_hash"))
    copies = Window.partitionBy("fetch_date", "itinerary_id", content).orderBy(
        F.desc("landed_at"), F.desc("file_path"), "itinerary_pos", "itinerary_hash")
    return (
        itineraries.withColumn("_copy", F.row_number().over(copies))
        .where("_copy = 1")
        .drop("_copy")
    )


def read_id_lists(spark: SparkSession, path: str) -> DataFrame:
    """``rank, id`` of every entry of files whose lines are bare JSON arrays of ids.

    A line that is no such array fails the job; blank lines are passed over.
    """
    lines = spark.read.text(path).where(F.trim("value") != "")
    ids = F.from_json("value", "array<bigint>", {"mode": "FAILFAST"})
    lists = lines.select(ids.alias("ids"))
    return lists.select(F.posexplode("ids").alias("rank", "id"))


def union_by_name(tables: list[DataFrame]) -> DataFrame:
    """Union of unlike tables; a column that one of them lacks is null there."""
    merged = tables[0]
    for table in tables[1:]:
        merged = merged.unionByName(table, allowMissingColumns=True)
    return merged
