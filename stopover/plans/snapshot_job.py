"""The whole job: landed snapshots to merged store, segments, rejects and summary CSV.

    python -m stopover.plans.snapshot_job --landing <folder> --out <folder>
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopover.functions.times import date_key
from stopover.operators.flatten import (
    explode_itineraries, explode_legs, explode_segments, segment_columns,
)
from stopover.operators.summary import (
    PRICE_KEYS, SEGMENT_ORDER, distinct_segments, summarise_legs, summarise_segments,
)
from stopover.schema import (
    ENVELOPE, FULL_ENVELOPE, SEGMENT_COLUMNS, SUMMARY_COLUMNS, SUMMARY_SCHEMA,
)
from stopover.session import staged
from stopover.sources.batches import read_apart, unread
from stopover.sources.sinks import (
    write_csv, write_json, write_parquet, write_partitioned,
)
from stopover.sources.snapshots import (
    ACCEPTED, CORRUPT, JSON_FILES, LINEAGE, latest_itineraries, list_versions,
    lost_files, outcome, passing_over, read_snapshots, snapshot_report,
)

EMPTY = "empty file"


def merge_snapshots(
    spark: SparkSession,
    landing: str,
    store: str,
    schema: str = FULL_ENVELOPE,
    multi_line: bool = False,
    files: str = JSON_FILES,
) -> DataFrame:
    """Write all landed records as parquet, by outcome and day, and open the accepted ones.

    The JSON text is parsed once, here. A scan task holds files of one day, or
    of a few if they are small, so the records are written as they are scanned.
    A field of the wrong type makes its record malformed; with the narrow
    ``ENVELOPE`` for ``schema`` that holds for the needed fields only.
    """
    records = read_snapshots(spark, landing, schema, multi_line, files).withColumn(
        "outcome", outcome())
    write_partitioned(records, store, "outcome", "fetch_date", rebalance=False)
    return open_store(spark, store)


def merge_readable(
    spark: SparkSession,
    landing: str,
    store: str,
    most: int,
    schema: str = FULL_ENVELOPE,
    multi_line: bool = False,
    files: str = JSON_FILES,
) -> tuple[DataFrame, DataFrame]:
    """The same, leaving out up to ``most`` files that cannot be read, whole; returns them too.

    One scan finds them all; see ``read_apart``.
    """
    listing = list_versions(spark, landing, files)

    def write(bad: list[str]) -> None:
        rows = read_apart(spark, landing, schema, multi_line, files, exclude=bad)
        named = F.when(F.col("is_record"), outcome()).otherwise(EMPTY)
        write_partitioned(rows.withColumn("outcome", named).drop("is_record"), store,
                          "outcome", "fetch_date", rebalance=False)

    passing_over(write, most)
    written = spark.read.schema("file_path string").parquet(store)
    lost = staged(unread(listing, written), "unreadable")
    if lost.count() > most:
        raise ValueError(f"more than {most} files cannot be read")
    return open_store(spark, store), lost_files(lost)


def open_store(spark: SparkSession, store: str, schema: str = ENVELOPE) -> DataFrame:
    """The accepted records, with the day as text as in a scan of the landing folder.

    Spark prunes nested columns up to the first explode only; the schema given
    here is what keeps all other nested fields unread.
    """
    return _stored(spark, store, schema).where(F.col("outcome") == ACCEPTED).drop("outcome")


def open_rejected(spark: SparkSession, store: str) -> DataFrame:
    """The other records: file, reason and, if malformed, the text."""
    records = _stored(spark, store, f"{CORRUPT} string").where(F.col("outcome") != ACCEPTED)
    return records.select(
        "file_path", F.col("outcome").alias("reason"), F.col(CORRUPT).alias("record"))


def _stored(spark: SparkSession, store: str, schema: str) -> DataFrame:
    columns = f"{schema}, {LINEAGE}, outcome string, fetch_date date"
    rows = spark.read.schema(columns).parquet(store).where(F.col("outcome") != EMPTY)
    return rows.withColumn("fetch_date", date_key(F.col("fetch_date")))


def current_itineraries(envelopes: DataFrame) -> DataFrame:
    """Itineraries, repeated landings of a day counted once."""
    return latest_itineraries(explode_itineraries(envelopes))


def itinerary_summary(envelopes: DataFrame) -> DataFrame:
    """Eleven columns, one row per leg."""
    return summarise_legs(explode_legs(current_itineraries(envelopes)))


def itinerary_segments(itineraries: DataFrame) -> DataFrame:
    return segment_columns(explode_segments(explode_legs(itineraries)))


def summary_by_price(segments: DataFrame) -> DataFrame:
    """The eleven columns by day, price text and departure, in order of the files.

    Itineraries of one day with equal price and departure come out as one row.
    """
    return summarise_segments(segments, PRICE_KEYS, SEGMENT_ORDER).select(*SUMMARY_COLUMNS)


def empty_summary(spark: SparkSession) -> DataFrame:
    """What a run without any accepted record returns."""
    return spark.createDataFrame([], SUMMARY_SCHEMA)


def run(
    spark: SparkSession,
    landing: str,
    out: str,
    by_price: bool = False,
    merged_json: bool = False,
    by_search_date: bool = False,
    multi_line: bool = False,
    files: str = JSON_FILES,
    unreadable: int = 0,
) -> DataFrame:
    """Write all outputs below ``out`` and return the summary.

    ``by_price`` summarises by day, price text and departure instead of by leg;
    ``merged_json`` writes the accepted records as JSON too, with every field;
    ``by_search_date`` the summary by leg with a folder for each search date.
    ``multi_line`` and ``files`` are those of ``read_snapshots``. Up to
    ``unreadable`` files that cannot be read are left out and listed with the rejects.

    Segments and summary come from one set of itineraries, kept below ``out``
    as ``itineraries``: the latest version of each on its day.
    """
    store = f"{out}/merged"
    if unreadable:
        merged, lost = merge_readable(
            spark, landing, store, unreadable, FULL_ENVELOPE, multi_line, files)
        rejects = open_rejected(spark, store).unionByName(lost)
    else:
        merged = merge_snapshots(spark, landing, store, FULL_ENVELOPE, multi_line, files)
        rejects = open_rejected(spark, store)
    write_json(rejects, f"{out}/rejected")
    write_parquet(snapshot_report(merged), f"{out}/report")
    if merged_json:
        write_json(open_store(spark, f"{out}/merged", FULL_ENVELOPE), f"{out}/merged_json")
    if merged.isEmpty():
        return empty_summary(spark)
    write_parquet(current_itineraries(merged), f"{out}/itineraries")
    itineraries = spark.read.parquet(f"{out}/itineraries")
    segments = itinerary_segments(itineraries)
    write_partitioned(
        distinct_segments(segments, SEGMENT_COLUMNS), f"{out}/segments", "fetch_date")
    legs = explode_legs(itineraries)
    write_parquet(
        summary_by_price(segments) if by_price else summarise_legs(legs), f"{out}/summary")
    if by_search_date:
        write_partitioned(summarise_legs(legs, ["search_date"]),
                          f"{out}/summary_by_search_date", "search_date")
    summary = spark.read.schema(SUMMARY_SCHEMA).parquet(f"{out}/summary")
    write_csv(summary, f"{out}/summary_csv")
    return summary


def main() -> None:
    options = argparse.ArgumentParser()
    options.add_argument("--landing", required=True)
    options.add_argument("--out", required=True)
    options.add_argument("--by-price", action="store_true")
    options.add_argument("--merged-json", action="store_true")
    options.add_argument("--by-search-date", action="store_true")
    options.add_argument("--multi-line", action="store_true")
    options.add_argument("--files", default=JSON_FILES)
    options.add_argument("--unreadable", type=int, default=0)
    chosen = options.parse_args()
    spark = SparkSession.builder.appName("snapshot job").getOrCreate()
    run(spark, chosen.landing, chosen.out, chosen.by_price, chosen.merged_json,
        chosen.by_search_date, chosen.multi_line, chosen.files, chosen.unreadable)


if __name__ == "__main__":
    main()
