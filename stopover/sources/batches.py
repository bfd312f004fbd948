"""Landed files in batches, with a log of what became of each file.

A file that cannot be read costs itself and nothing else. Files up to a stated
size are read whole, one row each, by a scan that leaves out what it cannot read: a
file that is listed and has no row is unreadable, and it never counts half. So any
number of bad files is found by the one scan that reads the good ones. Packed ones
(gzip) are read as they are and unpacked piece by piece, first to see that they are whole and
then for their lines, as their text may be many times as large. Larger
files are read by line and strictly; the error names the file.

``land`` does so in batches. A batch is written to a folder of its own and then
entered in the log; one that was not entered is done again. A file is known by its
path, length and time, so a run takes new files, changed ones, and those that
could not be read before.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stopover.schema import ENVELOPE, FULL_ENVELOPE
from stopover.session import staged
from stopover.sources.sinks import write_parquet, write_partitioned
from stopover.sources.snapshots import (
    CORRUPT, JSON_FILES, LINEAGE, existing_folders, lineage, list_versions, outcome, passing_over,
    plain_path, read_snapshots,
)

# Bytes of the largest file that is read whole (packed ones grow), and limits of a batch.
LARGEST = 32 << 20
# Bytes of a packed file unpacked at once, of text kept from the look at the whole file to its
# lines, and of lines that go on together.
PIECE, KEPT, LINES = 64 << 10, 32 << 20, 4 << 20
BATCH_BYTES, BATCH_FILES = 64 << 30, 10_000

LOG = ("file_path string, fetch_date string, length bigint, modified timestamp, records bigint, "
       "state string")
READ, UNREADABLE = "read", "unreadable"
_OWN = ["fetch_date", "search_date", "file_path", "landed_at"]


def _texts(whole: Column, multi_line: bool) -> Column:
    """Texts of the records of a file: its lines, or all of it; arrays fall apart."""
    lines = F.array(whole) if multi_line else F.split(whole, r"[\r\n]+")
    return F.filter(lines, lambda line: F.trim(line) != "")


def _one_of(paths: list[str]) -> Column:
    """Whether a row's file is one of ``paths``; the file source asks before it opens a file."""
    named = ["'" + p.replace("\\", "\\\\").replace("'", "\\'") + "'" for p in sorted(paths)]
    return F.expr(f"_metadata.file_path in ({', '.join(named)})") if named else F.lit(False)


def _unpacked(packed: memoryview) -> Iterator[bytes]:
    """The text of gzip members, in pieces; an error if one is broken or cut off."""
    at = 0
    while at < len(packed):
        member = zlib.decompressobj(wbits=31)
        while not member.eof:
            piece = packed[at:at + PIECE]
            if not piece:
                raise EOFError("cut off")
            yield member.decompress(piece)
            at += len(piece) - len(member.unused_data)


def _whole(packed: memoryview) -> Iterable[bytes]:
    """``_unpacked``, once all of it has been; a long text is unpacked anew."""
    kept, size = [], 0
    for piece in _unpacked(packed):
        size += len(piece)
        if size <= KEPT:
            kept.append(piece)
        else:
            kept.clear()
    return kept if size <= KEPT else _unpacked(packed)


def _lines(pieces: Iterable[bytes]) -> Iterator[bytes]:
    """Lines that are not blank."""
    begun: list[bytes] = []
    for piece in pieces:
        if b"\r" in piece:
            piece = piece.replace(b"\r", b"\n")
        end, *more = piece.split(b"\n")
        begun.append(end)
        for line in more:
            yield b"".join(begun)
            begun = [line]
    yield b"".join(begun)


def _as_text(lines: list[bytes]) -> pa.Array:
    texts = pa.array(lines, pa.binary())
    try:
        return texts.cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([line.decode(errors="replace") for line in lines], pa.string())


def _lines_of_packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``_OWN, line`` of the files that are whole; a null line for one without any."""

    def rows(batch: pa.RecordBatch, number: int, texts: pa.Array) -> pa.RecordBatch:
        own = batch.select(_OWN).take(pa.array(np.full(len(texts), number)))
        return pa.RecordBatch.from_arrays([*own.columns, texts], [*_OWN, "line"])

    for batch in batches:
        for number, packed in enumerate(batch.column("content")):
            try:
                pieces = _whole(memoryview(packed.as_buffer()))
            except (zlib.error, EOFError):
                continue
            held, size, none = [], 0, True
            for line in _lines(pieces):
                if line.strip(b" "):
                    held.append(line)
                    size += len(line)
                    none = False
                if size >= LINES:
                    yield rows(batch, number, _as_text(held))
                    held, size = [], 0
            if none:
                yield rows(batch, number, pa.nulls(1, pa.string()))
            elif held:
                yield rows(batch, number, _as_text(held))


def _whole_files(
    spark: SparkSession, paths: str | list[str], schema: str, multi_line: bool, files: str,
    chosen: Column,
) -> DataFrame:
    """``read_apart`` for those files that ``chosen``, a filter on ``_metadata``, names."""
    def scan(kind: str, some: Column) -> DataFrame:
        return (
            spark.read.format(kind)
            .option("wholetext", kind == "text")
            .option("ignoreCorruptFiles", True)
            .option("recursiveFileLookup", True)
            .option("pathGlobFilter", files)
            .load(paths)
            .where(chosen & some)
        )

    # With ``multi_line`` the text is one value whatever it comes from.
    packed = F.lit(False) if multi_line else F.col("_metadata.file_path").endswith(".gz")
    whole = scan("text", ~packed).select("value", *lineage())
    lines = whole.select(*_OWN, F.explode_outer(_texts(F.col("value"), multi_line)).alias("line"))
    if not multi_line:
        lines = lines.unionByName(
            scan("binaryFile", packed).select("content", *lineage()).mapInArrow(
                _lines_of_packed, lines.schema))
    # A text that is an array holds several records; one that is cut off stays one text.
    entries = F.when(F.col("line").rlike(r"^\ufeff?\s*\["), F.from_json("line", "array<string>"))
    texts = lines.select(*_OWN, F.explode_outer(
        F.coalesce(entries, F.array(F.ltrim("line", F.lit("\ufeff"))))).alias("text"))
    record = F.from_json("text", f"{schema}, {CORRUPT} string",
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return texts.select(
        record.alias("_record"), *_OWN, F.col("text").isNotNull().alias("is_record"),
    ).select("_record.*", *_OWN, "is_record")


def read_apart(
    spark: SparkSession,
    paths: str | list[str],
    schema: str = ENVELOPE,
    multi_line: bool = False,
    files: str = JSON_FILES,
    largest: int = LARGEST,
    exclude: list[str] | None = None,
) -> DataFrame:
    """The columns of ``read_snapshots``, and ``is_record``.

    Every file that can be read has a row: one for each record, or one that is no
    record if it holds none; files of no bytes are not listed by Spark at all. A file of
    at most ``largest`` bytes that cannot be read has no row and fails nothing; a
    larger one fails the job unless it is excluded. Of an array in one line each entry
    is a record, malformed or not, by itself.
    """
    small = _whole_files(spark, paths, schema, multi_line, files,
                         F.col("_metadata.file_size") <= largest)
    large = read_snapshots(
        spark, paths, schema, multi_line, files, exclude, larger_than=largest)
    return small.unionByName(large.withColumn("is_record", F.lit(True)))


def unread(listing: DataFrame, rows: DataFrame) -> DataFrame:
    """Files of ``listing`` that none of ``rows`` (of ``read_apart``) comes from."""
    return listing.join(rows.select("file_path").distinct(), "file_path", "left_anti")


@dataclass(frozen=True)
class Batch:
    """Files of some days; or one of ``of`` parts, by path, of a day with very many."""

    days: tuple[str | None, ...]
    part: int = 0
    of: int = 1

    def holds(self) -> Column:
        named = [d for d in self.days if d is not None]
        day = F.col("fetch_date").isin(named) if named else F.lit(False)
        if None in self.days:
            day |= F.col("fetch_date").isNull()
        return day & (F.pmod(F.xxhash64("file_path"), F.lit(self.of)) == self.part)


def batches(files: DataFrame, most_bytes: int, most_files: int) -> Iterator[Batch]:
    """Days in order, as many at a time as the limits allow; the driver holds days only."""
    days = files.groupBy("fetch_date").agg(
        F.sum("length").alias("bytes"), F.count("*").alias("files")).orderBy("fetch_date").collect()
    open_days: list[str | None] = []
    total_bytes = total_files = 0
    for day in days:
        of = max(-(-day.bytes // most_bytes), -(-day.files // most_files), 1)
        over = total_bytes + day.bytes > most_bytes or total_files + day.files > most_files
        if open_days and over:
            yield Batch(tuple(open_days))
            open_days, total_bytes, total_files = [], 0, 0
        if of > 1:
            yield from (Batch((day.fetch_date,), part, of) for part in range(of))
            continue
        open_days.append(day.fetch_date)
        total_bytes, total_files = total_bytes + day.bytes, total_files + day.files
    if open_days:
        yield Batch(tuple(open_days))


def _outermost(folders: set[str]) -> list[str]:
    """Folders that lie in no other one: a scan lists what is below them too."""
    kept: list[str] = []
    for folder in sorted(folders, key=lambda f: f + "/"):
        if not kept or not folder.startswith(kept[-1] + "/"):
            kept.append(folder)
    return kept


def read_log(spark: SparkSession, log: str) -> DataFrame:
    """What every batch did: a row for each file it was given, with the batch's number.

    ``records`` counts malformed ones too. Nothing has been landed yet if there is no log.
    """
    entered = existing_folders(spark, f"{log}/batch=*/_SUCCESS")
    if not entered:
        return spark.createDataFrame([], f"{LOG}, batch bigint")
    folders = [path.removesuffix("/_SUCCESS") for path in entered]
    return spark.read.schema(f"{LOG}, batch bigint").option("basePath", log).parquet(*folders)


def land(
    spark: SparkSession,
    base: str | list[str],
    store: str,
    log: str,
    schema: str = FULL_ENVELOPE,
    multi_line: bool = False,
    files: str = JSON_FILES,
    most: int = 0,
    largest: int = LARGEST,
    most_bytes: int = BATCH_BYTES,
    most_files: int = BATCH_FILES,
) -> int:
    """Write what the files below ``base`` hold to ``store``; returns the number of batches.

    Only files that the log does not have as read are taken. More than ``most``
    unreadable files in a run fail it, before the batch they are found in is
    entered: a store that is down must not pass for bad files. ``open_landed``
    reads the result.
    """
    listing = staged(list_versions(spark, base, files), "listing")
    known = read_log(spark, log)
    version = ["file_path", "length", "modified"]
    todo = staged(listing.join(
        known.where(F.col("state") == READ).select(*version), version, "left_anti"), "todo")
    first = number = (known.agg(F.max("batch")).first()[0] or 0) + 1
    unreadable = 0
    for batch in batches(todo, most_bytes, most_files):
        given = todo.where(batch.holds())
        folder = f"{store}/batch={number}"
        # Paths of one batch: a bounded number.
        named = given.select(
            "file_path", "length", plain_path(F.col("file_path")).alias("plain")).collect()
        small = [row.file_path for row in named if row.length <= largest]
        folders = _outermost({row.plain.rsplit("/", 1)[0] for row in named})

        def read(bad: list[str]) -> None:
            rows = _whole_files(spark, folders, schema, multi_line, files, _one_of(small))
            large = [row.plain for row in named
                     if row.length > largest and not {row.file_path, row.plain} & {*bad}]
            if large:
                rows = rows.unionByName(read_snapshots(
                    spark, large, schema, multi_line, files).withColumn("is_record", F.lit(True)))
            write_partitioned(rows.withColumn("outcome", outcome()), folder,
                              "outcome", "fetch_date", rebalance=False)

        passing_over(read, max(most - unreadable, 0))
        written = spark.read.schema("file_path string, is_record boolean").parquet(folder)
        found = written.groupBy("file_path").agg(F.count_if("is_record").alias("records"))
        entries = staged(given.join(found, "file_path", "left").withColumn(
            "state", F.when(F.col("records").isNull(), UNREADABLE).otherwise(READ)), "entries")
        unreadable += entries.where(F.col("state") == UNREADABLE).count()
        if unreadable > most:
            raise ValueError(f"{unreadable} files cannot be read, {most} are allowed")
        write_parquet(entries.select(*[c.split()[0] for c in LOG.split(", ")]),
                      f"{log}/batch={number}")
        number += 1
    return number - first


def open_landed(spark: SparkSession, store: str, log: str, schema: str = ENVELOPE) -> DataFrame:
    """Records of all entered batches, with ``outcome``; of a file its version landed last."""
    known = read_log(spark, log)
    columns = f"{schema}, {CORRUPT} string, {LINEAGE}, is_record boolean, outcome string, " \
              "fetch_date string, batch bigint"
    entered = [row[0] for row in known.select("batch").distinct().collect()]
    if not entered:
        return spark.createDataFrame([], columns)
    rows = spark.read.schema(columns).option("basePath", store).parquet(
        *[f"{store}/batch={number}" for number in sorted(entered)])
    read = known.where(F.col("state") == READ)
    last = read.groupBy("file_path").agg(F.max("batch").alias("last"), F.count("*").alias("n"))
    # Only files that were landed again, which are few, take part in the join.
    old = read.join(last.where("n > 1"), "file_path").where("batch < last").select(
        "file_path", "batch")
    return rows.where("is_record").join(old, ["file_path", "batch"], "left_anti").drop("is_record")


def landed_files(spark: SparkSession, log: str) -> DataFrame:
    """The log's last word on each file."""
    known = read_log(spark, log)
    return known.groupBy("file_path").agg(F.max_by(F.struct(
        *[c for c in known.columns if c != "file_path"]), "batch").alias("last")).select(
        "file_path", "last.*")
