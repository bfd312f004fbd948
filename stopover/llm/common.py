"""What the operators share: tables, importable workers, texts of Arrow batches."""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows of a batch that become Python objects at a time.
ROWS_AT_ONCE = 256
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
# A word: what no ASCII white space interrupts.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def on_workers(spark: SparkSession) -> None:
    """Let Python workers import this package, and take texts in smaller batches.

    The package is taken from where the driver has it; a cluster whose machines
    do not hold the same path gets it with ``--py-files`` as usual. Batches of
    Spark's default number of rows are large when rows are whole texts; a
    number that the session sets itself stays.
    """
    if spark.conf.get(BATCH) == "10000":
        spark.conf.set(BATCH, "2000")
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    have = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in have.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, have]))


def rows_of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for start in range(0, batch.num_rows, ROWS_AT_ONCE):
        yield batch.slice(start, ROWS_AT_ONCE)


def utf8(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8; null is empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def texts(column: pa.Array) -> list[str]:
    """Texts; null is empty."""
    return [x or "" for x in column.to_pylist()]


def crc32(id_column: Column) -> Column:
    """crc32 of an id written as text (null: of the empty text)."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary"))


def crc32_of(doc_id: int | None) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode())


def sampled(rows: DataFrame, size: int) -> DataFrame:
    """Distinct rows with ``text``, about ``size`` of them: those with a low hash of the text.

    All if there are no more than that. The same rows in every run; copies of
    a row count once, both in the sample and in the number that its share is
    of, so that a table gives the same sample however often its rows are there.
    What is shuffled are hashes of distinct rows, and the sample.
    """
    n = rows.select(F.xxhash64(*rows.columns)).distinct().count()
    if n > size:
        share = F.xxhash64("text").bitwiseAND(F.lit((1 << 52) - 1)) / F.lit(float(1 << 52))
        rows = rows.where(share < size / n)
    return rows.distinct()
