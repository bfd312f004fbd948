"""Sinks, and the matching reads that bring every value back.

Each task writes its own files; nothing is gathered into one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Times are written to the microsecond; the default stops at the millisecond.
_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}

# An empty text and a null stay apart, and blanks at either end are kept.
_CSV = {
    "header": True,
    "nullValue": "\\N",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    **_TIMES,
}


def write_json(df: DataFrame, path: str, packed: bool = False) -> None:
    """JSON lines; ``packed`` ones take about a tenth of the room, and a file is read by one task."""
    df.write.mode("overwrite").options(**_TIMES).json(path, compression="gzip" if packed else None)


def read_json(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).options(**_TIMES).json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**_CSV).csv(path)


def read_csv(spark: SparkSession, path: str, schema, multi_line: bool = False) -> DataFrame:
    """``multi_line`` is needed only if a text holds line breaks; files are then not split."""
    return spark.read.schema(schema).options(**_CSV).option("multiLine", multi_line).csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_partitioned(df: DataFrame, path: str, *columns: str, rebalance: bool = True) -> None:
    """Parquet with a folder per value of ``columns``, the whole table replaced.

    The rebalance hint brings the rows of a day together, so a day gets few
    files, and splits a day that is much larger than the rest over more tasks.
    """
    _write_folders(df, path, columns, rebalance, "static")


def replace_snapshots(
    df: DataFrame, path: str, column: str = "fetch_date", rebalance: bool = True
) -> None:
    """Write the days that ``df`` holds in place of their old versions; other days stay.

    A day of which ``df`` holds no row is another day.
    """
    _write_folders(df, path, (column,), rebalance, "dynamic")


def drop_days(
    spark: SparkSession, path: str, days: list[str], column: str = "fetch_date"
) -> None:
    """Remove days from a table with a folder for each; days that it lacks don't matter."""
    for day in days:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{column}={day}")
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def _write_folders(
    df: DataFrame, path: str, columns: tuple[str, ...], rebalance: bool, mode: str
) -> None:
    rows = df.hint("rebalance", *columns) if rebalance else df
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", mode)
        .partitionBy(*columns)
        .parquet(path)
    )
