"""Which fields the landed records really have, beside those that are read.

A read with a schema passes unknown fields over in silence. Here each record's
own shape is taken from its text; a day has few different shapes, whatever its
size, so only those and their numbers leave the scan.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stopover.schema import FULL_ENVELOPE, schema_paths
from stopover.sources.snapshots import JSON_FILES, lineage

FITS, UNKNOWN, OTHER, ABSENT = "read", "not read", "other type", "never found"


def record_shapes(
    spark: SparkSession, base: str | list[str], multi_line: bool = False, files: str = JSON_FILES
) -> DataFrame:
    """``fetch_date, shape, records``: the different shapes of a day's records.

    A record is a line, or with ``multi_line`` a file. Text that is no JSON has none.
    Fractions are ``DOUBLE`` whatever their digits.
    """
    texts = (
        spark.read.format("text")
        .option("wholetext", multi_line)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", files)
        .load(base)
        .select("value", *lineage())
    )
    shape = F.schema_of_variant(F.try_parse_json("value"))
    shape = F.regexp_replace(shape, r"DECIMAL\(\d+,\d+\)", "DOUBLE")
    return texts.groupBy("fetch_date", shape.alias("shape")).agg(
        F.count("*").alias("records")).where("shape is not null")


def shape_paths(shapes: DataFrame) -> DataFrame:
    """``fetch_date, path, type, records``: the fields of each shape, nested ones included.

    Paths are those of ``schema_paths``: arrays add no part of their own.
    """
    token = re.compile(r"`(?:[^`]|``)*`|[^`<>:,\s]+|[<>:,]")

    def fields(shape: str) -> list[tuple[str, str]]:
        words = iter(token.findall(shape))

        def walk(path: str, kind: str, is_field: bool) -> Iterator[tuple[str, str]]:
            """Fields below a type whose name has been read; an array is no path part."""
            if is_field:
                yield path, kind.lower()
            if kind == "ARRAY":
                next(words)
                yield from walk(path, next(words), False)
                next(words)
            elif kind == "OBJECT":
                next(words)
                while (word := next(words)) != ">":
                    if word != ",":
                        name = word[1:-1].replace("``", "`") if word[0] == "`" else word
                        next(words)
                        yield from walk(f"{path}.{name}" if path else name, next(words), True)

        return list(walk("", next(words), False))

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(day, path, kind, records)
                    for day, shape, records in zip(*(c.to_pylist() for c in batch.columns))
                    for path, kind in fields(shape)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate(
                    (pa.string(), pa.string(), pa.string(), pa.int64()))],
                ["fetch_date", "path", "type", "records"])

    return shapes.select("fetch_date", "shape", "records").mapInArrow(
        told, "fetch_date string, path string, type string, records long")


def _kind(data_type: str) -> str:
    """How the type of a read field is called among the shapes."""
    start = re.split(r"[<(]", data_type)[0]
    return {"struct": "object", "map": "object", "array": "array", "boolean": "boolean",
            "tinyint": "bigint", "smallint": "bigint", "int": "bigint", "bigint": "bigint",
            "float": "double", "double": "double", "decimal": "double"}.get(start, "string")


def schema_drift(found: DataFrame, schema: str | T.StructType = FULL_ENVELOPE) -> DataFrame:
    """``path, type, state, first_day, last_day, records``, from ``shape_paths`` and a read schema.

    A row for each field and type that occurs: ``read``, ``not read`` if the schema
    lacks it, ``other type`` if the schema's type makes such a record malformed. A
    field of the schema that no record has is ``never found``, with the schema's type.
    """
    spark = found.sparkSession
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    paths = {path: _kind(kind) for path, kind, _ in schema_paths(fields)}
    # As many rows as the schema has fields.
    known = spark.createDataFrame(list(paths.items()), "path string, want string")
    fields_found = found.groupBy("path", "type").agg(
        F.min("fetch_date").alias("first_day"), F.max("fetch_date").alias("last_day"),
        F.sum("records").alias("records"))
    both = fields_found.join(F.broadcast(known), "path", "left")
    state = (
        F.when(F.col("want").isNull(), UNKNOWN)
        .when(_fits(F.col("type"), F.col("want")), FITS)
        .otherwise(OTHER))
    there = both.select("path", "type", state.alias("state"), "first_day", "last_day", "records")
    absent = known.join(fields_found, "path", "left_anti").select(
        "path", F.col("want").alias("type"), F.lit(ABSENT).alias("state"),
        F.lit(None).cast("string").alias("first_day"), F.lit(None).cast("string").alias("last_day"),
        F.lit(0).cast("long").alias("records"))
    return there.unionByName(absent)


def _fits(kind: Column, want: Column) -> Column:
    """Whether a value of a kind can be read: texts take anything, fractions whole numbers."""
    return ((kind == want) | (kind == "void") | (want == "string")
            | ((want == "double") & (kind == "bigint")))
