"""Distinct rows, by one shuffle of packed columns.

Rows of texts mostly hold what their neighbours hold too, and a shuffle writes it for every
row. So tasks drop the copies they see, deal their rows to parts and pack the rows of a part by
columns, as one value; these are shuffled. Behind the shuffle rows are sorted by
their hash, which may spill, and of equal neighbours the first stays.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from stopover.operators.numbering import group_goes_on

# Bytes of rows that a task gathers before it packs them, and as it unpacks them.
PACKED_AT_ONCE, UNPACKED_AT_ONCE = 32 << 20, 8 << 20
LEVEL = 6
_HEAD = struct.Struct("<qq")


def _pack(rows: pa.RecordBatch) -> bytes:
    """Rows as one value: texts end to end behind a batch that has their lengths."""
    columns, texts = [], []
    for column in rows.columns:
        if pa.types.is_string(column.type):
            _, starts, data = column.buffers()
            ends = np.frombuffer(starts, np.int32)[column.offset:][[0, len(column)]]
            texts.append(memoryview(data)[ends[0]:ends[1]] if data else b"")
            column = pc.binary_length(column)
        columns.append(column)
    batch = pa.RecordBatch.from_arrays(columns, rows.schema.names).serialize()
    whole = b"".join([memoryview(batch), *texts])
    packed = pa.Codec("zstd", compression_level=LEVEL).compress(whole, asbytes=True)
    return _HEAD.pack(len(whole), batch.size) + packed


def _unpack(packed: bytes, schema: pa.Schema) -> pa.RecordBatch:
    size, at = _HEAD.unpack_from(packed)
    whole = pa.decompress(memoryview(packed)[_HEAD.size:], size, "zstd")
    lengths = pa.schema([
        (f.name, pa.int32() if pa.types.is_string(f.type) else f.type) for f in schema])
    columns = []
    for field, column in zip(
            schema, pa.ipc.read_record_batch(whole.slice(0, at), lengths).columns, strict=True):
        if pa.types.is_string(field.type):
            ends = np.cumsum(column.fill_null(0).to_numpy(), dtype=np.int32)
            starts = pa.py_buffer(np.append(np.int32(0), ends))
            data = whole.slice(at, int(ends[-1]))
            at += data.size
            column = pa.StringArray.from_buffers(
                len(column), starts, data, column.is_valid().buffers()[1], column.null_count)
        columns.append(column)
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def _gathered(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """Batches together, ``most`` bytes or more at a time, copies among them dropped."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in chain(batches, [None]):
        if batch is not None and batch.num_rows:
            held.append(batch)
            size += batch.nbytes
        if held and (batch is None or size >= most):
            table = pa.Table.from_batches(held)
            held, size = [], 0
            yield table.group_by(table.column_names, use_threads=False).aggregate([])


def _packer(schema: pa.Schema, order: list[str]) -> Callable:
    by = [(name, "ascending") for name in ["_part", *order]]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _gathered(batches, PACKED_AT_ONCE):
            table = table.take(pc.sort_indices(table, sort_keys=by)).combine_chunks()
            part = table["_part"].to_numpy()
            rows = table.select(schema.names).cast(schema).to_batches()[0]
            starts = np.flatnonzero(np.append(True, np.diff(part) != 0))
            packed = [_pack(rows.slice(a, b - a))
                      for a, b in zip(starts, np.append(starts[1:], len(part)), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part[starts], pa.int32()), pa.array(packed, pa.binary())],
                ["_part", "_rows"])

    return pack


def _unpacker(schema: pa.Schema) -> Callable:
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = (value.as_py() for batch in batches for value in batch.column("_rows"))
        for table in _gathered((_unpack(value, schema) for value in packed), UNPACKED_AT_ONCE):
            yield from table.combine_chunks().to_batches()

    return unpack


def _firsts(columns: list[str]) -> Callable:
    goes_on = group_goes_on(columns)

    def firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            new = ~goes_on(pa.Table.from_batches([*last, batch]))
            kept = new if last else np.append(True, new)
            last = [batch.slice(batch.num_rows - 1)]
            yield batch.filter(pa.array(kept)).select(columns)

    return firsts


def distinct_rows(df: DataFrame, order: list[str] | None = None) -> DataFrame:
    """``df.distinct()``, for columns that are no lists, maps or structs.

    Rows are packed in ``order``, which changes nothing but how close they are packed.
    """
    schema = to_arrow_schema(df.schema)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    number = F.xxhash64(*df.columns)
    dealt = df.withColumn("_part", F.pmod(number, F.lit(parts)).cast("int"))
    packed = dealt.mapInArrow(_packer(schema, order or []), "_part int, _rows binary")
    rows = packed.repartitionById(parts, "_part").mapInArrow(_unpacker(schema), df.schema)
    # A sort by number is cheap; the columns part unlike rows of one number.
    return rows.withColumn("_number", number).sortWithinPartitions(
        "_number", *df.columns).mapInArrow(_firsts(df.columns), df.schema)
