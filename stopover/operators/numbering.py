"""What a row's place in its group gives: running numbers and following rows, at any group size.

Rows are cut into ranges by key and order, so that no task holds more than its
range, however large one group is. Each range is sorted and gone through once, batch
by batch, with what the last batch left over; that is the one shuffle of the rows. What
crosses from range to range is then added from a table with a few rows per range.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stopover.session import staged


def in_ranges(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Rows in sorted ranges, with the number of the range; a running number parts equal rows."""
    # It is of no use behind the sort.
    numbered = df.withColumn("_row", F.monotonically_increasing_id())
    place = [*keys, *order, "_row"]
    return numbered.repartitionByRange(*place).sortWithinPartitions(*place).drop(
        "_row").withColumn("_range", F.spark_partition_id())


def same_keys(keys: list[str], struct: str) -> Column:
    """Whether a row has the keys of a struct; null is a key like any other."""
    same = F.lit(True)
    for key in keys:
        same &= F.col(key).eqNullSafe(F.col(f"{struct}.{key}"))
    return same


def group_goes_on(keys: list[str]) -> Callable[[pa.Table], np.ndarray]:
    """Function of a table: for each row but the first, whether it is in the group of the one before."""

    def goes_on(table: pa.Table) -> np.ndarray:
        same = np.ones(max(len(table) - 1, 0), bool)
        for key in keys:
            one = table[key].slice(0, len(same))
            other = table[key].slice(1)
            alike = pc.fill_null(pc.equal(one, other), False)
            neither = pc.and_(pc.is_null(one, nan_is_null=True), pc.is_null(other, nan_is_null=True))
            real = pc.equal(pc.is_null(one), pc.is_null(other))
            same &= pc.or_(alike, pc.and_(neither, real)).to_numpy()
        return same

    return goes_on


def following(
    df: DataFrame, keys: list[str], order: list[str], values: dict[str, str]
) -> DataFrame:
    """Rows in ranges with ``values`` of the next row in the group, as far as the range has it.

    ``_first`` and ``_last`` mark the ends of a range.
    """
    ranged = in_ranges(df, keys, order)
    goes_on = group_goes_on(keys)

    def look_ahead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, first = None, True
        for batch in chain(batches, [None]):
            if batch is not None and not batch.num_rows:
                continue
            if held is not None:
                parts = [held] if batch is None else [held, batch.slice(0, 1)]
                table = pa.Table.from_batches(parts)
                size = held.num_rows
                next_row = np.arange(1, size + 1)
                there = np.append(goes_on(table), False)[:size]
                index = pa.array(next_row, pa.int64(), mask=~there)
                ends = np.zeros((2, size), bool)
                ends[0, 0], ends[1, -1] = first, batch is None
                out = pa.Table.from_batches([held])
                for name, column in values.items():
                    out = out.append_column(name, table[column].take(index))
                out = out.append_column("_first", pa.array(ends[0]))
                out = out.append_column("_last", pa.array(ends[1]))
                yield from out.combine_chunks().to_batches()
                first = False
            held = batch

    schema = T.StructType([
        *ranged.schema, *[T.StructField(n, df.schema[c].dataType) for n, c in values.items()],
        T.StructField("_first", T.BooleanType()), T.StructField("_last", T.BooleanType())])
    return ranged.mapInArrow(look_ahead, schema)


def running(df: DataFrame, keys: list[str], order: list[str], amount: str) -> DataFrame:
    """Rows in ranges with ``_inside``, the sum of ``amount`` before a row in its group and range."""
    ranged = in_ranges(df, keys, order)
    goes_on = group_goes_on(keys)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, total = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch] if last is None else [last, batch])
            new = ~goes_on(table)
            starts = np.append(True, new) if last is None else new
            amounts = batch.column(amount).to_numpy(zero_copy_only=False)
            before = np.cumsum(amounts) - amounts
            # What was before the start of a row's group in this batch doesn't count.
            at = np.maximum.accumulate(np.where(starts, np.arange(len(starts)), -1))
            inside = np.where(at >= 0, before - before[at], before + total)
            total = int(inside[-1] + amounts[-1])
            last = batch.slice(batch.num_rows - 1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(inside, pa.int64())], [*batch.schema.names, "_inside"])

    schema = T.StructType([*ranged.schema, T.StructField("_inside", T.LongType())])
    return ranged.mapInArrow(add_up, schema)


def running_number(
    df: DataFrame, keys: list[str], order: list[str], name: str, weight: str | None = None
) -> DataFrame:
    """Add the number of rows before this one in its group, in ``order``; from 0.

    With ``weight`` the sum of that column over them, so that a row may stand for
    several. Rows alike in ``keys`` and ``order`` come in any order among themselves.
    """
    amount = F.lit(1) if weight is None else F.coalesce(weight, F.lit(0))
    rows = staged(running(
        df.withColumn("_amount", amount.cast("long")), keys, order, "_amount"), "running", "zstd")

    # Only the first and the last group of a range can go on in another one.
    group = F.struct(*keys)
    ends = rows.groupBy("_range").agg(F.min(group).alias("_head"), F.max(group).alias("_tail"))
    here = rows.join(F.broadcast(ends), "_range")
    sums = here.where(same_keys(keys, "_head") | same_keys(keys, "_tail")).groupBy(
        "_range", group.alias("_group")).agg(F.sum("_amount").alias("_sum"))
    earlier = Window.partitionBy("_group").orderBy("_range").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = sums.select(
        F.col("_range").alias("_at"), "_group", F.sum("_sum").over(earlier).alias("_offset"),
    ).where("_offset is not null")
    # At most two rows per range, here and above, so never many more than there are tasks.
    joined = rows.join(
        F.broadcast(offsets), (F.col("_range") == F.col("_at")) & same_keys(keys, "_group"), "left")
    number = F.col("_inside") + F.coalesce("_offset", F.lit(0))
    return joined.select(*df.columns, number.alias(name))
