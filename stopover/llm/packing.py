"""Best-fit packing by exact complements.

How texts are packed depends on their lengths alone, of which there are at
most as many as a sequence has places. So the plan is made from a histogram
of lengths: for each length, longest first, single lengths, then pairs, then
triples that exactly fill the gap are looked up and used as often as their
counts allow; what is left goes to the best fit, the longest length that the
gap still takes. A plan is a list of recipes with how often each is used. Its
size is bounded by the sequence length, whatever the number of texts.

Texts are then numbered within their length (by sorted ranges, so that a
frequent length is spread over tasks) and take the places of their number.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopover.llm.common import on_workers, rows_of, texts
from stopover.llm.tokens import encoder
from stopover.session import staged

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = PIECES + ", sequence_id long, offset long"


def pair_in(counts: np.ndarray, gap: int, most: int) -> tuple[int, int] | None:
    """Two lengths there are, with sum ``gap`` and none over ``most``; the longest first."""
    high = np.arange(min(gap - 1, most), (gap - 1) // 2, -1)
    if not len(high):
        return None
    fits = (counts[high] > 0) & (counts[gap - high] > np.where(2 * high == gap, 1, 0))
    found = np.flatnonzero(fits)
    return (int(high[found[0]]), int(gap - high[found[0]])) if len(found) else None


def complement(counts: np.ndarray, gap: int) -> tuple[int, ...] | None:
    """One, two or three lengths there are that exactly fill ``gap``."""
    if counts[gap] > 0:
        return (gap,)
    found = pair_in(counts, gap, gap)
    if found:
        return found
    for high in np.flatnonzero(counts[1:gap - 1])[::-1] + 1:
        if 3 * high < gap:
            break
        counts[high] -= 1
        rest = pair_in(counts, gap - int(high), int(high))
        counts[high] += 1
        if rest:
            return (int(high), *rest)
    return None


def recipes(histogram: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """How often each combination of lengths makes a sequence; every length is used up."""
    counts = np.zeros(size + 1, np.int64)
    for length, count in histogram.items():
        counts[length] = count
    plan: list[tuple[tuple[int, ...], int]] = []

    def use(combination: tuple[int, ...]) -> None:
        often = min(int(counts[x]) // n for x, n in Counter(combination).items())
        for x in combination:
            counts[x] -= often
        plan.append((combination, often))

    for length in range(size, 0, -1):
        if length == size and counts[length]:
            use((length,))
        while counts[length]:
            counts[length] -= 1
            rest = complement(counts, size - length)
            counts[length] += 1
            if rest is None:
                break
            use((length, *rest))
        while counts[length]:
            combination, gap = [length], size - length
            counts[length] -= 1
            while gap:
                fitting = np.flatnonzero(counts[1:gap + 1])
                if not len(fitting):
                    break
                best = int(fitting[-1]) + 1
                combination.append(best)
                counts[best] -= 1
                gap -= best
            for x in combination:
                counts[x] += 1
            use(tuple(combination))
    return plan


class Places:
    """Where the n-th text of a length goes: spans of numbers for each place of a recipe."""

    def __init__(self, plan: list[tuple[tuple[int, ...], int]], size: int):
        used, rows, sequence = np.zeros(size + 1, np.int64), [], 0
        for combination, often in plan:
            offset = 0
            for length in combination:
                rows.append((length, int(used[length]), sequence, offset))
                used[length] += often
                offset += length
            sequence += often
        rows.sort()
        table = np.array(rows, np.int64).reshape(-1, 4)
        self.first, self.sequence, self.offset = table[:, 1], table[:, 2], table[:, 3]
        self.lower = np.searchsorted(table[:, 0], np.arange(size + 2))

    def of(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.empty_like(length), np.empty_like(length)
        for x in np.unique(length):
            at = np.flatnonzero(length == x)
            low, high = self.lower[x], self.lower[x + 1]
            span = low + np.searchsorted(self.first[low:high], number[at], "right") - 1
            sequence[at] = self.sequence[span] + number[at] - self.first[span]
            offset[at] = self.offset[span]
        return sequence, offset


def _cut(batches: Iterator[pa.RecordBatch], path: str, size: int,
         end: int) -> Iterator[pa.RecordBatch]:
    encode, last = encoder(path).encode, np.array([end], "<u4").tobytes()
    for batch in batches:
        for part in rows_of(batch):
            out: list[tuple] = []
            for doc_id, text in zip(part.column("doc_id").to_pylist(), texts(part.column("text"))):
                ids = encode(text) + last
                for piece, at in enumerate(range(0, len(ids), 4 * size)):
                    own = ids[at:at + 4 * size]
                    out.append((doc_id, piece, at // 4, len(own) // 4, zlib.crc32(own)))
            columns = list(zip(*out))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])


def token_pieces(docs: DataFrame, path: str, size: int, end: int = 0) -> DataFrame:
    """Token pieces of every whole text: its ids and ``end``, cut every ``size`` ids.

    A null or empty text is its end id alone.
    """
    on_workers(docs.sparkSession)
    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(
        partial(_cut, path=path, size=size, end=end), PIECES)


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, at = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(n, part, np.int32)),
             pa.array(np.arange(at, at + n, dtype=np.int64))],
            names=[*batch.schema.names, "part", "at"])
        at += n


def _place(batches: Iterator[pa.RecordBatch], places: Places, before: dict[int, int],
           shorter: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        length = batch.column("length").to_numpy()
        start = np.array([before[p] for p in batch.column("part").to_pylist()], np.int64)
        number = start + batch.column("at").to_numpy() - shorter[length]
        sequence, offset = places.of(length, number)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
            names=[f.split()[0] for f in PLACED.split(", ")])


def pack(pieces: DataFrame, size: int) -> DataFrame:
    """Place pieces of at most ``size`` tokens in as few sequences of that size as can be.

    ``pieces`` has the columns of ``token_pieces``. Returns them with
    ``sequence_id`` (from 0 on) and ``offset``; a sequence is filled without
    gaps from 0. Equal pieces are each placed once, a piece longer than
    ``size`` or without tokens is an error, and no pieces give no rows. What
    comes to the driver is a count for each length and for each task.
    """
    spark = pieces.sparkSession
    on_workers(spark)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = ["length", "doc_id", "piece", "ids_crc32", "start"]
    ordered = (
        pieces.select(*[f.split()[0] for f in PIECES.split(", ")])
        .repartitionByRange(tasks, *keys).sortWithinPartitions(*keys))
    table = staged(ordered.mapInArrow(_number, PIECES + ", part int, at long"), "pieces")
    sizes = table.groupBy("part", "length").count().groupBy("part").agg(
        F.map_from_entries(F.collect_list(F.struct("length", "count"))).alias("lengths")).collect()
    histogram: Counter = Counter()
    before, total = {}, 0
    for row in sorted(sizes, key=lambda r: r["part"]):
        before[row["part"]] = total
        total += sum(row["lengths"].values())
        histogram.update(row["lengths"])
    if histogram and not 1 <= min(histogram) <= max(histogram) <= size:
        raise ValueError(f"pieces must have 1 to {size} tokens")
    counts = np.array([histogram.get(x, 0) for x in range(size + 1)], np.int64)
    places = Places(recipes(histogram, size), size)
    return table.mapInArrow(
        partial(_place, places=places, before=before, shorter=np.cumsum(counts) - counts), PLACED)


def best_fit_packing(docs: DataFrame, path: str, size: int = 2048, end: int = 0) -> DataFrame:
    """Encode whole texts and pack them; see ``token_pieces`` and ``pack``.

    The pieces (not the texts) are staged and shuffled; they are staged first,
    since cutting them into ranges reads them twice.
    """
    return pack(staged(token_pieces(docs, path, size, end), "tokens"), size)
