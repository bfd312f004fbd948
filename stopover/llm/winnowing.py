"""Document fingerprints by winnowing.

Every run of ``k`` code points has a rolling hash; of every window of ``w``
neighbouring hashes the smallest is chosen, the rightmost of equal ones, and
kept with its position. So any passage of at least ``w + k - 1`` code points that two
texts share gives both the same hash (the match guarantee), and nothing
shorter than ``k`` matches but by chance. A text shorter than ``k`` is one run.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stopover.llm.common import on_workers, rows_of
from stopover.session import staged

K, WINDOW = 24, 16
# Fixed value: an odd multiplier, so that its powers can be undone.
BASE = 0x9E3779B97F4A7C15
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, ``n`` of them at least."""
    if len(_powers.get("up", ())) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            out = np.full(size, base, np.uint64)
            out[0] = 1
            _powers[name] = np.multiply.accumulate(out)
    return _powers["up"][:n], _powers["down"][:n]


def run_hashes(codes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` codes, from prefix sums of one rolling polynomial."""
    if not len(codes):
        return np.empty(0, np.uint64)
    k = min(k, len(codes))
    up, down = powers(len(codes))
    sums = np.empty(len(codes) + 1, np.uint64)
    sums[0] = 0
    np.cumsum((codes + np.uint64(1)) * up, out=sums[1:])
    runs = (sums[k:] - sums[:-k]) * down[:len(codes) - k + 1]
    runs ^= runs >> np.uint64(31)
    runs *= np.uint64(0xBF58476D1CE4E5B9)
    return runs ^ (runs >> np.uint64(29))


def winnow(hashes: np.ndarray, window: int) -> np.ndarray:
    """Positions of the smallest hash of every window, the rightmost of equal ones."""
    n = len(hashes)
    least, at, reach = hashes, np.arange(n), 1
    while reach < min(window, n):
        step = min(reach, min(window, n) - reach)
        right = least[step:] <= least[:-step]
        at = np.where(right, at[step:], at[:-step])
        least, reach = hashes[at], reach + step
    return at[np.flatnonzero(np.diff(at, prepend=-1))] if n else at


class Fingerprint:
    """Chosen hashes of a text with their positions."""

    def __init__(self, text: str, k: int = K, window: int = WINDOW):
        codes = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64)
        hashes = run_hashes(codes, k)
        self.k, self.window, self.n_chars = k, window, len(codes)
        self.positions = winnow(hashes, window)
        self.hashes = hashes[self.positions]
        self.distinct = np.unique(self.hashes)

    def digest(self) -> str:
        """Hash of all hashes and positions: equal for equal texts."""
        parts = (self.hashes.astype("<u8").tobytes(), self.positions.astype("<u8").tobytes())
        return hashlib.blake2b(b"".join(parts), digest_size=16).hexdigest()

    def likeness(self, other: Fingerprint) -> float:
        """Share of hashes that both have among those that either has; 1 if neither has any."""
        both = len(self.distinct) + len(other.distinct)
        if not both:
            return 1.0
        merged = np.concatenate([self.distinct, other.distinct])
        merged.sort()
        common = int(np.count_nonzero(merged[1:] == merged[:-1]))
        return common / (both - common)

    def matches(self, other: Fingerprint) -> list[tuple[int, int]]:
        """Positions, here and there, of runs that both chose."""
        there: dict[int, list[int]] = {}
        for h, p in zip(other.hashes.tolist(), other.positions.tolist()):
            there.setdefault(h, []).append(p)
        return [(p, q) for h, p in zip(self.hashes.tolist(), self.positions.tolist())
                for q in there.get(h, ())]


def _fingerprints(batches: Iterator[pa.RecordBatch], k: int,
                  window: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in rows_of(batch):
            prints = [Fingerprint(t or "", k, window) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"),
                 pa.array([p.hashes.view(np.int64) for p in prints], pa.list_(pa.int64())),
                 pa.array([p.positions for p in prints], pa.list_(pa.int64()))],
                names=["doc_id", "hashes", "positions"])


def fingerprints(docs: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """``doc_id``, chosen ``hashes`` and their ``positions`` (code points) of every whole text.

    A null text counts as empty and has none; repeated rows are each returned.
    """
    on_workers(docs.sparkSession)
    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(
        partial(_fingerprints, k=k, window=window),
        "doc_id long, hashes array<long>, positions array<long>")


COMPARED = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
            "edited_fingerprint string, near_edited double, near_next double")
ENDS = "part int, first_text string, last_id long, last_text string"


def edited(text: str, following: str) -> str:
    """The last half of a text's code points replaced by as many of the following text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def compared(doc_id: int | None, text: str, own: Fingerprint, following: str,
             behind: Fingerprint) -> tuple:
    made = edited(text, following)
    new = Fingerprint(made, own.k, own.window)
    return (doc_id, len(text), hashlib.sha256(made.encode()).hexdigest(), own.digest(),
            new.digest(), own.likeness(new), own.likeness(behind))


def columns_of(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])


def _neighbours(batches: Iterator[pa.RecordBatch], k: int,
                window: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted, and each is compared with the one behind it.

    The last one has none here, so the last row and the first text come out
    as the ends of the part.
    """
    before, first, blank = None, "", (None,) * len(COMPARED.split(", "))
    for batch in batches:
        for part in rows_of(batch):
            out: list[tuple] = []
            for doc_id, text in zip(part.column("doc_id").to_pylist(),
                                    part.column("text").to_pylist()):
                own = Fingerprint(text := text or "", k, window)
                if before is None:
                    first = text
                else:
                    out.append((*compared(*before, text, own), None, None, None, None))
                before = (doc_id, text, own)
            yield columns_of(out, f"{COMPARED}, {ENDS}")
    if before is not None:
        yield columns_of([(*blank, TaskContext.get().partitionId(), first, *before[:2])],
                         f"{COMPARED}, {ENDS}")


def _ends(batches: Iterator[pa.RecordBatch], k: int, window: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(*[batch.column(c).to_pylist() for c in ("last_id", "last_text", "following")])
        yield columns_of([
            compared(doc_id, text, Fingerprint(text, k, window), behind,
                     Fingerprint(behind, k, window)) for doc_id, text, behind in rows], COMPARED)


def compared_with_edited(docs: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """Fingerprints of every whole text, of an edited text, and how alike they are.

    The edited text is ``edited`` with the next document in descending order
    of ``doc_id`` (null last; rows of one id by a hash of their text; after
    the last the first, which may be the document itself). A null text is
    empty. Two empty fingerprints are alike (1), an empty and another are not
    (0). Repeated rows are each returned; no rows give no rows.

    Texts are shuffled once, by ranges of ids, and compared within each range.
    The results are staged together with the two ends of each range; those few
    texts, one range's last and the next one's first, are joined and compared.
    """
    spark = docs.sparkSession
    on_workers(spark)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Ranges part rows of one id, even equal ones.
    falling = [F.col("doc_id").desc_nulls_last(), F.col("hash").desc(), F.col("row")]
    rows = (
        docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text",
                        "xxhash64(text) hash", "monotonically_increasing_id() row")
        .repartitionByRange(tasks, *falling).sortWithinPartitions(*falling)
        .select("doc_id", "text")
        .mapInArrow(partial(_neighbours, k=k, window=window), f"{COMPARED}, {ENDS}"))
    table = staged(rows, "compared")
    ends = table.where("part is not null")
    in_order = Window.orderBy("part")
    nexts = ends.select("part").select("part", F.coalesce(
        F.lead("part").over(in_order), F.min("part").over(Window.partitionBy())).alias("then"))
    firsts = ends.select(F.col("part").alias("then"), F.col("first_text").alias("following"))
    joined = ends.select("part", "last_id", "last_text").join(nexts, "part").join(firsts, "then")
    between = joined.select("last_id", "last_text", "following").mapInArrow(
        partial(_ends, k=k, window=window), COMPARED)
    return table.where("part is null").select(*between.columns).unionByName(between)
