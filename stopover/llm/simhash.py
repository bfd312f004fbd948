"""Near duplicates by 64-bit similarity fingerprints and pivot distance tables.

Texts become fingerprints, equal fingerprints one row. Two fingerprints that
differ in at most ``d`` bits agree on all but ``d`` of the ``d + 2`` blocks of
bits, so on two whole blocks at least: every pair of blocks is a key, and rows
of one key meet. (A caller with very many rows may let them meet on ``agree`` of
``d + agree`` blocks instead: more keys, each shared by fewer rows.) Which of
them link is settled by a pivot table: the distances of each fingerprint to a
number of fixed reference fingerprints, computed once per key group. By the
triangle inequality two rows are no link if any of these coordinates differs by
more than ``d``; rows sorted by the first coordinate leave a narrow band to look
at, the others discard most of that, and what is left is verified bit by bit.
Links come out as a forest (a link to the smallest fingerprint reached in the
key group), never as all pairs.

A key group too large for one task is dealt to several, each with two of its
parts, so that every two rows meet somewhere. Components are found by rounds
of large-star and small-star steps on distinct fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopover.llm.common import on_workers, rows_of, utf8
from stopover.session import staged

# Reference fingerprints, rows that one task takes of a key group at a time, and blocks of a key.
PIVOTS, PART, AGREE = 24, 4096, 2
# Parts that the links of one fingerprint are dealt to.
SPREAD = 256
_PIVOTS = np.random.default_rng(6).integers(0, 1 << 63, PIVOTS, dtype=np.uint64) << np.uint64(1)


def fingerprint(words: list[bytes], shingle: int, seed: int) -> int:
    """Majority of the bits of all shingles; no words: zero."""
    from xxhash import xxh64_intdigest

    if not words:
        return 0
    line, n = b" ".join(words), max(1, len(words) - shingle + 1)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(sizes + 1) - sizes - 1
    ends = (starts + sizes)[min(shingle, len(words)) - 1:]
    hashes = np.array([xxh64_intdigest(line[a:b], seed)
                       for a, b in zip(starts[:n].tolist(), ends.tolist())], "<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        bits = np.unpackbits(hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8),
                             axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle: int,
                  seed: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in rows_of(batch):
            # bytes.lower() and bytes.split() know ASCII only, as is asked here
            found = [fingerprint(raw.lower().split(), shingle, seed)
                     for raw in utf8(part.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("hash"),
                 pa.array(np.array(found, np.uint64).view(np.int64))],
                names=["doc_id", "hash", "fp"])


def key_names(agree: int) -> list[str]:
    return ["which", *[f"block{n}" for n in range(agree)]]


def block_keys(fp: Column, bits: int, agree: int = AGREE) -> Column:
    """Every choice of ``agree`` of the ``bits + agree`` blocks of a fingerprint, as array of structs."""
    blocks = bits + agree
    edges = [64 * i // blocks for i in range(blocks + 1)]
    values = [F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << (high - low)) - 1))
              for low, high in zip(edges, edges[1:])]
    return F.array(*[
        F.struct(*[v.alias(name) for v, name in zip([F.lit(n), *chosen], key_names(agree))])
        for n, chosen in enumerate(combinations(values, agree))])


def close_pairs(left: np.ndarray, right: np.ndarray | None, bits: int) -> np.ndarray:
    """Index pairs (rows of two columns) of fingerprints within ``bits`` bits.

    Without ``right``, pairs within ``left``. Pairs are looked at in bounded
    slices: the band of the first pivot, then all pivots, then all bits.
    """
    def table(x: np.ndarray) -> np.ndarray:
        return np.bitwise_count(x[None, :] ^ _PIVOTS[:, None]).astype(np.int8)

    other = left if right is None else right
    a, b = table(left), table(other)
    order = np.argsort(b[0], kind="stable")
    ranked = b[0][order]
    low = np.searchsorted(ranked, a[0].astype(np.int16) - bits, "left")
    high = np.searchsorted(ranked, a[0].astype(np.int16) + bits, "right")
    out = []
    for i in range(len(left)):
        near = order[low[i]:high[i]]
        if right is None:
            near = near[near > i]
        for pivot in range(1, PIVOTS):
            if len(near) < 16:
                break
            near = near[np.abs(b[pivot, near] - a[pivot, i]) <= bits]
        near = near[np.abs(b[:, near] - a[:, i, None]).max(axis=0, initial=0) <= bits]
        near = near[np.bitwise_count(other[near] ^ left[i]) <= bits]
        if len(near):
            out.append(np.stack([np.full(len(near), i), near], axis=1))
    return np.concatenate(out) if out else np.empty((0, 2), np.int64)


def forest(values: np.ndarray, pairs: np.ndarray) -> list[tuple[int, int]]:
    """The components of pairs, each as links from its members to its smallest value."""
    parent = list(range(len(values)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for one, two in pairs.tolist():
        one, two = root(one), root(two)
        if one != two:
            if values[one] > values[two]:
                one, two = two, one
            parent[two] = one
    return [(int(values[i]), int(values[root(i)])) for i in np.unique(pairs) if root(i) != i]


def _links(batches: Iterator[pa.RecordBatch], bits: int,
           names: list[str]) -> Iterator[pa.RecordBatch]:
    """Links of rows sorted by key and tile; ``side`` says which part of the tile a row is of."""
    key, held = None, []

    def settled() -> pa.RecordBatch | None:
        if len(held) < 2:
            return None
        fps = np.array([h[0] for h in held], np.int64)
        side = np.array([h[1] for h in held])
        left, right = (np.flatnonzero(side == s) for s in (0, 1))
        bare = fps.view(np.uint64)
        if len(right):
            pairs = close_pairs(bare[left], bare[right], bits)
            pairs = np.stack([left[pairs[:, 0]], right[pairs[:, 1]]], axis=1)
        else:
            pairs = close_pairs(bare, None, bits)
        found = forest(fps, pairs)
        if not found:
            return None
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in zip(*found)], names=["u", "v"])

    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in (*names, "fp", "side")]
        for *new, fp, side in zip(*columns):
            if new != key:
                if (out := settled()) is not None:
                    yield out
                key, held = new, []
            held.append((fp, side))
    if (out := settled()) is not None:
        yield out


def links(distinct: DataFrame, bits: int = 4, part: int = PART, agree: int = AGREE) -> DataFrame:
    """Links ``u, v`` (``v`` the smaller) that join all distinct ``fp`` within ``bits`` bits.

    Their components are those of all close pairs; a chain of close
    fingerprints stays connected.
    """
    spark = distinct.sparkSession
    on_workers(spark)
    keys = key_names(agree)
    keyed = distinct.select("fp", F.explode(block_keys(F.col("fp"), bits, agree)).alias("k")).select(
        "fp", "k.*")
    # Groups that are too large for one task, and the number of their parts; as a
    # table, so that the join is planned by its true size.
    large = staged(keyed.groupBy(*keys).count().where(F.col("count") > part).select(
        *[F.col(k).alias(f"l_{k}") for k in keys],
        F.ceil(F.col("count") / part).cast("int").alias("parts")), "large")
    dealt = keyed.join(large, [F.col(k) == F.col(f"l_{k}") for k in keys], "left")
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    tiles = F.when(F.col("parts").isNull(), F.array(F.struct(
        F.lit(0).alias("tile_a"), F.lit(0).alias("tile_b"), F.lit(0).alias("side")))).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda j: F.struct(
            F.least(j, F.col("own")).alias("tile_a"), F.greatest(j, F.col("own")).alias("tile_b"),
            (j < F.col("own")).cast("int").alias("side"))))
    tiled = dealt.withColumn("own", own).select("fp", *keys, F.explode(tiles).alias("t")).select(
        "fp", *keys, "t.*")
    group = [*keys, "tile_a", "tile_b"]
    met = tiled.repartition(*group).sortWithinPartitions(*group)
    return met.mapInArrow(partial(_links, bits=bits, names=group), "u long, v long").distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``fp, root`` of every end of a link: the smallest value of its component.

    Rounds of large-star (every larger neighbour of a row is linked to the
    smallest of its neighbourhood) and small-star (every smaller one, and the row
    itself); each round is written as a table, and the last one changes nothing. The
    smallest neighbour is an aggregate, joined back, so that no neighbourhood
    is gathered in a task; nor does the join gather one: links are dealt by their
    end and a hash of the other one, and the smallest neighbour goes to those
    parts that have a link of that end.
    """
    def star(table: DataFrame, both: bool) -> DataFrame:
        ends = table.select("u", "v")
        if both:
            ends = ends.union(table.select(F.col("v").alias("u"), F.col("u").alias("v")))
        ends = ends.withColumn("deal", F.pmod(F.xxhash64("v"), F.lit(SPREAD)).cast("int"))
        least = ends.groupBy(F.col("u").alias("m_u"), "deal").agg(F.min("v").alias("m"))
        least = least.groupBy("m_u").agg(F.min("m").alias("m"), F.collect_list("deal").alias("deals"))
        least = least.select("m_u", F.least("m_u", "m").alias("m"), "deals")
        sent = least.select("m_u", "m", F.explode("deals").alias("m_deal"))
        joined = ends.join(sent, (F.col("u") == F.col("m_u")) & (F.col("deal") == F.col("m_deal")))
        if both:
            return joined.where("v > u and v != m").select(
                F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        moved = joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return moved.union(least.select(F.col("m_u").alias("u"), F.col("m").alias("v"))).distinct()

    table = staged(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                   .where("u != v").distinct(), "links")
    for _ in range(most_rounds):
        after = staged(star(star(table, True), False), "links")
        # links that are all stars already stay as they are
        same = table.select("u", "v", F.lit(1).alias("n")).union(
            after.select("u", "v", F.lit(-1).alias("n"))).groupBy("u", "v").agg(
            F.sum("n").alias("n")).where("n != 0").isEmpty()
        table = after
        if same:
            break
    else:
        raise RuntimeError(f"components not settled after {most_rounds} rounds")
    roots = table.select(F.col("v").alias("u"), "v").distinct()
    return table.select(F.col("u").alias("fp"), F.col("v").alias("root")).union(
        roots.select(F.col("u").alias("fp"), F.col("v").alias("root")))


def grouped(docs: DataFrame, shingle: int, seed: int, bits: int) -> DataFrame:
    """``doc_id, hash, fp, root, component_id`` of every row; ``hash`` is one of the text."""
    on_workers(docs.sparkSession)
    rows = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text",
                           "xxhash64(cast(text as string)) hash")
    prints = staged(rows.mapInArrow(
        partial(_fingerprints, shingle=shingle, seed=seed), "doc_id long, hash long, fp long"),
        "fingerprints")
    least = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    found = components(links(least.select("fp"), bits)).select(F.col("fp").alias("of"), "root")
    placed = least.join(found, F.col("fp") == F.col("of"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = staged(placed.join(ids, "root").select(
        F.col("fp").alias("of"), "root", "component_id"), "components")
    return prints.join(named, F.col("fp") == F.col("of")).drop("of")


def near_duplicates(docs: DataFrame, shingle: int = 4, seed: int = 42,
                    bits: int = 4) -> DataFrame:
    """``doc_id, fp, component_id`` of every row; ``fp`` is the fingerprint as a signed integer.

    ``component_id`` is the smallest id among all documents that can be
    reached over links (of at most ``bits`` differing bits), the document
    itself included. A null or empty text has the fingerprint zero and links
    like any other; a null id is never a component's id unless there is no
    other; repeated rows are each returned; no rows give no rows. Further
    columns of ``docs`` are not read.
    """
    return grouped(docs, shingle, seed, bits).select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, shingle: int = 4, seed: int = 42, bits: int = 4) -> DataFrame:
    """The rows of ``docs``, all columns, of which one stays in each component.

    It is one with the smallest id (null last), of several with that id the one
    with the smallest hash of its text, and of equal rows any. Texts are shuffled
    once, to meet the ids and hashes that stay, and those of them that are there
    several times once more. ``docs`` is read three times, so it had better be a table.
    """
    found = grouped(docs, shingle, seed, bits)
    alike = found.groupBy("root", "doc_id", "hash").agg(F.count("*").alias("n"))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "hash", "n"))
    kept = staged(alike.groupBy("root").agg(least.alias("least")).select(
        F.col("least.doc_id").alias("k_id"), F.col("least.hash").alias("k_hash"),
        F.col("least.n").alias("n")), "kept")
    rows = docs.select(F.struct("*").alias("doc"), F.col("doc_id").cast("long").alias("id"),
                       F.xxhash64(F.col("text").cast("string")).alias("hash"))
    same = F.col("id").eqNullSafe(F.col("k_id")) & (F.col("hash") == F.col("k_hash"))
    single = rows.join(kept.where("n = 1"), same, "left_semi")
    several = rows.join(kept.where("n > 1"), same).dropDuplicates(["k_id", "k_hash"])
    return single.select("doc.*").union(several.select("doc.*"))
