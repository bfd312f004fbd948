"""How far the sources of a language lie apart, by the terms they use.

Terms that enough documents of a language hold are numbered in blocks of bounded
size. Each group (language and source) then has one array of (term id, count) per
block, sorted by id. A pair of groups is one merge of two such arrays: a
galloping intersection finds what they share, and shared, one-sided and absent
terms are priced by both groups. Tasks take the arrays of two tiles of sources,
so an array is sent once per tile and not once per source; each unordered pair is
merged once, within one task per block, and its parts are added up.

All prices are whole numbers: 1 + floor(SCALE * (count + 2) / (N + 2 * V)), and
the divergence of two prices is floor((p - q)^2 / (p + q)).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stopover.llm.common import on_workers, rows_of
from stopover.session import staged

SCALE = 1_000_000_000
# Terms are runs of ASCII letters, lower-cased, and of all that isn't ASCII; other bytes part them.
TERM_BYTES = bytes(
    b if b > 127 else ord(chr(b).lower()) if chr(b).isalpha() else 32 for b in range(256))

# Terms of a block, about; sources of a tile; ids for which the merge gallops at a time.
BLOCK, TILE, STRETCH = 8192, 8, 64
# Bytes and rows that a task counts or adds up at a time; tasks that share a hot group.
AT_ONCE, ROWS, SALTS = 16 << 20, 1 << 16, 64
# A term of a language: documents that hold it, and its occurrences by source.
TERMS = "lang string, term string, docs long, sources array<string>, n array<long>"
COLUMNS = ["lang", "term", "docs", "sources", "n"]


def price(count: Column, occurrences: Column, terms: Column) -> Column:
    """Price of a term in a group; decimals keep it exact at any size."""
    wide = "decimal(20,0)"
    over = F.lit(SCALE).cast("decimal(10,0)") * (count.cast(wide) + 2)
    under = occurrences.cast(wide) + terms.cast(wide) * 2
    return F.call_function("div", over, F.nullif(under, F.lit(0).cast(wide))) + 1


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def prices(counts: np.ndarray, under: int) -> np.ndarray:
    """The same for counts of an array."""
    if counts.max(initial=0) > (1 << 63) // SCALE - 3:
        counts = counts.astype(object)
    return (1 + SCALE * (counts + 2) // under).astype(np.int64)


def divergences(p: np.ndarray, q: np.ndarray | int) -> int:
    return int(((p - q) ** 2 // (p + q)).sum())


def intersection(few: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the common ids of two sorted arrays without repetitions, in each of them.

    For a stretch of ``few`` at a time the step through ``many`` doubles until it is
    past the stretch; a binary search looks at no more than was stepped over.
    """
    ours, theirs, start = [], [], 0
    for at in range(0, len(few), STRETCH):
        if start == len(many):
            break
        stretch, end, step = few[at:at + STRETCH], start, STRETCH
        while end < len(many) and many[end] < stretch[-1]:
            end, step = end + step, 2 * step
        window = many[start:end + 1]
        found = np.searchsorted(window, stretch)
        there = found < len(window)
        there[there] = window[found[there]] == stretch[there]
        ours.append(at + np.flatnonzero(there))
        theirs.append(start + found[there])
        start += int(found[-1])
    none = [np.zeros(0, np.int64)]
    return np.concatenate(ours or none), np.concatenate(theirs or none)


def merged(one: tuple, other: tuple, terms: int) -> tuple[int, int]:
    """Divergence of two groups over the terms that either has, and the number of those."""
    if len(one[0]) > len(other[0]):
        one, other = other, one
    (ids, counts, total), (ids2, counts2, total2) = one, other
    p, q = prices(counts, total + 2 * terms), prices(counts2, total2 + 2 * terms)
    p_none = int(prices(np.zeros(1, np.int64), total + 2 * terms)[0])
    q_none = int(prices(np.zeros(1, np.int64), total2 + 2 * terms)[0])
    ours, theirs = intersection(ids, ids2)
    value = divergences(p[ours], q[theirs])
    value += divergences(np.delete(p, ours), q_none) + divergences(np.delete(q, theirs), p_none)
    return value, len(ids) + len(ids2) - len(ours)


def tile_pairs(left: pa.Table, right: pa.Table) -> pa.Table:
    """Merges of all unordered pairs of groups of two tiles, for one block."""
    def groups(table: pa.Table) -> Iterator[tuple]:
        for number, entries, occurrences, terms in zip(
                table["number"].to_pylist(), table["entries"], table["occurrences"].to_pylist(),
                table["terms"].to_pylist()):
            ids = entries.values.field("id").to_numpy() if entries.is_valid else np.zeros(0, int)
            counts = entries.values.field("n").to_numpy() if entries.is_valid else ids
            yield number, terms, (ids, counts, occurrences)

    others = list(groups(right))
    rows = [(number, number2, *(merged(one, other, terms) if terms else (0, 0)))
            for number, terms, one in groups(left)
            for number2, _, other in others if number < number2]
    lang = left["lang"][:1].to_pylist() * len(rows)
    columns = list(zip(*rows)) if rows else [()] * 4
    return pa.table({"lang": pa.array(lang, pa.string())} | {
        name: pa.array(values, pa.int64())
        for name, values in zip(("a", "b", "value", "either"), columns)})


def words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The terms of all texts one after another, and the row that each is of."""
    texts = texts.cast(pa.large_string()).fill_null("")
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2].slice(ends[0], ends[-1] - ends[0]) if ends[-1] > ends[0] else b""
    raw = np.frombuffer(bytes(raw).translate(TERM_BYTES), np.uint8)
    inside, ends = raw != 32, ends - ends[0]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    starts = ends[:-1][ends[:-1] < len(raw)]
    begins[starts] = inside[starts]
    rows = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(np.flatnonzero(begins), ends)))
    raw, begins = raw[inside], begins[inside]
    bounds = np.append(np.flatnonzero(begins), len(raw)).astype(np.int64)
    return pa.LargeStringArray.from_buffers(
        len(rows), pa.py_buffer(bounds), pa.py_buffer(raw)), rows


def codes(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Numbers of the values, and the values by number."""
    made = column.dictionary_encode()
    return made.indices.to_numpy().astype(np.int64), made.dictionary


def changes(ordered: np.ndarray) -> np.ndarray:
    """Where a value differs from the one before it; true for the first."""
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    return new


def listed(values: pa.Array, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), values)


def chunk_counts(batch: pa.RecordBatch) -> pa.RecordBatch:
    """TERMS of documents ``lang, source, text``: one row for each term of a language.

    A term's number within its language and its document's rank by group make one
    number, so that one sort brings together terms, within them sources, within them documents.
    """
    langs, lang_names = codes(batch.column(0))
    sources, source_names = codes(batch.column(1))
    found, rows = words(batch.column(2))
    number, names = codes(found)
    by_group = np.lexsort((sources, langs))
    rank = np.empty_like(by_group)
    rank[by_group] = np.arange(len(by_group))
    low, middle = len(rank).bit_length(), len(names).bit_length()
    keys = (langs[rows] << middle | number) << low | rank[rows]
    keys.sort()
    terms, source = keys >> low, sources[by_group][keys & ((1 << low) - 1)]
    new = changes(terms)
    at, entry = np.flatnonzero(new), np.flatnonzero(new | changes(source))
    in_docs = np.add.reduceat(changes(keys), at, dtype=np.int64) if len(at) else at
    terms = terms[at]
    return pa.RecordBatch.from_arrays([
        lang_names.take(pa.array(terms >> middle)),
        names.take(pa.array(terms & ((1 << middle) - 1))).cast(pa.string()),
        pa.array(in_docs, pa.int64()),
        listed(source_names.take(pa.array(source[entry])),
               np.append(np.searchsorted(entry, at), len(entry))),
        listed(pa.array(np.diff(entry, append=len(keys)), pa.int64()),
               np.append(np.searchsorted(entry, at), len(entry))),
    ], COLUMNS)


def added(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Rows of TERMS in order, those of the same term of a language added up."""
    lang, term = batch.column(0), batch.column(1)
    new = np.ones(len(lang), bool)
    new[1:] = pc.or_(pc.not_equal(term[1:], term[:-1]), pc.not_equal(lang[1:], lang[:-1])).to_numpy(
        zero_copy_only=False)
    at, held = np.flatnonzero(new), pc.list_value_length(batch.column(3)).to_numpy()
    source, names = codes(batch.column(3).flatten())
    keys = np.repeat(np.cumsum(new) - 1, held) * len(names) + source
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    entry = np.flatnonzero(changes(keys))
    bounds = np.searchsorted(keys[entry], np.arange(len(at) + 1) * len(names))
    n = np.add.reduceat(batch.column(4).flatten().to_numpy()[order], entry)
    return pa.RecordBatch.from_arrays([
        lang.take(pa.array(at)), term.take(pa.array(at)),
        pa.array(np.add.reduceat(batch.column(2).to_numpy(), at)),
        listed(names.take(pa.array(source[order][entry])), bounds),
        listed(pa.array(n), bounds)], COLUMNS)


def gathered(
    batches: Iterator[pa.RecordBatch], weight: Callable[[pa.RecordBatch], int], limit: int,
) -> Iterator[pa.RecordBatch]:
    """Several batches as one of at most that weight, unless a single one is heavier."""
    held: list[pa.RecordBatch] = []
    total = 0
    for batch in batches:
        if held and total + weight(batch) > limit:
            yield pa.concat_batches(held)
            held, total = [], 0
        held.append(batch)
        total += weight(batch)
    if held:
        yield pa.concat_batches(held)


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """TERMS of all documents of a task, as many of them at a time as AT_ONCE allows."""
    parts = (rows for batch in batches for rows in rows_of(batch))
    for chunk in gathered(parts, lambda b: b.nbytes + b.num_rows * (AT_ONCE // ROWS), AT_ONCE):
        made = chunk_counts(chunk)
        for start in range(0, made.num_rows, ROWS):
            yield made.slice(start, ROWS)


def frequent(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Sums of TERMS in order, of terms in at least so many documents of their language."""
    last: list[pa.RecordBatch] = []
    for batch in gathered(batches, lambda b: b.num_rows, ROWS):
        if not batch.num_rows:
            continue
        made = added(pa.concat_batches([*last, batch]))
        # The last term may go on in the next batch.
        last = [made.slice(made.num_rows - 1)]
        made = made.slice(0, made.num_rows - 1)
        yield made.filter(pc.greater_equal(made.column(2), least))
    for made in last:
        yield made.filter(pc.greater_equal(made.column(2), least))


def term_counts(docs: DataFrame, least: int) -> DataFrame:
    """TERMS of the terms that at least so many documents of their language hold.

    A task's counts leave it as one row per term and language, with its sources in
    arrays, and meet those of other tasks in one shuffle, which spreads by term.
    """
    return (
        docs.mapInArrow(counted, TERMS).repartition("lang", "term")
        .sortWithinPartitions("term", "lang")
        .mapInArrow(lambda batches: frequent(batches, least), TERMS))


def spread_join(many: DataFrame, few: DataFrame, keys: list[str], by: str) -> DataFrame:
    """Left join with a small table of unique keys, whose hot ones are dealt to SALTS tasks."""
    salted = few.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return many.withColumn("salt", F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int")).join(
        salted, [*keys, "salt"], "left").drop("salt")


class Counts:
    """Tables of one audit: groups, languages, and what each group holds of the kept terms."""

    def __init__(self, docs: DataFrame, least: int):
        lang = F.coalesce("lang", F.lit("")).alias("lang")
        source = F.coalesce("source", F.lit("")).alias("source")
        occurrences = F.aggregate("n", F.lit(0).cast("long"), lambda a, b: a + b)
        vocabulary = staged(
            term_counts(docs.select(lang, source, "text"), least), "terms",
        ).select("lang", "term", occurrences.alias("in_lang"), "sources", "n")
        sizes = vocabulary.groupBy("lang").agg(
            F.count("*").alias("terms"), F.sum("in_lang").alias("lang_total"))
        blocks = F.greatest(F.ceil(F.col("terms") / BLOCK), F.lit(1)).cast("long")
        sizes = sizes.withColumn("blocks", blocks)
        inside = Window.partitionBy("lang", "block").orderBy("term")
        numbered = (
            spread_join(vocabulary, sizes, ["lang"], "term")
            .withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks")))
            .withColumn("id", F.row_number().over(inside).cast("long"))
            .withColumn("held", F.explode(F.arrays_zip("sources", "n")))
            .select("lang", F.col("held.sources").alias("source"), "term", "held.n", "in_lang",
                    "block", "id"))
        self.kept = staged(numbered, "kept")
        totals = self.kept.groupBy("lang", "source").agg(F.sum("n").alias("occurrences"))
        # One row per group, in one task per language.
        in_lang = Window.partitionBy("lang")
        groups = (
            docs.select(lang, source).distinct()
            .join(totals, ["lang", "source"], "left")
            .join(sizes, "lang", "left")
            .withColumn("number", F.row_number().over(in_lang.orderBy("source")).cast("long") - 1)
            .withColumn("groups", F.count("*").over(in_lang)))
        self.groups = staged(groups.na.fill(
            0, ["occurrences", "terms", "lang_total"]).na.fill(1, ["blocks"]), "groups")


def pairs(counts: Counts) -> DataFrame:
    """``lang, source, item, value`` of each group and each other source of its language."""
    arrays = counts.kept.groupBy("lang", "source", "block").agg(
        F.sort_array(F.collect_list(F.struct("id", "n"))).alias("entries"))
    tile = F.floor(F.col("number") / TILE)
    last = F.floor((F.col("groups") - 1) / TILE)
    dense = counts.groups.select(
        "lang", "source", "number", "occurrences", "terms", tile.alias("tile"), last.alias("last"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"),
    ).join(arrays, ["lang", "source", "block"], "left").drop("source")
    keys = ["lang", "block", "i", "j"]
    left = dense.select("*", F.col("tile").alias("i"),
                        F.explode(F.sequence("tile", "last")).alias("j"))
    right = dense.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tile"))).alias("i"),
                         F.col("tile").alias("j"))
    right = right.toDF(*right.columns)
    parts = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        tile_pairs, "lang string, a long, b long, value long, either long")
    summed = parts.groupBy("lang", "a", "b").agg(
        F.sum("value").alias("value"), F.sum("either").alias("either"))

    def named(side: str) -> DataFrame:
        none = price(F.lit(0), F.col("occurrences"), F.col("terms"))
        return counts.groups.select(
            "lang", F.col("number").alias(side), F.col("source").alias(f"{side}_source"),
            none.alias(f"{side}_none"), *(["terms"] if side == "a" else []))

    absent = (F.col("terms") - F.col("either")) * divergence(F.col("a_none"), F.col("b_none"))
    whole = summed.join(named("a"), ["lang", "a"]).join(named("b"), ["lang", "b"]).select(
        "lang", (F.col("value") + F.coalesce(absent, F.lit(0))).alias("value"),
        F.explode(F.array(
            F.struct(F.col("a_source").alias("source"), F.col("b_source").alias("item")),
            F.struct(F.col("b_source").alias("source"), F.col("a_source").alias("item")),
        )).alias("way"))
    return whole.select("lang", "way.source", "way.item", "value")


def terms(counts: Counts) -> DataFrame:
    """``lang, source, item, value`` of terms that a group holds more of than its language."""
    p = price(F.col("n"), F.col("occurrences"), F.col("terms"))
    q = price(F.col("in_lang"), F.col("lang_total"), F.col("terms"))
    groups = counts.groups.select("lang", "source", "occurrences", "terms", "lang_total")
    priced = spread_join(counts.kept, groups, ["lang", "source"], "term").select(
        "lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q"))
    return priced.where("p > q").select(
        "lang", "source", "item", divergence(F.col("p"), F.col("q")).alias("value"))


def audit(docs: DataFrame, least: int = 10, top: int = 10) -> DataFrame:
    """``lang, source, part, item, value, rank``: pairs of sources, and terms that stand out.

    Part ``pair`` has every other source of the language, farthest first; part
    ``term`` the ``top`` terms that the group has more of than its language,
    in falling order of their divergence. Items of one value go by their bytes.
    Null texts, languages and sources are empty; repeated rows count each; other
    columns don't matter. A group without terms has pairs (all values 0 if its
    language has no kept term) and no terms. No documents give no rows.

    The result itself has a row for each two sources of a language, so their
    number is bounded by what a report may hold; terms and documents are not.
    """
    on_workers(docs.sparkSession)
    counts = Counts(docs, least)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order)
    far = pairs(counts).withColumn("rank", rank).withColumn("part", F.lit("pair"))
    loud = terms(counts).withColumn("rank", rank).where(F.col("rank") <= top).withColumn(
        "part", F.lit("term"))
    return far.unionByName(loud).select("lang", "source", "part", "item", "value", "rank")
