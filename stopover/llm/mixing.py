"""Mixing sources to target sizes, by DataFrame operations only.

Sizes are summed by source, each source gets a target, and its rate is target
over size. A document is taken ``floor(rate)`` times, and once more if a number
in [0, 1) made from its id, its text, a running number among rows that are alike
in both, and a seed lies below the fraction that is left. So a source's sum is
right on average, also where ids are missing or repeated, and a run can be repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stopover.llm.common import WORD
from stopover.session import staged

# Copies of a source's size that its target never goes beyond.
MOST = 2.0
# Digits of the hash that make the random number: 52 bits, exact in a double.
DIGITS = 13
# Rows of a chunk, as a power of two, in which equal rows are numbered.
CHUNK = 10


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, share: float, weights: list[int], most: float = MOST) -> DataFrame:
    """Targets of sources with ``source, source_size``, one row each.

    Weights go round over the sources by code point, null last. Together the
    sources get ``share`` of all sizes, each in proportion to its weight; no
    target is above ``most`` times the source's size, and what that frees goes
    to the others by weight. With sources in order of the bound on target per
    weight, the level they share falls from the first one that isn't held at
    its bound; so the highest level below its bound is that of all who are not
    held. The order is a window over one row per source.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    rising = Window.orderBy("bound", F.col("source").isNull(), "source")
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weighted = sizes.withColumn("weight", F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), turn + 1))
    held = weighted.withColumn("bound", F.lit(float(most)) * F.col("source_size") / F.col("weight"))
    levels = held.withColumn("level", (
        F.lit(float(share)) * F.sum("source_size").over(everything)
        - F.lit(float(most)) * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
        / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    free = F.when(F.col("level") < F.col("bound"), F.col("level"))
    return levels.withColumn("common", F.max(free).over(everything)).select(
        "source", "source_size",
        F.when(F.col("common") < F.col("bound"), F.col("common") * F.col("weight"))
        .otherwise(F.lit(float(most)) * F.col("source_size")).alias("target"))


def draw(name: Column, number: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on a row's name, its number among its like, and a seed."""
    text = F.concat(name, F.lit(":"), number.cast("string"), F.lit(f":{seed}"))
    digits = F.substring(F.md5(text.cast("binary")), 1, DIGITS)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(16 ** DIGITS))


def named(id_column: Column, text: Column) -> Column:
    """Id and hash of the text (null id: like the text ``null``, null text: like an empty one)."""
    return F.concat(F.coalesce(id_column.cast("string"), F.lit("null")), F.lit(":"),
                    F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with ``number``, from 0 among rows of one ``name`` and source ``of``, in any order.

    Numbers are counted within chunks of rows that lay together, then the counts
    of a name's earlier chunks are added. So no task holds all rows of a name,
    only a count for each chunk that has it. Rows are written as a table first,
    so that a repeated task finds the same chunks.
    """
    placed = staged(rows.withColumn(
        "chunk", F.shiftright(F.monotonically_increasing_id(), CHUNK)), "chunks")
    earlier = Window.partitionBy("name", "of").orderBy("chunk").rowsBetween(
        Window.unboundedPreceding, -1)
    counts = placed.groupBy("name", "of", "chunk").count()
    later = staged(counts.withColumn("before", F.sum("count").over(earlier)).where("before > 0").select(
        F.col("name").alias("l_name"), F.col("of").alias("l_of"), F.col("chunk").alias("l_chunk"),
        "before"), "later_chunks")
    within = F.row_number().over(Window.partitionBy("name", "of", "chunk").orderBy("chunk")) - 1
    return placed.withColumn("within", within).join(
        later, (F.col("name") == F.col("l_name")) & F.col("of").eqNullSafe(F.col("l_of"))
        & (F.col("chunk") == F.col("l_chunk")), "left").withColumn(
        "number", F.col("within") + F.coalesce("before", F.lit(0)))


def repetitions(docs: DataFrame, share: float = 1.5, weights: list[int] | None = None,
                seed: int = 0, keep: list[str] | None = None, alike: bool = True) -> DataFrame:
    """How often each document is taken: a row per row, ``copies`` from 0 to 2.

    ``docs`` has ``doc_id, text, source``; the columns in ``keep`` (default: the
    id) come along in a struct ``doc``, so that no name can clash, with ``size``
    (words; null: 0), ``source_size``, ``target`` and ``copies`` beside it. A null
    source is a source; a null text counts as empty; a source without words
    has the target 0 and no copies; no rows give no rows. Rows alike in id, text and
    source each have a draw of their own; which of them is which is left open.
    A caller who knows that no two rows are alike says so (``alike``) and saves
    the running numbers, for which the columns in ``keep`` are shuffled.

    Sizes are summed before they are shuffled. The targets are one row per
    source, written as a table first, so that the join is planned by their
    true size: broadcast if Spark's threshold allows it, else a sort-merge join
    in which adaptive execution splits a hot source.
    """
    columns = [F.col(c) for c in (keep or ["doc_id"])]
    sized = docs.select(F.struct(*columns).alias("doc"),
                        named(F.col("doc_id"), F.col("text")).alias("name"),
                        F.col("source").alias("of"), n_words(F.col("text")).alias("size"))
    sized = numbered(sized) if alike else sized.withColumn("number", F.lit(0))
    sums = docs.select("source", n_words(F.col("text")).alias("size")).groupBy("source").agg(
        F.sum("size").alias("source_size"))
    table = staged(targets(sums, share, weights or [5, 2, 1]), "targets")
    joined = sized.join(table, F.col("of").eqNullSafe(F.col("source")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    copies = F.floor(rate) + (draw(F.col("name"), F.col("number"), seed) < rate - F.floor(rate)).cast("long")
    return joined.select("doc", "size", "source_size", "target", copies.alias("copies"))


def mixed(docs: DataFrame, share: float = 1.5, weights: list[int] | None = None,
          seed: int = 0, alike: bool = True) -> DataFrame:
    """The mix itself: all columns of ``docs``, of any name, a row for every copy.

    Odd rows count as in ``repetitions``.
    """
    taken = repetitions(docs, share, weights, seed, docs.columns, alike).where("copies > 0")
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select(
        "doc.*")
