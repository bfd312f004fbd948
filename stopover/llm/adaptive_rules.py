"""Quality rules with thresholds learned per language and source, by DataFrame operations only.

Each document gets integer measures, most of them shares in thousandths. Per
language, source and measure the values are counted in fixed buckets: a
quantile sketch that is exact to its bucket's width (1 below 1024, above that
less than a 500th of the value, without a last one), and that merges by adding
counts, in any order and over any grouping. A threshold is an upper fence
from such a sketch: the upper quartile, plus a multiple of its distance from the
median, plus a margin for groups that hardly vary. The values themselves, not
their buckets, are held against it. Groups too small for that
take the merged sketch of their language, or of everything. Documents are
joined with the thresholds of their group and judged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stopover.llm.common import WORD
from stopover.session import staged

SPACE = r"[\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
# Rows that a group needs for thresholds of its own, and spreads above the upper quartile.
ENOUGH, SPREADS = 200, 6
# Measure: numerator, denominator, parts of one, margin.
MEASURES = {
    "symbols": ("n_symbols", "word_chars", 1000, 50),
    "upper": ("n_upper", "word_chars", 1000, 200),
    "dup_lines": ("n_dup_lines", "n_lines", 1000, 300),
    "repeat_words": ("n_repeat_words", "n_words", 1000, 200),
    "word_length": ("word_chars", "n_words", 10, 60),
}
# Leading binary digits of a value that its bucket keeps.
DIGITS = 10


def n_repeat_words(docs: DataFrame) -> DataFrame:
    """Add ``n_repeat_words`` to rows with an array ``words``.

    Every 3-word window becomes a number: high bits of a hash, low bits its
    place. Sorted, windows that may be equal are neighbours; only those are
    compared as text. Each window found twice covers its three words.
    """
    at = F.call_function
    bits = F.coalesce(F.length(F.bin(F.size("words"))), F.lit(1))
    docs = docs.withColumn("bits", bits)
    window = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size("words") - 3, F.lit(0))),
        lambda i: at("shiftleft", F.xxhash64(
            F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)), F.col("bits"))
        .bitwiseOR(i.cast("long")))
    docs = docs.withColumn("sorted", F.sort_array(
        F.when(F.size("words") >= 3, window).otherwise(F.array().cast("array<bigint>"))))

    def same(x: Column, k: Column) -> Column:
        other = F.get("sorted", k)
        return at("shiftright", x, F.col("bits")) == at("shiftright", other, F.col("bits"))

    maybe = F.filter("sorted", lambda x, k: same(x, k - 1) | same(x, k + 1))
    docs = docs.withColumn("maybe", maybe)
    shown = F.transform("maybe", lambda x: x.bitwiseAND(
        at("shiftleft", F.lit(1).cast("long"), F.col("bits")) - 1).cast("int"))
    texts = F.transform(shown, lambda p: F.struct(
        F.concat_ws(" ", F.get("words", p), F.get("words", p + 1), F.get("words", p + 2))
        .alias("w"), p.alias("p")))
    docs = docs.withColumn("pairs", F.sort_array(texts))
    twice = F.filter("pairs", lambda x, k: (x["w"] == F.get("pairs", k - 1)["w"])
                     | (x["w"] == F.get("pairs", k + 1)["w"]))
    docs = docs.withColumn("starts", F.sort_array(F.transform(twice, lambda x: x["p"])))
    cover = F.aggregate(
        F.transform("starts", lambda p, k: F.least(
            F.lit(3), F.coalesce(F.get("starts", k + 1) - p, F.lit(3)))),
        F.lit(0), lambda total, x: total + x)
    return docs.withColumn("n_repeat_words", cover.cast("long")).drop(
        "bits", "sorted", "maybe", "pairs", "starts")


def measured(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Counts of every whole text, beside ``lang``, ``source`` and a struct ``doc`` of ``keep``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.struct(*keep).alias("doc"), "lang", "source", text.alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(WORD))
    rows = rows.select(
        "doc", "lang", "source",
        F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("words"),
        lines.alias("lines"),
        F.length(F.regexp_replace("text", SPACE, "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        F.regexp_count("text", F.lit("[A-Z]")).cast("long").alias("n_upper"))
    rows = rows.withColumns({
        "n_words": F.size("words").cast("long"),
        "n_lines": F.size("lines").cast("long"),
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long")})
    return n_repeat_words(rows.drop("lines")).drop("words")


def values() -> dict[str, Column]:
    """Whole values of the measures of a row, by name; 0 of nothing."""
    return {name: F.when(F.col(below) > 0, F.expr(f"({over} * {parts}) div {below}")).otherwise(0)
            for name, (over, below, parts, _) in MEASURES.items()}


def bucket(value: Column) -> Column:
    """The least value whose leading binary digits are those of ``value``."""
    more = F.greatest(F.length(F.bin(value)) - DIGITS, F.lit(0))
    at = F.call_function
    return at("shiftleft", at("shiftright", value, more), more)


def buckets() -> Column:
    """Measure names and bucket numbers of a row, as an array of structs."""
    return F.array(*[
        F.struct(F.lit(name).alias("measure"), bucket(value).alias("bucket"))
        for name, value in values().items()])


def fences(counts: DataFrame) -> DataFrame:
    """Upper fences from sketches ``lang, source, measure, bucket, n``, a row per language and source.

    ``by`` is 2 where a sketch is of a language and source, 1 of a language, 0
    of everything; a group takes the finest with enough rows.
    """
    merged = (
        counts.withColumn("by", F.lit(2))
        .unionByName(counts.groupBy("lang", "measure", "bucket").agg(F.sum("n").alias("n"))
                     .withColumns({"by": F.lit(1), "source": F.lit(None).cast("string")}))
        .unionByName(counts.groupBy("measure", "bucket").agg(F.sum("n").alias("n"))
                     .withColumns({"by": F.lit(0), "source": F.lit(None).cast("string"),
                                   "lang": F.lit(None).cast("string")})))
    sketch = Window.partitionBy("by", "lang", "source", "measure")
    ranked = merged.withColumns({
        "below": F.sum("n").over(sketch.orderBy("bucket")), "rows": F.sum("n").over(sketch)})
    margins = F.create_map(*[F.lit(x) for m, (*_, margin) in MEASURES.items() for x in (m, margin)])
    half = F.min(F.when(F.col("below") * 2 >= F.col("rows"), F.col("bucket")))
    upper = F.min(F.when(F.col("below") * 4 >= F.col("rows") * 3, F.col("bucket")))
    levels = ranked.groupBy("by", "lang", "source", "measure").agg(
        F.max("rows").alias("rows"), half.alias("half"), upper.alias("upper")).withColumn(
        "fence", F.col("upper") + SPREADS * (F.col("upper") - F.col("half"))
        + F.element_at(margins, F.col("measure")))
    table = staged(levels.select("by", "lang", "source", "measure", "rows", "fence"), "fences")
    own = table.where("by = 2").alias("own")
    language = table.where("by = 1").alias("language")
    everything = table.where("by = 0").alias("everything")
    chosen = own.join(language, F.expr(
        "own.lang <=> language.lang and own.measure = language.measure")).join(
        everything, F.expr("own.measure = everything.measure"))
    fence = F.when(F.col("own.rows") >= ENOUGH, F.col("own.fence")).when(
        F.col("language.rows") >= ENOUGH, F.col("language.fence")).otherwise(
        F.col("everything.fence"))
    return chosen.select("own.lang", "own.source", "own.measure", fence.alias("fence")).groupBy(
        F.col("lang").alias("f_lang"), F.col("source").alias("f_source")).agg(*[
            F.max(F.when(F.col("measure") == m, F.col("fence"))).alias(f"f_{m}")
            for m in MEASURES])


def judged(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Counts and verdict of every row.

    ``docs`` has ``doc_id, text, lang, source``. Returns a struct ``doc`` of the
    columns in ``keep`` (default: the id), ``n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, n_lines, n_upper``, ``base_failed`` (under 50
    words, or over half of them in repeated 3-word windows) and ``kept``: not
    failed, and no measure above its group's fence. A null text has no words;
    null languages and sources are groups of their own; repeated rows count
    and stay; no rows give no rows.

    The counts are staged once; sketches and verdicts read that. The fences,
    a row per language and source, are a table too, so that the join goes by
    their true size.
    """
    rows = staged(measured(docs, keep or ["doc_id"]), "measures")
    counts = rows.select("lang", "source", F.explode(buckets()).alias("b")).groupBy(
        "lang", "source", "b.measure", "b.bucket").agg(F.count("*").alias("n"))
    limits = staged(fences(staged(counts, "sketches")), "limits")
    joined = rows.join(limits, F.expr("lang <=> f_lang and source <=> f_source"))
    above = F.exists(F.array(*[
        F.struct(value.alias("value"), F.col(f"f_{m}").alias("fence"))
        for m, value in values().items()]), lambda x: x["value"] > x["fence"])
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return joined.select(
        "doc", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
        "n_upper", failed.alias("base_failed"), (~failed & ~above).alias("kept"))


def good_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, all columns."""
    return judged(docs, docs.columns).where("kept").select("doc.*")
