"""Log-probabilities of texts: all segmentations of their words into known pieces.

Pieces are those of an existing public vocabulary. A text is its words, each led
by a blank, and an end; its probability is the sum, over all ways to cut it
into pieces, of the product of the pieces' probabilities. Since no piece reaches
over a blank, that is a product over words, and a word's own probability comes from
a forward recursion in log space over its bytes. Single bytes are pieces too, so
every word has one.

What the pieces weigh is learned: their shares in the training words, as the
vocabulary's own tokenizer cuts them, one added to each count. Words are counted
over all documents, and each different word goes through the lattice once. Words
so frequent that no more than HOT of them can exist are looked up within tasks; the
others of a document are joined with the table of words, where no key is hot any more.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopover.llm.common import on_workers, rows_of, utf8
from stopover.session import staged

# A word is hot if it makes up 1/HOT of all words or more; bytes up to which it is sent itself.
HOT, SHORT = 400_000, 64
# Different words that a task counts before it passes the counts on.
AT_ONCE = 200_000

_pieces: dict[str, dict[int, bytes]] = {}
_LOG10 = math.log(10)


def words(text: bytes) -> list[bytes]:
    """Words of a text in UTF-8, A-Z lower-cased: what ASCII white space parts."""
    return text.lower().split()


def processor(path: str):
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=path)


def pieces(path: str) -> dict[int, bytes]:
    """Bytes of the pieces that can occur in a word, by their id; a blank leads a word."""
    if path not in _pieces:
        model, found = processor(path), {}
        for number in range(model.get_piece_size()):
            piece = model.id_to_piece(number)
            if model.is_byte(number):
                found[number] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(number) or model.is_unknown(number)
                      or model.is_unused(number) or "▁" in piece[1:]):
                found[number] = re.sub("^▁", " ", piece).encode()
        _pieces[path] = found
    return _pieces[path]


def log_sum(logs: list[float]) -> float:
    """Logarithm of a sum, from the logarithms of what is added."""
    if len(logs) == 1:
        return logs[0]
    top = max(logs)
    return top + math.log(sum([math.exp(x - top) for x in logs]))


class Lattice:
    """Natural logarithms of the pieces' probabilities, and the recursion over them."""

    def __init__(self, path: str, counts: dict[int, int], ends: int):
        known = pieces(path)
        total = sum(counts.get(number, 0) + 1 for number in known) + ends + 1
        share: dict[bytes, float] = {}
        for number, piece in known.items():
            # A character and a byte may be spelt alike: both are ways to write it.
            share[piece] = share.get(piece, 0.0) + (counts.get(number, 0) + 1) / total
        self.scores = {piece: math.log(p) for piece, p in share.items()}
        # Beginnings of longer pieces: where none goes on, no further end is tried.
        self.begins = {piece[:i] for piece in self.scores for i in range(1, len(piece))}
        self.end = math.log10((ends + 1) / total)

    def word(self, word: bytes) -> float:
        """log10 of the sum over all segmentations of the word with its blank."""
        text, scores, begins = b" " + word, self.scores, self.begins
        ways: list[list[float]] = [[] for _ in range(len(text) + 1)]
        ways[0].append(0.0)
        for start in range(len(text)):
            # All ways to this place are known: no piece ends behind where it starts.
            here, ways[start] = log_sum(ways[start]), []
            for end in range(start + 1, len(text) + 1):
                piece = text[start:end]
                score = scores.get(piece)
                if score is not None:
                    ways[end].append(here + score)
                if piece not in begins:
                    break
        return log_sum(ways[-1]) / _LOG10


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n, trained`` of all texts (``text, train``): all occurrences, and in training."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every: Counter[bytes] = Counter()
        trained: Counter[bytes] = Counter()

        def told() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays(
                [pa.array(list(every), pa.binary()), pa.array(list(every.values()), pa.int64()),
                 pa.array([trained[w] for w in every], pa.int64())], ["word", "n", "trained"])
            every.clear()
            trained.clear()
            return made

        for batch in batches:
            for rows in rows_of(batch):
                for text, train in zip(utf8(rows.column(0)), rows.column(1).to_pylist()):
                    own = words(text)
                    every.update(own)
                    if train:
                        trained.update(own)
                if len(every) > AT_ONCE:
                    yield told()
        yield told()

    return docs.select("text", "train").mapInArrow(
        counted, "word binary, n long, trained long",
    ).groupBy("word").agg(F.sum("n").alias("n"), F.sum("trained").alias("trained"))


def piece_counts(counted: DataFrame, path: str) -> dict[int, int]:
    """Occurrences of each piece in the training words, as the tokenizer cuts them."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, total = processor(path), Counter()
        for batch in batches:
            for rows in rows_of(batch):
                texts = [w.decode(errors="replace") for w in rows.column(0).to_pylist()]
                for ids, n in zip(model.encode(texts, num_threads=1), rows.column(1).to_pylist()):
                    for number in ids:
                        total[number] += n
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())],
            ["piece", "n"])

    # As many rows as the vocabulary has pieces.
    summed = counted.where("trained > 0").select("word", "trained").mapInArrow(
        cut, "piece long, n long").groupBy("piece").agg(F.sum("n").alias("n")).collect()
    return {row.piece: row.n for row in summed}


def hot_key(word: bytes) -> bytes:
    """What a frequent word is looked up by: itself, or a digest (led by a blank) if it's long."""
    return word if len(word) <= SHORT else b" " + hashlib.sha256(word).digest()


def frequent_words(weighed: DataFrame, total: int, under: float) -> dict[bytes, tuple]:
    """Known or not, base score and score of the hot words: at most HOT, by what hot means."""
    digest = F.concat(F.lit(b" "), F.unhex(F.sha2("word", 256)))
    key = F.when(F.length("word") <= SHORT, F.col("word")).otherwise(digest)
    rows = weighed.where(F.col("n") * HOT >= total).select(
        key.alias("key"), "trained", "score").collect()
    return {bytes(row.key): (row.trained > 0, math.log10(row.trained + 1) - under, row.score)
            for row in rows}


def scored(docs: DataFrame, trains: Column, path: str, keep: list[str]) -> DataFrame:
    """``doc`` (the columns ``keep``), ``n_tokens, n_known, train_tokens, base_score, score``.

    One row for each document. ``trains`` marks those that are learned from. Tokens
    are the words and one end. ``base_score`` is the sum of log10((c + 1) / (N + V + 1))
    over the tokens, c their counts in training, N all training tokens, V the different
    ones; ``score`` is log10 of the text's probability by the lattice of the vocabulary
    at ``path``. A null text is empty: the end alone. Repeated rows are scored each.
    Nothing to learn from makes all pieces alike and all tokens unknown. Columns of any
    name are fine; no documents give no rows.
    """
    spark = docs.sparkSession
    on_workers(spark)
    docs = docs.select(F.struct(*keep).alias("doc"), "text",
                       F.coalesce(trains, F.lit(False)).alias("train"))
    counted = staged(word_counts(docs), "words")
    sums = counted.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("all"),
        F.coalesce(F.sum("trained"), F.lit(0)).alias("trained"),
        F.count_if(F.col("trained") > 0).alias("different")).first()
    ends = docs.where("train").count()
    tokens = sums["trained"] + ends
    under = math.log10(tokens + sums["different"] + (ends > 0) + 1)
    lattice = Lattice(path, piece_counts(counted, path), ends)
    end_base, end = math.log10(ends + 1) - under, lattice.end
    shared = spark.sparkContext.broadcast(lattice)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [shared.value.word(w) for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64())],
                ["word", "n", "trained", "score"])

    weighed = staged(counted.mapInArrow(
        weigh, "word binary, n long, trained long, score double"), "weighed")
    hot = spark.sparkContext.broadcast(frequent_words(weighed, sums["all"], under))
    left_type = pa.list_(pa.struct([("word", pa.binary()), ("times", pa.int64())]))

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums over the end and the frequent words, and the counts of the others."""
        frequent = hot.value
        for batch in batches:
            for rows in rows_of(batch):
                told = []
                for text in utf8(rows.column(2)):
                    n, known, base, score, left = 1, int(ends > 0), end_base, end, []
                    for word, times in Counter(words(text)).items():
                        n += times
                        found = frequent.get(word if len(word) <= SHORT else hot_key(word))
                        if found is None:
                            left.append({"word": word, "times": times})
                        else:
                            known += times * found[0]
                            base += times * found[1]
                            score += times * found[2]
                    told.append((n, known, base, score, left))
                types = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), left_type]
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns[:2],
                     *[pa.array(values, kind) for values, kind in zip(zip(*told), types)]],
                    ["row", "doc", "n_tokens", "n_known", "base_score", "score", "left"])

    kind = docs.schema["doc"].dataType.simpleString()
    parted = staged(docs.select(
        F.monotonically_increasing_id().alias("row"), "doc", "text").mapInArrow(
        part, f"row long, doc {kind}, n_tokens long, n_known long, base_score double, "
              "score double, left array<struct<word:binary,times:long>>"), "parted")
    # No word here makes up more than 1/HOT of all, so no key of the join is hot.
    others = parted.select("row", F.explode("left").alias("of")).select(
        "row", "of.word", "of.times").join(weighed, "word")
    times, trained = F.col("times"), F.col("trained")
    sums_of_others = others.groupBy("row").agg(
        F.sum(F.when(trained > 0, times).otherwise(0)).alias("more_known"),
        F.sum(times * (F.log10(trained + 1) - under)).alias("more_base"),
        F.sum(times * F.col("score")).alias("more_score"))

    def both(column: str, more: str) -> Column:
        return (F.col(column) + F.coalesce(more, F.lit(0))).alias(column)

    return parted.drop("left").join(sums_of_others, "row", "left").select(
        "doc", "n_tokens", both("n_known", "more_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        both("base_score", "more_base"), both("score", "more_score"))
