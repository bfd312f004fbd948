"""Quality of a text by compression with the dictionaries of good and bad texts.

Two zstandard dictionaries are built, one from texts labelled good, one from
bad ones. A text is compressed with each, block by block, so that the
dictionary counts as much at its end as at its start; the difference of the two
sizes over their sum says which kind it resembles. A logistic curve turns that
into a probability. What a difference means depends on how far the text could
be compressed at all (a text of one word over and over needs next to nothing
with either), so the curve has a second argument, the logarithm of the
compressed share, and its square. It is fitted on texts that the dictionaries
at hand have not seen: the sample is split in folds, and each fold is measured
with the dictionaries of the others.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopover.llm.common import on_workers, rows_of, utf8

# Most labelled texts of each kind, bytes of a dictionary, of a block, and level.
SAMPLE, SIZE, BLOCK, LEVEL = 1500, 1 << 16, 1 << 12, 3
# Most blocks of a labelled text to learn from, spread evenly over it: 64 KiB.
LEARNED = 16
FOLDS = 3
# Bytes, half of them left, that every text is thought to be longer by: short ones prove little.
PRIOR = 200


def blocks(raw: bytes) -> list[bytes]:
    return [raw[i:i + BLOCK] for i in range(0, len(raw), BLOCK)]


def spread_blocks(text: Column, most: int = LEARNED) -> Column:
    """The blocks of a text in UTF-8, or ``most`` of them, evenly from its start to its end."""
    raw = F.encode(text, "UTF-8")
    n = F.coalesce(F.ceil(F.octet_length(text) / BLOCK).cast("long"), F.lit(0).cast("long"))
    taken = F.least(n, F.lit(most))
    # the first and the last block are among those taken
    at = lambda i: F.when(taken < 2, F.lit(0)).otherwise(
        F.floor(i * (n - 1) / (taken - 1)))
    return F.when(n == 0, F.array().cast("array<binary>")).otherwise(F.transform(
        F.sequence(F.lit(0).cast("long"), taken - 1),
        lambda i: F.substring(raw, (at(i) * BLOCK + 1).cast("int"), F.lit(BLOCK))))


def dictionary(texts: list[list[bytes]]) -> bytes:
    """Trained on the blocks of texts; of very few texts, what they hold."""
    samples = [b for own in texts for b in own]
    try:
        return zstandard.train_dictionary(SIZE, samples).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(samples)[-SIZE:] or b"\n"


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    held = zstandard.ZstdCompressionDict(content)
    held.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=held, write_content_size=False, write_dict_id=False)


@dataclass
class Model:
    good: bytes
    bad: bytes
    weights: tuple[float, ...] = (0.0, 0.0, 0.0, 0.0)
    least: float = 0.0
    most: float = 0.0

    def __post_init__(self):
        self.key = uuid.uuid4().hex

    @staticmethod
    def measure(pair, own: list[bytes]) -> tuple[float, float]:
        """Size with the bad dictionary less that with the good one, over their sum; share left."""
        good, bad = (sum(len(c.compress(b)) for b in own) for c in pair)
        both = good + bad + PRIOR
        return (bad - good) / both, float(np.log(both / (2 * (sum(map(len, own)) + PRIOR))))

    def pair(self):
        return compressor(self.good), compressor(self.bad)

    def score(self, measures: np.ndarray) -> np.ndarray:
        """Probability of the good label for rows of measures; shares stay in the learned range."""
        difference, share = measures[:, 0], np.clip(measures[:, 1], self.least, self.most)
        return curve(np.stack([difference, share, share ** 2, np.ones_like(share)], axis=1)
                     @ np.array(self.weights))


def curve(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def logistic(columns: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, ...]:
    """Weights of a logistic curve and its offset, by Newton's method with a small ridge."""
    if not len(columns) or y.min() == y.max():
        rate = (y.sum() + 1) / (len(y) + 2)
        return (*[0.0] * columns.shape[1], float(np.log(rate / (1 - rate))))
    scale, middle = columns.std(axis=0), columns.mean(axis=0)
    scale[scale == 0] = 1
    a = np.column_stack([(columns - middle) / scale, np.ones(len(y))])
    w = np.zeros(a.shape[1])
    for _ in range(rounds):
        p = curve(a @ w)
        move = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + 0.1 * np.eye(len(w)),
                               a.T @ (p - y) + 0.1 * w)
        w -= move
        if np.abs(move).max() < 1e-9:
            break
    plain = w[:-1] / scale
    return (*plain.tolist(), float(w[-1] - plain @ middle))


def train(texts: list[list[bytes]], labels: list[int]) -> Model:
    """Dictionaries of all texts, given in blocks, and the curve from folds that they haven't seen.

    Below twelve texts there are no folds, and all texts score the share of good ones.
    """
    y = np.array(labels, float)
    turn = np.arange(len(texts)) % FOLDS
    x = np.zeros((len(texts), 2))
    for fold in range(FOLDS if len(texts) >= 4 * FOLDS else 0):
        pair = Model(*[
            dictionary([t for t, q, f in zip(texts, labels, turn) if f != fold and q == k])
            for k in (1, 0)]).pair()
        for i in np.flatnonzero(turn == fold):
            x[i] = Model.measure(pair, texts[i])
    least, most = (float(np.quantile(x[:, 1], q)) if len(x) else 0.0 for q in (0.005, 0.995))
    share = np.clip(x[:, 1], least, most)
    weights = logistic(np.stack([x[:, 0], share, share ** 2], axis=1), y)
    return Model(*[dictionary([t for t, q in zip(texts, labels) if q == k]) for k in (1, 0)],
                 weights, least, most)


def fit(docs: DataFrame, labels: DataFrame, usable: Column, sample: int = SAMPLE) -> Model:
    """Train on labelled documents whose ``doc_id`` makes ``usable`` true, ``sample`` a kind at most.

    Of each kind the rows with the smallest hashes of the id are taken, the
    same ones in every run; an id with several labels counts as bad if any is.
    The chosen ids, a bounded number, are broadcast. Texts are cut into blocks in
    the tasks, and at most ``LEARNED`` blocks of each come to the driver; what is
    scored are whole texts.
    """
    on_workers(docs.sparkSession)
    known = labels.where(usable & F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = [known.where(F.col("quality") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
              for k in (1, 0)]
    ids = docs.sparkSession.createDataFrame(
        [tuple(r) for c in chosen for r in c.select("doc_id", "quality").collect()],
        "id long, quality int")
    rows = docs.select("doc_id", "text").where("text is not null").join(
        F.broadcast(ids), F.col("doc_id") == F.col("id")).select("id", "quality", "text")
    one = rows.groupBy("id", "quality").agg(F.min("text").alias("text"))
    cut = one.select("id", "quality", spread_blocks(F.col("text").cast("string")).alias("blocks"))
    got = sorted(cut.toArrow().to_pylist(), key=lambda r: r["id"])
    return train([r["blocks"] for r in got], [r["quality"] for r in got])


_models: dict[str, tuple] = {}


def _score(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    model = shared.value
    if model.key not in _models:
        _models.clear()
        _models[model.key] = model.pair()
    pair = _models[model.key]
    for batch in batches:
        for part in rows_of(batch):
            found = np.array([model.measure(pair, blocks(raw))
                              for raw in utf8(part.column("text"))])
            yield pa.RecordBatch.from_arrays(
                [part.column("doc"), pa.array(found[:, 0]), pa.array(model.score(found))],
                names=["doc", "measure", "score"])


def scored(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """Score of every whole text, from 0 to 1 (likely good): a row per row.

    Returns a struct ``doc`` of the columns in ``keep`` (default: the id), the
    ``measure`` and the ``score``. An empty or null text measures 0, its score is that of
    a text that resembles both kinds alike; without labels of both kinds all
    texts have the share of good labels. Equal texts have equal scores, repeated rows
    are each returned, further columns are not read unless kept; no rows give no rows.
    """
    spark = docs.sparkSession
    on_workers(spark)
    rows = docs.select(F.struct(*(keep or ["doc_id"])).alias("doc"),
                       F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(partial(_score, shared=spark.sparkContext.broadcast(model)),
                           f"doc {kind}, measure double, score double")
