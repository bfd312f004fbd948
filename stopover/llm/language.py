"""Language of a text by averaged hashed subword embeddings and a linear softmax.

A text is the average of the embeddings of the subwords (2 to 4 letters, word
ends marked) of its words, hashed to a fixed number of rows; a linear layer
and a softmax give the languages. Embeddings and layer are trained by
stochastic gradient descent in numpy on a bounded sample. Since all is linear
up to the softmax, a trained model needs one vector per word, which workers
keep: a text costs one look-up per word.

Probabilities are made honest by a temperature, fitted on logits of models that
have not seen the text (folds). A text is rejected by its evidence, the largest
logit, which is small if its subwords speak for no language. The threshold comes
from both kinds of text: from the folds, what known languages reach; and from
counter-examples, what strange texts reach, which are texts of languages left out
of training in turn, and sampled texts with their letters shuffled. It is the
lowest that rejects all counter-examples, unless that rejects more than a stated
share of the texts that are classified rightly; then it is the one that rejects
that share.
"""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stopover.llm.common import on_workers, rows_of, texts

LETTERS = re.compile(r"[^\W\d_]+")
ROWS, WIDTH, GRAMS = 1 << 14, 12, (2, 3, 4)
# Training texts: about so many, and of each language about so many if it has them; most languages.
SAMPLE, LEAST, LANGUAGES = 3000, 50, 100
# Folds of the sample, most turns in which languages are left out, texts to one that is shuffled.
FOLDS, TURNS, SHUFFLED = 3, 4, 10
# Words a worker keeps, and as many of the generation before.
KEPT = 100_000
UNKNOWN = "und"


def subwords(word: str) -> list[int]:
    marked = f"<{word}>"
    return [zlib.crc32(marked[i:i + n].encode()) % ROWS
            for n in GRAMS for i in range(len(marked) - n + 1)]


@dataclass
class Model:
    languages: list[str]
    vectors: np.ndarray  # a row per subword: what it adds to each language
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = -np.inf  # of the evidence
    kept: dict = field(default_factory=dict, repr=False)
    old: dict = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "kept": {}, "old": {}}

    def word(self, word: str) -> bytes:
        """What a word adds to each language, and the number of its subwords, as doubles."""
        rows = subwords(word)
        return np.append(self.vectors[rows].sum(axis=0), len(rows)).tobytes()

    def logits(self, text: str) -> np.ndarray | None:
        """What speaks for each language; None if the text has no letter."""
        words = LETTERS.findall(text.lower())
        if not any(letter.isalpha() for word in words for letter in word):
            return None
        if len(self.kept) > KEPT:
            self.old, self.kept = self.kept, {}
        kept, old = self.kept, self.old
        rows = list(map(kept.get, words))
        if None in rows:
            for i, word in enumerate(words):
                if rows[i] is None:
                    rows[i] = kept.get(word) or old.get(word) or self.word(word)
                    if len(word) < 64:
                        kept[word] = rows[i]
        total = np.frombuffer(b"".join(rows)).reshape(len(rows), -1).sum(axis=0)
        return total[:-1] / total[-1] + self.bias

    def predict(self, text: str) -> tuple[str, float, bool]:
        """Language, its probability, and whether the text is rejected."""
        logits = self.logits(text) if self.languages else None
        if logits is None:
            return UNKNOWN, 0.0, True
        best = int(logits.argmax())
        score = softmax(logits / self.temperature)[best]
        return self.languages[best], float(score), bool(logits[best] < self.threshold)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def counted(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Subwords of a text and their shares."""
    words = Counter(LETTERS.findall(text.lower()))
    rows = np.zeros(ROWS)
    for word, n in words.items():
        np.add.at(rows, subwords(word), n)
    there = np.flatnonzero(rows)
    return there, rows[there] / max(1.0, rows.sum())


Sample = tuple[str, np.ndarray, np.ndarray]


def descend(samples: list[Sample], languages: list[str], epochs: int = 6,
            rate: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """Vectors and bias after some rounds of gradient descent, a sample at a time."""
    rng = np.random.default_rng(7)
    target = {name: i for i, name in enumerate(languages)}
    emb = rng.normal(0, 1 / WIDTH, (ROWS, WIDTH))
    layer, bias = rng.normal(0, 1 / WIDTH, (WIDTH, len(languages))), np.zeros(len(languages))
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for i in rng.permutation(len(samples)):
            name, rows, shares = samples[i]
            mean = shares @ emb[rows]
            error = softmax(mean @ layer + bias)
            error[target[name]] -= 1
            back = layer @ error
            layer -= step * np.outer(mean, error)
            bias -= 0.1 * step * error
            # a subword's own step: shares are small, so they are scaled up alike for all
            emb[rows] -= step * len(rows) ** 0.5 * shares[:, None] * back[None, :]
    return emb @ layer, bias


def measured(samples: list[Sample], vectors: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Logits of samples, a row each."""
    out = [shares @ vectors[rows] + bias for _, rows, shares in samples]
    return np.array(out).reshape(len(out), len(bias))


def train(samples: list[Sample], shuffled: list[Sample] = (), wrongly: float = 0.002,
          **options) -> Model:
    """Model of ``(language, subwords, shares)``, calibrated by folds and counter-examples.

    ``shuffled`` are texts in no language. To leave a language out takes two
    others to tell apart; with fewer only the shuffled texts are counter-examples.
    One language alone teaches nothing, so all texts with letters are its.
    """
    languages = sorted({s[0] for s in samples})
    samples = [s for s in samples if len(s[1])]
    model = Model(languages, *descend(samples, languages, **options))
    if not samples:
        return model
    target = {name: i for i, name in enumerate(languages)}
    truth = np.array([target[s[0]] for s in samples])
    fold = np.random.default_rng(11).permutation(len(samples)) % FOLDS
    logits = np.zeros((len(samples), len(languages)))
    for turn in range(FOLDS):
        unseen = [s for s, f in zip(samples, fold) if f == turn]
        logits[fold == turn] = measured(unseen, *descend(
            [s for s, f in zip(samples, fold) if f != turn], languages, **options))
    # an unseen text counts as one of its language but for one part in n + 2 (rule of succession)
    n = len(samples)
    hope = np.full(logits.shape, 1 / (n + 2) / max(1, len(languages) - 1))
    hope[np.arange(n), truth] = 1 - 1 / (n + 2)
    model.temperature = min(
        np.geomspace(0.05, 50, 120),
        key=lambda t: -(hope * np.log(softmax(logits / t) + 1e-12)).sum(axis=1).mean())
    if len(languages) > 1:
        right = np.sort(logits.max(axis=1)[logits.argmax(axis=1) == truth])
        strange = [measured([s for s in shuffled if len(s[1])], model.vectors, model.bias).max(axis=1)]
        for turn in range(min(TURNS, len(languages))):
            out = set(languages[turn::TURNS])
            rest = [name for name in languages if name not in out]
            if len(rest) > 1:
                strange.append(measured(
                    [s for s in samples if s[0] in out],
                    *descend([s for s in samples if s[0] not in out], rest, **options)).max(axis=1))
        highest = np.concatenate(strange).max(initial=-np.inf)
        if len(right):
            model.threshold = float(min(np.nextafter(highest, np.inf), right[int(wrongly * len(right))]))
    return model


def mixed_letters(text: str, seed: int) -> str:
    """The text with its letters in another order, all else in its place."""
    letters = [c for c in text if c.isalpha()]
    random.Random(seed).shuffle(letters)
    rest = iter(letters)
    return "".join(next(rest) if c.isalpha() else c for c in text)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Subwords of each text; of some texts also those with shuffled letters (language null)."""
    for batch in batches:
        rows = list(zip(batch.column("lang").to_pylist(), texts(batch.column("text"))))
        for text in [text for _, text in rows]:
            seed = zlib.crc32(text.encode())
            if seed % SHUFFLED == 0:
                rows.append((None, mixed_letters(text, seed)))
        found = [counted(text) for _, text in rows]
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang for lang, _ in rows], pa.string()),
             pa.array([f[0].astype(np.int16) for f in found], pa.list_(pa.int16())),
             pa.array([f[1].astype(np.float32) for f in found], pa.list_(pa.float32()))],
            names=["lang", "rows", "shares"])


def sampled(rows: DataFrame, size: int, least: int, most: int) -> DataFrame:
    """Distinct rows of ``lang, text``, those with low hashes of the text.

    About ``size`` of all, and about ``least`` of a language that has fewer in
    those; languages are the ``most`` with the largest numbers of distinct rows.
    The same rows in every run, however many copies there are of a row.
    """
    counts = rows.select("lang", F.xxhash64("text")).distinct().groupBy("lang").count()
    total = F.sum("count").over(Window.partitionBy())
    shares = counts.withColumn("all", total).orderBy(F.desc("count"), "lang").limit(most).select(
        F.col("lang").alias("of"),
        F.greatest(F.lit(float(size)) / F.col("all"), F.lit(float(least)) / F.col("count")).alias("share"))
    low = F.xxhash64("text").bitwiseAND(F.lit((1 << 52) - 1)) / F.lit(float(1 << 52))
    return rows.join(F.broadcast(shares), (F.col("lang") == F.col("of")) & (low < F.col("share"))).select(
        "lang", "text").distinct()


def fit(docs: DataFrame, usable: Column, sample: int = SAMPLE, least: int = LEAST,
        languages: int = LANGUAGES, **options) -> Model:
    """Train on texts and non-null languages of ``usable`` rows.

    Takes about ``sample`` distinct texts, and of rare languages about ``least``
    each, for the ``languages`` most frequent ones. The sample goes by hashes, so it
    is the same in every run, and copies count once; only subword counts come to
    the driver, at most 6 bytes for each of 16,384 subwords a text.
    """
    on_workers(docs.sparkSession)
    rows = docs.where(usable & F.col("lang").isNotNull() & F.col("text").isNotNull())
    got = sampled(rows.select("lang", "text"), sample, least, languages).mapInArrow(
        _counted, "lang string, rows array<short>, shares array<float>").toArrow()
    names, rows, shares = (got.column(c) for c in ("lang", "rows", "shares"))
    samples = sorted(
        ((n.as_py(), r.values.to_numpy(), s.values.to_numpy().astype(np.float64))
         for n, r, s in zip(names, rows, shares)),
        key=lambda s: (s[0] or "", len(s[1]), s[1].tobytes(), s[2].tobytes()))
    return train([s for s in samples if s[0] is not None],
                 [s for s in samples if s[0] is None], **options)


_models: dict[int, Model] = {}


def kept_model(shared) -> Model:
    """The broadcast model, one object per process, so that its words stay known."""
    if shared.id not in _models:
        _models.clear()
        _models[shared.id] = shared.value
    return _models[shared.id]


class Shared:
    """A broadcast of a model with a key of its own."""

    def __init__(self, spark, model: Model):
        import uuid

        self.broadcast, self.id = spark.sparkContext.broadcast(model), uuid.uuid4().hex

    @property
    def value(self) -> Model:
        return self.broadcast.value


def _predict(batches: Iterator[pa.RecordBatch], shared: Shared) -> Iterator[pa.RecordBatch]:
    model = kept_model(shared)
    for batch in batches:
        for part in rows_of(batch):
            found = [model.predict(t) for t in texts(part.column("text"))]
            names, scores, rejected = ([f[i] for f in found] for i in range(3))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc"), pa.array(names, pa.string()), pa.array(scores, pa.float64()),
                 pa.array(rejected, pa.bool_())], names=["doc", "lang_pred", "score", "rejected"])


def predicted(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """Language of every whole text: a row per row.

    Returns a struct ``doc`` of the columns in ``keep`` (default: the id),
    ``lang_pred``, its calibrated ``score`` and whether it is ``rejected``. A
    text that is null, empty or without a letter (as Unicode has them) is ``und``
    with score 0 and rejected, as is everything if there was nothing to learn from.
    Of languages with one probability the first by code point is taken. Equal
    texts get equal results, rows with a null or repeated id stay as they are,
    and further columns of any name are not read; no rows give no rows.
    """
    spark = docs.sparkSession
    on_workers(spark)
    rows = docs.select(F.struct(*(keep or ["doc_id"])).alias("doc"),
                       F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(
        partial(_predict, shared=Shared(spark, model)),
        f"doc {kind}, lang_pred string, score double, rejected boolean")


def recognised(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that aren't rejected, all columns."""
    return predicted(docs, model, docs.columns).where("not rejected").select("doc.*")
