"""Language, quality and personal data: what must hold, and accuracy on held-out rows."""

import math
import os
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stopover.llm import language, pii, quality
from stopover.llm.common import crc32, sampled
from tests.llm.conftest import ROWS

SF = "/root/testdata/sf0.01"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@needs_data
def test_language_of_held_out_rows(docs):
    usable = crc32(F.col("doc_id")) % 4 != 2
    model = language.fit(docs, usable)
    got = language.predicted(docs, model, ["doc_id", "lang"]).where(
        crc32(F.col("doc.doc_id")) % 4 == 2).toPandas()
    right = [d["lang"] == p for d, p in zip(got.doc, got.lang_pred)]
    assert len(right) > 200 and np.mean(right) > 0.99 and got.rejected.mean() < 0.005
    again = language.fit(docs.repartition(5), usable)
    assert np.array_equal(model.vectors, again.vectors) and model.threshold == again.threshold


def test_copies_leave_the_sample_alone(spark):
    """A few hundred texts, thousands of copies of each."""
    words = {"en": "the cat and the dog sat on a mat", "fr": "le chat et le chien sont sur un tapis"}
    once = spark.createDataFrame(
        [(lang, f"{text} {n}") for n in range(200) for lang, text in words.items()],
        "lang string, text string")
    often = once.crossJoin(spark.range(2000)).drop("id")
    for size in (100, 400):
        want = sorted(map(tuple, sampled(once, size).collect()))
        assert 0.6 * size < len(want) <= 1.4 * size
        assert sorted(map(tuple, sampled(often, size).collect())) == want
    few, many = (language.fit(d, F.lit(True), 100) for d in (once, often))
    assert many.languages == ["en", "fr"] and many.threshold > -np.inf
    assert np.array_equal(few.vectors, many.vectors) and few.threshold == many.threshold


def test_language_of_odd_rows(odd, empty):
    model = language.fit(odd, F.lit(True))
    got = {r.doc.doc_id: r for r in language.predicted(odd, model).collect()}
    assert len(got) == len({i for i, *_ in ROWS})
    for i, text, *_ in ROWS:
        if not re.search(r"[^\W\d_]", text or ""):
            assert (got[i].lang_pred, got[i].score, got[i].rejected) == ("und", 0.0, True)
        else:
            assert got[i].lang_pred in model.languages and 0 <= got[i].score <= 1
    assert language.recognised(odd, model).columns == odd.columns
    nothing = language.fit(empty, F.lit(True))
    assert {r.lang_pred for r in language.predicted(odd, nothing).collect()} == {"und"}
    assert language.predicted(empty, model).count() == 0


def plain_prediction(model, text):
    """Subword by subword: the mean of what each adds, one language after another."""
    grams = [f"<{word}>"[i:i + n] for word in re.findall(r"[^\W\d_]+", text.lower())
             for n in (2, 3, 4) for i in range(len(word) + 3 - n)]
    rows = [zlib.crc32(g.encode()) % language.ROWS for g in grams]
    logits = [sum(model.vectors[r][k] for r in rows) / len(rows) + model.bias[k]
              for k in range(len(model.languages))]
    powers = [math.exp(x / model.temperature) for x in logits]
    best = max(range(len(powers)), key=lambda k: (powers[k], -k))
    return model.languages[best], powers[best] / sum(powers), logits[best] < model.threshold


@needs_data
def test_prediction_equals_the_plain_one(docs):
    model = language.fit(docs, F.lit(True))
    rows = docs.where("length(text) between 1 and 3000").limit(150)
    got = language.predicted(rows, model, ["text"]).collect()
    checked = [r for r in got if re.search(r"[a-z]", r.doc.text)]
    assert len(checked) > 100
    for row in checked:
        name, score, rejected = plain_prediction(model, row.doc.text)
        assert (row.lang_pred, row.rejected) == (name, rejected)
        assert math.isclose(row.score, score, rel_tol=1e-9)


@needs_data
def test_rejection_of_languages_left_out(spark):
    """Known texts stay; of one language after another, left out, most are rejected."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("lang is not null")
    held = crc32(F.col("doc_id")) % 4 == 2
    shares = {}
    for out in ("de", "en", "es", "fr"):
        model = language.fit(docs.where(F.col("lang") != out), ~held)
        rates = {r.strange: r.rejected for r in language.predicted(
            docs.where(held), model, ["lang"]).groupBy((F.col("doc.lang") == out).alias("strange")).agg(
            F.avg(F.col("rejected").cast("int")).alias("rejected")).collect()}
        assert rates[False] < 0.006
        shares[out] = rates[True]
    print(shares)
    assert min(shares["de"], shares["en"], shares["fr"]) > 0.5


def test_texts_of_shuffled_letters_are_rejected(spark):
    words = {"en": "the cat and the dog sat on a mat with", "fr": "le chat et le chien sont sur un tapis avec"}
    rows = spark.createDataFrame(
        [(lang, f"{text} {'abcdefgh'[n % 8]}{'mnopqrst'[n // 8 % 8]} {text}") for n in range(200)
         for lang, text in words.items()], "lang string, text string")
    model = language.fit(rows, F.lit(True))
    strange = [language.mixed_letters(text * 3, n) for n, text in enumerate(list(words.values()) * 20)]
    assert np.mean([model.predict(t)[2] for t in strange]) > 0.9
    assert not any(model.predict(r.text)[2] for r in rows.collect())


def test_signs_and_numbers_are_no_letters():
    model = language.Model(["en"], np.zeros((language.ROWS, 1)), np.zeros(1))
    for text in ("½ ² ①", "Ⅷ", "12 _ -", ""):
        assert model.predict(text) == ("und", 0.0, True)
    assert model.predict("½ a")[0] == "en"
    assert language.mixed_letters("ab 1c!", 3)[2:4] == " 1"


def test_rare_languages_are_sampled(spark):
    rows = spark.createDataFrame([("en", f"word {n}") for n in range(3000)]
                                 + [("da", f"ord {n}") for n in range(8)]
                                 + [("sv", f"ordet {n}") for n in range(200)], "lang string, text string")
    got = dict(language.sampled(rows.union(rows), 300, 40, 3).groupBy("lang").count().collect())
    assert got["da"] == 8 and 15 < got["sv"] < 80 and 200 < got["en"] < 400
    assert set(dict(language.sampled(rows, 300, 40, 2).groupBy("lang").count().collect())) == {"en", "sv"}


@needs_data
def test_quality_of_held_out_rows(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.fit(docs, labels, crc32(F.col("doc_id")) % 5 != 0)
    got = quality.scored(docs, model).select("doc.doc_id", "score").join(labels, "doc_id").where(
        crc32(F.col("doc_id")) % 5 == 0).toPandas()
    assert ((got.score >= 0.3) == (got.quality == 1)).mean() > 0.9
    assert (got[got.quality == 1].score >= 0.3).mean() > 0.95


def test_blocks_to_learn_from_are_spread_evenly(spark):
    size = quality.BLOCK
    sizes = [0, 1, size - 1, size, size + 1, 16 * size, 16 * size + 1, 100 * size + 7]
    made = ["".join(chr(97 + i * 7 // 5 % 26) for i in range(n)) for n in sizes] + ["é" * 40_000, None]
    rows = spark.createDataFrame(list(enumerate(made)), "n int, text string")
    got = dict(rows.select("n", quality.spread_blocks(F.col("text")).alias("b")).collect())
    for n, text in enumerate(made[:-1]):
        whole = quality.blocks(text.encode())
        most = quality.LEARNED
        at = range(len(whole)) if len(whole) <= most else [
            i * (len(whole) - 1) // (most - 1) for i in range(most)]
        assert [bytes(b) for b in got[n] or []] == [whole[i] for i in at], n
    assert not got[len(made) - 1]


def test_quality_of_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame(
        [(7, 1), (7, 0), (3, 1), (12, 0), (None, 1), (99, 1)], "doc_id long, quality int")
    model = quality.fit(odd, labels, F.lit(True))
    got = quality.scored(odd, model).collect()
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 for r in got)
    none = quality.fit(odd, labels.limit(0), F.lit(True))
    assert {r.score for r in quality.scored(odd, none).collect()} == {0.5}
    assert quality.scored(empty, model).count() == 0


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")


def plain_spans(text):
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text)
            if all(int(p) <= 255 for p in m.group().split("."))]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
            if 14 <= len(pii.digits(m.group())) <= 19 and pii.luhn(pii.digits(m.group()))]
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 10 <= len(pii.digits(m.group())) <= 15]
    return sorted(out)


def test_base_spans_equal_the_patterns():
    rng = np.random.default_rng(6)
    letters = list("a1.@-+ ()04") + ["4111111111111111", "10.0.0.255", "x@y.z", "+1 605 555 9305"]
    for _ in range(4000):
        text = "".join(rng.choice(letters, rng.integers(0, 25)))
        assert pii.base_spans(text) == plain_spans(text), repr(text)


def test_long_words_take_no_longer():
    for text in ("a" * 200_000 + "@", "1" * 200_000, "1." * 100_000, "+1" + " " * 100_000):
        pii.spans(text, pii.Trees())


MIXED = ("john at example[dot]com", "john at example (dot) com", "john AT example[.]com",
         "john at mail.example{dot}com", "john (at) example.com", "john at example dot com")


def test_mixed_forms_are_candidates():
    for own in MIXED:
        for text in (own, f"write to {own} now", f"x@ y {own}"):
            start = text.index("john")
            assert (start, 0, start + len(own)) in list(pii.candidates(text)), text


def test_names_are_taken_whole():
    name = "a.b" * 100
    text = f"mail x, {name} (at) b.c or {name}@b (dot) c"
    found = [text[s:e] for s, k, e in pii.candidates(text) if k == 0]
    assert found == [f"{name} (at) b.c", f"{name}@b (dot) c"]
    for long in ("a" * 200_000, "a" * 200_000 + " (at) b.c", "a@b " * 50_000, " at a" * 40_000,
                 " at dot" * 40_000, "a (at) " * 30_000):
        for _ in pii.candidates(long):
            pass


def test_mixed_forms_are_taken_and_plain_sentences_left():
    rows = [f"write to jo{n}.x@mail{n % 9}.example.com or {n} of it, we look at site{n}.com a@b{n}.org"
            for n in range(400)]
    model = pii.boost(*pii.examples(rows))
    for own in MIXED:
        text = f"write to {own} now"
        assert pii.masked(text, pii.spans(text, model)) == "write to [EMAIL] now", own
    for clean in ("we look at example.com dot by dot", "meet me at noon. then at home", "a at b dot"):
        assert pii.spans(clean, model) == []


FORMS = ("605-555-9305", "605.555.9305", "001 605 555 9305", "00 44 20 7946 0958", "020 7946 0958",
         "john.doe_at_example.com", "john.doe&#64;example.com", "john.doe&commat;example.com",
         "2001:db8:85a3::8a2e:370:7334", "john dot doe at example dot com", "jöhn@example.com")
CLEAN = ("look_at_main.py", "get_at_index.html", "de::ad1", "12:30:45", "2024-10-12 1030",
         "ISBN 0-306-40615-2", "order 4111-222-3333", "1234567890", "meet at example.com")


@pytest.fixture(scope="module")
def taught():
    rng = np.random.default_rng(9)
    rows = []
    for n in range(500):
        a, b, c, d = rng.integers(1, 255, 4).tolist()
        rows.append(f"write to jo{n}.x{n % 7}@mail{n % 9}.example.com or call +1 ({200 + a}) 555-{1000 + 9 * n} "
                    f"from host {a}.{b}.{c}.{d} paid {n} of {rng.integers(1000, 10**6)} by hand")
    return pii.boost(*pii.examples(rows))


@pytest.mark.parametrize("own", FORMS)
def test_forms_beyond_the_patterns_are_taken_whole(taught, own):
    text = f"write to {own} now"
    clean = pii.masked(text, pii.spans(text, taught))
    assert re.fullmatch(r"write to \[(EMAIL|IP|CARD|PHONE)\] now", clean), clean


def test_numbers_behind_tel_are_taken(taught):
    text = "reach tel:6055559305 now"
    assert pii.spans(text, taught) == [(10, 3, 20)]


@pytest.mark.parametrize("own", CLEAN)
def test_alike_forms_are_left(taught, own):
    assert pii.spans(f"see {own} here", taught) == []


def test_wider_addresses_keep_the_base_one(taught):
    found = pii.spans("x jöhn@example.com y", taught)
    assert found == [(2, 0, 18), (4, 0, 18)]
    text = "東京joe@example.com"
    assert pii.spans(text, taught) == pii.base_spans(text) == [(2, 0, 17)]


def test_candidates_of_long_texts_take_no_longer():
    for long in ("a dot " * 60_000 + "b at c.d", "a dot b at c.d " * 20_000, ":" * 200_000 + "1",
                 "1::" * 60_000, "1:2:" * 50_000, "_at_" * 50_000, "x&#64;" * 30_000):
        for _ in pii.candidates(long):
            pass


def test_marks_within_one_name():
    text = "é+x_at__at_y_at_b.c-d dot e f_at_g"
    assert [*pii.candidates(text)] == [(0, 0, 27)] * 3
    assert [*pii.candidates("_at_" * 40_000 + "b.c")] == [(0, 0, 160_003)] * 39_999


def test_threshold_is_the_lowest_with_the_precision():
    scores, truth = np.array([0.9, 0.8, 0.8, 0.7, 0.6, 0.55]), np.array([1, 1, 1, 1, 1, 0.0])
    assert np.isclose(pii.lowest(scores, truth), 0.575)
    assert np.isclose(pii.lowest(np.array([0.9, 0.7, 0.7]), np.array([1, 1, 0.0])), 0.8)
    assert pii.lowest(np.array([0.9, 0.9]), np.array([1, 0.0])) == 2.0
    assert pii.lowest(np.array([0.9, 0.2]), np.array([1, 1.0])) == 0.5
    assert pii.lowest(np.empty(0), np.empty(0)) == 2.0


def test_blocks_of_candidates_change_nothing(monkeypatch):
    text = " ".join(str(7919 * i % 10_007) for i in range(400)) + " 4111/1111/1111/1111 x"
    rows = [f"call +1 605 555 {n:04d} or {n} now, a{n}@b{n}.com 4111 1111 1111 1111"
            for n in range(1000, 1200)]
    model = pii.boost(*pii.examples(rows + [text]))
    whole = pii.spans(text, model)
    monkeypatch.setattr(pii, "SCORED", 7)
    assert min(model.thresholds) <= 1 and pii.spans(text, model) == whole


def test_examples_of_a_text_are_bounded():
    text = "1 2 3 4 5 6 7 8 9 " * 2000 + "a@b.com " * 1000
    x, y = pii.examples([text])
    assert len(x) == len(y) <= 12 * pii.PER_TEXT
    again, _ = pii.examples(["other 12345678901234567", text])
    assert np.array_equal(again[-len(x):], x)


def test_luhn():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_masking_joins_overlaps():
    assert pii.masked("ab 1.2.3.4 c", [(3, 1, 10)]) == "ab [IP] c"
    assert pii.masked("abcdef", [(1, 0, 4), (2, 3, 5)]) == "a[EMAIL]f"


@needs_data
def test_added_spans_keep_base_ones_and_leave_clean_texts(spark, docs):
    model = pii.fit(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))
    assert max(model.thresholds) <= 1
    caught = "joe (at) example (dot) com and then +1 (605) 555-9305 4078918989542222 here"
    kinds = {pii.KINDS[k] for _, k, _ in pii.spans(caught, model)}
    assert {"email", "card", "phone"} <= kinds
    for clean in ("we look at example.com dot by dot", "in 2024 there were 1234567 of 89", "a at b dot"):
        assert pii.spans(clean, model) == []
    for row in pii.found(docs, model).collect():
        assert set(filter(None, row.base.split(","))) <= set(filter(None, row.spans.split(",")))


def test_pii_of_odd_rows(odd, empty):
    model = pii.fit(odd)
    got = {r.doc.doc_id: r for r in pii.found(odd, model, ["doc_id", "base"]).collect()}
    for i, text, *_ in ROWS:
        assert got[i].base == pii.written(plain_spans(text or "")) and got[i].doc.base == "base"
        assert got[i].masked == text or got[i].spans
    assert got[None].base.count(":") == 8
    assert pii.found(empty, pii.fit(empty)).count() == 0
