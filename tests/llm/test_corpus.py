"""Divergence of sources, lattice scores and clusters, against plain versions."""

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import SentencePieceProcessor

from stopover.llm import centroids, common, divergence, lattice, queries

SF = "/root/testdata/sf0.01"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
CLASHES = ("term", "terms", "n", "block", "tile", "number", "item", "value", "rank", "row", "word",
           "times", "left", "train", "trained", "key", "vector", "cluster", "distance", "doc")


def with_clashes(frame):
    return frame.select("*", *[F.lit(c).alias(c) for c in CLASHES if c not in frame.columns])


# Divergence

sorted_ids = st.lists(st.integers(0, 2000), unique=True).map(sorted).map(
    lambda x: np.array(x, np.int64))


@settings(max_examples=200, deadline=None)
@given(sorted_ids, sorted_ids)
def test_intersection(few, many):
    ours, theirs = divergence.intersection(few, many)
    assert few[ours].tolist() == many[theirs].tolist() == sorted({*few} & {*many})


def test_intersection_steps_over_a_long_array():
    many = np.arange(0, 3_000_000, 3)
    few = np.array([0, 1, 2_999_997, 2_999_998, 5_000_000])
    ours, theirs = divergence.intersection(few, many)
    assert ours.tolist() == [0, 2] and theirs.tolist() == [0, len(many) - 1]
    for one, other in ((few[:0], many), (few, many[:0])):
        assert not len(divergence.intersection(one, other)[0])


def test_prices_are_exact_at_any_size(spark):
    count, total, terms = 7 * 10**15 + 1, 9 * 10**17 + 5, 123_456_789
    want = 1 + 10**9 * (count + 2) // (total + 2 * terms)
    assert divergence.prices(np.array([count]), total + 2 * terms).tolist() == [want]
    got = spark.range(1).select(
        divergence.price(F.lit(count), F.lit(total), F.lit(terms))).first()[0]
    assert got == want


def plain_audit(rows, least, top):
    texts, kept, group = {}, {}, {}
    for text, lang, source in rows:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")
        terms = [re.sub("[A-Z]+", lambda m: m[0].lower(), t) for t in terms]
        texts.setdefault(lang or "", []).append(set(terms))
        group.setdefault((lang or "", source or ""), Counter()).update(terms)
    for lang, sets in texts.items():
        documents = Counter(t for own in sets for t in own)
        kept[lang] = {t for t, n in documents.items() if n >= least}
    out = set()
    for (lang, source), counts in group.items():
        own = kept[lang]

        def price(counter, term):
            total = sum(counter[t] for t in own)
            return 1 + 10**9 * (counter[term] + 2) // (total + 2 * len(own))

        def apart(p, q):
            return (p - q) ** 2 // (p + q)

        whole = sum((c for (other, _), c in group.items() if other == lang), Counter())
        far = [(-sum(apart(price(counts, t), price(other, t)) for t in own), name.encode(), name)
               for (of, name), other in group.items() if of == lang and name != source]
        loud = [(-apart(price(counts, t), price(whole, t)), t.encode(), t)
                for t in own if counts[t] and price(counts, t) > price(whole, t)]
        for part, items in (("pair", sorted(far)), ("term", sorted(loud)[:top])):
            out |= {(lang, source, part, name, -value, rank)
                    for rank, (value, _, name) in enumerate(items, 1)}
    return out


def test_divergence_of_odd_rows(spark, odd, empty, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK", 3)
    monkeypatch.setattr(divergence, "TILE", 2)
    rows = [(r.text, r.lang, r.source) for r in odd.collect()]
    rows += [(f"Straße éa ÉA zebra{i % 5} alpha the", "en", f"s{i % 7}") for i in range(30)]
    docs = with_clashes(spark.createDataFrame(rows, "text string, lang string, source string"))
    for least, top in ((1, 10), (2, 3), (10, 10), (99, 10)):
        got = [tuple(r) for r in divergence.audit(docs.repartition(3), least, top).collect()]
        want = plain_audit(rows, least, top)
        assert len(got) == len(want) and set(got) == want
    assert divergence.audit(empty).collect() == []


def documents_of(rows):
    return pa.RecordBatch.from_pylist(rows, pa.schema(
        [("lang", pa.string()), ("source", pa.string()), ("text", pa.string())]))


def test_a_task_passes_a_term_on_once_for_all_sources():
    rows = [{"lang": "en", "source": f"s{n % 20}", "text": "The cat, the"} for n in range(400)]
    rows += [{"lang": "fr", "source": "s1", "text": t} for t in ("cat", None, "", " 7 ", "CAT é")]
    made = pa.Table.from_batches(divergence.counted(iter([documents_of(rows)]))).to_pylist()
    made = {(r["lang"], r["term"]): (r["docs"], r["sources"], set(r["n"])) for r in made}
    names = [f"s{n}" for n in range(20)]
    assert {k: (docs, sorted(own), n) for k, (docs, own, n) in made.items()} == {
        ("en", "the"): (400, sorted(names), {40}), ("en", "cat"): (400, sorted(names), {20}),
        ("fr", "cat"): (2, ["s1"], {2}), ("fr", "é"): (1, ["s1"], {1})}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.fixed_dictionaries({
    "lang": st.sampled_from(["", "x", "y"]), "source": st.sampled_from(["", "s", "t"]),
    "text": st.none() | st.text("aBb é東\n1", max_size=12)}), max_size=40), st.integers(1, 3))
def test_counts_do_not_depend_on_how_rows_are_cut(rows, least):
    docs, occurrences = Counter(), {}
    for row in rows:
        terms = [t.lower() for t in re.findall("[aBbé東]+", row["text"] or "")]
        docs.update((row["lang"], t) for t in set(terms))
        for term in terms:
            occurrences.setdefault((row["lang"], term), Counter())[row["source"]] += 1
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(common, "ROWS_AT_ONCE", 2)
        patch.setattr(divergence, "AT_ONCE", 160)
        patch.setattr(divergence, "ROWS", 4)
        cut = [documents_of(rows[at:at + 9]) for at in range(0, len(rows), 9)]
        told = [row for made in divergence.counted(iter(cut)) for row in made.to_pylist()]
        told.sort(key=lambda r: (r["term"], r["lang"]))
        schema = divergence.chunk_counts(documents_of([])).schema
        ordered = [pa.RecordBatch.from_pylist(told[at:at + 3], schema)
                   for at in range(0, len(told), 3)]
        got = [row for made in divergence.frequent(iter(ordered), least)
               for row in made.to_pylist()]
    assert {(r["lang"], r["term"]): (r["docs"], Counter(dict(zip(r["sources"], r["n"]))))
            for r in got} == {k: (n, occurrences[k]) for k, n in docs.items() if n >= least}
    assert len(got) == sum(n >= least for n in docs.values())


def test_terms_are_shuffled_by_language_and_term(spark):
    docs = spark.createDataFrame([("en", "s", "a b")], "lang string, source string, text string")
    plan = divergence.term_counts(docs, 1)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(lang") == plan.count("Exchange ") == 1
    assert "Aggregate" not in plan


# Lattice

@pytest.fixture(scope="module")
def path():
    return public_tokenizers.path("piece_bpe_32k.model")


def all_ways(text, shares):
    if not text:
        return Fraction(1)
    return sum((shares[text[:i]] * all_ways(text[i:], shares)
                for i in range(1, len(text) + 1) if text[:i] in shares), Fraction(0))


def plain_shares(path, counts, ends):
    """Probability of each piece by its bytes, and of the end."""
    model, shares = SentencePieceProcessor(model_file=path), Counter()
    for number in range(model.get_piece_size()):
        piece = model.id_to_piece(number)
        if re.fullmatch("<0x..>", piece):
            raw = bytes.fromhex(piece[3:5])
        elif piece in ("<unk>", "<s>", "</s>") or "▁" in piece[1:]:
            continue
        else:
            raw = piece.replace("▁", " ").encode()
        shares[raw] += Fraction(counts.get(number, 0) + 1)
    total = sum(shares.values()) + ends + 1
    return {raw: n / total for raw, n in shares.items()}, Fraction(ends + 1) / total


def test_word_is_the_sum_over_all_segmentations(path):
    counts = {n: n % 97 for n in range(32_000)}
    made, (shares, end) = lattice.Lattice(path, counts, 5), plain_shares(path, counts, 5)
    assert math.isclose(made.end, math.log10(end), rel_tol=1e-12)
    assert math.isclose(float(sum(shares.values()) + end), 1, rel_tol=1e-12)
    for word in ("a", "the", "walking", "x9#", "é", "東京", "🙂", "▁b", "ŋʘ"):
        want = math.log10(all_ways(b" " + word.encode(), shares))
        assert math.isclose(made.word(word.encode()), want, rel_tol=1e-9)


def test_very_long_words_stay_in_log_space(path):
    made = lattice.Lattice(path, {}, 1)
    one, two = made.word(b"ab9" * 3000), made.word(b"ab9" * 6000)
    assert math.isfinite(two) and -1e6 < two < one < -1000


def plain_scores(rows, path):
    """Base score, counts and lattice score of (doc_id, text) rows."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), t or ""))
             for _, t in rows]
    train = [zlib.crc32(b"" if i is None else str(i).encode()) % 7 != 2 for i, _ in rows]
    counts = Counter(w for own, t in zip(words, train) if t for w in own)
    ends = sum(train)
    n, different = sum(counts.values()) + ends, len(counts) + (ends > 0)
    model, found = SentencePieceProcessor(model_file=path), Counter()
    for word, times in counts.items():
        for number in model.encode(word):
            found[number] += times
    made, memo, out = lattice.Lattice(path, found, ends), {}, []
    for (i, _), own, learned in zip(rows, words, train):
        base = math.log10((ends + 1) / (n + different + 1))
        base += sum(math.log10((counts[w] + 1) / (n + different + 1)) for w in own)
        for w in own:
            if w not in memo:
                memo[w] = made.word(w.encode())
        score = made.end + sum(memo[w] for w in own)
        known = sum(counts[w] > 0 for w in own) + (ends > 0)
        out.append((i, not learned, len(own) + 1, known, n, base, score))
    return out


def same_scores(got, want):
    def order(row):
        return repr(row[:5]), round(row[5], 3)

    assert len(got) == len(want)
    for one, other in zip(sorted(map(tuple, got), key=order), sorted(want, key=order)):
        assert one[:5] == other[:5]
        assert math.isclose(one[5], other[5], rel_tol=1e-9)
        assert math.isclose(one[6], other[6], rel_tol=1e-9)


def op12(docs, path):
    remainder = queries.crc32(F.col("doc_id")) % 7
    return lattice.scored(docs, remainder != 2, path, docs.columns).select(
        "doc.doc_id", (queries.crc32(F.col("doc.doc_id")) % 7 == 2).alias("held"), "n_tokens",
        "n_known", "train_tokens", "base_score", "score")


@pytest.mark.parametrize("hot", [1, 20, 20_000])
def test_scores_of_odd_rows(spark, odd, empty, path, monkeypatch, hot):
    monkeypatch.setattr(lattice, "HOT", hot)
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    # A long word that is in many texts, one of 32 bytes, one that is in none of training.
    rows += [(100 + i, "Blob" * 50 + " same " + "q" * 32) for i in range(12)]
    rows += [(i, "unseen word") for i in range(400) if zlib.crc32(str(i).encode()) % 7 == 2][:3]
    docs = with_clashes(spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"base_score": F.lit("x"), "score": F.lit(1)}))
    same_scores(op12(docs.repartition(3), path).collect(), plain_scores(rows, path))
    assert op12(empty, path).collect() == []


def test_nothing_to_learn_from(spark, path):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = {r.doc.doc_id: r for r in lattice.scored(docs, F.lit(False), path, ["doc_id"]).collect()}
    assert got[1].n_known == got[1].train_tokens == 0 and got[1].base_score == 0
    assert got[2].n_tokens == 1 and got[1].score < got[2].score < 0


@needs_data
def test_op12_on_whole_documents(spark, path):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = queries.op12_lattice(spark, SF).collect()
    same_scores(got, plain_scores(rows, path))


# Clusters

def plain_clusters(rows, k, rounds, seed, dims):
    kept = [(i, [math.floor(Fraction(x) * 1024) for x in v]) for i, v in rows
            if v is not None and len(v) == dims
            and all(x is not None and math.isfinite(x) for x in v)]

    def start(row):
        return hashlib.sha256(f"{seed}:{'' if row[0] is None else row[0]}".encode()).hexdigest(), row[1]

    centre = [list(v) for _, v in sorted(kept, key=start)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centre))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        for n in range(len(centre)):
            of = [v for (_, v), m in zip(kept, own) if m == n]
            if of:
                centre[n] = [sum(c) // len(of) for c in zip(*of)]
    placed = [(i, *nearest(v)) for i, v in kept]
    inertia = Counter()
    for _, d, c in placed:
        inertia[c] += d
    told = lambda x: x if x < 1 << 63 else None
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centre]
    over = {c for _, d, c in placed if d >= 1 << 63}
    return [(i, c, told(d), None if c in over else told(inertia[c]),
             None if over else told(sum(inertia.values())), names[c]) for i, d, c in placed]


def same_clusters(spark, rows, k, rounds, dims, kind="float"):
    frame = with_clashes(spark.createDataFrame(
        rows, f"vec_id long, embedding array<{kind}>").withColumn("inertia", F.lit(None)))
    rows = [(r.vec_id, r.embedding) for r in frame.collect()]
    got = centroids.clustered(frame.repartition(3), "vec_id", "embedding", k, rounds, 3, dims)
    want = plain_clusters(rows, k, rounds, 3, dims)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    return want


def test_clusters_of_odd_rows(spark):
    dice = random.Random(5)
    rows = [(i, [dice.gauss(i % 3, 1) for _ in range(4)]) for i in range(60)]
    rows += [(7, [0.0] * 4), (7, [0.0] * 4), (7, [1.0] * 4), (None, [0.5] * 4), (70, None),
             (71, []), (72, [1.0] * 3), (73, [1.0] * 5), (74, [None, 1.0, 1.0, 1.0]),
             (75, [math.nan] * 4), (76, [math.inf] * 4), (77, [-math.inf, 0.0, 0.0, 0.0]),
             (78, [-0.0001] * 4)]
    assert len(same_clusters(spark, rows, 5, 4, 4)) == 65
    same_clusters(spark, rows, 1, 2, 4)
    same_clusters(spark, rows[:3], 8, 3, 4)
    same_clusters(spark, rows[:30], 4, 0, 4, "double")


def test_equally_near_centroids_and_equal_vectors(spark):
    grid = [(i, [float(i % 4), float(i // 4 % 4)]) for i in range(48)]
    same_clusters(spark, grid, 6, 5, 2)
    same_clusters(spark, [(i, [1.0, 2.0]) for i in range(20)], 4, 3, 2)


def test_components_of_any_size(spark):
    rows = [(i, [float(i), 2.0 ** (3 * i)]) for i in range(40)]
    rows += [(50, [1e300, -1e308]), (51, [1.7e308, 0.0]), (52, [-3.0e9, 3.0e9])]
    want = same_clusters(spark, rows, 3, 3, 2, "double")
    assert any(row[2] is None for row in want) and any(row[2] is not None for row in want)


def test_no_vectors(spark):
    empty = spark.createDataFrame([], T.StructType.fromDDL("vec_id long, embedding array<float>"))
    none = spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")
    for frame in (empty, none):
        got = centroids.clustered(frame, "vec_id", "embedding", 8, 10, 3, 64)
        assert got.collect() == [] and got.columns[0] == "vec_id"


@needs_data
def test_op13_on_whole_embeddings(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = [tuple(r) for r in queries.op13_centroids(spark, SF).collect()]
    assert sorted(got) == sorted(plain_clusters(rows, 8, 10, 3, 64))
