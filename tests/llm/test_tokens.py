"""Tokens, prefix tables, token files and packing against the libraries."""

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stopover.llm import packing, prefix_counts, token_files
from stopover.llm.tokens import Encoder
from stopover.session import fresh_path
from tests.llm.conftest import ROWS

BYTES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ODD = [
    "don't we'll 'l 'r're x've!! I'M 'S", "a<|endoftext|>b <|endoftex <|startoftext|><|endoftext|>",
    "école q́ ΣΑΣ İstanbul 한국어 한 12a3 ½ x y \x1c z",
    "'''ll ''s '", "  lead\n\n trail \t", "", "   x   y", "🙂🙂 ́x", "a" * 300, "1" * 80]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_encoder_equals_library(path):
    library, own = Tokenizer.from_file(path), Encoder(path)
    rng = random.Random(5)
    alphabet = "abcXYZ'éÀñ.,!012東İŉ×ª \n\t<|>_-́ "
    texts = ODD + ["".join(rng.choices(alphabet, k=rng.randint(1, 30))) for _ in range(3000)]
    for text in texts + texts[:50]:
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(own.encode(text), "<u4").tolist() == want, repr(text)


def test_encoder_keeps_two_generations(monkeypatch):
    monkeypatch.setattr("stopover.llm.tokens.KEPT", 5)
    own, library = Encoder(WORDS), Tokenizer.from_file(WORDS)
    for i in range(40):
        text = f"some words number{i} and word{i % 7}"
        assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode(
            text, add_special_tokens=False).ids
    assert len(own.kept) + len(own.old) < 30


@pytest.fixture(scope="module")
def rules():
    return prefix_counts.Counter(WORDS)


@pytest.mark.parametrize("text", ODD)
def test_every_prefix_of_odd_texts(rules, text):
    library = Tokenizer.from_file(WORDS)
    want = [len(library.encode(text[:i + 1], add_special_tokens=False).ids)
            for i in range(len(text))]
    assert rules.counts(text).tolist() == want


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abcdefgtheinorsT'é.,!01́東 \n", max_size=40))
def test_every_prefix(text):
    rules = prefix_counts.counter(WORDS)
    want = [len(rules.tokenizer.encode(text[:i + 1], add_special_tokens=False).ids)
            for i in range(len(text))]
    assert rules.counts(text).tolist() == want


def test_budget_is_the_longest_prefix(rules):
    counts = rules.counts("internationalisation of organisations, and more of the same")
    for budget in range(12):
        size = prefix_counts.fits(counts, budget)
        assert size == 0 or counts[size - 1] <= budget
        assert all(c > budget for c in counts[size:])


def test_prefix_counts_of_odd_rows(odd, empty):
    library = Tokenizer.from_file(WORDS)
    got = prefix_counts.prefix_counts(odd, WORDS, 10, tables=True).collect()
    want = Counter((i, len((t or "").encode()), len(
        library.encode(t or "", add_special_tokens=False).ids)) for i, t, *_ in ROWS)
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == want
    for row in got:
        table = np.frombuffer(row.counts, "<u4")
        assert (table[-1] if len(table) else 0) == row.n_tokens
    assert prefix_counts.prefix_counts(empty, WORDS, 10).count() == 0


def test_stored_tables_answer_any_budget(spark, odd, empty):
    library = Tokenizer.from_file(WORDS)
    tables = prefix_counts.stored(odd, WORDS)
    budgets = [0, 1, 7, 100, 10**6]
    got = prefix_counts.answered(tables, budgets).collect()
    kept = {(r.doc_id, r.n_bytes): prefix_counts.unpacked(pa.scalar(bytes(r.counts)), r.n_chars)
            for r in tables.collect()}
    assert Counter((r.doc_id, r.n_bytes) for r in got) == Counter(
        (i, len((t or "").encode())) for i, t, *_ in ROWS)
    for i, text, *_ in ROWS:
        text = text or ""
        counts = kept[i, len(text.encode())]
        assert len(counts) == len(text)
        for n in range(0, len(text), 1 + len(text) // 40):
            assert counts[n] == len(library.encode(text[:n + 1], add_special_tokens=False).ids)
        row = next(r for r in got if (r.doc_id, r.n_bytes) == (i, len(text.encode())))
        assert row.n_tokens == (counts[-1] if text else 0)
        for budget in budgets:
            within = [n + 1 for n, c in enumerate(counts.tolist()) if c <= budget]
            assert row[f"fits_{budget}"] == max(within, default=0)
    assert prefix_counts.answered(prefix_counts.stored(empty, WORDS), [5]).count() == 0
    for most in (0, 65_535, 65_536, 10**6):
        counts = np.array([0, most, most // 2], np.int64)
        raw = prefix_counts.packed(counts)
        assert prefix_counts.unpacked(pa.scalar(raw), 3).tolist() == counts.tolist()
        assert len(raw) == (6 if most < 1 << 16 else 12)


def test_token_files_round_trip(spark, odd, empty):
    library = Tokenizer.from_file(BYTES)
    folder = fresh_path(spark, "tokens")
    written = token_files.write_token_files(odd, folder, BYTES, length=16)
    got = token_files.read_token_files(spark, written).orderBy("start").collect()
    start, ids_of = 0, {(i, t): library.encode(t or "", add_special_tokens=False).ids + [0]
                        for i, t, *_ in ROWS}
    assert [r.doc_id for r in got] == sorted(
        (i for i, *_ in ROWS), key=lambda x: (x is not None, x or 0))
    texts = {i: t for i, t, *_ in ROWS}
    for row in got:
        ids = ids_of[row.doc_id, texts[row.doc_id]]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids), crc)
        start += len(ids)
    # sequences of a file in turn, without what fills up the last one, are its stream
    for file in written:
        if not file["n_tokens"]:
            continue
        reader = token_files.SequenceFile(file["path"])
        parts = [reader.sequence(i) for i in range(-(-file["n_tokens"] // 16))]
        assert sum(mask.true_count for _, mask in parts) == file["n_tokens"]
        # nothing is copied: two looks at a sequence show the same place of the mapped file
        for i, (ids, mask) in enumerate(parts):
            again, bits = reader.sequence(i)
            assert len(ids) == len(mask) == 16 and not ids.flags.owndata
            assert again.ctypes.data == ids.ctypes.data
            assert bits.buffers()[1].address == mask.buffers()[1].address
        joined = np.concatenate([ids[mask.to_numpy(zero_copy_only=False)] for ids, mask in parts])
        assert joined.tolist() == reader.tokens(0, file["n_tokens"]).tolist()
    none = token_files.write_token_files(empty, fresh_path(spark, "tokens"), BYTES)
    assert token_files.read_token_files(spark, none).count() == 0


def test_rows_of_one_id_are_parted(spark):
    """All rows without an id, most of them alike: no file holds much more than its share."""
    rows = [(None, "the same text")] * 3000 + [(None, f"text {i}") for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    written = token_files.write_token_files(docs, fresh_path(spark, "tokens"), BYTES)
    counts = [row["n_docs"] for row in written]
    assert sum(counts) == 4000 and max(counts) < 1500
    read = token_files.read_token_files(spark, written).collect()
    starts = sorted((r.start, r.n_tokens) for r in read)
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:])) and starts[0][0] == 0


def test_paths_as_spark_names_them():
    assert token_files.uri("/a/b c") == "file:///a/b c"
    assert token_files.uri("file:/a") == "file:/a" and token_files.uri("hdfs://h/a") == "hdfs://h/a"
    assert token_files.uri("s3a://bucket/a") == token_files.uri("s3n://bucket/a") == "s3://bucket/a"


def test_files_of_another_attempt_stay(spark, odd):
    """A second write into a folder meets no file of the first; each manifest reads its own."""
    folder = fresh_path(spark, "tokens")
    first = token_files.write_token_files(odd, folder, BYTES, length=16)
    again = token_files.write_token_files(odd.limit(0), folder, BYTES, length=16)
    assert not {r["path"] for r in first} & {r["path"] for r in again}
    assert token_files.read_token_files(spark, first).count() == len(ROWS)
    assert token_files.read_token_files(spark, again).count() == 0


def checked(rows, size):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    return by


def test_packing_of_odd_rows(odd, empty):
    library = Tokenizer.from_file(WORDS)
    rows = packing.best_fit_packing(odd, WORDS, 64).collect()
    by = checked(rows, 64)
    want = Counter()
    for i, t, *_ in ROWS:
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        for piece, at in enumerate(range(0, len(ids), 64)):
            own = ids[at:at + 64]
            want[i, piece, at, len(own), zlib.crc32(own.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    assert sorted(by) == list(range(len(by)))
    assert packing.best_fit_packing(empty, WORDS, 64).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), max_size=20))
def test_recipes_use_every_length_once(histogram):
    plan = packing.recipes(dict(histogram), 40)
    used = Counter()
    for combination, often in plan:
        assert often > 0 and sum(combination) <= 40
        for x in combination:
            used[x] += often
    assert used == Counter(histogram)
    total = sum(k * n for k, n in histogram.items())
    # best fit never leaves two sequences that would go into one
    assert sum(n for _, n in plan) <= max(2 * -(-total // 40), 1)


def test_complements_are_exact():
    counts = np.zeros(101, np.int64)
    counts[[5, 20, 35]] = 1
    assert packing.complement(counts, 35) == (35,)
    assert packing.complement(counts, 40) == (35, 5)
    assert packing.complement(counts, 60) == (35, 20, 5)
    assert packing.complement(counts, 50) is None


def test_too_long_pieces_are_an_error(spark):
    rows = spark.createDataFrame([(1, 0, 0, 65, 1)], packing.PIECES)
    with pytest.raises(ValueError):
        packing.pack(rows, 64)
