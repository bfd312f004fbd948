"""The registered queries, on whole test tables, against plain versions of what they promise."""

import hashlib
import os
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stopover.llm import queries, winnowing
from tests.llm.test_documents import plain_components, plain_fingerprint
from tests.llm.test_learned import plain_spans

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.fixture(scope="module")
def rows(spark):
    """Id and text of all documents, in ascending order of the ids."""
    found = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    return sorted((r.doc_id, r.text or "") for r in found)


def test_op1(spark, rows):
    got = {r.doc_id: r for r in queries.op1_winnowing(spark, SF).collect()}
    assert got.keys() == {i for i, _ in rows}
    prints = {i: winnowing.Fingerprint(t) for i, t in rows}
    falling = rows[::-1]
    for (i, text), (j, following) in zip(falling, falling[1:] + falling[:1]):
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        row = got[i]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert row.fingerprint == prints[i].digest()
        assert row.near_next == prints[i].likeness(prints[j])
        assert row.near_edited == prints[i].likeness(winnowing.Fingerprint(edited))
    by_text = {}
    for i, text in rows:
        by_text.setdefault(text, set()).add(got[i].fingerprint)
    assert all(len(found) == 1 for found in by_text.values())


def test_op2_and_op4_hold_out_by_id(spark, rows):
    language = {r.doc_id: r for r in queries.op2_language_id(spark, SF).collect()}
    quality = {r.doc_id: r for r in queries.op4_quality(spark, SF).collect()}
    for i, text in rows:
        crc = zlib.crc32(str(i).encode())
        assert language[i].held_out == (crc % 4 == 2) and 0 <= language[i].score <= 1
        assert (language[i].lang_pred == "und") == (not re.search(r"[^\W\d_]", text))
        assert quality[i].held_out == (crc % 5 == 0) and 0 <= quality[i].score <= 1
        assert quality[i].predicted == (quality[i].score >= 0.3)
    assert len(language) == len(quality) == len(rows)


def test_op3(spark, rows):
    got = {r.doc_id: r for r in queries.op3_pii(spark, SF).collect()}
    assert got.keys() == {i for i, _ in rows}
    for i, text in rows:
        base = [(start, k, end) for start, k, end in plain_spans(text)]
        names = [f"{queries.pii.KINDS[k]}:{start}:{end}" for start, k, end in base]
        kinds = Counter(k for _, k, _ in base)
        assert (got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone) == tuple(
            kinds[k] for k in range(4))
        assert got[i].base_sha256 == hashlib.sha256(",".join(names).encode()).hexdigest()
        assert set(names) <= set(got[i].spans.split(",")) | {""}


def test_op6(spark, rows):
    prints = {i: plain_fingerprint(t) for i, t in rows}
    roots = plain_components(set(prints.values()), 4)
    least = {}
    for i, p in prints.items():
        least[roots[p]] = min(i, least.get(roots[p], i))
    want = {(i, f"{p:016x}", least[roots[p]]) for i, p in prints.items()}
    got = queries.op6_simhash(spark, SF).collect()
    assert len(got) == len(rows) and {tuple(r) for r in got} == want


def test_op7(spark, rows):
    library, start, want = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0, []
    for i, text in rows:
        ids = np.array(library.encode(text, add_special_tokens=False).ids + [0], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = queries.op7_token_files(spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32")
    assert sorted(tuple(r) for r in got.collect()) == want


@pytest.fixture(scope="module")
def word_ids(rows):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return {i: library.encode(t, add_special_tokens=False).ids for i, t in rows}


def test_op9(spark, rows, word_ids):
    got = queries.op9_prefix_counts(spark, SF).select("doc_id", "n_bytes", "n_tokens", "over_limit")
    want = {(i, len(t.encode()), len(word_ids[i]), len(word_ids[i]) > 2048) for i, t in rows}
    assert {tuple(r) for r in got.collect()} == want and got.count() == len(rows)


def test_op10(spark, rows, word_ids):
    got = queries.op10_packing(spark, SF).collect()
    want, tokens = set(), 0
    for i, own in word_ids.items():
        ids = np.array(own + [0], "<u4")
        tokens += len(ids)
        for piece, at in enumerate(range(0, len(ids), 2048)):
            cut = ids[at:at + 2048]
            want.add((i, piece, at, len(cut), zlib.crc32(cut.tobytes())))
    assert {tuple(r)[:5] for r in got} == want and len(got) == len(want)
    ends: dict[int, int] = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 2048 and len(ends) <= -(-tokens // 2048) + 1


def test_op8_keeps_and_fails_by_the_base_rules(spark, rows):
    got = queries.op8_adaptive_rules(spark, SF)
    assert got.count() == len(rows)
    assert got.where("base_failed and kept").isEmpty()
    assert got.where((F.col("n_words") < 50) & ~F.col("base_failed")).isEmpty()


def test_op8_equals_its_sql_where_words_are_very_long(spark, tmp_path):
    """A group whose fence for the word length lies far beyond the exact buckets."""
    dice = random.Random(8)
    lengths = [dice.randrange(5, 60) * dice.choice([1, 1, 4]) for _ in range(300)] + [
        900, 2_000, 40_000, 3_000]
    rows = [(n, " ".join("".join(dice.choices("abcdefgh", k=size)) for _ in range(60)), "zz", "long")
            for n, size in enumerate(lengths)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(
        f"{tmp_path}/documents.parquet")
    got = queries.op8_adaptive_rules(spark, str(tmp_path))
    names = sorted(got.columns)
    db = duckdb.connect()
    db.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    want = db.execute(f"select {', '.join(names)} from ({queries.ORACLE['op8_adaptive_rules']})")
    assert sorted(map(tuple, got.select(names).collect())) == sorted(want.fetchall())
    # Some are kept beyond the last exact bucket, and some are not.
    beyond = {r.kept for r in got.where("word_chars * 10 div n_words > 1023").collect()}
    assert beyond == {True, False}
