"""Token counts of every prefix of a text, by dynamic programming over prefixes.

The encoding of a word is a chain of tokens in which each pair of neighbours is
itself an encoding, and every chain with that property is one. So the last
token of a prefix is the one whose neighbour is the last token of the prefix
before it: ``last[i]`` is the longest token ``t`` that ends at ``i`` and goes
with ``last[i - len(t)]``, and ``count[i] = count[i - len(t)] + 1``. No prefix
is encoded again; whether two tokens go together is asked of the tokenizers
library once and kept. Words add up along the text, since no token crosses a
word's end, and the table of a word (one byte per code point) is kept too.

The tables answer how many tokens any prefix has, and which is the longest
prefix within a budget. Counts may go down when a text grows: two tokens may
become one. So the answer to a budget is the last prefix that keeps to it.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import partial
from itertools import accumulate, groupby
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stopover.llm.common import on_workers, rows_of, texts
from stopover.llm.tokens import (
    _SAFE, _SPACED, DROPPED, KEPT, LONGEST, _loaded, byte_letters, separation, tokenizer)
from stopover.session import fresh_path

# Pairs of tokens whose answer is kept.
KEPT_PAIRS = 400_000
# What the tokenizer's pattern takes as one piece behind an apostrophe.
SHORT, LONG = "stmd", ("re", "ve", "ll")
_JOINS = re.compile("[\u1160-\u11ff]")


class Kinds(dict):
    """What a pre-tokenizer takes a character for: letter, number, other or space."""

    def __init__(self, cut):
        self.cut = cut

    def __missing__(self, char: str) -> str:
        pieces = len(self.cut(f"a{char}a"))
        self[char] = kind = ("L" if pieces == 1 else "W" if pieces == 2 else
                             "O" if len(self.cut(char + char)) == 1 else "N")
        return kind


class Run:
    """Prefix tables of one piece: grows by letters, and can be cut back."""

    def __init__(self, rules: Counter):
        self.rules, self.letters, self.last, self.count, self.whole = rules, "", [""], [0], [0]

    def push(self, letters: str) -> None:
        """Append letters: the last token of each prefix, its tokens, and those if it ends there."""
        rules = self.rules
        inner, finals, longest = rules.inner, rules.finals, rules.longest
        pairs, ending, asked = rules.pairs, rules.ending, rules.asked
        last, count, at = self.last, self.count, len(self.letters)
        self.letters = text = self.letters + letters
        for end in range(at + 1, len(text) + 1):
            token = whole = None
            for start in range(max(0, end - longest), end):
                before = last[start]
                if before is None:
                    continue
                found = text[start:end]
                if token is None and found in inner:
                    fits = pairs.get((before, found))
                    if asked(pairs, before, found) if fits is None else fits:
                        token, size = found, count[start] + 1
                if whole is None and found in finals:
                    fits = ending.get((before, found))
                    if asked(ending, before, found) if fits is None else fits:
                        whole = count[start] + 1
                if token is not None and whole is not None:
                    break
            last.append(token)
            count.append(size if token is not None else 0)
            self.whole.append(whole)

    def cut(self, size: int) -> None:
        self.letters = self.letters[:size]
        del self.last[size + 1:], self.count[size + 1:], self.whole[size + 1:]

    def total(self) -> int:
        """Tokens if the piece ends here."""
        return self.whole[-1]


class Counter:
    """Prefix tables by one tokenizer that drops white space between words."""

    def __init__(self, path: str):
        from tokenizers import models

        if separation(path) != "drop":
            raise ValueError("the tokenizer must cut texts at white space and drop it")
        self.tokenizer = tokenizer(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        suffix = self.suffix = model["end_of_word_suffix"] or ""
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.plain = models.BPE(vocab=model["vocab"], merges=merges)
        self.closed = self.tokenizer.model
        self.inner = {t for t in model["vocab"] if not (suffix and t.endswith(suffix))}
        self.finals = {t.removesuffix(suffix) for t in model["vocab"] if t.endswith(suffix)}
        self.longest = max(map(len, self.inner | self.finals))
        self.special = re.compile("|".join(
            re.escape(t["content"]) for t in spec["added_tokens"]) or r"(?!)")
        self.letters = byte_letters()
        self.kinds = Kinds(self.tokenizer.pre_tokenizer.pre_tokenize_str)
        self.pairs: dict[tuple[str, str], bool] = {}
        self.ending: dict[tuple[str, str], bool] = {}
        self.pieces: dict[str, bytes] = {}
        self.old_pieces: dict[str, bytes] = {}
        self.kept: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def asked(self, known: dict, one: str, two: str) -> bool:
        """Whether token ``two`` may follow ``one`` (empty: stand first), by the library's model.

        ``known`` is ``ending`` if the piece ends behind ``two``, else ``pairs``.
        """
        model, suffix = (self.closed, self.suffix) if known is self.ending else (self.plain, "")
        got = [t.value for t in model.tokenize(one + two)]
        if len(known) > KEPT_PAIRS:
            known.clear()
        known[one, two] = answer = got == [*([one] if one else []), two + suffix]
        return answer

    def piece(self, text: str) -> Run:
        run = Run(self)
        run.push("".join([self.letters[b] for b in text.encode()]))
        return run

    def feed(self, state: tuple, char: str) -> tuple:
        """State behind one more normal character.

        A state holds the tokens of finished pieces, the open piece with its
        text and kind, and the tokens before an apostrophe that may yet join.
        """
        done, run, text, kind, before = state
        new = self.kinds[char]
        if text == "'" and kind == "O" and char in SHORT:
            return done + self.piece("'" + char).total(), None, "", "", None
        if before is not None and len(text) == 1 and text + char in LONG:
            return before + self.piece("'" + text + char).total(), None, "", "", None
        if run is not None and new == kind and new in "LO":
            run.push("".join([self.letters[b] for b in char.encode()]))
            return done, run, text + char if len(text) < 2 else text, kind, None
        opened = done if text == "'" and kind == "O" and char in "rvl" else None
        done += run.total() if run is not None else 0
        if new == "W":
            return done, None, "", "", None
        return done, self.piece(char), char, new, opened

    @staticmethod
    def value(state: tuple) -> int:
        return state[0] + (state[1].total() if state[1] is not None else 0)

    def units(self, text: str) -> Iterator[str]:
        """Parts of a text that are brought into composed form alone."""
        if text.isascii():
            yield from text
            return
        unit = ""
        for char in text:
            if unit and unicodedata.category(char)[0] != "M" and not _JOINS.match(char):
                yield unit
                unit = ""
            unit += char
        if unit:
            yield unit

    def grown(self, state: tuple, text: str, out: list[int]) -> tuple:
        """State behind a text without special strings; the counts go to ``out``."""
        for unit in self.units(text):
            size = len(state[1].letters) if state[1] is not None else 0
            for end in range(1, len(unit) + 1):
                if state[1] is not None:
                    state[1].cut(size)
                after = state
                for char in unicodedata.normalize("NFC", unit[:end]):
                    for low in char.lower():
                        after = self.feed(after, low)
                out.append(self.value(after))
            state = after
        return state

    def learn(self, pieces: set[str]) -> None:
        """Make the tables of pieces; in sorted order, so that shared beginnings are kept."""
        if len(self.pieces) > KEPT:
            self.old_pieces, self.pieces = self.pieces, {}
        run, held = Run(self), ""
        for piece in sorted(pieces):
            old = self.old_pieces.get(piece)
            if old is not None:
                self.pieces[piece] = old
                continue
            letters = piece.encode().decode("latin-1").translate(self.letters)
            same = len(commonprefix((letters, held)))
            run.cut(same)
            run.push(letters[same:])
            held = letters
            if len(letters) == len(piece):
                counts = run.whole[1:]
            else:
                ends = accumulate(len(char.encode()) for char in piece)
                counts = [run.whole[end] for end in ends]
            self.pieces[piece] = bytes(counts) if len(piece) <= LONGEST else counts

    def prefixes(self, piece: str) -> bytes | list[int]:
        """Tokens of every prefix of one piece, by character."""
        found = self.pieces.get(piece)
        if found is None:
            self.learn({piece})
            found = self.pieces[piece]
        if len(piece) > LONGEST:
            del self.pieces[piece]
        return found

    def simple(self, text: str) -> str | None:
        """The text in normal form if that changes it character by character, and no pieces join."""
        if "'" in text or self.special.search(text):
            return None
        if text.isascii():
            return text.lower()
        low = "".join([char.lower() for char in text])
        if len(low) != len(text) or not unicodedata.is_normalized("NFC", text) or any(
                unicodedata.category(char)[0] == "M" for char in text) or _JOINS.search(text):
            return None
        return low

    def table(self, part: bytes) -> np.ndarray:
        """Tokens of every prefix of a part, by code point; a run of white space may lead it."""
        low = self.simple(text := part.decode())
        if low is None:
            return self.exact(text)
        out, done = [], 0
        for kind, group in groupby(low, self.kinds.__getitem__):
            for piece in group if kind in "NW" else ["".join(group)]:
                counts = [0] if kind == "W" else self.prefixes(piece)
                out += [done + count for count in counts]
                done = out[-1]
        return np.array(out, np.int64)

    def exact(self, text: str) -> np.ndarray:
        """The same, character by character, for texts that change when they are composed."""
        out, state, at = [], (0, None, "", "", None), 0
        for found in self.special.finditer(text):
            state = self.grown(state, text[at:found.start()], out)
            done, size = self.value(state), len(state[1].letters) if state[1] is not None else 0
            self.grown(state, found.group()[:-1], out)
            if state[1] is not None:
                state[1].cut(size)
            out.append(done + 1)
            state, at = (done + 1, None, "", "", None), found.end()
        self.grown(state, text[at:], out)
        return np.array(out, np.int64)

    def prepare(self, rows: list[list[bytes]]) -> None:
        """Make the tables of all parts that aren't kept, and keep those of short ones."""
        if len(self.kept) > KEPT:
            self.old, self.kept = self.kept, {}
        kept, old = self.kept, self.old
        new = set().union(*rows).difference(kept)
        cut: dict[bytes, list[str]] = {}
        for part in new:
            if part in old:
                kept[part] = old[part]
            elif len(part) <= LONGEST:
                text = part.decode()
                safe = _SAFE.fullmatch(text) and "'" not in text and b"<|" not in part
                cut[part] = DROPPED.findall(text.lower()) if safe else []
        known = self.pieces
        self.learn({p for pieces in cut.values() for p in pieces if p not in known})
        for part, pieces in cut.items():
            if not pieces:
                kept[part] = bytes(self.table(part).tolist())
                continue
            done = len(part.decode()) - sum(map(len, pieces))
            out = [bytes(done)]
            total = 0
            for piece in pieces:
                counts = self.prefixes(piece)
                out.append(bytes([total + x for x in counts]) if total else counts)
                total = out[-1][-1]
            kept[part] = b"".join(out)

    def all_counts(self, rows: list[str]) -> Iterator[np.ndarray]:
        """Tokens of every prefix of each text, see ``counts``."""
        parts = [_SPACED.findall(text.encode()) for text in rows]
        self.prepare(parts)
        for row in parts:
            tables = list(map(self.kept.get, row))
            if None in tables:
                tables = [self.table(part) if t is None else np.frombuffer(t, np.uint8)
                          for t, part in zip(tables, row)]
                flat = np.concatenate(tables).astype(np.int64)
            else:
                flat = np.frombuffer(b"".join(tables), np.uint8).astype(np.int64)
            sizes = np.fromiter(map(len, tables), np.int64, len(tables))
            if len(sizes):
                word = flat[np.cumsum(sizes) - 1]
                flat += np.repeat(np.cumsum(word) - word, sizes)
            yield flat

    def counts(self, text: str) -> np.ndarray:
        """Tokens of every prefix of a text; entry ``i`` is that of the first ``i + 1`` code points."""
        return next(self.all_counts([text]))


def counter(path: str) -> Counter:
    """The counter of a file, kept with its tables as long as the process lives."""
    key = ("counter", path)
    if key not in _loaded:
        _loaded[key] = Counter(path)
    return _loaded[key]


def fits(counts: np.ndarray, budget: int) -> int:
    """Code points of the longest prefix of at most ``budget`` tokens."""
    if not len(counts) or counts[-1] <= budget:
        return len(counts)
    within = np.flatnonzero(counts <= budget)
    return int(within[-1]) + 1 if len(within) else 0


def packed(counts: np.ndarray) -> bytes:
    """A table as little-endian integers of 16 bits if they hold its counts, else of 32."""
    return counts.astype("<u2" if counts.max(initial=0) < 1 << 16 else "<u4").tobytes()


def _count(batches: Iterator[pa.RecordBatch], path: str, budget: int,
           tables: bool) -> Iterator[pa.RecordBatch]:
    rules = counter(path)
    for batch in batches:
        for part in rows_of(batch):
            columns: list[list] = [[], [], [], []]
            rows = texts(part.column("text"))
            for text, counts in zip(rows, rules.all_counts(rows)):
                total = int(counts[-1]) if len(counts) else 0
                values = (len(text.encode()), total, fits(counts, budget),
                          counts.astype("<u4").tobytes() if tables else None)
                for column, value in zip(columns, values):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *[pa.array(c, pa.int64()) for c in columns[:3]],
                 *([pa.array(columns[3], pa.binary())] if tables else [])],
                names=["doc_id", "n_bytes", "n_tokens", "fits_chars", *["counts"] * tables])


def prefix_counts(docs: DataFrame, path: str, budget: int, tables: bool = False) -> DataFrame:
    """Tokens of every whole text, and how much of it a budget holds.

    ``docs`` has ``doc_id`` and ``text``, further columns are not read. Returns
    a row per row: ``doc_id, n_bytes, n_tokens, fits_chars`` (code points of
    the longest prefix of at most ``budget`` tokens) and, on request,
    ``counts``: the table itself, an unsigned 32-bit little-endian integer for
    each code point. A null text counts as empty, an empty one has no tokens
    and an empty table. Rows with a null or repeated id stay as they are.
    """
    on_workers(docs.sparkSession)
    schema = "doc_id long, n_bytes long, n_tokens long, fits_chars long"
    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(
        partial(_count, path=path, budget=budget, tables=tables),
        schema + (", counts binary" if tables else ""))


def _store(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    rules = counter(path)
    for batch in batches:
        for part in rows_of(batch):
            rows = texts(part.column("text"))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([len(t.encode()) for t in rows], pa.int64()),
                 pa.array([len(t) for t in rows], pa.int64()),
                 pa.array([packed(counts) for counts in rules.all_counts(rows)], pa.binary())],
                names=["doc_id", "n_bytes", "n_chars", "counts"])


def stored(docs: DataFrame, path: str) -> DataFrame:
    """The tables of all texts, written to the shared folder: ``doc_id, n_bytes, n_chars, counts``.

    A count for each code point, in integers of 16 bits, or of 32 for texts of more
    than 65,535 tokens; compressed, since a count mostly equals the one before it.
    Rows as in ``prefix_counts``.
    """
    spark = docs.sparkSession
    on_workers(spark)
    tables = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(
        partial(_store, path=path), "doc_id long, n_bytes long, n_chars long, counts binary")
    place = fresh_path(spark, "prefix_tables")
    tables.write.option("compression", "zstd").parquet(place)
    return spark.read.schema(tables.schema).parquet(place)


def unpacked(table: pa.Scalar, n_chars: int) -> np.ndarray:
    """A view of a stored table; what ``n_chars`` counts take tells their width."""
    raw = table.as_buffer()
    return np.frombuffer(raw, "<u2" if raw.size == 2 * n_chars else "<u4")


def _answer(batches: Iterator[pa.RecordBatch], budgets: list[int]) -> Iterator[pa.RecordBatch]:
    # what a worker kept in order to count is not needed to read, and takes much room
    _loaded.clear()
    for batch in batches:
        tables = [unpacked(t, n) for t, n in zip(
            batch.column("counts"), batch.column("n_chars").to_pylist())]
        totals = [int(t[-1]) if len(t) else 0 for t in tables]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("n_bytes"), pa.array(totals, pa.int64()),
             *[pa.array([fits(t, b) for t in tables], pa.int64()) for b in budgets]],
            names=["doc_id", "n_bytes", "n_tokens", *[f"fits_{b}" for b in budgets]])


def answered(tables: DataFrame, budgets: list[int]) -> DataFrame:
    """Totals and, for each budget, the longest prefix it holds, from stored tables alone.

    Returns a row per row: ``doc_id, n_bytes, n_tokens`` and ``fits_<budget>``, in
    code points. An empty table has no tokens; no rows give no rows.
    """
    on_workers(tables.sparkSession)
    return tables.select("doc_id", "n_bytes", "n_chars", "counts").mapInArrow(
        partial(_answer, budgets=budgets), "doc_id long, n_bytes long, n_tokens long, "
        + ", ".join(f"fits_{b} long" for b in budgets))
