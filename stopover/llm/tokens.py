"""Token ids of whole texts by a public tokenizer, through a cache of its words.

A byte-pair tokenizer cuts a text into pieces first and encodes each alone. No
piece of the two supported kinds reaches from a character that is no white
space into white space, so a text may be cut before every run of ASCII white
space, and the ids of its parts are the ids of the whole. Parts repeat, so
their encodings (always the library's own) are kept, a bounded number of them.
Texts or tokenizers for which the cut isn't known to be safe are encoded whole.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array

import numpy as np

# Parts kept (as many of the generation before), and bytes of the longest part that is kept.
KEPT, LONGEST = 400_000, 64
# Runs of marks behind words that are kept.
MARKS = 10_000

# Characters that some definitions count as white space, ASCII ones left out.
_ODD_SPACE = re.compile(
    "[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u2064\u3000\ufeff]")
# Latin letters that no normal form changes, and how the two kinds of tokenizers cut.
_LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u0148"
_SAFE = re.compile(f"[ \t-\r!-~{_LATIN}]*")
_WORD = re.compile(rf"( ?[{_LATIN}]+)([!-/:-@\[-`{{-~]*)")
_SHORT = "'s|'t|'re|'ve|'m|'ll|'d"
DROPPED = re.compile(rf"{_SHORT}|[{_LATIN}]+|[0-9]|[^\s0-9{_LATIN}]+")
LED = re.compile(rf"{_SHORT}| ?[{_LATIN}]+| ?[0-9]+| ?[^\s0-9{_LATIN}]+|\s+(?!\S)|\s+")
# In a bytes pattern white space is that of ASCII; nothing is ever tried twice.
_SPACED = re.compile(rb"\s*+\S++|\s++")

assert array("I").itemsize == 4 and sys.byteorder == "little"
_loaded: dict[tuple[str, str], object] = {}


def tokenizer(path: str):
    """The tokenizer of a file, loaded once in a process; it uses one thread."""
    key = ("tokenizer", path)
    if key not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _loaded[key] = Tokenizer.from_file(path)
    return _loaded[key]


def encoder(path: str) -> Encoder:
    """The encoder of a file, kept with its cache as long as the process lives."""
    key = ("encoder", path)
    if key not in _loaded:
        _loaded[key] = Encoder(path)
    return _loaded[key]


def separation(path: str) -> str:
    """How texts may be cut: ``drop`` white space, keep it (``lead`` a part), or ``whole``."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    kinds = [spec["pre_tokenizer"] or {}]
    kinds = kinds[0].get("pretokenizers", kinds)
    names = [k.get("type") for k in kinds]
    normal = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
    if names == ["ByteLevel"] and kinds[0]["use_regex"] and not kinds[0]["add_prefix_space"]:
        return "lead" if spec["normalizer"] is None else "whole"
    if (names == ["Split", "ByteLevel"] and kinds[0]["behavior"] == "Removed"
            and kinds[0]["invert"] and r"[^\s\p{L}\p{N}]+" in kinds[0]["pattern"]["Regex"]
            and normal == ["NFC", "Replace", "Lowercase"]):
        return "drop"
    return "whole"


def byte_letters() -> dict[int, str]:
    """The letter by which byte-level tokenizers write each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers.

    Parts of Latin letters and ASCII characters only, which all definitions of
    letters agree on, are cut into pieces here and given to the library's model
    piece by piece; others go through the whole tokenizer.
    """

    def __init__(self, path: str):
        self.tokenizer = tokenizer(path)
        self.separation = separation(path)
        self.pieces = {"drop": DROPPED, "lead": LED}.get(self.separation)
        self.letters = byte_letters()
        self.kept: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.marks: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        raw = text.encode()
        if self.separation == "drop":
            parts = raw.split()
        elif self.separation == "lead" and (raw.isascii() and not re.search(rb"[\x1c-\x1f]", raw)
                                            or not _ODD_SPACE.search(text)):
            parts = _SPACED.findall(raw)
        else:
            return self.plain([raw])[0]
        found = list(map(self.kept.get, parts))
        missing = [i for i, ids in enumerate(found) if ids is None]
        if missing:
            self.fill(parts, found, missing)
        return b"".join(found)

    def fill(self, parts: list[bytes], found: list[bytes | None], missing: list[int]) -> None:
        """Put the ids of parts that aren't kept in their places."""
        if len(self.kept) > KEPT:
            self.old, self.kept = self.kept, {}
        kept, old, hard = self.kept, self.old, []
        for i in missing:
            part = parts[i]
            ids = kept.get(part) or old.get(part) or self.quick(part)
            if ids is None:
                hard.append(i)
                continue
            found[i] = ids
            if len(part) <= LONGEST:
                kept[part] = ids
        new = list({parts[i] for i in hard})
        made = dict(zip(new, self.plain(new)))
        for i in hard:
            found[i] = made[parts[i]]
        kept.update((p, ids) for p, ids in made.items() if len(p) <= LONGEST)

    def quick(self, part: bytes) -> bytes | None:
        """Ids by the library's model alone; None if the part isn't known to be safe."""
        text = part.decode()
        if self.separation == "drop":
            text = text.lower()
        # Most parts are a word, perhaps with marks behind it: two pieces, and few marks.
        simple = _WORD.fullmatch(text)
        if simple:
            word, marks = simple.groups()
            ids = self.piece(word)
            if not marks:
                return ids
            if marks not in self.marks:
                if len(self.marks) > MARKS:
                    self.marks.clear()
                self.marks[marks] = self.piece(marks)
            return ids + self.marks[marks]
        if not _SAFE.fullmatch(text) or "<|" in text:
            return None
        return b"".join(map(self.piece, self.pieces.findall(text)))

    def piece(self, piece: str) -> bytes:
        """Ids of one piece, which the library's model takes in byte letters."""
        if not piece.isascii():
            word = piece.encode().decode("latin-1").translate(self.letters)
        elif piece[0] > " ":
            word = piece
        else:
            word = piece.translate(self.letters)
        return array("I", [t.id for t in self.tokenizer.model.tokenize(word)]).tobytes()

    def plain(self, parts: list[bytes]) -> list[bytes]:
        """By the library's whole tokenizer."""
        encoded = self.tokenizer.encode_batch_fast(
            [p.decode() for p in parts], add_special_tokens=False) if parts else []
        return [np.array(e.ids, "<u4").tobytes() for e in encoded]
