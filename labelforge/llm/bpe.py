"""BPE encoding and decoding with public vocabulary files.

Byte-level texts are cut where a byte pair stands that occurs inside no vocabulary token: no merge can
cross it.  Of those certain cuts the ones before ASCII white space are used; there the
pre-tokenizer's result on each side does not depend on the other side either.  The fragments are
encoded independently, each distinct one once while it is remembered, and their ids concatenated.

The merges are the ``tokenizers`` library's own model.  A fragment of plain Latin text is split by the
published pattern here; every other fragment goes to the library whole.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from . import words as W
from .base import arrow_map

#: Fragments in the younger half of a worker's memory, and the longest one worth it.
REMEMBERED, LONGEST = 400_000, 64
_SPACES = (9, 10, 11, 12, 13, 32)
#: Marks that end words and belong to no pattern of their own.
_TAIL = b".,;:!?"
#: Characters on which every Unicode version agrees; outside them the library splits and folds.
_PLAIN = re.compile("[\t\n\r -~À-įıĴ-ɏ]*")
# The two published pre-tokenizer patterns.
BYTE_PATTERN = public_tokenizers.PATTERN
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: What the two come to on plain ASCII.
ASCII_BYTE_PATTERN = BYTE_PATTERN.replace(r"^\s\p{L}\p{N}", r"^\sA-Za-z0-9").replace(r"\p{L}", "[A-Za-z]").replace(r"\p{N}", "[0-9]")
ASCII_WORD_PATTERN = WORD_PATTERN.replace(r"\p{L}", "A-Za-z").replace(r"\p{N}", "0-9")


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, extra = [""] * 256, 256
    for b in range(256):
        if b in plain:
            letters[b] = chr(b)
        else:
            letters[b], extra = chr(extra), extra + 1
    return letters


_LETTERS = {b: x for b, x in enumerate(byte_letters())}
_BYTE_OF = {x: b for b, x in _LETTERS.items()}


class Memory(dict):
    """Packed ids of fragments, computed when missed.  When full, it keeps what it held as the older half."""

    def __init__(self, encode: Callable):
        self.encode, self.older = encode, {}

    def __missing__(self, fragment) -> bytes:
        ids = self.older.get(fragment)
        if ids is None:
            ids = self.encode(fragment)
        if len(fragment) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[fragment] = ids
        return ids


class Encoder:
    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.byte_level = spec["model"].get("end_of_word_suffix") is None
        self.marks = tuple(x["content"] for x in spec["added_tokens"])
        self.pattern = regex.compile(BYTE_PATTERN if self.byte_level else WORD_PATTERN)
        vocabulary = {**spec["model"]["vocab"], **{x["content"]: x["id"] for x in spec["added_tokens"]}}
        special = set(self.marks)
        tokens = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            known = token not in special and all(c in _BYTE_OF for c in token)
            tokens[i] = bytes(_BYTE_OF[c] for c in token) if known else token.encode()
        self.lengths = np.array([len(x) for x in tokens], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.inside = np.zeros((256, 256), bool)
        for token, i in vocabulary.items():
            if token not in special:
                raw = np.frombuffer(tokens[i], np.uint8)
                self.inside[raw[:-1], raw[1:]] = True
        self.cuts = self._cuts()
        self.ascii = re.compile(ASCII_BYTE_PATTERN if self.byte_level else ASCII_WORD_PATTERN)
        self.memory, self.pieces = Memory(self._fragment), Memory(self._piece)

    def _cuts(self) -> re.Pattern:
        """Before white space, after a byte that never precedes it inside a token."""
        after: dict[bytes, list[int]] = {}
        for c in _SPACES:
            before = bytes(b for b in range(256) if not self.inside[b, c])
            after.setdefault(before, []).append(c)
        one_of = lambda bs: b"[" + b"".join(b"\\x%02x" % b for b in bs) + b"]"
        return re.compile(b"|".join(b"(?<=" + one_of(b) + b")(?=" + one_of(c) + b")" for b, c in after.items() if b) or b"(?!)")

    def _piece(self, piece: str) -> bytes:
        letters = piece if piece.isascii() and piece.isalpha() else piece.encode("utf-8").decode("latin-1").translate(_LETTERS)
        return array("I", [t.id for t in self.tokenizer.model.tokenize(letters)]).tobytes()

    def _fragment(self, fragment: bytes) -> bytes:
        if not self.byte_level:
            if fragment.isalpha():  # ASCII letters
                return array("I", [t.id for t in self.tokenizer.model.tokenize(fragment.lower().decode())]).tobytes()
            word = fragment.rstrip(_TAIL)
            if word.isalpha():  # and one run of marks after them
                return self.memory[word] + self.pieces[fragment[len(word) :].decode()]
        text = fragment.decode("utf-8")
        if not _PLAIN.fullmatch(text) or any(x in text for x in self.marks):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if not self.byte_level:
            text = text.lower()
        pieces = (self.ascii if text.isascii() else self.pattern).findall(text)
        return b"".join(map(self.pieces.__getitem__, pieces))

    def encode(self, text: bytes) -> bytes:
        """Ids of a UTF-8 text as little-endian unsigned 32-bit integers."""
        fragments = self.cuts.split(text) if self.byte_level else text.split()
        return b"".join(map(self.memory.__getitem__, fragments))

    def forget(self) -> None:
        """Empty the memory: workers live on after a task, and several may have served it."""
        for memory in (self.memory, self.pieces):
            memory.clear()
            memory.older = {}

    def decode(self, ids: bytes, step: int = 1_000_000) -> bytes:
        out, ids = [], np.frombuffer(ids, "<u4")
        for i in range(0, len(ids), step):
            n = self.lengths[ids[i : i + step]]
            at = np.arange(n.sum()) + np.repeat(self.starts[ids[i : i + step]] - (np.cumsum(n) - n), n)
            out.append(self.bytes[at].tobytes())
        return b"".join(out)


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _encode(path: str, decode: bool):
    def run(batch):
        e = encoder(path)
        for row, data, offsets in W.text_slices(batch.column("text")):
            raw = data.tobytes()
            ids = [e.encode(raw[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            columns = [batch.column("key").slice(row, len(ids)), pa.array(ids, pa.binary())]
            if decode:
                columns.append(pa.array([e.decode(x).decode("utf-8", "replace") for x in ids], pa.string()))
            yield pa.record_batch(columns, names=["key", "ids", "decoded"][: len(columns)])
    return run


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decode: bool = False) -> DataFrame:
    """``(key, ids)`` per row, and with ``decode`` also ``decoded``.

    ``key`` is the id column as it is, null included; ``ids`` are packed little-endian unsigned 32-bit
    integers.  Null and empty texts have no ids.  Repeated rows are encoded each.  Other columns are
    ignored.  ``path`` names a vocabulary file that every executor has.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    text = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text"))
    return arrow_map(text, _encode(path, decode), f"key {kind}, ids binary" + ", decoded string" * decode)
