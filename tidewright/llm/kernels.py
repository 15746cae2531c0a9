"""Vectorised text kernels for Arrow batches: code points, word boundaries and hashes as flat numpy arrays.

A batch of texts becomes one array of code points with document offsets. Words, runs of words and sentences are
then found by array operations, so no Python code runs per word or per document. Blocks hold about a million
characters, which bounds a worker's memory; a longer text is a block of its own and is never cut.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LETTER, NUMBER, MARK, SPACE, HAN = 1, 2, 4, 8, 16
BLOCK_CHARS = 1 << 20

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_MULT = np.uint64(0xBF58476D1CE4E5B9)


def mix(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, elementwise."""
    values = values ^ (values >> np.uint64(31))
    values = values * _MULT
    values = values ^ (values >> np.uint64(29))
    return values * _GOLD


def _classify(code: int) -> int:
    char = chr(code)
    kind = unicodedata.category(char)
    found = {"L": LETTER, "N": NUMBER, "M": MARK}.get(kind[0], 0)
    if char.isspace() or kind[0] == "Z":
        found |= SPACE
    if found & LETTER and unicodedata.name(char, "").startswith("CJK "):
        found |= HAN
    return found


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Class and lower case of each code point of the basic plane."""
    kinds = np.fromiter((_classify(c) for c in range(0x10000)), np.uint8, 0x10000)
    lower = np.arange(0x10000, dtype=np.uint32)
    for code in range(0x10000):
        low = chr(code).lower()
        if len(low) == 1:
            lower[code] = ord(low)
    return kinds, lower


@dataclass
class Chars:
    """Code points of several texts: ``code`` as written, ``low`` in lower case, ``kind`` bits, ``offset`` by text."""

    code: np.ndarray
    low: np.ndarray
    kind: np.ndarray
    offset: np.ndarray

    @property
    def docs(self) -> int:
        return len(self.offset) - 1

    def first(self) -> np.ndarray:
        """True at the first character of each non-empty text."""
        flags = np.zeros(len(self.code), bool)
        starts = self.offset[:-1]
        flags[starts[starts < self.offset[1:]]] = True
        return flags

    def doc_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offset, at, side="right") - 1


def chars(texts: pa.Array) -> Chars:
    """Flatten one Arrow string array; null counts as empty, invalid UTF-8 as replacement characters."""
    if pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.string())
    texts = texts.fill_null("")
    length = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4) if len(texts) else np.zeros(1, np.int32)
    raw = texts.buffers()[2]
    body = memoryview(raw)[ends[0] : ends[-1]].tobytes() if raw is not None else b""
    code = np.frombuffer(body.decode("utf-8", "replace").encode("utf-32-le", "replace"), np.uint32)
    if len(code) != length.sum():
        parts = [memoryview(raw)[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(ends, ends[1:])]
        length = np.array([len(p) for p in parts], np.int64)
        code = np.frombuffer("".join(parts).encode("utf-32-le", "replace"), np.uint32)
    kinds, lower = _tables()
    if len(code) and code.max() >= 0x10000:
        base = np.minimum(code, 0xFFFF)
        kind, low = kinds[base], lower[base]
        high = code >= 0x10000
        seen, back = np.unique(code[high], return_inverse=True)
        kind[high] = np.array([_classify(int(c)) for c in seen], np.uint8)[back]
        low[high] = np.array([ord(chr(c).lower()) if len(chr(c).lower()) == 1 else c for c in seen], np.uint32)[back]
    else:
        kind, low = kinds[code], lower[code]
    return Chars(code, low, kind, np.concatenate([np.zeros(1, np.int64), np.cumsum(length)]))


def blocks(texts: pa.Array | pa.ChunkedArray, limit: int = BLOCK_CHARS) -> Iterator[tuple[int, int, Chars]]:
    """(start, end, Chars) over slices of ``texts`` with about ``limit`` characters each."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not len(texts):
        return
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    start = 0
    while start < len(texts):
        base = size[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(size, base + limit, side="right")))
        yield start, end, chars(texts.slice(start, end - start))
        start = end


@dataclass
class Words:
    """Words of a block: character span, 64-bit hash of the lower-cased word, document."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    doc: np.ndarray


@lru_cache(maxsize=4)
def _powers(size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.full(size, _GOLD, np.uint64))


def words(text: Chars, allowed: int = LETTER | NUMBER | MARK, split_han: bool = True) -> Words:
    """Maximal runs of ``allowed`` characters; with ``split_han`` every Han character is a word of its own."""
    inside = (text.kind & allowed) > 0
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | text.first()[1:]
    if split_han:
        han = (text.kind & HAN) > 0
        begin |= inside & han
        begin[1:] |= inside[1:] & han[:-1] & inside[:-1]
    at = np.flatnonzero(inside)
    if not len(at):
        empty = np.zeros(0, np.int64)
        return Words(empty, empty, np.zeros(0, np.uint64), empty)
    first = np.flatnonzero(begin[at])
    count = np.diff(np.append(first, len(at)))
    place = np.arange(len(at)) - np.repeat(first, count)
    power = _powers(1 << max(6, int(count.max() - 1).bit_length()))
    value = text.low[at].astype(np.uint64)
    value += np.uint64(1)
    value *= power[place]
    start = at[first]
    return Words(start, start + count, mix(np.add.reduceat(value, first) + count.astype(np.uint64)), text.doc_of(start))


def runs(hashes: np.ndarray, doc: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` successive items that lie in one document, with the index of their first item."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    found = hashes[:count]
    for k in range(1, size):
        found = mix(found) + hashes[k : k + count]
    inside = np.flatnonzero(doc[:count] == doc[size - 1 :])
    return mix(found[inside]), inside


def _grouped(values: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that puts equal values of a document side by side, and True where a new value begins.

    One 64-bit sort key holds the document in its upper bits and the upper bits of the value below; neighbours are
    then compared in full. The values must be hashes: equal upper bits of different values have to be rare.
    """
    if not len(values):
        return np.zeros(0, np.int64), np.zeros(0, bool)
    base = doc - doc.min()
    bits = np.uint64(max(1, int(base.max()).bit_length()))
    order = np.argsort((base.astype(np.uint64) << (np.uint64(64) - bits)) | (values >> bits))
    v, d = values[order], doc[order]
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (d[1:] != d[:-1])
    return order, new


def distinct(values: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each document's values once, sorted by document."""
    order, new = _grouped(values, doc)
    kept = order[new]
    return values[kept], doc[kept]


def repeated(values: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """True where the same value already stood earlier in the same document."""
    flags = np.ones(len(values), bool)
    if len(values):
        order, new = _grouped(values, doc)
        flags[np.minimum.reduceat(order, np.flatnonzero(new))] = False
    return flags


def word_hash(word: str) -> int:
    """The hash that :func:`words` gives this word."""
    return int(words(chars(pa.array([word])), split_han=False).hash[0])


def hash_set(listed: list[str]) -> np.ndarray:
    """Sorted hashes of the given words."""
    return np.unique(np.array([word_hash(w) for w in listed], np.uint64))


def member(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    """True where a value stands in the sorted ``table``."""
    if not len(table):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return table[at] == values


def marks(text: Chars, listed: str) -> np.ndarray:
    """True at the listed characters, which must lie in the basic plane."""
    table = np.zeros(0x10000, bool)
    table[[ord(c) for c in listed]] = True
    if len(text.low) and text.low.max() >= 0x10000:
        return table[np.minimum(text.low, 0xFFFF)] & (text.low < 0x10000)
    return table[text.low]


def per_doc(doc: np.ndarray, docs: int, weight: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(doc, weights=weight, minlength=docs)
