"""Whole-text splitting into the byte-level tokenizers' words, on NumPy arrays.

The pattern of the public byte-level vocabularies is

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

Its matches follow from runs of four character classes (letter, number, other, white
space), the last blank of a white-space run, and one-apostrophe runs before s, t, re,
ve, m, ll or d. They are found here for many documents at once; distinct words then
go to the encoder, and ids are gathered back into documents.
"""
from __future__ import annotations

import functools
import itertools
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex

from trafficwatch.llm.base import CHUNK_BYTES, slices

LETTER, NUMBER, OTHER, SPACE = 0, 1, 2, 3


@functools.cache
def _classes() -> np.ndarray:
    """Character class by code point."""
    table = np.full(0x110000, OTHER, np.uint8)
    points = np.concatenate([np.arange(0xD800), np.arange(0xE000, 0x110000)])
    every = "".join(map(chr, points))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
        for match in regex.finditer(pattern, every):
            table[points[match.start():match.end()]] = kind
    return table


@dataclass
class Words:
    """Words of consecutive documents: ``code[doc_start[d]:doc_start[d + 1]]`` are the
    words of document d, as indexes into the distinct words ``vocabulary``."""

    vocabulary: pa.Array
    code: np.ndarray
    doc_start: np.ndarray


def _kinds(data: np.ndarray) -> np.ndarray:
    """The character class of each byte of UTF-8 ``data``: that of the character it belongs to."""
    kind = np.frombuffer(bytearray(data).translate(_classes()[:256].tobytes()), np.uint8)
    lead = np.flatnonzero(data >= 0xC0)  # first bytes of characters of two to four bytes
    first = data.take(lead)
    for low, high, size in ((0xC0, 0xE0, 2), (0xE0, 0xF0, 3), (0xF0, 0x100, 4)):
        at = lead.compress((first >= low) & (first < high))
        point = data.take(at).astype(np.int32) & (0x7F >> size)
        for k in range(1, size):
            point = point << 6 | data.take(at + k) & 0x3F
        own = _classes().take(point)
        for k in range(size):
            kind[at + k] = own
    return kind


def _starts(data: np.ndarray, doc_at: np.ndarray) -> np.ndarray:
    """True where a word of UTF-8 ``data`` starts. ``doc_at``: start positions of nonempty documents."""
    kind = _kinds(data)
    n = len(data)
    first = np.zeros(n, bool)
    first[doc_at] = True
    word = first.copy()
    word[1:] |= kind[1:] != kind[:-1]
    apostrophes = np.flatnonzero(data == 0x27)
    alone = apostrophes[word[apostrophes] & np.append(word, True)[apostrophes + 1]]
    # A white-space run before other text in its document: its last character stands
    # alone or, if it is a blank, belongs to the next word.
    space = kind == SPACE
    after = 1 + np.flatnonzero(space[:-1] & ~space[1:] & ~first[1:])
    last = after - 1
    for _ in range(3):  # from its last byte to its first
        last -= data.take(last) & 0xC0 == 0x80
    word[last] = True
    word[after[data.take(after - 1) == 0x20]] = False
    # Contractions: a run of one apostrophe that no blank was joined to.
    single = alone[word[alone]]
    padded = np.append(data, np.zeros(2, np.uint8))
    inside = np.append(~first, [False, False])
    one = np.where(inside[single + 1], padded[single + 1], 0)
    two = np.where(inside[single + 1] & inside[single + 2], padded[single + 2], 0)
    size = np.where(np.isin(one, [ord(c) for c in "stmd"]), 1, 0)
    for pair in ("re", "ve", "ll"):
        size[(one == ord(pair[0])) & (two == ord(pair[1]))] = 2
    single, size = single[size > 0], size[size > 0]
    word[single + 1] = False
    behind = single + 1 + size
    word[behind[behind < n]] = True
    return word


def split_words(texts: pa.Array, added: re.Pattern[bytes] | None = None) -> Words:
    """The words of each text of a string array without nulls. A match of ``added`` is a
    word of its own, and the texts before and after it are split each for itself."""
    texts.validate(full=True)  # UTF-8
    texts = texts.cast(pa.binary())
    if not len(texts):
        return Words(pa.array([], pa.binary()), np.zeros(0, np.int64), np.zeros(1, np.int64))
    bounds = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    if bounds[0] == bounds[-1]:
        return Words(pa.array([], pa.binary()), np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64))
    buffer = texts.buffers()[2].slice(bounds[0], bounds[-1] - bounds[0])
    data = np.frombuffer(buffer, np.uint8)
    bounds -= bounds[0]
    doc_at = bounds[:-1][np.diff(bounds) > 0]
    cuts = np.array([(low + m.start(), low + m.end()) for low, text in zip(bounds[:-1].tolist(), texts.to_pylist(), strict=True)
                     for m in added.finditer(text)] if added and added.search(buffer) else [], np.int64).reshape(-1, 2)
    apart = np.union1d(doc_at, cuts)
    word = _starts(data, apart[apart < len(data)])
    for low, high in cuts.tolist():
        word[low + 1:high] = False
    at = np.flatnonzero(word)
    ends = np.append(at, len(data)).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(ends), buffer])
    encoded = words.dictionary_encode()
    return Words(encoded.dictionary, encoded.indices.to_numpy(), np.searchsorted(at, bounds))


def ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``size[i]`` numbers from ``first[i]`` on, for one i after the other."""
    some = np.flatnonzero(size)
    if len(some) < len(size):
        first, size = first.take(some), size.take(some)
    steps = np.ones(int(size.sum()), np.int64)
    if len(steps):
        steps[0] = first[0]
        steps[np.cumsum(size[:-1])] = first[1:] - first[:-1] - size[:-1] + 1
        np.cumsum(steps, out=steps)
    return steps


@dataclass
class Ragged:
    """Rows of different lengths: row i is ``values[start[i]:start[i + 1]]``."""

    values: np.ndarray
    start: np.ndarray

    @classmethod
    def of(cls, rows: list) -> "Ragged":
        start = np.zeros(len(rows) + 1, np.int64)
        np.cumsum([len(r) for r in rows], out=start[1:])
        flat = np.fromiter(itertools.chain.from_iterable(rows), np.int64, int(start[-1]))
        return cls(flat, start)

    def take(self, rows: np.ndarray) -> "Ragged":
        first = self.start.take(rows)
        size = self.start[1:].take(rows) - first  # of these rows only: there may be many others
        start = np.zeros(len(rows) + 1, np.int64)
        np.cumsum(size, out=start[1:])
        return Ragged(self.values.take(ranges(first, size)), start)


def document_ids(words: Words, word_ids: Ragged) -> Ragged:
    """Token ids of each document, given those of each vocabulary word."""
    flat = word_ids.take(words.code)
    return Ragged(flat.values, flat.start[words.doc_start])


def encode_documents(texts: pa.Array, encode: Callable[[pa.Array], Ragged], piece_bytes: int = CHUNK_BYTES,
                     added: re.Pattern[bytes] | None = None) -> Iterator[Ragged]:
    """Token ids of the documents of a block, in pieces of about ``piece_bytes``. The
    distinct words of the whole block are put together and ``encode`` sees each once;
    matches of ``added`` are words, too."""
    batch = pa.RecordBatch.from_arrays([texts], names=["t"])
    pieces = [split_words(p.column(0), added) for p in slices(batch, "t", piece_bytes)]
    merged = pa.concat_arrays([p.vocabulary for p in pieces] or [pa.array([], pa.binary())]).dictionary_encode()
    ids, place, at = encode(merged.dictionary), merged.indices.to_numpy(), 0
    for piece in pieces:
        own = place[at:at + len(piece.vocabulary)]
        at += len(piece.vocabulary)
        yield document_ids(piece, ids.take(own))
