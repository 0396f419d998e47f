"""Token ids of whole texts by a ``tokenizers`` library file.

A byte-level tokenizer works on each word of its pattern separately, so the library
is asked for each distinct word once and its ids are gathered into documents. Texts are
first cut at the file's added tokens, as the library does; each is a word with its own id.
"""
from __future__ import annotations

import functools
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from trafficwatch.llm.base import CHUNK_BYTES
from trafficwatch.llm.pretokens import Ragged, encode_documents

#: Text bytes of the documents whose distinct words are looked up together.
BLOCK_BYTES = 8 << 20
#: Words whose ids a task remembers between chunks.
REMEMBERED = 1_000_000  # about 40 bytes each
#: Bytes of these words.
REMEMBERED_BYTES = 64 << 20
#: New words that the library is asked for in one string.
JOINED = 100


def _byte_characters() -> np.ndarray:
    """The character of each byte in a byte-level vocabulary; that of 0xFF, which no text has,
    is a line break here."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = np.zeros(256, np.uint32)
    table[shown] = shown
    hidden = np.setdiff1d(np.arange(256), shown)
    table[hidden] = 0x100 + np.arange(len(hidden))
    table[0xFF] = ord("\n")
    return table


class WordEncoder:
    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self._tokenizer = Tokenizer.from_file(path)
        tokens = list(self._tokenizer.get_added_tokens_decoder().values())
        if any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in tokens):
            raise ValueError("added tokens that look at their neighbours are not supported")
        found = sorted((t.content.encode() for t in tokens), key=len, reverse=True)  # the longest match counts
        #: The file's added tokens.
        self.added = re.compile(b"|".join(map(re.escape, found))) if found else None
        # Words that are no added token only pass the byte alphabet and the merges, so the
        # library's merges can be asked for many in one string, each on a line.
        own = self._tokenizer
        self._bytes_only = own.normalizer is None and isinstance(own.pre_tokenizer, pre_tokenizers.ByteLevel) \
            and not own.pre_tokenizer.add_prefix_space and own.truncation is None and own.padding is None
        self._lines = Tokenizer(own.model)
        self._lines.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")
        self._characters = _byte_characters()
        vocabulary = self._lines.get_vocab()
        #: Bytes of each token; 0 for those that are no token of this kind.
        self._size = np.zeros(max(vocabulary.values(), default=-1) + 1, np.int64)
        self._size[list(vocabulary.values())] = [len(token) for token in vocabulary]
        #: Words and ids that are never forgotten: the added tokens.
        self._always = pa.array(found, pa.binary()), Ragged.of([[self._tokenizer.token_to_id(f.decode())] for f in found])
        self._known, self._ids = self._none()  # remembered words and their ids

    def words(self, vocabulary: pa.Array) -> Ragged:
        """Ids of each of the distinct words ``vocabulary``."""
        # Looked up from the memory's side: the hash table of this block's words is the smaller one.
        known = pc.index_in(self._known, vocabulary)
        at = np.flatnonzero(known.is_valid().to_numpy(zero_copy_only=False))
        place = np.full(len(vocabulary), -1, np.int64)
        place[known.fill_null(0).to_numpy()[at]] = at
        unknown = place < 0
        if unknown.any():
            new = vocabulary.filter(pa.array(unknown))
            ids = self._asked(new)
            place[unknown] = len(self._known) + np.arange(len(new))
            self._known = pa.concat_arrays([self._known, new])
            self._ids = Ragged(np.concatenate([self._ids.values, ids.values.astype(np.uint32)]),
                               np.concatenate([self._ids.start, self._ids.start[-1] + ids.start[1:]]))
        found = self._ids.take(place)
        if len(self._known) > REMEMBERED or self._known.nbytes > REMEMBERED_BYTES:
            # The words of this chunk stay, frequent ones among them.
            self._known, self._ids = self._none()
            if vocabulary.nbytes <= REMEMBERED_BYTES:
                self._known = pa.concat_arrays([self._known, vocabulary])
                self._ids = Ragged(np.concatenate([self._ids.values, found.values]),
                                   np.concatenate([self._ids.start, self._ids.start[-1] + found.start[1:]]))
        return Ragged(found.values.astype(np.int64), found.start)

    def _asked(self, words: pa.Array) -> Ragged:
        """Ids of each of ``words``, none of them an added token, from the library."""
        if self._bytes_only and len(words) >= JOINED:
            offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1]
            data = np.frombuffer(words.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
            ends = (offsets[1:] - offsets[0]).astype(np.int64)
            text = self._characters[np.insert(data, ends, 0xFF)].tobytes().decode("utf-32-le")
            cuts = np.append(0, (ends + np.arange(1, len(words) + 1))[JOINED - 1:-1:JOINED]).tolist() + [len(text)]
            lines = [text[a:b - 1] for a, b in itertools.pairwise(cuts)]
            found = self._lines.encode_batch_fast(lines, add_special_tokens=False)
            flat = np.concatenate([np.array(e.ids, np.int64) for e in found])
            reached = np.cumsum(self._size.take(flat))
            after = np.searchsorted(reached, ends) + 1
            # Each word is the bytes of its tokens, unless the vocabulary lacks a byte.
            if len(flat) == after[-1] and np.array_equal(reached[after - 1], ends):
                return Ragged(flat, np.append(0, after))
        found = self._tokenizer.encode_batch_fast([w.decode() for w in words.to_pylist()], add_special_tokens=False)
        return Ragged.of([e.ids for e in found])

    def _none(self) -> tuple[pa.Array, Ragged]:
        words, ids = self._always
        return words, Ragged(ids.values.astype(np.uint32), ids.start)

    def documents(self, texts: pa.Array, piece_bytes: int = CHUNK_BYTES) -> Iterator[Ragged]:
        """Ids of the documents of a block, piece by piece (see :func:`encode_documents`)."""
        return encode_documents(texts, self.words, piece_bytes, self.added)


@functools.cache
def encoder(path: str) -> WordEncoder:
    """One encoder per worker process and file."""
    return WordEncoder(path)
