"""Byte-level BPE by corpus-level merge replay, and decoding.

The distinct words of the whole corpus are merged, each once, however many documents
hold it:

1. each task lists the distinct words of its blocks of documents, per word bucket
   (a hash of the word);
2. a bucket's words from all blocks become one symbol sequence with borders between
   words. An inverted index maps each mergeable token pair, by the rank of what it joins
   to, to the positions where it stands; merges are applied in rank order, each to all
   its positions at once, and only the pairs that a merge forms with its two neighbours
   are looked up and indexed anew;
3. blocks and the ids of their words meet by block, and ids are gathered into documents.

What moves are word lists and word numbers, compressed, never texts or single words. A
block is named by a hash of its content; if the two passes over the documents should not
form the same blocks (rows that change while they are read), the job fails.

The rank of a pair is the rank of its joined bytes, ties go to the leftmost place.
Within a word merges must come in rank order; should a merge form a pair of a lower
rank than its own (a rank file trained by BPE has none in practice), that word is
encoded again alone, step by step.
"""
from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficwatch.llm.base import CHUNK_BYTES, record, slices, text_or_empty
from trafficwatch.llm.pretokens import Ragged, Words, split_words

#: Text bytes of the documents whose distinct words are listed together.
BLOCK_BYTES = 16 << 20
_NONE = np.int32(2**31 - 1)


class Ranks:
    """A tiktoken rank file and the merges that follow from it."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            pairs = [line.split() for line in file if line.strip()]
        self.rank = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.size = max(self.rank.values()) + 1
        keys, ranks = [], []
        for token, rank in self.rank.items():
            for cut in range(1, len(token)):
                left, right = self.rank.get(token[:cut]), self.rank.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left * self.size + right)
                    ranks.append(rank)
        order = np.argsort(np.array(keys, np.int64))
        self._keys = np.array(keys, np.int64)[order]
        self._ranks = np.array(ranks, np.int32)[order]
        self.byte_id = np.array([self.rank[bytes([b])] for b in range(256)], np.int32)
        tokens = [b""] * self.size
        for token, rank in self.rank.items():
            tokens[rank] = token
        self.token = tokens
        self.token_bytes = Ragged.of(tokens)

    def of_pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, or _NONE."""
        key = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        return np.where(self._keys[at] == key, self._ranks[at], _NONE)

    def word(self, word: bytes) -> list[int]:
        """Ids of one word: the lowest-ranked, leftmost pair again and again."""
        parts = [word[i:i + 1] for i in range(len(word))]
        while len(parts) > 1:
            ranks = [self.rank.get(parts[i] + parts[i + 1], _NONE) for i in range(len(parts) - 1)]
            at = min(range(len(ranks)), key=ranks.__getitem__)
            if ranks[at] == _NONE:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [self.rank[p] for p in parts]

    def decode(self, ids: np.ndarray) -> bytes:
        return self.token_bytes.take(ids).values.astype(np.uint8).tobytes()


@functools.cache
def load_ranks(path: str) -> Ranks:
    """One table per worker process and file."""
    return Ranks(path)


def replay(ranks: Ranks, vocabulary: pa.Array) -> Ragged:
    """Ids of each distinct word of ``vocabulary`` (nonempty byte strings)."""
    vocabulary = vocabulary.cast(pa.binary())
    data = np.frombuffer(b"".join(vocabulary.to_pylist()), np.uint8)
    size = pc.binary_length(vocabulary).to_numpy(zero_copy_only=False).astype(np.int64)
    start = np.concatenate([[0], np.cumsum(size)])
    n = len(data)
    token = ranks.byte_id[data]
    after = np.arange(1, n + 1, dtype=np.int32)  # next live position; n: the word ends
    after[start[1:] - 1] = n
    before = np.arange(-1, n - 1, dtype=np.int32)  # previous live position; -1: none
    before[start[:-1]] = -1
    rank_at = np.full(n + 1, _NONE, np.int32)  # rank of the pair that starts here
    alive = np.ones(n, bool)
    odd_words: set[int] = set()

    index: dict[int, list[np.ndarray]] = {}
    queue: list[int] = []

    def enter(places: np.ndarray, pair_ranks: np.ndarray) -> None:
        order = np.argsort(pair_ranks, kind="stable")
        places, pair_ranks = places[order], pair_ranks[order]
        cuts = np.flatnonzero(np.diff(pair_ranks)) + 1
        heads = pair_ranks[np.concatenate([[0], cuts])] if len(places) else pair_ranks
        for rank, part in zip(heads.tolist(), np.split(places, cuts), strict=True):
            if rank not in index:
                index[rank] = []
                heapq.heappush(queue, rank)
            index[rank].append(part)

    def look_up(places: np.ndarray) -> None:
        """Rank and index the pairs that start at ``places``."""
        right = after[places]
        whole = right < n
        found = np.full(len(places), _NONE, np.int32)
        found[whole] = ranks.of_pairs(token[places[whole]], token[right[whole]])
        rank_at[places] = found
        known = found != _NONE
        if known.any():
            enter(places[known], found[known])

    if n:
        look_up(np.arange(n, dtype=np.int32))
    while queue:
        rank = heapq.heappop(queue)
        places = np.concatenate(index.pop(rank))
        places = np.unique(places[alive[places] & (rank_at[places] == rank)])
        if not len(places):
            continue
        # Chains of overlapping pairs: leftmost first, so every other one merges.
        chained = np.zeros(len(places), bool)
        chained[1:] = after[places[:-1]] == places[1:]
        if chained.any():
            number = np.arange(len(places))
            head = np.maximum.accumulate(np.where(chained, 0, number))
            places = places[(number - head) % 2 == 0]
        gone = after[places]
        token[places] = rank
        alive[gone] = False
        rank_at[gone] = _NONE
        behind = after[gone]
        after[places] = behind
        inner = behind < n
        before[behind[inner]] = places[inner]
        left = before[places]
        touched = np.unique(np.concatenate([places, left[left >= 0]]))
        look_up(touched)
        lower = touched[rank_at[touched] < rank]
        if len(lower):
            odd_words.update(np.unique(np.searchsorted(start, lower, side="right") - 1).tolist())
    kept = np.flatnonzero(alive)
    result = Ragged(token[kept].astype(np.int64), np.searchsorted(kept, start))
    if odd_words:
        rows = [result.values[a:b] for a, b in zip(result.start[:-1], result.start[1:], strict=True)]
        for word in odd_words:
            rows[word] = ranks.word(vocabulary[word].as_py())
        result = Ragged.of(rows)
    return result


_ENCODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])
_DIGESTS = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()),
                      ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
_WORDS = pa.schema([("block", pa.string()), ("bucket", pa.int32()), ("places", pa.binary()),
                    ("lengths", pa.binary()), ("words", pa.binary())])
_WORD_IDS = pa.schema([("block", pa.string()), ("places", pa.binary()), ("counts", pa.binary()), ("ids", pa.binary())])
_CODED = pa.schema([("block", pa.string()), ("doc_ids", pa.list_(pa.int64())),
                    ("word_counts", pa.binary()), ("codes", pa.binary())])
_WORD_IDS_DDL = "block string, places binary, counts binary, ids binary"


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers below 2**32, their four bytes apart (like with like), compressed."""
    return zstandard.compress(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 3)


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Batches of a task put together to blocks of about ``limit`` text bytes."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        for piece in slices(batch, "text", limit):
            nbytes = pc.sum(pc.binary_length(piece.column(1))).as_py() or 0
            if held and size + nbytes > limit:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
            held.append(piece)
            size += nbytes
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _block_words(block: pa.RecordBatch) -> tuple[str, pa.Array, np.ndarray, np.ndarray]:
    """(name, vocabulary, word numbers, words per document); frequent words have low numbers."""
    name = xxhash.xxh3_128(repr(block.column(0).to_pylist()).encode())
    pieces: list[Words] = []
    for piece in slices(block, "text", CHUNK_BYTES):
        for text in piece.column(1).to_pylist():
            name.update(text.encode() + b"\xff")
        pieces.append(split_words(piece.column(1)))
    merged = pa.concat_arrays([p.vocabulary for p in pieces] or [pa.array([], pa.binary())]).dictionary_encode()
    place, at, codes = merged.indices.to_numpy(), 0, []
    for piece in pieces:
        codes.append(place[at:at + len(piece.vocabulary)][piece.code])
        at += len(piece.vocabulary)
    flat = np.concatenate([np.zeros(0, np.int64), *codes])
    by_use = np.argsort(-np.bincount(flat, minlength=len(merged.dictionary)), kind="stable")
    number = np.empty(len(by_use), np.int64)
    number[by_use] = np.arange(len(by_use))
    counts = np.concatenate([np.zeros(0, np.int64), *(np.diff(p.doc_start) for p in pieces)])
    return name.hexdigest(), merged.dictionary.take(pa.array(by_use)), number[flat], counts


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))


def word_lists(docs: DataFrame, buckets: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(block, bucket, places, lengths, words): each block's distinct words, dealt into
    buckets, with their numbers in the block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, block_bytes):
            name, vocabulary, _, _ = _block_words(block)
            words = vocabulary.to_pylist()
            of = np.fromiter((zlib.crc32(w) % buckets for w in words), np.int64, len(words))
            for bucket in np.unique(of).tolist():
                own = np.flatnonzero(of == bucket)
                listed = [words[i] for i in own.tolist()]
                yield record(_WORDS, [name], [bucket], [_packed(own)],
                             [_packed(np.array([len(w) for w in listed]))], [zstandard.compress(b"".join(listed), 3)])

    return docs.mapInArrow(run, "block string, bucket int, places binary, lengths binary, words binary")


def replay_buckets(words: DataFrame, ranks_path: str) -> DataFrame:
    """(block, places, counts, ids): ids of each block's words. A bucket holds the corpus'
    words of one hash value, listed once per block that has them. Tasks that hold the
    same rows list equal blocks under one name; the first list stands for all."""
    def run(group: pa.Table) -> pa.Table:
        first = {name: at for at, name in reversed(list(enumerate(group.column("block").to_pylist())))}
        group = group.take(sorted(first.values()))
        lengths = [_unpacked(v) for v in group.column("lengths").to_pylist()]
        data = b"".join(zstandard.decompress(v) for v in group.column("words").to_pylist())
        cuts = np.concatenate([[0], np.cumsum(np.concatenate(lengths))])
        listed = pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), pa.py_buffer(data)])
        distinct = listed.dictionary_encode()
        ids = replay(load_ranks(ranks_path), distinct.dictionary)
        code, at, counts, values = distinct.indices.to_numpy(), 0, [], []
        for length in lengths:
            own = ids.take(code[at:at + len(length)])
            at += len(length)
            counts.append(_packed(np.diff(own.start)))
            values.append(_packed(own.values))
        return pa.Table.from_batches([record(
            _WORD_IDS, group.column("block").to_pylist(), group.column("places").to_pylist(), counts, values)])

    return words.groupBy("bucket").applyInArrow(run, _WORD_IDS_DDL)


def coded_blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(block, doc_ids, word_counts, codes): each block's documents as word numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, block_bytes):
            name, _, codes, counts = _block_words(block)
            yield record(_CODED, [name], [block.column(0).to_pylist()], [_packed(counts)], [_packed(codes)])

    return docs.mapInArrow(run, "block string, doc_ids array<long>, word_counts binary, codes binary")


def _block_ids(block: pa.Table, words: pa.Table) -> Iterator[tuple[list, Ragged]]:
    """(doc ids, token ids) of the documents of one block, some documents at a time; a
    block that several tasks formed comes as often."""
    places, counts, values = ([_unpacked(v) for v in words.column(c).to_pylist()] for c in ("places", "counts", "ids"))
    known = int(sum(map(len, places)))
    for doc_ids, word_counts, packed in zip(*(block.column(c).to_pylist() for c in ("doc_ids", "word_counts", "codes")), strict=True):
        codes, starts = _unpacked(packed), np.concatenate([[0], np.cumsum(_unpacked(word_counts))])
        if (int(codes.max()) + 1 if len(codes) else 0) != known:
            raise RuntimeError("the two passes over the documents formed different blocks")
        size = np.zeros(known, np.int64)
        for place, count in zip(places, counts, strict=True):
            size[place] = count
        of_word = Ragged(np.zeros(int(size.sum()), np.int64), np.concatenate([[0], np.cumsum(size)]))
        for place, count, ids in zip(places, counts, values, strict=True):
            first = np.cumsum(count) - count
            of_word.values[np.repeat(of_word.start[place] - first, count) + np.arange(len(ids))] = ids
        low = 0
        while low < len(doc_ids):  # about a million words at a time
            high = max(low + 1, int(np.searchsorted(starts, starts[low] + (1 << 20), side="right")) - 1)
            flat = of_word.take(codes[starts[low]:starts[high]])
            yield doc_ids[low:high], Ragged(flat.values, flat.start[starts[low:high + 1] - starts[low]])
            low = high


def _encoded(docs: DataFrame, ranks_path: str, block_bytes: int, make, schema: pa.Schema, ddl: str) -> DataFrame:
    """Rows that ``make(doc ids, token ids)`` makes of all documents."""
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    words = replay_buckets(word_lists(docs, buckets, block_bytes), ranks_path)

    def gather(block: pa.Table, own: pa.Table) -> pa.Table:
        made = [make(doc_ids, ids) for doc_ids, ids in _block_ids(block, own)]
        return pa.Table.from_batches(made, schema=schema)

    return coded_blocks(docs, block_bytes).groupBy("block").cogroup(words.groupBy("block")).applyInArrow(gather, ddl)


def encode(docs: DataFrame, ranks_path: str, doc_id: str = "doc_id", text: str = "text",
           block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, ids): token ids of every whole text. A null text counts as empty and
    has no ids; rows repeat as they do in ``docs``; an empty table gives no rows. Other
    columns are not read."""
    def make(doc_ids: list, ids: Ragged) -> pa.RecordBatch:
        lists = pa.ListArray.from_arrays(pa.array(ids.start, pa.int32()), pa.array(ids.values, pa.int32()))
        return record(_ENCODED, doc_ids, lists)

    return _encoded(_rows(docs, doc_id, text), ranks_path, block_bytes, make, _ENCODED, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """(doc_id, decoded binary): the bytes of each id list; null ids give null."""
    schema = pa.schema([("doc_id", pa.int64()), ("decoded", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = load_ranks(ranks_path)
        for batch in batches:
            for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                yield record(schema, part.column(0), [
                    None if v is None else ranks.decode(np.array(v, np.int64)) for v in part.column(1).to_pylist()])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded binary")


def round_trip_digests(docs: DataFrame, ranks_path: str, doc_id: str = "doc_id", text: str = "text",
                       block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_tokens, sha256 of the ids (little-endian unsigned 32 bits) and of the
    bytes decoded from them. Digests are taken where the ids are gathered, so id lists
    are not moved. Nulls, repeats and empty tables as in :func:`encode`."""
    def make(doc_ids: list, ids: Ragged) -> pa.RecordBatch:
        ranks = load_ranks(ranks_path)
        whole = [ids.values[a:b] for a, b in zip(ids.start[:-1].tolist(), ids.start[1:].tolist(), strict=True)]
        return record(_DIGESTS, doc_ids, [len(v) for v in whole],
                      [hashlib.sha256(v.astype("<u4").tobytes()).hexdigest() for v in whole],
                      [hashlib.sha256(ranks.decode(v)).hexdigest() for v in whole])

    return _encoded(_rows(docs, doc_id, text), ranks_path, block_bytes, make, _DIGESTS,
                    "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
