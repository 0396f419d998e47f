"""Byte-level BPE replay, tokenizer words, Re-Pair shards: exact round trips."""
import base64
import hashlib
import json
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from trafficwatch.llm import bpe_replay, pretokens, repair, tokenize
from trafficwatch.llm.tokenize import encoder

MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PLAIN = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "\n", "'", "''s", " 's", "it's we'll 'tis'", "a  b   c\n\n d \t", "naïve café — ½ ٣ 一二",
       "　x y z", "x\x1cy\x1fz", "aaaaaaaaaaaaaaaa" * 40, "😀😀 é", "<|endoftext|>", "\x00�"]
ALPHABET = "'strevmld aé1½中😀,.\"\r\n\t\x1c\u0085　"
DOCS = "doc_id long, text string"


def tiktoken_encoding():
    with open(MULTI, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def replayed(texts):
    ranks = bpe_replay.load_ranks(MULTI)
    return [r.values[a:b].tolist() for r in pretokens.encode_documents(
                pa.array(texts, pa.string()), lambda words: bpe_replay.replay(ranks, words), 64)
            for a, b in zip(r.start[:-1], r.start[1:])]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(ALPHABET, max_size=30), max_size=6))
def test_words_are_the_matches_of_the_pattern(texts):
    words = pretokens.split_words(pa.array(texts, pa.string()))
    vocabulary = [w.decode() for w in words.vocabulary.to_pylist()]
    for d, text in enumerate(texts):
        own = [vocabulary[c] for c in words.code[words.doc_start[d]:words.doc_start[d + 1]]]
        assert own == regex.findall(public_tokenizers.PATTERN, text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=40), max_size=5))
def test_replay_equals_tiktoken_on_any_text(texts):
    encoding = tiktoken_encoding()
    assert replayed(texts) == [encoding.encode_ordinary(t) for t in texts]


def test_replay_equals_tiktoken_on_odd_texts():
    encoding = tiktoken_encoding()
    assert replayed(ODD) == [encoding.encode_ordinary(t) for t in ODD]


def test_a_merge_to_a_lower_rank_is_replayed_step_by_step(tmp_path):
    # "bc" (257) outranks "abc" (256): joining b and c makes a pair of a lower rank.
    tokens = [bytes([b]) for b in range(256)] + [b"abc", b"bc", b"abcd", b"cabc"]
    path = tmp_path / "ranks.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for i, t in enumerate(tokens)))
    ranks = bpe_replay.Ranks(str(path))
    encoding = tiktoken.Encoding("odd", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks.rank, special_tokens={})
    words = ["abc", "abcd", "abcabc", "cabcabcd", "bcabc", "abcbcabc"]
    found = bpe_replay.replay(ranks, pa.array([w.encode() for w in words], pa.binary()))
    for i, word in enumerate(words):
        assert found.values[found.start[i]:found.start[i + 1]].tolist() == encoding.encode_ordinary(word) == ranks.word(word.encode())


def test_tokenizer_words_equal_the_library_on_whole_texts():
    tokenizer = Tokenizer.from_file(PLAIN)
    texts = [*ODD, "a <|endoftext|> b", "<|endoftext|>", "x\n <|endoftext|><|endoftext|>'s  é", "<|endoftext| >", "|>"]
    texts += [a + b for a, b in zip(texts, texts[1:])]
    (ids,) = encoder(PLAIN).documents(pa.array(texts))
    for d, text in enumerate(texts):
        assert ids.values[ids.start[d]:ids.start[d + 1]].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_round_trip_query_and_encode_decode(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(99, None), (None, "x y"), (3, ODD[3])]
    docs = spark.createDataFrame(rows, DOCS).withColumn("ids", F.lit("clash")).withColumn("n_tokens", F.lit(0))
    encoding = tiktoken_encoding()
    found = bpe_replay.round_trip_digests(docs, MULTI, block_bytes=50).collect()
    assert len(found) == len(rows)
    expected = sorted((str(d), len(i := encoding.encode_ordinary(t or "")),
                       hashlib.sha256(np.array(i, "<u4").tobytes()).hexdigest(),
                       hashlib.sha256((t or "").encode()).hexdigest()) for d, t in rows)
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found) == expected
    decoded = bpe_replay.decode(bpe_replay.encode(docs, MULTI), MULTI).collect()
    assert sorted((str(r.doc_id), bytes(r.decoded)) for r in decoded) == sorted((str(d), (t or "").encode()) for d, t in rows)
    assert bpe_replay.round_trip_digests(docs.limit(0), MULTI).count() == 0


def test_equal_blocks_of_several_tasks(spark):
    rows = [(i, f"{t} row {i % 5}") for i, t in enumerate(ODD)] + [(None, "x y"), (None, None)]
    table = spark.createDataFrame(spark.sparkContext.parallelize(rows * 3, 3), DOCS).union(
        spark.createDataFrame(spark.sparkContext.parallelize([(None, "same row")] * 2, 2), DOCS))
    assert table.rdd.getNumPartitions() == 5
    encoding = tiktoken_encoding()
    everything = rows * 3 + [(None, "same row")] * 2
    for block_bytes in (60, 1 << 20):
        found = bpe_replay.round_trip_digests(table, MULTI, block_bytes=block_bytes).collect()
        assert sorted((str(r.doc_id), r.n_tokens, r.decoded_sha256) for r in found) == sorted(
            (str(d), len(encoding.encode_ordinary(t or "")), hashlib.sha256((t or "").encode()).hexdigest()) for d, t in everything)
    encoded = bpe_replay.encode(table, MULTI).collect()
    assert sorted((str(r.doc_id), r.ids) for r in encoded) == sorted(
        (str(d), encoding.encode_ordinary(t or "")) for d, t in everything)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.integers(0, 6), max_size=60), max_size=6), st.integers(2, 4))
def test_repair_shard_decodes_every_document_and_range(documents, min_count):
    arrays = [np.array(d, np.int64) for d in documents]
    shard = repair.Shard(repair.write_shard(arrays, min_count))
    assert [shard.document(k).tolist() for k in range(len(shard))] == documents
    flat = [x for d in documents for x in d]
    for start in range(0, len(flat), 7):
        assert shard.tokens(start, min(len(flat), start + 5)).tolist() == flat[start:start + 5]


def test_repair_makes_rules_and_refuses_damage():
    ids = np.array([1, 2, 3, 4] * 500, np.int64)
    rules, lengths, sequence, terminals = repair.compress(ids, 4)
    assert len(rules) and len(sequence) < len(ids) // 20 and lengths.max() > 8 and terminals == 5
    with pytest.raises(ValueError):
        repair.Shard(b"XXXX" + repair.write_shard([ids])[4:])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=120), st.integers(2, 4))
def test_repair_goes_on_until_no_pair_is_frequent(ids, min_count):
    rules, lengths, sequence, terminals = repair.compress(np.array(ids, np.int64), min_count)
    assert repair.expand(sequence, rules, terminals).tolist() == ids and len(set(map(tuple, rules.tolist()))) == len(rules)
    assert [len(repair.expand(np.array([terminals + k]), rules, terminals)) for k in range(len(rules))] == lengths.tolist()
    counts, after = {}, {}
    for at, pair in enumerate(zip(sequence[:-1].tolist(), sequence[1:].tolist())):
        if after.get(pair, 0) <= at:  # without overlap
            counts[pair], after[pair] = counts.get(pair, 0) + 1, at + 2
    assert max(counts.values(), default=0) < min_count


def test_repair_makes_rules_for_rare_pairs_and_small_shards(monkeypatch):
    # Pairs that stand twice among many that stand once, and a shard of a few ids.
    rare = np.concatenate([np.arange(1000), [7, 8, 9, 10], np.arange(1000, 2000), [7, 8, 9, 10]])
    for ids in (rare, np.array([5, 6, 7, 5, 6, 7])):
        rules, _, sequence, terminals = repair.compress(ids)
        assert len(rules) and len(sequence) < len(ids)
        shard = repair.write_shard([ids[:3], ids[3:]])
        assert [d.tolist() for d in map(repair.Shard(shard).document, (0, 1))] == [ids[:3].tolist(), ids[3:].tolist()]
        monkeypatch.setattr(repair, "SPELLED_IDS", 0)
        assert repair.Shard(shard).document(1).tolist() == ids[3:].tolist()
        monkeypatch.undo()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=80), st.integers(2, 4))
def test_repair_of_ids_too_large_to_be_sorted_with_their_places(ids, min_count):
    large = np.array(ids, np.int64) + (1 << 30)
    left, right, places = large[:-1], large[1:], np.arange(max(0, len(ids) - 1))
    wide = repair._pairs_at(left, right, places, places + 1, min_count)
    counted, after = {}, {}
    for at, pair in enumerate(zip(ids[:-1], ids[1:])):
        if after.get(pair, 0) <= at:  # without overlap
            counted.setdefault(pair, []).append(at)
            if pair[0] == pair[1]:
                after[pair] = at + 2
    expected = {pair: at for pair, at in counted.items() if len(at) >= min_count}
    small = repair._pairs_at(left - (1 << 30), right - (1 << 30), places, places + 1, min_count)
    for (pairs, counts, members), base in ((wide, 1 << 30), (small, 0)):
        lists = np.split(members, np.cumsum(counts)[:-1]) if len(counts) else []
        assert {((p >> 32) - base, (p & 0xFFFFFFFF) - base): at.tolist()
                for p, at in zip(pairs.tolist(), lists, strict=True)} == expected


def test_repair_looks_at_the_places_of_the_chosen_pairs_only():
    ids = np.concatenate([np.arange(1000), [7, 9], np.arange(1000, 2000), [7, 9, 7, 9]])
    work = repair._Sequence(ids.astype(np.int64), 2)
    near = work.near_top()
    assert work.pairs[near].tolist() == [7 << 32 | 9] and work.places_of(near).tolist() == [1000, 2002, 2004]
    at, codes = work.chosen(near)
    work.replace(at, np.full(len(at), 5000))
    assert codes.tolist() == near.tolist() and work.symbols[work.alive].tolist() == [
        *range(1000), 5000, *range(1000, 2000), 5000, 5000]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 50), st.integers(0, 4)), max_size=12))
def test_ranges_of_any_size(pairs):
    first, size = np.array([p[0] for p in pairs], np.int64), np.array([p[1] for p in pairs], np.int64)
    assert pretokens.ranges(first, size).tolist() == [f + k for f, n in pairs for k in range(n)]


def test_taking_some_rows_does_not_read_all_others():
    class Small(np.ndarray):
        def __array_ufunc__(self, ufunc, method, *inputs, **options):
            assert all(np.size(i) < 100 for i in inputs)
            return getattr(ufunc, method)(*(np.asarray(i) for i in inputs), **options)

    rows = pretokens.Ragged(np.arange(6000), np.arange(0, 6001, 3).view(Small))
    taken = rows.take(np.array([1999, 0, 0, 7]))
    assert taken.values.tolist() == [5997, 5998, 5999, 0, 1, 2, 0, 1, 2, 21, 22, 23] and taken.start.tolist() == [0, 3, 6, 9, 12]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=40), max_size=8))
def test_repair_documents_together_and_one_by_one(documents):
    data = repair.write_shard([np.array(d, np.int64) for d in documents])
    shard, unspelled = repair.Shard(data), repair.Shard(data)
    unspelled._spelled = None
    assert [d.tolist() for d in shard.documents()] == [d.tolist() for d in unspelled.documents()] == documents


def test_repair_lists_only_places_that_hold_the_pair_and_keeps_32_bits_a_place():
    ids = np.array([1, 2, 3, 1, 2, 4, 2, 3] * 20)
    work = repair._Sequence(ids, 2)
    of = {(p >> 32, p & 0xFFFFFFFF): c for c, p in enumerate(work.pairs.tolist())}
    assert work.places_of(np.array([of[2, 3]])).tolist() == sorted([*range(1, 160, 8), *range(6, 160, 8)])
    first = np.array([of[1, 2]])
    at, codes = work.chosen(first)
    work.replace(at, np.full(len(at), 9))
    assert codes.tolist() == first.tolist() and work.places_of(first).tolist() == []
    assert work.places_of(np.array([of[2, 3], of[4, 2]])).tolist() == sorted([*range(5, 160, 8), *range(6, 160, 8)])
    assert {a.itemsize for a in (work.symbols, work.next, work.before, work.code, work.members)} == {4}
    # Where 32 bits may not hold all symbols, 64 are kept.
    large = ids + (1 << 31) - 100
    assert repair._Sequence(large, 2).symbols.itemsize == 8
    rules, _, sequence, terminals = repair.compress(large)
    assert len(rules) > 5 and repair.expand(sequence, rules, terminals).tolist() == large.tolist()


def test_token_files_in_id_order(spark):
    rows = [(7, "seven seven"), (2, None), (5, "a b c"), (None, "no id"), (5, "a a"), (11, "x " * 3000), (12, "a <|endoftext|> b")]
    docs = spark.createDataFrame(rows, DOCS).withColumn("part", F.lit(1)).withColumn("shard", F.lit("clash"))
    tokenizer = Tokenizer.from_file(PLAIN)
    found = repair.round_trip(docs, PLAIN).orderBy("start").collect()
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    at = 0
    for row, (doc, text) in zip(found, ordered, strict=True):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        assert tuple(row) == (doc, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert repair.round_trip(docs.limit(0), PLAIN).count() == 0


def test_known_words_are_not_asked_again(monkeypatch):
    """Not even when the memory of words runs full: those of the last block stay."""
    own = tokenize.WordEncoder(PLAIN)
    asked, real = [], own._tokenizer

    class Counting:
        def encode_batch_fast(self, words, **options):
            asked.append(len(words))
            return real.encode_batch_fast(words, **options)

    own._tokenizer = Counting()
    monkeypatch.setattr(tokenize, "REMEMBERED", 4)
    blocks = [["one two three"], ["one two three four five"], ["five four"], [], ["one"], [""], ["three é😀"]]
    for texts in blocks:
        (ids,) = list(own.documents(pa.array(texts, pa.string()))) or [pretokens.Ragged.of([])]
        assert ids.values.tolist() == [i for t in texts for i in real.encode(t, add_special_tokens=False).ids]
    assert asked == [3, 2, 1, 1, 3]
    asked.clear()
    monkeypatch.setattr(tokenize, "REMEMBERED_BYTES", 3)  # too few for any block
    for _ in range(2):
        list(own.documents(pa.array(["alpha beta gamma"])))
    assert asked == [3, 3]


def library(tokenizer, texts):
    return [i for t in texts for i in tokenizer.encode(t, add_special_tokens=False).ids]


def test_many_new_words_are_asked_in_few_strings(monkeypatch):
    own, tokenizer = tokenize.WordEncoder(PLAIN), Tokenizer.from_file(PLAIN)
    asked, lines = [], own._lines

    class Counting:
        def encode_batch_fast(self, strings, **options):
            asked.append(len(strings))
            return lines.encode_batch_fast(strings, **options)

    own._lines, own._tokenizer = Counting(), None
    words = [f"w{i:x}é{i * 7919 % 9973}ÿĊ\n<|endoftext|>{chr(0x4E00 + i)}  {chr(0x1F300 + i)}'s" for i in range(300)]
    monkeypatch.setattr(tokenize, "REMEMBERED", 1500)
    for block in (words[:200], words[100:], [*words[250:], *ODD, "".join(f" u{i}x" for i in range(400))]):
        (ids,) = own.documents(pa.array(block, pa.string()))
        assert ids.values.tolist() == library(tokenizer, block)
        for d, text in enumerate(block[:20]):
            assert ids.values[ids.start[d]:ids.start[d + 1]].tolist() == library(tokenizer, [text])
    assert len(asked) == 3 and max(asked) < 30


def test_words_whose_bytes_the_vocabulary_lacks(tmp_path):
    tokens = ["a", "b", "c", "Ġ", "ab", "Ġa"]  # no other bytes: the library leaves them out
    path = tmp_path / "few.json"
    path.write_text(json.dumps({"version": "1.0", "added_tokens": [], "normalizer": None, "post_processor": None, "decoder": None,
                                "truncation": None, "padding": None,
                                "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True},
                                "model": {"type": "BPE", "vocab": {t: i for i, t in enumerate(tokens)},
                                          "merges": [["a", "b"], ["Ġ", "a"]]}}))
    texts = [" ".join("abcx"[i % 4] + "ab" * (i % 7) + "c" * (i // 7) for i in range(150)), " x abx a"]
    (ids,) = tokenize.WordEncoder(str(path)).documents(pa.array(texts))
    assert ids.values.tolist() == library(Tokenizer.from_file(str(path)), texts)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("a1.' \n\u00a0\u1680\u2003\u3000é\u0660中\ue000😀𝐀𝟙s", max_size=20), max_size=5), st.integers(0, 3))
def test_words_of_two_to_four_byte_characters(texts, skip):
    array = pa.array(["skipped é"] * skip + texts, pa.string()).slice(skip)
    words = pretokens.split_words(array)
    vocabulary = [w.decode() for w in words.vocabulary.to_pylist()]
    assert [[vocabulary[c] for c in words.code[a:b]] for a, b in zip(words.doc_start[:-1], words.doc_start[1:])] == [
        regex.findall(public_tokenizers.PATTERN, t) for t in texts]


def test_bytes_that_are_no_text_are_refused():
    raw = pa.array([b"a \xff b", b"ok"], pa.binary())
    with pytest.raises((ValueError, pa.ArrowInvalid)):
        pretokens.split_words(pa.Array.from_buffers(pa.string(), 2, raw.buffers()))
