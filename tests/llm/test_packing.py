"""Best-fit packing: every plan and the query against its rules."""
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from trafficwatch.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def sequences_of(histogram, capacity):
    runs = packing.plan(histogram, capacity)
    sequences = {}
    for i, (length, first) in enumerate(zip(runs.length.tolist(), runs.first.tolist())):
        last = i + 1 == len(runs.length) or runs.length[i + 1] != length
        stop = histogram[length] if last else int(runs.first[i + 1])
        assert first == 0 or runs.length[i - 1] == length
        for k in range(stop - first):
            sequences.setdefault(int(runs.base[i]) + k, []).append((int(runs.offset[i]), length))
    assert sorted(sequences) == list(range(runs.sequences))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    assert sum(map(len, sequences.values())) == sum(histogram.values())
    return runs.sequences


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 256), st.integers(1, 40), max_size=40))
def test_any_histogram_is_placed_whole_and_gapless(histogram):
    packed = sequences_of(histogram, 256)
    total = sum(k * n for k, n in histogram.items())
    assert -(-total // 256) <= packed <= 2 * -(-total // 256) + 1


def test_packing_is_near_the_bound():
    rng = np.random.default_rng(1)
    for lengths in (rng.integers(1, 1025, 30_000), np.clip(rng.exponential(300, 30_000).astype(int) + 1, 1, 1024)):
        values, counts = np.unique(lengths, return_counts=True)
        bound = -(-int(lengths.sum()) // 1024)
        assert sequences_of(dict(zip(values.tolist(), counts.tolist())), 1024) <= 1.015 * bound


def test_linear_groups_are_of_equal_cardinality():
    groups = packing.linear_groups({100: 50, 90: 3, 80: 47, 70: 20}, 4)
    assert [sum(n for _, n in g) for g in groups] == [30, 30, 30, 30]
    assert [length for g in groups for length, _ in g] == sorted((length for g in groups for length, _ in g), reverse=True)


def check(rows, found, capacity=1024):
    tokenizer = Tokenizer.from_file(PATH)
    expected = []
    for doc, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        cuts = [0, *range((len(ids) - 1) % capacity + 1, len(ids) + 1, capacity)]
        expected += [(doc, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted((tuple(r)[:5] for r in found), key=str) == sorted(expected, key=str)
    sequences = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in sequences.values():
        held.sort()
        assert [o for o, _ in held] == [sum(n for _, n in held[:i]) for i in range(len(held))]
        assert sum(n for _, n in held) <= capacity


def test_pack_documents(spark, monkeypatch):
    monkeypatch.setattr(packing, "WINDOW_ROWS", 7)  # the hot length spans several rank windows
    rows = [(i, "same words here") for i in range(60)] + [(100, None), (101, ""), (None, "no id"), (3, "repeated id")]
    rows += [(200 + i, "longer text " * (40 * i)) for i in range(20)] + [(300, "x y " * 20_000), (301, "a <|endoftext|> b<|endoftext|>")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("length", F.lit("clash")).withColumn("salt", F.lit(1))
    check(rows, packing.pack_documents(docs, PATH).collect())
    assert packing.pack_documents(docs.limit(0), PATH).count() == 0
