"""Periodic runs: grammar extensions, candidates and the query against brute force."""
import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import SF_SMALL
from trafficwatch.llm import recompression as rc
from trafficwatch.llm.base import table

DOCS = "doc_id long, text string"


def brute_runs(words, min_words=24, min_periods=3):
    """Every period's maximal stretches; of equal stretches the smallest period."""
    found = {}
    for q in range(1, len(words) // min_periods + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(min_words, min_periods * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def periodic(rng, n, letters):
    words = [b"%d" % rng.randrange(letters) for _ in range(n)]
    for _ in range(rng.randint(0, 3)):
        if n > 10:
            a, p, m = rng.randrange(n), rng.randint(1, max(1, n // 4)), rng.randint(1, n)
            for i in range(a + p, min(n, a + m)):
                words[i] = words[i - p]
    return words


def test_runs_equal_brute_force():
    rng = random.Random(3)
    for _ in range(120):
        docs = [periodic(rng, rng.choice([0, 1, 5, 23, 24, 25, 60, 150, 300]), rng.choice([1, 2, 3, 5, 50]))
                for _ in range(rng.randint(1, 8))]
        assert [[tuple(r) for r in runs.tolist()] for runs in rc.find_runs(docs)] == [brute_runs(d) for d in docs]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=3, max_size=60), st.integers(1, 4), st.integers(1, 3))
def test_other_limits(words, min_words, min_periods):
    words = [b"%d" % w for w in words]
    (found,) = rc.find_runs([words], 4 * min_words, 1 + min_periods)
    assert [tuple(r) for r in found.tolist()] == brute_runs(words, 4 * min_words, 1 + min_periods)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=40), min_size=1, max_size=4), st.data())
def test_grammar_extends_exactly(documents, data):
    symbols, wall = [0], 0
    for d in documents:
        wall += 1
        symbols += [len(documents) + 1 + w for w in d] + [wall]
    grammar = rc.Grammar(np.array(symbols), len(documents) + 1)
    # Rules never join a separator, and the last level spells the text out again.
    places = st.integers(0, len(symbols) - 1)
    pairs = data.draw(st.lists(st.tuples(places, places).filter(lambda p: p[0] != p[1]), min_size=1, max_size=20))
    x, y = (np.array(a) for a in zip(*pairs))
    after = before = 0
    for a, b, after, before in zip(x, y, grammar.extend(x, y), grammar.extend(x, y, forward=False)):
        n = 0
        while max(a, b) + n < len(symbols) and symbols[a + n] == symbols[b + n]:
            n += 1
        m = 0
        while min(a, b) - m > 0 and symbols[a - m - 1] == symbols[b - m - 1]:
            m += 1
        assert (after, before) == (n, m)


def test_grid_pieces_are_one_grid(monkeypatch):
    whole = [np.concatenate(a) for a in zip(*rc.grid(500))]
    monkeypatch.setattr(rc, "GRID_CHUNK", 50)
    pieces = list(rc.grid(500))
    assert len(pieces) > 3 and all((np.concatenate(a) == w).all() for a, w in zip(zip(*pieces), whole))
    words = [b"a", b"b", b"c"] * 30 + [b"%d" % i for i in range(60)] + [b"x"] * 40
    assert [tuple(r) for r in rc.find_runs([words, words])[1].tolist()] == brute_runs(words)


def test_strongest_and_collapse():
    runs = np.array([[0, 30, 10], [50, 60, 20], [200, 24, 1], [300, 48, 2]])
    assert rc.strongest(runs) == (200, 24, 1) and rc.strongest(runs[:0]) is None
    assert rc.strongest(runs[:2]) == (0, 30, 10)  # equal exponents: the smaller start
    words = [b"a", b"b"] * 20 + [b"c"]
    assert rc.collapse(words, rc.find_runs([words])[0]) == [b"a", b"b", b"c"]


def expected_row(doc, text):
    words = (text or "").encode().split()
    h = zlib.crc32(b"" if doc is None else str(doc).encode())
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()),
            sha(b" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_query_equals_brute_force(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(f"w{rng.randrange(40)}" for _ in range(rng.randint(0, 200)))) for i in range(150)]
    rows += [(200, None), (None, "a b " * 40), (None, None), (201, ""), (202, " \t\n "), (203, "é ü x\n" * 30),
             (7, "same id"), (7, "same id"), (204, "long " * 6_000 + "tail")]
    docs = spark.createDataFrame(rows, DOCS).repartition(3).withColumn("start", F.lit("clash")).withColumn("n_runs", F.lit(1))
    assert sorted(map(tuple, rc.run_report(docs).collect()), key=str) == sorted((expected_row(*r) for r in rows), key=str)
    runs = rc.periodic_runs(docs).where("doc_id = 203").collect()
    assert [tuple(r) for r in runs] == [(203, 0, 60, 2)]
    assert rc.collapsed_texts(docs).where("doc_id = 204").first().text == "long tail"
    for query in (rc.run_report, rc.periodic_runs, rc.collapsed_texts):
        assert query(docs.limit(0)).count() == 0


def test_query_on_the_whole_table(spark):
    docs = table(spark, SF_SMALL, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect() if len(r.text or "") < 2500]
    found = {r.doc_id: tuple(r) for r in rc.run_report(docs).collect()}
    assert len(found) == docs.count()
    assert all(found[doc] == expected_row(doc, text) for doc, text in rows)
