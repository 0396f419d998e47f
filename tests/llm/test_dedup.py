"""Exact dedup, SimHash, components, line dedup, winnowing against brute force."""
import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from trafficwatch.llm import exact_dedup, line_dedup, simhash, winnow
from trafficwatch.llm.components import components

DOCS = "doc_id long, text string"


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def least_reachable(links, nodes):
    root = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    return root


def test_exact_dedup_groups(spark):
    rows = [(1, "a"), (2, "a"), (3, "A"), (4, None), (5, ""), (6, "a "), (2, "a"), (None, "a"), (None, "only"),
            (7, "long " * 5000), (8, "long " * 5000)] + [(100 + i, "hot") for i in range(300)]
    docs = spark.createDataFrame(rows, DOCS).repartition(7) \
        .withColumn("keep_id", F.lit("clash")).withColumn("digest", F.lit("clash"))
    found = sorted(map(tuple, exact_dedup.dedup_report(docs, salts=3).collect()), key=str)
    largest = {}
    for doc, text in rows:
        known = largest.get(text or "")
        largest[text or ""] = doc if known is None else max(known, doc or known)
    sizes = Counter(t or "" for _, t in rows)
    expected = sorted(((d, largest[t or ""], sizes[t or ""], d == largest[t or ""], sha(t)) for d, t in rows), key=str)
    assert found == expected
    kept = exact_dedup.keep_largest(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [2, 3, 5, 6, 8, 399]  # one row of each text
    assert exact_dedup.dedup_report(docs.limit(0)).count() == 0


def test_exact_dedup_compares_texts_that_share_a_digest(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup.F, "sha2", lambda column, bits: F.lit("same"))
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], DOCS)
    found = sorted(map(tuple, exact_dedup.dedup_report(docs).collect()))
    assert [r[:4] for r in found] == [(1, 3, 2, False), (2, 2, 1, True), (3, 3, 2, True)]


def test_exact_dedup_plan_is_native(spark):
    docs = spark.createDataFrame([(1, "a")], DOCS)
    plan = exact_dedup.dedup_report(docs)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct"))


def brute_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text).replace("\t", " ").replace("\n", " ")
             .replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@settings(max_examples=60, deadline=None)
@given(st.text("abAB \t\n\x0bé　\x1c", max_size=60))
def test_simhash_fingerprint(text):
    assert simhash.fingerprint(text) == brute_fingerprint(text)


def test_spark_xxhash64_is_the_same_hash(spark):
    value = spark.range(1).select(F.xxhash64(F.lit("abc def ghi"))).first()[0]
    assert value % 2**64 == xxhash.xxh64_intdigest(b"abc def ghi", 42)


@pytest.mark.parametrize("distance", [1, 2, 3, 4])
def test_links_are_all_pairs_within_the_distance(spark, distance):
    rng = random.Random(distance)
    fps = {0, 2**64 - 1, 1, 1 << 63}
    for _ in range(25):
        centre = rng.getrandbits(64)
        for _ in range(8):
            flipped = centre
            for bit in rng.sample(range(64), rng.randint(0, distance + 1)):
                flipped ^= 1 << bit
            fps.add(flipped)
    fps = sorted(f - 2**64 if f >> 63 else f for f in fps)
    found = [tuple(r) for r in simhash.fingerprint_links(spark.createDataFrame([(f,) for f in fps], "fp long"), distance).collect()]
    expected = {(a, b) for i, a in enumerate(fps) for b in fps[i + 1:] if ((a ^ b) % 2**64).bit_count() <= distance}
    assert len(found) == len(set(found)) and set(found) == expected


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_index_of_fingerprints_is_never_broadcast(spark):
    """64 rows for each fingerprint, which Spark counts as one."""
    links = simhash.fingerprint_links(spark.range(5).withColumnRenamed("id", "fp"))
    assert "SortMergeJoin" in physical(links) and "Broadcast" not in physical(links)


def test_tables_of_all_documents_are_never_broadcast(spark):
    docs = spark.createDataFrame([(i, f"a b c {i}") for i in range(5)], DOCS)
    for df in (simhash.near_duplicates(docs), simhash.keep_first(docs)):
        plan = physical(df)
        joins = [line for line in plan.split("\n") if "Join" in line and ("doc_id" in line or "node" in line)]
        assert joins and all("SortMergeJoin" in line for line in joins), plan


def test_components_of_chains_stars_and_rings(spark):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    links += [(rng.randint(400, 460), rng.randint(400, 460)) for _ in range(50)]
    links = [(a, b) if rng.random() < 0.5 else (b, a) for a, b in links]
    nodes = {n for link in links for n in link}
    root = least_reachable(links, nodes)
    found = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert found == {n: r for n, r in root.items() if n != r}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_simhash_query(spark):
    base = " ".join(f"word{i}" for i in range(400))
    rows = [(5, base), (9, base), (3, base + " tail"), (8, None), (4, ""), (6, "\t "), (7, "one"), (10, "ONE"),
            (None, "one"), (11, "two words"), (12, " ".join(f"other{i}" for i in range(300)))]
    rows += [(50 + i, base.replace("word7 ", f"word{i}x ")) for i in range(30)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("fp", F.lit("clash")).withColumn("root", F.lit(1))
    found = simhash.near_duplicates(docs).collect()
    prints = [(d, brute_fingerprint(t or "")) for d, t in rows]
    nodes = sorted({f for _, f in prints})
    root = least_reachable([(a, b) for a in nodes for b in nodes if (a ^ b).bit_count() <= 2], nodes)
    least = {}
    for doc, fp in prints:
        if doc is not None:
            least[root[fp]] = min(doc, least.get(root[fp], doc))
    expected = sorted(((d, f"{fp:016x}", least[root[fp]]) for d, fp in prints), key=str)
    assert sorted(map(tuple, found), key=str) == expected
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == sorted(set(least.values()))  # one row of each component
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def brute_lines(rows, least):
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))

    seen = Counter(k for _, t in rows for k in {key(line) for line in (t or "").split("\n")} if k)
    result = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [line for line in lines if seen[key(line)] < least or not key(line)]
        result.append((doc, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return sorted(result, key=str)


def test_line_dedup(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 40)
    monkeypatch.setattr(line_dedup, "PROBE_ROWS", 30)  # the hot line's shard is probed by many tasks
    rng = random.Random(3)
    pool = ["Menu", " menu\t", "Éa", "éa", "COPYRIGHT 2020", "x" * 5000, "", "  ", "a\rb", "\x1cz"] + [f"line {i}" for i in range(60)]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 12)))) for i in range(120)]
    rows += [(500, None), (None, "Menu\nonly here"), (7, "Menu\nrepeated id"), (501, "\n\n"), (502, "MENU")]
    docs = spark.createDataFrame(rows, DOCS).withColumn("key", F.lit("clash")).withColumn("shard", F.lit(1))
    found = sorted(map(tuple, line_dedup.line_report(docs).collect()), key=str)
    assert found == brute_lines(rows, 10)
    assert line_dedup.line_report(docs.limit(0)).count() == 0


@settings(max_examples=30, deadline=None)
@given(st.sets(st.binary(min_size=16, max_size=16), max_size=300))
def test_perfect_hash_finds_members_and_rejects_others(keys):
    numbers = np.frombuffer(b"".join(sorted(keys)), "<u8").reshape(-1, 2)
    counts = np.arange(1, len(numbers) + 1)
    arrays = line_dedup.PerfectHash.from_bytes(line_dedup.PerfectHash.build(numbers, counts).to_bytes())
    assert arrays.lookup(numbers).tolist() == np.minimum(counts, 255).tolist()
    others = numbers ^ np.uint64(0x5555555555555555)
    strange = np.array([o.tobytes() not in keys for o in others], bool)
    assert not arrays.lookup(others)[strange].any()


def brute_winnow(text, k, window):
    points = [ord(c) for c in text]
    grams = [points[i:i + min(k, len(points))] for i in range(max(1, len(points) - k + 1))] if points else []
    mask, hashes = 2**64 - 1, []
    for gram in grams:
        h = 0
        for p in gram:
            h = (h * 0x9E3779B97F4A7C15 + p + 1) & mask
        h ^= h >> 30
        h = h * 0xBF58476D1CE4E5B9 & mask
        h ^= h >> 27
        h = h * 0x94D049BB133111EB & mask
        hashes.append((h ^ h >> 31) >> 32)
    width, chosen = min(window, len(hashes)), []
    for i in range(len(hashes) - width + 1):
        best = max(range(i, i + width), key=lambda j: (-hashes[j], j))
        if not chosen or chosen[-1] != best:
            chosen.append(best)
    return [hashes[j] for j in chosen], chosen


@settings(max_examples=80, deadline=None)
@given(st.text("ab😀", max_size=90), st.integers(1, 9), st.integers(1, 12))
def test_winnowing(text, k, window):
    hashes, places = winnow.winnow(text, k, window)
    assert (hashes.tolist(), places.tolist()) == (brute_winnow(text, k, window) if text else ([], []))


def test_short_texts_keep_a_hash_of_what_they_share():
    rng = random.Random(4)
    for n in range(48, 300, 9):
        text = "".join(rng.choice("abcdefghij ") for _ in range(n))
        mixed = winnow.edited(text, "".join(rng.choice("klmnopqrst ") for _ in range(rng.choice((3, n)))))
        one, other = (set(winnow.winnow(t, window=winnow.window_for(t))[0].tolist()) for t in (text, mixed))
        assert one & other


def test_next_documents_of_large_ids_beside_a_null_id(spark):
    # As floats these ids would be equal in pairs.
    rows = [(2**53 + i, f"text number {i} " * 9) for i in range(40)] + [(None, "no id")]
    docs = spark.createDataFrame(rows, DOCS).repartition(7)
    ordered = sorted(rows, key=lambda r: r[0] or 0)
    following = {d: ordered[(i + 1) % len(ordered)][1] for i, (d, _) in enumerate(ordered)}
    found = {r.doc_id: r.edited_sha256 for r in winnow.edit_report(docs).collect()}
    assert found == {d: sha(winnow.edited(t, following[d])) for d, t in rows}


def test_shared_passage_shares_a_hash():
    rng = random.Random(1)
    letters = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    passage = letters(winnow.K + winnow.WINDOW - 1)
    for _ in range(50):
        one, two = letters(200) + passage + letters(90), letters(31) + passage + letters(400)
        assert set(winnow.winnow(one)[0].tolist()) & set(winnow.winnow(two)[0].tolist())


@pytest.mark.parametrize("parts", ["1", "5"])
def test_edit_report(spark, parts):
    rng = random.Random(8)
    rows = [(i * 3, "".join(rng.choice("abé😀 ") for _ in range(rng.randint(0, 300)))) for i in range(60)]
    rows += [(400, None), (None, "no id here"), (12, "repeated id"), (500, ""), (501, "x" * 4000)]
    docs = spark.createDataFrame(rows, DOCS).repartition(4).withColumn("part", F.lit(0)).withColumn("own", F.lit("clash"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        found = sorted(map(tuple, winnow.edit_report(docs).collect()), key=str)
        one = winnow.edit_report(docs.where("doc_id = 501")).collect()
        assert winnow.edit_report(docs.limit(0)).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    expected = []
    for i, (doc, text) in enumerate(ordered):
        text, following = text or "", ordered[(i + 1) % len(ordered)][1] or ""
        half = len(text) // 2
        mixed = text[:len(text) - half] + following[:half]
        own, other, next_ = (winnow.winnow(t, window=winnow.window_for(t))[0] for t in (text, mixed, following))
        expected.append((doc, len(text), sha(mixed), "".join(f"{h:08x}" for h in own.tolist()),
                         "".join(f"{h:08x}" for h in other.tolist()), winnow.likeness(own, other), winnow.likeness(own, next_)))
    assert found == sorted(expected, key=str)
    assert len(one) == 1 and one[0].near_next == 1.0
