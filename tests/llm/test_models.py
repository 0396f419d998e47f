"""Language identification and toxicity: brute-force search, folds, held-out accuracy."""
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from trafficwatch.llm import langid, toxicity
from trafficwatch.llm.base import table
from conftest import SF_MID

DOCS = "doc_id long, text string, lang string"
SYLLABLES = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["sch", "ung", "er", "ich"], "cc": ["éa", "oux", "que", "ai"]}


def invented(rng, lang, words):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(words))


def documents(n=240):
    rng = random.Random(2)
    return [(i, invented(rng, lang := rng.choice(list(SYLLABLES)), rng.randint(1, 40)), lang) for i in range(n)]


def test_language_learns_from_its_fold_only(spark):
    rows = documents()
    docs = spark.createDataFrame(rows, DOCS)
    odd = [(1000, None, "aa"), (1001, "", "aa"), (1002, "12 - 34 !", "bb"), (None, "ka lo mi", None), (1003, "KA LO MI " * 3000, None)]
    everything = docs.union(spark.createDataFrame(odd, DOCS)).withColumn("score", F.lit("clash")).withColumn("p", F.lit(1))
    found = {r.doc_id: r for r in langid.identify(everything).collect()}
    assert len(found) == len(rows) + len(odd)
    for doc, _, lang in rows:
        r = found[doc]
        assert r.held_out == (zlib.crc32(str(doc).encode()) % 3 == 1)
        assert r.lang_pred == lang and 0 <= r.score <= 1
    assert [found[d].lang_pred for d in (1000, 1001, 1002)] == ["und"] * 3 and found[1000].score == 0
    assert found[None].lang_pred == found[1003].lang_pred == "aa"
    # Other labels of held-out rows change nothing.
    lies = everything.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, "zz").otherwise(F.col("lang")))
    again = {r.doc_id: r for r in langid.identify(lies).collect()}
    assert {d: (r.lang_pred, r.score) for d, r in again.items()} == {d: (r.lang_pred, r.score) for d, r in found.items()}
    kept = langid.keep_identified(everything)
    assert kept.columns == everything.columns
    assert {r.doc_id for r in kept.collect()} == set(found) - {1000, 1001, 1002}


def test_language_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "ka lo", None)], DOCS)
    assert [tuple(r)[2:] for r in langid.identify(docs).collect()] == [("und", 0.0)]
    assert langid.identify(docs.limit(0)).count() == 0


def test_without_a_learned_language_texts_with_letters_stay(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 3 == 1)
    rows = [(held, "ka lo", "aa"), (None, "né", None), (1000, "12 - 34 !", None), (1001, "", None), (1002, None, None)]
    for lang in (F.col("lang"), F.lit(None).cast("string")):
        docs = spark.createDataFrame(rows, DOCS).withColumn("lang", lang).withColumn("n", F.lit(1))
        kept = langid.keep_identified(docs)
        assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {held, None}
    assert langid.keep_identified(docs.limit(0)).count() == 0


def test_language_on_the_tables(spark):
    docs = table(spark, SF_MID, "documents")
    found = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id")
    held = [r for r in found.collect() if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)


def test_ftrl_is_sparse_and_temperature_fits():
    rng = np.random.default_rng(0)
    rows = [(np.array([label, 2 + rng.integers(50)]), np.array([0.9, 0.1])) for label in (0, 1) * 100]
    weights, _ = langid.fit_ftrl(rows, np.array([0, 1] * 100), 2)
    assert weights[0, 0] > 0 > weights[0, 1] and np.count_nonzero(weights) < 60
    logits = rng.normal(size=(4000, 3))
    share = np.exp(logits) / np.exp(logits).sum(1, keepdims=True)
    labels = np.array([rng.choice(3, p=p) for p in share])
    assert langid.fit_temperature(logits * 4, labels) == pytest.approx(4, rel=0.15)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 8))
def test_block_max_search_is_exact(seed, k):
    rng = np.random.default_rng(seed)
    def vector():
        at = np.sort(rng.choice(30, rng.integers(1, 8), replace=False))
        x = rng.integers(1, 4, len(at)).astype(float)
        return at, x / np.sqrt(x @ x)

    examples = [vector() for _ in range(rng.integers(0, 200))]
    index = toxicity.BlockMaxIndex(examples, 30, block=8)
    at, x = vector()
    near, cosine = index.nearest(at, x, k)
    dense = np.zeros((len(examples), 30))
    for i, (a, w) in enumerate(examples):
        dense[i, a] = w
    query = np.zeros(30)
    query[at] = x
    scores = dense @ query if len(examples) else np.zeros(0)
    order = sorted(np.flatnonzero(scores > 0).tolist(), key=lambda i: (-round(scores[i], 9), i))[:k]
    assert near.tolist() == order and np.allclose(cosine, scores[order])


def test_isotonic_pools_violators():
    x = np.array([0.1, 0.2, 0.2, 0.4, 0.9])
    knots, rates = toxicity.isotonic(x, np.array([0.0, 1, 0, 0, 1]), np.ones(5))
    assert (np.diff(rates) >= 0).all() and rates[0] == 0 and rates[-1] == 1
    assert np.interp(0.2, knots, rates) == pytest.approx(1 / 3)


def toxic_case(spark, n=600):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(n):
        text, toxic = invented(rng, "aa", 30), int(rng.random() < 0.3)
        if toxic:
            words = text.split()
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["zorgblat", "ZORGBLAT!", "fnordish", "zorgblatter"]))
            text = " ".join(words)
        rows.append((i, text, "aa"))
        if rng.random() < 0.7:
            labels.append((i, 1, toxic))
    truth = {d: int("zorg" in t.lower() or "fnord" in t) for d, t, _ in rows}
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), truth


def test_toxicity_scores_and_evidence(spark):
    docs, labels, truth = toxic_case(spark)
    odd = spark.createDataFrame([(9000, None, None), (9001, "", None), (9002, "ka lo " * 4000 + "zorgblat zorgblat fnordish zorgblat", None)], DOCS)
    docs = docs.union(odd).withColumn("toxic", F.lit("clash")).withColumn("score", F.lit(1))
    labels = labels.union(spark.createDataFrame([(None, 1, 1), (3, 1, None), (5, 0, None)], labels.schema)).union(labels.limit(5))
    found = {r.doc_id: r for r in toxicity.score_documents(docs, labels).collect()}
    assert len(found) == len(truth) + 3
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in found.values())
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) for d, r in found.items())
    assert sum(found[d].predicted == t for d, t in truth.items()) >= 0.98 * len(truth)
    assert found[9000].predicted == found[9001].predicted == 0 and found[9002].predicted == 1
    assert all(found[9002].evidence[i].cosine >= found[9002].evidence[i + 1].cosine for i in range(2))
    assert all(zlib.crc32(str(e.doc_id).encode()) % 4 != 2 for r in found.values() for e in r.evidence)
    # Labels of the held-out fold change nothing.
    lies = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r.doc_id: r.score for r in toxicity.score_documents(docs, lies).collect()}
    assert again == {d: r.score for d, r in found.items()}
    kept = toxicity.keep_civil(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, r in found.items() if not r.predicted}


def test_toxicity_without_labels_or_rows(spark):
    docs, labels, _ = toxic_case(spark, 20)
    assert {r.score for r in toxicity.score_documents(docs, labels.limit(0)).collect()} == {0.0}
    assert {r.score for r in toxicity.score_documents(docs, labels.withColumn("toxic", F.lit(1))).collect()} == {1.0}
    assert toxicity.score_documents(docs.limit(0), labels).count() == 0
