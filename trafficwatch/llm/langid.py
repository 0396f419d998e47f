"""Language identification.

Sparse multinomial logistic regression on TF-IDF character n-grams (1 to 3 letters,
hashed into BUCKETS), trained by follow-the-regularised-leader (FTRL-proximal) with an
elastic net, and calibrated by temperature.

Document frequencies cover all training documents. Weights are fitted on a bounded
sample: about ``per_language`` documents of each language, chosen by a hash of the id;
a quarter of them only sets the temperature. The model has BUCKETS x languages
numbers, whatever the size of the corpus.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficwatch.llm.base import crc32_bucket, map_batches, record, slices
from trafficwatch.llm.chargrams import gram_buckets, letter_points

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
PER_LANGUAGE = 1000
UNDETERMINED = "und"
#: FTRL-proximal and elastic net.
ALPHA, BETA, L1, L2, EPOCHS = 1.0, 1.0, 0.02, 0.01, 3
#: Documents below this calibrated score are rejected by :func:`keep_identified`.
MIN_SCORE = 0.3


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, occurrences) of a text's n-grams."""
    points = letter_points(text)
    if not len(points):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    found = np.bincount(np.concatenate([gram_buckets(points, n, BUCKETS) for n in ORDERS]), minlength=BUCKETS)
    at = np.flatnonzero(found)
    return at, found[at]


def document_frequencies(texts: DataFrame) -> np.ndarray:
    """Documents that hold each bucket's n-grams; the last entry counts the documents."""
    schema = pa.schema([("bucket", pa.int32()), ("documents", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS + 1, np.int64)
        for batch in batches:
            for piece in slices(batch, "text", 1 << 20):
                for text in piece.column(0).to_pylist():
                    total[gram_counts(text)[0]] += 1
                    total[BUCKETS] += 1
        at = np.flatnonzero(total)
        yield record(schema, at, total[at])

    rows = texts.select("text").mapInArrow(run, "bucket int, documents long") \
        .groupBy("bucket").agg(F.sum("documents").alias("documents")).collect()  # BUCKETS + 1 rows at most
    result = np.zeros(BUCKETS + 1, np.int64)
    for row in rows:
        result[row["bucket"]] = row["documents"]
    return result


def tfidf(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, weights) with logarithmic term frequency, of length 1."""
    at, found = gram_counts(text)
    weight = (1 + np.log(found)) * idf[at] if len(at) else np.zeros(0)
    norm = np.sqrt(weight @ weight)
    return at, weight / norm if norm else weight


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray  # float32, BUCKETS
    weights: np.ndarray  # float32, BUCKETS x languages
    bias: np.ndarray
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, calibrated probability); UNDETERMINED with 0 without letters."""
        at, weight = tfidf(text, self.idf) if text else ((), ())
        if not len(at) or not self.languages:
            return UNDETERMINED, 0.0
        logits = (weight @ self.weights[at] + self.bias) / self.temperature
        share = np.exp(logits - logits.max())
        best = int(logits.argmax())
        return self.languages[best], float(share[best] / share.sum())


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """(weights, bias) of the multinomial model by FTRL-proximal with L1 and L2."""
    size = BUCKETS + 1  # the last row is the bias
    z = np.zeros((size, classes))
    n = np.zeros((size, classes))

    def weights(at):
        kept = np.abs(z[at]) > L1
        return np.where(kept, (np.sign(z[at]) * L1 - z[at]) / ((BETA + np.sqrt(n[at])) / ALPHA + L2), 0)

    order = np.random.default_rng(0)
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            at, x = np.append(rows[i][0], BUCKETS), np.append(rows[i][1], 0.1)
            w = weights(at)
            logits = x @ w
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[labels[i]] -= 1
            gradient = x[:, None] * p
            squared = gradient**2
            z[at] += gradient - (np.sqrt(n[at] + squared) - np.sqrt(n[at])) / ALPHA * w
            n[at] += squared
    final = weights(np.arange(size))
    return final[:BUCKETS], final[BUCKETS] * 0.1


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least negative log-likelihood, by golden-section search."""
    def loss(log_t: float) -> float:
        scaled = logits / np.exp(log_t)
        top = scaled.max(axis=1, keepdims=True)
        return float((np.log(np.exp(scaled - top).sum(axis=1)) + top[:, 0]
                      - scaled[np.arange(len(labels)), labels]).sum())

    low, high, golden = np.log(0.02), np.log(20.0), (5**0.5 - 1) / 2
    for _ in range(60):
        a, b = high - golden * (high - low), low + golden * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def train(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """A model from (doc_id, text, lang) rows; rows without text or lang are left out."""
    labelled = labelled.where("text is not null and lang is not null").select("doc_id", "text", "lang")
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    languages = sorted(counts)
    frequency = document_frequencies(labelled)
    idf = (np.log((1 + frequency[BUCKETS]) / (1 + frequency[:BUCKETS])) + 1).astype(np.float32)
    if not languages:
        return Model([], idf, np.zeros((BUCKETS, 0), np.float32), np.zeros(0), 1.0)
    scale = 1 << 30
    share = F.lit(0)
    for lang, count in counts.items():
        share = F.when(F.col("lang") == lang, int(min(1.0, per_language / count) * scale)).otherwise(share)
    sample = labelled.withColumn("turn", F.pmod(F.xxhash64("doc_id", F.lit("langid")), F.lit(scale))) \
        .where(F.col("turn") < share)
    vectors = pa.schema([("lang", pa.string()), ("turn", pa.int64()), ("at", pa.binary()), ("x", pa.binary())])

    def featurise(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = [tfidf(t, idf) for t in batch.column(2).to_pylist()]
        yield record(vectors, batch.column(0), batch.column(1), [a.astype("<u2").tobytes() for a, _ in found],
                     [x.astype("<f4").tobytes() for _, x in found])

    def fit(group: pa.Table) -> pa.Table:
        # Order and folds follow from the hash of the id, not from how rows arrive.
        rows = sorted(zip(*(group.column(c).to_pylist() for c in ("turn", "lang", "at", "x")), strict=True))
        data = [(np.frombuffer(at, "<u2").astype(np.int64), np.frombuffer(x, "<f4").astype(float)) for _, _, at, x in rows]
        y = np.array([languages.index(lang) for _, lang, _, _ in rows])
        held = np.array([turn % 4 == 3 for turn, _, _, _ in rows])
        if held.all() or not held.any():
            held[:] = False
        fitted = [d for d, h in zip(data, held, strict=True) if not h]
        weights, bias = fit_ftrl(fitted, y[~held], len(languages))
        logits = np.array([x @ weights[at] + bias for (at, x), h in zip(data, held, strict=True) if h])
        temperature = fit_temperature(logits, y[held]) if held.any() else 1.0
        return pa.table({"weights": [weights.astype("<f4").tobytes()], "bias": [bias.tolist()],
                         "temperature": [temperature]},
                        schema=pa.schema([("weights", pa.binary()), ("bias", pa.list_(pa.float64())),
                                          ("temperature", pa.float64())]))

    # The bounded sample meets in one task; its vectors are at most 12 bytes per n-gram.
    fitted = map_batches(sample.select("lang", "turn", "text"), featurise,
                         "lang string, turn long, at binary, x binary") \
        .groupBy(F.lit(0).alias("all")).applyInArrow(
            lambda group: fit(group), "weights binary, bias array<double>, temperature double").first()
    weights = np.frombuffer(fitted["weights"], "<f4").reshape(BUCKETS, len(languages))
    return Model(languages, idf, weights, np.array(fitted["bias"]), fitted["temperature"])


def predictor(model: Model):
    """An Arrow function: text -> struct of lang_pred and score."""
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64())])
    shared = model  # at most BUCKETS x (languages + 1) floats travel with the task

    @F.arrow_udf("lang_pred string, score double")
    def predict(texts: pa.Array) -> pa.Array:
        found = [shared.predict(t) for t in texts.to_pylist()]
        return pa.array([{"lang_pred": a, "score": b} for a, b in found], kind)

    return predict


def training_rows(docs: DataFrame) -> DataFrame:
    """Documents that may teach: crc32(doc_id as text) mod 3 is not 1."""
    return docs.where(crc32_bucket("doc_id", 3) != 1).select("doc_id", "text", "lang")


def identify(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score.

    Learns from the text and lang of :func:`training_rows`. A null text and a text
    without letters get ``und`` and 0. Repeated rows get equal predictions. A null id
    counts as '' for the fold. Without any labelled training row all is ``und``; an
    empty table gives no rows. Other columns are not read.
    """
    model = train(training_rows(docs), per_language)
    held_out: Column = crc32_bucket("doc_id", 3) == 1
    return docs.select("doc_id", held_out.alias("held_out"), predictor(model)("text").alias("p")) \
        .select("doc_id", "held_out", "p.lang_pred", "p.score")


def keep_identified(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose language is determined with
    at least ``min_score``. If no language could be learned (no training row has one),
    every row whose text has a letter."""
    model = train(training_rows(docs))
    names = docs.columns
    if not model.languages:
        @F.arrow_udf("boolean")
        def has_letter(texts: pa.Array) -> pa.Array:
            return pa.array([len(letter_points(t or "")) > 0 for t in texts.to_pylist()], pa.bool_())

        found = docs.select(F.struct("*").alias("__row"), has_letter("text").alias("__l"))
        return found.where("__l").select(*[F.col("__row")[n].alias(n) for n in names])
    found = docs.select(F.struct("*").alias("__row"), predictor(model)("text").alias("__p"))
    return found.where((F.col("__p.lang_pred") != UNDETERMINED) & (F.col("__p.score") >= min_score)) \
        .select(*[F.col("__row")[n].alias(n) for n in names])
