"""Toxicity by nearest labelled examples.

A text's features are the 5-letter grams that go with the toxic label (lift and
chi-squared over the labelled sample), weighted by TF-IDF, and one constant feature for
the rest of the text; vectors are scaled to length 1. Its nearest
examples are found exactly, by cosine, in a block-max inverted index; their votes, weighted
by distance, are calibrated to a probability, and the neighbours are the evidence.

Index: posting lists by feature; a list is cut where the examples' blocks (64 examples of
one label with like features) end, and each cut keeps its largest weight. A query sums
the query-weighted maxima to an upper bound per block, visits blocks from the highest
bound and stops when the bound falls below the k-th best cosine found: no block left
out can hold a nearer example.

Bounds: about ``per_class`` labelled documents of either class, chosen by a hash of the id, and
``features`` features make the model; a quarter of the sample only calibrates. Document
frequencies are counted over all documents.
"""
from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficwatch.llm.base import crc32_bucket, map_batches, persisted, record, slices
from trafficwatch.llm.chargrams import gram_buckets, letter_points

GRAM = 5
BUCKETS = 1 << 22
PER_CLASS = 4000
FEATURES = 8192
#: A feature goes with the label if it is so many times as frequent among toxic examples,
LIFT = 4
#: and its chi-squared at least this (one in a million by chance).
CHI_SQUARED = 24.0
NEIGHBOURS = 15
BLOCK = 64
THRESHOLD = 0.3
#: Weight of the one feature that stands for all the rest of a text: with it the cosine
#: also tells one toxic word from many.
REST = 8.0
#: Keeps the weight of an identical example finite.
NEAREST = 0.05


def text_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(feature, occurrences) of a whole text."""
    return np.unique(gram_buckets(letter_points(text), GRAM, BUCKETS), return_counts=True)


class BlockMaxIndex:
    """Exact cosine search over example vectors (rows of (features, weights))."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], features: int, block: int = BLOCK):
        self.size, self.blocks = len(vectors), -(-len(vectors) // block)
        example = np.repeat(np.arange(len(vectors)), [len(at) for at, _ in vectors]).astype(np.int64)
        feature = np.concatenate([at for at, _ in vectors] or [np.zeros(0, np.int64)]).astype(np.int64)
        weight = np.concatenate([x for _, x in vectors] or [np.zeros(0)])
        order = np.lexsort((example, feature))
        self.example, feature, self.weight = example[order], feature[order], weight[order]
        place = self.example // block
        cut = np.ones(len(feature), bool)
        cut[1:] = (feature[1:] != feature[:-1]) | (place[1:] != place[:-1])
        first = np.flatnonzero(cut)
        self.cut_start = np.append(first, len(feature))
        self.cut_block = place[first]
        self.cut_max = np.maximum.reduceat(self.weight, first) if len(first) else np.zeros(0)
        self.list_start = np.searchsorted(feature[first], np.arange(features + 1))

    def nearest(self, at: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(examples, cosines) of the k nearest with a positive cosine, nearest first;
        of equal ones those with smaller numbers."""
        counts = self.list_start[at + 1] - self.list_start[at]
        cuts = _ranges(self.list_start[at], counts)
        value = np.repeat(x, counts)
        bound = np.bincount(self.cut_block[cuts], value * self.cut_max[cuts], minlength=self.blocks)
        by_bound = np.argsort(-bound, kind="stable")
        by_bound = by_bound[:np.count_nonzero(bound)]
        best = np.zeros(0, np.int64), np.zeros(0)
        done, step = 0, 4
        while done < len(by_bound):
            limit = best[1][k - 1] if len(best[1]) >= k else 0.0
            visit = by_bound[done:done + step]
            visit = visit[bound[visit] >= limit - 1e-12]  # rounding must not hide a tie
            if not len(visit):
                break
            wanted = np.zeros(self.blocks, bool)
            wanted[visit] = True
            mine = np.flatnonzero(wanted[self.cut_block[cuts]])
            size = self.cut_start[cuts[mine] + 1] - self.cut_start[cuts[mine]]
            postings = _ranges(self.cut_start[cuts[mine]], size)
            score = np.bincount(self.example[postings], np.repeat(value[mine], size) * self.weight[postings],
                                minlength=self.size)
            found = np.flatnonzero(score)
            examples = np.concatenate([best[0], found])
            scores = np.concatenate([best[1], score[found]])
            top = np.lexsort((examples, -np.round(scores, 9)))[:k]
            best = examples[top], scores[top]
            done, step = done + step, step * 2
        return best


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range, one after another."""
    total = np.cumsum(counts)
    return np.arange(total[-1] if len(total) else 0) + np.repeat(starts - (total - counts), counts)


@dataclass
class Model:
    features: np.ndarray  # sorted feature numbers
    idf: np.ndarray
    index: BlockMaxIndex | None = None
    ids: np.ndarray | None = None  # doc_id of each example
    toxic: np.ndarray | None = None
    knots: np.ndarray | None = None  # raw votes and the probabilities they stand for
    rates: np.ndarray | None = None
    no_feature: float = 0.0  # probability of a text without any neighbour

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        found, counts = text_features(text or "")
        at = np.searchsorted(self.features, found)
        known = at < len(self.features)
        known[known] = self.features[at[known]] == found[known]
        at = at[known]
        if not len(at):
            return at, np.zeros(0)
        weight = np.append((1 + np.log(counts[known])) * self.idf[at], REST)
        at = np.append(at, len(self.features))
        norm = np.sqrt(weight @ weight)
        return at, weight / norm

    def vote(self, at: np.ndarray, x: np.ndarray) -> tuple[float | None, np.ndarray, np.ndarray]:
        """(distance-weighted share of toxic neighbours, neighbours, cosines)."""
        if self.index is None or not len(at):
            return None, np.zeros(0, np.int64), np.zeros(0)
        near, cosine = self.index.nearest(at, x, NEIGHBOURS)
        if not len(near):
            return None, near, cosine
        weight = 1 / (NEAREST + 1 - np.minimum(cosine, 1))
        return float(weight @ self.toxic[near] / weight.sum()), near, cosine

    def probability(self, vote: float | None) -> float:
        return self.no_feature if vote is None else float(np.interp(vote, self.knots, self.rates))


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-decreasing steps of least squares (pool adjacent violators), as knots."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []  # mean, weight, first x, last x
    for value, target, w in zip(x[order].tolist(), y[order].tolist(), weight[order].tolist(), strict=True):
        pools.append([target, w, value, value])
        while len(pools) > 1 and (pools[-2][0] >= pools[-1][0] or pools[-2][3] == pools[-1][2]):
            mean, w2, _, last = pools.pop()
            total = pools[-1][1] + w2
            pools[-1][0] = (pools[-1][0] * pools[-1][1] + mean * w2) / total
            pools[-1][1], pools[-1][3] = total, last
    knots = np.array([p[i] for p in pools for i in (2, 3)])
    return knots, np.repeat([p[0] for p in pools], 2)


def fit(model: Model, rows: list[tuple[int, int, int, np.ndarray, np.ndarray]], weights: dict[int, float]) -> Model:
    """Index and calibration of (turn, doc_id, toxic, features, weights) rows; ``weights``:
    documents that a sampled row of either class stands for."""
    held = [r for r in rows if r[0] % 4 == 3]
    # Like examples share a block: by label, then by their weightiest features.
    kept = sorted((r for r in rows if r[0] % 4 != 3 and len(r[3])),
                  key=lambda r: (r[2], *r[3][np.argsort(-r[4], kind="stable")[:2]].tolist(), r[0], r[1]))
    model.index = BlockMaxIndex([(r[3], r[4]) for r in kept], len(model.features) + 1)
    model.ids = np.array([r[1] for r in kept], np.int64)
    model.toxic = np.array([r[2] for r in kept], float)
    votes = [(model.vote(r[3], r[4])[0], r[2]) for r in held or rows]
    known = [(v, t) for v, t in votes if v is not None]
    without = [t for v, t in votes if v is None]
    total = sum(weights[t] for t in without)
    model.no_feature = sum(weights[t] * t for t in without) / total if total else 0.0
    if known:
        model.knots, model.rates = isotonic(np.array([v for v, _ in known]), np.array([t for _, t in known], float),
                                            np.array([weights[t] for _, t in known]))
    else:
        model.knots, model.rates = np.array([0.0]), np.array([model.no_feature])
    return model


def document_frequencies(texts: DataFrame, features: np.ndarray) -> tuple[np.ndarray, int]:
    """(documents that hold each feature, documents) over all rows."""
    schema = pa.schema([("at", pa.int32()), ("documents", pa.int64())])
    size = len(features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 1, np.int64)
        wanted = np.full(BUCKETS, -1, np.int32)
        wanted[features] = np.arange(size)
        for batch in batches:
            for piece in slices(batch, "text", 1 << 20):
                for text in piece.column(0).to_pylist():
                    found = wanted[gram_buckets(letter_points(text or ""), GRAM, BUCKETS)]
                    total[np.unique(found[found >= 0])] += 1
                    total[size] += 1
        at = np.flatnonzero(total)
        yield record(schema, at, total[at])

    result = np.zeros(size + 1, np.int64)
    for row in texts.select("text").mapInArrow(run, "at int, documents long") \
            .groupBy("at").agg(F.sum("documents").alias("documents")).collect():  # at most `features` + 1 rows
        result[row["at"]] = row["documents"]
    return result[:size], int(result[size])


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, features: int = FEATURES) -> Model:
    """A model from the ``doc_id, toxic`` rows of ``labels`` whose crc32 mod 4 is not 2."""
    known = labels.where((crc32_bucket("doc_id", 4) != 2) & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()) \
        .groupBy(F.col("doc_id").alias("of")).agg(F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}  # two rows
    empty = Model(np.zeros(0, np.int64), np.zeros(0), None, no_feature=counts.get(1, 0) / max(1, sum(counts.values())))
    if not (counts.get(0) and counts.get(1)):
        return empty
    scale = 1 << 30
    shares = {t: min(1.0, per_class / n) for t, n in counts.items()}
    chosen = known.withColumn("turn", F.pmod(F.xxhash64("of", F.lit("toxicity")), F.lit(scale))).where(
        F.col("turn") < F.when(F.col("toxic") == 1, int(shares[1] * scale)).otherwise(int(shares[0] * scale)))
    # About 2 * per_class rows of three numbers: bounded, so it is broadcast.
    # It is written once and read three times.
    sample = persisted(docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("of"))
                       .select("turn", "doc_id", "toxic", "text"), "toxicity-sample")
    present = pa.schema([("feature", pa.int32()), ("toxic", pa.int32())])

    def list_features(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for toxic, text in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            found = text_features(text or "")[0]
            yield record(present, found, np.full(len(found), toxic))

    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if not (sizes.get(0) and sizes.get(1)):
        return empty
    ones, total = F.lit(sizes[1]), F.lit(sum(sizes.values()))
    tally = map_batches(sample, list_features, "feature int, toxic int").groupBy("feature").agg(
        F.sum("toxic").alias("a"), F.count(F.lit(1)).alias("n"))
    excess = total * F.col("a") - F.col("n") * ones
    tally = tally.withColumn("chi", total * excess * excess
                             / (F.col("n").cast("double") * (total - F.col("n")) * ones * (total - ones)))
    lifted = F.col("a") * (total - ones) >= LIFT * (F.col("n") - F.col("a")) * ones
    best = tally.where((F.col("chi") >= CHI_SQUARED) & lifted).orderBy(F.desc("chi"), "feature").limit(features)
    selected = np.sort(np.array([r["feature"] for r in best.select("feature").collect()], np.int64))
    if not len(selected):
        return empty
    frequency, documents = document_frequencies(docs, selected)
    model = Model(selected, np.log((1 + documents) / (1 + frequency)) + 1)
    vectors = pa.schema([("turn", pa.int64()), ("doc_id", pa.int64()), ("toxic", pa.int32()),
                         ("at", pa.binary()), ("x", pa.binary())])

    def weigh(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = [model.vector(t) for t in batch.column(3).to_pylist()]
        yield record(vectors, *batch.columns[:3], [a.astype("<i4").tobytes() for a, _ in found],
                     [x.tobytes() for _, x in found])

    weights = {t: 1 / shares[t] for t in (0, 1)}

    def build(group: pa.Table) -> pa.Table:
        rows = sorted(zip(*(group.column(c).to_pylist() for c in vectors.names), strict=True))
        fitted = fit(model, [(turn, doc, toxic, np.frombuffer(at, "<i4").astype(np.int64), np.frombuffer(x))
                             for turn, doc, toxic, at, x in rows], weights)
        return pa.table({"model": [pickle.dumps(fitted)]}, schema=pa.schema([("model", pa.binary())]))

    # The bounded sample meets in one task.
    blob = map_batches(sample, weigh, "turn long, doc_id long, toxic int, at binary, x binary") \
        .groupBy(F.lit(0).alias("all")).applyInArrow(lambda group: build(group), "model binary").first()
    return pickle.loads(blob["model"])


def scorer(model: Model):
    """An Arrow function: text -> struct of score, predicted and evidence (the nearest
    examples with their label and cosine)."""
    kind = pa.struct([("score", pa.float64()), ("predicted", pa.int32()), ("evidence", pa.list_(pa.struct(
        [("doc_id", pa.int64()), ("toxic", pa.int32()), ("cosine", pa.float64())])))])
    # The bounded model reaches each executor once.
    from pyspark.sql import SparkSession

    shared = SparkSession.getActiveSession().sparkContext.broadcast(model)

    @F.arrow_udf("score double, predicted int, evidence array<struct<doc_id:bigint,toxic:int,cosine:double>>")
    def score(texts: pa.Array) -> pa.Array:
        known, rows = shared.value, []
        for text in texts.to_pylist():
            vote, near, cosine = known.vote(*known.vector(text))
            value = min(1.0, max(0.0, known.probability(vote)))
            rows.append({"score": value, "predicted": int(value >= THRESHOLD), "evidence": [
                {"doc_id": int(known.ids[n]), "toxic": int(known.toxic[n]), "cosine": float(c)}
                for n, c in zip(near[:3], cosine[:3], strict=True)]})
        return pa.array(rows, kind)

    return score


def score_documents(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted, evidence.

    A null or empty text, or one without any feature, gets the rate of toxic documents
    among calibration texts without a neighbour. Labels without id or value teach
    nothing; of repeated labels the toxic one counts; an id that several documents
    repeat teaches with each of them. If a class has no label all texts get the rate of
    the other, if it has no labelled document the share of toxic labels. An empty table gives no rows. Other columns are not read.
    """
    model = train(docs, labels, per_class)
    return docs.select("doc_id", (crc32_bucket("doc_id", 4) == 2).alias("held_out"),
                       scorer(model)("text").alias("s")).select("doc_id", "held_out", "s.*")


def keep_civil(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, that are not predicted toxic."""
    model = train(docs, labels)
    names = docs.columns
    found = docs.select(F.struct("*").alias("__row"), scorer(model)("text").alias("__s"))
    return found.where(F.col("__s.predicted") == 0).select(*[F.col("__row")[n].alias(n) for n in names])
