"""Merkle manifest of a data set, with octopus multiproofs.

Every row is a *leaf*: the hash of its fields, each as ``-`` (null) or as byte count, ``:`` and
value. Rows of one source, by ascending id, form a tree of arity 3: level by level, every three
consecutive nodes (the last run may have fewer) become the hash of their digests, until one
node is left, the *subroot*. The subroots, by source, form another such tree, whose last
node is the *root*. A hash is a SHA-256 over the concatenation of its inputs; digests enter
it, and leave this module, as lowercase hex.

Positions come from a range partitioning: each task numbers its own rows and one small row
per (task, group) gives the offsets, so a source of any size is spread over all tasks. Trees
are built in aligned blocks of 3^7 nodes, seven levels a round.

Proofs: a *leaf partition* is one block of leaves that are asked for. It names the
minimal union of node coordinates (level, index) that its proofs need and its own leaves do
not give, fetches each of them once by one join, derives the shared inner nodes,
and writes out the single proofs locally (:func:`missing_nodes`, :func:`expand_proofs`).
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trafficwatch.llm.base import crc32_bucket, persisted, record

ARITY = 3
#: Levels that a task builds at once, over ARITY ** LEVELS nodes.
LEVELS = 7
#: The fields of a leaf.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Trees: the rows of a source, and the sources.
ROWS, SOURCES = 0, 1


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_hash(columns: Iterable[Column]) -> Column:
    """Hash of a row's fields."""
    texts = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def height(n: int) -> int:
    """Levels above the leaves of a tree with ``n`` leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


def missing_nodes(wanted: np.ndarray, n: int) -> list[tuple[int, int]]:
    """The fewest coordinates (level, index) that, with the leaves ``wanted`` (indexes, some
    order) of a tree of ``n`` leaves, give the proofs of all of these leaves."""
    known, found, level = np.unique(wanted), [], 0
    while n > 1:
        runs = np.unique(known // ARITY)
        members = (runs[:, None] * ARITY + np.arange(ARITY)).ravel()
        members = members[members < n]
        found += [(level, i) for i in np.setdiff1d(members, known, assume_unique=True).tolist()]
        known, n, level = runs, -(-n // ARITY), level + 1
    return found


def expand_proofs(leaves: dict[int, str], fetched: dict[tuple[int, int], str], n: int) -> dict[int, list[list[str]]]:
    """For each of ``leaves`` (index -> digest) its siblings, level by level, as (those before
    it, those after it) of every level, from these leaves and the :func:`missing_nodes`."""
    nodes = {(0, i): d for i, d in leaves.items()} | fetched
    known, size, level = sorted(leaves), n, 0
    while size > 1:  # the shared inner nodes, each derived once
        runs = dict.fromkeys(i // ARITY for i in known)
        for run in runs:
            members = range(run * ARITY, min(size, run * ARITY + ARITY))
            nodes[level + 1, run] = digest(*(nodes[level, m] for m in members))
        known, size, level = list(runs), -(-size // ARITY), level + 1
    proofs = {}
    for leaf in leaves:
        at, size, steps = leaf, n, []
        for level in range(height(n)):
            low, high = at // ARITY * ARITY, min(size, at // ARITY * ARITY + ARITY)
            steps.append([[nodes[level, m] for m in range(low, at)], [nodes[level, m] for m in range(at + 1, high)]])
            at, size = at // ARITY, -(-size // ARITY)
        proofs[leaf] = steps
    return proofs


def fold(leaf: str, proof: Sequence[Sequence[Sequence[str]]]) -> str:
    """The root that a leaf digest and its proof lead to."""
    for before, after in proof:
        leaf = digest(*before, leaf, *after)
    return leaf


def positions(rows: DataFrame, group: str | None, order: Sequence[str], name: str) -> DataFrame:
    """``rows`` (written to shared storage) with ``index`` and ``n``: place in the order of its
    group, from 0, and the group's size. Nulls come first, and form a group of their own."""
    keys = [group] if group else []
    ranged = rows.repartitionByRange(*[F.asc_nulls_first(c) for c in (*keys, *order)]) \
        .sortWithinPartitions(*[F.asc_nulls_first(c) for c in (*keys, *order)]) \
        .withColumns({"part": F.spark_partition_id(), "row": F.monotonically_increasing_id()})
    placed = persisted(ranged, name)
    # A task's rows of one group are consecutive; one row for each such stretch.
    stretches = placed.groupBy(*keys, "part").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("own"))
    whole = Window.partitionBy(*keys)
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    stretches = stretches.select(
        *[F.col(k).alias("of_group") for k in keys], F.col("part").alias("of_part"), "first",
        F.coalesce(F.sum("own").over(earlier), F.lit(0)).alias("before"), F.sum("own").over(whole).alias("n"))
    same = F.col("part") == F.col("of_part")
    if group:
        same &= F.col(group).eqNullSafe(F.col("of_group"))
    return placed.join(stretches, same).select(
        *rows.columns, (F.col("row") - F.col("first") + F.col("before")).alias("index"), "n")


_NODES = "tree int, source_no long, level int, index long, digest string, is_root boolean"
_NODE = pa.schema([("tree", pa.int32()), ("source_no", pa.int64()), ("level", pa.int32()), ("index", pa.int64()),
                   ("digest", pa.string()), ("is_root", pa.bool_())])


def _raise(table: pa.Table, levels: int) -> pa.Table:
    """The nodes of up to ``levels`` levels above one block of consecutive nodes."""
    table = table.sort_by("index")
    level, index, n = (table.column(c)[0].as_py() for c in ("level", "index", "n"))
    tree, source = table.column("tree")[0].as_py(), table.column("source_no")[0].as_py()
    size, digests, rows = n, table.column("digest").to_pylist(), []
    for _ in range(level):
        size = -(-size // ARITY)
    for level in range(level + 1, level + levels + 1):
        if size == 1:
            break
        digests = [digest(*digests[i:i + ARITY]) for i in range(0, len(digests), ARITY)]
        index, size = index // ARITY, -(-size // ARITY)
        rows += [(tree, source, level, index + i, d, size == 1) for i, d in enumerate(digests)]
    return pa.Table.from_batches([record(_NODE, *(zip(*rows, strict=True) if rows else [()] * len(_NODE)))])


def build_nodes(leaves: DataFrame, tree: int, name: str, levels: int = LEVELS) -> DataFrame:
    """All nodes (tree, source_no, level, index, digest, is_root) of the trees over ``leaves``
    (source_no, index, n, digest): the leaves are level 0. A task builds ``levels`` at once."""
    def raised(table: pa.Table) -> pa.Table:
        return _raise(table, levels)

    lowest = leaves.select(F.lit(tree).alias("tree"), "source_no", F.lit(0).alias("level"), "index", "digest",
                           (F.col("n") == 1).alias("is_root"))
    sizes = leaves.select("source_no", "n").distinct()
    rounds = -(-height(leaves.agg(F.max("n")).first()[0] or 0) // levels)
    nodes, below = lowest, leaves.select(F.lit(tree).alias("tree"), "source_no", F.lit(0).alias("level"),
                                         "index", "n", "digest")
    for turn in range(1, rounds + 1):
        above = persisted(below.withColumn("block", F.expr(f"index div {ARITY ** levels}")).groupBy("source_no", "block")
                          .applyInArrow(raised, _NODES), f"{name}-{turn}")
        nodes = nodes.unionByName(above)
        below = above.where(f"level = {turn * levels} and not is_root").drop("is_root").join(sizes, "source_no")
    return nodes


class Manifest:
    """Leaves, nodes and roots of a table.

    ``rows``: the given columns and source_no, index, n (the tree of a source), sources
    (their number); ``nodes`` of all trees (those of the sources' tree have source_no 0);
    ``subroots``: source_no and subroot; ``root``: one row, or none of an empty table.
    """

    def __init__(self, leaves: DataFrame, source: str = "source", doc_id: str = "doc_id", leaf: str = "leaf",
                 levels: int = LEVELS):
        #: Leaves of a leaf partition.
        self.block = ARITY ** levels
        placed = positions(leaves, source, [doc_id, leaf], "merkle-leaves")
        named = positions(placed.select(F.col(source).alias("name")).distinct(), None, ["name"], "merkle-sources") \
            .select("name", F.col("index").alias("source_no"), F.col("n").alias("sources"))
        self.rows = persisted(placed.join(named, F.col(source).eqNullSafe(F.col("name"))).drop("name"), "merkle-rows")
        of_rows = build_nodes(self.rows.select("source_no", "index", "n", F.col(leaf).alias("digest")), ROWS, "merkle-rows", levels)
        self.subroots = of_rows.where("is_root").select("source_no", F.col("digest").alias("subroot"))
        tops = persisted(self.subroots.join(self.rows.select("source_no", "sources").distinct(), "source_no").select(
            F.lit(0).cast("long").alias("source_no"), F.col("source_no").alias("index"),
            F.col("sources").alias("n"), F.col("subroot").alias("digest")), "merkle-subroots")
        of_sources = build_nodes(tops, SOURCES, "merkle-sources", levels)
        self.root = of_sources.where("is_root").select(F.col("digest").alias("root"))
        self.nodes = of_rows.unionByName(of_sources)


_WANTED = pa.schema([("source_no", pa.int64()), ("block", pa.int64()), ("tree", pa.int32()), ("of", pa.int64()),
                     ("level", pa.int32()), ("index", pa.int64())])


def _needs(table: pa.Table) -> pa.Table:
    """Missing coordinates of one leaf partition, in the tree of its source and in the sources'."""
    source, block, n, sources = (table.column(c)[0].as_py() for c in ("source_no", "block", "n", "sources"))
    rows = [(source, block, ROWS, source, *at) for at in missing_nodes(table.column("index").to_numpy(), n)]
    rows += [(source, block, SOURCES, 0, *at) for at in missing_nodes(np.array([source]), sources)]
    return pa.Table.from_batches([record(_WANTED, *(zip(*rows, strict=True) if rows else [()] * len(_WANTED)))])


_PROOF_TYPE = "array<struct<before: array<string>, after: array<string>>>"
_STEP = pa.struct([("before", pa.list_(pa.string())), ("after", pa.list_(pa.string()))])


def prove(manifest: Manifest, asked: DataFrame, leaf: str = "leaf") -> DataFrame:
    """``asked`` (rows of ``manifest.rows``, all or some of them) with ``proof``: for each level
    from the leaf to the root the siblings before and after the path."""
    blocks = asked.withColumn("block", F.expr(f"index div {manifest.block}"))
    partition = ["source_no", "block"]
    wanted = blocks.select(*partition, "index", "n", "sources").groupBy(*partition).applyInArrow(
        _needs, "source_no long, block long, tree int, of long, level int, index long")
    nodes = manifest.nodes.select(*(F.col(c).alias(f"node_{c}") for c in ("tree", "source_no", "level", "index")), "digest")
    fetched = wanted.join(nodes, (F.col("tree") == F.col("node_tree")) & (F.col("of") == F.col("node_source_no"))
                          & (F.col("level") == F.col("node_level")) & (F.col("index") == F.col("node_index"))) \
        .select(*partition, "tree", "level", "index", "digest")
    out = blocks.drop("block").schema.add("proof", _proof_type())
    names = [f.name for f in out.fields[:-1]]

    def expand(own: pa.Table, given: pa.Table) -> pa.Table:
        if not own.num_rows:
            raise ValueError("nodes for a leaf partition without leaves")
        trees: list[dict[tuple[int, int], str]] = [{}, {}]
        for tree, level, index, value in zip(*(given.column(c).to_pylist() for c in ("tree", "level", "index", "digest")),
                                             strict=True):
            trees[tree][level, index] = value
        source, n, sources = (own.column(c)[0].as_py() for c in ("source_no", "n", "sources"))
        at = own.column("index").to_pylist()
        inner = expand_proofs(dict(zip(at, own.column(leaf).to_pylist(), strict=True)), trees[ROWS], n)
        # The sources' tree needs no digest of its own leaf for the siblings: '' stands for it.
        outer = expand_proofs({source: ""}, trees[SOURCES], sources)[source]
        proofs = [[{"before": b, "after": a} for b, a in (*inner[i], *outer)] for i in at]
        return own.select(names).append_column("proof", pa.array(proofs, pa.list_(_STEP)))

    return blocks.groupBy(*partition).cogroup(fetched.groupBy(*partition)).applyInArrow(expand, out)


def _proof_type():
    from pyspark.sql.types import ArrayType, StringType, StructField, StructType

    digests = ArrayType(StringType())
    return ArrayType(StructType([StructField("before", digests), StructField("after", digests)]))


_CHECKED = pa.schema([("doc_id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()),
                      ("proof_sha256", pa.string()), ("folded_root", pa.string()), ("verified", pa.bool_())])


def verify(proved: DataFrame, manifest: Manifest, now: str = "now") -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256 (over all siblings, leaf to root, left to right),
    folded_root (from the row's present leaf hash in column ``now`` and its proof), verified."""
    def check(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, leaf, present, proof, subroot, root in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                steps = [(step["before"], step["after"]) for step in proof]
                folded = fold(present, steps)
                siblings = digest(*(d for before, after in steps for d in (*before, *after)))
                rows.append((doc, leaf, subroot, root, siblings, folded, folded == root))
            if rows:
                yield record(_CHECKED, *zip(*rows, strict=True))

    rows = proved.join(manifest.subroots, "source_no").join(F.broadcast(manifest.root))  # one row
    return rows.select(F.col("doc_id").cast("long"), "leaf", now, "proof", "subroot", "root").mapInArrow(
        check, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
               "folded_root string, verified boolean")


def manifest_report(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """:func:`verify` of all rows of ``docs`` (doc_id, source, lang, n_chars, text) against their
    manifest, after the texts of rows whose unsigned crc32 of the id in decimal is even lost
    their line feeds.

    Rows with a null source form a source of their own, the first; a null id comes first in
    its source and counts as '' under the crc32; rows that repeat an id follow each other
    by leaf hash, equal rows are equal leaves. A lone row is its own subroot, a lone
    source's subroot is the root. An empty table gives no rows. Other columns are not read.
    """
    tampered = F.when(crc32_bucket("doc_id", 2) == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))
    columns = [F.col(c) for c in FIELDS]
    leaves = persisted(docs.select("doc_id", "source", leaf_hash(columns).alias("leaf"),
                                   leaf_hash([*columns[:-1], tampered]).alias("now")), "merkle-hashes")
    manifest = Manifest(leaves, levels=levels)
    return verify(prove(manifest, manifest.rows.drop("source")), manifest)
