"""Exact dedup by skew-safe combining, in DataFrame operations only.

Equal texts are found in three combining stages, each of which groups by the whole
text, so content is compared in full at every stage and never by its digest alone:

1. *local*: Spark's partial aggregation folds the equal texts of one scan task;
2. *salted*: what is left is merged per (digest, salt, text). The salt is the scan
   task's number, so a text that fills a third of the table reaches each of the
   ``salts`` reducers as one row per task, never as its copies;
3. *global*: at most ``salts`` winners per text meet in one row per text.

Members find their group by digest. A digest whose texts were all found equal in
stage 3 has one group; digests that two different texts share (none is known) are
looked up by digest and whole text instead, so a collision never merges texts.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficwatch.llm.base import fresh_name, one_per_key, persisted, text_or_empty

SALTS = 16


def text_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                salts: int = SALTS) -> DataFrame:
    """One row per distinct text: digest, text, keep_id (largest id), group_size."""
    rows = docs.select(F.col(doc_id).alias("id"), text_or_empty(text).alias("text"))
    rows = rows.withColumn("digest", F.sha2("text", 256)) \
               .withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    salted = rows.groupBy("digest", "salt", "text").agg(
        F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return salted.groupBy("digest", "text").agg(
        F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))


def dedup_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 salts: int = SALTS) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    A null text counts as empty; texts are equal when identical. Of equal texts the
    row with the largest id stays. A null id loses against any other; if all ids of a
    group are null, keep_id is null and its rows are kept. Rows that repeat both id
    and text each count in group_size and share the verdict of that id. An empty
    table gives an empty report; further columns are not looked at.
    """
    # One small row per digest; `texts` counts the different texts that share it.
    by_digest = persisted(text_groups(docs, doc_id, text, salts).groupBy("digest").agg(
        F.count(F.lit(1)).alias("texts"), F.max("keep_id").alias("keep_id"),
        F.sum("group_size").alias("group_size")), "exact-dedup")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                       text_or_empty(text).alias("text"))
    members = rows.select("doc_id", F.sha2("text", 256).alias("digest"))
    single = members.join(by_digest.where("texts = 1"), "digest").select(
        "digest", "doc_id", "keep_id", "group_size")
    if not by_digest.where("texts > 1").isEmpty():
        shared = (rows.withColumn("digest", F.sha2("text", 256))
                  .join(by_digest.where("texts > 1").select("digest"), "digest", "left_semi"))
        groups = text_groups(shared, "doc_id", "text", salts)
        single = single.unionByName(shared.join(groups, ["digest", "text"])
                                    .select("digest", "doc_id", "keep_id", "group_size"))
    return single.select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"))


def keep_largest(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Exactly one row of ``docs`` per text, with all its columns: the one with the largest id; of
    rows that share it, or have none, the greatest in the other columns."""
    own_id, digest, copies = (fresh_name(docs, n) for n in ("kept_id", "kept_sha", "copies"))
    # One small row per text that stays, with the number of rows that its id and text stand for.
    kept = persisted(dedup_report(docs, doc_id, text).where("kept").groupBy(
        F.col("doc_id").alias(own_id), F.col("text_sha256").alias(digest)).agg(F.count(F.lit(1)).alias(copies)), "kept-texts")

    def rows(of: DataFrame, how: str) -> DataFrame:
        return docs.join(of, F.col(f"`{doc_id}`").cast("long").eqNullSafe(F.col(own_id))
                         & (F.sha2(text_or_empty(f"`{text}`"), 256) == F.col(digest)), how)

    single = rows(kept.where(F.col(copies) == 1), "left_semi")
    repeated = kept.where(F.col(copies) > 1).drop(copies)
    if repeated.isEmpty():
        return single
    return single.unionByName(one_per_key(rows(repeated, "inner"), own_id, digest))
