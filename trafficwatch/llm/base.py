"""Shared plumbing of the corpus operators: tables, scratch tables, Arrow chunks."""
from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficwatch.session import checkpoint_root

#: Text bytes that a task turns into NumPy arrays at once (a longer text is taken alone).
CHUNK_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder of the session."""
    return os.path.join(checkpoint_root(spark), "llm", f"{name}-{uuid.uuid4().hex[:12]}")


def persisted(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a Parquet table on shared storage and read back: lineage is
    cut, and the loss of an executor costs no recomputation. The folder belongs to
    the job and can be removed once its results are written."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]],
                schema: str, limit: int = CHUNK_BYTES, text: str = "text") -> DataFrame:
    """``mapInArrow`` over row slices that hold at most ``limit`` bytes of ``text``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, text, limit):
                yield from function(piece)

    return df.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, text: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of ``batch`` with at most ``limit`` bytes of ``text`` each;
    a single longer text is a slice of its own."""
    if not batch.num_rows:
        return
    sizes = pc.binary_length(batch.column(text)).fill_null(0).to_pylist()
    start, held = 0, 0
    for row, size in enumerate(sizes):
        if row > start and held + size > limit:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += size
    yield batch.slice(start)


def record(schema: pa.Schema, *columns) -> pa.RecordBatch:
    """A record batch of ``schema`` from sequences or arrays."""
    arrays = [c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type)
              for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def crc32_bucket(column: str, modulus: int) -> Column:
    """crc32 of an id written as text, modulo ``modulus``; a null id counts as ''."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % modulus


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def one_per_key(df: DataFrame, *keys: str) -> DataFrame:
    """One row of each key, without the key columns: the greatest in its orderable columns."""
    columns = [c for c in df.columns if c not in keys]
    quoted = [F.col(f"`{c}`") for c in columns]
    plain = [F.col(f"`{f.name}`") for f in df.schema.fields
             if f.name in columns and not any(kind in f.dataType.simpleString() for kind in ("map<", "variant"))]
    row = F.max_by(F.struct(*quoted), F.struct(*(plain or [F.lit(0)])))
    return df.groupBy(*keys).agg(row.alias("the_row")).select(*[F.col(f"the_row.`{c}`").alias(c) for c in columns])
