"""CSV records with line breaks in quotes, read by many tasks per file.

Whether a line break ends a record depends on the quotes before it: their number is even. Each
split counts its own quotes; the counts of the splits before it, one small row each, give
the parity at its start, and so every line knows whether it opens a record or continues
one, also across splits. A task puts the records of its splits together where it reads them; a grouping joins
only the pieces of records that pass the end of a split. A quote that is never closed makes one record of
the rest of its file, as any reader of this dialect does.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Where a record begins: file, offset of its split, place in it.
POSITION = ("_file", "_block", "_pos")


def file_lines(spark: SparkSession, path: str) -> DataFrame:
    """(_file, _block, value, odd): lines between line feeds; ``odd``: 1 if the line holds an odd
    number of quotes."""
    text = spark.read.option("lineSep", "\n").text(path)
    quotes = F.char_length("value") - F.char_length(F.replace("value", F.lit('"'), F.lit("")))
    return text.select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        "value", (quotes % 2).alias("odd"))


def quoted_breaks(spark: SparkSession, path: str) -> bool:
    """Does a line end inside quotes anywhere? One scan that stops at the first such line."""
    return not file_lines(spark, path).where("odd = 1").isEmpty()


_PIECES = pa.schema([("_file", pa.string()), ("_block", pa.int64()), ("_pos", pa.int64()), ("record", pa.string()),
                     ("opens", pa.bool_()), ("closes", pa.bool_())])


def _pieces() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function that gives the records of the lines (_file, _block, inside, value) of whole splits, each
    with ``opens`` and ``closes``: does it begin, does it end in its split? ``_pos`` is the number of its
    first line there. It is a local function, so workers need pyarrow and NumPy but not this package."""
    def joined(lines: pa.Array, bounds: np.ndarray) -> pa.Array:
        """The lines from each of ``bounds`` up to the next, with their line breaks."""
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), lines), "\n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, line, inside, begun, at = None, 0, 0, [], 0

        def made(records: pa.Array, places: np.ndarray, opens: bool, closes: bool) -> pa.RecordBatch:
            n = len(records)
            return pa.RecordBatch.from_arrays(
                [pa.repeat(pa.scalar(split[0], pa.string()), n), pa.repeat(pa.scalar(split[1], pa.int64()), n),
                 pa.array(places, pa.int64()), records, pa.repeat(opens, n), pa.repeat(closes, n)], schema=_PIECES)

        def piece(closes: bool) -> pa.RecordBatch:
            lines = pa.concat_arrays(begun)
            return made(joined(lines, np.array([0, len(lines)])), np.array([at]), at >= 0, closes)

        for batch in batches:
            file, block = batch.column(0), batch.column(1).to_numpy()
            changed = (block[1:] != block[:-1]) | pc.not_equal(file[1:], file[:-1]).to_numpy(zero_copy_only=False)
            bounds = np.concatenate([[0], 1 + np.flatnonzero(changed), [len(block)]])
            for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                if low == high:
                    continue
                here = (file[low].as_py(), int(block[low]))
                if here != split:
                    if begun:
                        yield piece(closes=False)
                    split, line, begun, at = here, 0, [], -1  # at -1: what an earlier split began
                    inside = batch.column(2)[low].as_py()
                lines = batch.column(3).slice(low, high - low)
                odd = pc.count_substring(lines, '"').to_numpy() % 2
                after = (inside + np.cumsum(odd)) % 2
                opening = np.flatnonzero(after == odd)  # not inside quotes before the line
                inside = int(after[-1])
                first = int(opening[0]) if len(opening) else len(lines)
                if first:  # the end of an open record, or more of it
                    begun.append(lines[:first])
                    if len(opening) or not inside:
                        yield piece(closes=True)
                        begun = []
                if inside and len(opening):
                    last = int(opening[-1])
                    begun, at = [lines[last:]], line + last
                    lines, opening = lines[first:last], opening[:-1]
                else:
                    lines = lines[first:]
                if len(opening):
                    yield made(joined(lines, np.append(opening - first, len(lines))), line + opening, True, True)
                line += high - low
        if begun:
            yield piece(closes=False)

    return run


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(_file, _block, _pos, record) of all files of ``path``, without each file's first record (the
    header) and without empty ones; the position is that of the record's first line."""
    lines = file_lines(spark, path)
    split, file = ["_file", "_block"], Window.partitionBy("_file")
    before = file.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    # One row per split: parity at its start.
    counted = lines.groupBy(*split).agg(F.sum("odd").alias("own"))
    at_start = counted.select(*split, F.pmod(F.coalesce(F.sum("own").over(before), F.lit(0)), F.lit(2)).alias("inside"))
    pieces = lines.join(F.broadcast(at_start), split).select(*split, "inside", "value") \
        .mapInArrow(_pieces(), "_file string, _block long, _pos long, record string, opens boolean, closes boolean")

    whole = F.col("opens") & F.col("closes")
    head = (F.col("_block") == 0) & (F.col("_pos") == 0)
    alone = pieces.where(whole & ~head).select(*POSITION, "record")
    # At most two pieces of a split belong to records that pass its ends: to the last one opened.
    opening = F.when(F.col("opens"), F.struct("_block", "_pos"))
    here = file.orderBy("_block", "_pos").rowsBetween(Window.unboundedPreceding, 0)
    owned = pieces.where(~whole).withColumn("record_at", F.last(opening, ignorenulls=True).over(here))
    joined = owned.groupBy("_file", "record_at").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_block", "_pos", "record"))), lambda p: p["record"]), "\n")
        .alias("record"), F.max(head).alias("head")).where(~F.col("head")) \
        .select("_file", F.col("record_at._block").alias("_block"), F.col("record_at._pos").alias("_pos"), "record")
    ended = F.regexp_replace("record", "\r$", "")
    return alone.unionByName(joined).select(*POSITION, ended.alias("record")).where("record <> ''")


def parsed(records: DataFrame, columns: list[str]) -> DataFrame:
    """The fields of :func:`csv_records` as text columns, and the position."""
    def quoted(name: str) -> str:
        return "`" + name.replace("`", "``") + "`"

    schema = ", ".join(f"{quoted(c)} string" for c in columns)
    fields = F.from_csv("record", schema, {"quote": '"', "escape": '"'})
    return records.select(fields.alias("_fields"), *POSITION).select("_fields.*", *POSITION)
