"""CSV records over line breaks in quotes: many splits, same rows as Python's reader."""
import csv
import io
import random

import pytest

from trafficwatch.sources import csvlines
from trafficwatch.sources.telemetry import load_events, read_csv_text

HEADER = ["id", "no`te", "x y"]


def made(rng, rows, ends):
    pieces = ["", "a", 'q"uote', "line\nbreak", "two\n\nbreaks,\n", "comma, here", '"', '""\n""', "é😀\n", " padded "]
    data = [[str(i), "".join(rng.choice(pieces) for _ in range(rng.randint(1, 4))), rng.choice(pieces) + "z"] for i in range(rows)]
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=ends)
    writer.writerow(HEADER)
    writer.writerows(data)
    return data, out.getvalue()


def read(spark, path, split_bytes):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    try:
        df = read_csv_text(spark, path)
        return df, [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("ends", ["\n", "\r\n"])
@pytest.mark.parametrize("split_bytes", [37, 400, 1 << 20])
def test_records_over_many_splits(spark, tmp_path, split_bytes, ends):
    rng = random.Random(split_bytes)
    expected = []
    for name in ("a.csv", "b.csv"):
        data, text = made(rng, 60, ends)
        (tmp_path / name).write_bytes(text.encode())
        expected += [(name, *row) for row in data]
    df, rows = read(spark, str(tmp_path), split_bytes)
    assert df.columns == [*HEADER, *csvlines.POSITION]
    rows.sort(key=lambda r: r[3:])  # file order, as "first per id" sees it
    found = [(r[3].rsplit("/", 1)[1], *(v or "" for v in r[:3])) for r in rows]
    assert found == expected
    if split_bytes == 37:
        assert len({r[3:5] for r in rows}) > 20  # one file over many splits


def test_plain_files_need_no_joining(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,note\n1,"a, b"\n2,c\n\n')
    assert not csvlines.quoted_breaks(spark, str(tmp_path))
    assert [tuple(r)[:2] for r in read_csv_text(spark, str(tmp_path)).collect()] == [("1", "a, b"), ("2", "c")]
    records = csvlines.csv_records(spark, str(tmp_path))
    assert sorted(tuple(r)[3] for r in records.collect()) == ['1,"a, b"', "2,c"]


def test_first_of_each_id_and_a_header_of_two_lines(spark, tmp_path):
    rows = ["event_id,camera_id,plate_number,\"vehicle\ntype\",latitude,longitude,speed_kph,event_time"]
    for i in range(40):
        rows.append(f'e{i % 10},c,p{i},"two\nlines {i}",14.5,121.0,{i},2026-09-01T07:00:00+08:00')
    (tmp_path / "t.csv").write_text("\n".join(rows) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "101")
    try:
        found = load_events(spark, str(tmp_path / "t.csv")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((r.event_id, r.plate_number, r.speed_kph) for r in found) == [(f"e{i}", f"P{i}", float(i)) for i in range(10)]


def test_an_open_quote_takes_the_rest_of_its_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,note\n1,x\n2,"open\n3,y\n4,z\n')
    (tmp_path / "b.csv").write_text("id,note\n5,v\n")
    rows = sorted(tuple(r)[3] for r in csvlines.csv_records(spark, str(tmp_path)).collect())
    assert rows == ["1,x", '2,"open\n3,y\n4,z', "5,v"]


@pytest.mark.parametrize("split_bytes", [90, 1 << 20])
def test_records_pass_the_ends_of_arrow_batches(spark, tmp_path, split_bytes):
    data, text = made(random.Random(5), 80, "\n")
    for name in ("a.csv", "b.csv"):
        (tmp_path / name).write_bytes(text.encode())
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "2")
    try:
        rows = read(spark, str(tmp_path), split_bytes)[1]
    finally:
        spark.conf.set(name, before)
    rows.sort(key=lambda r: r[3:])
    assert [tuple(v or "" for v in r[:3]) for r in rows] == [tuple(row) for row in data] * 2


def test_records_within_a_split_are_not_shuffled(spark, tmp_path):
    """Only counts and the pieces of records that pass the end of a split are."""
    (tmp_path / "a.csv").write_text("id,note\n" + '1,"two\nlines"\n' * 2000)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        records = csvlines.csv_records(spark, str(tmp_path))
        assert records.count() == 2000
        plan = records._jdf.queryExecution().executedPlan()
        moved = []

        def walk(node):
            if node.nodeName() in ("Exchange", "BroadcastExchange"):
                moved.append(node.metrics().apply("numOutputRows" if node.nodeName() == "BroadcastExchange"
                                                  else "shuffleRecordsWritten").value())
            for k in range(node.children().size()):
                walk(node.children().apply(k))

        records.collect()
        walk(plan)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert moved and max(moved) < 100


def test_the_export_is_written_by_the_tasks_that_read_the_table(spark, tmp_path):
    from pathlib import Path

    from trafficwatch.catalog import QUERIES
    from trafficwatch.session import checkpoint_root

    for k in range(3):
        spark.sql(f"""SELECT {k} * 100 + id event_id, id % 5 user_id, 'view' event_type, '{{"k": 3}}' props, 50D + id value,
                  timestamp_ntz'2024-01-03 00:00:00' + make_dt_interval(0, 0, 0, id) ts FROM range(0, 100, 1, 1)""") \
            .write.mode("append").parquet(str(tmp_path / "events.parquet"))
    root = Path(checkpoint_root(spark)) / "csv-queries"
    known = set(root.glob("*")) if root.exists() else set()
    before = {n: spark.conf.get(n) for n in ("spark.sql.files.openCostInBytes", "spark.sql.files.maxPartitionBytes")}
    for n, value in zip(before, ("1", "2000"), strict=True):
        spark.conf.set(n, value)
    try:
        rows = QUERIES["csv_quoted_breaks"](spark, str(tmp_path)).collect()
    finally:
        for n, value in before.items():
            spark.conf.set(n, value)
    assert len(rows) == 300
    (export,) = set(root.glob("*")) - known
    assert len(list(export.glob("*.csv"))) > 1
