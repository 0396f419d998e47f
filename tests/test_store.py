"""The violation store: commits, snapshots, tiers, expiry, partition layouts, pruning."""
import datetime as dt
import os
import time
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from trafficwatch import schemas
from trafficwatch.catalog import violations
from trafficwatch.plans import lookup
from trafficwatch.sources import commitlog, sinks
from trafficwatch.sources.sinks import compact_violations, read_compacted

DAY = dt.date(2024, 1, 1)


def test_compacted_store_prunes_and_answers_the_same(spark, tmp_dir):
    source = violations(spark, SF_SMALL)
    path = os.path.join(tmp_dir, "violations")
    compact_violations(source, path)
    assert any(d.startswith("violation_date=") for d in os.listdir(path))
    stored = read_compacted(spark, path)

    by_type = lookup.violations_by_type(stored, "speeding", DAY)
    plan = by_type._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(violation_date" in plan
    assert "violation_type" in plan.split("PartitionFilters:")[1].split("]")[0]

    def ids(df):
        return [r.violation_id for r in df.collect()]

    assert ids(by_type) == ids(lookup.violations_by_type(source, "speeding", DAY))
    by_plate = lookup.violations_by_plate(stored, "p 12")
    plate_plan = by_plate._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(plate_number,P 12)" in plate_plan  # reaches the scan: row groups skipped
    assert "TakeOrderedAndProject" in plate_plan
    assert ids(lookup.violations_by_plate(stored, "p 12")) == ids(lookup.violations_by_plate(source, "p 12"))
    assert stored.count() == source.count()


RED = "red_light_violations"


def rows_of(spark, ids, plate="P", status="NEW", kind="BEATING_RED_LIGHT", day="2024-01-01", speed=40.0):
    """Violations with the given ids; the plate is the id's hash class under ``plate``."""
    at = dt.datetime.fromisoformat(day + "T04:00:00+00:00")
    made = spark.createDataFrame([(i,) for i in ids], "i long").select(
        F.concat(F.lit("v"), "i").alias("violation_id"), F.lit(kind).alias("violation_type"),
        F.concat(F.lit(plate + " "), F.col("i") % 50).alias("plate_number"), F.lit("c").alias("camera_id"),
        F.lit(at).alias("violation_time"), F.lit(day).cast("date").alias("violation_date"), F.lit(at).alias("window_start"),
        F.lit(at).alias("window_end"), F.lit(speed).alias("recorded_speed_kph"), F.lit(status).alias("ticket_status"))
    return made.select(*[(F.col(f.name) if f.name in made.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                         for f in schemas.VIOLATION])


def held(df):
    return sorted((r.violation_id, r.ticket_status) for r in df.collect())


def files_read(df):
    """Files that the scans of a query opened."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    found, todo = 0, [plan]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif kind == "FileSourceScanExec":
            found += node.metrics().get("numFiles").get().value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def test_a_file_with_an_old_time_is_read_when_it_is_committed_late(spark, tmp_dir):
    sinks.write_batch(rows_of(spark, [1]), tmp_dir, RED, "a", 0)
    assert sinks.compact_store(spark, tmp_dir) == 1
    sinks.write_batch(rows_of(spark, [2]), tmp_dir, RED, "b", 0)
    for folder, _, names in os.walk(os.path.join(tmp_dir, RED, "run=b")):
        for name in names:
            os.utime(os.path.join(folder, name), (1, 1))
    assert held(sinks.read_violations(spark, tmp_dir)) == [("v1", "NEW"), ("v2", "NEW")]
    assert sinks.compact_store(spark, tmp_dir) == 2
    assert held(sinks.read_violations(spark, tmp_dir)) == [("v1", "NEW"), ("v2", "NEW")]


def test_uncommitted_and_replayed_batches(spark, tmp_dir):
    assert sinks.write_batch(rows_of(spark, [1]), tmp_dir, RED, "a", 0)
    assert not sinks.write_batch(rows_of(spark, [1, 9]), tmp_dir, RED, "a", 0)  # a replay
    # What a writer left before its commit is not read, and replaced by the next attempt.
    rows_of(spark, [5]).write.parquet(os.path.join(tmp_dir, RED, "run=a", "batch_id=1"))
    assert held(sinks.read_violations(spark, tmp_dir)) == [("v1", "NEW")]
    sinks.compact_store(spark, tmp_dir, grace_seconds=0)
    assert not sinks.write_batch(rows_of(spark, [1, 9]), tmp_dir, RED, "a", 0)  # known though merged and expired
    assert sinks.write_batch(rows_of(spark, [6]), tmp_dir, RED, "a", 1)
    assert held(sinks.read_violations(spark, tmp_dir)) == [("v1", "NEW"), ("v6", "NEW")]


def test_a_store_without_a_log_is_refused(spark, tmp_dir):
    rows_of(spark, [5]).write.parquet(os.path.join(tmp_dir, RED, "run=a", "batch_id=0"))
    with pytest.raises(FileNotFoundError):
        sinks.read_violations(spark, tmp_dir)


def test_readers_keep_one_version_while_a_compaction_runs(spark, tmp_dir):
    for batch in range(3):
        sinks.write_batch(rows_of(spark, range(batch, batch + 4), status=f"S{batch}", speed=40.0 + batch), tmp_dir, RED, "a", batch)
    before = commitlog.snapshot(spark, tmp_dir)
    reader = sinks.read_violations(spark, tmp_dir)  # planned, not yet run
    expected = held(sinks.read_violations(spark, tmp_dir, at=before))
    sinks.compact_store(spark, tmp_dir)
    sinks.write_batch(rows_of(spark, range(6), status="LATER", speed=99.0), tmp_dir, RED, "a", 3)
    assert held(reader) == held(sinks.read_violations(spark, tmp_dir, at=before)) == expected
    assert expected == [("v0", "S0"), ("v1", "S1"), ("v2", "S2"), ("v3", "S2"), ("v4", "S2"), ("v5", "S2")]
    assert held(sinks.read_violations(spark, tmp_dir)) == [(f"v{i}", "LATER") for i in range(6)]


def test_an_interrupted_merge_is_not_read(spark, tmp_dir, monkeypatch):
    sinks.write_batch(rows_of(spark, [1, 2]), tmp_dir, RED, "a", 0)
    real = commitlog.commit

    def dies(spark, root, op, **more):
        if op == "merge":
            raise RuntimeError("driver lost")
        return real(spark, root, op, **more)

    monkeypatch.setattr(commitlog, "commit", dies)
    with pytest.raises(RuntimeError):
        sinks.compact_store(spark, tmp_dir)
    monkeypatch.undo()
    assert held(sinks.read_violations(spark, tmp_dir)) == [("v1", "NEW"), ("v2", "NEW")]
    assert sinks.compact_store(spark, tmp_dir) == 1


def test_concurrent_writers_and_merges_lose_nothing(spark, tmp_dir):
    def write(job):
        for batch in range(4):
            sinks.write_batch(rows_of(spark, [100 * job + batch]), tmp_dir, RED, f"job{job}", batch)

    with ThreadPoolExecutor(5) as pool:
        work = [pool.submit(write, job) for job in range(3)]
        work += [pool.submit(lambda: [sinks.compact_store(spark, tmp_dir, fanout=2) for _ in range(2)]) for _ in range(2)
                 if not time.sleep(1)]
        for w in work:
            w.result()
    expected = sorted((f"v{100 * job + batch}", "NEW") for job in range(3) for batch in range(4))
    assert held(sinks.read_violations(spark, tmp_dir)) == expected
    sinks.compact_store(spark, tmp_dir, fanout=2, grace_seconds=0)
    assert held(sinks.read_violations(spark, tmp_dir)) == expected


def test_tiers_bound_what_is_rewritten_and_listed(spark, tmp_dir):
    fanout, rounds, per_batch = 3, 10, 20
    rewritten = []
    for batch in range(rounds):
        sinks.write_batch(rows_of(spark, range(batch * per_batch, (batch + 1) * per_batch)), tmp_dir, RED, "a", batch)
        known = {f.path for f in commitlog.snapshot(spark, tmp_dir).live}
        sinks.compact_store(spark, tmp_dir, fanout=fanout, bucket_rows=50, grace_seconds=0)
        live = commitlog.snapshot(spark, tmp_dir).live
        rewritten.append(sum(f.rows for f in live if f.path not in known))
        # Fewer than fanout folders a tier, and nothing else on disk.
        tiers = [f.tier for f in live]
        assert all(tiers.count(t) < fanout for t in tiers) and 0 not in tiers
        assert sorted(os.listdir(os.path.join(tmp_dir, "merged", "violations"))) == sorted(os.path.basename(f.path) for f in live)
        assert not [b for r in os.listdir(os.path.join(tmp_dir, RED)) for b in os.listdir(os.path.join(tmp_dir, RED, r))]
        assert len([n for n in os.listdir(os.path.join(tmp_dir, "log")) if n.endswith(".json")]) <= 2
    # Most rounds rewrite the young batch only; a full tier is rewritten once for the next.
    assert rewritten == [20, 20, 60, 20, 20, 60, 20, 20, 180, 20]
    assert sinks.read_violations(spark, tmp_dir).count() == rounds * per_batch


def test_snapshots_expire_after_the_grace_time_only(spark, tmp_dir):
    sinks.write_batch(rows_of(spark, [1]), tmp_dir, RED, "a", 0)
    sinks.compact_store(spark, tmp_dir)
    young = os.path.join(tmp_dir, RED, "run=a", "batch_id=0")
    assert os.path.exists(young) and commitlog.expire(spark, tmp_dir, 3600) == 0
    time.sleep(0.01)
    assert commitlog.expire(spark, tmp_dir, 0) == 1 and not os.path.exists(young)
    assert commitlog.expire(spark, tmp_dir, 0) == 0
    assert held(sinks.read_violations(spark, tmp_dir)) == [("v1", "NEW")]


def test_a_plate_lookup_opens_only_the_plates_bucket(spark, tmp_dir):
    days = [f"2024-01-{d:02d}" for d in range(1, 9)]
    for n, day in enumerate(days):
        sinks.write_batch(rows_of(spark, range(1000 * n, 1000 * n + 200), day=day), tmp_dir, RED, "a", n)
    sinks.compact_store(spark, tmp_dir, bucket_rows=100)
    (folder,) = commitlog.snapshot(spark, tmp_dir).of(sinks.VIOLATIONS)
    assert folder.rows == 1600 and folder.buckets == 16
    key = lookup.plate_key(" p  7")
    by_plate = sinks.read_violations(spark, tmp_dir, plate=key)
    scan = sinks.read_violations(spark, tmp_dir, where=lookup.plate_is(" p  7"))
    assert held(by_plate) == held(scan) and by_plate.count() == 4 * len(days)
    assert files_read(by_plate) <= 2 < len(days) <= files_read(scan)
    # Young batches are scanned beside it, and the rest of the lookup is as before.
    sinks.write_batch(rows_of(spark, [7], status="PAID", speed=77.0), tmp_dir, RED, "a", len(days))
    answer = lookup.violations_by_plate(sinks.read_violations(spark, tmp_dir, plate=key), "p 7", limit=100)
    assert answer.count() == 4 * len(days) + 0 and ("v7", "PAID") in held(answer)
    assert sinks.read_violations(spark, tmp_dir, plate=lookup.plate_key("none")).count() == 0
    bloom = spark.read.parquet(os.path.join(tmp_dir, folder.path, "by_plate")).inputFiles()[0].removeprefix("file://")
    import pyarrow.parquet as pq

    assert pq.ParquetFile(bloom).metadata.num_rows > 0


def test_reading_some_queries(spark, tmp_dir):
    sinks.write_batch(rows_of(spark, [1]), tmp_dir, RED, "a", 0)
    sinks.write_batch(rows_of(spark, [2], kind="SPEEDING"), tmp_dir, "speeding_violations", "a", 0)
    sinks.compact_store(spark, tmp_dir)
    sinks.write_batch(rows_of(spark, [3], kind="SPEEDING"), tmp_dir, "speeding_violations", "a", 1)
    assert held(sinks.read_violations(spark, tmp_dir, ("speeding_violations",))) == [("v2", "NEW"), ("v3", "NEW")]
    assert sinks.read_violations(spark, tmp_dir, day=dt.date(2024, 1, 2)).count() == 0


def test_stats_are_compacted(spark, tmp_dir):
    def stats(n, readings):
        at = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
        made = spark.createDataFrame([(f"c{i}", at + dt.timedelta(minutes=i), readings) for i in range(n)],
                                     "camera_id string, window_start timestamp, reading_count int")
        made = made.withColumns({"window_end": F.col("window_start") + F.expr("INTERVAL 1 MINUTE"), "stat_date": F.lit("2024-01-01").cast("date")})
        return made.select(*[(F.col(f.name) if f.name in made.columns else F.lit(1)).cast(f.dataType).alias(f.name)
                             for f in schemas.CAMERA_STATS])

    for batch in range(3):
        sinks.write_batch(stats(5 + batch, batch + 1), tmp_dir, sinks.STATS, "a", batch)
        assert sinks.compact_store(spark, tmp_dir, fanout=2) == batch + 1
    found = sinks.read_stats(spark, tmp_dir).collect()
    assert sorted((r.camera_id, r.reading_count) for r in found) == [(f"c{i}", 3) for i in range(7)]
    assert sinks.read_stats(spark, tmp_dir, where=F.col("camera_id") == "c2").count() == 1
