"""Lookups and reports on a hand-made evening at two harbour cameras."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import cameras
from trafficwatch import schemas
from trafficwatch.plans import lookup, report
from trafficwatch.plans.quality import detection_quality, registry_checks

DAY = dt.date(2025, 3, 14)
CLOSE = dt.datetime(2025, 3, 14, 12, 0, tzinfo=dt.timezone.utc)  # 20:00 in Manila
PIER, GATE = ("HBR-1", "Pier 4"), ("HBR-2", "Gate 9")

# id, offence, plate, camera, km/h, and the Manila clock of the violation and of its detection
EVENING = """
    ('v1', 'SPEEDING',          'TUG 77', 'HBR-1', 'Pier 4', 92.0, '19:25:00', '19:27:00'),
    ('v2', 'ILLEGAL_PARKING',   'OAR 3',  'HBR-2', 'Gate 9',  1.0, '19:51:00', '19:56:00'),
    ('v3', 'SPEEDING',          'TUG 77', 'HBR-1', 'Pier 4', 86.0, '19:57:30', '19:58:00'),
    ('v4', 'BEATING_RED_LIGHT', 'KEEL 5', 'HBR-1', 'Pier 4', 45.0, '19:58:30', '19:59:00')
"""


@pytest.fixture(scope="module")
def evening(spark):
    rows = spark.sql(f"""
        SELECT id AS violation_id, offence AS violation_type, plate AS plate_number, 'VAN' AS vehicle_type,
               camera AS camera_id, place AS location_name, 'Quay Road' AS road_name, 14.6 AS latitude,
               120.9 AS longitude, timestamp('2025-03-14 ' || happened || '+08:00') AS violation_time,
               date'2025-03-14' AS violation_date, timestamp('2025-03-14 ' || happened || '+08:00') AS window_start,
               timestamp('2025-03-14 ' || happened || '+08:00') AS window_end, kph AS recorded_speed_kph,
               50 AS speed_limit_kph, 1 AS reading_count, 'seen' AS evidence, 'PENDING_REVIEW' AS ticket_status,
               timestamp('2025-03-14 ' || found || '+08:00') AS detected_at
        FROM VALUES {EVENING} AS t(id, offence, plate, camera, place, kph, happened, found)""")
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in schemas.VIOLATION])


def ids(df, name="id"):
    return [r[name] for r in df.collect()]


def test_api_record(evening):
    record = lookup.api_record(evening.where("violation_id = 'v2'")).first().asDict()
    assert record == {
        "id": "v2", "time": "2025-03-14T19:51:00.000+08:00", "type": "ILLEGAL_PARKING", "plate": "OAR 3",
        "vehicle": "VAN", "camera": "HBR-2", "location": "Gate 9", "speed": 1.0, "limit": 50, "evidence": "seen",
        "status": "PENDING_REVIEW", "detected": "2025-03-14T19:56:00.000+08:00"}


def test_day_reports(evening):
    stats = report.day_stats(evening, CLOSE).first()
    # Three of the four were detected or happened in the last five minutes' span.
    assert (stats.total, stats.avg_speed, stats.busiest) == (4, 56.0, "Pier 4")
    summary = report.day_summary(evening, DAY).first()
    assert (summary.date, summary.total, summary.avg_speed) == ("2025-03-14", 4, 56.0)
    assert (summary.first, summary.last) == ("2025-03-14T19:25:00.000+08:00", "2025-03-14T19:58:30.000+08:00")
    assert (summary.top_plate, summary.top_plate_count) == ("TUG 77", 2)


def test_counts(evening):
    assert {tuple(r) for r in report.counts_by(evening, "camera_id").collect()} == {("HBR-1", 3), ("HBR-2", 1)}
    assert {tuple(r) for r in report.counts_by(evening, "violation_type").collect()} == {
        ("SPEEDING", 2), ("ILLEGAL_PARKING", 1), ("BEATING_RED_LIGHT", 1)}
    assert ids(report.counts_by_location(evening), "location_name") == ["Pier 4", "Gate 9"]
    assert tuple(report.top_key(evening, "plate_number").first()) == ("TUG 77", 2)


def test_reports_of_an_empty_day(evening):
    nothing = evening.limit(0)
    stats = report.day_stats(nothing, CLOSE).first()
    assert (stats.total, stats.avg_speed, stats.busiest, stats.per_minute) == (0, 0.0, None, 0.0)
    summary = report.day_summary(nothing, DAY).first()
    assert (summary.total, summary.first, summary.top_plate) == (0, None, None)
    assert report.latest_detection_age(nothing, CLOSE).first().age_seconds is None


def test_newest_first(evening):
    assert ids(lookup.violations_of_day(evening, DAY, limit=3)) == ["v4", "v3", "v2"]
    for limit in (0, 2001):
        with pytest.raises(ValueError):
            lookup.newest_first(lookup.api_record(evening), limit=limit)


def test_key_lookups(evening):
    assert ids(lookup.violations_by_plate(evening, "\ttug \t 77"), "violation_id") == ["v3", "v1"]
    assert lookup.violations_by_plate(evening, "tug  77", strict_key=True).count() == 0
    assert ids(lookup.violations_by_camera(evening, "hbr-1 ", DAY, limit=2), "violation_id") == ["v4", "v3"]
    assert ids(lookup.violations_by_type(evening, " speeding", DAY), "violation_id") == ["v3", "v1"]
    assert lookup.violations_by_type(evening, "SPEEDING", "2025-03-13").count() == 0
    assert lookup.violations_by_plate(evening, "TUG 77", limit=7000, strict_key=True).count() == 2
    for bad in (lambda: lookup.violations_by_plate(evening, "TUG 77", limit=1001),
                lambda: lookup.violations_by_camera(evening, "HBR-1", DAY, limit=0)):
        with pytest.raises(ValueError):
            bad()


def test_store_at_a_moment_and_lookback(evening):
    at = lambda minute: CLOSE.replace(hour=11, minute=minute)
    assert sorted(ids(lookup.as_of(evening, at(56)), "violation_id")) == ["v1", "v2"]
    assert lookup.as_of(evening, at(20)).count() == 0
    assert sorted(ids(lookup.lookback(evening, DAY, at(50)), "violation_id")) == ["v1", "v2", "v3", "v4"]
    assert sorted(ids(lookup.lookback(evening, DAY, CLOSE), "violation_id")) == ["v2", "v3", "v4"]
    assert ids(lookup.new_violations(evening, DAY, at(57), CLOSE)) == ["v3", "v4"]
    assert lookup.new_violations(evening, DAY + dt.timedelta(days=1), CLOSE, CLOSE).count() == 0


def test_poll_steps(evening):
    early = lookup.api_record(evening.where("violation_id in ('v1', 'v2')"))
    everything = lookup.api_record(evening)
    snapshot, news = lookup.poll_step(None, early, DAY)  # the first load is silent
    assert sorted(ids(snapshot)) == ["v1", "v2"] and news.count() == 0
    changed = everything.withColumn("status", F.when(F.col("id") == "v2", "PAID").otherwise(F.col("status")))
    snapshot, news = lookup.poll_step(snapshot, changed.where("id <> 'v1'"), DAY)
    assert ids(news) == ["v3", "v4"]  # oldest first
    assert {r.id: r.status for r in snapshot.collect()} == {
        "v1": "PENDING_REVIEW", "v2": "PAID", "v3": "PENDING_REVIEW", "v4": "PENDING_REVIEW"}
    again, news = lookup.poll_step(snapshot, everything, DAY)  # a full reload brings nothing new
    assert again.count() == 4 and news.count() == 0
    tomorrow, news = lookup.poll_step(snapshot, everything.limit(0), DAY + dt.timedelta(days=1))  # day change
    assert tomorrow.count() == 0 and news.count() == 0
    assert lookup.news(early, everything, initial=True).count() == 0


def test_counters(spark, evening):
    assert report.latest_detection_age(evening, CLOSE).first().age_seconds == 60.0
    assert report.latest_detection_age(evening, CLOSE - dt.timedelta(hours=3)).first().age_seconds == 0.0
    readings = spark.sql("""
        SELECT timestamp_micros(1000000L * s) AS event_time
        FROM (SELECT explode(concat(sequence(0, 9), sequence(600, 629), array(172800, 172801))) AS s)""")
    rates = [(r.total, r.events_per_sec) for r in report.event_rate(readings).orderBy("poll_time").collect()]
    # Polls at 300 s, 900 s and two days later (the running total crosses days).
    assert rates == [(10, 0.0), (40, 30 / 600), (42, 2 / (172_800 + 300 - 900))]
    health = {r.metric: r.value for r in report.health_counters(readings, evening, DAY, CLOSE).collect()}
    assert health == {"topic_total": 42.0, "events_per_sec": 2 / 172_200, "latest_violation_age": 60.0,
                      "violations_today": 4.0}


def test_registry_checks(spark):
    assert {r.failed for r in registry_checks(cameras(spark)).collect()} == {0}
    faulty = [("DOCK", "a", "r", "c", 14.5, 121.0, 60, "SPEED"), ("DOCK", "b", "r", "c", 14.5, 121.0, 60, "SPEED"),
              ("BUOY", "c", "r", "c", 15.0, 121.0, 60, "SONAR"), ("MAST", "d", "r", "c", 14.5, 121.5, 60, "INTERSECTION")]
    found = {r.rule: (r.failed, r.passed) for r in registry_checks(cameras(spark, faulty)).collect()}
    assert found == dict.fromkeys(("unique_camera_id", "known_camera_type", "all_camera_types_present",
                                   "latitude_in_bounds", "longitude_in_bounds"), (1, False))


def test_detection_quality(spark, evening):
    planted = spark.createDataFrame(
        [("TUG 77", "HBR-1", "SPEEDING"), ("RAFT 8", "HBR-1", "SPEEDING"), ("OAR 3", "HBR-2", "ILLEGAL_PARKING")],
        "plate_number string, camera_id string, simulated_scenario string")
    found = {r.violation_type: (r.tp, r.fp, r.fn) for r in detection_quality(evening, planted).collect()}
    assert found["SPEEDING"] == (1, 0, 1) and found["ILLEGAL_PARKING"] == (1, 0, 0)
    assert found["BEATING_RED_LIGHT"] == (0, 1, 0)
