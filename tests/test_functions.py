import datetime as dt
import hashlib

from pyspark.sql import functions as F

from trafficwatch.functions import (
    iso_text,
    local_date,
    local_text,
    lookup_key,
    normalize_plate,
    parse_bool,
    parse_time,
    strip,
)
from trafficwatch.operators.detect import violation_id

UTC = dt.timezone.utc
MANILA = dt.timezone(dt.timedelta(hours=8))


def one(spark, col, value=None, ddl="s string"):
    return spark.createDataFrame([(value,)], ddl).select(col.alias("r")).first()["r"]


def instant(spark, aware):
    micros = round(aware.timestamp() * 1_000_000)
    return spark.range(1).select(F.timestamp_micros(F.lit(micros)).alias("t"))


def test_iso_text_is_manila_with_milliseconds(spark):
    now = dt.datetime(2026, 9, 24, 2, 0, tzinfo=UTC)
    df = instant(spark, now)
    assert df.select(iso_text("t")).first()[0] == "2026-09-24T10:00:00.000+08:00"
    assert df.select(iso_text("t", "UTC")).first()[0] == "2026-09-24T02:00:00.000+00:00"


def test_iso_text_negative_offset_and_null(spark):
    df = instant(spark, dt.datetime(2026, 1, 15, 12, 30, 1, 987654, tzinfo=UTC))
    assert df.select(iso_text("t", "America/New_York")).first()[0] == "2026-01-15T07:30:01.987-05:00"
    assert one(spark, iso_text(F.lit(None).cast("timestamp"))) is None


def test_local_date_and_text_do_not_follow_session_zone(spark):
    df = instant(spark, dt.datetime(2024, 1, 1, 17, 0, 0, 500000, tzinfo=UTC))
    row = df.select(local_date("t").alias("d"), local_text("t").alias("s")).first()
    assert row.d == dt.date(2024, 1, 2)
    assert row.s == "2024-01-02 01:00:00.5"


def micros_of(spark, text, **kw):
    return spark.createDataFrame([(text,)], "s string").select(
        F.unix_micros(parse_time(F.col("s"), **kw)).alias("u")).first()["u"]


def test_parse_time_offsets_and_naive(spark):
    base = dt.datetime(2026, 9, 1, 7, 0, tzinfo=MANILA)
    want = round(base.timestamp() * 1_000_000)
    assert micros_of(spark, "2026-09-01 07:00:00") == want
    assert micros_of(spark, "2026-09-01T07:00:00+08:00") == want
    assert micros_of(spark, "2026-08-31T23:00:00Z") == want
    assert micros_of(spark, " 2026-09-01T07:00:00.000 ") == want
    assert micros_of(spark, "not a time") is None


def test_strip_handles_all_whitespace(spark):
    assert one(spark, strip("s"), "\t  ABC 1\n ") == "ABC 1"
    assert one(spark, strip("s"), " x ") == "x"


def test_parse_bool_tokens(spark):
    got = [one(spark, parse_bool("s"), v) for v in ["TRUE", "1", "Yes", "y", "t", "no", "0", "x", " ", None]]
    assert got == [True, True, True, True, True, False, False, False, None, None]


def test_plate_normalisation(spark):
    assert one(spark, normalize_plate("s"), "  abc   1234 ") == "ABC 1234"
    assert one(spark, normalize_plate("s"), "abc\t\n1234") == "ABC 1234"
    assert one(spark, lookup_key("s"), "  cam-edsa-gua ") == "CAM-EDSA-GUA"


def test_violation_id_matches_sha256_of_manila_text(spark):
    t = dt.datetime(2026, 9, 1, 7, 0, 1, 250000, tzinfo=MANILA)
    df = instant(spark, t).select(F.lit("ABC 1234").alias("plate_number"),
                                  F.lit("CAM-EDSA-GUA").alias("camera_id"), "t")
    got = df.select(violation_id(F.lit("SPEEDING"), F.col("t"))).first()[0]
    text = "SPEEDING|ABC 1234|CAM-EDSA-GUA|2026-09-01 07:00:01.25"
    assert got == hashlib.sha256(text.encode()).hexdigest()[:32]


def test_parse_time_date_only_and_short_offsets(spark):
    midnight = round(dt.datetime(2026, 9, 1, tzinfo=MANILA).timestamp() * 1_000_000)
    assert micros_of(spark, "2026-09-01") == midnight  # date only: naive, declared zone
    assert micros_of(spark, "2026-09-01T00:00:00+08") == midnight
    assert micros_of(spark, "2026-08-31T16:00:00Z") == midnight


def test_times_do_not_follow_the_session_zone(spark):
    """Gap and overlap hours of a daylight-saving zone, in three session zones."""
    texts = ["2026-03-08 02:30:00.5", "2026-11-01 01:30:00", "2026-03-07T18:30:00Z", "2026-07-01",
             "1969-12-31 23:59:59.999999+00:00"]
    found = []
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Asia/Manila", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            rows = spark.createDataFrame([(t,) for t in texts], "s string").select(
                iso_text(parse_time("s")), iso_text(parse_time("s"), "America/New_York"),
                iso_text(parse_time("s", "America/New_York"), "America/New_York"), F.unix_micros(parse_time("s")))
            found.append([tuple(r) for r in rows.collect()])
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert found[0] == found[1] == found[2]
    assert [r[0] for r in found[0]] == [
        "2026-03-08T02:30:00.500+08:00", "2026-11-01T01:30:00.000+08:00", "2026-03-08T02:30:00.000+08:00",
        "2026-07-01T00:00:00.000+08:00", "1970-01-01T07:59:59.999+08:00"]
    # A wall clock in the gap moves on by the hour that is missing.
    assert found[0][0][2] == "2026-03-08T03:30:00.500-04:00" and found[0][1][2] == "2026-11-01T01:30:00.000-04:00"


def test_durations_are_spark_intervals():
    import pytest

    from trafficwatch.config import DEFAULT, duration_seconds

    found = [duration_seconds(t) for t in ("20 seconds", "1 minute 30 seconds", "500 milliseconds", "1 day", "interval 2 hours")]
    assert found == [20, 90, 0.5, 86400, 7200]
    assert DEFAULT.with_values({"trigger_interval": "500 milliseconds"}).trigger_interval == "500 milliseconds"
    for bad in ("", "soon", "5", "5 parsecs", "minute 1"):
        with pytest.raises(ValueError):
            duration_seconds(bad)
