"""The durable poll: first load, empty first load, day change, full reload, restart."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from helpers import MANILA
from test_store import RED, rows_of
from trafficwatch.config import DEFAULT, Settings
from trafficwatch.plans import lookup, poll
from trafficwatch.sources import commitlog, sinks


def at(day, hour, minute=0, second=0):
    return dt.datetime(2024, 1, day, hour, minute, second, tzinfo=MANILA)


def log_of(spark, rows):
    """(id, day, time of day, detected at) as violations; fetches from it as of a moment."""
    made = spark.createDataFrame(
        [(i, happened.date(), happened, found, status) for i, happened, found, status in rows],
        "violation_id string, violation_date date, violation_time timestamp, detected_at timestamp, ticket_status string")
    blank = rows_of(spark, [1]).drop(*made.columns, "violation_type")
    df = made.crossJoin(blank).withColumn("violation_type", F.lit("SPEEDING")).withColumn("window_end", F.col("detected_at"))
    columns = rows_of(spark, [1]).columns

    def fetch_at(now):
        def fetch(day, since):
            known = lookup.day_violations(lookup.as_of(df.select(*columns), now), day)
            return known if since is None else known.where(F.col("violation_time") >= lookup.instant(since))
        return fetch

    return fetch_at


def ids(df):
    return [r.id for r in df.collect()]


ROWS = [("a", at(1, 8), at(1, 8, 2), "NEW"), ("b", at(1, 8, 20), at(1, 8, 21), "NEW"), ("slow", at(1, 8, 5), at(1, 8, 50), "NEW"),
        ("c", at(1, 8, 49), at(1, 8, 51), "NEW"), ("b", at(1, 8, 20), at(1, 8, 51), "PAID"), ("next", at(2, 0, 1), at(2, 0, 2), "NEW"),
        ("yesterday", at(1, 23, 59), at(2, 0, 3), "NEW")]


def test_the_four_rules_of_a_poll(spark, tmp_dir):
    fetch = log_of(spark, ROWS)

    def step(now):
        found = poll.poll(spark, tmp_dir, fetch(now), now)
        return found, ids(found.news), sorted(ids(poll.held_records(spark, tmp_dir)))

    found, fresh, held = step(at(1, 8, 22))  # the first load is silent
    assert (found.initial, found.full, fresh, held) == (True, True, [], ["a", "b"])
    found, fresh, held = step(at(1, 8, 27))  # exactly 300 s: not yet a full read
    assert (found.initial, found.full, fresh, held) == (False, False, [], ["a", "b"])
    found, fresh, held = step(at(1, 8, 52))  # a full read: "slow" happened before the lookback
    assert (found.full, fresh, held) == (True, ["slow", "c"], ["a", "b", "c", "slow"])
    assert {r.id: r.status for r in poll.held_records(spark, tmp_dir).collect()}["b"] == "PAID"
    found, fresh, held = step(at(1, 8, 53))
    assert (found.full, fresh, held) == (False, [], ["a", "b", "c", "slow"])
    found, fresh, held = step(at(2, 0, 4))  # the new day's records are news, yesterday's late one is not read
    assert (found.initial, found.full, fresh, held) == (False, True, ["next"], ["next"])


def test_an_empty_first_load_is_followed_by_news(spark, tmp_dir):
    fetch = log_of(spark, ROWS)
    for now, expected in ((at(1, 7), []), (at(1, 8, 3), ["a"]), (at(1, 8, 4), [])):
        assert ids(poll.poll(spark, tmp_dir, fetch(now), now).news) == expected
    # So does the step without a folder.
    nothing = lookup.api_record(fetch(at(1, 7))(dt.date(2024, 1, 1), None))
    one = lookup.api_record(fetch(at(1, 8, 3))(dt.date(2024, 1, 1), None))
    held, silent = lookup.poll_step(None, nothing, "2024-01-01")
    held, fresh = lookup.poll_step(held, one, "2024-01-01")
    assert (ids(silent), ids(fresh)) == ([], ["a"])
    next_day, fresh = lookup.poll_step(held, lookup.api_record(fetch(at(2, 1))(dt.date(2024, 1, 2), None)), "2024-01-02")
    assert (ids(fresh), ids(next_day)) == (["next"], ["next"])


def test_the_same_news_after_a_lost_client_and_a_lost_poll(spark, tmp_dir, monkeypatch):
    fetch = log_of(spark, ROWS)
    poll.poll(spark, tmp_dir, fetch(at(1, 8, 3)), at(1, 8, 3))
    real = commitlog.write_text
    monkeypatch.setattr(commitlog, "write_text", lambda *a: (_ for _ in ()).throw(OSError("driver lost")))
    with pytest.raises(OSError):
        poll.poll(spark, tmp_dir, fetch(at(1, 8, 22)), at(1, 8, 22))
    monkeypatch.setattr(commitlog, "write_text", real)
    assert sorted(ids(poll.held_records(spark, tmp_dir))) == ["a"]  # that poll has not happened
    found = poll.poll(spark, tmp_dir, fetch(at(1, 8, 22)), at(1, 8, 22))
    assert ids(found.news) == ["b"] and found.state.generation == 1
    assert ids(poll.news_of(spark, tmp_dir, found.state.generation)) == ["b"]  # read again by a restarted client
    assert poll.load_state(spark, tmp_dir) == found.state


def test_generations_are_bounded(spark, tmp_dir):
    fetch = log_of(spark, ROWS)
    settings = Settings(api_full_reload_seconds=60)
    for minute in range(8):
        for second in (0, 30):
            now = at(1, 8, 20 + minute, second)
            poll.poll(spark, tmp_dir, fetch(now), now, settings)
    state = poll.load_state(spark, tmp_dir)
    kept = [n for n in os.listdir(os.path.join(tmp_dir, "records")) if n.startswith("generation=")]
    assert state.generation == 15 and state.generation - state.base < 3 and len(kept) <= 6
    assert sorted(ids(poll.held_records(spark, tmp_dir))) == ["a", "b"]


def test_polling_a_store(spark, tmp_dir):
    store, client = os.path.join(tmp_dir, "store"), os.path.join(tmp_dir, "client")
    sinks.write_batch(rows_of(spark, [1, 2]), store, RED, "a", 0)
    now = at(1, 12, 10)  # the rows happened at 12:00 in Manila
    assert ids(poll.poll(spark, client, poll.store_fetch(spark, store), now).news) == []
    sinks.write_batch(rows_of(spark, [2, 3], speed=50.0), store, RED, "a", 1)
    sinks.compact_store(spark, store)
    later = poll.poll(spark, client, poll.store_fetch(spark, store), now + dt.timedelta(minutes=4))
    assert (ids(later.news), later.full) == (["v3"], False)
    assert {r.id: r.speed for r in poll.held_records(spark, client).collect()} == {"v1": 40.0, "v2": 50.0, "v3": 50.0}
    sinks.write_batch(rows_of(spark, [4]), store, RED, "a", 2)
    much_later = poll.poll(spark, client, poll.store_fetch(spark, store), now + dt.timedelta(minutes=50))
    assert (ids(much_later.news), much_later.full) == (["v4"], True)
    assert DEFAULT.api_full_reload_seconds == 300
