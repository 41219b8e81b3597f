from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from hearthline.operators.intervals import cap_sessions, closed_sessions, prorate, valid_sessions, with_duration

COLS = ["session_id", "guild_id", "joined_at", "left_at"]
STAMPS = ("joined_at", "left_at")


def sessions(ntz, *pairs):
    return ntz([(i, 1, a, b) for i, (a, b) in enumerate(pairs)], "session_id int, guild_id int, joined_at string, left_at string", STAMPS)


def pieces(df, unit, tz="UTC"):
    key = "bucket_local" if unit == "hour" else "bucket_date"
    return {str(r[0]): r[1] for r in prorate(df, unit=unit, tz=tz).select(key, "duration_seconds").collect()}


def test_hour_split(ntz):
    got = pieces(sessions(ntz, ("2026-01-05 21:30:00", "2026-01-05 22:45:00")), "hour")
    assert got == {"2026-01-05 21:00:00": 1800.0, "2026-01-05 22:00:00": 2700.0}


def test_day_split(ntz):
    got = pieces(sessions(ntz, ("2026-01-09 23:00:00", "2026-01-10 02:00:00")), "day")
    assert got == {"2026-01-09": 3600.0, "2026-01-10": 7200.0}


def test_end_on_the_border_gives_no_empty_piece(ntz):
    assert pieces(sessions(ntz, ("2026-01-05 22:10:00", "2026-01-05 23:00:00")), "hour") == {"2026-01-05 22:00:00": 3000.0}
    assert pieces(sessions(ntz, ("2026-01-05 22:00:00", "2026-01-06 00:00:00")), "day") == {"2026-01-05": 7200.0}


def test_zero_length_session_has_no_piece(ntz):
    assert pieces(sessions(ntz, ("2026-01-05 22:10:00", "2026-01-05 22:10:00")), "hour") == {}


def test_cap(ntz):
    df = with_duration(cap_sessions(sessions(ntz, ("2026-01-01 00:00:00", "2026-01-02 06:00:00"))))
    assert df.first().duration_seconds == 24 * 3600


def test_invalid_sessions_are_dropped(ntz):
    df = sessions(ntz, ("2026-01-01 01:00:00", None), ("2026-01-01 01:00:00", "2026-01-01 00:59:59"), ("2026-01-01 01:00:00", "2026-01-01 01:00:00"))
    assert [r.session_id for r in valid_sessions(df).collect()] == [2]


def test_tokyo_day_border(ntz):
    # 14:00-16:00 UTC is 23:00-01:00 in Tokyo
    got = pieces(sessions(ntz, ("2026-01-05 14:00:00", "2026-01-05 16:00:00")), "day", "Asia/Tokyo")
    assert got == {"2026-01-05": 3600.0, "2026-01-06": 3600.0}


def test_half_hour_zone(ntz):
    # 10:00 UTC is 15:30 in Kolkata
    got = pieces(sessions(ntz, ("2026-01-05 10:00:00", "2026-01-05 11:00:00")), "hour", "Asia/Kolkata")
    assert got == {"2026-01-05 15:00:00": 1800.0, "2026-01-05 16:00:00": 1800.0}


def test_days_of_23_and_25_hours(ntz):
    spring = sessions(ntz, ("2026-03-08 05:00:00", "2026-03-09 04:00:00"))  # New York 2026-03-08, whole day
    assert pieces(spring, "day", "America/New_York") == {"2026-03-08": 23 * 3600.0}
    autumn = sessions(ntz, ("2026-11-01 04:00:00", "2026-11-02 04:00:00"))
    assert pieces(autumn, "day", "America/New_York") == {"2026-11-01": 24 * 3600.0}
    both = sessions(ntz, ("2026-11-01 04:00:00", "2026-11-02 05:00:00"))
    assert pieces(both, "day", "America/New_York") == {"2026-11-01": 25 * 3600.0}


@pytest.mark.parametrize("unit", ["hour", "day"])
@pytest.mark.parametrize("tz", ["UTC", "Asia/Tokyo", "Asia/Kolkata", "America/New_York"])
def test_seconds_are_conserved(ntz, unit, tz):
    rnd, rows = random.Random(5), []
    for _ in range(200):
        start = f"2026-03-{rnd.randint(5, 12):02d} {rnd.randint(0, 23):02d}:{rnd.randint(0, 59):02d}:{rnd.randint(0, 59):02d}.{rnd.randint(0, 999999):06d}"
        rows.append((start, rnd.randint(0, 30 * 3600)))
    df = ntz([(i, 1, a, s) for i, (a, s) in enumerate(rows)], "session_id int, guild_id int, joined_at string, s int", ("joined_at",))
    df = closed_sessions(df.withColumn("left_at", F.expr("joined_at + make_dt_interval(0, 0, 0, s)")))
    whole = with_duration(df).agg(F.sum("duration_seconds")).first()[0]
    assert prorate(df, unit=unit, tz=tz).agg(F.sum("duration_seconds")).first()[0] == whole


def test_unknown_unit(ntz):
    with pytest.raises(ValueError):
        prorate(sessions(ntz, ("2026-01-05 10:00:00", "2026-01-05 11:00:00")), unit="week")
