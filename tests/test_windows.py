"""Window bounds (L8) and row-to-window assignment against a brute force."""

import random
from datetime import date, datetime, timedelta

import pytest

from tidewater.operators.windows import add_months, assign_windows, make_windows


def test_start_on_31st_drifts_like_iterated_steps():
    w = make_windows("2024-01-31", "2024-05-15", 1)
    assert [x.start for x in w[:3]] == [date(2024, 1, 31), date(2024, 2, 29), date(2024, 3, 29)]
    assert add_months(date(2023, 1, 31), 1) == date(2023, 2, 28)


def test_end_on_step_boundary_is_covered_unless_legacy():
    fixed = make_windows("2024-01-01", "2024-04-01", 3)
    legacy = make_windows("2024-01-01", "2024-04-01", 3, legacy_end=True)
    assert fixed[-1].start == fixed[-1].end == date(2024, 4, 1)
    assert legacy[-1].end == date(2024, 3, 31)
    assert len(fixed) == len(legacy) + 1
    assert make_windows("2024-01-01", "2024-01-01", 3, legacy_end=True) == []


def test_windows_are_gap_free_and_cover_the_range():
    w = make_windows("1995-01-01", "2001-08-01", 3)
    assert len(w) == 27
    for a, b in zip(w, w[1:]):
        assert b.start == a.end + timedelta(days=1)
    assert w[0].start == date(1995, 1, 1) and w[-1].end == date(2001, 8, 1)


@pytest.mark.parametrize("months", [0, -1, None])
def test_bad_months_rejected(months):
    with pytest.raises(ValueError):
        make_windows("2024-01-01", "2024-06-01", months)


def _brute(d, wins):
    for w in wins:
        lo = datetime.combine(w.start, datetime.min.time())
        hi = datetime.combine(w.end, datetime.min.time())
        v = d if isinstance(d, datetime) else datetime.combine(d, datetime.min.time())
        if lo <= v <= hi:
            return w.number
    return None


@pytest.mark.parametrize("start,end,months", [("2024-01-31", "2025-03-02", 1), ("2023-03-15", "2026-01-01", 5)])
def test_assignment_matches_brute_force(spark, start, end, months):
    wins = make_windows(start, end, months)
    rng = random.Random(7)
    base = date.fromisoformat(start) - timedelta(days=40)
    days = [base + timedelta(days=rng.randrange(0, 1200)) for _ in range(400)]
    stamps = [datetime.combine(d, datetime.min.time()) + timedelta(hours=rng.choice([0, 0, 10])) for d in days]
    ddf = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "i int, d date")
    tdf = spark.createDataFrame([(i, t) for i, t in enumerate(stamps)], "i int, d timestamp_ntz")
    for df, vals in ((ddf, days), (tdf, stamps)):
        got = {r.i: r.window_no for r in assign_windows(df, "d", wins, months).collect()}
        want = {i: _brute(v, wins) for i, v in enumerate(vals) if _brute(v, wins) is not None}
        assert got == want


def test_a_slice_of_windows_keeps_its_numbers(spark):
    wins = make_windows("2024-01-01", "2024-12-31", 1)
    part = wins[5:8]  # June..August, numbers 6..8
    df = spark.createDataFrame([(date(2024, 6, 15),), (date(2024, 8, 31),), (date(2024, 9, 1),)], "d date")
    got = sorted((r.d, r.window_no) for r in assign_windows(df, "d", part, 1).collect())
    assert got == [(date(2024, 6, 15), 6), (date(2024, 8, 31), 8)]
