"""Operators against plain loops over small random data."""

from __future__ import annotations

import datetime as dt
from collections import defaultdict

from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from seasongrid.operators.joins import forward_fill, last_nonblank
from seasongrid.plans import gold

few = settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _date(number: int) -> dt.datetime:
    return dt.datetime(2022, 6, 1) + dt.timedelta(days=40 * number)


# Race number -> (season, date number); some races share a date.
CALENDAR = {r: (2022 + r // 6, r - (r % 5 == 4)) for r in range(12)}

results = st.dictionaries(
    st.tuples(st.sampled_from("AB"), st.sampled_from(sorted(CALENDAR))),
    st.one_of(st.none(), st.integers(1, 9)),
    min_size=1,
    max_size=14,
)


def _frames(make, data):
    calendar = make(
        "Race_Key long, Year int, Date timestamp", *[(r, s, _date(d)) for r, (s, d) in CALENDAR.items()]
    )
    facts = make(
        "team string, Year int, Date timestamp, rank int",
        *[(t, CALENDAR[r][0], _date(CALENDAR[r][1]), v) for (t, r), v in data.items()],
    )
    return facts, calendar


@few
@given(results, st.one_of(st.none(), st.integers(0, 11)))
def test_forward_fill(make, data, stop):
    facts, calendar = _frames(make, data)
    until = None if stop is None else F.lit(_date(stop))
    got = forward_fill(facts, calendar, ["team"], "rank", "rank_then", until=until)

    shown = [r for r in CALENDAR if stop is None or CALENDAR[r][1] <= stop]
    want = []
    for team, season in {(t, CALENDAR[r][0]) for t, r in data if r in shown}:
        daily = defaultdict(list)
        for (t, r), v in data.items():
            if t == team and CALENDAR[r][0] == season and v is not None:
                daily[CALENDAR[r][1]].append(v)
        for race in shown:
            if CALENDAR[race][0] == season:
                days = [d for d in daily if d <= CALENDAR[race][1]]
                want.append((team, season, race, max(daily[max(days)]) if days else None))
    assert rows(got, "team", "Year", "Race_Key", "rank_then") == sorted(
        want, key=lambda r: [(v is not None, v) for v in r]
    )


@few
@given(results)
def test_running_maximum_over_the_whole_calendar(make, data):
    facts, calendar = _frames(make, data)
    dates = calendar.select("Date", F.col("Date").alias("day")).distinct()
    got = forward_fill(facts, dates, ["team"], "rank", "best", None, "day", "Date", how="max")

    want = []
    for team in {t for t, _ in data}:
        for number in {d for _, d in CALENDAR.values()}:
            seen = [v for (t, r), v in data.items() if t == team and CALENDAR[r][1] <= number and v is not None]
            want.append((team, _date(number), max(seen, default=None)))
    assert rows(got, "team", "Date", "best") == sorted(want, key=lambda r: [(v is not None, v) for v in r])


@few
@given(results, st.integers(0, 11))
def test_last_nonblank(make, data, stop):
    facts, _ = _frames(make, data)
    got = last_nonblank(facts, ["team"], "Date", "rank", "last", F.lit(_date(stop)))
    want = []
    for team in {t for t, _ in data}:
        known = [(CALENDAR[r][1], v) for (t, r), v in data.items() if t == team and v is not None]
        want.append((team, max((k for k in known if k[0] <= stop), default=(None, None))[1]))
    assert rows(got) == sorted(want)


standing = st.tuples(
    st.sampled_from(["A", "A ", "B"]),
    st.integers(1, 4),
    st.one_of(st.none(), st.integers(0, 20).map(lambda n: n / 2)),
    st.integers(1, 2),
)


@few
@given(st.lists(standing, min_size=1, max_size=20))
def test_fact_team(make, data):
    calendar = make("meeting_key long, date_start timestamp", *[(m, _date(m)) for m in range(1, 4)])
    table = make(
        "team_name string, year int, meeting_key long, points float, position int",
        *[(t, 2022, m, p, w) for t, m, p, w in data],
    )
    want = []
    for team in "AB":
        best, before = None, 0.0
        series = [(m, p, w) for t, m, p, w in data if t.strip() == team and m < 4]
        for m, p, w in sorted(series, key=lambda r: (r[0], r[1] is not None, r[1], r[2])):
            best = p if best is None else best if p is None else max(best, p)
            gain = None if best is None or before is None else max(best - before, 0.0)
            want.append((f"{team}-2022", m, gain, best, w))
            before = best
    got = rows(gold.fact_team(table, calendar), "Team_Key", "Race_Key", "Race_Points", "Season_Points", "World_Position")
    order = {"key": lambda r: [(v is not None, v) for v in r]}
    assert got == sorted(want, **order)
    # Blocks of races, and blocks of points within a race.
    for block in (F.col("meeting_key"), F.struct("date_start", "meeting_key", F.floor(F.col("points") / 4))):
        blocked = gold.fact_team(table, calendar, block=block)
        assert rows(blocked, "Team_Key", "Race_Key", "Race_Points", "Season_Points", "World_Position") == got
