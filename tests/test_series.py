from __future__ import annotations

import random

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from seasongrid.operators.dedup import collapse_copies, expand_copies, first_per_group
from seasongrid.operators.series import clamped_delta, previous_value, running_max, spans_at, value_spans

SCHEMA = "name string, race int, points float"


def _deltas(df, block=None):
    series = previous_value(df, "points", ["name"], ["race"], "prev", 0.0, block)
    return series.withColumn("gained", clamped_delta(F.col("points"), F.col("prev")))


def test_delta_of_a_series_that_drops(make):
    df = make(SCHEMA, ("A", 1, 10.0), ("A", 2, 25.0), ("A", 3, 20.0), ("A", 4, 30.0))
    got = _deltas(df)
    assert [r[1] for r in rows(got, "race", "gained")] == [10.0, 15.0, 0.0, 10.0]
    assert dict(got.dtypes)["gained"] == "float"


def test_running_max_repairs_a_drop(make):
    df = make(SCHEMA, ("A", 1, 10.0), ("A", 2, 25.0), ("A", 3, 20.0), ("A", 4, 30.0))
    fixed = running_max(df, "points", ["name"], ["race"], "fixed")
    lagged = previous_value(fixed, "fixed", ["name"], ["race"], "prev")
    got = lagged.withColumn("gained", clamped_delta(F.col("fixed"), F.col("prev")))
    assert rows(got, "race", "fixed", "gained") == [
        (1, 10.0, 10.0), (2, 25.0, 15.0), (3, 25.0, 0.0), (4, 30.0, 5.0)
    ]


points = st.one_of(st.none(), st.integers(0, 40).map(lambda n: n / 2))
history = st.dictionaries(
    st.tuples(st.sampled_from("ABC"), st.integers(1, 12)), points, min_size=1, max_size=30
)
few = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@few
@given(history)
def test_blocks_change_nothing(make, data):
    df = make(SCHEMA, *[(n, r, p) for (n, r), p in data.items()])
    blocked = df.withColumn("part", F.floor(F.col("race") / 4))
    assert rows(_deltas(df), "name", "race", "prev", "gained") == rows(
        _deltas(blocked, "part"), "name", "race", "prev", "gained"
    )
    plain = running_max(df, "points", ["name"], ["race"], "fixed")
    by_block = running_max(blocked, "points", ["name"], ["race"], "fixed", "part")
    assert rows(plain, "name", "race", "fixed") == rows(by_block, "name", "race", "fixed")


@few
@given(st.lists(st.integers(0, 60).map(lambda n: n / 2), min_size=1, max_size=15))
def test_gains_cover_the_final_total(make, totals):
    df = make(SCHEMA, *[("A", i, p) for i, p in enumerate(totals)])
    gained = sum(r[0] for r in rows(_deltas(df), "gained"))
    assert gained >= totals[-1]
    if totals == sorted(totals):
        assert gained == totals[-1]
    fixed = [r[1] for r in rows(running_max(df, "points", ["name"], ["race"], "fixed"), "race", "fixed")]
    assert fixed == sorted(fixed)


def test_input_order_and_partitions_do_not_matter(make):
    data = [(n, r, float(r * 3 % 7)) for n in "ABCD" for r in range(9)]
    expected = rows(_deltas(make(SCHEMA, *data)))
    random.Random(7).shuffle(data)
    assert rows(_deltas(make(SCHEMA, *data).repartition(7))) == expected


def test_first_per_group_keeps_one_row(make):
    df = make("k string, v int", ("a", 2), ("a", 1), ("b", 5), (None, 7), (None, 6))
    assert rows(first_per_group(df, ["k"], [F.col("v").desc()])) == [(None, 7), ("a", 2), ("b", 5)]


@pytest.mark.parametrize("width", [1 << 16, 4])
def test_copies_survive_the_round_trip(make, monkeypatch, width):
    monkeypatch.setattr("seasongrid.operators.dedup._COPIES_PER_ROW", width)
    data = [("x", 1.5)] * 11 + [("y", 2.0)] * 4 + [("z", None)]
    collapsed = collapse_copies(make("k string, v float", *data))
    assert collapsed.count() == 3
    back = expand_copies(collapsed, "copies", "copy")
    assert rows(back.groupBy("k", "v").agg(F.count("*").alias("n"), F.max("copy").alias("top"))) == [
        ("x", 1.5, 11, 11), ("y", 2.0, 4, 4), ("z", None, 1, 1)
    ]


def test_spans_of_a_running_maximum(make):
    df = make("k string, d int, v double", ("a", 1, 5.0), ("a", 1, 3.0), ("a", 3, 5.0), ("a", 4, 2.0), ("a", 6, 9.0), ("a", None, 99.0), ("b", 2, None), ("b", 5, 1.0), (None, 4, 2.0))
    spans = value_spans(df, ["k"], "d", "v")
    assert rows(spans, "k", "since", "until", "v") == [(None, 4, None, 2.0), ("a", 1, 6, 5.0), ("a", 6, None, 9.0), ("b", 5, None, 1.0)]
    asked = make("d int", (0,), (1,), (5,), (6,), (100,), (5,), (None,))
    got = rows(spans_at(spans, asked, "d"), "k", "d", "v")
    assert got == [(None, 5, 2.0), (None, 6, 2.0), (None, 100, 2.0), ("a", 1, 5.0), ("a", 5, 5.0), ("a", 6, 9.0), ("a", 100, 9.0), ("b", 5, 1.0), ("b", 6, 1.0), ("b", 100, 1.0)]
    assert spans_at(spans, asked.where("false"), "d").count() == 0


def test_spans_do_not_grow_with_later_dates(make, spark):
    later = spark.range(500).selectExpr("'b' as k", "cast(id + 10 as int) as d", "cast(id as double) as v")
    early = make("k string, d int, v double", ("a", 1, 5.0), ("a", 2, 7.0))
    spans = value_spans(early.unionByName(later), ["k"], "d", "v")
    assert spans.where("k = 'a'").count() == 2
