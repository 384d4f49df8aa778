"""Vector codes against brute force: every distance, every round."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from seasongrid.llm import vector_codes as codes

SCHEMA = "vec_id long, embedding array<float>, label int, ints array<int>, code string, of int"


def _nearest(points, entries):
    d = ((points[:, None, :] - entries[None]) ** 2).sum(axis=2)
    return d.argmin(axis=1), d.min(axis=1)


def _brute(rows, parts=8, entries=16, rounds=6):
    """``rows`` are (id, list of integers) of one length, in order."""
    points = np.array([v for _, v in rows], np.int64).reshape(len(rows), parts, -1)
    books = points[:entries].transpose(1, 0, 2).copy()
    for _ in range(rounds):
        for p in range(parts):
            index, _ = _nearest(points[:, p], books[p])
            for e in set(index.tolist()):
                mine = points[index == e, p]
                books[p, e] = [int(s) // len(mine) for s in mine.sum(axis=0)]
    found = [_nearest(points[:, p], books[p]) for p in range(parts)]
    text = ["".join(f"{index[i]:02x}" for index, _ in found) for i in range(len(rows))]
    flat = ",".join(str(x) for x in books.ravel().tolist())
    return text, sum(d for _, d in found).tolist(), hashlib.sha256(flat.encode()).hexdigest()


@pytest.mark.parametrize("width,spread", [(1, 3), (2, 4), (8, 3), (8, 100_000)])
def test_tree_finds_the_first_of_the_nearest(width, spread):
    rng = np.random.default_rng(width + spread)
    for n in (0, 1, 3, 5, 16, 40):
        entries, points = rng.integers(-spread, spread, (n, width)), rng.integers(-spread, spread, (300, width))
        tree = codes.build(entries)
        if n:
            index, d = codes.nearest_entries(points, entries, tree)
            want, far = _nearest(points, entries)
            assert index.tolist() == want.tolist() and d.tolist() == far.tolist()
        assert codes.nearest_entries(points[:0], entries, tree)[0].tolist() == []


def test_tree_leaves_out_subtrees():
    rng = np.random.default_rng(1)
    entries = rng.integers(-30, 30, (64, 4)) + 1000 * rng.integers(0, 5, (64, 1))
    points, measured = entries[rng.integers(0, 64, 500)] + 3, []
    index, _ = codes.nearest_entries(points, entries, codes.build(entries), measured)
    assert index.tolist() == _nearest(points, entries)[0].tolist() and sum(measured) < 500 * 64 / 2


def test_against_brute_force_with_odd_rows(spark):
    rng = np.random.default_rng(3)
    vectors = (rng.integers(-40, 40, (200, 16)) / 64).astype(np.float32)  # many ties
    vectors[50:120] = vectors[7]  # a third are copies
    rows = [(int(i) * 3 - 100, v.tolist(), [None, 1, 2][i % 3], None, "x", 0) for i, v in enumerate(vectors)]
    rows += [(500, None, 1, None, "x", 0), (501, [float("nan")] * 16, 1, None, None, 0), (502, [None] + [0.0] * 15, 1, None, None, 0), (503, [float("inf")] * 16, 1, None, None, 0)]
    got = {r["vec_id"]: r for r in codes.compress(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()}
    kept = [(i, np.floor(np.array(v, float) * 4096).astype(int).tolist(), l) for i, v, l, *_ in rows[:200]]
    text, error, sha = _brute([(i, v) for i, v, _ in kept])
    assert len(got) == 200 and {r["codebooks_sha256"] for r in got.values()} == {sha}
    assert [got[i]["code"] for i, *_ in kept] == text and [got[i]["error"] for i, *_ in kept] == error
    sums = {}
    for (_, _, l), e in zip(kept, error, strict=True):
        sums[l] = sums.get(l, 0) + e
    assert all(got[i]["label_error"] == sums[l] for i, _, l in kept)


def test_repeated_null_uneven_huge_and_no_rows(spark):
    rows = [(1, [1.0] * 3, 1), (1, [1.0] * 3, 1), (None, [1.0] * 5, None), (2, [], 1), (3, [3e38, -3e38], None), (None, None, None)]
    df = spark.createDataFrame([(*r, None, None, None) for r in rows], SCHEMA)
    got = codes.compress(df).collect()
    assert len(got) == 5 and all(r["error"] == 0 and len(r["code"]) == 16 for r in got)
    by = {r["vec_id"]: r["code"] for r in got}
    assert by[1] == "00" * 8 and by[2].startswith("0202")  # the rows are, by id: 1, 1, 2, 3, null
    assert codes.compress(df.where(F.lit(False))).collect() == []
    hollow = codes.compress(df.where("vec_id = 2")).collect()
    assert [(r["code"], r["error"], r["label_error"]) for r in hollow] == [("00" * 8, 0, 0)]
