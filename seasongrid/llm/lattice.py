"""Near-duplicate vectors by lattice hashing.

Each table projects the unit vectors at random to ``blocks`` times eight
numbers, scales them and decodes every eight to the nearest point of the E8
lattice; neighbouring lattice points next in distance are probed too.  A vector
is a member of the cells it probes; vectors that share a cell are verified by
cosine in double precision.  A pair that shares several cells counts in the
cell with the smallest key only, so links can be counted where they are found
and no pair leaves its task: what leaves are counts and a spanning forest.

Cells shrink as a table grows.  The projections are scaled up with the eighth
root of the number of vectors, so that a cell of unrelated vectors keeps its
size, and as a pair then shares fewer cells, there are more tables: as many as
a pair just at the threshold needs to be found with a chance of ``FOUND``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seasongrid.llm.blocks import in_blocks
from seasongrid.llm.common import mix, starts_of_runs, stored, whole_runs
from seasongrid.llm.components import components

TABLES = 6
PROBES = 4
SCALE = 2.0
#: Vectors up to which ``TABLES`` and ``SCALE`` hold.
ROWS = 20_000
#: Chance that a pair just at the threshold shares a cell of a larger table.
FOUND = 0.995
MOST_TABLES = 400
BLOCKS = 1
BLOCK_WIDTH = 1024


@lru_cache
def _roots() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    whole = []
    for i in range(8):
        for j in range(i):
            for a in (1, -1):
                for b in (1, -1):
                    v = np.zeros(8)
                    v[i], v[j] = a, b
                    whole.append(v)
    signs = np.array(np.meshgrid(*[[0.5, -0.5]] * 8)).reshape(8, -1).T
    return np.concatenate([np.array(whole), signs[(signs < 0).sum(axis=1) % 2 == 0]])


def _d8(x: np.ndarray) -> np.ndarray:
    """Nearest points with integer coordinates of even sum."""
    near = np.rint(x)
    odd = np.flatnonzero(near.sum(axis=1) % 2)
    if len(odd):
        off = x[odd] - near[odd]
        worst = np.argmax(np.abs(off), axis=1)
        near[odd, worst] += np.where(off[np.arange(len(odd)), worst] >= 0, 1, -1)
    return near


def decode(x: np.ndarray) -> np.ndarray:
    """Nearest E8 points: of the two cosets of D8 the nearer one."""
    a, b = _d8(x), _d8(x - 0.5) + 0.5
    nearer = ((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1)
    return np.where(nearer[:, None], a, b)


def probes(x: np.ndarray, n: int) -> np.ndarray:
    """For each row the ``n`` nearest of its lattice point and that point's neighbours."""
    home = decode(x)
    steps = np.concatenate([np.zeros((1, 8)), _roots()])
    # |x - home - s|^2 = |x - home|^2 - 2 (x - home).s + |s|^2
    far = (steps**2).sum(axis=1)[None, :] - 2 * (x - home) @ steps.T
    chosen = np.argpartition(far, n, axis=1)[:, :n]
    return home[:, None, :] + steps[chosen]


def cell_keys(v: np.ndarray, tables: int, n: int, scale: float, blocks: int, seed: int = 8) -> np.ndarray:
    """64-bit keys of the cells each unit vector belongs to, ascending by row."""
    dim = v.shape[1]
    keys = []
    for t in range(tables):
        rng = np.random.default_rng([seed, t, dim])
        wide = max(8 * blocks, 1)
        plane = rng.standard_normal((dim, wide))
        plane = np.linalg.qr(plane)[0] if wide <= dim else plane / np.sqrt(dim)
        plane = plane * np.sqrt(dim / 8)  # distances keep their mean over eight dimensions
        y = v @ plane * scale
        table_keys = None
        for b in range(blocks):
            cells = (2 * probes(y[:, 8 * b : 8 * b + 8], n)).astype(np.int64).view(np.uint64)
            key = np.full(cells.shape[:2], t * 64 + b + 1, np.uint64)
            for i in range(8):
                key = mix(key, cells[:, :, i])
            table_keys = key if table_keys is None else mix(table_keys[:, :, None], key[:, None, :]).reshape(len(v), -1)
        keys.append(table_keys)
    # 31 bits are enough: two cells with one key are only verified together
    return np.sort((np.concatenate(keys, axis=1) >> np.uint64(33)).astype(np.int32), axis=1)


def geometry(n: int, dim: int, threshold: float, probed: int = PROBES, blocks: int = BLOCKS) -> tuple[int, float]:
    """Number of tables and scale for ``n`` vectors.

    The chance that a pair at the threshold meets in one table is measured on
    made pairs, always the same ones.
    """
    if n <= ROWS or dim < 2 or not 0 < threshold < 1:
        return TABLES, SCALE
    scale = SCALE * (n / ROWS) ** (1 / (8 * blocks))
    rng, tried = np.random.default_rng(dim), 8
    one, two = rng.standard_normal((2, 400, dim))
    one /= np.linalg.norm(one, axis=1, keepdims=True)
    two -= (two * one).sum(axis=1, keepdims=True) * one
    two = threshold * one + np.sqrt(1 - threshold**2) * two / np.linalg.norm(two, axis=1, keepdims=True)
    met = [_together(*(cell_keys(v, 1, probed, scale, blocks, seed) for v in (one, two))).mean() for seed in range(tried)]
    chance = min(max(float(np.mean(met)), 1e-3), 0.999)
    return int(np.clip(np.ceil(np.log(1 - FOUND) / np.log(1 - chance)), TABLES, MOST_TABLES)), scale


def _together(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether two rows of keys share one."""
    return np.array([np.isin(x, y).any() for x, y in zip(a, b, strict=True)])


def _unit(column: pa.Array) -> np.ndarray:
    """Unit vectors of rows that have one length."""
    v = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    # scaled by the largest component first: squares of very small or large ones stay finite
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _usable(vector: str):
    x = F.col(vector)
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    return F.coalesce(x.isNotNull() & ~bad & F.exists(x, lambda e: e != 0), F.lit(False))


def _verify(threshold: float):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_runs(batches, ("cell", "block"), 20_000):
            cell = rows["cell"].to_numpy()
            ids, copies = rows["id"].to_numpy(), rows["copies"].to_numpy()
            part, block = rows["part"].to_numpy(), rows["block"].to_numpy()
            vector = rows["vector"].combine_chunks()
            keys = rows["keys"].combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
            bounds = np.append(starts_of_runs(cell, block), len(ids))
            linked = np.zeros(len(ids), np.int64)
            left, right = [], []
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                if b - a < 2:
                    continue
                v = _unit(vector.slice(a, b - a))
                near = np.triu(v @ v.T >= threshold, 1)
                i, j = np.nonzero(near)
                if not len(i):
                    continue
                # in a cut cell, two members of one block meet in several groups: the first one counts
                mine = np.ones(len(i), bool)
                if part[a] >= 0:
                    one, two = divmod(int(block[a]), 1 << 31)
                    own = part[a + i]
                    lead = (one == 0) & ((own == two) | ((own == 0) & (two == 1)))
                    mine = (own != part[a + j]) | lead
                for at in range(0, len(i), 100_000):
                    x, y = a + i[at : at + 100_000], a + j[at : at + 100_000]
                    mine[at : at + 100_000] &= _first_shared(keys[x], keys[y]) == cell[a] & 0x7FFFFFFF
                x, y = a + i[mine], a + j[mine]
                np.add.at(linked, x, copies[y])
                np.add.at(linked, y, copies[x])
                p, q = _forest(near | near.T)
                left.append(ids[a + p])
                right.append(ids[a + q])
            some = np.flatnonzero(linked)
            p = np.concatenate(left) if left else np.zeros(0, np.int64)
            q = np.concatenate(right) if right else np.zeros(0, np.int64)
            none = np.zeros(len(p), np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([ids[some], p])), pa.array(np.concatenate([ids[some], q])), pa.array(np.concatenate([linked[some], none]))],
                ["a", "b", "n"],
            )

    return verify


def _first_shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest key that both rows hold; rows ascend."""
    least = np.full(len(a), np.iinfo(np.int32).max, np.int32)
    for k in range(a.shape[1] - 1, -1, -1):
        hit = (b == a[:, k : k + 1]).any(axis=1)
        least[hit] = a[hit, k]
    return least


def _forest(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of a boolean matrix of links."""
    left, right = [], []
    rest = np.flatnonzero(near.any(axis=1))
    while len(rest):
        queue, rest = [int(rest[0])], rest[1:]
        while queue and len(rest):
            x = queue.pop()
            ok = near[x, rest]
            new, rest = rest[ok], rest[~ok]
            queue += new.tolist()
            left.append(np.full(len(new), x))
            right.append(new)
    empty = np.zeros(0, np.int64)
    return (np.concatenate(left) if left else empty), (np.concatenate(right) if right else empty)


def near_duplicates(
    vectors: DataFrame,
    threshold: float = 0.95,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    tables: int | None = None,
    probed: int = PROBES,
    scale: float | None = None,
    blocks: int = BLOCKS,
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, a row for every row of ``vectors``.

    Links are the pairs found with a cosine of at least ``threshold``.  Tables
    and scale follow from the number of different vectors where they are not
    given; a pair just at 0.95 is found with a chance over 0.99 (64 dimensions).
    Vectors that are null, empty, zero, or hold a null or a
    non-finite component link with nothing, nor do vectors of different length.
    Equal vectors travel once with their number.  ``component_id`` is the
    smallest id that can be reached; it is null only where all ids are null,
    and such rows are not kept.  Rows of a repeated id are judged by their own
    vectors.  Other columns are ignored.
    """
    x, of = F.col(vector), F.col(vec_id).cast("long").alias("vec_id")
    rows = vectors.select(of, F.when(_usable(vector), x.cast("array<double>")).alias("vector"))
    points = rows.where("vector is not null").groupBy("vector").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    points = stored(points.withColumn("id", F.monotonically_increasing_id()), "vectors")
    n, dim = points.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    own_tables, own_scale = geometry(n, dim or 0, threshold, probed, blocks)
    tables, scale = tables or own_tables, scale or own_scale

    def with_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch["vector"].value_lengths().to_numpy()
            for dim in np.unique(sizes):
                part = batch.filter(pa.array(sizes == dim))
                for at in range(0, part.num_rows, 1000):
                    piece = part.slice(at, 1000)
                    keys = cell_keys(_unit(piece["vector"]), tables, probed, scale, blocks)
                    held = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, keys.shape[1], dtype=np.int32)), pa.array(keys.ravel()))
                    yield pa.RecordBatch.from_arrays([piece["id"], piece["copies"], piece["vector"], held], ["id", "copies", "vector", "keys"])

    keyed = points.select("id", "copies", "vector").mapInArrow(with_cells, "id long, copies long, vector array<double>, keys array<int>")
    keyed = stored(keyed.withColumn("vector", F.col("vector").cast("array<float>") if dict(vectors.dtypes)[vector] == "array<float>" else F.col("vector")), "cells")
    cell = F.explode(F.transform(F.array_distinct("keys"), lambda k: F.shiftleft(F.size("vector").cast("long"), 32) + k))
    members = in_blocks(keyed.withColumn("cell", cell), "cell", "id", BLOCK_WIDTH)
    found = stored(members.mapInArrow(_verify(threshold), "a long, b long, n long"), "links")
    linked = found.where("a = b").groupBy("a").agg(F.sum("n").alias("n"))
    moved = components(found.where("a != b"), "a", "b")
    grouped = (
        points.join(linked, points["id"] == linked["a"], "left")
        .join(moved, points["id"] == moved["node"], "left")
        .select("vector", "least", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component_id", "id").alias("group"))
    )
    least = grouped.groupBy("group").agg(F.min("least").alias("component_id"))
    named = grouped.join(least, "group").select(F.col("vector").alias("of"), "n_links", "component_id")
    out = rows.join(named, rows["vector"] == named["of"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.when(F.col("of").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
