"""Compression of vectors to short codes: a codebook for each part, entries found by a GNAT.

Vectors become integers and are cut into equal parts.  The entries of a part's
codebook stand in a geometric near-neighbour access tree: a few of them are split
points, every other entry belongs to the nearest split point, and each split
point knows the least and the greatest distance from itself to every group.
A part that measures its distance to a split point so loses whole groups, split
point included, that cannot hold a nearer entry.  Elimination is strict and
rounds against itself, distances that decide are integers, so the entry found
is the nearest, and of equally near ones the first, in every case.

A round of learning is one pass over the stored integers: sums and numbers of
each entry's parts, added up in the tasks.  What reaches the driver are as many
numbers as the codebooks have, whatever the number of vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seasongrid.llm.common import stored, unique_name

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
#: Split points of a node; a node with no more entries than this has no groups.
DEGREE = 4
#: Relative error that covers the rounding of a root and of a sum.
_SLACK = 1e-12
_FAR = np.iinfo(np.int64).max


# ---------------------------------------------------------------- the tree


@dataclass
class Node:
    """``low`` and ``high`` have a row a split point and a column a group: distances, rounded outwards."""

    splits: list[int]
    low: np.ndarray
    high: np.ndarray
    groups: list[Node | None] = field(default_factory=list)


def _squares(points: np.ndarray, point: np.ndarray) -> np.ndarray:
    off = points - point
    return np.einsum("ij,ij->i", off, off)


def build(entries: np.ndarray, among: list[int] | None = None, degree: int = DEGREE) -> Node | None:
    """The tree over the rows of ``entries``: split points far from each other, groups by the nearest one."""
    among = list(range(len(entries))) if among is None else among
    if not among:
        return None
    splits = [among[0]]
    nearest = _squares(entries[among], entries[among[0]])
    owner = np.zeros(len(among), np.int64)
    while len(splits) < min(degree, len(among)):
        taken = np.isin(among, splits)
        nxt = int(np.argmax(np.where(taken, -1, nearest)))
        d = _squares(entries[among], entries[among[nxt]])
        owner[d < nearest] = len(splits)
        nearest = np.minimum(nearest, d)
        splits.append(among[nxt])
    members = [[s] for s in splits]
    rest: list[list[int]] = [[] for _ in splits]
    for e, o in zip(among, owner.tolist(), strict=True):
        if e not in splits:
            members[o].append(e)
            rest[o].append(e)
    away = [[np.sqrt(_squares(entries[m], entries[s]).astype(float)) for m in members] for s in splits]
    low = np.array([[d.min() for d in row] for row in away]) * (1 - _SLACK)
    high = np.array([[d.max() for d in row] for row in away]) * (1 + _SLACK)
    return Node(splits, low, high, [build(entries, r, degree) for r in rest])


def nearest_entries(points: np.ndarray, entries: np.ndarray, tree: Node | None, measured: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of every point, ties to the lower index, and the squared distance.

    ``measured`` collects the number of distances that were computed.
    """
    best = np.full(len(points), _FAR, np.int64)
    index = np.full(len(points), len(entries), np.int64)

    def visit(node: Node, rows: np.ndarray) -> None:
        alive = np.ones((len(rows), len(node.splits)), bool)
        for i, entry in enumerate(node.splits):
            at = np.flatnonzero(alive[:, i])
            if not len(at):
                continue
            of = rows[at]
            d = _squares(points[of], entries[entry])
            if measured is not None:
                measured.append(len(of))
            nearer = (d < best[of]) | ((d == best[of]) & (entry < index[of]))
            best[of[nearer]], index[of[nearer]] = d[nearer], entry
            root = np.sqrt(d.astype(float))
            reach = np.sqrt(best[of].astype(float)) * (1 + _SLACK)
            for j in range(len(node.splits)):  # an entry at just the best distance may have a lower index: it stays
                out = (root * (1 - _SLACK) - node.high[i, j] > reach) | (node.low[i, j] - root * (1 + _SLACK) > reach)
                alive[at[out], j] = False
        for j, group in enumerate(node.groups):
            if group is not None and alive[:, j].any():
                visit(group, rows[alive[:, j]])

    if tree is not None and len(points):
        visit(tree, np.arange(len(points)))
    return index, best


# ---------------------------------------------------------------- integers


def _whole(vec: str) -> str:
    return f"{vec} is not null and not exists({vec}, x -> x is null or isnan(x) or abs(x) = double('infinity'))"


def integers(vectors: DataFrame, vector: str, parts: int = PARTS, scale: int = SCALE, keep: tuple[str, ...] = ()) -> tuple[DataFrame, int]:
    """The rows with a usable vector: ``keep`` and ``ints``, all of one length that ``parts`` divides; and that length."""
    taken = vectors.select(*[F.col(c) for c in keep], F.col(vector).cast("array<double>").alias("v")).where(_whole("v"))
    longest = taken.agg(F.max(F.size("v"))).first()[0] or 0
    size = -(-longest // parts) * parts
    # the squared distance of two vectors must fit 64 bits
    bound = int((2**62 / max(size, 1)) ** 0.5 / 2)
    ints = F.expr(f"transform(v, x -> cast(floor(greatest(least(x * {scale}D, {bound}D), -{bound}D)) as int))")
    pad = F.expr(f"array_repeat(0, {size} - size(v))")
    return taken.select(*keep, F.concat(ints, pad).alias("ints")), size


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), size).astype(np.int64)


# ---------------------------------------------------------------- codebooks


def _start(rows: DataFrame, size: int, parts: int, entries: int) -> np.ndarray:
    """The first rows by id (null last), then by vector; ``entries`` rows reach the driver."""
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "ints").limit(entries).select("ints").collect()
    books = np.array([r[0] for r in first], np.int64).reshape(len(first), parts, size // parts)
    return books.transpose(1, 0, 2)


def _sums(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """``(part, entry, place, total, n)`` over all rows; a task gives one row for each number of the codebooks."""
    parts, entries, width = books.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [build(b) for b in books]
        total, n = np.zeros(books.shape, np.int64), np.zeros((parts, entries), np.int64)

        def emitted() -> pa.RecordBatch:
            p, e = np.nonzero(n)
            place = np.tile(np.arange(width), len(p))
            columns = [np.repeat(p, width), np.repeat(e, width), place, total[p, e].ravel(), np.repeat(n[p, e], width)]
            return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["part", "entry", "place", "total", "n"])

        seen = 0
        for batch in batches:
            points = _matrix(batch["ints"], parts * width)
            for p in range(parts):
                mine = points[:, p * width : (p + 1) * width]
                index, _ = nearest_entries(mine, books[p], trees[p])
                np.add.at(total[p], index, mine)
                n[p] += np.bincount(index, minlength=entries)
            seen += batch.num_rows
            if seen > 1 << 30:  # before a sum of numbers below 2**31 could pass 64 bits
                yield emitted()
                total[:], n[:], seen = 0, 0, 0
        yield emitted()

    summed = rows.select("ints").mapInArrow(add, "part long, entry long, place long, total long, n long")
    return summed.groupBy("part", "entry", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))


def learn(rows: DataFrame, size: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks of integers, (part, entry, place), after ``rounds`` rounds over all rows; entries without a part stay."""
    books = _start(rows, size, parts, entries)
    if books.size == 0:
        return books
    for _ in range(rounds):
        for part, entry, place, total, n in _sums(rows, books).collect():
            books[part, entry, place] = int(total) // n
    return books


def codes(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """``rows`` without ``ints``, with ``code`` and ``error``."""
    parts, _, width = books.shape
    schema = rows.drop("ints").schema.add("code", "string").add("error", "long")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [build(b) for b in books]
        for batch in batches:
            points = _matrix(batch["ints"], parts * width)
            found = np.zeros((len(points), parts), np.uint8)
            error = np.zeros(len(points), np.int64)
            for p in range(parts):
                index, d = nearest_entries(points[:, p * width : (p + 1) * width], books[p], trees[p])
                found[:, p] = index
                error += d
            text = [row.tobytes().hex() for row in found]
            kept = [batch[c] for c in schema.names[:-2]]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(text, pa.string()), pa.array(error)], schema.names)

    return rows.select(*schema.names[:-2], "ints").mapInArrow(encode, schema)


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``(vec_id, code, error, label_error, codebooks_sha256)``, a row for every usable vector.

    Vectors that are null or hold null or non-finite components have no row.
    The others are padded with zeros to the length of the longest, rounded up to
    a multiple of the parts; an empty vector is a zero vector.  A component
    beyond what squared distances in 64 bits allow (32,768 at 64 components)
    counts as that bound.  Rows of a repeated id are coded each, and each counts
    among the first; rows with a null id come after all others, equal ids go by
    their vectors.  Fewer rows than entries make smaller codebooks.  A label's
    error beyond 64 bits is null.  Other columns are ignored, whatever their
    names; an empty table gives no rows.
    """
    named = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    rows, size = integers(named, "vector", keep=("vec_id", "label"))
    rows = stored(rows, "integers")
    if size == 0:  # nothing, or empty vectors only: all alike, and near the first entry
        books = np.zeros((PARTS, min(1, rows.limit(1).count()), 0), np.int64)
    else:
        books = learn(rows, size)
    coded = stored(codes(rows, books), "codes")
    total = coded.groupBy("label").agg(F.expr("try_cast(sum(cast(error as decimal(38,0))) as bigint)").alias("label_error"))
    of = total.select(F.col("label").alias(unique_name(coded, "of")), "label_error")
    joined = coded.join(of, F.col("label").eqNullSafe(F.col("of")), "left")
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
