"""SimHash near-duplicates: fingerprints, candidate search on segment bit counts, groups.

A fingerprint's 64 bits are cut into 32 segments of two.  The vector of bit
counts per segment is the embedding: flipping one bit moves it by one, so the
Manhattan distance of two vectors never exceeds the fingerprints' bit distance.
The range join at Manhattan distance ``d`` runs on grids: the segments form
``d + 3`` groups, of which at least three are equal in any two vectors within
``d``; each choice of three groups is a grid whose cells are their counts.
Members of a cell are compared by Manhattan distance, then by exact distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from seasongrid.llm.blocks import WIDTH, in_blocks
from seasongrid.llm.common import document_key, release_memory, starts_of_runs, stored, trim_memory, unique_name, whole_runs
from seasongrid.llm.components import components

SEED = 42
_LOW = 0x5555555555555555
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str | None, size: int = 4) -> int:
    """The fingerprint of one text as an unsigned number; no words give zero."""
    import xxhash

    # bytes.split() cuts at exactly the six ASCII white-space characters
    words = (text or "").encode("utf-8", "replace").translate(_LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    if len(words) < size:
        hashes = [digest(line, SEED)]
    else:
        hashes = [digest(line[a:b], SEED) for a, b in zip(starts, ends[size - 1 :].tolist(), strict=False)]
    bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
    ones = np.add.reduce(bits, axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = 4, *also: Column) -> DataFrame:
    """``(doc_id, fp)`` and the columns of ``also``: whole texts, ``fp`` as a signed 64-bit number."""

    @F.arrow_udf("long")
    def of(column: pa.Array) -> pa.Array:
        trim_memory()
        found = np.fromiter((fingerprint(t.as_py(), size) for t in column), np.uint64, len(column))
        return pa.array(found.view(np.int64))

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), of(F.col(text).cast("string")).alias("fp"), *also)


def bit_counts(x):
    """A column (or number array) of counts per segment, each written as that many ones.

    Two counts 0, 1, 2 become 00, 01, 11, so that the bits in which two values
    differ number their Manhattan distance.
    """
    if isinstance(x, np.ndarray):
        low, up = np.uint64(_LOW), x >> np.uint64(1)
        return ((x & up & low) << np.uint64(1)) | ((x | up) & low)
    low, up = F.lit(_LOW), F.shiftrightunsigned(x, 1)
    return F.shiftleft(x.bitwiseAND(up).bitwiseAND(low), 1).bitwiseOR(x.bitwiseOR(up).bitwiseAND(low))


def grids(distance: int, equal: int = 3) -> list[int]:
    """Bit masks of the grids, as signed numbers."""
    parts = np.array_split(np.arange(32), distance + equal)
    masks = []
    for chosen in combinations(parts, equal):
        mask = sum(3 << (2 * int(s)) for s in np.concatenate(chosen))
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    return masks


def _chains(ids: np.ndarray, fps: np.ndarray, distance: int, bounds: np.ndarray) -> tuple[list, list]:
    """Links that connect, within every run, whatever its members' links connect."""
    counts = bit_counts(fps)

    def near(a, b):
        ok = np.bitwise_count(counts[a] ^ counts[b]) <= distance
        return ok & (np.bitwise_count(fps[a] ^ fps[b]) <= distance)

    left, right = [], []
    sizes = np.diff(bounds)
    start = np.repeat(bounds[:-1], sizes)
    end = np.repeat(bounds[1:], sizes)
    small = end - start <= 32
    at = np.flatnonzero(small)
    for step in range(1, 32):  # all pairs of short runs, a distance in rows at a time
        at = at[at + step < end[at]]
        if not len(at):
            break
        hit = at[near(at, at + step)]
        left.append(ids[hit])
        right.append(ids[hit + step])
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a <= 32:
            continue
        rest = np.arange(a, b)  # of a long run a spanning forest is enough
        while len(rest):
            queue, rest = [int(rest[0])], rest[1:]
            while queue and len(rest):
                x = queue.pop()
                ok = near(x, rest)
                new, rest = rest[ok], rest[~ok]
                queue += new.tolist()
                left.append(np.full(len(new), ids[x]))
                right.append(ids[new])
    return left, right


def links(points: DataFrame, distance: int, width: int = WIDTH) -> DataFrame:
    """Pairs ``(a, b)`` of fingerprints that connect what all links within ``distance`` connect.

    ``points`` has each fingerprint once, as ``fp``.
    """
    counts = bit_counts(F.col("fp"))
    cells = F.explode(F.array(*[F.xxhash64(F.lit(i), counts.bitwiseAND(F.lit(m))) for i, m in enumerate(grids(distance))]))
    members = in_blocks(points.select("fp", cells.alias("cell")), "cell", "fp", width)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        for rows in whole_runs(batches, ("cell", "block")):
            ids = rows["fp"].to_numpy()
            bounds = np.append(starts_of_runs(rows["cell"].to_numpy(), rows["block"].to_numpy()), len(ids))
            left, right = _chains(ids, ids.view(np.uint64), distance, bounds)
            if left:
                pairs = np.unique(np.stack([np.concatenate(left), np.concatenate(right)], axis=1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    return members.mapInArrow(verify, "a long, b long")


def _components(found: DataFrame, least: Column, distance: int) -> DataFrame:
    """``(of, component_id)``: of each fingerprint the minimum ``least`` of all rows of its component."""
    points = stored(found.groupBy("fp").agg(F.min(least).alias("least")), "points")
    moved = components(links(points, distance), "a", "b")
    grouped = points.join(moved, points["fp"] == moved["node"], "left").select("fp", "least", F.coalesce("component_id", "fp").alias("group"))
    named = grouped.groupBy("group").agg(F.min("least").alias("component_id"))
    return grouped.select(F.col("fp").alias("of"), "group").join(named, "group").select("of", "component_id")


def near_duplicates(docs: DataFrame, distance: int = 4, size: int = 4, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, a row for every row of ``docs``.

    Fingerprints within ``distance`` bits link; ``component_id`` is the smallest
    id that can be reached, the row's own included.  Null texts, empty texts and
    texts of white space have fingerprint zero and link like any other.  A null
    id is never a smallest one, so a group of null ids alone has a null
    ``component_id``; rows of a repeated id are judged by their own texts.
    Other columns are ignored.
    """
    found = stored(fingerprints(docs, text, doc_id, size), "fingerprints")
    of_point = _components(found, F.col("doc_id"), distance)
    return found.join(of_point, found["fp"] == of_point["of"]).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def without_copies(docs: DataFrame, distance: int = 4, size: int = 4, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with exactly one row of each component that :func:`near_duplicates` links.

    It is the row with the smallest id (null after all others), then the smallest
    hash of its text.  Rows of a repeated or null id are judged and removed by
    their own texts; of rows with equal id and text, the first by their columns
    stays.  An empty table gives an empty one.
    """
    found = stored(fingerprints(docs, text, doc_id, size, document_key(text, doc_id).alias("key")), "fingerprints")
    own = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "key")
    of_point = _components(found, own, distance)
    first = F.col("doc_id").eqNullSafe(F.col("component_id.doc_id")) & (F.col("key") == F.col("component_id.key"))
    copies = found.join(of_point, found["fp"] == of_point["of"]).where(~first).select(F.coalesce("doc_id", F.lit(0)).alias("_of"), F.col("key").alias("_same"))
    copies = stored(copies, "near-duplicates")
    id_, key, place = (unique_name(docs, n) for n in ("_id", "_key", "_place"))
    keyed = docs.withColumn(id_, F.coalesce(F.col(doc_id).cast("long"), F.lit(0))).withColumn(key, document_key(text, doc_id))
    by = [F.col(c) for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    # one row of each id and text before the join, so that a hot one does not travel
    single = keyed.withColumn(place, F.row_number().over(Window.partitionBy(id_, key).orderBy(*by))).where(F.col(place) == 1)
    return single.join(copies, (single[id_] == copies["_of"]) & (single[key] == copies["_same"]), "left_anti").drop(id_, key, place)
