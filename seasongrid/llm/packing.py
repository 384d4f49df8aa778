"""Hierarchical packing of token sequences into several context sizes.

Documents longer than the largest window give whole windows of it; what
remains is routed to the smallest tier that holds it.  Each tier packs its own
pieces, the longest tier first: a piece opens a window, and its gap is filled
from the shorter tiers, whole pieces as long as one fits, then one cut to fit.
So every window is full.  What is left when a task ends is cut at powers of
two.  Windows of one size form step groups of equal token numbers, numbered
over all tasks: the written pieces tell how many windows of each size each task
made, and a running sum over these few numbers places a task's windows behind
those of the tasks before it.

A task packs the documents it reads, in one pass and without a shuffle; it holds
no more than one batch of documents and what their shorter tiers left open.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seasongrid.llm.common import crc, stored, trim_memory
from seasongrid.llm.tokens import ENCODED, encoder, groups, tokenizer_path, with_end

TIERS = (256, 512, 1024, 2048, 4096)
#: Tokens of one step: a step group holds as many windows of one tier as fit.
STEP_TOKENS = 1 << 19
#: Rows of one task have sequence ids of their own range.
_PER_TASK = 1 << 36
SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long,"
    " context int, step_group long, ids array<int>"
)


class Packer:
    """Packs pieces ``(doc, start, length)`` into windows; windows leave by :meth:`take`."""

    def __init__(self, tiers: tuple[int, ...] = TIERS) -> None:
        self.tiers = tuple(sorted(tiers))
        self.open: list[deque] = [deque() for _ in self.tiers]
        self.waiting = 0
        self.full: list[tuple[int, list]] = []

    def _tier(self, length: int) -> int:
        return next(i for i, t in enumerate(self.tiers) if length <= t)

    def add(self, doc, length: int) -> None:
        largest, start = self.tiers[-1], 0
        while length - start >= largest:
            self.full.append((largest, [(doc, start, largest)]))
            start += largest
        if length > start:
            self._queue((doc, start, length - start))

    def _queue(self, piece: tuple, front: bool = False) -> None:
        queue = self.open[self._tier(piece[2])]
        queue.appendleft(piece) if front else queue.append(piece)
        self.waiting += piece[2]

    def _pop(self, tier: int) -> tuple:
        piece = self.open[tier].popleft()
        self.waiting -= piece[2]
        return piece

    def _fill(self, pieces: list, gap: int, below: int) -> int:
        """Fill a gap from the tiers up to ``below``: whole pieces, the longest tiers first, then a cut one."""
        for tier in range(below, -1, -1):
            while gap and self.open[tier] and self.open[tier][0][2] <= gap:
                piece = self._pop(tier)
                pieces.append(piece)
                gap -= piece[2]
        for tier in range(below + 1):
            if gap and self.open[tier]:
                doc, start, length = self._pop(tier)
                pieces.append((doc, start, gap))
                self._queue((doc, start + gap, length - gap), front=True)
                return 0
        return gap

    def pack(self, keep: int) -> None:
        """Close windows as long as more than ``keep`` tokens wait."""
        for tier in range(len(self.tiers) - 1, -1, -1):
            size = self.tiers[tier]
            while self.open[tier] and self.waiting >= max(size, keep):
                first = self._pop(tier)
                pieces, gap = [first], size - first[2]
                gap = self._fill(pieces, gap, tier)
                if gap:  # only longer tiers are left
                    gap = self._fill(pieces, gap, len(self.tiers) - 1)
                self.full.append((size, pieces))

    def finish(self) -> None:
        """Close all windows; the last tokens go to windows at powers of two."""
        self.pack(0)
        while self.waiting:
            size = min(self.tiers[-1], 1 << (self.waiting.bit_length() - 1))
            pieces: list = []
            self._fill(pieces, size, len(self.tiers) - 1)
            self.full.append((size, pieces))

    def take(self) -> list[tuple[int, list]]:
        full, self.full = self.full, []
        return full


def pack(
    docs: DataFrame,
    tokenizer: str | None = None,
    end_id: int | None = 2,
    tiers: tuple[int, ...] = TIERS,
    step_tokens: int = STEP_TOKENS,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """Pieces of all documents: which ids lie where in which sequence.

    ``sequence_id`` names a window of ``context`` ids, in which the pieces'
    offsets have no gap; every window is full.  ``step_group`` collects windows
    of one context of ``step_tokens`` ids in all, so steps cost alike; of each
    context the last group only may have fewer.  ``ids`` are the piece's.  Null
    texts count as empty; with ``end_id`` None they have no piece.  Rows of a
    repeated id are packed each on its own.  Other columns are ignored; an empty
    table has no pieces.
    """
    path = tokenizer or tokenizer_path()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trim_memory()
        encode, packer = encoder(path).encode, Packer(tiers)
        base = TaskContext.get().partitionId() * _PER_TASK
        number, per_tier = 0, {}

        def rows() -> Iterator[pa.RecordBatch]:
            nonlocal number
            out: list[tuple] = []
            data: list[bytes] = []
            for size, pieces in packer.take():
                place = per_tier.get(size, 0)
                per_tier[size] = place + 1
                offset = 0
                for (doc, ids, total), start, length in pieces:
                    part = ids[4 * start : 4 * (start + length)]
                    out.append((doc, start, length, crc(part), total, base + number, offset, size, place))
                    data.append(part)
                    offset += length
                number += 1
            columns = list(zip(*out, strict=True)) if out else [()] * 9
            kinds = [pa.int64()] * 7 + [pa.int32(), pa.int64()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            sizes = np.array([len(x) // 4 for x in data], np.int32)
            values = pa.Array.from_buffers(pa.int32(), int(sizes.sum()), [None, pa.py_buffer(b"".join(data))])
            arrays.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), values))
            yield pa.RecordBatch.from_arrays(arrays, [f.split()[0] for f in SCHEMA.split(",")])

        for batch in batches:
            for a, b in groups(batch["t"], ENCODED):
                part = batch.slice(a, b - a)
                offsets, ids = with_end(*encode(part["t"]), end_id)
                docs = part["d"].to_pylist()
                for c, d in groups(part["t"], 2 << 20):
                    data, at = ids[offsets[c] : offsets[d]].tobytes(), (offsets[c : d + 1] - offsets[c]).tolist()
                    for doc, x, y in zip(docs[c:d], at[:-1], at[1:], strict=True):
                        packer.add((doc, data[4 * x : 4 * y], y - x), y - x)
                    packer.pack(4 * packer.tiers[-1])
                    yield from rows()
        packer.finish()
        yield from rows()
        trim_memory()

    source = docs.select(F.col(doc_id).cast("long").alias("d"), F.col(text).cast("string").alias("t"))
    return _step_groups(stored(source.mapInArrow(packed, SCHEMA), "pieces"), step_tokens)


def _task(sequence_id: str) -> Column:
    return F.floor(F.col(sequence_id) / F.lit(_PER_TASK)).cast("long")


def _step_groups(pieces: DataFrame, step_tokens: int) -> DataFrame:
    """Step groups from each window's place among those of its context and task, which ``step_group`` holds before."""
    windows = pieces.where("offset = 0").groupBy(_task("sequence_id").alias("_task"), F.col("context").alias("_context"))
    made = windows.agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("_context").orderBy("_task")
    before = made.select("_task", "_context", (F.sum("_n").over(earlier) - F.col("_n")).alias("_before"))
    before = stored(before, "places")  # a few rows a task: by their true size the pieces need not move for this join
    same = (_task("sequence_id") == F.col("_task")) & (F.col("context") == F.col("_context"))
    per_step = F.greatest(F.lit(1), F.floor(F.lit(step_tokens) / F.col("context")))
    step = F.floor((F.col("_before") + F.col("step_group")) / per_step).cast("long")
    size = F.length(F.bin(F.col("context").cast("long")))
    group = (step * 64 + size).alias("step_group")
    columns = [group if name == "step_group" else F.col(name) for name in pieces.columns]
    return pieces.join(before, same).select(*columns)


def digests(pieces: DataFrame) -> DataFrame:
    """Pieces without ``ids``, their ``ids_crc32`` taken from these."""
    kept = [c for c in pieces.columns if c not in ("ids", "ids_crc32")]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["ids"]
            offsets = ids.offsets.to_numpy()
            data = memoryview(ids.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)).cast("B")
            found = [crc(bytes(data[4 * a : 4 * b])) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in kept], pa.array(found, pa.int64())], [*kept, "ids_crc32"])

    schema = pieces.select(*kept).schema.add("ids_crc32", "long")
    return pieces.select(*kept, "ids").mapInArrow(sums, schema)
