"""Exact removal of repeated passages by suffix arrays.

A passage is a string of ``window`` bytes; every byte under a passage that also
starts earlier goes.  Three steps find the repeats of a corpus of any size:

1. Every window has a key, the least hash of its 32-byte strings; neighbouring
   windows mostly share it, so a text becomes runs of windows with one key.
   Equal windows have equal keys.  Runs whose key occurs nowhere else are done.
2. For the others, the bytes under a run travel to the key's task.  Runs with
   the same bytes are one run there, in fact already before they travel.
3. A suffix array of the runs that met is built by two-stage sorting: suffixes
   smaller than their successor are sorted directly, the others are induced by
   scanning the buckets of first bytes in order.  Neighbours in it with a
   common prefix of ``window`` bytes are repeats; the first by (doc_id,
   position) stays.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seasongrid.llm.common import mix, release_memory, starts_of_runs, stored, trim_memory, unique_name, whole_runs
from seasongrid.llm.tokens import groups

WINDOW = 100
GRAM = 32
#: Window starts that are hashed at once; a longer text is taken in overlapping parts.
PART = 1 << 20
#: Runs that are sorted and sent on together, about.
RUNS = 1 << 17
#: Contexts, and their bytes, that meet in one suffix array, about; a key's contexts stay together.
CONTEXTS = 10_000
ROOM = 1 << 20
#: A key with more different contexts than this, or more bytes in them, is cut into its windows.
HOT_KEY = 20_000
HOT_ROOM = 4 << 20
_LEAST = -(1 << 63)


# ---------------------------------------------------------------- runs of windows


def _words(b: np.ndarray) -> np.ndarray:
    """The eight bytes at every position as one number; shorter by 7 than ``b``."""
    x = b.astype(np.uint64)
    for n in (1, 2, 4):
        x = x[:-n] | x[n:] << np.uint64(8 * n)
    return x


def _grams(b: np.ndarray, size: int = GRAM) -> np.ndarray:
    """A hash of the ``size`` bytes (32 at least) at every position where they end in ``b``."""
    x = _words(b)
    x = mix(x[:-8], x[8:])
    x, have = mix(x[:-16], x[16:]), 32
    while have < size:
        step = min(have, size - have)
        x, have = mix(x[:-step], x[step:]), have + step
    return x


def _least(h: np.ndarray, width: int) -> np.ndarray:
    """Sliding minimum."""
    have = 1
    while 2 * have <= width:
        h = np.minimum(h[:-have], h[have:])
        have *= 2
    return np.minimum(h[: len(h) - (width - have)], h[width - have :]) if width > have else h


def runs(b: np.ndarray, starts: np.ndarray, ends: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Runs of equal keys: ``(text, first start, last start, key, twice)``, starts counted in ``b``.

    ``starts`` and ``ends`` are the texts in ``b``, one after the other.  ``twice``
    says whether the string of the key occurs more than once below the run, as it
    must where windows of one run are equal.
    """
    long = np.flatnonzero(ends - starts >= window)
    none = np.zeros(0, np.int64)
    if not len(long):
        return none, none, none, none, none.astype(bool)
    hashes, width = _grams(b, gram), window - gram + 1
    key = _least(hashes, width)
    first, last = starts[long], ends[long] - window
    valid = np.zeros(len(key) + 1, np.int8)
    np.add.at(valid, first, 1)
    np.add.at(valid, last + 1, -1)
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    new[first] = True
    new &= np.cumsum(valid[:-1], dtype=np.int8) > 0
    lo = np.flatnonzero(new)
    text = np.searchsorted(first, lo, "right") - 1
    hi = np.minimum(np.append(lo[1:] - 1, last[-1]), last[text])
    below = np.lib.stride_tricks.sliding_window_view(hashes, width)
    left, right = below[lo] == key[lo][:, None], below[hi] == key[lo][:, None]
    twice = (left.sum(axis=1) > 1) | (right.sum(axis=1) > 1) | (lo + left.argmax(axis=1) != hi + right.argmax(axis=1))
    return long[text], lo, hi, key[lo].view(np.int64), twice


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column without nulls."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(column.buffers()[2] or b"", np.uint8), offsets


def _runs_of(column: pa.Array, window: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Runs with starts counted from the start of each text, in parts of bounded size."""
    data, offsets = _buffers(column)
    for a, b in groups(column, PART // 2):
        starts, ends = offsets[a:b], offsets[a + 1 : b + 1]
        base = starts[0]
        if ends[-1] - base <= 2 * PART:
            text, lo, hi, key, twice = runs(data[base : ends[-1]], starts - base, ends - base, window)
            yield text + a, lo - (starts - base)[text], hi - (starts - base)[text], key, twice
            continue
        for i in range(a, b):
            for at in range(0, max(1, int(offsets[i + 1] - offsets[i]) - window + 1), PART):
                part = data[offsets[i] + at : min(offsets[i] + at + PART + window - 1, offsets[i + 1])]
                text, lo, hi, key, twice = runs(part, np.array([0]), np.array([len(part)]), window)
                yield text + i, lo + at, hi + at, key, twice


def _tag(hashes):
    """Nine bits of a text's hash, beside the 64 of ``doc``."""
    return hashes & 511


def _all_runs(docs: DataFrame, window: int) -> DataFrame:
    """``(to, doc, span)``: every run, to be dealt out by ``to``.

    Of the runs of one key that are sent on together the first goes to the key's task; the
    others are known to be repeated, so they go anywhere, which spreads hot
    keys.  ``span`` packs the first start, some bits of the text's hash, whether
    the key's string is below the run twice, the number of windows less one, and
    whether the key is known to be repeated.
    """

    def sent(batch: pa.RecordBatch, parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        text, lo, hi, key, twice = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = starts_of_runs(key)
        sizes = np.diff(np.append(first, len(key)))
        extra = np.repeat(sizes > 1, sizes)
        twice = twice[order]
        many = extra | twice
        extra[first] = False
        to = key.copy()
        to[extra] = mix(key[extra].view(np.uint64), np.flatnonzero(extra).astype(np.uint64)).view(np.int64)
        span = lo[order] << 32 | twice.astype(np.int64) << 22 | (hi - lo)[order] << 1 | many
        text = text[order]
        span |= _tag(batch["hash"].to_numpy())[text] << 23
        return pa.RecordBatch.from_arrays([pa.array(to), pa.array(batch["doc"].to_numpy()[text]), pa.array(span)], ["to", "doc", "span"])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        for batch in batches:
            held, size = [], 0
            for part in _runs_of(batch["text"], window):
                held.append(part)
                size += len(part[0])
                if size >= RUNS:
                    yield sent(batch, held)
                    held, size = [], 0
            if size:
                yield sent(batch, held)

    return docs.select("doc", "hash", "text").mapInArrow(find, "to long, doc long, span long")


def _repeated_runs(found: DataFrame) -> DataFrame:
    """``(doc, span)`` of the runs whose key occurs more than once."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        for rows in whole_runs(batches, ("to",)):
            to, span = rows["to"].to_numpy(), rows["span"].to_numpy()
            first = starts_of_runs(to)
            sizes = np.diff(np.append(first, len(to)))
            chosen = np.repeat(sizes > 1, sizes) | (span & 1 == 1)
            if chosen.any():
                yield pa.RecordBatch.from_arrays([pa.array(rows["doc"].to_numpy()[chosen]), pa.array(span[chosen])], ["doc", "span"])

    return found.repartition("to").sortWithinPartitions("to").mapInArrow(keep, "doc long, span long")


# ---------------------------------------------------------------- suffix arrays


def suffix_array(t: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``t`` (bytes) in the order of their suffixes, exact for ``depth`` bytes at least.

    Two-stage sorting.  A suffix is of the small kind if it is smaller than its
    successor, which the next different byte decides; those are sorted as
    strings.  In the bucket of a first byte, the other kind comes first, ordered
    by the places of its successors: they lie in earlier buckets, or, where the
    byte repeats, among the suffixes of the same bucket with a shorter repeat.
    """
    n = len(t)
    if n == 0:
        return np.zeros(0, np.int64)
    ends = np.append(np.flatnonzero(t[1:] != t[:-1]), n - 1)  # of stretches of one byte
    after = np.append(t[1:], np.uint8(0))
    small_end = t[ends] < after[ends]
    small_end[-1] = False  # the last suffix is larger than the empty one after it
    sizes = np.diff(np.concatenate([[-1], ends]))
    small = np.repeat(small_end, sizes)
    repeat = np.repeat(ends, sizes) - np.arange(n)  # same bytes that follow

    strings = np.ndarray((n,), f"S{depth}", np.concatenate([t, np.zeros(depth, np.uint8)]).data, strides=(1,))
    directly = np.flatnonzero(small)
    directly = directly[np.argsort(strings[directly], kind="stable")]

    heads = np.concatenate([[0], np.cumsum(np.bincount(t, minlength=256))])
    larger = np.bincount(t[~small], minlength=256)
    place = np.empty(n + 1, np.int64)
    place[n] = -1  # the empty suffix
    of = t[directly]
    within = np.arange(len(of)) - np.searchsorted(of, of, "left")
    place[directly] = heads[of] + larger[of] + within

    rest = np.flatnonzero(~small)
    rest = rest[np.lexsort((repeat[rest], t[rest]))]
    bounds = np.append(starts_of_runs(t[rest], repeat[rest]), len(rest))
    done = np.zeros(256, np.int64)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):  # bucket by bucket
        part = rest[a:b]
        part = part[np.argsort(place[part + 1], kind="stable")]
        c = int(t[part[0]])
        place[part] = heads[c] + done[c] + np.arange(b - a)
        done[c] += b - a
    order = np.empty(n, np.int64)
    order[place[:n]] = np.arange(n)
    return order


def common_prefixes(t: np.ndarray, order: np.ndarray, limit: int) -> np.ndarray:
    """Length of the common prefix of each position in ``order`` with the one before, up to ``limit``."""
    words = _words(np.concatenate([t, np.zeros(limit + 16, np.uint8)]))
    out = np.zeros(len(order), np.int64)
    at = np.arange(1, len(order))
    for step in range(0, limit, 8):
        x = words[order[at] + step] ^ words[order[at - 1] + step]
        same = np.where(x == 0, 8, np.bitwise_count((x & (~x + np.uint64(1))) - np.uint64(1)) // 8)
        out[at] += same
        at = at[x == 0]
        if not len(at):
            break
    return np.minimum(out, limit)


def repeats(contexts: list[bytes], window: int = WINDOW) -> list[list[tuple[int, int]]]:
    """For each of several byte strings the ranges of window starts that occur before.

    Before means in an earlier string, or further left in the same one.
    """
    if not contexts:
        return []
    t = np.frombuffer(b"\x00".join(contexts) + b"\x00", np.uint8)
    sizes = np.array([len(c) for c in contexts], np.int64)
    starts = np.cumsum(sizes + 1) - (sizes + 1)
    order = suffix_array(t, (window + 7) // 8 * 8)
    owner = np.searchsorted(starts, order, "right") - 1
    order = order[order + window <= starts[owner] + sizes[owner]]
    out: list[list[tuple[int, int]]] = [[] for _ in contexts]
    if not len(order):
        return out
    first = np.flatnonzero(common_prefixes(t, order, window) < window)
    least = np.repeat(np.minimum.reduceat(order, first), np.diff(np.append(first, len(order))))
    again = np.sort(order[order != least])
    if len(again):
        owner = np.searchsorted(starts, again, "right") - 1
        cuts = np.append(starts_of_runs(again - np.arange(len(again)), owner), len(again))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            i = int(owner[a])
            out[i].append((int(again[a] - starts[i]), int(again[b - 1] - starts[i])))
    return out


# ---------------------------------------------------------------- the corpus

_CONTEXT = "key long, id long, hash long, lo long, hi long, twice boolean, bytes binary"
_FIELDS = [f.split()[0] for f in _CONTEXT.split(", ")]
_KINDS = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(_KINDS)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _KINDS, strict=True)], _FIELDS)


def _collapsed(rows: list[tuple]) -> tuple[list[tuple], list[tuple]]:
    """Of rows with equal key and bytes the first by id, hash and start, and the others without bytes."""
    first: dict[tuple, tuple] = {}
    again = []
    for row in sorted(rows, key=lambda r: r[1:4]):
        one = first.setdefault((row[0], row[6]), row)
        if one[1:4] != row[1:4]:  # else it is the same place of a repeated row
            again.append((row[1] ^ row[3], *row[1:6], None))
    return list(first.values()), again


def _contexts(docs: DataFrame, repeated: DataFrame, window: int) -> DataFrame:
    """Rows of ``_CONTEXT``: the bytes under repeated runs; without bytes, ranges known to be repeats."""
    spans = repeated.groupBy(F.col("doc").alias("of")).agg(F.collect_set("span").alias("spans"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        for batch in batches:
            for a, b in groups(batch["text"], 8 << 20):
                part = batch.slice(a, b - a)
                rows = []
                for id_, hash_, text, held in zip(*(part[c].to_pylist() for c in ("id", "hash", "text", "spans")), strict=True):
                    data = text.encode()
                    n = len(data)
                    end = -1
                    for span in sorted(held):
                        lo = max(end + 1, span >> 32)
                        hi = min((span >> 32) + (span >> 1 & 0x1FFFFF), n - window)
                        if lo <= hi and span >> 23 & 511 == _tag(hash_):
                            rows.append((0, id_, hash_, lo, hi, span >> 22 & 1 == 1, data[lo : hi + window]))
                            end = hi
                first, again = _collapsed(rows)
                if again:
                    yield _batch(again)
                yield _batch(_with_keys(first, window))

    joined = docs.join(spans, docs["doc"] == spans["of"]).select("id", "hash", "text", "spans")
    return joined.mapInArrow(cut, _CONTEXT)


def _with_keys(rows: list[tuple], window: int) -> list[tuple]:
    """The key of each context anew: it depends on the bytes alone."""
    if not rows:
        return rows
    data = np.frombuffer(b"".join(r[6][:window] for r in rows), np.uint8).reshape(len(rows), -1)
    flat = _least(_grams(data.ravel()), window - GRAM + 1)[:: data.shape[1]].view(np.int64)
    return [(int(k), *r[1:]) for k, r in zip(flat[: len(rows)], rows, strict=True)]


def _windows(row: tuple, window: int) -> tuple[list[tuple], list[tuple]]:
    """A context as its different windows, each with a key of its own, and the ranges that repeat one of them."""
    _, id_, hash_, lo, _, _, data = row
    b = np.frombuffer(data, np.uint8)
    keys = _grams(b, window).view(np.int64)
    _, first, of = np.unique(keys, return_index=True, return_inverse=True)
    first = first[of]
    bytes_ = np.lib.stride_tricks.sliding_window_view(b, window)
    at = np.flatnonzero(first != np.arange(len(keys)))
    equal = [np.all(bytes_[at[i : i + 4096]] == bytes_[first[at[i : i + 4096]]], axis=1) for i in range(0, len(at), 4096)]
    again = at[np.concatenate(equal)] if equal else at
    own = np.ones(len(keys), bool)
    own[again] = False
    rows = [(int(keys[x]), id_, hash_, lo + x, lo + x, False, data[x : x + window]) for x in np.flatnonzero(own).tolist()]
    cuts = np.append(starts_of_runs(again - np.arange(len(again))), len(again)).tolist()
    ranges = [(int(again[x]), int(again[y - 1])) for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
    return rows, [(id_ ^ (lo + x), id_, hash_, lo + x, lo + y, False, None) for x, y in ranges]


def _spread(contexts: DataFrame, window: int) -> DataFrame:
    """Contexts whose keys have more than ``HOT_KEY`` of them, or ``HOT_ROOM`` bytes, are cut into single windows, each its own key."""
    number, room = F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("bytes")).alias("room")
    sizes = contexts.groupBy("key").agg(number, room).where((F.col("n") > HOT_KEY) | (F.col("room") > HOT_ROOM))
    sizes = stored(sizes.select(F.col("key").alias("hot")), "hot-keys")  # mostly none, and then no context travels for this join

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()

        def collapsed(rows: list[tuple]) -> pa.RecordBatch:
            first, again = _collapsed(rows)
            return _batch(first + again)

        for batch in batches:
            calm = batch.filter(pc.is_null(batch["hot"]))
            if calm.num_rows:
                yield pa.RecordBatch.from_arrays([calm[c].cast(k) for c, k in zip(_FIELDS, _KINDS, strict=True)], _FIELDS)
            hot = batch.filter(pc.is_valid(batch["hot"]))
            rows: list[tuple] = []
            for i in range(hot.num_rows):
                windows, again = _windows(tuple(hot[c][i].as_py() for c in _FIELDS), window)
                rows += windows
                if again:
                    yield _batch(again)
                if len(rows) > CONTEXTS:
                    yield collapsed(rows)
                    rows = []
            if rows:
                yield collapsed(rows)

    joined = contexts.join(sizes, contexts["key"] == sizes["hot"], "left").select(*_FIELDS, "hot")
    return joined.mapInArrow(cut, _CONTEXT)


def _found(contexts: DataFrame, window: int) -> DataFrame:
    """``(id, hash, lo, hi)``: ranges of window starts that occur before.

    A key with one context, whose string is there once, has no equal windows.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        for table in whole_runs(batches, ("key",), CONTEXTS, ROOM):
            known = pc.is_null(table["bytes"])
            again = list(zip(*(table.filter(known)[c].to_pylist() for c in _FIELDS), strict=True))
            first, more = _collapsed(list(zip(*(table.filter(pc.invert(known))[c].to_pylist() for c in _FIELDS), strict=True)))
            out = [r[1:5] for r in again + more]
            met = Counter(r[0] for r in first)
            sorted_ = [r for r in first if r[5] or met[r[0]] > 1]
            for (_, id_, hash_, lo, *_), ranges in zip(sorted_, repeats([r[6] for r in sorted_], window), strict=True):
                out += [(id_, hash_, lo + a, lo + b) for a, b in ranges]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["id", "hash", "lo", "hi"])

    return contexts.repartition("key").sortWithinPartitions("key").mapInArrow(search, "id long, hash long, lo long, hi long")


def repeated_ranges(docs: DataFrame, window: int = WINDOW, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``(id, hash, ranges)`` of the texts with repeats: an array of ``(lo, hi)`` window starts.

    ``id`` is the document's id (the least number for null) and ``hash`` its text's.
    """
    if window < GRAM:
        raise ValueError(f"a passage has at least {GRAM} bytes")
    rows = _rows(docs, text, doc_id).where(F.octet_length("text") >= window)
    repeated = stored(_repeated_runs(_all_runs(rows, window)), "runs")
    contexts = stored(_contexts(rows, repeated, window), "contexts")
    known = contexts.where("bytes is null").select("id", "hash", "lo", "hi")
    found = _found(_spread(contexts.where("bytes is not null"), window), window)
    return known.union(found).groupBy("id", "hash").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))


def _rows(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """``(doc, id, hash, text)``; ``doc`` is one number for id and text, so a null or repeated id's texts stay apart.

    Texts of one id have the same ``doc`` only if their hashes are equal.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(_LEAST)).alias("id"), F.xxhash64(body).alias("hash"), body.alias("text"))
    return rows.select(F.xxhash64("id", "hash").alias("doc"), "id", "hash", "text")


def _cut(data: bytes, ranges: list[dict] | None, window: int) -> tuple[bytes, int]:
    """What is left without the bytes under the windows, and the number of removed stretches."""
    kept, spans, end = [], 0, -1
    for lo, hi in sorted((r["lo"], r["hi"]) for r in ranges or ()):
        if lo > end:
            spans += 1
            kept.append(data[max(end, 0) : lo])
        end = max(end, hi + window)
    kept.append(data[max(end, 0) :])
    return b"".join(kept), spans


def remove(docs: DataFrame, window: int = WINDOW, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with ``kept`` (bytes), ``n_bytes``, ``n_removed`` and ``n_spans``.

    Texts are UTF-8 bytes and passages never cross texts.  Null and empty texts
    and texts shorter than a passage stay.  Earlier means a smaller ``doc_id``
    (null before all), then a smaller hash of the text, then an earlier start.
    Rows with equal id and text are one document: they get the same result.
    Columns of ``docs`` with these four names are replaced; others stay.
    """
    found = repeated_ranges(docs, window, text, doc_id)
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    kind = pa.struct([("kept", pa.binary()), ("n_removed", pa.int64()), ("n_spans", pa.int64())])

    @F.arrow_udf("kept binary, n_removed long, n_spans long")
    def cut(texts: pa.Array, ranges: pa.Array) -> pa.Array:
        trim_memory()
        out = []
        for t, r in zip(texts, ranges, strict=True):
            data = t.as_py().encode()
            kept, spans = _cut(data, r.as_py(), window)
            out.append((kept, len(data) - len(kept), spans))
        columns = list(zip(*out, strict=True)) if out else [(), (), ()]
        return pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kind, strict=True)], fields=list(kind))

    names = [unique_name(docs, n) for n in ("_of", "_hash", "_ranges", "_cut")]
    of, hash_, held, done = names
    right = found.select(F.col("id").alias(of), F.col("hash").alias(hash_), F.col("ranges").alias(held))
    same = (F.coalesce(docs[doc_id].cast("long"), F.lit(_LEAST)) == right[of]) & (F.xxhash64(F.coalesce(docs[text].cast("string"), F.lit(""))) == right[hash_])
    joined = docs.join(right, same, "left").drop(of, hash_)
    out = joined.withColumn(done, cut(body, F.col(held)))
    out = out.withColumn("n_bytes", F.octet_length(body).cast("long"))
    for name in ("kept", "n_removed", "n_spans"):
        out = out.withColumn(name, F.col(f"{done}.{name}"))
    return out.drop(held, done)



def as_text(kept: Column) -> Column:
    """Bytes as text; what is left of a character that lost some of its bytes goes."""

    @F.arrow_udf("string")
    def decoded(column: pa.Array) -> pa.Array:
        return pa.array([b.as_py().decode("utf-8", "ignore") if b.is_valid else None for b in column], pa.string())

    return decoded(kept)
