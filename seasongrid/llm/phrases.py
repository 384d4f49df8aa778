"""Collocations by dynamic itemset counting.

Texts are dealt to shards that are scanned in turn, round and round.  At first
only words are counted.  A longer phrase becomes active in the scan after both
its subphrases, all but the last and all but the first word, have reached the
threshold, wherever the scans stand then, and is counted until it has seen every
shard once.  So words, pairs and triples are counted in the same scans, and a
phrase that cannot reach the threshold costs nothing.  A phrase that reaches it
has subphrases that do so too, no later: every one is found, with its exact count.

When a phrase reached it is known to a scan by a table of fixed size, indexed by
a hash, that holds the scan in which a phrase of that place was the first to do
so.  Phrases that share a place only make longer ones start early, or be counted
in vain: the start of a phrase is a function of the table, it never changes, and
a phrase is counted in the ``shards`` scans from its start on, whichever that is.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seasongrid.llm.common import mix, stored
from seasongrid.session import fresh_dir

SHARDS = 2
LEAST = 10
LONGEST = 3
TOP = 2000
SHARE = 50
#: Bytes of text that are counted at once; a longer text is taken in parts.
GROUP = 4 << 20
#: Places of a table of scans, a byte each; with more frequent phrases than that a scan counts more than it needs.
PLACES = 1 << 23
_BUCKET = 1 << 15  # bits of one bitmap_construct_agg
_NEVER = 255
_SMALL_MAP = "spark.sql.codegen.aggregate.map.twolevel.enabled"
_SCANNED = "lang string, phrase string, size int, start int, n long"


def _normal_form() -> bytes:
    table = bytearray(range(256))
    for c in range(ord("A"), ord("Z") + 1):
        table[c] = c + 32
    table[9] = 32
    for c in b".,;:!?\x0a\x0b\x0c\x0d":
        table[c] = 10
    return bytes(table)


_NORMAL = _normal_form()


# ---------------------------------------------------------------- one group of texts


def _parts(texts: list[bytes]) -> Iterator[tuple[bytes, int]]:
    """Normal text of about ``GROUP`` bytes, and the number of its first words that were counted before.

    Texts are lines of their own.  A longer one is cut before a word; the words
    that a phrase may reach back to stand again before the next part.
    """
    held: list[bytes] = []
    size = 0
    for text in texts:
        data = text.translate(_NORMAL)
        if len(data) > GROUP:
            yield from _cut(data)
            continue
        held.append(data)
        size += len(data) + 1
        if size >= GROUP:
            yield b"\n".join(held), 0
            held, size = [], 0
    if held:
        yield b"\n".join(held), 0


def _cut(data: bytes) -> Iterator[tuple[bytes, int]]:
    at, before = 0, b""
    while at < len(data):
        space, line = data.find(b" ", at + GROUP), data.find(b"\n", at + GROUP)
        to = min(x if x >= 0 else len(data) for x in (space, line))
        part = before + data[at:to]
        yield part, len(before.split())
        before = b" ".join(part.rsplit(b"\n", 1)[-1].rsplit(None, LONGEST)[-(LONGEST - 1) :])
        at = to


def _words(data: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The different words, the number of each word in order, and the piece it stands in."""
    b = np.frombuffer(data, np.uint8)
    line = b == 10
    inside = (b != 32) & ~line
    edge = np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
    words = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(b[inside])]).dictionary_encode()
    return words.dictionary, words.indices.to_numpy().astype(np.int64), np.searchsorted(np.flatnonzero(line), starts)


def _hash(word: str) -> int:
    return xxhash.xxh64_intdigest(word)


def _hashes(words: pa.Array) -> np.ndarray:
    """The hash of each word, worked out once for each different one."""
    words = words.dictionary_encode()
    return np.array([_hash(w) for w in words.dictionary.to_pylist()], np.uint64)[words.indices.to_numpy()]


class _Times:
    """When the words and phrases of one group reached the threshold."""

    def __init__(self, lang: str, words: list[str], tables: dict[int, np.ndarray]) -> None:
        self.tables = tables
        self.words = np.array([_hash(w) for w in words], np.uint64)
        self.firsts = mix(self.words, np.full(1, _hash(lang), np.uint64))

    def of(self, columns: list[np.ndarray]) -> np.ndarray:
        """``columns`` hold the first words of the phrases, the second ones and so on."""
        h = self.firsts[columns[0]]
        for column in columns[1:]:
            h = mix(h, self.words[column])
        return self.tables[len(columns)][(h % np.uint64(PLACES)).astype(np.int64)]


def _unique(columns: list[np.ndarray], n_words: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The different phrases, column by column, and their numbers."""
    key, prefixes = columns[0], []
    for column in columns[1:]:  # number the prefixes of each length, so that no key grows beyond 64 bits
        if prefixes:
            prefix, key = np.unique(key, return_inverse=True)
            prefixes.append(prefix)
        else:
            prefixes.append(None)
        key = key * n_words + column
    phrase, n = np.unique(key, return_counts=True)
    out = []
    for prefix in reversed(prefixes):
        out.append(phrase % n_words)
        phrase = phrase // n_words if prefix is None else prefix[phrase // n_words]
    return [phrase, *reversed(out)], n


def _counted(lang: str, data: bytes, again: int, step: int, shards: int, tables: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """The active phrases of one group with their numbers; those that end in the first ``again`` words are left out.

    In the first round words are counted, and all of a language under no phrase.
    """
    known, ids, piece = _words(data)

    def batch(phrase: pa.Array, size: int, start: np.ndarray | int, n: np.ndarray) -> pa.RecordBatch:
        starts = np.broadcast_to(np.asarray(start, np.int32), len(n))
        columns = [pa.repeat(lang, len(n)), phrase, pa.repeat(pa.scalar(size, pa.int32()), len(n)), pa.array(starts), pa.array(n.astype(np.int64))]
        return pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "size", "start", "n"])

    if step < shards:
        n = np.bincount(ids[again:], minlength=len(known))
        some = np.flatnonzero(n)
        yield batch(known.take(pa.array(some)), 1, 0, n[some])
        yield batch(pa.array([""]), 0, 0, n.sum(keepdims=True))
    if not tables or len(ids) < 2:
        return
    times = _Times(lang, known.to_pylist(), tables)
    word_time = times.of([np.arange(len(known))])
    reached = word_time[ids]
    for size in range(2, LONGEST + 1):
        n = len(ids) - size + 1
        if n <= 0:
            return
        later = np.maximum(reached[:n], reached[1 : n + 1])
        both = (later < _NEVER) & (piece[:n] == piece[size - 1 :])
        start = later.astype(np.int16) + 1
        at = np.flatnonzero(both & (start <= step) & (step < start + shards))
        at = at[at + size > again]
        if len(at):
            columns, numbers = _unique([ids[at + k] for k in range(size)], len(known))
            begun = np.maximum(times.of(columns[:-1]), times.of(columns[1:])).astype(np.int32) + 1
            words = [known.take(pa.array(c)) for c in columns]
            yield batch(pc.binary_join_element_wise(*words, " "), size, begun, numbers)
        if size == LONGEST or size not in tables:
            return
        at = np.flatnonzero(both)
        reached = np.full(n, _NEVER, np.uint8)
        reached[at] = times.of([ids[at + k] for k in range(size)])


def scan(texts: DataFrame, step: int, shards: int, tables: dict[int, np.ndarray]) -> DataFrame:
    """``(lang, phrase, size, start, n)`` of one shard, several rows for a phrase."""
    shared = {size: texts.sparkSession.sparkContext.broadcast(t.tobytes()) for size, t in tables.items()}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {size: np.frombuffer(t.value, np.uint8) for size, t in shared.items()}
        for batch in batches:
            langs = batch["lang"].dictionary_encode()
            order = np.argsort(langs.indices.to_numpy(), kind="stable")
            of = langs.indices.to_numpy()[order]
            cuts = [*np.flatnonzero(np.diff(of, prepend=-1)).tolist(), len(of)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                lang = langs.dictionary[int(of[a])].as_py()
                rows = batch["text"].take(pa.array(order[a:b])).cast(pa.binary()).to_pylist()
                for data, again in _parts(rows):
                    yield from _counted(lang, data, again, step, shards, held)

    return texts.select("lang", "text").mapInArrow(count, _SCANNED)


# ---------------------------------------------------------------- the cycle


def _places(langs: pa.Array, phrases: pa.Array) -> np.ndarray:
    """The place of each phrase in the table of its size, as :class:`_Times` has it."""
    words = pc.split_pattern(phrases, " ")
    first, size = words.offsets.to_numpy()[:-1] - words.offsets[0].as_py(), pc.list_value_length(words).to_numpy()
    hashes = _hashes(words.flatten())
    h = mix(hashes[first], _hashes(langs))
    for k in range(1, int(size.max(initial=0))):
        longer = np.flatnonzero(size > k)
        h[longer] = mix(h[longer], hashes[first[longer] + k])
    return (h % np.uint64(PLACES)).astype(np.int64)


def mark(reached: DataFrame, step: int, tables: dict[int, np.ndarray]) -> bool:
    """Enter ``step`` for phrases that have reached the threshold where nothing is entered; whether any was.

    The driver gets a bit for each place, and keeps a byte, whatever the number of phrases.
    """

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["size"], pa.array(_places(batch["lang"], batch["phrase"]))], ["size", "at"])

    at = reached.select("lang", "phrase", "size").mapInArrow(places, "size int, at long")
    bucket = F.floor(F.col("at") / _BUCKET).cast("int").alias("bucket")
    new = False
    for size, number, bits in at.groupBy("size", bucket).agg(F.bitmap_construct_agg(F.col("at") % _BUCKET)).collect():
        table = tables.setdefault(size, np.full(PLACES, _NEVER, np.uint8))
        part = table[number * _BUCKET : (number + 1) * _BUCKET]
        first = np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little")[: len(part)].astype(bool) & (part == _NEVER)
        part[first] = step
        new |= bool(first.any())
    return new


@contextlib.contextmanager
def _many_keys(spark: SparkSession) -> Iterator[None]:
    """No small map ahead of the aggregation's own: nearly every row has a key that it does not hold."""
    before = spark.conf.get(_SMALL_MAP, None)
    spark.conf.set(_SMALL_MAP, "false")
    try:
        yield
    finally:
        spark.conf.unset(_SMALL_MAP) if before is None else spark.conf.set(_SMALL_MAP, before)


def frequent(docs: DataFrame, least: int = LEAST, shards: int = SHARDS, text: str = "text", lang: str = "lang") -> tuple[DataFrame, DataFrame]:
    """``(lang, phrase, size, n)`` of all phrases that occur ``least`` times, and ``(lang, n)``, the words of each language."""
    if not 0 < shards * LONGEST < _NEVER:
        raise ValueError(f"shards are between 1 and {_NEVER // LONGEST}")
    rows = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("string").alias("text"),
        (F.monotonically_increasing_id() % shards).alias("shard"),
    ).where("text is not null and text <> ''")
    path = fresh_dir(docs.sparkSession, "shards")
    rows.write.option("compression", "zstd").partitionBy("shard").parquet(path)
    texts = docs.sparkSession.read.schema("lang string, text string, shard long").parquet(path)

    finished: list[DataFrame] = []
    active: DataFrame | None = None
    tables: dict[int, np.ndarray] = {}
    step, latest = 0, -1
    while step < shards or step <= latest + shards:
        seen = scan(texts.where(F.col("shard") == step % shards), step, shards, tables)
        counts = (seen if active is None else seen.union(active)).groupBy("lang", "phrase", "size", "start").agg(F.sum("n").alias("n"))
        over = F.col("start") + shards - 1 == step
        with _many_keys(docs.sparkSession):
            counts = stored(counts.where(~over | (F.col("n") >= least) | (F.col("size") == 0)), f"counts-{step}", batch=None)
        finished.append(counts.where(over).drop("start"))
        active = counts.where(~over)
        if mark(counts.where((F.col("n") >= least) & F.col("size").between(1, LONGEST - 1)), step, tables):
            latest = step
        step += 1
    found = reduce(DataFrame.union, finished)
    return found.where("size > 0"), found.where("size = 0").select("lang", "n")


# ---------------------------------------------------------------- scores


def _inner(phrase: Column, size: Column) -> Column:
    """The phrases of two words and more that lie inside a phrase."""
    words = F.split(phrase, " ")
    return F.flatten(
        F.transform(
            F.sequence(F.lit(2), size - 1),
            lambda m: F.transform(F.sequence(F.lit(1), size - m + 1), lambda i: F.array_join(F.slice(words, i, m), " ")),
        )
    )


def scored(counts: DataFrame) -> DataFrame:
    """``(lang, phrase, a, l, r, score)`` of the phrases that do not mostly lie in a longer one.

    Products are decimals of 38 digits, the quotient is a whole-number division.
    """
    phrases = counts.where("size > 1")
    cut = F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    cuts = phrases.select("lang", "phrase", F.col("n").alias("a"), cut)
    cuts = cuts.withColumn("first", F.expr("substring_index(phrase, ' ', k)")).withColumn("rest", F.expr("substr(phrase, length(first) + 2)"))
    left = counts.select(F.col("lang").alias("_l1"), F.col("phrase").alias("_p1"), F.col("n").alias("l"))
    right = counts.select(F.col("lang").alias("_l2"), F.col("phrase").alias("_p2"), F.col("n").alias("r"))
    score = F.expr("(cast(1000000 as decimal(7,0)) * cast(a as decimal(15,0)) * cast(a as decimal(15,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    lowest = (
        cuts.join(left, (F.col("lang") == F.col("_l1")) & (F.col("first") == F.col("_p1")))
        .join(right, (F.col("lang") == F.col("_l2")) & (F.col("rest") == F.col("_p2")))
        .groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    )
    longer = phrases.where("size > 2").select("lang", F.explode(_inner(F.col("phrase"), F.col("size"))).alias("phrase"), "n")
    longer = longer.groupBy(F.col("lang").alias("_l"), F.col("phrase").alias("_p")).agg(F.max("n").alias("_longer"))
    joined = lowest.join(longer, (F.col("lang") == F.col("_l")) & (F.col("phrase") == F.col("_p")), "left")
    alone = F.col("_longer").isNull() | (100 * F.col("_longer") < SHARE * F.col("a"))
    return joined.where(alone).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def collocations(
    docs: DataFrame, least: int = LEAST, top: int = TOP, shards: int = SHARDS, text: str = "text", lang: str = "lang"
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the best ``top`` phrases of each language.

    Null and empty texts and texts without a word give nothing; a null language
    is ``und``, as is a language of that name.  Every row counts, repeated ones
    too.  Ties go by ``a``, then by the phrase's bytes.  A language without a
    phrase has no row; an empty table gives none.  Other columns are ignored.
    """
    counts, totals = frequent(docs, least, shards, text, lang)
    found = stored(scored(counts), "phrases")
    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    # many small windows first, so that the one of a language gets a bounded number of rows
    some = F.row_number().over(Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(256))).orderBy(*best))
    first = found.withColumn("place", some).where(F.col("place") <= top).drop("place")
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
