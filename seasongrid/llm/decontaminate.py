"""Benchmark decontamination: windows of test words looked up in training texts.

All in DataFrame expressions.  The distinct windows of the benchmark form a
hash set that is broadcast after its size was measured (beyond the bound the
same join shuffles).  Each document is cut into words once; its windows are
probed as text, so a hit is verified by equality of every word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seasongrid.llm.common import unique_name

#: What lies between words, once A-Z are lower case.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A character that lower() might change beside A-Z: any but ASCII and the small letters of Latin-1.
OTHER = r"[^\x00-\x7F\xDF-\xFF]"
WINDOW = 10
#: The broadcast is used up to this many bytes of windows.
BROADCAST_BYTES = 64 << 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Words of a text in order; a null text has none."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    # lower() is the same and faster where nothing but A-Z has a lower case
    lowered = F.when(text.rlike(OTHER), F.translate(text, _UPPER, _LOWER)).otherwise(F.lower(text))
    return F.array_remove(F.split(lowered, BETWEEN), "")


def windows_of(words_: Column, size: int) -> Column:
    """``(at, window)`` for every stretch of ``size`` words."""
    places = F.when(F.size(words_) >= size, F.sequence(F.lit(0), F.size(words_) - size)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.struct(i.alias("at"), F.concat_ws(" ", F.slice(words_, i + 1, size)).alias("window")))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW, text: str = "text", item_id: str = "item_id") -> DataFrame:
    """``(window, size, items)``: each distinct window with its words and the items that hold it."""
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("item"), words(F.col(text)).alias("w")).where(F.size("w") > 0)
    size = F.least(F.size("w"), F.lit(window))
    return (
        items.select("item", size.alias("size"), F.explode(F.transform(
            F.sequence(F.lit(0), F.size("w") - size), lambda i: F.concat_ws(" ", F.slice("w", i + 1, size))
        )).alias("window"))
        .groupBy("window", "size")
        .agg(F.collect_set("item").alias("items"))
    )


def _covered(hits: Column) -> Column:
    """Words inside any of the ``(at, size)`` windows."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))

    def step(state: Column, hit: Column) -> Column:
        end = hit["at"] + hit["size"]
        more = F.greatest(F.lit(0), end - F.greatest(hit["at"], state["end"]))
        return F.struct((state["n"] + more).alias("n"), F.greatest(state["end"], end).alias("end"))

    return F.aggregate(F.array_sort(hits), start, step, lambda s: s["n"])


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text", doc_id: str = "doc_id", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``(doc_id, text_key, n_words, hits)``, a row for every row of ``docs``.

    ``hits`` holds ``(at, size, items)`` of every place where a benchmark window
    starts.  An item of fewer words than ``window`` is one window of its own
    length.  Null and empty texts have no words and no hits; an empty benchmark
    has no windows.  Repeated rows stay apart.  Other columns are ignored.
    """
    known = benchmark_windows(benchmark, window, text)
    measured = known.groupBy("size").agg(F.sum(F.length("window") * 4 + 64 + F.size("items") * 32).alias("bytes")).collect()  # a row for each size up to the window
    small = sum(r["bytes"] for r in measured) <= broadcast_bytes
    known = known.select(F.col("window").alias("of"), "size", "items")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_key"), words(F.col(text)).alias("w"))
    first = F.array(F.struct(F.lit(-1).alias("at"), F.lit(None).cast("string").alias("window")))
    every = F.concat(first, *[windows_of(F.col("w"), r["size"]) for r in sorted(measured)])
    probed = rows.select("row", "doc_id", "text_key", F.size("w").alias("n_words"), F.explode(every).alias("p")).select("row", "doc_id", "text_key", "n_words", "p.at", "p.window")
    probed = probed.join(F.broadcast(known) if small else known, F.col("window") == F.col("of"), "left").where("at < 0 or of is not null")
    hit = F.when(F.col("at") >= 0, F.struct("at", "size", "items"))
    return probed.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("text_key").alias("text_key"), F.max("n_words").cast("long").alias("n_words"), F.collect_list(hit).alias("hits")
    ).drop("row")


def report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)`` from :func:`hits`."""
    found = hits(docs, benchmark, **options)
    items = F.array_sort(F.array_distinct(F.flatten(F.col("hits.items"))))
    n_hit = _covered(F.transform("hits", lambda h: F.struct(h["at"].alias("at"), h["size"].alias("size")))).cast("long")
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), items.alias("items")).select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def remove(docs: DataFrame, benchmark: DataFrame, spans: bool = False, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """``docs`` without contaminated documents, or with the hit words cut out of their texts.

    With ``spans`` the words of a contaminated text that no window covers are
    kept, joined by spaces, normalised as they were compared; other texts stay
    as they are.  The columns are those of ``docs``, whatever their names.
    Without, the rows of a null or repeated id stay or fall each by
    its own text.
    """
    found = hits(docs, benchmark, text=text, doc_id=doc_id, **options).where(F.size("hits") > 0)
    of, key, held = (unique_name(docs, name) for name in ("_of", "_key", "_hits"))
    cut = found.groupBy(F.col("doc_id").alias(of), F.col("text_key").alias(key)).agg(F.first("hits").alias(held))
    same = docs[doc_id].eqNullSafe(cut[of]) & (F.xxhash64(docs[text]) == cut[key])
    if not spans:
        return docs.join(cut.drop(held), same, "left_anti")
    joined = docs.join(cut, same, "left").drop(of, key)
    free = F.filter(words(F.col(text)), lambda w, i: ~F.exists(F.col(held), lambda h: (h["at"] <= i) & (i < h["at"] + h["size"])))
    return joined.withColumn(text, F.when(F.col(held).isNull(), F.col(text)).otherwise(F.concat_ws(" ", free))).drop(held)
