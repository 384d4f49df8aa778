"""Language of a text by its nearest centroid.

A text becomes counts of its letter n-grams (one to three UTF-8 bytes of the
lower-cased text, hashed to ``width`` slots), damped, weighted by inverse
document frequency and scaled to length one.  Every language has several
centroids, found by clustering its training texts; the language of the
centroid with the largest cosine wins.  A text further from that centroid than
``slack`` allows, measured by the training texts' own distances, is rejected.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from seasongrid.llm.common import release_memory, stored, unique_name
from seasongrid.llm.tokens import groups

UNDETERMINED = "und"
#: Labelled texts per language that the centroids are clustered from; chosen by a hash of the id.
FIT_PER_LANGUAGE = 1000
#: Languages that a model may hold; more is an error.
MOST_LANGUAGES = 500
_LETTER = re.compile(r"[^\W\d_]")
#: The same for Spark; characters too new for its tables are left to ``_LETTER``.
_SOME_LETTER = r"[\p{L}\p{Nl}\p{No}\p{Cn}]"
_RESULT = "lang_pred string, score double, accepted boolean"


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray  # rows of length one
    language_of: np.ndarray  # of each centroid
    floor: np.ndarray  # per language: less than this cosine is rejected
    width: int


def counts(texts: list[str], width: int) -> np.ndarray:
    """Hashed n-gram counts, one row for each text."""
    out = np.zeros((len(texts), width), np.float32)
    for i, text in enumerate(texts):
        b = np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8).astype(np.uint32)
        word = ((b >= 97) & (b <= 122)) | (b >= 128)
        b = np.where(word, b, np.uint32(32))
        b = np.concatenate([[np.uint32(32)], b, [np.uint32(32)]]).astype(np.uint32)
        two = b[:-1] << np.uint32(8) | b[1:]
        three = two[:-1] << np.uint32(8) | b[2:]
        two = two[two != 0x2020]
        three = three[(three & np.uint32(0xFFFF)) != 0x2020]
        three = three[three >> np.uint32(8) != 0x2020]
        grams = np.concatenate([b[b != 32], two | np.uint32(1 << 24), three | np.uint32(2 << 24)])
        slots = (grams * np.uint32(2654435761)) >> np.uint32(12)
        out[i] = np.bincount(slots % width, minlength=width)
    return out


def vectors(raw: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.sqrt(raw) * idf
    length = np.linalg.norm(v, axis=1, keepdims=True)
    return v / np.where(length > 0, length, 1)


def _clusters(v: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means from spread-out seeds; no random numbers."""
    chosen = [v.mean(axis=0) / max(np.linalg.norm(v.mean(axis=0)), 1e-9)]
    for _ in range(min(k, len(v)) - 1):
        chosen.append(v[np.argmin((v @ np.array(chosen).T).max(axis=1))])
    c = np.array(chosen)
    for _ in range(rounds):
        own = np.argmax(v @ c.T, axis=1)
        c = np.array([v[own == j].mean(axis=0) if (own == j).any() else c[j] for j in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
    return c


def fit(
    labelled: DataFrame,
    text: str = "text",
    lang: str = "lang",
    by: str = "doc_id",
    width: int = 4096,
    per_language: int = FIT_PER_LANGUAGE,
    clusters: int = 3,
    slack: float = 0.5,
) -> Model:
    """Centroids from at most ``per_language`` texts of each label, chosen by a hash of ``by``.

    Document frequencies are those of the same bounded sample.  Rows without a
    label, a text or a letter teach nothing; without any other row the model
    has no language and every text is undetermined.  Texts are counted and each
    language clustered in tasks; the driver gets document frequencies and centroids.
    """
    known = labelled.select(F.col(lang).cast("string").alias("l"), F.col(text).cast("string").alias("t"), F.xxhash64(by).alias("h"))
    known = known.where(F.col("l").isNotNull() & F.col("t").rlike(_SOME_LETTER))
    n = known.select("l").distinct().count()
    if n > MOST_LANGUAGES:
        raise ValueError(f"{n} labels; a model holds {MOST_LANGUAGES} languages")
    # hashes alone are ranked; texts travel only for the chosen ones
    place = F.row_number().over(Window.partitionBy("l").orderBy("h"))
    bounds = known.select("l", "h").withColumn("place", place).where(F.col("place") <= per_language).groupBy(F.col("l").alias("of")).agg(F.max("h").alias("most"))
    near = known.join(F.broadcast(bounds), (F.col("l") == F.col("of")) & (F.col("h") <= F.col("most")))
    place = F.row_number().over(Window.partitionBy("l").orderBy("h", "t"))
    ranked = near.withColumn("place", place).where(F.col("place") <= per_language)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        for batch in batches:
            for a, b in groups(batch["t"]):
                part = batch.slice(a, b - a)
                found = [x for x in zip(*(part[c].to_pylist() for c in ("l", "place", "t")), strict=True) if _LETTER.search(x[2])]
                if not found:
                    continue
                rows = [(np.flatnonzero(r), r) for r in counts([t for _, _, t in found], width)]
                yield pa.RecordBatch.from_pydict(
                    {"l": [x for x, _, _ in found], "place": [p for _, p, _ in found], "slots": [np.asarray(s, np.int32) for s, _ in rows], "n": [r[s] for s, r in rows]},
                    schema=pa.schema([("l", pa.string()), ("place", pa.int32()), ("slots", pa.list_(pa.int32())), ("n", pa.list_(pa.float32()))]),
                )

    sample = stored(ranked.select("l", "place", "t").mapInArrow(features, "l string, place int, slots array<int>, n array<float>"), "language-sample")
    texts_with = np.zeros(width, np.int64)
    for slot, texts in sample.select(F.explode("slots").alias("slot")).groupBy("slot").count().collect():  # a row for each slot at most
        texts_with[slot] = texts
    idf = (np.log((1 + sample.count()) / (1 + texts_with)) + 1).astype(np.float32)

    def cluster(language: pa.Table) -> pa.Table:
        release_memory()
        language = language.sort_by("place")
        raw = np.zeros((language.num_rows, width), np.float32)
        for i, (s, n) in enumerate(zip(language["slots"], language["n"], strict=True)):
            raw[i, s.values.to_numpy()] = n.values.to_numpy()
        own = vectors(raw, idf)
        c = _clusters(own, clusters)
        floor = slack * float((own @ c.T).max(axis=1).min())
        return pa.table({"l": language["l"].slice(0, 1), "centroids": pa.array([c.ravel()], pa.list_(pa.float32())), "floor": [floor]})

    found = sample.groupBy("l").applyInArrow(cluster, "l string, centroids array<float>, floor double").toArrow().sort_by("l")
    centroids = [c.values.to_numpy().reshape(-1, width) for c in found["centroids"]]
    owner = [i for i, c in enumerate(centroids) for _ in c]
    floor = np.array(found["floor"].to_pylist(), float)
    return Model(found["l"].to_pylist(), idf, np.concatenate(centroids) if centroids else np.zeros((0, width)), np.array(owner, int), floor, width)


def classify(model: Model, texts: list[str | None]) -> tuple[list[str], list[float], list[bool]]:
    lang, score, accepted = [UNDETERMINED] * len(texts), [0.0] * len(texts), [False] * len(texts)
    at = [i for i, t in enumerate(texts) if t and _LETTER.search(t)] if len(model.languages) else []
    for a in range(0, len(at), 64):
        part = at[a : a + 64]
        near = vectors(counts([texts[i] for i in part], model.width), model.idf) @ model.centroids.T
        best = np.argmax(near, axis=1)
        for i, j, s in zip(part, model.language_of[best].tolist(), near[np.arange(len(part)), best].tolist(), strict=True):
            lang[i], score[i], accepted[i] = model.languages[j], min(1.0, max(0.0, s)), s >= model.floor[j]
    return lang, score, accepted


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (cosine, 0 to 1) and ``accepted``.

    Only the text is looked at, all of it.  Null texts and texts without a
    letter are ``und`` with score 0 and not accepted.  A rejected text keeps
    its nearest language.  Equal cosines go to the first language by name.
    Columns of ``docs`` with these names are replaced; others stay.
    """

    @F.arrow_udf(returnType=_RESULT)
    def found(column: pa.Array) -> pa.Array:
        release_memory()
        parts = []
        for a, b in groups(column):
            lang, score, accepted = classify(model, column.slice(a, b - a).to_pylist())
            parts.append(pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(accepted, pa.bool_())], ["lang_pred", "score", "accepted"]))
        kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("accepted", pa.bool_())])
        return pa.concat_arrays(parts) if parts else pa.array([], kind)

    held = unique_name(docs, "_language")
    out = docs.withColumn(held, found(F.col(text).cast("string")))
    for name in ("lang_pred", "score", "accepted"):
        out = out.withColumn(name, F.col(f"{held}.{name}"))
    return out.drop(held)


def held_out(doc_id: str = "doc_id"):
    """Whether a row is kept from training: its id's crc32, as text, divides by five.  A null id's row is not kept."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))
