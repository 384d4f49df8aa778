"""Collocations against plain counting."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from seasongrid.llm import phrases

SCHEMA = "doc_id long, text string, lang string, phrase string, n long, shard int, size int"


def _brute(docs, least=10, top=2000, longest=3):
    counts, words = {}, Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            w = re.findall("[^\x20\x09]+", piece)
            words[lang] += len(w)
            for k in range(1, longest + 1):
                counts.setdefault(lang, Counter()).update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        found = []
        kept = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        covered = set()
        for p, a in kept.items():
            for k in range(2, len(p)):
                covered |= {q for i in range(len(p) - k + 1) if 100 * a >= 50 * f[q := p[i : i + k]]}
        for p, a in kept.items():
            if p in covered:
                continue
            cuts = [(1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((" ".join(p), a, f[p[:k]], f[p[k:]], words[lang], score))
        found.sort(key=lambda r: (-r[5], -r[1], r[0].encode()))
        out += [(lang, i + 1, *r) for i, r in enumerate(found[:top])]
    return sorted(out)


def _docs(n, seed=4):
    rng = random.Random(seed)
    vocabulary = [rng.choice(["", "É", "ñ", " ", "Q"]) + "".join(rng.choice("abc") for _ in range(rng.randint(1, 3))) for _ in range(30)]
    glue = [" ", "  ", "\t", ". ", ",", "\n", "\x0b", "; ", " - ", " "] + [" "] * 12
    make = lambda k: "".join(rng.choice(vocabulary) + rng.choice(glue) for _ in range(k))
    out = [(make(rng.randint(0, 60)), rng.choice(["en", "fr", None, "und", "x"])) for _ in range(n)]
    out += [out[0]] * (n // 3) + [(None, "en"), ("", None), (" .\t! ", "en"), ("Only Words here", "solo")]
    rng.shuffle(out)
    return out


def _rows(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def _frame(spark, docs):
    return spark.createDataFrame([(i, t, l, "p", 1, 0, 0) for i, (t, l) in enumerate(docs)], SCHEMA)


@pytest.mark.parametrize("shards,top", [(1, 2000), (3, 7), (4, 2000)])
def test_against_plain_counting(spark, shards, top):
    docs = _docs(150)
    got = _rows(phrases.collocations(_frame(spark, docs).repartition(5), shards=shards, top=top))
    assert len(got) > 10 and got == _brute(docs, top=top)


def test_phrases_that_reach_late(spark):
    """Rare in all shards but the last, and words that reach the threshold only together with the last shard."""
    docs = [("alpha beta gamma", "en")] * 9 + [("pad. pad", "en")] * 40 + [("alpha beta gamma", "en")]
    got = _rows(phrases.collocations(_frame(spark, docs).coalesce(1), shards=3))
    assert got == _brute(docs) == [("en", 1, "alpha beta gamma", 10, 10, 10, 110, 1_000_000)]


def test_long_texts_in_parts(spark, monkeypatch):
    docs = _docs(40) + [(" ".join(t or "" for t, _ in _docs(60, 9)), "en"), ("x" * 5000 + " " + "y z " * 50, "en")]
    data = [(t or "").encode().translate(phrases._NORMAL) for t, _ in docs]
    monkeypatch.setattr(phrases, "GROUP", 64)
    import numpy as np

    tables = {size: np.zeros(phrases.PLACES, np.uint8) for size in (1, 2)}  # all reached in the first scan
    got = Counter()
    for part, again in phrases._parts([(t or "").encode() for t, _ in docs]):
        for batch in phrases._counted("en", part, again, 1, 3, tables):
            for p, n, size in zip(*(batch[c].to_pylist() for c in ("phrase", "n", "size")), strict=True):
                got[p] += n * (size > 0)
    del got[""]
    want = Counter()
    for d in data:
        for piece in d.decode().split("\n"):
            w = [x for x in piece.split(" ") if x]
            want.update(" ".join(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    assert got == want


def test_no_rows(spark):
    empty = _frame(spark, [(None, None)])
    assert phrases.collocations(empty).collect() == [] and phrases.collocations(empty.where("false")).collect() == []


def test_places_are_found_for_many_phrases_at_once(monkeypatch):
    calls, mix = [], phrases.mix
    monkeypatch.setattr(phrases, "mix", lambda *a: calls.append(len(a[0])) or mix(*a))
    rng = random.Random(3)
    rows = [(rng.choice(["en", "", "und"]), [rng.choice(["a", "bé", "of", "日"]) for _ in range(rng.choice([1, 2, 3]))]) for _ in range(500)]
    whole = pa.array(["x y", *(" ".join(words) for _, words in rows)], pa.string())
    found = phrases._places(pa.array([lang for lang, _ in rows]), whole.slice(1))
    assert len(calls) == 3
    assert len(phrases._places(pa.array([], pa.string()), pa.array([], pa.string()))) == 0
    for at, (lang, words) in zip(found.tolist(), rows, strict=True):
        table = np.zeros(phrases.PLACES, np.uint8)
        table[at] = 7
        times = phrases._Times(lang, words, {len(words): table})
        assert times.of([np.array([i]) for i in range(len(words))]).tolist() == [7]
