"""Base spans against the patterns themselves, the field against enumeration."""

from __future__ import annotations

import itertools
import random
import re

import numpy as np
import pytest

from seasongrid.llm import personal_data as pd_

SCHEMA = "doc_id long, text string, base string, spans string, label int, code int"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _good(kind, match):
    digits = [int(c) for c in match if c.isascii() and c.isdigit()]
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def _base(text):
    found = [(m.start(), list(PATTERNS).index(k), m.end(), k) for k, p in PATTERNS.items() for m in re.finditer(p, text) if _good(k, m.group())]
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(found))


def _odd_texts(n, seed):
    rng = random.Random(seed)
    pieces = ["+1 (743) 555-3824", "4785380592391139", "4785 3805 9239 1139", "10.0.0.255", "1.2.3.4.5.6.7.8", "256.1.1.1", "a.b@c-d.ex.am", "x@y@z.com", "@a.b", "é@b.de", "00000.1.2.3", "9" * 25, "+", "1", ".", "-", " ", "\n", "(", "é", "word", "\x00", "%", "0 0-0", "@", "٣"]
    return ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 14))) for _ in range(n)]


@pytest.mark.parametrize("size", [8, 200, 4 << 20])
def test_base_spans_are_the_patterns(monkeypatch, size):
    monkeypatch.setattr(pd_, "GROUP", size)
    texts = _odd_texts(1500, size) + ["", "a" * 3000 + "@b.c " + "1 " * 2000, "a@" + "b" * 100_000]
    rows = pd_.look([t.encode() for t in texts])
    for text, row in zip(texts, rows, strict=True):
        assert pd_._text(list(zip(row["base"][::3], row["base"][1::3], row["base"][2::3], strict=True))) == _base(text)


def test_tokens_do_not_depend_on_the_parts(monkeypatch):
    texts = [" ".join(_odd_texts(30, i)) for i in range(20)]
    whole = pd_.look([t.encode() for t in texts])
    monkeypatch.setattr(pd_, "GROUP", 16)
    assert pd_.look([t.encode() for t in texts]) == whole
    assert any(any(r["follows"]) for r in whole)


def _exact(unary, follows, node, hub, field):
    """Marginals by enumeration of all labellings, the hubs' labels included."""
    n, hubs = len(unary), int(hub.max()) + 1 if len(hub) else 0
    p = np.zeros_like(unary)
    for labels in itertools.product(range(pd_.LABELS), repeat=n + hubs):
        score = sum(unary[i, labels[i]] for i in range(n))
        score += sum(field.chain[labels[i - 1], labels[i]] for i in np.flatnonzero(follows))
        score += sum(field.skip[labels[i], labels[n + h]] for i, h in zip(node, hub, strict=True))
        for i in range(n):
            p[i, labels[i]] += np.exp(score)
    return p / p.sum(axis=1, keepdims=True)


def test_messages_are_exact_without_loops():
    rng = np.random.default_rng(1)
    field = pd_.Field(np.zeros((0, 0)), rng.normal(size=(5, 5)), rng.normal(size=(5, 5)))
    unary, follows = rng.normal(size=(4, 5)), np.array([False, True, False, False])
    node, hub = np.array([1, 2, 3]), np.array([0, 0, 0])
    got = pd_.marginals(unary, follows, node, hub, field)
    assert np.allclose(got, _exact(unary, follows, node, hub, field))
    empty = pd_.marginals(unary[:0], follows[:0], node[:0], hub[:0], field)
    assert empty.shape == (0, 5)


def _corpus():
    rng = random.Random(2)
    number = lambda: f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"
    texts = []
    for _ in range(60):
        n = number()
        texts.append(f"call {n} or again {n} by mail jo.{rng.randint(10, 99)}@mail.example.com from 10.1.2.{rng.randint(1, 250)} now")
    texts += [f"chapter {i} of {rng.randint(100, 999)} pages, token {rng.getrandbits(64):x} and {rng.randint(10**6, 10**7)} items" for i in range(80)]
    return texts


def test_distant_mentions_take_the_label(spark):
    texts = _corpus()
    linked = "Ring +1 (743) 555-3824 soon. " + "word " * 400 + "Later 743 555-3824 again; and 4567123 items"
    alone = "Later 4567123 again; and chapter 3"
    rows = [(i, t) for i, t in enumerate([*texts, linked, alone])]
    df = spark.createDataFrame([(i, t, None, None, 0, 0) for i, t in rows], SCHEMA).repartition(4)
    got = {r["doc_id"]: r for r in pd_.find(df).collect()}
    for i, t in rows:
        assert got[i]["base"] == _base(t) and set(_base(t).split(",")) <= set(got[i]["spans"].split(","))
    extra = [s for s in got[len(texts)]["spans"].split(",") if s not in got[len(texts)]["base"].split(",")]
    place = linked.index("555-3824 again")
    assert len(extra) == 1 and extra[0].startswith("phone:") and extra[0].endswith(f":{place + 8}")
    assert got[len(texts) + 1]["spans"] == ""
    assert all(r["spans"] == r["base"] for i, r in got.items() if i < len(texts))


def test_many_repetitions_and_odd_rows(spark):
    many = "4785380592391139 " * 5000 + "x 4785-380592391139-1"
    rows = [(1, many), (1, many), (None, "a@b.cd"), (2, None), (3, ""), (4, "é 10.0.0.1"), (None, None)]
    df = spark.createDataFrame([(i, t, "b", "s", 1, 2) for i, t in rows], SCHEMA)
    got = sorted(((r["doc_id"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], len(r["base"])) for r in pd_.find(df).collect()), key=str)
    want = _base(many)
    assert got == sorted([(1, 0, 0, want.count("card"), 0, len(want))] * 2 + [(None, 1, 0, 0, 0, 9), (2, 0, 0, 0, 0, 0), (3, 0, 0, 0, 0, 0), (4, 0, 1, 0, 0, 7), (None, 0, 0, 0, 0, 0)], key=str)
    assert pd_.find(df.where("false")).collect() == []
