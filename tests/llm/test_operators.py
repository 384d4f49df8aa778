"""Operators on small tables against brute force, with the cases that break things."""

from __future__ import annotations

import hashlib
import random
import re
import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from seasongrid.llm import chat, decontaminate, language_id, lattice, lm_score, packing, simhash, suffixes, token_counts, token_files, tokens
from seasongrid.llm.common import whole_runs
from seasongrid.llm.tokens import Encoder, encoder, tokenizer_path
from seasongrid.session import fresh_dir

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, part int, hash string, _cut int"


def _texts():
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    sentence = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    base = [sentence(rng.randint(30, 120)) for _ in range(25)]
    shared = sentence(40)
    texts = [*base, *base[:4], *[f"{t} changed" for t in base[:5]], *[f"{sentence(12)} {shared} {sentence(9)}" for _ in range(6)]]
    texts += [None, "", "   \n", "a", "Éé İ Σ <|endoftext|> \x00 !,.", "ab" * 400, "x" * 3000, base[7], sentence(5000), "été " * 60]
    return texts


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ["en", "fr", None][i % 3], "s", len(t or ""), 1, "h", 2) for i, t in enumerate(_texts())]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def odd(spark):
    """Repeated rows, a null id, one id with two texts."""
    long = "word " * 50
    rows = [(1, long), (1, long), (None, long), (2, "one"), (2, "two words here"), (None, None)]
    return spark.createDataFrame([(i, t, None, None, None, 0, None, None) for i, t in rows], SCHEMA)


def _by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def _ids(text, end=()):
    return encoder(tokenizer_path()).library.encode(text or "", add_special_tokens=False).ids + list(end)


def _crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def _groups(nodes, linked):
    group = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(group[a], group[b])
            if group[a] != low or group[b] != low:
                group[a] = group[b] = low
                changed = True
    return group


def test_ids_are_the_librarys():
    rng, small = random.Random(1), Encoder(tokenizer_path(), remembered=200)
    letters = "aAbZ.,'!? \n\t\r\x00\x85\xa0\x1c1²½éÉßµ_-<|>Σσİ t're"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(3000)] + [None, "", "<|startoftext|>x"]
    for at in range(0, len(texts), 500):
        part = texts[at : at + 500]
        offsets, ids = small.encode(pa.array(part, pa.string()))
        assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)] == [_ids(t) for t in part]


def test_language(spark, docs):
    train = spark.createDataFrame([(i, t, l) for i, (t, l) in enumerate([("the cat and the dog " * 4, "en"), ("le chat et le chien " * 4, "fr"), (None, "en"), ("x", None)] * 5)], "doc_id long, text string, lang string")
    model = language_id.fit(train)
    got = language_id.predict(spark.createDataFrame([(1, "the dog and cat", 1), (2, "le chien et", 1), (3, None, 1), (4, "12 !", 1)], "doc_id long, text string, score int"), model)
    assert {r["doc_id"]: r["lang_pred"] for r in got.collect()} == {1: "en", 2: "fr", 3: "und", 4: "und"}
    assert all(0 <= r["score"] <= 1 and (r["accepted"] or r["lang_pred"] == "und") for r in got.collect())
    empty = language_id.fit(train.where("false"))
    assert {r["lang_pred"] for r in language_id.predict(docs, empty).collect()} == {"und"}


def test_token_files(spark, docs, odd):
    path = fresh_dir(spark, "files")
    token_files.write(docs, path)
    start, want = 0, {}
    for i, text in enumerate(_texts()):
        ids = _ids(text, [1])
        want[i] = (start, len(ids), _crc(ids))
        start += len(ids)
    got = _by_id(token_files.digests(spark, path))
    assert {i: (r["start"], r["n_tokens"], r["ids_crc32"]) for i, r in got.items()} == want
    assert {r[0] for r in token_files.read(spark, path, ["doc_id"], 3, 5).collect()} == {3, 4, 5}
    for table, n in ((odd, 6), (docs.where("false"), 0)):
        path = fresh_dir(spark, "files")
        token_files.write(table, path, encoding="dictionary")
        assert token_files.digests(spark, path).count() == n


def _fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def test_simhash(spark, docs, odd):
    prints = [_fingerprint(t) for t in _texts()]
    near = [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    group = _groups(range(len(prints)), near)
    got = _by_id(simhash.near_duplicates(docs))
    assert {i: (r["fingerprint"], r["component_id"]) for i, r in got.items()} == {i: (f"{p:016x}", group[i]) for i, p in enumerate(prints)}
    assert simhash.near_duplicates(odd).count() == 6 and simhash.near_duplicates(docs.where("false")).count() == 0


def test_simhash_links_in_cut_cells(spark):
    rng = random.Random(3)
    prints = {0, *(sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3))) for _ in range(400))}
    points = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp long")
    pairs = [(r["a"], r["b"]) for r in simhash.links(points, 4, width=50).collect()]
    signed = [r[0] for r in points.collect()]
    near = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 4]
    assert _groups(signed, pairs) == _groups(signed, near) and set(pairs) | {p[::-1] for p in pairs} <= {*near, *(p[::-1] for p in near)}


@pytest.mark.parametrize("width", [1024, 16])
def test_vectors(spark, monkeypatch, width):
    monkeypatch.setattr(lattice, "BLOCK_WIDTH", width)
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((12, 32))
    v = [(centres[i % 12] + 0.12 * rng.standard_normal(32)).astype(np.float32).tolist() for i in range(150)]
    v += [v[0], v[0], None, [], [0.0] * 32, [float("nan")] * 32, [None] * 32, [1e-30] * 32, [1e30] * 32, [1.0, 2.0]]
    got = {r["vec_id"]: r for r in lattice.near_duplicates(spark.createDataFrame(list(enumerate(v)), "vec_id long, embedding array<float>")).collect()}
    usable = [i for i, x in enumerate(v) if x and len(x) == 32 and x[0] is not None and np.isfinite(x).all() and any(x)]
    unit = {i: np.array(v[i], float) / np.linalg.norm(np.array(v[i], float)) for i in usable}
    near = [(i, j) for i in usable for j in usable if i != j and unit[i] @ unit[j] >= 0.95]
    group = _groups(range(len(v)), near)
    links = defaultdict(int)
    for i, _ in near:
        links[i] += 1
    assert {i: (r["n_links"], r["component_id"], r["kept"]) for i, r in got.items()} == {i: (links[i], group[i], group[i] == i) for i in range(len(v))}


def test_lattice_points_are_nearest():
    x = np.random.default_rng(1).standard_normal((200, 8)) * 2
    near = lattice.decode(x)
    every = near[:, None, :] + np.concatenate([np.zeros((1, 8)), lattice._roots()])
    assert np.allclose(((x[:, None, :] - every) ** 2).sum(axis=2).min(axis=1), ((x - near) ** 2).sum(axis=1))


def test_decontamination(spark, docs, odd):
    texts = _texts()
    items = [(7, " ".join(texts[3].split()[5:25])), (10, texts[3].upper()), (9, "changed"), (8, None), (6, "?!"), (None, texts[6])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    known = defaultdict(set)
    for i, text in items:
        w = words(text)
        for k in range(max(0, len(w) - min(10, len(w)) + 1) if w else 0):
            known[tuple(w[k : k + 10])].add("null" if i is None else str(i))
    want = {}
    for i, text in enumerate(texts):
        w, hit, found = words(text), set(), set()
        for size in {len(k) for k in known}:
            for k in range(len(w) - size + 1):
                if tuple(w[k : k + size]) in known:
                    hit |= set(range(k, k + size))
                    found |= known[tuple(w[k : k + size])]
        want[i] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
    for bound in (1 << 20, 0):
        got = _by_id(decontaminate.report(docs, bench, broadcast_bytes=bound))
        assert {i: tuple(r)[1:] for i, r in got.items()} == want
    assert {r["doc_id"] for r in decontaminate.remove(docs, bench).collect()} == {i for i, w in want.items() if not w[4]}
    cut = _by_id(decontaminate.remove(docs, bench, spans=True))
    assert all(len(words(cut[i]["text"])) == w[0] - w[1] for i, w in want.items())
    assert decontaminate.report(odd, bench).count() == 6 and decontaminate.report(docs, bench.where("false")).where("contaminated").count() == 0


def test_packing(spark, docs, odd):
    rows = packing.pack(docs).collect()
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append(r)
        pieces[r["doc_id"]].append(r)
    for i, text in enumerate(_texts()):
        ids, at = _ids(text, [2]), 0
        for r in sorted(pieces[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids"] == ids[at : at + r["length"]] and r["ids_crc32"] == _crc(r["ids"])
            at += r["length"]
        assert at == len(ids)
    for held in sequences.values():
        at = 0
        for r in sorted(held, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at == held[0]["context"] and at & (at - 1) == 0 and at <= 4096
    assert packing.pack(odd).count() >= 6 and packing.pack(docs.where("false")).count() == 0


def test_token_counts(spark, docs):
    lengths = [len(_ids(t, [1])) for t in _texts()]
    got = token_counts.token_counts(docs).collect()
    assert {r["length"] for r in got} == set(lengths)
    for r in got:
        assert r["truncated_total"] == sum(min(n, r["length"]) for n in lengths)
        assert r["docs_longer"] == sum(n > r["length"] for n in lengths) and r["total_tokens"] == sum(lengths)
    assert token_counts.token_counts(docs.where("false")).count() == 0


def _without_repeats(texts, window=100):
    seen, out = set(), []
    for text in texts:
        data, gone = (text or "").encode(), set()
        for i in range(len(data) - window + 1):
            if data[i : i + window] in seen:
                gone |= set(range(i, i + window))
            seen.add(data[i : i + window])
        kept = bytes(b for i, b in enumerate(data) if i not in gone)
        out.append((kept, len(gone), sum(i in gone and i - 1 not in gone for i in range(len(data)))))
    return out


@pytest.mark.parametrize("hot", [suffixes.HOT_KEY, 1])
def test_repeated_passages(spark, docs, odd, monkeypatch, hot):
    monkeypatch.setattr(suffixes, "HOT_KEY", hot)
    got = _by_id(suffixes.remove(docs))
    assert [(bytes(got[i]["kept"]), got[i]["n_removed"], got[i]["n_spans"]) for i in range(len(got))] == _without_repeats(_texts())
    # the null id is first and repeats itself after five bytes; both rows of id 1 repeat it
    (_, first, _), (_, again, _) = _without_repeats(["word " * 50] * 2)
    assert sorted(r["n_removed"] for r in suffixes.remove(odd).collect()) == [0, 0, 0, first, again, again]
    assert suffixes.remove(docs.where("false")).count() == 0


def test_suffix_order():
    rng = random.Random(4)
    for letters in (b"ab", b"a", b"abcdefg", b"\x00a\xff"):
        data = bytes(rng.choice(letters) for _ in range(1500))
        order = suffixes.suffix_array(np.frombuffer(data, np.uint8), 104)
        keys = [data[i : i + 104].ljust(104, b"\0") for i in order.tolist()]
        assert sorted(order.tolist()) == list(range(1500)) and keys == sorted(keys)


def test_language_model(spark, docs):
    start, pairs, contexts, words = -1, defaultdict(int), defaultdict(int), defaultdict(int)
    sequences = [_ids(t) for t in _texts()]
    for ids in sequences:
        for v, w in zip([start, *ids], ids, strict=False):
            pairs[v, w] += 1
            contexts[v] += 1
            words[w] += 1
    total = sum(words.values())
    log = lambda v, w: np.log(pairs[v, w] / contexts[v] if pairs[v, w] >= 2 else 0.4 * words[w] / total)
    for hot in (lm_score.HOT, 5):
        got = _by_id(lm_score.score(docs, hot=hot))
        for i, ids in enumerate(sequences):
            assert got[i]["n_tokens"] == len(ids)
            assert got[i]["log_score"] == pytest.approx(sum(log(v, w) for v, w in zip([start, *ids], ids, strict=False)))
    assert lm_score.score(docs.where("false")).count() == 0


def test_chat(spark):
    texts = ["</s>[INST] ok [/INST]", "%3C|100%25<|end|>\n", None, "", "<<|turn|>", "é<"]
    turns = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(texts)] + [(None, 0, None, "x"), (2, 0, "assistant", "x"), (2, 0, "assistant", "x")]
    rows = chat.canonical(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    path = fresh_dir(spark, "chat")
    chat.write(rows, path)
    got = {r["conv_id"]: r for r in chat.digests(spark.read.parquet(path)).collect()}
    said = "".join(f"{r}\n{t or ''}\n" for _, _, r, t in turns[:6])
    learned = "".join(t or "" for _, _, r, t in turns[:6] if r == "assistant")
    assert got[1]["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest() and got[1]["n_turns"] == 6
    assert got[1]["loss_sha256"] == hashlib.sha256(learned.encode()).hexdigest() and got[1]["loss_chars"] == len(learned)
    assert got[2]["n_turns"] == 2 and got[None]["n_turns"] == 1
    formatted = spark.read.parquet(path).where("conv_id = 1").agg(F.sum(F.length("formatted"))).first()[0]
    assert got[1]["formatted_chars"] == formatted


@pytest.mark.parametrize(("schema", "row"), [
    ("conv_id long, messages array<struct<role: string, content: string>>", (1, [("user", "q"), ("assistant", "a")])),
    ("conv_id long, source string, conversations array<struct<value: string, from: string>>", (1, "s", [("q", "human"), ("a", "gpt")])),
    ("conv_id long, Prompt string, completion string", (1, "q", "a")),
    ("conv_id long, instruction string, input string, output string", (1, "q", None, "a")),
])
def test_layouts(spark, schema, row):
    got = chat.canonical(spark.createDataFrame([row], schema)).orderBy("turn").collect()
    assert [(r["role"], r["text"]) for r in got] == [("user", "q"), ("assistant", "a")]


def test_pipeline(spark, tmp_path, docs):
    import corpus_pipeline

    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    docs.select(*columns).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, _texts()[9])], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    frame = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, str(tmp_path))
        assert frame.columns == columns
        assert stage(spark, docs.select(*columns).where("false"), str(tmp_path)).count() == 0
    kept = {r["doc_id"] for r in frame.collect()}
    assert 9 not in kept and 0 in kept and not kept & set(range(25, 29))
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == kept


def test_pipeline_removes_rows_by_their_own_text(spark, tmp_path):
    """A third of the rows with a null or repeated id."""
    import corpus_pipeline

    rng = random.Random(8)
    sentence = lambda: " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(60))
    a, b, c, d, e, f, g, h = (sentence() for _ in range(8))
    rows = [
        (1, a), (None, a), (None, b),  # a null id grouped with a smaller one, and a clean one
        (2, c), (3, c), (3, d),  # a repeated id with a near copy and a clean text
        (4, e), (4, e), (4, e),  # one id, one text
        (None, f), (None, f), (None, f + " x"),  # null ids alone
        (5, g), (5, h), (None, None), (None, ""),
    ]
    same = lambda x, y: (_fingerprint(x) ^ _fingerprint(y)).bit_count() <= 4
    assert same(f, f + " x") and not any(same(x, y) for x in (a, b, c, d, e, f, g, h) for y in (a, b, c, d, e, f, g, h, "") if x != y)
    docs = spark.createDataFrame([(i, t, None, None, len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    left = [(r["doc_id"], (r["text"] or "").removesuffix(" x")) for r in kept.collect()]
    assert sorted(left, key=str) == sorted([(1, a), (None, b), (2, c), (3, d), (4, e), (None, f), (5, g), (5, h), (None, "")], key=str)

    spark.createDataFrame([(1, b), (2, g)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clean = corpus_pipeline.decontaminate_documents(spark, docs, str(tmp_path))
    assert sorted(((r["doc_id"], r["text"]) for r in clean.collect()), key=str) == sorted([(i, t) for i, t in rows if t not in (b, g)], key=str)


def test_repeated_passages_of_one_id(spark):
    """Many texts of a null or repeated id: none of them sees the spans of another."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(7))
    shared = [" ".join(word() for _ in range(rng.randint(14, 40))) for _ in range(300)]
    texts = [" ".join([word() * rng.randint(1, 9), rng.choice(shared), word() * rng.randint(1, 9), rng.choice(shared)]) for _ in range(3000)]
    rows = spark.createDataFrame([(None if i % 2 else 7, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    order = sorted((r["doc_id"] is not None, r["h"], r["text"]) for r in rows.withColumn("h", F.xxhash64("text")).collect())
    want = {(known, text): found for (known, _, text), found in zip(order, _without_repeats([t for *_, t in order]), strict=True)}
    got = {(r["doc_id"] is not None, r["text"]): (bytes(r["kept"]), r["n_removed"], r["n_spans"]) for r in suffixes.remove(rows).collect()}
    assert sum(got[k] != want[k] for k in want) == 0 and len(got) == len(want)
    docs = suffixes._rows(rows, "text", "doc_id")
    assert suffixes._repeated_runs(suffixes._all_runs(docs, 100)).groupBy("doc").count().agg(F.max("count")).first()[0] < 100


@pytest.mark.parametrize(("schema", "row"), [
    ("conv_id long, system string, messages array<struct<role: string, content: string>>", (1, "s", [("user", "q"), ("assistant", "a")])),
    ("conv_id long, conversations array<struct<value: string, from: string>>, system string", (1, [("q", "human"), ("a", "gpt")], "s")),
    ("conv_id long, system string, prompt string, completion string", (1, "s", "q", "a")),
    ("conv_id long, system string, instruction string, output string", (1, "s", "q", "a")),
])
def test_layouts_with_a_system_turn(spark, schema, row):
    got = chat.canonical(spark.createDataFrame([row], schema)).orderBy("turn").collect()
    assert [(r["turn"], r["role"], r["text"]) for r in got] == [(0, "system", "s"), (1, "user", "q"), (2, "assistant", "a")]


def test_layouts_never_ignore_a_known_text(spark):
    for schema in ("conv_id long, prompt string, completion string, input string", "conv_id long, text string"):
        with pytest.raises(ValueError, match="no layout"):
            chat.canonical(spark.createDataFrame([], schema))
    nothing = chat.canonical(spark.createDataFrame([(1, "s", None)], "conv_id long, system string, messages array<struct<role: string, content: string>>"))
    assert [(r["role"], r["text"]) for r in nothing.collect()] == [("system", "s")]


def test_language_labels_without_a_letter(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MOST_LANGUAGES", 3)
    schema = "doc_id long, text string, lang string"
    rows = [(i, "12 !", f"junk{i % 40}") for i in range(400)] + [(1000 + i, f"text in {l}", l) for l in ("x", "y", "z") for i in range(3)]
    assert language_id.fit(spark.createDataFrame(rows, schema)).languages == ["x", "y", "z"]
    with pytest.raises(ValueError, match="4 labels"):
        language_id.fit(spark.createDataFrame([*rows, (1, "word", "w")], schema))
    half = spark.createDataFrame([(i, "12 !" if i % 2 else "text", "x") for i in range(40)], schema)
    whole = spark.createDataFrame([(i, "text", "x") for i in range(0, 40, 2)], schema)
    few, all_ = (language_id.fit(d, per_language=20) for d in (half, whole))
    assert np.array_equal(few.idf, all_.idf)


def test_language_model_is_made_outside_the_driver(spark):
    """The counts of a sample's texts, 16 MB a language, do not reach the driver; the model is that of all texts at once."""
    rng = random.Random(9)
    texts = [(i, "".join(rng.choice(f"{l}{l}{l}abcdefgh ") for _ in range(60)), l) for i, l in enumerate("xyzw" * 300)]
    rows = spark.createDataFrame(texts, "doc_id long, text string, lang string").repartition(3)
    tracemalloc.start()
    try:
        model = language_id.fit(rows)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 8 << 20
    places = {r["doc_id"]: r["h"] for r in rows.select("doc_id", F.xxhash64("doc_id").alias("h")).collect()}
    order = sorted(texts, key=lambda r: (r[2], places[r[0]]))
    raw = language_id.counts([t for _, t, _ in order], model.width)
    idf = (np.log((1 + len(raw)) / (1 + (raw > 0).sum(axis=0))) + 1).astype(np.float32)
    assert model.languages == ["w", "x", "y", "z"] and np.array_equal(model.idf, idf)
    for i in range(4):
        own = language_id.vectors(raw[300 * i : 300 * (i + 1)], idf)
        c = language_id._clusters(own, 3)
        assert np.allclose(model.centroids[model.language_of == i], c, atol=1e-6)
        assert np.isclose(model.floor[i], 0.5 * (own @ c.T).max(axis=1).min(), atol=1e-6)


def test_periodic_texts_do_not_meet_in_one_task(spark, monkeypatch):
    """Rulers and padding have one least string all along: their contexts are long, and of one key."""
    rng = random.Random(8)
    texts = ["-" * rng.randint(100, 900) + f" {i} " + "=-" * rng.randint(60, 300) + "-" * 40 + str(i) for i in range(120)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    monkeypatch.setattr(suffixes, "HOT_ROOM", 4000)
    got = _by_id(suffixes.remove(rows))
    assert [(bytes(got[i]["kept"]), got[i]["n_removed"], got[i]["n_spans"]) for i in range(len(got))] == _without_repeats(texts)
    docs = suffixes._rows(rows, "text", "doc_id")
    contexts = suffixes._contexts(docs, suffixes._repeated_runs(suffixes._all_runs(docs, 100)), 100).where("bytes is not null")
    room = lambda df: df.groupBy("key").agg(F.sum(F.octet_length("bytes")).alias("n")).agg(F.max("n")).first()[0]
    assert room(contexts) > 20_000 and room(suffixes._spread(contexts, 100)) <= 4000


def test_windows_of_a_context():
    data = b"ab" * 80 + b"x" * 130
    rows, again = suffixes._windows((0, 5, 6, 10, 10 + len(data) - 100, True, data), 100)
    assert [r[6] for r in rows] == list(dict.fromkeys(data[i : i + 100] for i in range(len(data) - 99)))
    places = {r[3] - 10 for r in rows} | {i for r in again for i in range(r[3] - 10, r[4] - 9)}
    assert places == set(range(len(data) - 99)) and all(r[6] is None and r[1:3] == (5, 6) for r in again)


def test_runs_are_cut_by_rows_and_by_bytes():
    keys = [1] * 5 + [2] * 3 + [3] + [4] * 9 + [5]
    batch = pa.RecordBatch.from_arrays([pa.array(keys), pa.array(["x" * 100] * len(keys))], ["k", "v"])
    for rows, room in ((4, 1 << 30), (1000, 300), (1, 1), (1000, 1 << 30)):
        parts = [t["k"].to_pylist() for t in whole_runs(iter([batch.slice(0, 7), batch.slice(7)]), ("k",), rows, room)]
        assert sum(parts, []) == keys and all(a[-1] != b[0] for a, b in zip(parts, parts[1:], strict=False))
    assert len(parts) == 1


def test_a_table_of_rows_may_have_columns_of_other_layouts(spark):
    schema = "conv_id long, turn long, role string, text string, system string, prompt string, output string, messages string"
    rows = spark.createDataFrame([(1, 0, "user", "q", "s", "p", "o", "m"), (1, 1, None, None, None, None, None, None)], schema)
    assert sorted(tuple(r) for r in chat.canonical(rows).collect()) == [(1, 0, "user", "q"), (1, 1, "", "")]
    assert chat.canonical(rows.where("false")).count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_other_tokenizers_give_their_own_ids(name):
    own = Encoder(tokenizer_path(name))
    assert (own.separator is None) == (name == "byte_bpe_50k.json")
    texts = [t for t in _texts() if t is not None]
    offsets, ids = own.encode(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        assert ids[offsets[i] : offsets[i + 1]].tolist() == own.library.encode(t, add_special_tokens=False).ids


def test_remembered_stretches_are_not_asked_for_again(monkeypatch):
    own, asked, ask = Encoder(tokenizer_path(), remembered=1000), [], Encoder._ask
    monkeypatch.setattr(Encoder, "_ask", lambda self, library, stretches: asked.extend(stretches) or ask(self, library, stretches))
    texts = [" ".join(f"w{'abcdefghij'[part]}{'abcdefghij'[i // 100]}x{'abcdefghij'[i // 10 % 10]}{'abcdefghij'[i % 10]}" for i in range(300)) for part in range(3)]
    for text in texts * 3:
        _, ids = own.encode(pa.array([text + ", WORLD."], pa.string()))
        assert ids.tolist() == own.library.encode(text + ", WORLD.", add_special_tokens=False).ids
    assert sorted(asked) == sorted({*" ".join(texts).split(), "world"})
    monkeypatch.undo()
    for size in (1, 5, 2000, 3):  # more than are remembered, then few
        many = " ".join(f"{'ab' * (i % 7)}{i}é{i}." for i in range(size))
        _, ids = own.encode(pa.array([many], pa.string()))
        assert ids.tolist() == own.library.encode(many, add_special_tokens=False).ids
        assert len(own.forms) <= 1000 + size


def test_spans_are_cut_from_tables_with_any_columns(spark):
    item = "one two three four five six seven eight nine ten"
    schema = "doc_id long, text string, _of int, _key int, _found string, _hits string, hits int"
    docs = spark.createDataFrame([(1, f"a {item} b", 1, 2, "f", "h", 3), (None, "clean", 4, 5, None, None, 6)], schema)
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    cut = decontaminate.remove(docs, bench, spans=True)
    assert cut.columns == docs.columns
    assert sorted((tuple(r) for r in cut.collect()), key=str) == sorted([(1, "a b", 1, 2, "f", "h", 3), (None, "clean", 4, 5, None, None, 6)], key=str)
    assert [tuple(r) for r in decontaminate.remove(docs, bench).collect()] == [(None, "clean", 4, 5, None, None, 6)]


def test_token_files_are_written_from_small_batches(spark, monkeypatch):
    setting, sizes, encode = "spark.sql.execution.arrow.maxBytesPerBatch", [], token_files.encode
    monkeypatch.setattr(token_files, "encode", lambda *a: sizes.append(spark.conf.get(setting)) or encode(*a))
    docs, before = spark.createDataFrame([(1, "some words")], "doc_id long, text string"), spark.conf.get(setting, None)
    try:
        for own in (None, "1000000"):
            spark.conf.unset(setting) if own is None else spark.conf.set(setting, own)
            token_files.write(docs, fresh_dir(spark, "small"))
            assert spark.conf.get(setting, None) == own
    finally:
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)
    assert sizes == [str(token_files.BATCH)] * 2 and token_files.BATCH < tokens.ENCODED


def test_places_of_many_ids_take_little_room():
    rng = np.random.default_rng(1)
    sizes, chosen = rng.integers(0, 5, 1000), rng.integers(0, 1000, 500_000)
    data = np.arange(sizes.sum(), dtype="<u4")
    tracemalloc.start()
    try:
        lengths, found = tokens._gather(sizes, data, chosen)
        room = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    rows = np.split(data, np.cumsum(sizes)[:-1])
    assert np.array_equal(lengths, sizes[chosen]) and np.array_equal(found, np.concatenate([rows[i] for i in chosen]))
    assert room < 1.5 * (found.nbytes + lengths.nbytes)  # the values, their numbers, and a block of places
    assert [len(x) for x in tokens._gather(sizes, data, chosen[:0])] == [0, 0]


@pytest.mark.parametrize("hot", [token_files.HOT_ID, 1])
def test_token_files_of_limited_length_and_one_id(spark, monkeypatch, hot):
    monkeypatch.setattr(token_files, "HOT_ID", hot)
    texts = [f"some words {i}" for i in range(60)]
    docs = spark.createDataFrame([(5 if i % 3 else i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    path = fresh_dir(spark, "limited")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "7")
    try:
        token_files.write(docs, path, end_id=1)
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    rows = sorted((r["doc_id"], r["h"] if hot == 1 else 0, r["text"]) for r in docs.withColumn("h", F.xxhash64("text")).collect())
    at, want = 0, []
    for id_, _, text in rows:
        ids = _ids(text, [1])
        want.append((id_, at, len(ids), _crc(ids)))
        at += len(ids)
    assert sorted(tuple(r) for r in token_files.digests(spark, path).collect()) == sorted(want)


def test_a_null_id_is_not_held_out(spark):
    rows = spark.createDataFrame([(None,), (1,), (2,)], "doc_id long").withColumn("held_out", language_id.held_out())
    assert all(r["held_out"] in (True, False) for r in rows.collect()) and rows.where("doc_id is null").first()["held_out"] is False


def test_step_groups_hold_equal_tokens_over_all_tasks(spark, docs):
    rows = packing.pack(docs.repartition(7), step_tokens=2048).collect()
    tokens, context = defaultdict(int), {}
    for r in rows:
        tokens[r["step_group"]] += r["length"]
        assert context.setdefault(r["step_group"], r["context"]) == r["context"]
    for size in set(context.values()):
        totals = [n for group, n in tokens.items() if context[group] == size]
        full = max(size, 2048)
        assert sum(n != full for n in totals) <= 1 and max(totals) <= full
    assert sum(tokens.values()) == sum(len(_ids(t, [2])) for t in _texts())
    found = packing.digests(packing.pack(docs)).collect()
    assert {(r["doc_id"], r["start"], r["ids_crc32"]) for r in found} == {(r["doc_id"], r["start"], r["ids_crc32"]) for r in packing.pack(docs).collect()}


def test_stages_keep_own_columns(spark):
    import corpus_pipeline

    passage = "some passage of words that repeats " * 5
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, accepted string, kept string, n_bytes string, lang_pred string, _rest string, `a b` string"
    rows = [(i, f"{t} {passage}", "en", "s", 1, "c1", "c2", "c3", "c4", "c5", "c6", "c7") for i, t in enumerate(["the cat and dog", "a dog and the cat", "the dog"] * 5)]
    docs = spark.createDataFrame([*rows, (None, None, None, None, None, None, None, None, None, None, None, None)], schema)
    named = corpus_pipeline.identify_language(spark, docs, "")
    assert named.columns == docs.columns and named.count() == 15
    cut = corpus_pipeline.remove_repeated_passages(spark, docs, "")
    assert cut.columns == docs.columns and cut.count() == 16
    for frame in (named, cut):
        assert {tuple(r)[5:] for r in frame.where("doc_id is not null").collect()} == {("c1", "c2", "c3", "c4", "c5", "c6", "c7")}
    assert all(r["n_chars"] == len(r["text"]) for r in cut.where("text is not null").collect())


def test_cells_shrink_as_the_table_grows():
    """Comparisons a vector at five times the vectors, and how many pairs at 0.95 and above are found."""
    rng, compared, tables = np.random.default_rng(3), {}, {}
    for n in (lattice.ROWS, 5 * lattice.ROWS):
        tables[n], scale = lattice.geometry(n, 64, 0.95)
        v = rng.standard_normal((n, 64))
        v /= np.linalg.norm(v, axis=1, keepdims=True)
        keys = np.concatenate([lattice.cell_keys(v[at : at + 1000], tables[n], lattice.PROBES, scale, 1) for at in range(0, n, 1000)])
        _, sizes = np.unique(keys, return_counts=True)
        compared[n] = float((sizes.astype(float) ** 2).sum()) / n
        # queries: the rows whose id divides by 20, each with a near one at a cosine from 0.95 on
        some = v[::20][:1000]
        off = rng.standard_normal(some.shape)
        off -= (off * some).sum(axis=1, keepdims=True) * some
        cosine = rng.uniform(0.95, 0.96, (len(some), 1))
        near = cosine * some + np.sqrt(1 - cosine**2) * off / np.linalg.norm(off, axis=1, keepdims=True)
        other = lattice.cell_keys(near, tables[n], lattice.PROBES, scale, 1)
        assert lattice._together(keys[::20][:1000], other).mean() >= 0.98
    assert lattice.geometry(lattice.ROWS, 64, 0.95) == (lattice.TABLES, lattice.SCALE)
    assert compared[5 * lattice.ROWS] <= 2 * compared[lattice.ROWS]
