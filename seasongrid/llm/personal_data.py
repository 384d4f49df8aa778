"""Personal data by patterns and a skip-chain conditional random field.

Four patterns find the base spans.  The field labels tokens: stretches between
white space that hold a digit or an ``@``; any other token is outside for
certain, so it only ends a chain.  Its potentials:

* of a token, by its shape and that of its neighbours: logistic regression,
* of two neighbours,
* of a token and the hub of its key.  Equal or similar tokens of a document,
  letters and digits alike, however far apart, share a hub (a mail address also
  the hub of its part before the ``@``), so a thousand repetitions are a
  thousand edges.

All three are fitted to the patterns' labels from counts over all documents,
each kind of factor for itself.  Tokens under a base span are evidence.  Loopy
message passing, a fixed number of rounds, spreads it; tokens whose marginal
for a kind reaches ``least`` become added spans.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seasongrid.llm.common import stored

KINDS = ("email", "ip", "card", "phone")
LABELS = len(KINDS) + 1  # 0 is outside
ROUNDS = 12
LEAST = 0.8
#: Bytes of text that are looked at together; a longer text is taken in parts.
GROUP = 4 << 20
#: Tokens whose messages are passed together; a document with more stands alone.
TOKENS = 200_000
#: Shortest key that makes a hub.
KEY = 4

_DOMAIN = re.compile(rb"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(rb"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(rb"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(rb"\+[0-9][\x20().0-9-]+[0-9]")
_BREAK = re.compile(rb"[\t-\r]|(?<=[A-Za-z\x80-\xff])\x20|\x20(?=[A-Za-z\x80-\xff])")
_CORE = re.compile(rb"[A-Za-z0-9+(\x80-\xff].*[A-Za-z0-9)\x80-\xff]|[A-Za-z0-9\x80-\xff]", re.S)
_DIGITS = b"0123456789"
_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256))
_PLAIN = bytes(c for c in range(256) if c not in _DIGITS and c not in _LETTERS)
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_EMAIL_, _IP_, _CARD_, _PHONE_, _WHITE_, _DIGIT_, _MARK_ = (1 << i for i in range(7))


def _classes() -> np.ndarray:
    of = np.zeros(256, np.uint8)
    word = _DIGITS + _LETTERS[:52]
    for bit, chars in ((_EMAIL_, word + b"._%+-@"), (_IP_, _DIGITS + b"."), (_CARD_, _DIGITS + b" -"), (_PHONE_, _DIGITS + b"+ ().-"), (_WHITE_, b" \t\n\x0b\x0c\r"), (_DIGIT_, _DIGITS), (_MARK_, _DIGITS + b"@")):
        of[list(chars)] |= bit
    return of


_CLASS = _classes()


# ---------------------------------------------------------------- base spans


def _emails(run: bytes) -> Iterator[tuple[int, int]]:
    """A run has the characters of an address only, so the part before an ``@`` starts where the last search ended."""
    start = 0
    at = run.find(b"@")
    while at >= 0:
        domain = _DOMAIN.match(run, at + 1)
        if at > start and domain:
            yield start, domain.end()
            start = domain.end()
        else:
            start = at + 1
        at = run.find(b"@", start)


def _ips(run: bytes) -> Iterator[tuple[int, int]]:
    for dotted in _DOTTED.finditer(run):
        parts = dotted.group().split(b".")
        at = dotted.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            size = sum(map(len, four)) + 3
            small = [p.lstrip(b"0") for p in four]
            if all(len(p) <= 3 and int(p or b"0") <= 255 for p in small):
                yield at, at + size
            at += size + 1


def _luhn(digits: bytes) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = c - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _cards(run: bytes) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(run):
        digits = m.group().translate(None, b" -")
        if 14 <= len(digits) <= 19 and _luhn(digits):
            yield m.span()


def _phones(run: bytes) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(run):
        if 10 <= len(m.group().translate(None, b"+ ().-")) <= 15:
            yield m.span()


_FINDERS = ((_EMAIL_, _emails, 0, ord("@")), (_IP_, _ips, 4, ord(".")), (_CARD_, _cards, 14, None), (_PHONE_, _phones, 10, ord("+")))


def _edges(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(mask.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def base_spans(data: bytes) -> list[tuple[int, int, int]]:
    """``(start, end, kind)`` in bytes; a match lies in one run of its pattern's characters, a line end is in none."""
    b = np.frombuffer(data, np.uint8)
    cls = _CLASS[b]
    digits = np.concatenate([[0], np.cumsum((cls & _DIGIT_) > 0, dtype=np.int32)])
    out = []
    for kind, (bit, find, least, sign) in enumerate(_FINDERS):
        starts, ends = _edges((cls & bit) > 0)
        chosen = digits[ends] - digits[starts] >= least
        if sign is not None:
            held = np.zeros(len(starts), bool)
            held[np.searchsorted(starts, np.flatnonzero(b == sign), "right") - 1] = True
            chosen &= held
        for s, e in zip(starts[chosen].tolist(), ends[chosen].tolist(), strict=True):
            out += [(s + x, s + y, kind) for x, y in find(data[s:e])]
    return sorted(out)


# ---------------------------------------------------------------- tokens


def _hash(key: bytes) -> int:
    return xxhash.xxh64_intdigest(key) >> 1 | 1  # never 0, which is no key


def _keys(token: bytes) -> tuple[int, int]:
    """Hashes of the letters and digits of a token, and of what stands before its ``@``; 0 for none."""
    key = token.translate(_LOWER, _PLAIN)
    before = token.split(b"@", 1)[0].translate(_LOWER, _PLAIN) if b"@" in token else b""
    return (_hash(key) if len(key) >= KEY else 0), (_hash(before) if len(before) >= KEY else 0)


#: Number of values of each field of a shape.
_FIELDS = (9, 4, 3, 2, 2, 2, 2, 2, 4, 4)


def _shape(token: bytes) -> list[int]:
    digits = len(token) - len(token.translate(None, _DIGITS))
    rest = token.translate(None, _DIGITS + b".@-+()")
    other = rest.translate(None, _LETTERS)
    return [
        bisect_right((1, 3, 4, 5, 8, 10, 14, 20), digits), min(token.count(b"."), 3), min(token.count(b"@"), 2),
        b"-" in token, b"+" in token, b"(" in token or b")" in token, len(other) < len(rest), len(other) > 0,
    ]


def _beside(shape: list[int] | None) -> int:
    """What a token's shape tells its neighbour."""
    return 0 if shape is None else 1 if shape[4] else 2 if shape[0] <= 2 else 3


def _code(fields: list[int]) -> int:
    code = 0
    for value, size in zip(fields, _FIELDS, strict=True):
        code = code * size + int(value)
    return code


def _fields(codes: np.ndarray) -> np.ndarray:
    out = np.empty((len(codes), len(_FIELDS)), np.int64)
    for i in range(len(_FIELDS) - 1, -1, -1):
        codes, out[:, i] = codes // _FIELDS[i], codes % _FIELDS[i]
    return out


class _Document:
    """What is known of one text: base spans, and its tokens with a shape each."""

    def __init__(self) -> None:
        self.base: list[tuple[int, int, int]] = []
        self.tokens: list[tuple[int, int, int, int, int, bool]] = []  # start, end, label, keys, follows the one before
        self.shapes: list[list[int]] = []
        self.tail: bytes = b"x"  # the text since the last token, if it is white space only

    def row(self) -> dict:
        follows = [t[5] for t in self.tokens] + [False]
        codes = []
        for i, shape in enumerate(self.shapes):
            before = self.shapes[i - 1] if follows[i] else None
            after = self.shapes[i + 1] if follows[i + 1] else None
            codes.append(_code([*shape, _beside(before), _beside(after)]))
        names = ("start", "end", "label", "key", "local", "follows")
        columns = zip(*self.tokens, strict=True) if self.tokens else [()] * len(names)
        return {
            "base": [x for start, end, kind in self.base for x in (start, end, kind)], "code": codes,
            **{n: list(c) for n, c in zip(names, columns, strict=True)},
        }


def _units(texts: list[bytes]) -> Iterator[tuple[bytes, list[int], list[int]]]:
    """Texts, line by line, about ``GROUP`` bytes at a time: the bytes, the texts' numbers, and where they start.

    A longer text comes in parts, cut where no match can stand.
    """
    held, of, starts, size = [], [], [], 0
    for i, data in enumerate(texts):
        if len(data) > GROUP:
            at = 0
            while at < len(data):
                cut = _BREAK.search(data, at + GROUP)
                to = cut.end() if cut else len(data)
                yield data[at:to], [i], [0]
                at = to
            continue
        held.append(data)
        of.append(i)
        starts.append(size)
        size += len(data) + 1
        if size >= GROUP:
            yield b"\n".join(held), of, starts
            held, of, starts, size = [], [], [], 0
    if held:
        yield b"\n".join(held), of, starts


def _look(data: bytes, of: list[int], starts: list[int], found: list[_Document], before: list[int]) -> None:
    """Add the base spans and tokens of one unit; ``before`` counts the characters of each text in earlier units."""
    b = np.frombuffer(data, np.uint8)
    cls = _CLASS[b]
    chars = np.concatenate([[0], np.cumsum((b & 0xC0) != 0x80, dtype=np.int32)])
    marks = np.concatenate([[0], np.cumsum((cls & _MARK_) > 0, dtype=np.int32)])
    zero = [before[i] - int(chars[s]) for i, s in zip(of, starts, strict=True)]  # adds to a character's number in the unit

    def owner(at: int) -> int:
        return bisect_right(starts, at) - 1

    spans = base_spans(data)
    for s, e, kind in spans:
        o = owner(s)
        found[of[o]].base.append((int(chars[s]) + zero[o], int(chars[e]) + zero[o], kind))
    begins, ends = _edges((cls & _WHITE_) == 0)
    chosen = np.flatnonzero(marks[ends] > marks[begins])
    labels = np.zeros(len(chosen), np.int64)
    for s, e, kind in reversed(sorted(spans, key=lambda x: x[2])):  # of several kinds the first
        lo, hi = np.searchsorted(ends[chosen], s, "right"), np.searchsorted(begins[chosen], e, "left")
        labels[lo:hi] = kind + 1
    last_of, last = -1, -2
    for n, label in zip(chosen.tolist(), labels.tolist(), strict=True):
        s, e = int(begins[n]), int(ends[n])
        o = owner(s)
        document = found[of[o]]
        token = data[s:e]
        follows = n == last + 1 if o == last_of else not document.tail and not data[starts[o] : s].strip()
        core = _CORE.search(token)
        x, y = (s + core.start(), s + core.end()) if core else (s, e)
        key, local = _keys(token)
        document.tokens.append((int(chars[x]) + zero[o], int(chars[y]) + zero[o], label, key, local, follows and bool(document.tokens)))
        document.shapes.append(_shape(token))
        document.tail = b""
        last_of, last = o, n
    for o, i in enumerate(of):
        to = starts[o + 1] - 1 if o + 1 < len(of) else len(data)
        before[i] += int(chars[to] - chars[starts[o]])
    if len(of) == 1 and found[of[0]].tokens:  # a part: does the next one start beside its last token?
        tail = data[int(ends[chosen[-1]]) :] if len(chosen) else data
        if tail.strip():
            found[of[0]].tail = b"x"


_ROW = "doc_id long, base array<long>, code array<int>, start array<long>, end array<long>, label array<int>, key array<long>, local array<long>, follows array<boolean>"
_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("base", pa.list_(pa.int64())), ("code", pa.list_(pa.int32())), ("start", pa.list_(pa.int64())), ("end", pa.list_(pa.int64())), ("label", pa.list_(pa.int32())), ("key", pa.list_(pa.int64())), ("local", pa.list_(pa.int64())), ("follows", pa.list_(pa.bool_()))]
)


def look(texts: list[bytes]) -> list[dict]:
    """Base spans and tokens of whole texts."""
    found, before = [_Document() for _ in texts], [0] * len(texts)
    for data, of, starts in _units(texts):
        _look(data, of, starts, found, before)
    return [document.row() for document in found]


def tokens(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """A row for each document: its base spans and tokens, in characters."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                rows = look(part["text"].cast(pa.binary()).to_pylist())
                for row, id_ in zip(rows, part["doc_id"].to_pylist(), strict=True):
                    row["doc_id"] = id_
                yield pa.RecordBatch.from_pylist(rows, _ARROW)

    named = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    return named.mapInArrow(find, _ROW)


# ---------------------------------------------------------------- fitting


@dataclass
class Field:
    """Logarithms of potentials: weights of a shape's fields; of two neighbours; of a token and its hub."""

    weights: np.ndarray
    chain: np.ndarray
    skip: np.ndarray

    def unary(self, codes: np.ndarray) -> np.ndarray:
        score = _one_hot(codes) @ self.weights
        return score - np.logaddexp.reduce(score, axis=1, keepdims=True)


def _one_hot(codes: np.ndarray) -> np.ndarray:
    fields = _fields(codes)
    x = np.zeros((len(codes), sum(_FIELDS) + 1))
    x[:, -1] = 1
    at = 0
    for i, size in enumerate(_FIELDS):
        x[np.arange(len(codes)), at + fields[:, i]] = 1
        at += size
    return x


def _arrays(table: pa.RecordBatch | pa.Table) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The token columns, one after the other, and the document of each token."""
    columns = {n: table[n] for n in ("code", "label", "key", "local", "follows")}
    flat = {n: c.flatten().to_numpy(zero_copy_only=False) for n, c in columns.items()}
    sizes = np.diff(columns["code"].offsets.to_numpy())
    return flat, np.repeat(np.arange(len(sizes)), sizes)


def _members(flat: dict[str, np.ndarray], owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and the number of their hub, sorted by hub and token; hubs of one token are none."""
    at = [np.flatnonzero(flat[n]) for n in ("key", "local")]
    local = at[1][flat["local"][at[1]] != flat["key"][at[1]]]
    node = np.concatenate([at[0], local])
    key = np.concatenate([flat["key"][at[0]], flat["local"][local]])
    order = np.lexsort((node, key, owner[node]))
    node, key = node[order], key[order]
    new = np.ones(len(node), bool)
    new[1:] = (key[1:] != key[:-1]) | (owner[node[1:]] != owner[node[:-1]])
    hub = np.cumsum(new) - 1
    many = np.bincount(hub, minlength=1)[hub] > 1
    return node[many], np.unique(hub[many], return_inverse=True)[1]


def counts(rows: DataFrame) -> DataFrame:
    """``(factor, a, b, n)`` over all documents: shapes with labels, neighbours' labels, labels that follow each other in a hub."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, owner = _arrays(batch)
            label = flat["label"].astype(np.int64)
            follows = np.flatnonzero(flat["follows"])
            node, hub = _members(flat, owner)
            same = np.flatnonzero(hub[1:] == hub[:-1])
            pairs = ((0, flat["code"].astype(np.int64), label), (1, label[follows - 1], label[follows]), (2, label[node[same]], label[node[same + 1]]))
            for factor, a, b in pairs:
                key, n = np.unique(a * LABELS + b, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), factor, np.int32)), pa.array(key // LABELS), pa.array(key % LABELS), pa.array(n.astype(np.int64))], ["factor", "a", "b", "n"])

    found = rows.select("code", "label", "key", "local", "follows").mapInArrow(count, "factor int, a long, b long, n long")
    return found.groupBy("factor", "a", "b").agg(F.sum("n").alias("n"))


def _agreement(pairs: dict[tuple[int, int], int], trust: float) -> np.ndarray:
    """One weight for equal labels, whichever they are: the logarithm of how much oftener pairs agree than differ.

    ``trust`` counts as that many equal pairs seen beforehand.
    """
    same = trust + sum(n for (a, b), n in pairs.items() if a == b)
    other = 1 + sum(n for (a, b), n in pairs.items() if a != b)
    return float(np.clip(np.log(same / other), 0, 4)) * np.eye(LABELS)


def fit(found: list[tuple[int, int, int, int]], steps: int = 400) -> Field:
    """From all counts; there are at most as many as shapes times labels."""
    found = sorted(found)
    of = [{(a, b): n for f, a, b, n in found if f == factor} for factor in range(3)]
    codes = sorted({a for a, _ in of[0]})
    weights = np.zeros((sum(_FIELDS) + 1, LABELS))
    weights[-1, 0] = 2.0  # without any count a token is outside
    if codes:
        x = _one_hot(np.array(codes))
        y = np.zeros((len(codes), LABELS))
        place = {c: i for i, c in enumerate(codes)}
        for (a, b), n in of[0].items():
            y[place[a], b] += n
        total = y.sum()
        first = second = np.zeros_like(weights)
        for step in range(1, steps + 1):  # Adam on the mean log-likelihood
            score = x @ weights
            p = np.exp(score - np.logaddexp.reduce(score, axis=1, keepdims=True))
            slope = x.T @ (y - y.sum(axis=1, keepdims=True) * p) / total - 1e-4 * weights
            first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
            weights = weights + 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Field(weights, _agreement(of[1], 1.0), _agreement(of[2], 4.0))


# ---------------------------------------------------------------- inference


def _through(x: np.ndarray, potential: np.ndarray) -> np.ndarray:
    """The message that beliefs ``x`` send over an edge, normalised."""
    m = np.logaddexp.reduce(x[:, :, None] + potential[None], axis=1)
    return m - np.logaddexp.reduce(m, axis=1, keepdims=True)


def marginals(unary: np.ndarray, follows: np.ndarray, node: np.ndarray, hub: np.ndarray, field: Field, rounds: int = ROUNDS) -> np.ndarray:
    """Marginals of the tokens after ``rounds`` rounds in which every edge passes both its messages."""
    right = np.flatnonzero(follows)  # the later token of each pair of neighbours
    down, up = np.zeros((len(right), LABELS)), np.zeros((len(right), LABELS))
    back = np.zeros((len(node), LABELS))
    hubs = int(hub.max()) + 1 if len(hub) else 0

    def beliefs() -> np.ndarray:
        b = unary.copy()
        b[right] += down  # a token is the later one of one pair at most, and the earlier one of one
        b[right - 1] += up
        np.add.at(b, node, back)
        return b

    for _ in range(rounds):
        b = beliefs()
        down, up = _through(b[right - 1] - up, field.chain), _through(b[right] - down, field.chain.T)
        into = _through(b[node] - back, field.skip)
        gathered = np.zeros((hubs, LABELS))
        np.add.at(gathered, hub, into)
        back = _through(gathered[hub] - into, field.skip.T)
    b = beliefs()
    return np.exp(b - np.logaddexp.reduce(b, axis=1, keepdims=True))


def _added(rows: pa.Table, field: Field, least: float) -> list[list[tuple[int, int, int]]]:
    """Added spans of each document: tokens with a sure label, of numbers also several in a row."""
    flat, owner = _arrays(rows)
    unary = field.unary(flat["code"].astype(np.int64))
    label = flat["label"]
    known = np.flatnonzero(label)
    unary[known] = -50.0
    unary[known, label[known]] = 0.0
    p = marginals(unary, flat["follows"], *_members(flat, owner), field)
    best = p.argmax(axis=1)
    chosen = np.flatnonzero((label == 0) & (best > 0) & (p.max(axis=1) >= least))
    start, end = (rows[n].flatten().to_numpy() for n in ("start", "end"))
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(rows.num_rows)]
    last = -2
    for i in chosen.tolist():
        spans, kind = out[int(owner[i])], int(best[i]) - 1
        if i == last + 1 and flat["follows"][i] and KINDS[kind] in ("card", "phone") and spans[-1][2] == kind:
            spans[-1] = (spans[-1][0], int(end[i]), kind)
        else:
            spans.append((int(start[i]), int(end[i]), kind))
        last = i
    return out


def _text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, end, kind in sorted(spans, key=lambda s: (s[0], s[2], s[1])))


def _groups(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    block = batch["code"].offsets.to_numpy()[1:].astype(np.int64) // TOKENS
    cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
    return (batch.slice(a, b - a) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if b > a)


def find(docs: DataFrame, least: float = LEAST, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base, spans)``, a row for every row of ``docs``.

    ``base`` and ``spans`` (base and added ones) are ``kind:start:end`` by
    start, then kind, comma-joined, in characters, ends exclusive; the numbers
    count base spans.  An added span overlaps no base span.  Null and empty
    texts have none.  Rows with a null or repeated id are looked at each.  The
    field is fitted to all of ``docs``, copies included.  Other columns are
    ignored; an empty table gives no rows.
    """
    rows = stored(tokens(docs, text, doc_id), "tokens")
    field = fit([tuple(r) for r in counts(rows).collect()])

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _groups(batch):
                added = _added(part, field, least)
                bases = [list(zip(b[::3], b[1::3], b[2::3], strict=True)) for b in part["base"].to_pylist()]
                numbers = [[sum(s[2] == k for s in b) for b in bases] for k in range(len(KINDS))]
                columns = [part["doc_id"], *[pa.array(n, pa.int64()) for n in numbers]]
                columns += [pa.array([_text(b) for b in bases], pa.string())]
                columns += [pa.array([_text(b + a) for b, a in zip(bases, added, strict=True)], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", *[f"n_{k}" for k in KINDS], "base", "spans"])

    numbers = ", ".join(f"n_{k} long" for k in KINDS)
    return rows.mapInArrow(label, f"doc_id long, {numbers}, base string, spans string")
