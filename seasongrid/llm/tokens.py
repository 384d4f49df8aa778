"""Token ids of whole texts by a public tokenizer, at the speed of a look-up.

Where a tokenizer's pattern never matches across white space, and its normaliser
treats the stretches between spaces one by one, the ids of a text are the ids of
its stretches in order, and each different stretch goes through the library once
for each worker.  Texts that hold one of the tokenizer's special strings, or the
separator used here, go through the library whole.  Whether a tokenizer is of
that kind is tried when it is loaded; all texts of another go through whole.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

VOCABULARY = "word_bpe_49k.json"
#: Stretches remembered for each worker: those of late use stay. Bounds memory, not results.
REMEMBERED = 1_000_000
_SEPARATOR = "\x00"
#: Stretches that the library gets in one text, and in one call.
_JOINED, _ASKED = 256, 1 << 13
#: Rows gathered at once: the places of their values take several times the values' own room.
_GATHERED = 1 << 16
#: What the look-up could get wrong: case, accents, punctuation, digits, white space, joined letters.
_PROBES = (
    "Hello, World. It's don't ÉTÉ été", "a b  c\td\ne", " lead and trail ", "x1y2 3.14, 1,000. e-mail_a@b.c", "Σσ İi ßµ ½²",
    "can't we'll THEY'RE n't 's", "(a) [b] {c} <d> \"e\" #f %g &h", "naïve café, coöperate.", "日本語 中文, русский. العربية",
    "a,b.c,. ,. .a ,b", "fi ﬁ ﬀ e\u0301 \u00a0nbsp\u2003em", "aaaa bbbb, cccc. dddd", "MiXeD CaSe, UPPER.",
)


class Encoder:
    """Stretches are remembered as columns, and looked up many at a time: no Python string is made of a known one."""

    def __init__(self, path: str, remembered: int = REMEMBERED) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers

        self.library = Tokenizer.from_file(path)
        #: For stretches that already are in their normal form.
        self.normal = Tokenizer.from_file(path)
        self.normal.normalizer = normalizers.Sequence([])
        self.remembered = remembered
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        separator = self.library.encode(_SEPARATOR, add_special_tokens=False).ids
        self.separator = separator[0] if len(separator) == 1 else None
        self._forget_all()
        if self.separator is not None and not self._by_stretches():
            self.separator = None
        self._forget_all()

    def _by_stretches(self) -> bool:
        """Whether the look-up gives the library's ids for texts that would tell."""
        try:
            offsets, ids = self.encode(pa.array(_PROBES, pa.string()))
        except ValueError:
            return False
        found = [ids[a:b].tobytes() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        return found == [self._whole(text) for text in _PROBES]

    def _forget_all(self) -> None:
        """Remember nothing but the empty stretch and the tails, whose places are their numbers in :func:`_shape`."""
        self.forms, self.sizes, self.ids = pa.array([""], pa.string()), np.zeros(1, np.int64), np.zeros(0, "<u4")
        self.used, self.calls = np.zeros(1, np.int64), 0
        if self.separator is not None:
            self._remember(pa.array([",", "."], pa.string()))

    def _forget(self) -> None:
        """Keep the half that was used last."""
        self.used[:3] = self.calls
        kept = np.sort(np.argsort(-self.used, kind="stable")[: max(3, self.remembered // 2)])
        self.forms = self.forms.take(pa.array(kept))
        self.sizes, self.ids = _gather(self.sizes, self.ids, kept)
        self.used = self.used[kept]

    def _remember(self, forms: pa.Array) -> None:
        """Ask the library for the ids of forms, and keep them at the end of what is known."""
        latin, _ = _shape(forms)
        parts = [(self.normal, np.flatnonzero(latin)), (self.library, np.flatnonzero(~latin))]
        asked = [self._ask(library, forms.take(pa.array(at)).to_pylist()) for library, at in parts]
        sizes, ids = (np.concatenate(x) for x in zip(*asked, strict=True))
        sizes, ids = _gather(sizes, ids, np.argsort(np.concatenate([at for _, at in parts])))
        self.forms = pa.concat_arrays([self.forms, forms])
        self.sizes, self.ids = np.concatenate([self.sizes, sizes]), np.concatenate([self.ids, ids])
        self.used = np.concatenate([self.used, np.full(len(forms), self.calls)])

    def _whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _ask(self, library, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Sizes and ids of stretches: many in one text, with a separator that has one id of its own."""
        found = [np.zeros(0, "<u4")]
        for at in range(0, len(stretches), _ASKED):
            parts = [stretches[i : i + _JOINED] for i in range(at, min(at + _ASKED, len(stretches)), _JOINED)]
            texts = [f" {_SEPARATOR} ".join(part) for part in parts]
            for part, encoding in zip(parts, library.encode_batch_fast(texts, add_special_tokens=False), strict=True):
                ids = np.array([*encoding.ids, self.separator], "<u4")
                if np.count_nonzero(ids == self.separator) != len(part):
                    raise ValueError("the tokenizer joined stretches across its separator")
                found.append(ids)
        ids = np.concatenate(found)
        ends = ids == self.separator
        return np.diff(np.flatnonzero(ends), prepend=-1) - 1, ids[~ends]

    def _ids_of(self, stretches: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each stretch, and all ids one after the other.

        Stretches of Latin-1 share the ids of their lower-case form, less a comma
        or stop after a letter: there lower case is the whole normal form, and a
        letter never joins a comma or stop after it.
        """
        latin, tail = _shape(stretches)
        core = pc.if_else(pa.array(latin), pc.utf8_lower(stretches), stretches)
        core = pc.if_else(pa.array(tail > 0), pc.utf8_slice_codeunits(core, 0, -1), core).dictionary_encode()
        found = pc.index_in(core.dictionary, value_set=self.forms)
        at = pc.fill_null(found, -1).to_numpy().astype(np.int64)
        new = np.flatnonzero(at < 0)
        if len(new):
            at[new] = len(self.forms) + np.arange(len(new))
            self._remember(core.dictionary.take(pa.array(new)))
        self.used[at] = self.calls
        both = np.empty(2 * len(stretches), np.int64)
        both[0::2], both[1::2] = at[core.indices.to_numpy()], tail
        lengths, ids = _gather(self.sizes, self.ids, both)
        return lengths[0::2] + lengths[1::2], ids

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of whole texts: their offsets in one array of all ids, and that array; a null text has none."""
        self.calls += 1
        if len(self.forms) > self.remembered:
            self._forget()
        texts = pc.fill_null(texts, "")
        hard = np.full(len(texts), self.separator is None)
        if self.separator is not None:
            for mark in (_SEPARATOR, *self.special):
                hard |= pc.match_substring(texts, mark).to_numpy(zero_copy_only=False)
        places, words = _split(pc.if_else(pa.array(hard), "", texts) if hard.any() else texts)
        sizes, data = self._ids_of(words.dictionary)
        lengths, ids = _gather(sizes, data, words.indices.to_numpy())
        ends = np.concatenate([[0], np.cumsum(lengths)])[places]
        if not hard.any():
            return ends, ids
        parts = [ids[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        for i in np.flatnonzero(hard).tolist():
            parts[i] = np.frombuffer(self._whole(texts[i].as_py()), "<u4")
        return np.concatenate([[0], np.cumsum([len(p) for p in parts])]), np.concatenate(parts)


def _split(texts: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray]:
    """Where the stretches of each text begin and end among all, and the stretches; no copy of the texts stays."""
    for white in "\n\t\r":
        texts = pc.replace_substring(texts, white, " ")
    split = pc.split_pattern(texts, " ")
    return split.offsets.to_numpy() - split.offsets[0].as_py(), split.flatten().dictionary_encode()


def _shape(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Which texts are all Latin-1; which of them end in a letter and a comma (1) or stop (2)."""
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[: ends[-1]]
    other = np.concatenate([[0], np.cumsum(data > 0xC3)])
    latin = other[ends[1:]] == other[ends[:-1]]
    data, ends = np.concatenate([np.zeros(3, np.uint8), data]), ends + 3  # so that three bytes can be looked back
    long = ends[1:] - ends[:-1] > 1
    last, letter, lead = (data[ends[1:] - k] for k in (1, 2, 3))
    low = letter | np.uint8(0x20)
    plain = (letter < 128) & (low >= 97) & (low <= 122)
    accented = (lead == 0xC3) & (letter >= 0xA0) & (letter <= 0xBF) & (letter != 0xB7) & (ends[1:] - ends[:-1] > 2)
    tail = np.where(last == ord(","), 1, np.where(last == ord("."), 2, 0))
    return latin, np.where(latin & long & (plain | accented), tail, 0)


def _gather(sizes: np.ndarray, data: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chosen rows of ragged rows: their sizes, and their values one after the other."""
    starts = np.cumsum(sizes) - sizes
    lengths = sizes[chosen]
    found, end = np.empty(int(lengths.sum()), data.dtype), 0
    for at in range(0, len(chosen), _GATHERED):
        some = lengths[at : at + _GATHERED]
        ends = np.cumsum(some)
        places = np.repeat(starts[chosen[at : at + _GATHERED]] - (ends - some), some)
        places += np.arange(len(places))
        found[end : end + len(places)] = data[places]
        end += len(places)
    return lengths, found


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One for each worker process and file."""
    return Encoder(path)


def tokenizer_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: Bytes of text to encode at once: many stretches share a look-up.
ENCODED = 8 << 20


def groups(texts: pa.Array, size: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts have about ``size`` bytes: bounds what is held beside them."""
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy()
    block = np.cumsum(lengths + 16) // size
    cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(texts)]
    return ((a, b) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if b > a)


def with_end(offsets: np.ndarray, ids: np.ndarray, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
    """The same rows with one more id at the end of each."""
    if end_id is None:
        return offsets, ids
    n = len(offsets) - 1
    return offsets + np.arange(n + 1), np.insert(ids, offsets[1:], np.uint32(end_id))
