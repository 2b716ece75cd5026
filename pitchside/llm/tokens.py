"""Token ids of whole texts, with a per-worker cache of text pieces.

A byte-pair tokenizer never merges across the borders of its pre-tokens, so a text
can be cut before white space that follows other text and the ids of the pieces
put together. Pieces are found and looked up by hash for a whole run of documents
at once; only pieces that the worker has not met go to the tokenizer, words of letters many
at a time where its file is known to part them. The cache is
bounded; when it is full, the pieces that were met again since the last time stay and the others
go, which changes the time, never the ids.
"""

from __future__ import annotations

import json
import os
from itertools import chain

import numpy as np

from pitchside.llm import kernels as K

TABLE_BITS = 21
JOINED = 100  # pieces to a text
MAX_PIECES = 1_000_000
MAX_IDS = 6_000_000
_SPACE_NL = np.zeros(256, bool)
_SPACE_NL[[0x20, 0x0A]] = True
_ODD = np.zeros(256, bool)  # other ASCII white space
_ODD[[0x09, 0x0B, 0x0C, 0x0D]] = True
_LETTER = np.zeros(256, bool)  # ASCII
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".,;:!?")] = True
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
# pre-tokenizers that never hold a letter and a stop after it in one pre-token
_STOPS_APART = ("'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+",)


def _odd_space(data: np.ndarray) -> np.ndarray:
    """Positions of white space other than space and newline (U+0085, U+00A0, U+1680,
    U+2000-200A, 2028, 2029, 202F, 205F, 3000 besides ASCII)."""
    found = [np.flatnonzero(_ODD[data])]
    if len(data) > 1:
        two = np.flatnonzero(data[:-1] == 0xC2)
        found.append(two[np.isin(data[two + 1], (0x85, 0xA0))])
    if len(data) > 2:
        lead = data[:-2]
        three = np.flatnonzero((lead == 0xE1) | (lead == 0xE2) | (lead == 0xE3))
        a, b, c = data[three], data[three + 1], data[three + 2]
        general = (b == 0x80) & (((c >= 0x80) & (c <= 0x8A)) | np.isin(c, (0xA8, 0xA9, 0xAF))) | (b == 0x81) & (c == 0x9F)
        found.append(three[((a == 0xE1) & (b == 0x9A) & (c == 0x80)) | ((a == 0xE2) & general) | ((a == 0xE3) & (b == 0x80) & (c == 0x80))])
    return np.concatenate(found)


class Encoder:
    """Ids of runs of documents by a tokenizers file.

    ``spaced``: white space belongs to the tokens (byte-level BPE); pieces keep the
    white space before them, and a text with white space other than space and newline
    is one piece. Otherwise white space is dropped and pieces are what is between; where the
    file's pre-tokenizer is known to part them, also before a stop that follows an ASCII letter,
    and where its normalizer lower-cases, A-Z are looked up as a-z. A letter before a byte that
    is not ASCII is not (it may be composed before it is lower-cased), nor is any letter of a run
    that holds a special token in some case.
    ``plain_specials``: the strings of special tokens in a text are ordinary text; otherwise
    they get the special ids, as the tokenizer does by itself (its special tokens must not take
    white space around them, so that they stay inside a piece).
    """

    def __init__(self, path: str, spaced: bool, plain_specials: bool = False) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain_specials
        for t in self.tokenizer.get_added_tokens_decoder().values():
            if not plain_specials and (t.lstrip or t.rstrip or any(c.isspace() for c in t.content)):
                raise ValueError(f"the special token {t.content!r} takes white space: texts cannot be cut there")
        self.spaced = spaced
        self.stops_apart, self.folded = (False, False) if spaced else self._known()
        suffix = self.tokenizer.model.end_of_word_suffix if self.stops_apart and hasattr(self.tokenizer.model, "end_of_word_suffix") else None
        self.last = None
        if suffix:
            words = self.tokenizer.get_vocab()
            self.last = np.zeros(max(words.values()) + 1, bool)
            self.last[[i for word, i in words.items() if word.endswith(suffix)]] = True
        self.special = [t.content.lower().encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.mask = np.uint64((1 << TABLE_BITS) - 1)
        self._clear()

    def _known(self) -> tuple[bool, bool]:
        """Whether stops are parted from ASCII letters before them, and A-Z read as a-z."""
        file = json.loads(self.tokenizer.to_str())
        steps = file["pre_tokenizer"] or {}
        first = steps.get("pretokenizers", [steps])[0]
        apart = first.get("type") == "Split" and first["pattern"].get("Regex") in _STOPS_APART and (first["behavior"], first["invert"]) == ("Removed", True)
        norm = file["normalizer"] or {}
        norms = norm.get("normalizers", [norm])
        plain = all(n.get("type") in ("NFC", "Lowercase") or n == {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "} for n in norms)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        whole = not any(t.isalpha() or any(a.isascii() and a.isalpha() and b in ".,;:!?" for a, b in zip(t, t[1:])) for t in added)
        return apart and plain and whole, plain and any(n.get("type") == "Lowercase" for n in norms)

    def _clear(self) -> None:
        self.keys = np.zeros(1 << TABLE_BITS, np.uint64)
        self.slot = np.zeros(1 << TABLE_BITS, np.int32)
        self.start = np.zeros(1024, np.int64)
        self.size = np.zeros(1024, np.int32)
        self.flat = np.zeros(4096, np.uint32)
        self.hash = np.zeros(1024, np.uint64)
        self.again = np.zeros(1024, bool)  # met after it was added
        self.n = self.used = 0

    def _age(self) -> None:
        """Forget the pieces that were not met again; all, if that leaves more than half."""
        kept = np.flatnonzero(self.again[: self.n])
        h, size, ids = self.hash[kept], self.size[kept], self._ids(kept)
        self._clear()
        if len(kept) <= MAX_PIECES // 2 and len(ids) <= MAX_IDS // 2:
            self._add(h, size, ids)

    def _ids(self, entry: np.ndarray) -> np.ndarray:
        """The ids of entries, one after another."""
        size = self.size[entry]
        total = np.cumsum(size, dtype=np.int64)
        if not len(total):
            return np.zeros(0, np.uint32)
        return self.flat[np.repeat(self.start[entry] - (total - size), size) + np.arange(total[-1])]

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Entry of each hash, -1 where absent."""
        out = np.full(len(h), -1, np.int64)
        todo = np.arange(len(h))
        pos = (h & self.mask).astype(np.int64)
        while len(todo):
            k = self.keys[pos]
            hit = k == h[todo]
            out[todo[hit]] = self.slot[pos[hit]]
            on = ~hit & (k != 0)
            todo, pos = todo[on], (pos[on] + 1) & int(self.mask)
        return out

    def _add(self, h: np.ndarray, size: np.ndarray, ids: np.ndarray) -> None:
        m, total = len(h), len(ids)
        while self.n + m > len(self.start):
            self.start, self.size, self.hash, self.again = (np.resize(x, 2 * len(x)) for x in (self.start, self.size, self.hash, self.again))
        while self.used + total > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        self.flat[self.used : self.used + total] = ids
        self.size[self.n : self.n + m] = size
        self.hash[self.n : self.n + m] = h
        self.again[self.n : self.n + m] = False
        self.start[self.n : self.n + m] = self.used + np.cumsum(size, dtype=np.int64) - size
        entry = np.arange(self.n, self.n + m, dtype=np.int32)
        self.n, self.used = self.n + m, self.used + total
        todo = np.arange(m)
        pos = (h & self.mask).astype(np.int64)
        while len(todo):
            free = self.keys[pos] == 0
            self.keys[pos[free]] = h[todo[free]]
            won = free & (self.keys[pos] == h[todo])
            self.slot[pos[won]] = entry[todo[won]]
            todo, pos = todo[~won], (pos[~won] + 1) & int(self.mask)

    def _pieces(self, t: K.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the pieces of a run, and the piece offsets of documents."""
        n = len(t.data)
        if not self.spaced:
            inside = ~_SPACE_NL[t.data]
            edge = np.zeros(n + 1, bool)
            edge[1:n] = inside[1:] != inside[:-1]
            if self.stops_apart:
                edge[1:n] |= _STOP[t.data[1:]] & _LETTER[t.data[:-1]]
            edge[t.offsets] = True
            at = np.flatnonzero(edge)
            held = np.flatnonzero(inside[at[:-1]])
            start = at[held]
            return start, at[held + 1], np.searchsorted(start, t.offsets)
        white = _SPACE_NL[t.data]
        first = np.zeros(n + 1, bool)
        first[1:n] = white[1:] & ~white[:-1]
        odd = _odd_space(t.data)
        if len(odd):
            for d in np.unique(np.searchsorted(t.offsets, odd, "right") - 1):
                first[t.offsets[d] : t.offsets[d + 1]] = False
        first[t.offsets] = True
        first[n] = False
        start = np.flatnonzero(first)
        return start, np.append(start[1:], n), np.searchsorted(start, t.offsets)

    def _tokenize(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(the order that pieces are taken in, their numbers of ids in that order, the ids).

        Pieces of letters only are one pre-token each, so where the pre-tokenizer is known and the
        last id of a pre-token can be told, they are tokenized many to a text."""
        joined = np.fromiter((self.last is not None and x.isalpha() for x in texts), bool, len(texts))
        order = np.argsort(~joined, kind="stable")
        texts = [texts[i] for i in order.tolist()]
        n = int(joined.sum())
        groups = [texts[i : min(i + JOINED, n)] for i in range(0, n, JOINED)]
        sizes, ids = [], []

        def each(some: list[str]) -> None:
            if some:
                found = [e.ids for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
                sizes.append(np.fromiter(map(len, found), np.int64, len(found)))
                ids.extend(found)

        if groups:
            for group, e in zip(groups, self.tokenizer.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)):
                end = np.flatnonzero(self.last[e.ids]) + 1
                if len(end) == len(group) and end[-1] == len(e.ids):
                    sizes.append(np.diff(end, prepend=0))
                    ids.append(e.ids)
                else:  # a letter to Python that the tokenizer knows otherwise
                    each(group)
        each(texts[n:])
        size = np.concatenate(sizes)
        return order, size.astype(np.int32), np.fromiter(chain.from_iterable(ids), np.uint32, int(size.sum()))

    def _values(self, data: np.ndarray) -> np.ndarray:
        """What is hashed of each byte."""
        if not self.folded:
            return K.BYTE_VALUES[data]
        text = data.tobytes().lower()
        if any(t in text for t in self.special):
            return K.BYTE_VALUES[data]
        values = K.FOLDED_VALUES[data]
        before = np.flatnonzero(_UPPER[data[:-1]] & (data[1:] >= 0x80))
        values[before] = K.BYTE_VALUES[data[before]]
        return values

    def encode(self, t: K.Texts) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the whole run, id offsets of its documents)."""
        if not len(t.data):
            return np.zeros(0, np.uint32), np.zeros(len(t) + 1, np.int64)
        start, end, bounds = self._pieces(t)
        if self.n > MAX_PIECES or self.used > MAX_IDS:
            self._age()
        h = K.span_hash(K.prefix(self._values(t.data), K.BYTE_POWERS), start, end, K.BYTE_POWERS)
        h[h == 0] = 1
        entry = self._find(h)
        missing = np.flatnonzero(entry < 0)
        if len(missing) < len(entry):
            self.again[entry[entry >= 0]] = True
        if len(missing):
            new, at, count = np.unique(h[missing], return_index=True, return_counts=True)
            data = t.data.tobytes()
            texts = [data[a:b].decode() for a, b in zip(start[missing[at]].tolist(), end[missing[at]].tolist())]
            order, size, ids = self._tokenize(texts)
            n = self.n
            self._add(new[order], size, ids)
            self.again[n : self.n] = count[order] > 1
            entry[missing] = self._find(h[missing])
        total = np.zeros(len(entry) + 1, np.int64)
        np.cumsum(self.size[entry], out=total[1:])
        return self._ids(entry), total[bounds]


ENCODERS = "encoders"
_ENCODERS: dict[tuple[str, bool, bool], Encoder] = K.KEPT.setdefault(ENCODERS, {})


def encoder(path: str, spaced: bool, plain_specials: bool = False) -> Encoder:
    """The worker's encoder for a file; it stays until the worker takes a tidy task that does
    not keep ``ENCODERS``."""
    key = (path, spaced, plain_specials)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(*key)
    return _ENCODERS[key]


def vocabulary_size(path: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).get_vocab_size()


def vocabulary(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))
