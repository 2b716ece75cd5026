"""Plain versions of the operators, over Python lists, for the tests."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile("[^\x20\x09-\x0d]+")
ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LAST = (1 << 63) - 1


def key(doc_id):
    return LAST if doc_id is None else doc_id


def numbered(docs):
    """(own id, text, source) rows, and doc_id by own id: a doc_id stands for one text; other texts
    under it, and those without one, get ids above all, by doc_id and the text's MD5."""
    md5 = lambda t: hashlib.md5((t or "").encode()).hexdigest()
    texts = defaultdict(set)
    for d, t, _ in docs:
        texts[d].add(md5(t))
    own = {(d, m): d for d in texts if d is not None for m in [min(texts[d])]}
    at = max([d for d in texts if d is not None], default=0) + 1
    for d, m in sorted(((d, m) for d in texts for m in texts[d] if (d, m) not in own), key=lambda x: (x[0] is None, x[0] or 0, x[1])):
        own[d, m] = at
        at += 1
    return [(own[d, md5(t)], t, s) for d, t, s in docs], {i: d for (d, _), i in own.items()}


def restored(rows, given, *more):
    """Result rows with the doc_ids (column 0 and the columns ``more``) as they were."""
    return [tuple(given.get(x, x) if i in (0, *more) else x for i, x in enumerate(r)) for r in rows]


def sha(x) -> str:
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def words(text):
    return WORD.findall(text or "")


def decontaminated(docs, items):
    windows = defaultdict(set)
    for item, text in items:
        w = ALNUM.findall((text or "").translate(LOWER))
        if item is not None and w:
            n = min(10, len(w))
            for i in range(len(w) - n + 1):
                windows[tuple(w[i : i + n])].add(str(item))
    sizes = {len(k) for k in windows}
    out = []
    for d, text, _ in docs:
        w, hit, found = ALNUM.findall((text or "").translate(LOWER)), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (g := tuple(w[i : i + n])) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[g]
        out.append((d, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def substrings(docs):
    first, out = {}, []
    for d, w in sorted({(key(d), tuple(words(t))) for d, t, _ in docs}):
        for i in range(len(w) - 19):
            first.setdefault(w[i : i + 20], (d, i))
    for d, t, _ in docs:
        w, gone = tuple(words(t)), set()
        for i in range(len(w) - 19):
            if first[w[i : i + 20]] != (key(d), i):
                gone.update(range(i, i + 20))
        out.append((d, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def shingles(text, size):
    w = words((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])


def near_components(docs, size):
    """key -> (set size, smallest key reachable)."""
    sets = {key(d): shingles(t, size) for d, t, _ in docs}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    ids = sorted(d for d in sets if sets[d])
    for i, a in enumerate(ids):
        for b in ids[:i]:
            m, n = len(sets[a]), len(sets[b])
            if 100 * min(m, n) >= 80 * max(m, n):
                both = len(sets[a] & sets[b])
                if 100 * both >= 80 * (m + n - both):
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def line_key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)


def lines_cut(docs):
    holders = defaultdict(set)
    for d, t, _ in docs:
        for line in (t or "").split("\n"):
            if len(k := line_key(line)) >= 40:
                holders[k].add(key(d))
    out = []
    for d, t, _ in docs:
        every = (t or "").split("\n")
        stay = [x for x in every if len(holders.get(line_key(x), ())) < 5 or max(holders[line_key(x)]) == key(d)]
        out.append((d, len(every), len(every) - len(stay), "\n".join(stay)))
    return out


def byte_repeats(docs):
    count, texts = Counter(), {key(d): (t or "").encode() for d, t, _ in docs}
    for b in texts.values():
        count.update(b[i : i + 200] for i in range(len(b) - 199))
    out = []
    for d, _, _ in docs:
        b = texts[key(d)]
        mark, end = bytearray(len(b)), 0
        for i in range(len(b) - 199):
            if count[b[i : i + 200]] > 1:
                a = max(i, end)
                end = i + 200
                mark[a:end] = b"\1" * (end - a)
        spans = len(re.findall(b"\1+", bytes(mark)))
        out.append((d, len(b), sum(mark), spans, sha(bytes(x for x, m in zip(b, mark) if not m))))
    return out


def quality(docs, share=0.1, floor=10):
    held, of_host = defaultdict(set), defaultdict(set)
    norm = lambda line: " ".join(words(line)).translate(LOWER)
    for d, t, s in docs:
        of_host[s].add(key(d))
        for line in (t or "").split("\n"):
            if words(line):
                held[s, norm(line)].add(key(d))
    out = []
    for d, t, s in docs:
        t = t or ""
        w, every = words(t), [x for x in t.split("\n") if words(x)]
        seen, dup = set(), 0
        for x in every:
            dup += x in seen
            seen.add(x)
        at = defaultdict(list)
        for i in range(len(w) - 4):
            at[tuple(w[i : i + 5])].append(i)
        rep = {i + k for v in at.values() if len(v) > 1 for i in v for k in range(5)}
        chars = sum(map(len, w))
        lost = sum(sum(map(len, words(x))) for x in every if len(held[s, norm(x)]) > max(floor, share * len(of_host[s])))
        failed = len(w) < 10 or 100 * len(rep) > 20 * len(w)
        out.append((d, len(w), chars, sum(c in "#*$%&|<>" for c in t), dup, len(rep), failed, not failed and chars - lost >= 0.3 * chars))
    return out


def token_ids(name, texts, end):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(str(public_tokenizers.path(name)))
    return [np.array([*e.ids, end], "<u4") for e in tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(ids.tobytes())


def cut_pieces(docs, capacity=2048):
    out = []
    for (d, _, _), ids in zip(docs, token_ids("byte_bpe_50k.json", [t for _, t, _ in docs], 0)):
        at, n, piece = 0, len(ids), 0
        while at < n:
            size = (n - at) % capacity or capacity
            out.append((d, piece, at, size, crc(ids[at : at + size])))
            at, piece = at + size, piece + 1
    return out


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)


def base_secrets(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)
