"""Pieces, the cache of them and the tokenizer's own ids."""

from __future__ import annotations

import random

import pyarrow as pa
import pytest

from pitchside.llm import kernels as K
from pitchside.llm import tokens

ATOMS = [
    *("The", "THE", "the", "a", "I", "foo.bar", "don't", "DON'T", "'S", "'s", "x.Y", ".'s", "a.", ".a", "1", "23", "-", "(", '"', "...", ",", ";", "!", "?", ":"),
    *("É", "é", "É", "H̱", "ẖ", "Ḱ", "K", "Σ", "ΑΣ.", "ς", "İ", "İ", "ẞ", "ª", "ʰ", "²", "한", "하", "́", "\U00010400", "\U000323b0", "😀"),
    *("<|endoftext|>", "<|ENDOFTEXT|>", "<|endof", "text|>", "<|startoftext|>", " ", " ", "  ", "\n", "\t", "\r\n", "\x85", "\xa0", "　", "​", "\x00"),
]


def _ids(enc, texts, limit):
    out = []
    for run in K.runs(pa.array(texts), limit):
        ids, off = enc.encode(run)
        out += [ids[off[i] : off[i + 1]].tolist() for i in range(len(run))]
    return out


@pytest.mark.parametrize("plain", [False, True])
@pytest.mark.parametrize("name, spaced", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_ids_are_the_tokenizers(monkeypatch, name, spaced, plain):
    monkeypatch.setattr(tokens, "MAX_PIECES", 800)  # so that pieces are forgotten on the way
    rng = random.Random(7)
    texts = ["".join(rng.choice(ATOMS) for _ in range(rng.randint(0, 12))) for _ in range(6000)]
    enc = tokens.Encoder(tokens.vocabulary(name), spaced, plain)
    assert _ids(enc, texts, 4000) == [e.ids for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_case_and_stops_make_no_new_pieces():
    enc = tokens.Encoder(tokens.vocabulary("word_bpe_49k.json"), spaced=False)
    text = "the The THE the, The. the; THE! the? The:"
    assert _ids(enc, [text], 1 << 16) == [enc.tokenizer.encode(text, add_special_tokens=False).ids]
    assert enc.n == 7  # the word and six stops


def test_pieces_that_were_met_again_stay(monkeypatch):
    monkeypatch.setattr(tokens, "MAX_PIECES", 40)
    enc = tokens.Encoder(tokens.vocabulary("word_bpe_49k.json"), spaced=False)
    seen = []
    batch = enc.tokenizer.encode_batch_fast

    class Counted:
        def encode_batch_fast(self, texts, **options):
            seen.extend(w for t in texts for w in t.split(" "))
            return batch(texts, **options)

    enc.tokenizer = Counted()
    for i in range(30):
        _ids(enc, ["often again " + " ".join("".join(chr(97 + int(c)) for c in f"{i}{j}") + "x" for j in range(8))], 1 << 16)
    assert seen.count("often") == seen.count("again") == 1
    assert enc.n <= 50
