"""Token ids of whole texts by a public tokenizer file, one white-space piece at a time.

The tokenizer drops white space and never joins pieces across it, so the ids of a text
are the ids of its pieces in order. Pieces repeat (Zipf), so a bounded cache of packed
ids replaces most of the work. A new piece of Latin script is cut by the tokenizer's own
split pattern and its words go straight to the tokenizer's model; any other piece goes
through the whole tokenizer. ``tests/llm`` compares both with the library's own encoding.
"""

from __future__ import annotations

import functools
import json
import re
from array import array

import numpy as np

#: Python's str.split also splits at these four, the tokenizer does not.
_ODD = re.compile("[\x1c-\x1f]")
#: Characters whose normal form and lower case need no look at their neighbours.
_LATIN = re.compile("[\x21-\x7e\xa1-įı-ɏ]+")
#: Entries of either cache of a worker; what comes later is encoded each time.
CACHE = 500_000


def _byte_letters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: bytes that print
    stand for themselves, the others take the code points from 256 on in order."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class Encoder:
    """``encode(texts)`` gives the ids of each text as packed little-endian integers of ``dtype``."""

    def __init__(self, name: str):
        import public_tokenizers
        import regex
        from tokenizers import Tokenizer

        path = public_tokenizers.path(name)
        self.tok = Tokenizer.from_file(path)
        size = self.tok.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        with open(path, encoding="utf-8") as f:
            conf = json.load(f)
        self.specials = [t["content"] for t in conf["added_tokens"]]
        kinds = [n["type"] for n in (conf["normalizer"] or {}).get("normalizers", [])]
        cuts = (conf["pre_tokenizer"] or {}).get("pretokenizers", [])
        #: The direct way holds for this shape of file only; others use the whole tokenizer.
        self.direct = kinds == ["NFC", "Replace", "Lowercase"] and [c["type"] for c in cuts] == ["Split", "ByteLevel"]
        if self.direct:
            self.words = regex.compile(cuts[0]["pattern"]["Regex"])
            self.letters = _byte_letters()
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.open = "<" if all("<" in x for x in self.specials) else ""
        self.pieces: dict[str, bytes] = {}
        self.known: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _word(self, word: str) -> bytes:
        got = self.known.get(word)
        if got is None:
            plain = word if word.isascii() else "".join([self.letters[b] for b in word.encode()])
            got = array(self.code, [t.id for t in self.tok.model.tokenize(plain)]).tobytes()
            if len(self.known) < CACHE:
                self.known[word] = got
        return got

    def _piece(self, piece: str) -> bytes:
        if not self.direct or not _LATIN.fullmatch(piece) or (self.open in piece and any(s in piece for s in self.specials)):
            return self._whole(piece)
        low = piece.lower()
        if low.isalpha():
            return self._word(low)
        if low[:-1].isalpha() and low[-1] in ".,!?;:":
            return self._word(low[:-1]) + self._word(low[-1])
        return b"".join([self._word(w) for w in self.words.findall(low)])

    def encode(self, texts: list[str]) -> list[bytes]:
        have, get, out = self.pieces, self.pieces.__getitem__, []
        for t in texts:
            if _ODD.search(t):
                out.append(self._whole(t))
                continue
            split = t.split()
            try:
                out.append(b"".join(map(get, split)))
            except KeyError:
                new = {p: self._piece(p) for p in {*split}.difference(have)}
                if len(have) < CACHE:
                    have.update(new)
                    out.append(b"".join(map(get, split)))
                else:  # the first pieces seen are the frequent ones: they stay
                    out.append(b"".join([new[p] if p in new else have[p] for p in split]))
        return out


@functools.lru_cache(maxsize=2)
def encoder(name: str) -> Encoder:
    """The task's encoder for a tokenizer file, kept while the Python worker lives."""
    return Encoder(name)
