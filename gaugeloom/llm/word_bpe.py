"""Fast exact encoding with a word-level BPE tokenizer file."""

from __future__ import annotations

import re
import struct

from tokenizers import Tokenizer

REMEMBERED = 500_000
#: Words of these characters alone need no Unicode normalisation, and their lower case is plain.
PLAIN = re.compile(r"[!-&(-;=-~À-ÖØ-öø-ÿ]+")
PIECES = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


def _byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies use for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class _Memory(dict):
    def __init__(self, make) -> None:
        super().__init__()
        self.make = make

    def __missing__(self, key):
        self[key] = got = self.make(key)
        return got


class WordEncoder:
    """Ids of whole texts as little-endian unsigned 32-bit integers.

    For tokenizers that drop white space and never join over it: each word is encoded once and
    remembered. Plain words go piece by piece to the BPE model; all others through the whole tokenizer.
    What is remembered is bounded and forgotten when full.
    """

    def __init__(self, path: str) -> None:
        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.letters = _byte_letters()
        self.words = _Memory(self._word)
        self.pieces = _Memory(self._piece)

    def _piece(self, piece: str) -> bytes:
        letters = piece if piece.isascii() else "".join(self.letters[b] for b in piece.encode())
        ids = [x.id for x in self.model.tokenize(letters)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _word(self, word: bytes) -> bytes:
        core = word.rstrip(b".,")
        if core.isalpha() and len(word) - len(core) <= 1:
            tail = word[len(core) :].decode()
            got = self.pieces[core.lower().decode()]
            return got + self.pieces[tail] if tail else got
        text = word.decode("utf-8", "replace")
        if PLAIN.fullmatch(text):
            return b"".join([self.pieces[x] for x in PIECES.findall(text.lower())])
        ids = self.whole.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: bytes) -> bytes:
        for memory in (self.words, self.pieces):
            if len(memory) > REMEMBERED:
                memory.clear()
        return b"".join(map(self.words.__getitem__, text.split()))
