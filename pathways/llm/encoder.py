"""Ids of texts by the tokenizers library, with remembered pieces.

Encoding a text splits it into pieces whose ids do not depend on each other. The
pieces of ordinary text repeat, so each worker keeps the ids of those it has met,
up to a bound; the ids themselves always come from the library. Texts for which
the split is not certain are encoded whole.
"""

from __future__ import annotations

import json
import re
import sys
from array import array

import numpy as np
from tokenizers import Tokenizer

MOST_CHUNKS = 600_000
MOST_PIECES = 600_000

# White space on which Python and the library's expressions may differ.
_ODD = re.compile("[\x1c-\x1f\x85\xa0 ᠎ -     　]")
# A word of letters that no normal form joins with others, and the marks after it.
_MARKS = ".,;:!?"
_PLAIN = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+)([.,;:!?]*)")


def odd(text: str) -> bool:
    """Some white space in the text is not certain to be white space to the library."""
    if text.isascii():
        return "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text
    return _ODD.search(text) is not None


class Remembered(dict):
    """Values made on first use; beyond ``most`` they are made anew each time."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key):
        value = self.make(key)
        if len(self) < self.most:
            self[key] = value
        return value


class Encoder:
    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        pre = told["pre_tokenizer"]
        steps = pre["pretokenizers"] if pre["type"] == "Sequence" else [pre]
        first = steps[0]
        kept = first["type"] == "ByteLevel" and first["use_regex"] and not first["add_prefix_space"]
        dropped = first["type"] == "Split" and first["behavior"] == "Removed" and first["invert"]
        self.drops_space = dropped and told["normalizer"] is not None
        self.keeps_space = kept and told["normalizer"] is None
        self.special = [t["content"] for t in told["added_tokens"]]
        self._special = re.compile("|".join(map(re.escape, self.special)) or r"(?!)")
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self._code = "H" if self.dtype.itemsize == 2 else "I"
        alphabet = {b: c for b, c in zip(range(256), self._byte_characters())}
        self._bytes = {b: ord(c) for b, c in alphabet.items()}
        self.by_piece = Remembered(self._piece_ids, MOST_PIECES)
        self.by_chunk = Remembered(lambda c: self._chunk_ids(c) if c.isalpha() or self._certain(c) else None, MOST_CHUNKS)
        self.after_space = Remembered(lambda c: self._chunk_ids(" " + c) if c.isalpha() or self._certain(c) else None, MOST_CHUNKS)
        self.line_end = self._chunk_ids("\n") if self.keeps_space else b""

    def _byte_characters(self) -> list[str]:
        """The characters that stand for bytes 0 to 255 in byte-level vocabularies, by their rule."""
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        hidden = [b for b in range(256) if b not in shown]
        return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]

    def pieces(self, chunk: str) -> list[str]:
        """Pre-tokens of a stretch of text without special tokens, as the model gets them."""
        space = self.keeps_space and chunk[:1] == " "
        if self.drops_space or self.keeps_space:
            # The common case of what follows: ASCII letters, and marks after them.
            own = chunk[1:] if space else chunk
            word = own.rstrip(_MARKS)
            if word.isascii() and word.isalpha():
                marks = own[len(word) :]
                word = word.lower() if self.drops_space else chr(self._bytes[32]) + word if space else word
                return [word, marks] if marks else [word]
        plain = _PLAIN.fullmatch(chunk, 1 if space else 0) if self.drops_space or self.keeps_space else None
        if plain:
            word, marks = plain.groups()
            if self.drops_space:
                word = word.lower()
            if not word.isascii():
                word = word.encode().decode("latin-1").translate(self._bytes)
            if space:
                word = chr(self._bytes[32]) + word
            return [word, marks] if marks else [word]
        tk = self.tokenizer
        if tk.normalizer is not None:
            chunk = tk.normalizer.normalize_str(chunk)
        return [p for p, _ in tk.pre_tokenizer.pre_tokenize_str(chunk)]

    def count(self, piece: str) -> int:
        return len(self.tokenizer.model.tokenize(piece))

    @staticmethod
    def _certain(chunk: str) -> bool:
        """No white space within or at the ends, so that the chunk is split like any other."""
        return chunk.split() == [chunk] and "\u180e" not in chunk

    def _piece_ids(self, piece: str) -> bytes:
        ids = array(self._code, [t.id for t in self.tokenizer.model.tokenize(piece)])
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def _chunk_ids(self, chunk: str) -> bytes:
        return b"".join([self.by_piece[p] for p in self.pieces(chunk)])

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def parts(self, text: str) -> tuple[int, list[str]]:
        """Special tokens found, and chunks whose pre-tokens together are those of the text."""
        if "<" in text and self._special.search(text):
            found, between = len(self._special.findall(text)), self._special.split(text)
        else:
            found, between = 0, [text]
        if not self.drops_space:
            return found, between
        return found, [c for t in between for c in ([t] if odd(t) else t.split())]

    def ids(self, text: str) -> bytes:
        """Ids as little-endian integers of ``dtype``."""
        if not text:
            return b""
        if "<" in text and self._special.search(text):
            return self.whole(text)
        if self.drops_space and not odd(text):
            return b"".join(map(self.by_chunk.__getitem__, text.split()))
        if self.keeps_space:
            spaced = self.after_space.__getitem__
            lines = []
            try:
                for line in text.split("\n"):
                    first, *rest = line.split(" ")
                    lines.append(b"".join([self.by_chunk[first], *map(spaced, rest)]))
                return self.line_end.join(lines)
            except TypeError:  # a chunk that is not certain has no bytes
                pass
        return self.whole(text)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's own encoder for a tokenizer file, kept from task to task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
