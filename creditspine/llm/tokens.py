"""Token ids of whole texts with a public tokenizer, at the speed of its distinct words.

Both kinds of vocabulary never join characters across the places where texts
are cut here, so a piece between two cuts has the same ids alone as in the
text. Pieces seen before come from a bounded memory. A new piece that is one
plain word, or one with closing punctuation, goes straight to the library's
merge model; any other piece goes through the whole tokenizer.
"""

from __future__ import annotations

import os
import re
import string
from array import array
from collections.abc import Callable

import numpy as np
from tokenizers import Tokenizer

#: White space of any kind; next to a space or newline it may belong to one token with it.
SPACES = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
WORD_START = re.compile(r" (?=\S)")
ASCII_SPACE = re.compile("[ \t\n\x0b\x0c\r]+")
#: Begins a piece of byte-level text that no space goes before.
BARE = "\x00"
#: Pieces in each of the two generations that the memory holds.
GENERATION = 400_000
#: Longest piece that is remembered, in characters.
LONGEST = 64
CLOSING = string.punctuation


def byte_characters() -> dict[int, str]:
    """The printable character that byte-level vocabularies write for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


def loose(text: str) -> bool:
    """White space at an end, or any next to a space or newline."""
    # which kinds occur is quick to tell; most texts have two
    return text[:1].isspace() or text[-1:].isspace() or any(
        " " + c in text or "\n" + c in text or c + "\n" in text for c in SPACES if c in text)


def plain(word: str) -> bool:
    """A word whose letters are composed and lower-cased one by one, as all below U+0250 but one."""
    return word.isalpha() and (word.isascii() or max(word) < "ɐ" and "İ" not in word)


class Memory(dict):
    """Ids by piece; a piece that is asked for the first time is learned."""

    def __init__(self, learn: Callable[[str], bytes], old: dict[str, bytes]):
        super().__init__()
        self.learn, self.old = learn, old

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = self.learn(piece)
        if len(piece) <= LONGEST:
            self[piece] = ids
        return ids


class Encoder:
    """``encode_many`` gives the ids of each text as bytes of little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.byte_level = "a</w>" not in self.tokenizer.get_vocab()  # else words, lower-cased, without white space
        self.table = byte_characters()
        self.memory = Memory(self._learn, {})

    def _split(self, text: str) -> list[str]:
        """Pieces; of byte-level text the space before each is left out, and BARE marks those without one."""
        if not self.byte_level:
            return text.split() if text.isascii() and not any(c in text for c in "\x1c\x1d\x1e\x1f") else ASCII_SPACE.split(text)
        if loose(text):
            return WORD_START.split(BARE + text)
        return (BARE + text.replace("\n", " \n " + BARE)).split(" ")

    def _learn(self, piece: str) -> bytes:
        bare = self.byte_level and piece[:1] == BARE
        space = " " if self.byte_level and not bare and piece != "\n" else ""
        text = piece[1:] if bare else piece
        core = text.rstrip(CLOSING) if len(piece) <= LONGEST else ""
        if not plain(core):
            return self._alone(space + text)
        if core != text:
            # the closing punctuation is a piece of its own
            n = len(core) - len(text)
            return self.memory[piece[:n]] + self.memory[BARE + text[n:] if self.byte_level else text[n:]]
        word = space + (text if self.byte_level else text.lower())
        if space or not word.isascii():
            word = word.encode().decode("latin-1").translate(self.table)
        return array("I", [t.id for t in self.model.tokenize(word)]).tobytes()

    def _alone(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def encode_many(self, texts: list[str]) -> list[bytes]:
        get = self.memory.__getitem__
        # a text that holds the mark itself is not cut
        out = [self._alone(t) if BARE in t else b"".join(map(get, self._split(t))) for t in texts]
        if len(self.memory) > GENERATION:
            self.memory = Memory(self._learn, dict(self.memory))
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this worker process; its memory outlives a task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
