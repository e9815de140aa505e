"""Token ids of whole texts by a vocabulary of the ``tokenizers`` library.

The library spends its time on words it has met before, so a worker
remembers the ids of white-space separated chunks. That is exact where the
tokenizer never looks across white space; ``chunked`` reads from the
vocabulary's file whether it is of that kind, and texts with white space
that the library does not count as such are encoded as a whole.
"""

from __future__ import annotations

import json
import os
import re
from array import array

import numpy as np
import regex

from .byte_bpe import CACHE_BYTES, Recent

# Fixed value: the pattern of the public word vocabulary.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Python's str.split() also cuts at these four, and the library does not.
OTHER = "\x1c\x1d\x1e\x1f"
_plain = "ƀ"  # below: no combining marks, and one-to-one lower case but for one


class WordTokens:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            setup = json.load(f)
        self.chunked, self.pattern = _shape(setup)
        self.special = tuple(t["content"] for t in setup.get("added_tokens", ()))
        self.letters = _byte_letters()
        # A run of letters is one piece by this pattern, and a character
        # after it another.
        self.one_run = self.pattern is not None and self.pattern.pattern == WORDS and not any(t.isalpha() or t[:-1].isalpha() for t in self.special)
        self.pieces = Recent(self._piece)
        self.chunks = Recent(self._chunk, 2 * CACHE_BYTES)  # words in lower case too, as most pieces are

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        """One match of the pattern, straight through the library's model."""
        # Printable ASCII stands for itself, and a piece has no white space.
        letters = piece if piece.isascii() and piece.isprintable() else "".join(map(self.letters.__getitem__, piece.encode()))
        return array("I", [t.id for t in self.tokenizer.model.tokenize(letters)]).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        if self.pattern is None or not chunk.isascii() and max(chunk) >= _plain:
            return self._whole(chunk)
        if self.one_run:  # most chunks are a word, or a word and a mark
            if chunk.isalpha():
                if (low := chunk.lower()).isalpha():  # one capital becomes two characters
                    return self._piece(low) if low == chunk else self.chunks[low]
            elif (low := chunk[:-1].lower()).isalpha():
                return self.chunks[low] + self.pieces[chunk[-1]]
        if any(s in chunk for s in self.special):
            return self._whole(chunk)
        return b"".join(map(self.pieces.__getitem__, self.pattern.findall(chunk.lower())))

    def ids(self, text: str | None) -> np.ndarray:
        """uint32 ids, without special tokens; none for a null text."""
        if not text:
            return np.zeros(0, np.uint32)
        if not self.chunked or any(c in text for c in OTHER):
            return np.frombuffer(self._whole(text), np.uint32)
        return np.frombuffer(b"".join(map(self.chunks.__getitem__, text.split())), np.uint32)


def _shape(setup: dict) -> tuple[bool, regex.Pattern | None]:
    """Whether chunks may be encoded one by one; and the pattern of pieces,
    if they may go straight to the model: NFC, white space, lower case, then
    the matches of a pattern (none with white space) as byte letters."""
    norm, pre = setup.get("normalizer") or {}, setup.get("pre_tokenizer") or {}
    steps = [n.get("type") for n in norm.get("normalizers", [norm])]
    cuts = pre.get("pretokenizers", [pre])
    if steps != ["NFC", "Replace", "Lowercase"] or norm["normalizers"][1]["pattern"] != {"Regex": "\\s+"} or norm["normalizers"][1]["content"] != " ":
        return False, None
    if [c.get("type") for c in cuts] != ["Split", "ByteLevel"] or cuts[0]["behavior"] != "Removed" or not cuts[0]["invert"] or cuts[1]["add_prefix_space"] or cuts[1]["use_regex"]:
        return False, None
    pattern = cuts[0]["pattern"].get("Regex", "")
    if setup.get("post_processor") or any(t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"]) for t in setup.get("added_tokens", ())):
        return False, None
    compiled = regex.compile(pattern)
    if compiled.search(" \t\n"):
        return False, None
    return True, compiled


def _byte_letters() -> list[str]:
    """A printable letter per byte: printable Latin-1 stands for itself, the
    other bytes in turn for the letters from 256 on."""
    letters, spare = [], 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            letters.append(chr(b))
        else:
            letters.append(chr(spare))
            spare += 1
    return letters


_loaded: dict[str, WordTokens] = {}


def word_tokens(path: str) -> WordTokens:
    """One per Python worker, from the worker's own copy of the vocabulary."""
    if path not in _loaded:
        _loaded[path] = WordTokens(path)
    return _loaded[path]
