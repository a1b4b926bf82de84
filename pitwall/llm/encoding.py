"""Texts to token ids by a public tokenizer, with the ids of common pieces remembered.

Both tokenizers cut a text into pieces before they merge bytes, and no piece crosses
certain places in the text. Cut at those places only, the ids of the parts, one after the
other, are the ids of the text. Parts repeat, so most are looked up. A new part that is a
word of Latin letters, perhaps with punctuation after it, is one or two pieces and goes to
the library's BPE model; any other new part goes through the library's whole tokenizer.
"""

import re
from array import array

from tokenizers import Tokenizer

#: Parts remembered in each of two generations, some 60 MB each; the older one is dropped when the newer is full.
REMEMBERED = 300_000
LONGEST_REMEMBERED = 64

# Before a single space that stands between two characters other than white space.
_BEFORE_SPACE = re.compile(r"(?<=\S)(?= \S)")
# Python takes these for white space; the library's pattern may not.
_SEPARATORS = "\x1c\x1d\x1e\x1f"
_LATIN_WORD = re.compile(r"( ?)([A-Za-zß-öø-ÿ]+)([.,;:!?*#$%&|)\]\"]*)\Z")
# Byte-level vocabularies write a byte as the character of its number if that is printable,
# and else as the next one from 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_CHARACTERS = {b: b for b in _PRINTABLE} | {
    b: 256 + i for i, b in enumerate(b for b in range(256) if b not in set(_PRINTABLE))
}
_UINT32 = "I"
_encoders: dict[tuple[str, str], "Encoder"] = {}


class Encoder:
    """encode(text): ids as little-endian unsigned 32-bit integers in bytes.

    spaces: "kept" if a space belongs to the piece after it, as in byte-level vocabularies;
    "dropped" if white space only sets pieces apart and letters are lower-cased.
    """

    def __init__(self, path: str, spaces: str, remembered: int = REMEMBERED):
        self.remembered = remembered
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = [token.content for token in added.values()]
        self.kept = spaces == "kept"
        self.newer: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @classmethod
    def of(cls, path: str, spaces: str, remembered: int = REMEMBERED) -> "Encoder":
        """One encoder per process, so that later tasks find what earlier ones have learnt."""
        if (path, spaces) not in _encoders:
            _encoders[path, spaces] = cls(path, spaces, remembered)
        return _encoders[path, spaces]

    def rest(self) -> None:
        """Forget the older generation, where a task ends and other work follows."""
        self.older = {}

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if any(token in text for token in self.special):
            return self._by_library(text)
        known, learn = self.newer.get, self._ids
        words = text.split()
        if not self.kept:
            if any(c in text for c in _SEPARATORS):
                return self._by_library(text)
            return b"".join([known(word) or learn(word) for word in words])
        gaps = text.count(" ") + text.count("\n")
        if len(words) != gaps + 1 or sum(map(len, words)) + gaps != len(text):
            # White space other than single spaces and line ends between words.
            return b"".join([learn(part) for part in _BEFORE_SPACE.split(text)])
        lines, newline = [], learn("\n")
        for line in text.split("\n"):
            first, *others = line.split(" ")
            lines.append(b"".join([learn(first), *(known(" " + word) or learn(" " + word) for word in others)]))
        return newline.join(lines)

    def _ids(self, part: str) -> bytes:
        ids = self.newer.get(part) or self.older.get(part)
        if ids is None:
            word = _LATIN_WORD.match(part)
            if word is None or not self.kept and word[1]:
                ids = self._by_library(part)
            elif word[3]:
                ids = self._ids(part[: word.start(3)]) + self._ids(word[3])
            else:
                ids = self._by_model(part)
        if len(part) <= LONGEST_REMEMBERED:
            if len(self.newer) >= self.remembered:
                self.older = self.newer.copy()
                self.newer.clear()
            self.newer[part] = ids
        return ids

    def _by_model(self, word: str) -> bytes:
        if not self.kept:
            word = word.lower()
        if not word.isascii() or word[0] == " ":
            word = word.encode().decode("latin-1").translate(_BYTE_CHARACTERS)
        return array(_UINT32, [token.id for token in self.model.tokenize(word)]).tobytes()

    def _by_library(self, text: str) -> bytes:
        return array(_UINT32, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
