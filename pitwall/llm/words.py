"""Words and word hashes of Arrow text columns, computed on whole buffers.

A text is cut into words on the UTF-8 bytes of the column, without a Python string per
word. Hashes are 64-bit polynomial sums over random byte values, mixed at the end; all
arithmetic is modulo 2**64. Long columns are taken in chunks of documents, so the memory
needed follows the longest text, not the column.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1_000_000
LETTER_CHUNK = 250_000
#: Powers kept between calls, as many as a chunk of usual texts needs; those of a very long text are dropped.
KEPT_POWERS = 1 << 20
SPACES = frozenset([0x20, *range(0x09, 0x0E)])

_BYTE_VALUES = np.random.default_rng(20_240_501).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_GRAM_BASES = (0xD1342543DE82EF95, 0xAF251AF3B0F025B5)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = values ^ (values >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i for i below n at least."""
    known = _powers.get(base)
    if known is None or len(known[0]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        inverse = pow(base, -1, 2**64)
        known = tuple(_running_product(b, size) for b in (base, inverse))
        if size <= KEPT_POWERS:
            _powers[base] = known
    return known


def forget_powers() -> None:
    """Free what powers has kept."""
    _powers.clear()


def _running_product(base: int, size: int) -> np.ndarray:
    factors = np.full(size, base, np.uint64)
    factors[0] = 1
    return np.multiply.accumulate(factors)


def span_sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Of each span: the sum of values[start + j] * base**j."""
    up, down = powers(base, len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return (sums[ends] - sums[starts]) * down[starts]


@dataclass
class Words:
    """The words of consecutive documents: hash and byte span, and where each document's words begin."""

    first_row: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray

    @property
    def n_docs(self) -> int:
        return len(self.bounds) - 1

    def grams(self, k: int, lane: int = 0) -> np.ndarray:
        """A hash for each k consecutive words, at the position of the first (also across documents)."""
        at = np.arange(max(0, len(self.hashes) - k + 1))
        words = self.hashes if not lane else mixed(self.hashes + np.uint64(lane))
        return mixed(span_sums(words, at, at + k, _GRAM_BASES[lane]) + np.uint64(k))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string column; a null has no bytes."""
    if pa.types.is_dictionary(column.type):
        column = column.dictionary_decode()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return offsets, np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)


def split_words(column: pa.Array, is_word: np.ndarray, byte_map: np.ndarray | None = None) -> Iterator[Words]:
    """Cuts each text into the longest runs of bytes that is_word (256 booleans) marks, after byte_map."""
    offsets, data = text_buffer(column)
    row, n = 0, len(column)
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + CHUNK_BYTES, "right")) - 1)
        end = min(end, n)
        yield _words_of(row, offsets[row : end + 1] - offsets[row], data[offsets[row] : offsets[end]], is_word, byte_map)
        row = end


def _words_of(row, offsets, data, is_word, byte_map) -> Words:
    if byte_map is not None:
        data = byte_map[data]
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = is_word[data]
    cuts = np.zeros(len(data) + 1, bool)
    cuts[offsets] = True
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | cuts))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | cuts))
    sums = span_sums(_BYTE_VALUES[data], starts, ends, _BASE)
    hashes = mixed(sums + (ends - starts).astype(np.uint64))
    return Words(row, data, starts, ends, hashes, np.searchsorted(starts, offsets))


def byte_set(separators: frozenset[int]) -> np.ndarray:
    """Marks every byte but the separators."""
    table = np.ones(256, bool)
    table[list(separators)] = False
    return table


#: Lower-cases A-Z and nothing else.
ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32
NOT_SPACE = byte_set(SPACES)


@dataclass
class LetterWords:
    """The lower-cased letter runs of consecutive documents: code points (0 between words), spans, hashes, bounds."""

    first_row: int
    values: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray

    @property
    def n_docs(self) -> int:
        return len(self.bounds) - 1

    def letter_grams(self, starts: np.ndarray, n: int) -> np.ndarray:
        """Hashes of n code points from each start on."""
        return mixed(span_sums(self.values, starts, starts + n, _LETTER_BASE) + np.uint64(n))


_LETTER_BASE = 0xE7037ED1A0B428DB
_letters: list[np.ndarray] = []


def letter_words(column: pa.Array) -> Iterator[LetterWords]:
    """Cuts each text, lower-cased, into its longest runs of letters."""
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    is_letter = _letters[0]
    row, texts, held = 0, [], 0
    for i, text in enumerate(column):
        texts.append((text.as_py() or "").lower())
        held += len(texts[-1])
        if held >= LETTER_CHUNK or i + 1 == len(column):
            lengths = np.array([len(t) for t in texts]) + 2
            # Two code points that are no letters set documents apart.
            points = np.frombuffer(("\0\0".join(texts) + "\0\0").encode("utf-32-le"), np.uint32)
            offsets = np.append(0, np.cumsum(lengths))
            inside = np.concatenate([[False], is_letter[points]])
            points = np.concatenate([np.zeros(1, np.uint32), points])
            starts = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
            ends = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
            values = np.where(inside, mixed(points.astype(np.uint64)), np.uint64(0))
            sums = span_sums(values, starts, ends, _LETTER_BASE)
            hashes = mixed(sums ^ (ends - starts).astype(np.uint64))
            yield LetterWords(row, values, starts, ends, hashes, np.searchsorted(starts, offsets + 1))
            row, texts, held = i + 1, [], 0
