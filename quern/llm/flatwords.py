"""Words of many texts at once, as flat numpy arrays.

A word is a longest run of a-z, 0-9 and _ in the lower-cased text.  A batch of
texts is handled as one byte buffer: lower-casing is a table lookup, word
borders are comparisons, and word hashes come from one running sum of
byte * P**position, so no Python object is made per word.  Work is cut into
pieces of about ``PIECE`` bytes (always whole texts), which bounds memory
whatever the batch size; a single longer text makes one longer piece.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np

PIECE = 1 << 20
_P = np.uint64(0x9E3779B97F4A7C15)
_PINV = np.uint64(pow(int(_P), -1, 1 << 64))
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S33 = np.uint64(33)

_TABLE = np.zeros(256, np.uint8)
for _c in b"abcdefghijklmnopqrstuvwxyz0123456789_":
    _TABLE[_c] = _c
for _c in b"ABCDEFGHIJKLMNOPQRSTUVWXYZ":
    _TABLE[_c] = _c + 32

_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser (in a new array); wraps silently."""
    h = h ^ (h >> _S33)
    h *= _M1
    h ^= h >> _S33
    h *= _M2
    h ^= h >> _S33
    return h


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, PIECE + 1)
        for k, base in enumerate((_P, _PINV)):
            a = np.full(size, base, np.uint64)
            a[0] = 1
            _powers[k] = np.multiply.accumulate(a)
    return _powers[0], _powers[1]


@dataclass
class Words:
    """Words of the texts ``first .. first + n - 1`` of a batch.

    hashes: a 64-bit hash per word; counts, starts: words of each text and the
    index of its first word; begin, end: byte range of each word in ``data``.
    """

    first: int
    n: int
    hashes: np.ndarray
    counts: np.ndarray
    starts: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    data: bytes
    text_begin: np.ndarray

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.n), self.counts)


def _encode(text: str | None) -> bytes:
    if not text:
        return b""
    # The only two letters outside ASCII whose lower case holds an ASCII letter.
    if "\u212a" in text or "\u0130" in text:
        text = text.replace("\u212a", "k").replace("\u0130", "i ")
    return text.encode("utf-8", "surrogatepass")


def pieces(texts: Sequence[str | None], size: int = PIECE) -> Iterator[Words]:
    """Cut a batch of texts (None counts as empty) into pieces of words."""
    group: list[bytes] = []
    total, first = 0, 0
    for i, text in enumerate(texts):
        b = _encode(text)
        if group and total + len(b) > size:
            yield _words(first, group)
            group, total, first = [], 0, i
        group.append(b)
        total += len(b) + 1
    if group:
        yield _words(first, group)


def _words(first: int, group: list[bytes]) -> Words:
    data = b"\n".join(group) + b"\n"
    lengths = np.fromiter(map(len, group), np.int64, len(group)) + 1
    text_begin = np.concatenate(([0], np.cumsum(lengths)))
    low = _TABLE[np.frombuffer(data, np.uint8)]
    inside = (low != 0).view(np.int8)
    edge = np.diff(inside, prepend=np.int8(0))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    powers, inverse = _power(len(low) + 1)
    total = np.empty(len(low) + 1, np.uint64)
    total[0] = 0
    np.cumsum(low.astype(np.uint64) * powers[: len(low)], out=total[1:])
    hashes = mix((total[end] - total[begin]) * inverse[begin])
    starts = np.searchsorted(begin, text_begin[:-1])
    counts = np.diff(np.append(starts, len(begin)))
    return Words(first, len(group), hashes, counts, starts, begin, end, data, text_begin)


def grams(words: Words, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all runs of k words inside one text: (hash, text, position)."""
    n = len(words.hashes) - k + 1
    if n <= 0:
        z = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), z, z
    text = words.text_of_word()
    h = np.zeros(n, np.uint64)
    for i in range(k):
        h *= _P
        h += words.hashes[i : i + n]
    ok = text[:n] == text[k - 1 :]
    at = np.flatnonzero(ok)
    text = text[at]
    return mix(h[at]), text, at - words.starts[text]
