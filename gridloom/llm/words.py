"""Hashes of the words of many texts at once, without a Python object per word.

A word's hash is that of its bytes by a polynomial over the text, so one running sum gives the hashes
of all words. ASCII letters count as small ones.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import xxhash

#: Bytes that are worked on together; longer texts are cut at white space.
STRETCH = 1 << 18
_SPACE = re.compile(rb"[ \t\n\r\x0b\x0c]")
_BASE = 0x9E3779B97F4A7C15
_ODD = np.uint64(_BASE)
BLANK = bytes([9, 10, 11, 12, 13, 32])
#: All but ASCII letters and the bytes of other characters.
NOT_LETTERS = bytes(b for b in range(128) if not chr(b).isalpha())
#: The same, but digits are in words.
NOT_IN_WORDS = bytes(b for b in range(128) if not chr(b).isalnum())


def stretches(data: bytes, most: int = STRETCH) -> Iterator[bytes]:
    """The text in parts of about ``most`` bytes, cut at ASCII white space only."""
    at = 0
    while len(data) - at > most:
        space = _SPACE.search(data, at + most)
        if space is None:
            break
        yield data[at : space.start()]
        at = space.end()
    yield data[at:] if at else data


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _ODD
    return x ^ (x >> np.uint64(29))


@lru_cache(maxsize=4)
def _values(between: bytes) -> np.ndarray:
    """A number per byte, none for what stands between words."""
    small = [ord(chr(b).lower()) if b < 128 else b for b in range(256)]
    values = [0 if b in between else xxhash.xxh3_64_intdigest(bytes([s])) | 1 for b, s in enumerate(small)]
    return np.array(values, dtype=np.uint64)


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _ODD), np.full(n, np.uint64(pow(_BASE, -1, 1 << 64)))
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def hashed_words(data: bytes, between: bytes = BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end of each word, in order."""
    values = _values(between)[np.frombuffer(data, np.uint8)]
    inside = np.zeros(len(values) + 2, dtype=bool)
    np.not_equal(values, 0, out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    first, end = edges[::2], edges[1::2]
    up, down = _powers(1 << max(19, (len(values) + 1).bit_length()))
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return mixed((total[end] - total[first]) * down[first]), first, end


def word_arrays(texts: Iterable[bytes], between: bytes = BLANK) -> Iterator[np.ndarray]:
    """The word hashes of each text, in order."""
    held: list[bytes] = []
    size = 0

    def together() -> Iterator[np.ndarray]:
        if held:
            words, first, _ = hashed_words(b"\n".join(held), between)
            starts = np.cumsum([0] + [len(t) + 1 for t in held])
            at = np.searchsorted(first, starts)
            for i in range(len(held)):
                yield words[at[i] : at[i + 1]]

    for text in texts:
        if size + len(text) > STRETCH:
            yield from together()
            held, size = [], 0
        if len(text) > STRETCH:
            yield np.concatenate([hashed_words(part, between)[0] for part in stretches(text)])
        else:
            held.append(text)
            size += len(text) + 1
    yield from together()
