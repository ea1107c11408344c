"""MD5 of many short texts at once, for hashes that differ by a prefix only.

``F.md5`` hashes a row and prefix at a time, and most of its cost is around the
hash: the digest object, its hexadecimal text and that text's number.  Here a
step of MD5 is one numpy operation on a column of words.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa

_ADDED = [int(abs(math.sin(i + 1)) * 2**32) for i in range(64)]
_TURNS = [n for four in ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)) for n in four * 4]
_WORD = [(i, 5 * i + 1, 3 * i + 5, 7 * i)[i // 16] % 16 for i in range(64)]
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)


class Md5Messages:
    """Texts to be hashed behind prefixes; a text that is not null follows
    ``separator`` (as in ``concat_ws``)."""

    def __init__(self, texts: pa.Array, separator: str = ""):
        tails = [b"" if t is None else separator.encode() + t.encode() for t in texts.to_pylist()]
        self.lengths = np.fromiter(map(len, tails), np.int64, len(tails))
        self.data = np.frombuffer(b"".join(tails), np.uint8)
        self.padded: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

    def _words(self, prefix: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For a prefix of that many bytes, left empty: the texts by number of
        blocks, and their words, a row a word."""
        if prefix not in self.padded:
            total = self.lengths + prefix
            blocks = (total + 8) // 64 + 1
            row = np.repeat(np.arange(len(total)), self.lengths)
            column = np.arange(len(self.data)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths) + prefix
            self.padded[prefix] = []
            for count in np.unique(blocks):
                some = np.flatnonzero(blocks == count)
                place = np.full(len(total), -1)
                place[some] = np.arange(len(some))
                raw = np.zeros((len(some), 64 * count), np.uint8)
                here = place[row] >= 0
                raw[place[row[here]], column[here]] = self.data[here]
                raw[np.arange(len(some)), total[some]] = 0x80
                raw[:, -8:] = (total[some] * 8).astype("<u8")[:, None].view(np.uint8)
                self.padded[prefix].append((some, np.ascontiguousarray(raw.view("<u4").T)))
        return self.padded[prefix]

    def leading(self, prefix: str) -> np.ndarray:
        """The number of the first seven hexadecimal digits of each hash."""
        start = prefix.encode()
        head = np.frombuffer(start + bytes(-len(start) % 4), "<u4")
        out = np.empty(len(self.lengths), np.uint32)
        for some, words in self._words(len(start)):
            first = [w | h for w, h in zip(words, head)]
            out[some] = _first_word([*first, *words[len(first) :]]).byteswap() >> 4
        return out


def _first_word(words: list[np.ndarray]) -> np.ndarray:
    state = [np.full(len(words[0]), v, np.uint32) for v in _START]
    f = np.empty_like(state[0])
    for at in range(0, len(words), 16):
        a, b, c, d = (v.copy() for v in state)
        for i in range(64):
            if i < 16:
                np.bitwise_xor(c, d, out=f)
                f &= b
                f ^= d
            elif i < 32:
                np.bitwise_xor(b, c, out=f)
                f &= d
                f ^= c
            elif i < 48:
                np.bitwise_xor(b, c, out=f)
                f ^= d
            else:
                np.invert(d, out=f)
                f |= b
                f ^= c
            a += f
            np.add(words[at + _WORD[i]], np.uint32(_ADDED[i]), out=f)
            a += f
            np.left_shift(a, np.uint32(_TURNS[i]), out=f)
            a >>= np.uint32(32 - _TURNS[i])
            a |= f
            a += b
            a, b, c, d = d, a, b, c
        for total, part in zip(state, (a, b, c, d)):
            total += part
    return state[0]
