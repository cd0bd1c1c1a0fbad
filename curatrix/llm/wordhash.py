"""Words of whole Arrow batches as 64-bit hashes, by array arithmetic over their bytes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
_P = 0x9E3779B97F4A7C15 | 1
_P_INVERSE = pow(_P, -1, 1 << 64)
_MULTIPLIERS = [U(pow(0xD6E8FEB86659FD93, i + 1, 1 << 64) | 1) for i in range(16)]


def mixed(h: np.ndarray) -> np.ndarray:
    """Finaliser: spreads every input bit over the word."""
    h = (h ^ (h >> U(32))) * U(0xD6E8FEB86659FD93)
    h = (h ^ (h >> U(29))) * U(0xBF58476D1CE4E5B9)
    return h ^ (h >> U(32))


_WORD_BYTE = np.zeros(256, bool)
for _r in (range(48, 58), range(65, 91), range(97, 123), range(128, 256)):
    _WORD_BYTE[list(_r)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_P, _P_INVERSE)):
            t = np.full(n, base, U)
            t[0] = 1
            _powers[k] = np.multiply.accumulate(t)
    return _powers


@dataclass
class Words:
    """Words of consecutive texts: start/end bytes, hash, the text of each word and each text's range."""

    data: np.ndarray
    text_start: np.ndarray
    text_end: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    text: np.ndarray
    first: np.ndarray
    past: np.ndarray
    sums: np.ndarray

    def context(self, order: int, salt: np.ndarray | int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the ``order`` words ending at each word, and whether that many lie in its text."""
        acc = np.zeros(len(self.hash), U)
        for back in range(order):
            acc[back:] += self.hash[: len(self.hash) - back or None][: len(self.hash) - back] * _MULTIPLIERS[back]
        inside = np.arange(len(self.hash)) - self.first[self.text] >= order - 1
        return mixed(acc + np.asarray(salt, U) * U(0x9E3779B97F4A7C15) + U(order)), inside

    def span(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of the bytes from ``start`` to ``end``, whatever they are; ASCII case is folded."""
        return mixed((self.sums[end] - self.sums[start]) * _power_tables(len(self.data) + 1)[1][start])


def words_of(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> Words:
    """Words of the texts data[start[i]:end[i]] (in order, not overlapping).

    A word is a run of ASCII letters and digits and of non-ASCII bytes other than general punctuation,
    Latin-1 signs, byte-order marks and replacement characters; ASCII case is folded.
    """
    is_word = _WORD_BYTE[data]
    n = len(data)
    if n > 2:
        lead2 = (data[:-1] == 0xC2) & (data[1:] < 0xC0)
        is_word[:-1][lead2] = False
        is_word[1:][lead2] = False
        lead3 = ((data[:-2] == 0xE2) & ((data[1:-1] == 0x80) | (data[1:-1] == 0x81))) | (
            (data[:-2] == 0xEF) & (((data[1:-1] == 0xBF) & (data[2:] == 0xBD)) | ((data[1:-1] == 0xBB) & (data[2:] == 0xBF)))
        )
        for k in range(3):
            is_word[k : n - 2 + k][lead3] = False
    inside = np.zeros(n + 1, np.int32)
    np.add.at(inside, start, 1)
    np.add.at(inside, end, -1)
    is_word &= np.cumsum(inside[:n]) > 0
    at_start = np.zeros(n + 1, bool)
    at_start[start] = True
    before = np.zeros(n, bool)
    before[1:] = is_word[:-1]
    begins = np.nonzero(is_word & (~before | at_start[:n]))[0]
    after = np.zeros(n, bool)
    after[:-1] = is_word[1:]
    ends = np.nonzero(is_word & (~after | at_start[1:]))[0] + 1
    up, down = _power_tables(n + 1)
    total = np.zeros(n + 1, U)
    np.cumsum((_LOWER[data].astype(U) + U(1)) * up[:n], out=total[1:])
    h = mixed((total[ends] - total[begins]) * down[begins])
    text = np.searchsorted(start, begins, side="right") - 1
    first = np.searchsorted(begins, start)
    past = np.searchsorted(begins, end)
    return Words(data, start, end, begins, ends, h, text, first, np.maximum(past, first), total)


def text_chunks(column: pa.Array, most_bytes: int = 1_000_000) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(from row, to row, bytes, offsets) of pieces of a string column; a null is an empty text."""
    whole = column.cast(pa.large_binary())
    offsets = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset : whole.offset + len(whole) + 1]
    raw = whole.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(whole):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most_bytes, side="right")) - 1)
        to = min(to, len(whole))
        yield at, to, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to
