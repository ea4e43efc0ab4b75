"""Texts as flat byte arrays inside tasks: words, lines and hashes of byte spans without Python loops.

An Arrow column of texts becomes blocks of about a megabyte.  Each text is followed by one line end,
so that no word or line ever reaches into the next text.  Null texts are empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20
WORD = r"[^\x20\x09-\x0D]+"

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LINE_END = (pa.scalar("", pa.large_string()), pa.scalar("\n", pa.large_string()))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_U = np.uint64


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit over all output bits."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_FIRST_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], _U)  # keeps so many bytes of eight
_STEP, _LENGTH = _U(0x9E3779B97F4A7C15), _U(0xA0761D6478BD642F)


def _family(seed: int) -> np.uint64:
    return _U((seed + 1) * 0xD1342543DE82EF95 % (1 << 64))


def _places(begin: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(span, number within the span, place) of all units of spans that hold ``count`` units from ``begin`` on."""
    span = np.repeat(np.arange(len(begin)), count)
    step = np.arange(len(span)) - np.repeat(np.cumsum(count) - count, count)
    return span, step, begin[span] + step


def _sum_by(span: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums modulo 2**64 of values by their span; spans ascend."""
    out = np.zeros(n, _U)
    if len(span):
        at = np.flatnonzero(np.diff(span, prepend=-1))
        out[span[at]] = np.add.reduceat(values, at)
    return out


@dataclass
class Block:
    """Consecutive texts: ``data`` holds text, line end, text, line end...; ``starts`` has one entry more than texts."""

    data: np.ndarray
    starts: np.ndarray

    def __len__(self) -> int:
        return len(self.starts) - 1

    @property
    def n_bytes(self) -> np.ndarray:
        return np.diff(self.starts) - 1

    @cached_property
    def _words(self) -> tuple[np.ndarray, np.ndarray]:
        space = _SPACE[self.data]
        before = np.empty_like(space)
        before[:1] = True
        before[1:] = space[:-1]
        return np.flatnonzero(before & ~space), np.flatnonzero(space & ~before)

    @property
    def word_from(self) -> np.ndarray:
        return self._words[0]

    @property
    def word_to(self) -> np.ndarray:
        return self._words[1]

    @cached_property
    def words_at(self) -> np.ndarray:
        """For each text its first word's number, and at the end the number of words."""
        return np.searchsorted(self.word_from, self.starts)

    @property
    def n_words(self) -> np.ndarray:
        return np.diff(self.words_at)

    @cached_property
    def line_to(self) -> np.ndarray:
        return np.flatnonzero(self.data == 0x0A)

    @cached_property
    def line_from(self) -> np.ndarray:
        return np.concatenate([np.zeros(min(1, len(self.line_to)), np.int64), self.line_to[:-1] + 1])

    @cached_property
    def lines_at(self) -> np.ndarray:
        """For each text its first line's number, and at the end the number of lines."""
        return np.searchsorted(self.line_from, self.starts)

    @cached_property
    def _eights(self) -> np.ndarray:
        """The eight bytes from each place on as one number."""
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        return np.ndarray(len(self.data) + 1, "<u8", padded.data, strides=(1,))

    def span_hash(self, begin: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
        """64-bit hashes of byte spans; equal bytes have equal hashes wherever they lie.

        The sum over a span's pieces of eight bytes of a mixture of piece and place, so that no pattern of
        the bytes makes different spans alike.  Seeds give independent hashes.
        """
        begin, size = np.asarray(begin, np.int64), np.asarray(end, np.int64) - begin
        family = _family(seed)
        total = mix64((self._eights[begin] & _FIRST_BYTES[np.clip(size, 0, 8)]) + family)
        if len(long := np.flatnonzero(size > 8)):
            span, step, _ = _places(np.zeros(len(long), np.int64), (size[long] - 1) >> 3)
            place = begin[long][span] + 8 * (step + 1)
            kept = np.minimum(begin[long][span] + size[long][span] - place, 8)
            pieces = mix64((self._eights[place] & _FIRST_BYTES[kept]) + family + (step + 1).astype(_U) * _STEP)
            total[long] += _sum_by(span, pieces, len(long))
        return mix64(total + size.astype(_U) * _LENGTH)

    def window_keys(self, size: int) -> np.ndarray:
        """A number for the ``size`` bytes (a multiple of eight) from each place on: equal for equal bytes, else mostly not."""
        n = len(self.data) - size + 1
        total = np.zeros(n, _U)
        for k in range(0, size, 8):
            total += self._eights[k : k + n] * _family(k)
        return mix64(total)

    @cached_property
    def word_hash(self) -> np.ndarray:
        return self.span_hash(self.word_from, self.word_to)

    @cached_property
    def _other_word_hash(self) -> np.ndarray:
        return self.span_hash(self.word_from, self.word_to, 1)

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of each window of ``k`` words that lies in one text."""
        n, h = len(self.word_from), self.word_hash
        if n < k:
            return np.empty(0, np.int64), np.empty(0, _U)
        acc = np.zeros(n - k + 1, _U)
        for j in range(k):
            acc = mix64(acc + h[j : n - k + 1 + j])
        last = np.repeat(self.words_at[1:], self.n_words)[: n - k + 1]  # the end of the own text
        first = np.flatnonzero(np.arange(n - k + 1) + k <= last)
        return first, acc[first]

    def run_hash(self, first: np.ndarray, last: np.ndarray, seed: int = 0) -> np.ndarray:
        """64-bit hashes of runs of words, ``last`` excluded; white space between words does not count.

        Even and odd seeds start from independent hashes of the words.
        """
        first, size = np.asarray(first, np.int64), np.asarray(last, np.int64) - first
        words = self._other_word_hash if seed & 1 else self.word_hash
        span, step, place = _places(first, size)
        parts = mix64(words[place] + _family(seed) + (step + 1).astype(_U) * _STEP)
        return mix64(_sum_by(span, parts, len(first)) + size.astype(_U) * _LENGTH)

    def lowered(self) -> Block:
        """The same texts with A-Z in lower case."""
        return Block(_LOWER[self.data], self.starts)

    def text_of(self, unit_from: np.ndarray) -> np.ndarray:
        """The number of the text that holds each byte position."""
        return np.searchsorted(self.starts, unit_from, side="right") - 1


def blocks(column: pa.Array | pa.ChunkedArray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, Block]]:
    """(first, last + 1, block) for runs of texts of about ``limit`` bytes, at least one text each."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    sizes = pc.binary_length(column).to_numpy(zero_copy_only=False) + 1
    ends = np.cumsum(sizes)
    first = 0
    while first < len(column):
        base = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, base + limit, side="right")))
        part = pc.binary_join_element_wise(column[first:last], *_LINE_END)
        offsets = np.frombuffer(part.buffers()[1], np.int64)[part.offset : part.offset + len(part) + 1]
        data = np.frombuffer(part.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
        yield first, last, Block(data, offsets - offsets[0])
        first = last


def repeated(keys: np.ndarray) -> np.ndarray:
    """Marks the values that occur more than once."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    same = ordered[1:] == ordered[:-1]
    out = np.zeros(len(keys), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def later(keys: np.ndarray) -> np.ndarray:
    """Marks the values that occurred before."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    out = np.zeros(len(keys), bool)
    out[order[1:][ordered[1:] == ordered[:-1]]] = True
    return out


def sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of ``values[at[i]:at[i + 1]]``; empty slices give zero."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[at[1:]] - total[at[:-1]]


def covered(first: np.ndarray, length: int, n: int) -> np.ndarray:
    """Marks the units that any window starting at ``first`` covers, out of ``n``."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, first, 1)
    np.add.at(step, np.minimum(first + length, n), -1)
    return np.cumsum(step[:-1]) > 0
