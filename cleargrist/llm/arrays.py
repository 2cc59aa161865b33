"""Numpy helpers over the UTF-8 bytes of many texts at once.

They run inside Arrow tasks (``mapInArrow``). A batch is taken in blocks of a quarter of a megabyte
of text, so that a task's memory does not follow the number of rows in a batch; one text is never
cut, so a block may hold one longer text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 18

_GRAM_BASE = np.uint64(0xD1B54A32D192ED03)


def byte_table(members: bytes) -> np.ndarray:
    """For each byte value, whether it is one of the members."""
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


SPACE = byte_table(b" \t\n\x0b\x0c\r")
WORD = ~SPACE
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
#: Bytes that begin a code point.
LEAD = (np.arange(256) & 0xC0) != 0x80


@dataclass(frozen=True)
class Block:
    """Rows ``first`` to ``first + len(starts)`` of a batch: their bytes, and where each begins."""

    first: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    def __len__(self) -> int:
        return len(self.starts)

    def text(self, row: int) -> bytes:
        return self.data[self.starts[row] : self.ends[row]].tobytes()


def blocks(column: pa.Array, size: int = BLOCK_BYTES) -> Iterator[Block]:
    """The texts of a string or binary column, a null as an empty text."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        last = int(np.searchsorted(at, at[row] + size, side="right")) - 1
        last = min(max(last, row + 1), n)
        low = at[row]
        yield Block(row, whole[low : at[last]], at[row:last] - low, at[row + 1 : last + 1] - low)
        row = last


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd number modulo 2^64, and their inverses."""
    known = _powers.get(int(base))
    if known is None or len(known[0]) < n:
        size = max(n, 1 << 10)
        up = np.full(size, base, np.uint64)
        down = np.full(size, pow(int(base), -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        known = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
        if size <= BLOCK_BYTES:
            _powers[int(base)] = known
    return known[0][:n], known[1][:n]


_PRIME = (1 << 61) - 1
_P, _61, _31, _30 = (np.uint64(x) for x in (_PRIME, 61, 31, 30))
_LOW31, _LOW30 = np.uint64((1 << 31) - 1), np.uint64((1 << 30) - 1)
# Two numbers modulo the prime, drawn once; hashes by one tell nothing about those by the other.
_BASES = (0x0C1F6A93D5E7B284, 0x13A8E2571F4C96BD)
_CHUNK = BLOCK_BYTES


def _reduced(x: np.ndarray) -> np.ndarray:
    """Modulo the prime."""
    x = (x & _P) + (x >> _61)
    return np.minimum(x, x - _P)  # below the prime the difference wraps to a larger number


def _product(a: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """a * (high * 2^31 + low) modulo the prime."""
    up, down = a >> _31, a & _LOW31
    middle = down * high + up * low
    out = (up * high << np.uint64(1)) + (middle >> _30) + ((middle & _LOW30) << _31) + down * low
    return _reduced(out)


@lru_cache(maxsize=8)
def _prime_powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of a base modulo the prime, in halves of 30 and 31 bits."""
    out = np.ones(n, np.uint64)
    done = 1
    while done < n:
        step = pow(base, done, _PRIME)
        more = min(done, n - done)
        out[done : done + more] = _product(out[:more], np.uint64(step >> 31), np.uint64(step) & _LOW31)
        done += more
    return out >> _31, out & _LOW31


class Hasher:
    """64-bit hashes of any spans of one byte array, by differences of one running sum.

    A span's hash is a polynomial of its bytes modulo the prime 2^61 - 1, with its bits spread:
    two different spans of n bytes agree for at most n of all bases, whatever the bytes. A modulus
    of 2^64 would be cheaper, but there strings exist that agree for every base. Where equality
    decides a result over a whole corpus, a ``second`` hash by another base goes along.

    Sums take 8 bytes of memory for a byte of text; a text longer than a block is summed up in chunks.
    """

    def __init__(self, data: np.ndarray, second: bool = False):
        base = _BASES[second]
        inverse = pow(base, -1, _PRIME)
        self._down = _prime_powers(inverse, _CHUNK)
        n_chunks = len(data) // _CHUNK + 1
        self._far = _prime_powers(pow(inverse, _CHUNK, _PRIME), n_chunks) if n_chunks > 1 else None
        high, low = _prime_powers(base, _CHUNK)
        self._sums = np.zeros(len(data) + 1, np.uint64)
        for first in range(0, len(data), _CHUNK):
            part = data[first : first + _CHUNK].astype(np.uint64) + np.uint64(1)
            n = len(part)
            above = _reduced(np.cumsum(part * high[:n]))
            # Times 2^31 modulo the prime is a rotation.
            above = ((above << _31) & _P) | (above >> _30)
            sums = _reduced(np.cumsum(part * low[:n]) + above)
            if first:
                shift = pow(base, first, _PRIME)
                sums = _product(sums, np.uint64(shift >> 31), np.uint64(shift) & _LOW31)
                sums = _reduced(sums + self._sums[first])
            self._sums[first + 1 : first + 1 + n] = sums

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        span = _reduced(self._sums[ends] + (_P - self._sums[starts]))
        high, low = self._down
        near = starts & (_CHUNK - 1) if self._far else starts
        span = _product(span, high[near], low[near])
        if self._far:
            high, low = self._far
            chunk = starts // _CHUNK
            span = _product(span, high[chunk], low[chunk])
        return mix(span)


@dataclass(frozen=True)
class Spans:
    """Spans of a block's bytes, in order, each with the row it lies in."""

    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray


def runs(block: Block, member: np.ndarray) -> Spans:
    """Maximal runs of bytes that are members of a table, not crossing texts."""
    return marked_runs(block, member[block.data])


def marked_runs(block: Block, inside: np.ndarray) -> Spans:
    """Maximal runs of bytes that a mask marks, not crossing texts."""
    n = len(inside)
    if not n:
        none = np.zeros(0, np.int64)
        return Spans(none, none, none)
    edge = np.zeros(n + 1, bool)
    edge[block.starts] = True
    edge[block.ends] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:n]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:] | edge[1:n]
    starts = np.flatnonzero(begins)
    return Spans(starts, np.flatnonzero(closes) + 1, rows_of(block, starts))


def rows_of(block: Block, positions: np.ndarray) -> np.ndarray:
    """The row of each byte position."""
    return np.searchsorted(block.starts, positions, side="right") - 1


def lines(block: Block) -> Spans:
    """The pieces between line feeds; an empty text is one empty line."""
    feeds = np.flatnonzero(block.data == 10)
    rows = np.concatenate([np.arange(len(block)), rows_of(block, feeds)])
    starts = np.concatenate([block.starts, feeds + 1])
    ends = np.concatenate([feeds, block.ends])
    order = np.lexsort((starts, rows))
    end_rows = np.concatenate([rows_of(block, feeds), np.arange(len(block))])
    return Spans(starts[order], ends[np.lexsort((ends, end_rows))], rows[order])


def n_grams(hashes: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n consecutive words of one text, and the index of the first word of each."""
    count = max(0, len(hashes) - n + 1)
    if not count:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = hashes[:count].copy()
    for i in range(1, n):
        out *= _GRAM_BASE
        out += hashes[i : i + count]
    firsts = np.flatnonzero(rows[:count] == rows[n - 1 : n - 1 + count])
    return mix(out[firsts]), firsts


def repeated(keys: np.ndarray) -> np.ndarray:
    """For each key, whether it occurs more than once."""
    order = np.argsort(keys)
    same = keys[order[1:]] == keys[order[:-1]]
    flags = np.zeros(len(keys), bool)
    flags[order[1:]] |= same
    flags[order[:-1]] |= same
    return flags


def counts(rows: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    """Number of entries, or sum of their weights, for each of n rows."""
    return np.bincount(rows, weights, minlength=n)[:n]


_MIX_ODD = np.uint64(0x9E3779B97F4A7C15)


def _bit_masks(n: int = 1 << 12) -> np.ndarray:
    """Words with up to four bits set, by a rule."""
    bits = mix(np.arange(1, n + 1, dtype=np.uint64) * _MIX_ODD)
    masks = np.zeros(n, np.uint64)
    for shift in (0, 6, 12, 18):
        masks |= np.uint64(1) << (bits >> np.uint64(shift) & np.uint64(63))
    return masks


#: Of a blocked Bloom filter whose blocks are two words: the bits of a hash in either word.
BIT_MASKS = _bit_masks()


def first_mask(hashes: np.ndarray) -> np.ndarray:
    return BIT_MASKS[hashes & np.uint64(4095)]


def second_mask(hashes: np.ndarray) -> np.ndarray:
    return BIT_MASKS[hashes >> np.uint64(12) & np.uint64(4095)]


def bit_block(hashes: np.ndarray, n_blocks: int) -> np.ndarray:
    """The block of each hash among up to 2^32."""
    return ((hashes >> np.uint64(32)) * np.uint64(n_blocks) >> np.uint64(32)).astype(np.int64)


def in_bits(hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Indices of the hashes that the filter of these words, two for a block, may hold."""
    block = bit_block(hashes, len(words) // 2)
    mask = first_mask(hashes)
    hit = np.flatnonzero(words[2 * block] & mask == mask)
    mask = second_mask(hashes[hit])
    return hit[words[2 * block[hit] + 1] & mask == mask]
