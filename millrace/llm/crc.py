"""CRC-32 of many spans of a byte array at once.

CRC-32 without its initial and final masks is linear: it is the exclusive or of what each
byte contributes, and a byte's contribution depends only on its value and on how many bytes
follow it. So the contributions of all bytes are looked up in a table (value by distance from
the end of the span) and folded with ``bitwise_xor.reduceat``; the masks add a constant that
depends on the length alone. A span longer than the table is cut into blocks from its end
and the blocks are folded pairwise, each left one moved on by the bytes of the right one.
"""

from __future__ import annotations

import functools
import zlib

import numpy as np

from millrace.llm.common import ranges

#: Bytes a block has: the reach of the position table.
REACH = 64
POLYNOMIAL = 0xEDB88320
MASK = 0xFFFFFFFF


def _byte_table() -> np.ndarray:
    value = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        value = np.where(value & 1, value >> 1 ^ np.uint32(POLYNOMIAL), value >> 1)
    return value


@functools.cache
def position_table() -> np.ndarray:
    """What a byte contributes, at [distance from the end, value]."""
    first = _byte_table()
    rows = [first]
    for _ in range(REACH - 1):
        rows.append(rows[-1] >> 8 ^ first[rows[-1] & 0xFF])
    return np.array(rows)


@functools.cache
def _length_constants() -> np.ndarray:
    return np.array([zlib.crc32(bytes(n)) for n in range(REACH + 1)], np.uint32)


@functools.cache
def _moves(level: int) -> np.ndarray:
    """Tables at [byte of the remainder, value] that move a remainder on by REACH * 2**level bytes."""
    if level:
        half = _moves(level - 1)
        return _moved(half, half)
    value = np.arange(256, dtype=np.uint32) << np.arange(0, 32, 8, dtype=np.uint32)[:, None]
    first = position_table()[0]
    for _ in range(REACH):
        value = value >> 8 ^ first[value & 0xFF]
    return value


def _moved(value: np.ndarray, tables: np.ndarray) -> np.ndarray:
    return tables[0][value & 0xFF] ^ tables[1][value >> 8 & 0xFF] ^ tables[2][value >> 16 & 0xFF] ^ tables[3][value >> 24]


def _constants(lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of as many zero bytes as each length says."""
    table = _length_constants()
    short = table[np.minimum(lengths, REACH)]
    for i in np.flatnonzero(lengths > REACH):
        blocks, rest = divmod(int(lengths[i]), REACH)
        value = np.array([int(table[rest]) ^ MASK], np.uint32)
        level = 0
        while blocks:
            if blocks & 1:
                value = _moved(value, _moves(level))
            blocks >>= 1
            level += 1
        short[i] = int(value[0]) ^ MASK
    return short


def crc32_spans(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of data[start : start + length] for every span; spans may overlap, none is empty."""
    if not len(starts):
        return np.empty(0, np.uint32)
    counts = -(-lengths // REACH)
    span = np.repeat(np.arange(len(starts)), counts)
    behind = counts[span] - 1 - ranges(np.zeros(len(counts), np.int64), counts)  # blocks to the right of a block
    ends = (starts + lengths)[span] - behind * REACH
    begins = np.maximum(ends - REACH, starts[span])
    sizes = ends - begins
    at = ranges(begins, sizes)
    heads = np.cumsum(sizes) - sizes
    parts = position_table()[np.repeat(ends, sizes) - 1 - at, data[at]]
    value = np.bitwise_xor.reduceat(parts, heads)
    level = 0
    while len(value) > len(starts):  # blocks 2k and 2k + 1 from the right become block k
        odd = behind & 1 == 1
        value[odd] = _moved(value[odd], _moves(level))
        behind >>= 1
        heads = np.flatnonzero(np.r_[True, (span[1:] != span[:-1]) | (behind[1:] != behind[:-1])])
        value, span, behind = np.bitwise_xor.reduceat(value, heads), span[heads], behind[heads]
        level += 1
    return value ^ _constants(lengths)
