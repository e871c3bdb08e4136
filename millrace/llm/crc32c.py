"""CRC-32C of many byte strings at once, with NumPy, and the mask of framed records.

A checksum is linear over its bits, so the blocks of all strings go through the tables
together, each block is moved behind the bytes that follow it, and the parts of a string
are added up.
"""

from __future__ import annotations

import numpy as np

# The reflected Castagnoli polynomial, and the mask of framed records.
POLYNOMIAL = 0x82F63B78
MASK_DELTA = 0xA282EAD8
BLOCK = 128
U = np.uint32


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=U)
    for _ in range(8):
        table = np.where(table & U(1), (table >> U(1)) ^ U(POLYNOMIAL), table >> U(1))
    return table


_BYTE = _byte_table()


def _place_tables() -> np.ndarray:
    """For each place in a block, what a byte there adds to the block's checksum."""
    out = np.empty((BLOCK, 256), U)
    out[-1] = _BYTE
    for at in range(BLOCK - 2, -1, -1):
        out[at] = (out[at + 1] >> U(8)) ^ _BYTE[out[at + 1] & U(255)]
    return out


def _moved(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return table[0][crc & U(255)] ^ table[1][(crc >> U(8)) & U(255)] ^ table[2][(crc >> U(16)) & U(255)] ^ table[3][crc >> U(24)]


def _shift_tables(bits: int = 40) -> list[np.ndarray]:
    """For each k, tables that move a checksum behind 2**k more zero bytes, by its four bytes."""
    values = (np.arange(256, dtype=U)[None, :] << (U(8) * np.arange(4, dtype=U))[:, None]).astype(U)
    tables = [(values >> U(8)) ^ _BYTE[values & U(255)]]
    while len(tables) < bits:
        tables.append(_moved(tables[-1], tables[-1]))
    return tables


_PLACES = _place_tables()
_SHIFTS = _shift_tables()


def _shifted(crc: np.ndarray, by: np.ndarray) -> np.ndarray:
    """Each checksum behind so many more zero bytes."""
    crc, by = crc.copy(), by.astype(np.int64)
    for k, table in enumerate(_SHIFTS):
        if not (by >> k).any():
            break
        on = (by >> k) & 1 == 1
        crc[on] = _moved(table, crc[on])
    return crc


def crc32c(data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Checksums of the strings that stand one after another in ``data`` (unsigned bytes)."""
    lengths = np.asarray(lengths, np.int64)
    per = -(-lengths // BLOCK)
    ends = np.cumsum(lengths)
    owner = np.repeat(np.arange(len(lengths)), per)
    firsts = np.cumsum(per) - per
    behind = np.repeat(per, per) - 1 - (np.arange(len(owner)) - np.repeat(firsts, per))
    stops = ends[owner] - behind * BLOCK
    sums = np.zeros(len(owner), U)
    for lo in range(0, len(owner), 1 << 14):
        stop = stops[lo : lo + (1 << 14)]
        places = stop[:, None] - BLOCK + np.arange(BLOCK)
        # A string's first block is filled up with zeros in front, which add nothing.
        begin = (ends - lengths)[owner[lo : lo + (1 << 14)]]
        block = np.where(places >= begin[:, None], data[np.maximum(places, 0)], 0).T
        part = sums[lo : lo + (1 << 14)]
        for at in range(BLOCK):
            part ^= _PLACES[at][block[at]]
    sums = _shifted(sums, behind * BLOCK)
    whole = np.zeros(len(lengths), U)
    some = per > 0
    if some.any():
        whole[some] = np.bitwise_xor.reduceat(sums, firsts[some])
    ones = np.full(len(lengths), 0xFFFFFFFF, U)
    return whole ^ _shifted(ones, lengths) ^ U(0xFFFFFFFF)


def masked(crc: np.ndarray) -> np.ndarray:
    """The checksum turned by 15 bits plus a constant, so that a checksum of checksums stays sound."""
    return (((crc >> U(15)) | (crc << U(17))) + U(MASK_DELTA)).astype(U)
