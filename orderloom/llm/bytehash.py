"""Vectorised hashes of byte windows and words, for use inside tasks.

A prefix sum over random byte values times powers of an odd multiplier gives the
hash of any slice of a buffer by one subtraction and one product, modulo 2**64.
"""

from __future__ import annotations

import numpy as np

_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 2**64)
_BYTE_VALUES = np.random.default_rng(20240229).integers(1, 2**64, 256, dtype=np.uint64) | np.uint64(1)
_powers = np.ones(1, dtype=np.uint64)
_inverses = np.ones(1, dtype=np.uint64)


def _grown(table: np.ndarray, factor: int, size: int) -> np.ndarray:
    while len(table) < size:
        step = np.uint64(pow(factor, len(table), 2**64))
        table = np.concatenate([table, table * step])
    return table


def mixed(values: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values so that every bit depends on all bits."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(32)
    values *= np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


class SliceHashes:
    """Hashes of slices of one buffer; equal bytes give equal hashes in any buffer."""

    def __init__(self, data: np.ndarray):
        global _powers, _inverses
        size = len(data) + 1
        if len(_powers) < size:
            _powers = _grown(_powers, _MULTIPLIER, size)
            _inverses = _grown(_inverses, _INVERSE, size)
        self._sums = np.zeros(size, dtype=np.uint64)
        np.cumsum(_BYTE_VALUES[data] * _powers[: size - 1], out=self._sums[1:])

    def raw(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self._sums[ends] - self._sums[starts]) * _inverses[starts]

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Well mixed 64-bit hashes of data[start:end]."""
        lengths = (ends - starts).astype(np.uint64)
        return mixed(self.raw(starts, ends) + lengths * np.uint64(0xA24BAED4963EE407))

    def windows(self, width: int) -> np.ndarray:
        """Mixed hashes of all windows of one width, in order of their start."""
        count = len(self._sums) - width
        if count <= 0:
            return np.zeros(0, dtype=np.uint64)
        return mixed((self._sums[width:] - self._sums[:-width]) * _inverses[:count])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of `width` neighbours, by block-wise prefix and suffix minima."""
    count = len(values) - width + 1
    if count <= 0:
        return values[:0]
    rows = -(-len(values) // width)
    padded = np.full(rows * width, np.iinfo(values.dtype).max, dtype=values.dtype)
    padded[: len(values)] = values
    blocks = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])
