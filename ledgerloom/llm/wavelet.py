"""Wavelet matrix of a shard of token ids, in one compressed file.

Plane k holds bit (width - 1 - k) of every id, in the order that results from
moving, plane after plane, the ids with a 0 before those with a 1. A directory
of running counts makes rank a lookup and a few popcounts; select is a binary
search over rank. So the planes alone give the id at a place, the number of
occurrences of an id before a place, and the place of its k-th occurrence.

File: b"WMX1", header length (uint32), JSON header {tokens, docs, width,
planes: [bytes of each compressed plane]}, doc_ids (int64), null flags (uint8),
tokens of each document (uint32), then the planes, zstandard-compressed
little-endian packed bits. Directories are rebuilt on reading.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard

MAGIC = b"WMX1"
BLOCK = 512         # bits between two entries of a rank directory


def _mask(plane: np.ndarray, n: int) -> pa.Array:
    """Packed bits as Arrow booleans: Arrow filters by them in half the time of a numpy mask."""
    return pa.Array.from_buffers(pa.bool_(), n, [None, pa.py_buffer(plane)])


class WaveletMatrix:
    def __init__(self, n: int, planes: list[np.ndarray]):
        """``planes``: packed bits (little end first), most significant first."""
        self.n, self.planes, self.width = n, planes, len(planes)
        self.ranks, self.zeros = [], []
        for p in planes:
            ones = np.bitwise_count(np.pad(p, (0, -len(p) % (BLOCK // 8)))).reshape(-1, BLOCK // 8).sum(axis=1, dtype=np.int64)
            self.ranks.append(np.concatenate(([0], np.cumsum(ones))))
            self.zeros.append(n - int(self.ranks[-1][-1]))

    @classmethod
    def build(cls, ids: np.ndarray) -> "WaveletMatrix":
        width = max(1, int(ids.max()).bit_length()) if len(ids) else 1
        now = ids.astype(np.uint16 if width <= 16 else np.uint32)
        planes = []
        for k in range(width - 1, -1, -1):
            planes.append(np.packbits(now & now.dtype.type(1 << k) != 0, bitorder="little"))
            values = pa.array(now)
            now = np.concatenate([pc.filter(values, _mask(p, len(now))).to_numpy() for p in (~planes[-1], planes[-1])])
        return cls(len(ids), planes)

    def bits(self, k: int) -> np.ndarray:
        return np.unpackbits(self.planes[k], count=self.n, bitorder="little").view(bool)

    def rank1(self, k: int, i: int) -> int:
        """Ones of plane k before place i."""
        b = i // BLOCK
        part = self.planes[k][b * (BLOCK // 8): (i + 7) // 8]
        n = int(self.ranks[k][b]) + int(np.bitwise_count(part).sum())
        if i % 8 and len(part):
            n -= int(part[-1] >> (i % 8)).bit_count()
        return n

    def _bit(self, k: int, i: int) -> int:
        return int(self.planes[k][i // 8]) >> (i % 8) & 1

    def _select(self, k: int, bit: int, j: int) -> int:
        """Place of the j-th (from 0) ``bit`` of plane k."""
        low, high = 0, self.n - 1
        while low < high:
            mid = (low + high) // 2
            ones = self.rank1(k, mid + 1)
            if (ones if bit else mid + 1 - ones) > j:
                high = mid
            else:
                low = mid + 1
        return low

    def access(self, i: int) -> int:
        """The id at place i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        out = 0
        for k in range(self.width):
            bit = self._bit(k, i)
            ones = self.rank1(k, i)
            i = self.zeros[k] + ones if bit else i - ones
            out = out << 1 | bit
        return out

    def _range(self, token: int, i: int) -> tuple[int, int]:
        low, high = 0, i
        for k in range(self.width):
            a, b = self.rank1(k, low), self.rank1(k, high)
            low, high = (self.zeros[k] + a, self.zeros[k] + b) if token >> (self.width - 1 - k) & 1 else (low - a, high - b)
        return low, high

    def count(self, token: int, i: int | None = None) -> int:
        """Occurrences of an id before place i (in all, if None)."""
        if token >> self.width:
            return 0
        low, high = self._range(token, self.n if i is None else i)
        return high - low

    def find(self, token: int, j: int) -> int:
        """Place of the j-th (from 0) occurrence of an id, -1 if there are fewer."""
        if not 0 <= j < self.count(token):
            return -1
        at = self._range(token, self.n)[0] + j
        for k in range(self.width - 1, -1, -1):
            bit = token >> (self.width - 1 - k) & 1
            at = self._select(k, bit, at - self.zeros[k] if bit else at)
        return at

    def all_ids(self) -> np.ndarray:
        """Every id in order: the planes' moves undone from the last to the first."""
        kind = np.uint16 if self.width <= 16 else np.uint32
        now, out = np.zeros(self.n, kind), np.empty(self.n, kind)
        for k in range(self.width - 1, -1, -1):
            bit, z = self.bits(k), self.zeros[k]
            now[z:] |= kind(1 << (self.width - 1 - k))
            out[bit] = now[z:]
            out[np.logical_not(bit, out=bit)] = now[:z]
            now, out = out, now
        return now.astype("<u4")


def to_bytes(matrix: WaveletMatrix, doc_ids: list[int | None], lengths: list[int]) -> bytes:
    packed = [zstandard.ZstdCompressor(level=1).compress(p.tobytes()) for p in matrix.planes]
    head = json.dumps({"tokens": matrix.n, "docs": len(doc_ids), "width": matrix.width,
                       "planes": [len(p) for p in packed]}).encode()
    return b"".join([MAGIC, len(head).to_bytes(4, "little"), head,
                     np.array([x or 0 for x in doc_ids], "<i8").tobytes(),
                     np.array([x is None for x in doc_ids], np.uint8).tobytes(),
                     np.array(lengths, "<u4").tobytes(), *packed])


def from_bytes(data: bytes) -> tuple[WaveletMatrix, list[int | None], np.ndarray]:
    """The matrix, the documents' ids and their numbers of tokens."""
    if data[:4] != MAGIC:
        raise ValueError("not a wavelet matrix file")
    size = int.from_bytes(data[4:8], "little")
    head, at = json.loads(data[8:8 + size]), 8 + size
    n = head["docs"]
    ids = np.frombuffer(data, "<i8", n, at)
    null = np.frombuffer(data, np.uint8, n, at + 8 * n)
    lengths = np.frombuffer(data, "<u4", n, at + 9 * n)
    at, planes = at + 13 * n, []
    for b in head["planes"]:
        planes.append(np.frombuffer(zstandard.ZstdDecompressor().decompress(data[at:at + b]), np.uint8))
        at += b
    return WaveletMatrix(head["tokens"], planes), [None if z else int(i) for i, z in zip(ids, null)], lengths
