"""Wavelet matrix: ids of a shard as bit planes that answer access, rank and select.

A plane holds one bit of every id, highest bit first; before the next plane the
ids are dealt stably, those with bit 0 first. A directory of counts every
`BLOCK` bits makes a rank one look-up and a few bytes of counting.

File of a shard: `MAGIC`, five little-endian 64-bit lengths (bits, tokens,
documents table, planes, directory), the zstd-compressed documents table as an
Arrow stream (doc_id, n_tokens), then planes and directory, zstd-compressed.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa

MAGIC = b"SMWM0001"
BLOCK = 512
_HEAD = struct.Struct("<8s6Q")


class WaveletMatrix:
    """`bits` planes over `size` ids."""

    def __init__(self, size: int, planes: np.ndarray, counts: np.ndarray):
        self.size, self.planes, self.counts = size, planes, counts
        self.bits = len(planes)
        self.zeros = [size - int(c[-1]) for c in counts]

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        ids = np.asarray(ids, np.uint16 if bits <= 16 else np.uint32)
        size, width = len(ids), -(-len(ids) // BLOCK) * (BLOCK // 8)
        planes = np.zeros((bits, width), np.uint8)
        for level in range(bits):
            ones = (ids & ids.dtype.type(1 << (bits - 1 - level))) != 0
            packed = np.packbits(ones)
            planes[level, : len(packed)] = packed
            if level + 1 < bits:
                ids = np.concatenate([ids.take(np.flatnonzero(~ones)), ids.take(np.flatnonzero(ones))])
        return cls(size, planes, cls._directory(planes))

    @staticmethod
    def _directory(planes: np.ndarray) -> np.ndarray:
        """Ones before each block, and of all at the end."""
        each = np.bitwise_count(planes).reshape(len(planes), -1, BLOCK // 8).sum(axis=2, dtype=np.uint32)
        counts = np.zeros((len(planes), each.shape[1] + 1), np.uint32)
        np.cumsum(each, axis=1, out=counts[:, 1:])
        return counts

    def _ones(self, level: int, i: int) -> int:
        """Ones before position `i` of a plane."""
        block, start = divmod(i, BLOCK)
        first = block * (BLOCK // 8)
        part = self.planes[level, first : first + -(-start // 8)]
        ones = int(self.counts[level, block]) + int(np.bitwise_count(part).sum())
        if start % 8:
            ones -= int(part[-1] & ((1 << (8 - start % 8)) - 1)).bit_count()
        return ones

    def _step(self, level: int, bit: int, i: int) -> int:
        """Where position `i` of a plane falls in the next one, on the side of `bit`."""
        ones = self._ones(level, i)
        return self.zeros[level] + ones if bit else i - ones

    def access(self, i: int) -> int:
        """The id at position `i`."""
        if not 0 <= i < self.size:
            raise IndexError(i)
        value = 0
        for level in range(self.bits):
            bit = int(self.planes[level, i // 8] >> (7 - i % 8)) & 1
            value = 2 * value + bit
            i = self._step(level, bit, i)
        return value

    def _range(self, value: int, end: int) -> tuple[int, int]:
        """Where the occurrences of `value` before `end` stand after the last plane."""
        start = 0
        for level in range(self.bits):
            bit = value >> (self.bits - 1 - level) & 1
            start, end = self._step(level, bit, start), self._step(level, bit, end)
        return start, end

    def rank(self, value: int, end: int) -> int:
        """Occurrences of `value` before position `end`."""
        if value < 0 or value >> self.bits:
            return 0
        start, end = self._range(value, end)
        return end - start

    def select(self, value: int, k: int) -> int:
        """Position of the occurrence number `k` of `value`, from 0; -1 if there are fewer."""
        if value < 0 or value >> self.bits:
            return -1
        start, end = self._range(value, self.size)
        if k < 0 or start + k >= end:
            return -1
        i = start + k
        for level in reversed(range(self.bits)):
            bit = value >> (self.bits - 1 - level) & 1
            i = self._find(level, bit, i - self.zeros[level] if bit else i)
        return i

    def _find(self, level: int, bit: int, k: int) -> int:
        """Position of bit number `k` of one kind in a plane, by halving over ranks."""
        low, high = 0, self.size
        while low < high:
            middle = (low + high) // 2
            ones = self._ones(level, middle + 1)
            if (ones if bit else middle + 1 - ones) > k:
                high = middle
            else:
                low = middle + 1
        return low

    def values(self) -> np.ndarray:
        """All ids in order: the dealing of each plane undone, lowest plane first."""
        ids = np.zeros(self.size, np.uint16 if self.bits <= 16 else np.uint32)
        for level in reversed(range(self.bits)):
            ones = np.unpackbits(self.planes[level], count=self.size).view(bool)
            zeros, dealt = self.zeros[level], np.empty_like(ids)
            dealt[np.flatnonzero(~ones)] = ids[:zeros]
            dealt[np.flatnonzero(ones)] = ids[zeros:] | ids.dtype.type(1 << (self.bits - 1 - level))
            ids = dealt
        return ids


class Shard:
    """Documents of one file: `doc_ids`, `lengths` and the matrix over all their ids."""

    def __init__(self, doc_ids: list[int | None], lengths: np.ndarray, matrix: WaveletMatrix):
        self.doc_ids, self.lengths, self.matrix = doc_ids, np.asarray(lengths, np.int64), matrix
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)]).astype(np.int64)

    def to_bytes(self) -> bytes:
        table = pa.RecordBatch.from_arrays(
            [pa.array(self.doc_ids, pa.int64()), pa.array(self.lengths, pa.int64())], names=["doc_id", "n_tokens"]
        )
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as writer:
            writer.write_batch(table)
        raw = sink.getvalue().to_pybytes()
        zstd = pa.Codec("zstd", compression_level=1)
        packed = zstd.compress(raw, asbytes=True)
        planes = zstd.compress(self.matrix.planes.tobytes() + self.matrix.counts.tobytes(), asbytes=True)
        m = self.matrix
        return _HEAD.pack(MAGIC, m.bits, m.size, len(raw), len(packed), m.planes.shape[1], m.counts.shape[1]) + packed + planes

    @classmethod
    def from_bytes(cls, data: bytes) -> Shard:
        magic, bits, size, raw, packed, width, blocks = _HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a wavelet shard")
        zstd = pa.Codec("zstd")
        at = _HEAD.size
        with pa.ipc.open_stream(zstd.decompress(data[at : at + packed], raw)) as reader:
            table = reader.read_all()
        body = zstd.decompress(data[at + packed :], bits * width + 4 * bits * blocks, asbytes=True)
        planes = np.frombuffer(body, np.uint8, bits * width).reshape(bits, width)
        counts = np.frombuffer(body, np.uint32, bits * blocks, bits * width).reshape(bits, blocks)
        return cls(
            table.column("doc_id").to_pylist(), table.column("n_tokens").to_numpy(), WaveletMatrix(size, planes, counts)
        )

    def token(self, doc: int, i: int) -> int:
        """Id number `i` of document number `doc` of this shard."""
        return self.matrix.access(int(self.starts[doc]) + i)

    def count(self, value: int) -> int:
        return self.matrix.rank(value, self.matrix.size)

    def occurrences(self, value: int) -> list[tuple[int, int]]:
        """(document number, position in it) of every occurrence of an id."""
        found = [self.matrix.select(value, k) for k in range(self.count(value))]
        owners = np.searchsorted(self.starts, found, side="right") - 1
        return [(int(d), p - int(self.starts[d])) for d, p in zip(owners, found)]
