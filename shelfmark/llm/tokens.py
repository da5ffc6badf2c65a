"""Words of a batch of texts as arrays: positions, owners and 64-bit hashes.

All work is on the UTF-8 bytes that Arrow already holds; no Python object is
made per word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes that are hashed at once; what a text of any length needs besides its bytes is a few numbers per word.
BLOCK = 1 << 18
_powers: dict[int, np.ndarray] = {}


def _table(base: int) -> np.ndarray:
    """Powers 0 to `BLOCK` - 1 of an odd number, modulo 2^64."""
    if len(_powers.get(base, ())) != BLOCK:
        factors = np.full(BLOCK, base, np.uint64)
        factors[0] = 1
        _powers[base] = np.cumprod(factors, dtype=np.uint64)
    return _powers[base]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def classes(**groups: str) -> np.ndarray:
    """A byte table: 0 parts words; bytes of equal class run together."""
    table = np.zeros(256, np.uint8)
    for number, members in enumerate(groups.values(), start=1):
        for byte in members.encode("latin-1"):
            table[byte] = number
    return table


HIGH = bytes(range(0x80, 0x100)).decode("latin-1")
ALNUM = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz" + HIGH
#: Runs of ASCII letters, digits and all else beyond ASCII.
ALNUM_WORDS = classes(words=ALNUM)
#: The same, and runs of the other printing ASCII characters.
WORDS_AND_MARKS = classes(
    words=ALNUM, marks="".join(chr(c) for c in range(0x21, 0x7F) if chr(c) not in ALNUM)
)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def byte_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts (null: none) and the bounds of each text in them."""
    column = column.cast(pa.large_string()).fill_null("")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


class Words:
    """Words of a text column: `doc` owns each word, `hash` names it; A-Z count as a-z if `fold`.

    `kinds` gives the class of every byte instead of the table. The bytes are
    gone through in blocks. A word's hash is the difference of a running sum at
    its two ends, so a word may lie across any number of blocks.
    """

    def __init__(self, column: pa.Array, table: np.ndarray = ALNUM_WORDS, fold: bool = True, kinds: np.ndarray | None = None):
        raw, bounds = byte_view(column)
        self.docs = len(bounds) - 1
        offsets = np.int32 if len(raw) < 1 << 31 else np.int64
        found = [(np.zeros(0, offsets), np.zeros(0, offsets), np.zeros(0, np.uint64))]
        total, opened, last = np.uint64(0), None, 0
        for first in range(0, len(raw), BLOCK):
            block = raw[first : first + BLOCK]
            size = len(block)
            kind = table[block] if kinds is None else kinds[first : first + size]
            edge = np.ones(size, bool)
            edge[1:] = kind[1:] != kind[:-1]
            edge[0] = kind[0] != last
            inside = bounds[np.searchsorted(bounds, first) : np.searchsorted(bounds, first + size)]
            edge[inside - first] = True
            cuts = np.flatnonzero(edge)
            before = kind[cuts - 1]  # what a cut ends
            if len(cuts) and cuts[0] == 0:
                before[0] = last
            values = ((_LOWER[block] if fold else block).astype(np.uint64) + np.uint64(1)) * _table(_BASE)[:size]
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
            sums = sums * np.uint64(pow(_BASE, first, 1 << 64)) + total
            total, last = sums[-1], kind[-1]
            begin, end = cuts[kind[cuts] > 0], cuts[before > 0]
            down = _table(_INVERSE)[begin] * np.uint64(pow(_INVERSE, first, 1 << 64))
            starts, ends, at, to = begin + first, end + first, sums[begin], sums[end]
            if opened is not None:  # the word that the last block left open
                starts, at, down = (np.append(old, new) for old, new in zip(opened, (starts, at, down)))
            whole = len(ends)
            opened = None
            if len(starts) > whole:
                opened = starts[whole:].astype(np.int64), at[whole:], down[whole:]
            found.append((starts[:whole].astype(offsets), ends.astype(offsets), mix((to - at[:whole]) * down[:whole])))
        if opened is not None:
            found.append((opened[0].astype(offsets), np.array([len(raw)], offsets), mix((total - opened[1]) * opened[2])))
        self.starts, self.ends, self.hash = (np.concatenate(part) for part in zip(*found))
        self.doc = np.searchsorted(bounds, self.starts, side="right") - 1
        self.counts = np.bincount(self.doc, minlength=self.docs)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(owner, hash) of each run of `n` words inside one text."""
        size = max(0, len(self.hash) - n + 1)
        gram = np.empty(size, np.uint64)
        for first in range(0, size, BLOCK):
            last = min(first + BLOCK, size)
            total = np.zeros(last - first, np.uint64)
            for i in range(n):
                total = total * np.uint64(0xD6E8FEB86659FD93) + self.hash[first + i : last + i]
            gram[first:last] = mix(total)
        same = self.doc[:size] == self.doc[n - 1 : n - 1 + size]
        return self.doc[:size][same], gram[same]

    def shingles(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """`grams(n)`, and for a text of fewer words, but not none, one gram of all its words."""
        doc, gram = self.grams(n)
        short = np.flatnonzero((self.counts > 0) & (self.counts < n))
        if not len(short):
            return doc, gram
        first = np.concatenate([[0], np.cumsum(self.counts)])
        whole = np.array(
            [
                int(np.bitwise_xor.reduce(mix(self.hash[first[d] : first[d + 1]] + np.arange(1, self.counts[d] + 1, dtype=np.uint64))))
                for d in short
            ],
            np.uint64,
        )
        doc, gram = np.concatenate([doc, short]), np.concatenate([gram, mix(whole)])
        order = np.argsort(doc, kind="stable")
        return doc[order], gram[order]


#: Bytes of a text that are parted at white space at once.
PART = 1 << 20
_SPACE = b" \t\n\x0b\x0c\r"


def parts(raw: bytes):
    """`raw` in pieces of about `PART` bytes that break no word."""
    at = 0
    while len(raw) - at > PART:
        end = max(raw.rfind(bytes([c]), at, at + PART) for c in _SPACE)
        if end < 0:  # one word longer than a piece
            ends = [e for c in _SPACE if (e := raw.find(bytes([c]), at + PART)) >= 0]
            end = min(ends, default=len(raw) - 1)
        yield raw[at : end + 1]
        at = end + 1
    yield raw[at:]


def word_numbers(raw: bytes, known: dict[bytes, int]) -> np.ndarray:
    """The words of `raw` (parted at ASCII white space) as numbers from `known`, which takes in new words."""
    found = [
        np.fromiter((known.setdefault(w, len(known)) for w in words), np.int32, len(words))
        for part in parts(raw)
        if (words := part.split())
    ]
    return np.concatenate(found) if found else np.zeros(0, np.int32)
