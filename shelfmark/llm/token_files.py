"""Token ids of all documents in wavelet files, in order of doc_id, and back.

Documents are range-partitioned by id and each task writes its own shards, so
ids ascend through the files by name. A shard closes at `SHARD_TOKENS` ids, so
a task holds one shard at a time; a longer document is a shard of its own.
"""

from __future__ import annotations

import os
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.batches import pieces
from shelfmark.llm.merges import byte_letters
from shelfmark.llm.tokens import BLOCK, Words, byte_view
from shelfmark.llm.wavelet import Shard, WaveletMatrix
from shelfmark.session import materialize, scratch_path

END_ID = 1
SHARD_TOKENS = 2_000_000
#: Text that is encoded at once: the more, the fewer chunks are looked up again.
PIECE_BYTES = 1 << 20
#: Runs whose ids a Python worker remembers, twice: the latest and those before; and the most bytes and ids of them all.
REMEMBERED = 500_000
REMEMBERED_TEXT = 1 << 23
REMEMBERED_SUM = 1 << 22
#: Runs with more ids or bytes are not remembered.
REMEMBERED_IDS = 64
REMEMBERED_BYTES = 256
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_encoders: dict[str, LibraryEncoder] = {}


def _classes() -> np.ndarray:
    """0 white space in ASCII; 1 the bytes of a-z, ß-ö and ø-ÿ, which the normaliser leaves alone; 2 marks; 3 all else."""
    table = np.full(256, 3, np.uint8)
    table[list(b" \t\n\x0b\x0c\r")] = 0
    table[ord("a") : ord("z") + 1] = 1
    table[[0xC3, *range(0x9F, 0xB7), *range(0xB8, 0xC0)]] = 1  # under any other first byte they stand beside a 3
    table[list(b".,;:!?*#%&$")] = 2
    return table


_CLASSES = _classes()


def _kinds(data: bytes, bounds: np.ndarray) -> np.ndarray:
    """The class of each byte; what lies between white space is all 3 if any of its bytes is."""
    kinds = _CLASSES[np.frombuffer(data, np.uint8)]
    blanks, starts, ends = np.flatnonzero(kinds == 0), [], []
    for block in range(0, len(kinds), BLOCK):
        odd = np.flatnonzero(kinds[block : block + BLOCK] == 3) + block
        after, doc = np.searchsorted(blanks, odd), np.searchsorted(bounds, odd, side="right")
        begin = np.maximum(np.concatenate([[0], blanks + 1])[after], bounds[doc - 1])
        begin, first = np.unique(begin, return_index=True)
        starts.append(begin)
        ends.append(np.minimum(np.append(blanks, len(data))[after[first]], bounds[doc[first]]))
    if starts and sum(map(len, starts)):
        step = np.zeros(len(kinds) + 1, np.int8)
        step[np.unique(np.concatenate(starts))] += 1
        step[np.unique(np.concatenate(ends))] -= 1
        kinds[np.cumsum(step[:-1], dtype=np.int8).view(bool)] = 3
    return kinds


def _eights(data: bytes) -> np.ndarray:
    """The eight bytes from each place on, as a number; eight zeros follow the last."""
    return np.ndarray((len(data) + 1,), "<u8", data + bytes(8), strides=(1,))


def _differ(one: np.ndarray, at: np.ndarray, other: np.ndarray, to: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the `size` bytes at places `at` of one and `to` of the other text differ."""
    mask = ~np.uint64(0) >> (64 - 8 * np.clip(size, 1, 8)).astype(np.uint64)
    differs = ((one[at] ^ other[to]) & mask) != 0
    # then from eight to eight, the last ones overlapping
    rest, step = np.flatnonzero(~differs & (size > 8)), 8
    while len(rest):
        shift = np.minimum(step, size[rest] - 8)
        unequal = one[at[rest] + shift] != other[to[rest] + shift]
        differs[rest[unequal]] = True
        rest, step = rest[~unequal & (step + 8 < size[rest])], step + 8
    return differs


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of all ranges, one after the other."""
    return np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


class Memory:
    """Ids of runs in a table by hash, in arrays of bounded size; of runs with equal hashes one is kept."""

    def __init__(self, size: int):
        width = 1 << max(4, (2 * size - 1).bit_length())
        self.size, self.mask, self.count = size, np.uint64(width - 1), 0
        self.slots = np.zeros(width, np.int32)  # a run's number and 1; 0 is empty
        self.hash = np.empty(size, np.uint64)
        self.most_text, self.most_ids = min(REMEMBERED_TEXT, size * REMEMBERED_BYTES), min(REMEMBERED_SUM, size * REMEMBERED_IDS)
        self.text = np.zeros(self.most_text + 8, np.uint8)
        self.eights = np.ndarray((self.most_text + 1,), "<u8", self.text, strides=(1,))
        self.ids = np.empty(self.most_ids, "<u4")
        # where the text and the ids of each run begin, and of the next one
        self.text_at, self.ids_at = np.zeros(size + 1, np.int32), np.zeros(size + 1, np.int32)

    def __len__(self) -> int:
        return self.count

    def find(self, eights: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Number of each run, compared byte by byte, or -1."""
        found = np.full(len(hashes), -1, np.int64)
        if not self.count:
            return found
        at, open_ = (hashes & self.mask).astype(np.int64), np.arange(len(hashes))
        while len(open_):
            held = self.slots[at] - 1
            same = (held >= 0) & (self.hash[held] == hashes[open_])
            found[open_[same]] = held[same]
            further = (held >= 0) & ~same
            open_, at = open_[further], (at[further] + 1) & int(self.mask)
        here = np.flatnonzero(found >= 0)
        own, start = found[here], starts[here]
        size, text_at = ends[here] - start, self.text_at[own]
        unequal = (size != self.text_at[own + 1] - text_at) | _differ(eights, start, self.eights, text_at, size)
        found[here[unequal]] = -1
        return found

    def fits(self, runs: int, text: int, ids: int) -> bool:
        n = self.count
        return n + runs <= self.size and self.text_at[n] + text <= self.most_text and self.ids_at[n] + ids <= self.most_ids

    def add(
        self, raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray, hashes: np.ndarray, ids: np.ndarray, ids_at: np.ndarray, n_ids: np.ndarray
    ) -> None:
        """Take in runs that it does not hold, as far as there is room; of runs with equal hashes the first."""
        places, n = np.full(len(hashes), -1, np.int64), self.count
        held_text, held_ids = int(self.text_at[n]), int(self.ids_at[n])
        most = np.searchsorted(held_text + np.cumsum(sizes), self.most_text, side="right")
        most = min(self.size - n, most, np.searchsorted(held_ids + np.cumsum(n_ids), self.most_ids, side="right"))
        open_ = np.sort(np.unique(hashes[:most], return_index=True)[1])
        at = (hashes[open_] & self.mask).astype(np.int64)
        while len(open_):
            held = self.slots[at]
            old = (held > 0) & (held <= n)
            same = old & (self.hash[held - 1] == hashes[open_])
            empty = np.flatnonzero(held == 0)
            self.slots[at[empty]] = n + 1 + open_[empty]  # of several the last; a number for now
            won = self.slots[at] == n + 1 + open_
            places[open_[won]] = at[won]
            further = ~won & ~same
            open_, at = open_[further], (at[further] + 1) & int(self.mask)
        new = np.flatnonzero(places >= 0)
        self.slots[places[new]] = n + 1 + np.arange(len(new))
        self.count = n + len(new)
        self.hash[n : self.count] = hashes[new]
        self.text_at[n + 1 : self.count + 1] = held_text + np.cumsum(sizes[new])
        self.ids_at[n + 1 : self.count + 1] = held_ids + np.cumsum(n_ids[new])
        self.text[held_text : self.text_at[self.count]] = raw[_ranges(starts[new], sizes[new])]
        self.ids[held_ids : self.ids_at[self.count]] = ids[_ranges(ids_at[new], n_ids[new])]


class LibraryEncoder:
    """The tokenizers library behind a memory of runs: letters, marks, and what lies between ASCII white space if it has anything else.

    Neither words nor special tokens of the vocabulary cross white space, and
    plain letters and marks are words of their own, so equal runs have equal ids
    and each goes to the library once while it is remembered. Hashes gather what
    may be equal; every run is then compared byte by byte with the one that
    stands for its hash. A-Z count as a-z, as the vocabulary has it, unless a
    special token might stand in the texts.
    """

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(vocabulary)
        self.library.no_truncation()
        self.library.no_padding()
        self.bits = max(1, int(self.library.get_vocab_size(with_added_tokens=True) - 1).bit_length())
        self.known, self.older = Memory(REMEMBERED), Memory(1)
        self.spelled = dict(enumerate(byte_letters()))

    def _new(self, runs: list[bytes], plain: list[bool]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all runs, ids per run); a plain run needs nothing but the library's merges."""
        odd = iter(self.library.encode_batch_fast([run.decode() for run, own in zip(runs, plain) if not own], add_special_tokens=False))
        tokenize, spelled, flat, sizes = self.library.model.tokenize, self.spelled, array("I"), []
        for run, own in zip(runs, plain):
            if own:
                found = [t.id for t in tokenize(run.decode() if run.isascii() else run.decode("latin-1").translate(spelled))]
            else:
                found = next(odd).ids
            flat.extend(found)
            sizes.append(len(found))
        return np.frombuffer(flat, np.uintc) if flat else np.zeros(0, np.uintc), np.array(sizes, np.int64)

    def encode(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in order, each with `end` after it; ids per text)."""
        raw, bounds = byte_view(texts)
        data = raw.tobytes()
        special = b"<|" in data
        data = data if special else data.translate(_FOLD)
        kinds = _kinds(data, bounds)
        words = Words(texts, fold=not special, kinds=kinds)
        eights, starts, ends, hashes = _eights(data), words.starts, words.ends, words.hash
        known = self.known
        entry = known.find(eights, starts, ends, hashes)
        unknown = np.flatnonzero(entry < 0)
        first, place = _named(eights, starts[unknown], ends[unknown], hashes[unknown])
        # a run for each name: its ids are those of the older memory, or new
        begin, until, hashed = (x[unknown[first]] for x in (starts, ends, hashes))
        old = self.older.find(eights, begin, until, hashed)
        again, unseen = np.flatnonzero(old >= 0), np.flatnonzero(old < 0)
        keys = [data[a:b] for a, b in zip(begin[unseen].tolist(), until[unseen].tolist())]
        made, made_sizes = self._new(keys, (kinds[begin[unseen]] < 3).tolist())
        sizes, offsets = np.empty(len(first), np.int64), np.empty(len(first), np.int64)
        sizes[again], sizes[unseen] = self.older.ids_at[old[again] + 1] - self.older.ids_at[old[again]], made_sizes
        found = np.concatenate([self.older.ids[_ranges(self.older.ids_at[old[again]], sizes[again])], made])
        order = np.concatenate([again, unseen])
        offsets[order] = np.cumsum(sizes[order]) - sizes[order]

        held = int(known.ids_at[known.count])
        flat = np.concatenate([known.ids[:held], found])
        at = known.ids_at[entry].astype(np.int64)
        n = known.ids_at[entry + 1] - at
        at[unknown], n[unknown] = held + offsets[place], sizes[place]
        counts = np.bincount(words.doc, weights=n, minlength=words.docs).astype(np.int64) + 1
        steps = np.arange(int(n.sum()))
        out = np.full(len(steps) + words.docs, end, "<u4")
        out[steps + np.repeat(words.doc, n)] = flat[steps + np.repeat(at - (np.cumsum(n) - n), n)]

        keep = np.flatnonzero((sizes <= REMEMBERED_IDS) & (until - begin <= REMEMBERED_BYTES))
        begin, size = begin[keep].astype(np.int64), (until - begin)[keep].astype(np.int64)
        if not known.fits(len(keep), int(size.sum()), int(sizes[keep].sum())):
            self.known, self.older = Memory(REMEMBERED), known
        self.known.add(np.frombuffer(data, np.uint8), begin, size, hashed[keep], found, offsets[keep], sizes[keep])
        return out, counts


def _named(eights: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a run that stands for each name, name of each run); runs have the same name only if their bytes are equal."""
    _, first, place = np.unique(hashes, return_index=True, return_inverse=True)
    own, size = first[place], ends - starts
    odd = np.flatnonzero((size != size[own]) | _differ(eights, starts, eights, starts[own], size))
    if len(odd):  # equal hashes of different runs: each gets a name of its own
        place = place.copy()
        place[odd] = len(first) + np.arange(len(odd))
        first = np.append(first, odd)
    return first, place


def encoder(vocabulary: str) -> LibraryEncoder:
    if vocabulary not in _encoders:
        _encoders[vocabulary] = LibraryEncoder(vocabulary)
    return _encoders[vocabulary]


def write(docs: DataFrame, vocabulary: str, root: str, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Write all documents as wavelet files under `root`; give the list of files.

    (part, seq, file, n_docs, n_tokens). `root` is a URI that every executor can
    write to through Arrow's file systems. A null or empty text is its end id
    alone, a null doc_id comes first, and rows of equal id follow each other in
    order of their texts' hashes. A task that runs again writes the same files.
    """
    ordered = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ordered = ordered.withColumn("tie", F.xxhash64("text"))
    ordered = ordered.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text").drop("tie")

    def run(batches):
        part = TaskContext.get().partitionId()
        store, folder = fs.FileSystem.from_uri(root)
        store.create_dir(folder, recursive=True)
        ids, lengths, owners, held, seq = [], [], [], 0, 0

        def flush():
            nonlocal ids, lengths, owners, held, seq
            shard = Shard(owners, np.array(lengths), WaveletMatrix.build(np.concatenate(ids), encoder(vocabulary).bits))
            name = f"part-{part:06d}-{seq:06d}.wm"
            with store.open_output_stream(f"{folder}/_{name}.{TaskContext.get().taskAttemptId()}") as out:
                out.write(shard.to_bytes())
            store.move(f"{folder}/_{name}.{TaskContext.get().taskAttemptId()}", f"{folder}/{name}")
            row = [[part], [seq], [name], [len(lengths)], [held]]
            ids, lengths, owners, held, seq = [], [], [], 0, seq + 1
            return pa.RecordBatch.from_pydict(dict(zip(("part", "seq", "file", "n_docs", "n_tokens"), row)))

        for batch in batches:
            for piece in pieces(batch, "text", PIECE_BYTES):
                found, counts = encoder(vocabulary).encode(piece.column(1), END_ID)
                at = 0
                for doc_id, n in zip(piece.column(0).to_pylist(), counts.tolist()):
                    if held and held + n > SHARD_TOKENS:
                        yield flush()
                    ids.append(found[at : at + n])
                    owners.append(doc_id)
                    lengths.append(n)
                    held, at = held + n, at + n
        if held:
            yield flush()

    files = ordered.mapInArrow(run, "part long, seq long, file string, n_docs long, n_tokens long")
    return materialize(files, "token-files")


def starts(files: DataFrame) -> DataFrame:
    """(file, first): ids of all documents before each file, summed by task and then over tasks."""
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return (
        files.withColumn("before", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
        .join(parts, "part")
        .select("file", (F.col("base") + F.col("before")).alias("first"))
    )


def read(files: DataFrame, root: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone."""
    spark = files.sparkSession
    if not files.limit(1).count():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    contents = (
        spark.read.format("binaryFile").option("pathGlobFilter", "part-*.wm").load(root)
        .select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    )

    def run(batches):
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                shard = Shard.from_bytes(content.as_buffer().to_pybytes())
                raw = memoryview(shard.matrix.values().astype("<u4").tobytes())
                bounds = (4 * shard.starts).tolist()
                sums = [zlib.crc32(raw[a:b]) for a, b in zip(bounds, bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([file] * len(sums)),
                        pa.array(shard.doc_ids, pa.int64()),
                        pa.array(shard.starts[:-1]),
                        pa.array(shard.lengths),
                        pa.array(sums, pa.int64()),
                    ],
                    names=["file", "doc_id", "inside", "n_tokens", "ids_crc32"],
                )

    found = contents.mapInArrow(run, "file string, doc_id long, inside long, n_tokens long, ids_crc32 long")
    return found.join(starts(files), "file").select(
        "doc_id", (F.col("first") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"
    )


def write_and_read(docs: DataFrame, vocabulary: str, root: str | None = None) -> DataFrame:
    root = root or scratch_path(docs.sparkSession, "wavelet")
    root = root if "://" in root or root.startswith("file:") else f"file://{root}"
    return read(write(docs, vocabulary, root), root)
