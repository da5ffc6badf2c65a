"""Near duplicates by ProbMinHash over weighted five-word shingles.

A shingle weighs as often as it stands in its text. Each element of a text
arrives as a Poisson process of its weight's rate, every arrival at one of
`COMPONENTS` places; a place keeps the element that came first, and an element
stops when its next arrival is later than every place's first. Two texts agree
at a place with their probability Jaccard similarity. Band by band equal places
make candidates, and each candidate is verified by the similarity itself.

Texts with equal words are one node. In a bucket every node is verified against
the least one; the links found give first classes. Buckets that still hold
several classes are then gone through across classes, in blocks of bounded
size: the pairs whose signatures agree enough are verified, the most promising
first, and classes that a link has joined are one from there on. Only links are
given out. So no link that joins classes is lost, and a group of thousands of
copies gives as many rows as it has members and not their square.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.batches import bounded_broadcast, pieces
from shelfmark.llm.graph import components
from shelfmark.llm.tokens import ALNUM_WORDS, Words, byte_view, mix
from shelfmark.session import materialize

SHINGLE = 5
SIMILARITY = 0.8
#: A pair of similarity 0.8 shares no band with probability (1 - 0.8^6)^40 = 5e-6.
BANDS, ROWS = 40, 6
COMPONENTS = BANDS * ROWS
#: Agreeing components below which a pair of similarity 0.8 falls once in three million (five deviations).
AGREEING = int(COMPONENTS * (SIMILARITY - 5 * (SIMILARITY * (1 - SIMILARITY) / COMPONENTS) ** 0.5))
#: Nodes of a bucket that one cell takes from each side, and words of theirs (12 bytes of shingle each).
CELL, CELL_WORDS = 1_500, 3_000_000
#: Elements of texts whose arrivals are drawn at once.
DRAWN = 1 << 18
#: Shingles that a task keeps at hand while it verifies pairs.
HELD_BYTES = 32 << 20
#: Above so many ids a join goes by shuffle and not by broadcast.
BROADCAST_IDS = 4_000_000


def weighted_shingles(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, Words]:
    """(owner, shingle, weight) of each distinct shingle, owners ascending; a text of 1 to 4 words is one shingle."""
    words = Words(column, ALNUM_WORDS)
    doc, gram = words.shingles(SHINGLE)
    if words.docs > 1:
        order = np.lexsort((gram, doc))
        doc, gram = doc[order], gram[order]
    else:
        gram.sort()  # a long text is alone, and sorted in its place
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (gram[1:] != gram[:-1])
    starts = np.flatnonzero(new)
    return doc[starts], gram[starts], np.diff(np.append(starts, len(doc))).astype(np.float64), words


def signatures(owner: np.ndarray, element: np.ndarray, weight: np.ndarray, docs: int) -> np.ndarray:
    """The first element to arrive at each place of each text, 0 for a text without elements.

    The elements of a long text are drawn in parts; those of later parts stop
    at what earlier ones have reached.
    """
    first = np.full(docs * COMPONENTS, np.inf)
    chosen = np.zeros(docs * COMPONENTS, np.uint64)
    for at in range(0, len(element), DRAWN):
        part = slice(at, at + DRAWN)
        _draw(owner[part], element[part], weight[part], first, chosen)
    return chosen.reshape(docs, COMPONENTS)


def _draw(owner: np.ndarray, element: np.ndarray, weight: np.ndarray, first: np.ndarray, chosen: np.ndarray) -> None:
    """Take the arrivals of some elements into the `first` times of all places and the elements `chosen` there."""
    docs = len(first) // COMPONENTS
    time = np.zeros(len(element))
    arrival = 0
    while len(element):
        arrival += 1
        draw = mix(element + np.uint64(arrival * 0xA0761D6478BD642F % 2**64))
        time = time - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / weight
        place = owner * COMPONENTS + (mix(draw ^ np.uint64(0xE7037ED1A0B428DB)) % np.uint64(COMPONENTS)).astype(np.int64)
        np.minimum.at(first, place, time)
        won = time == first[place]
        chosen[place[won]] = element[won]
        last = first.reshape(docs, COMPONENTS).max(axis=1)
        alive = time < last[owner]
        owner, element, weight, time = owner[alive], element[alive], weight[alive], time[alive]


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Probability Jaccard similarity of two weighted sets (sorted elements, weights).

    The sum over shared i of 1 / sum_j max(a_j / a_i, b_j / b_i). With the
    elements in order of a_j / b_j, the maximum is a_j / a_i from i on and
    b_j / b_i before, so running sums give every term.
    """
    every = np.union1d(a[0], b[0])
    x, y = np.zeros(len(every)), np.zeros(len(every))
    x[np.searchsorted(every, a[0])] = a[1]
    y[np.searchsorted(every, b[0])] = b[1]
    ratio = np.divide(x, y, out=np.full(len(x), np.inf), where=y > 0)
    order = np.argsort(ratio, kind="stable")
    x, y = x[order], y[order]
    from_here = np.cumsum(x[::-1])[::-1]
    before = np.cumsum(y) - y
    both = (x > 0) & (y > 0)
    return float((1 / (from_here[both] / x[both] + before[both] / y[both])).sum())


def _sign(docs: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """(doc_id, low, high, n_words, bands, signs) of each row; digest and signature are null for a text without words."""

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, "text"):
                owner, element, weight, words = weighted_shingles(piece.column(1))
                signed = signatures(owner, element, weight, words.docs)
                some = words.counts > 0
                total = np.zeros((words.docs, BANDS), np.uint64)
                for row in range(ROWS):
                    total = mix(total * np.uint64(0xD6E8FEB86659FD93) + signed[:, row::ROWS] + np.uint64(row))
                total = mix(total + np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                signs = (signed >> np.uint64(32)).astype(np.uint8)
                digests = np.frombuffer(b"".join(_digests(words, piece.column(1))), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column(0),
                        pa.array(digests[:, 0], mask=~some),
                        pa.array(digests[:, 1], mask=~some),
                        pa.array(words.counts, pa.int64()),
                        pa.array([t.tobytes() for t in total], pa.binary(), mask=~some),
                        pa.array([s.tobytes() for s in signs], pa.binary(), mask=~some),
                    ],
                    names=["doc_id", "low", "high", "n_words", "bands", "signs"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, low long, high long, n_words long, bands binary, signs binary")


_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if ALNUM_WORDS[b] else 32 for b in range(256))


def _digests(words: Words, column: pa.Array) -> list[bytes]:
    """128 bits of the sequence of words of each text."""
    raw, bounds = byte_view(column)
    folded = raw.tobytes().translate(_FOLD)
    return [hashlib.md5(b" ".join(folded[a:b].split())).digest() for a, b in zip(bounds, bounds[1:])]


def _verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose similarity reaches the limit."""
    full = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a").join(
        texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b"
    )

    def run(batches):
        held: OrderedDict[int, tuple] = OrderedDict()
        size = 0

        def shingles(key, text):
            nonlocal size
            if key in held:
                held.move_to_end(key)
                return held[key]
            _, element, weight, _ = weighted_shingles(pa.array([text], pa.string()))
            held[key] = (element, weight)
            size += element.nbytes + weight.nbytes
            while size > HELD_BYTES and len(held) > 1:
                gone = held.popitem(last=False)[1]
                size -= gone[0].nbytes + gone[1].nbytes
            return element, weight

        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            keep = [
                similarity(shingles(i, s.as_py()), shingles(j, t.as_py())) >= SIMILARITY - 1e-12
                for i, j, s, t in zip(a, b, batch.column(2), batch.column(3))
            ]
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return full.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def _texts(docs: DataFrame, pairs: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """Texts of the nodes in `pairs`, one per node."""
    nodes = materialize(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "neardup-nodes")
    found = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("text IS NOT NULL")
    found = found.join(bounded_broadcast(nodes, BROADCAST_IDS), "doc_id")
    return materialize(found.groupBy("doc_id").agg(F.min("text").alias("text")), "neardup-texts")


def _shingles(docs: DataFrame, nodes: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """(node, element, weight): the weighted shingles of the given nodes as bytes."""
    texts = docs.select(F.col(id_col).cast("long").alias("node"), F.col(text_col).alias("text")).where("text IS NOT NULL")
    texts = texts.join(bounded_broadcast(nodes, BROADCAST_IDS), "node").groupBy("node").agg(F.min("text").alias("text"))

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, "text"):
                owner, element, weight, words = weighted_shingles(piece.column(1))
                ends = np.cumsum(np.bincount(owner, minlength=words.docs))[:-1]
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column(0),
                        pa.array([e.tobytes() for e in np.split(element, ends)], pa.binary()),
                        pa.array([w.astype(np.float32).tobytes() for w in np.split(weight, ends)], pa.binary()),
                    ],
                    names=["node", "element", "weight"],
                )

    return texts.mapInArrow(run, "node long, element binary, weight binary")


class _Cell:
    """Nodes of one bucket, or of two blocks of a large one, and the classes they are in."""

    def __init__(self):
        self.rows: list[tuple] = []

    def links(self) -> set[tuple[int, int]]:
        """Verified pairs that join classes; once joined, two classes are not compared any more.

        A pair is looked at in the first band that it shares, the most promising first.
        """
        left, right, band, node, root, bands, signs, element, weight = map(list, zip(*self.rows))
        bands = np.frombuffer(b"".join(bands), np.uint64).reshape(-1, BANDS)
        signs = np.frombuffer(b"".join(signs), np.uint8).reshape(-1, COMPONENTS)
        names = {r: i for i, r in enumerate(dict.fromkeys(root))}
        group = np.array([names[r] for r in root])
        right = np.array(right)
        sets: dict[int, tuple] = {}

        def shingles(i):
            if i not in sets:
                sets[i] = (np.frombuffer(element[i], np.uint64), np.frombuffer(weight[i], np.float32).astype(np.float64))
            return sets[i]

        found = set()
        for k in np.flatnonzero(left):
            others = np.flatnonzero(right & (group != group[k]))
            if not len(others):
                continue
            agreeing = (signs[others] == signs[k]).sum(axis=1)
            near = agreeing >= AGREEING
            if not near.any():
                continue
            others, agreeing = others[near], agreeing[near]
            # by the keys themselves: signs may agree in a band whose elements differ, and no bucket holds the pair there
            first = (bands[others] == bands[k]).argmax(axis=1) == band[k]
            others, agreeing = others[first], agreeing[first]
            for x in others[np.argsort(-agreeing, kind="stable")]:
                if group[x] != group[k] and similarity(shingles(k), shingles(x)) >= SIMILARITY - 1e-12:
                    found.add((min(node[k], node[x]), max(node[k], node[x])))
                    group[group == group[x]] = group[k]
        return found


def _cross_links(rows: DataFrame) -> DataFrame:
    """Links (a, b) between the classes that share a bucket; rows: (band, key, node, root, blocks, bands, signs, element, weight).

    A bucket is dealt into its number of blocks, and each pair of blocks is a
    cell of its own, so no task holds a large bucket whole.
    """
    cells = F.col("blocks")
    dealt = rows.withColumn("own", F.pmod(F.xxhash64("node"), cells)).withColumn(
        "other", F.explode(F.sequence(F.lit(0), cells - 1))
    )
    content = ["left", "right", "band", "node", "root", "bands", "signs", "element", "weight"]
    dealt = dealt.withColumns({
        "i": F.least("own", "other"), "j": F.greatest("own", "other"),
        "left": F.col("own") <= F.col("other"), "right": F.col("own") >= F.col("other"),
    })
    dealt = dealt.select("key", "i", "j", *content).repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    def run(batches):
        at, cell, found = None, _Cell(), set()
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in range(batch.num_columns)]
            for row in zip(*columns):
                if row[:3] != at:
                    if len(cell.rows) > 1:
                        found |= cell.links()
                    at, cell = row[:3], _Cell()
                cell.rows.append(row[3:])
        if len(cell.rows) > 1:
            found |= cell.links()
        a, b = zip(*found) if found else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return dealt.mapInArrow(run, "a long, b long").distinct()


def classes(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, class_id) of every row: the least doc_id among all linked to it, itself included.

    Words are runs of ASCII letters, digits and all beyond ASCII, A-Z as a-z.
    Texts of equal words are copies. Texts of fewer than five words are compared
    as one shingle; null, empty and wordless texts are alone in their class. Very
    long texts are compared whole; a task holds about fifteen bytes for each byte.
    Rows that share a doc_id share a class, and if their texts differ one text
    stands for all; a null doc_id has a null class.
    """
    signed = materialize(_sign(docs, text_col, id_col), "neardup-signed")
    copies = signed.where("low IS NOT NULL AND doc_id IS NOT NULL").groupBy("low", "high").agg(F.min("doc_id").alias("node"))
    copies = materialize(copies, "neardup-copies")
    nodes = signed.join(copies.select("low", "high", "node"), ["low", "high"]).where("doc_id = node")
    nodes = nodes.groupBy("node").agg(F.min_by(F.struct("n_words", "bands", "signs"), F.struct("low", "high")).alias("s"))
    nodes = materialize(nodes.select("node", "s.n_words", "s.bands", "s.signs"), "neardup-distinct")

    keys = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda i: F.conv(F.hex(F.substring("bands", i * 8 + 1, 8)), 16, -10).cast("long"),
    )
    keyed = nodes.select("node", F.posexplode(keys).alias("band", "key"))
    # reduced before the shuffle and joined back, so a bucket of any size is never gathered in one task
    shared = keyed.groupBy("key").agg(F.min("node").alias("least"), F.count("node").alias("n")).where("n > 1").drop("n")
    buckets = keyed.join(materialize(shared, "neardup-shared"), "key").select("band", "key", "node", "least")
    buckets = materialize(buckets, "neardup-buckets")

    stars = buckets.where("node != least").select(F.col("least").alias("a"), F.col("node").alias("b")).distinct()
    stars = materialize(stars, "neardup-pairs")
    links = materialize(_verify(stars, _texts(docs, stars, text_col, id_col)), "neardup-links")
    roots = components(links)

    rooted = buckets.join(roots, "node", "left").select("band", "key", "node", F.coalesce("root", "node").alias("root"))
    several = rooted.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x != y").select("key")
    open_rows = materialize(rooted.join(several, "key"), "neardup-open")
    if open_rows.limit(1).count():
        open_nodes = materialize(open_rows.select("node").distinct(), "neardup-nodes")
        blocks = F.greatest(F.ceil(F.count("node") / CELL), F.ceil(F.sum("n_words") / CELL_WORDS)).cast("long")
        sizes = open_rows.join(nodes.select("node", "n_words"), "node").groupBy("key").agg(blocks.alias("blocks"))
        open_rows = open_rows.join(materialize(sizes, "neardup-sizes"), "key")
        known = nodes.select("node", "bands", "signs").join(_shingles(docs, open_nodes, text_col, id_col), "node")
        more = materialize(_cross_links(open_rows.join(known, "node")), "neardup-links")
        if more.limit(1).count():
            roots = components(links.unionByName(more))

    own = copies.join(roots, "node", "left").select("low", "high", F.coalesce("root", "node").alias("class_id"))
    found = signed.where("low IS NOT NULL").select("doc_id", "low", "high").join(own, ["low", "high"], "left")
    # texts without words meet nobody, and are not sent to one task for their lack of a digest
    alone = signed.where("low IS NULL").select("doc_id", F.col("doc_id").alias("class_id"))
    # ids with several texts: one class for all their rows, the least
    return _one_class_per_id(found.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id")).unionByName(alone))


def _one_class_per_id(rows: DataFrame) -> DataFrame:
    rows = materialize(rows, "neardup-classes")
    torn = rows.groupBy("doc_id").agg(F.min("class_id").alias("x"), F.max("class_id").alias("y")).where("x != y")
    links = materialize(torn.select(F.col("x").alias("a"), F.col("y").alias("b")), "neardup-links")
    if not links.limit(1).count():
        return rows
    roots = components(links).withColumnRenamed("node", "class_id")
    return rows.join(roots, "class_id", "left").select("doc_id", F.coalesce("root", "class_id").alias("class_id"))


def keep_one(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """`docs` with one row of each class: that of the least id; rows without id stay."""
    found = materialize(classes(docs, text_col, id_col), "neardup-kept")
    gone = bounded_broadcast(found.where("doc_id != class_id").select("doc_id").distinct(), BROADCAST_IDS)
    again = found.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id")
    again = materialize(again, "neardup-again")
    kept = docs.join(gone.withColumnRenamed("doc_id", id_col), id_col, "left_anti").select(*docs.columns)
    if not again.limit(1).count():
        return kept
    again = bounded_broadcast(again, BROADCAST_IDS).withColumnRenamed("doc_id", id_col)
    once = kept.join(again, id_col, "left_semi").dropDuplicates([id_col])
    return kept.join(again, id_col, "left_anti").unionByName(once).select(*docs.columns)
