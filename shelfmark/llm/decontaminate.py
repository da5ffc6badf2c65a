"""Benchmark decontamination by a generalised suffix automaton over words.

The automaton of a block of test items accepts every run of their words and
never a run across two items. Documents stream through it, word by word; the
state and its length say how long a run ending here is found in the items.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.batches import append_columns
from shelfmark.session import materialize

WINDOW = 10
#: Words of test items in one automaton; more items make more automata, met one after the other.
BLOCK_WORDS = 400_000
#: Share of a text's words in removed spans above which the whole text goes.
MAX_COVERAGE = 0.5
SCAN = "n_words long, hit_spans array<struct<first:int,last:int>>, hit_items array<string>"
DIGESTS = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"

#: A-Z to a-z; letters, digits and all beyond ASCII stay; the rest parts words.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """Words of a text; a null text has none."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


class Automaton:
    """Generalised suffix automaton of items; each state is a set of runs with the same ends."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, words in items:
            last = 0
            for word in words:
                last = self._extend(last, word)
        self._mark(items)

    def _state(self, length: int, moves: dict[bytes, int], link: int) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, p: int, word: bytes, q: int) -> int:
        """The state of q's runs no longer than p's plus one, parted from q."""
        clone = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, word: bytes) -> int:
        known = self.next[last].get(word)
        if known is not None:  # another item had this run already
            return known if self.length[known] == self.length[last] + 1 else self._split(last, word, known)
        new, p = self._state(self.length[last] + 1, {}, 0), last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, word, q)
        return new

    def _mark(self, items: list[tuple[str, list[bytes]]]) -> None:
        """For each state: the items with a window that ends a match there, and the short items among its suffixes."""
        owners: dict[int, set[str]] = {}
        whole: dict[int, list[tuple[int, str]]] = {}
        for item, words in items:
            state = 0
            for i, word in enumerate(words):
                state = self.next[state][word]
                at = state
                while at > 0 and item not in owners.get(at, ()):
                    if self.length[at] >= self.window:
                        owners.setdefault(at, set()).add(item)
                    at = self.link[at]
            if 0 < len(words) < self.window:
                whole.setdefault(self._suffix(state, len(words)), []).append((len(words), item))
        order = sorted(range(1, len(self.next)), key=self.length.__getitem__)
        self.anchor = [0] * len(self.next)  # the state of the last `window` words of a match
        self.short: list[tuple] = [()] * len(self.next)
        for s in order:
            link = self.link[s]
            if self.length[s] >= self.window:
                self.anchor[s] = s if self.length[link] < self.window else self.anchor[link]
            self.short[s] = self.short[link] + tuple(whole.get(s, ()))
        self.owners = {s: frozenset(owners[s]) for s in set(self.anchor) if s}

    def _suffix(self, state: int, length: int) -> int:
        """The state of the last `length` words of a match that ends in `state`."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Spans (first, last) of words inside windows found in the items, and those items."""
        moves, link, lengths, anchor, short = self.next, self.link, self.length, self.anchor, self.short
        state = matched = 0
        spans: list[tuple[int, int]] = []
        found: set[str] = set()
        for i, word in enumerate(words):
            step = moves[state].get(word)
            while step is None and state:
                state = link[state]
                matched = lengths[state]
                step = moves[state].get(word)
            if step is None:
                continue
            state = step
            matched += 1
            first = i + 1
            if matched >= self.window:
                first = i - matched + 1
                found |= self.owners[anchor[state]]
            if short[state]:
                for size, item in short[state]:
                    if size <= matched:
                        found.add(item)
                        first = min(first, i - size + 1)
            if first <= i:
                while spans and spans[-1][1] >= first - 1:
                    first = min(first, spans.pop()[0])
                spans.append((first, i))
        return spans, found


def _blocks(items: DataFrame, text_col: str, id_col: str) -> tuple[int, Iterator[list[tuple[str, list[bytes]]]]]:
    """The number of blocks of bounded size, and the items with words in each; the driver reads one block at a time."""
    chosen = items.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).where(
        "id IS NOT NULL AND text IS NOT NULL"
    )
    chars = chosen.agg(F.sum(F.length("text")).alias("n")).first().n or 0
    count = 1 + chars // (2 * BLOCK_WORDS)  # a word and its separator are two characters at least

    def block(k: int) -> list[tuple[str, list[bytes]]]:
        part = chosen.where(F.pmod(F.xxhash64("id", "text"), F.lit(count)) == k)
        return [(row.id, words_of(row.text)) for row in part.distinct().orderBy("id", "text").collect()]

    return count, map(block, range(count))


def scan(docs: DataFrame, items: DataFrame, text_col: str = "text", keep=None, window: int = WINDOW,
         item_text: str = "text", item_id: str = "item_id") -> DataFrame:
    """`docs` with `SCAN`: words, merged spans of hit words, and the ids of the items that hit.

    Every row stays a row. A null text has no words; items without id, text or
    words hit nothing; repeated items count once. More items than one automaton
    holds are met block by block, each pass over a written table.
    """
    keep = list(docs.columns if keep is None else keep)
    out, first = docs, True
    for block in _blocks(items, item_text, item_id)[1]:
        automaton = Automaton(block, window)
        if not first:
            out = materialize(out, "decontaminate")

        def make(piece, automaton=automaton, first=first):
            texts = piece.column("__text").to_pylist()
            counts, spans, found = [], [], []
            for row, text in enumerate(texts):
                words = words_of(text)
                hit, names = automaton.scan(words)
                if not first:
                    hit = merge_spans(hit + [(s["first"], s["last"]) for s in piece.column("__spans")[row].as_py()])
                    names |= set(piece.column("__items")[row].as_py())
                counts.append(len(words))
                spans.append([{"first": a, "last": b} for a, b in hit])
                found.append(sorted(names))
            kinds = [pa.int64(), pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())])), pa.list_(pa.string())]
            return [pa.array(x, kind) for x, kind in zip((counts, spans, found), kinds)]

        if first:
            # the text stays until the last block has seen it
            out = append_columns(out.select(*keep, F.col(text_col).alias("__scanned")), "__scanned", SCAN, make)
        else:
            out = append_columns(
                out.withColumnsRenamed({"hit_spans": "__spans", "hit_items": "__items"}), "__scanned", SCAN, make
            ).drop("__spans", "__items")
        first = False
    return out.drop("__scanned")


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, with those that touch joined."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(spans):
        if out and out[-1][1] >= first - 1:
            out[-1] = (out[-1][0], max(last, out[-1][1]))
        else:
            out.append((first, last))
    return out


def digests(scanned: DataFrame) -> DataFrame:
    """`scanned` with `DIGESTS` in place of spans and items."""
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)
    return (
        scanned.withColumn("n_hit", n_hit)
        .withColumn("n_items", F.size("hit_items").cast("long"))
        .withColumn("items_sha256", F.sha2(F.array_join(F.array_sort("hit_items"), ","), 256))
        .withColumn("contaminated", F.col("n_hit") > 0)
        .drop("hit_spans", "hit_items")
    )


_WORD = re.compile(rb"[^ ]+")


def cut_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """`text` without the words of `spans` and what stands between them; a line break takes each span's place."""
    raw = text.encode("utf-8", "surrogatepass")
    places = [m.span() for m in _WORD.finditer(raw.translate(_FOLD))]
    out, at = [], 0
    for first, last in spans:
        out.append(raw[at : places[first][0]].rstrip())
        at = places[last][1]
    out.append(raw[at:].lstrip())
    return b"\n".join(out).decode("utf-8", "surrogatepass")


def clean(docs: DataFrame, items: DataFrame, text_col: str = "text", max_coverage: float = MAX_COVERAGE,
          window: int = WINDOW) -> DataFrame:
    """`docs` without test items: hit spans are cut out of the text, and a text with too many hit words goes.

    A span reaches `window` words (or is a whole short item), which is the
    length limit; a text goes when its hit words exceed `max_coverage` of all.
    Cutting can bring a window together from both sides, so a text that was
    cut is scanned and cut again until it has none. Clean rows stay as they are,
    null and empty texts too. Several blocks give what one would: each round
    takes the spans of all blocks on the same text before it cuts, and hit words
    count against the words of the text as it came.
    """
    count, blocks = _blocks(items, "text", "item_id")
    if count > 1:
        return _clean_in_rounds(docs, items, text_col, max_coverage, window)
    automaton = Automaton(next(blocks), window)

    def run(batches):
        for batch in batches:
            kept, texts = [], []
            for text in batch.column(text_col).to_pylist():
                total, cut = len(words_of(text)), 0
                while text:
                    spans, _ = automaton.scan(words_of(text))
                    if not spans:
                        break
                    cut += sum(b - a + 1 for a, b in spans)
                    text = cut_spans(text, spans)
                kept.append(cut <= max_coverage * total)
                texts.append(text)
            at = batch.schema.get_field_index(text_col)
            done = batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
            yield done.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def _clean_in_rounds(docs: DataFrame, items: DataFrame, text_col: str, max_coverage: float, window: int) -> DataFrame:
    """`clean` for several blocks: all of them scan a text, then it is cut; texts that were cut go round again."""
    own = {c: "__cleaned" if c == text_col else f"__c{i}" for i, c in enumerate(docs.columns)}
    todo = docs.select(
        *(F.col(f"`{c}`").alias(name) for c, name in own.items()),
        F.lit(None).cast("long").alias("__total"), F.lit(0).cast("long").alias("__cut"),
    )
    done = None
    while True:
        found = materialize(scan(todo, items, "__cleaned", window=window).drop("hit_items"), "decontaminate")
        clear = found.where(F.size("hit_spans") == 0).select(*own.values())
        done = clear if done is None else done.unionByName(clear)

        def run(batches, schema=todo.schema):
            for batch in batches:
                kept, texts, totals, cuts = [], [], [], []
                for text, n, spans, total, cut in zip(
                    *(batch.column(c).to_pylist() for c in ("__cleaned", "n_words", "hit_spans", "__total", "__cut"))
                ):
                    total = n if total is None else total
                    spans = [(s["first"], s["last"]) for s in spans]
                    cut += sum(b - a + 1 for a, b in spans)
                    kept.append(cut <= max_coverage * total)
                    texts.append(cut_spans(text, spans) if kept[-1] else None)
                    totals.append(total)
                    cuts.append(cut)
                made = {"__cleaned": pa.array(texts, pa.string()), "__total": pa.array(totals, pa.int64()), "__cut": pa.array(cuts, pa.int64())}
                columns = [made[c] if c in made else batch.column(c) for c in schema.names]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names).filter(pa.array(kept, pa.bool_()))

        todo = materialize(found.where(F.size("hit_spans") > 0).mapInArrow(run, todo.schema), "decontaminate")
        if not todo.limit(1).count():
            return done.select(*(F.col(name).alias(c) for c, name in own.items()))
