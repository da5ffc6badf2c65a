"""Parts of the operators against plain versions."""

import datetime
import random
import re
import subprocess
import sys
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfmark.llm import decontaminate, language, neardup, neighbours, pseudonyms, quality_rules, token_files, tokens
from shelfmark.llm.graph import components
from shelfmark.llm.merges import PlainDecoder, WordCodec
from shelfmark.llm.queries import VOCABULARY
from shelfmark.llm.wavelet import Shard, WaveletMatrix


@pytest.fixture(scope="module")
def codec():
    return WordCodec(VOCABULARY)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


BITS = ["a", "b", "the", "in", "g", " ", "'s", "'", "é", "ß", "Σ", "İ", "<|endoftext|>", "<|", "J̌", "\x1c", "1", "!!", "́", "ing", "th", "中"]


def test_codec_and_library_memory_equal_the_library(codec, library):
    rng = random.Random(3)
    texts = ["".join(rng.choices(BITS, k=rng.randrange(25))) for _ in range(4000)]
    remembering = token_files.LibraryEncoder(VOCABULARY)
    halves = [remembering.encode(pa.array(some), 1) for some in (texts[:2000], texts[2000:])]
    ends = np.cumsum(np.concatenate([counts for _, counts in halves]))[:-1]
    for text, remembered in zip(texts, np.split(np.concatenate([ids for ids, _ in halves]), ends)):
        ids = library.encode(text, add_special_tokens=False).ids
        assert codec.encode(text) == ids and remembered.tolist() == [*ids, 1]
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_codec_equals_the_library_on_code_points_of_any_age(codec, library):
    some = [*range(0x80, 0x3000), *range(0xA000, 0xABFF), *range(0x10900, 0x10F00), *range(0x11900, 0x11E00)]
    for point in some:
        text = f"a{chr(point)}\u0332b1{chr(point)}!{chr(point)} x"
        assert codec.encode(text) == library.encode(text, add_special_tokens=False).ids, hex(point)


def thue_morse(letters, n):
    return "".join(letters[bin(i).count("1") % 2] for i in range(n))


def test_chunks_of_equal_hash_keep_their_own_ids(library, monkeypatch):
    pairs = [thue_morse(letters, n) for n in (1024, 2048) for letters in ("ab", "ba")]
    few = ["ab", "ba", "abcdefgh", "abcdefgi", "bbcdefgh", "abcdefghij", "abcdefghik", "abcdefghijklmnopqr", "abcdefgXijklmnopqr", "a"]
    texts = [*pairs, " ".join(pairs), " ".join(few + few[::-1]), *few]
    wanted = [[*library.encode(t, add_special_tokens=False).ids, 1] for t in texts]

    def check():
        own = token_files.LibraryEncoder(VOCABULARY)
        for some in (texts, texts[::-1]):
            ids, counts = own.encode(pa.array(some), 1)
            assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == (wanted if some is texts else wanted[::-1])

    check()
    # and if all hashes were equal
    words = token_files.Words

    class Same(words):
        def __init__(self, *args, **options):
            super().__init__(*args, **options)
            self.hash = np.zeros_like(self.hash)

    monkeypatch.setattr(token_files, "Words", Same)
    check()


def test_long_words_are_not_remembered():
    codec, remembering = WordCodec(VOCABULARY), token_files.LibraryEncoder(VOCABULARY)
    texts = ["x" * 5_000 + " ab", "é" * 5_000]
    assert [codec.encode(t) for t in texts] == [remembering.library.encode(t, add_special_tokens=False).ids for t in texts]
    remembering.encode(pa.array(texts), 1)
    assert set(codec._chunks) == {"ab"} == set(codec._words) and len(remembering.known) == 1


def test_library_memory_of_any_size_equals_the_library(library, monkeypatch):
    """Marks in and around words, letters that only look plain, and memories that are full all the time."""
    some = [*BITS, ".", ",", "...", "&*", "é", "ç", "÷", "É", "Ÿ", "š", "ệ", "a\u0301", "Abc", "-", "\n", "\xa0", "word", "words,more"]
    rng = random.Random(7)
    texts = ["".join(rng.choices(some, k=rng.randrange(30))) for _ in range(3000)] + ["x" * 300 + ".", "", None]
    wanted = [[*library.encode(t or "", add_special_tokens=False).ids, 1] for t in texts]
    for size in (1, 40, 5000):
        monkeypatch.setattr(token_files, "REMEMBERED", size)
        own = token_files.LibraryEncoder(VOCABULARY)
        for _ in range(2):
            for first in range(0, len(texts), 500):
                ids, counts = own.encode(pa.array(texts[first : first + 500], pa.string()), 1)
                assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == wanted[first : first + 500]
                assert len(own.known) <= size and len(own.older) <= size


MANY_RUNS = r"""
import random, re, sys
from pathlib import Path
import pyarrow as pa
from shelfmark.llm import token_files
from shelfmark.llm.batches import give_back

def held():
    give_back()
    return int(re.search("RssAnon:\s+(\d+)", Path("/proc/self/status").read_text())[1]) / 1024

own, rng = token_files.LibraryEncoder(sys.argv[1]), random.Random(8)
parts = ["the", "an", "er", "on", "re", "he", "in", "ed", "nd", "ha", "at", "en", "es", "of", "or"]
def some(n):
    return pa.array([" ".join("".join(rng.choices(parts, k=7)) + rng.choice(["", ",", "."]) for _ in range(n))])
own.encode(some(100), 1)
before = held()
for _ in range(95):
    own.encode(some(10_000), 1)
print(held() - before)
"""


@pytest.mark.skipif(not Path("/proc/self/status").exists(), reason="memory is read from /proc")
def test_library_memory_is_small():
    """A worker remembers two times half a million runs at most; as Python objects they took 211 MB."""
    found = subprocess.run([sys.executable, "-c", MANY_RUNS, VOCABULARY], capture_output=True, text=True, cwd=Path(__file__).parents[2])
    assert not found.returncode and float(found.stdout) < 100, found


def test_stream_needs_no_more_than_the_lookahead(codec):
    merges = WordCodec(VOCABULARY).merges
    merges.window = merges.lookahead + 8
    rng = random.Random(4)
    for _ in range(60):
        word = "".join(rng.choices("aeinthrsod", k=rng.randrange(200, 900)))
        symbols = [codec.letters[b] for b in word.encode()]
        symbols[-1] += "</w>"
        assert list(merges.transduce(symbols)) == merges.merge(symbols)


def test_plain_decoder_joins_bytes_to_characters(codec):
    plain = PlainDecoder(codec.tokens)
    assert "".join(plain.push(i) for i in codec.encode("Wörld 中文 q́")) == "wörld 中文 q ́ "


def test_wavelet_answers_like_a_list():
    rng = np.random.default_rng(1)
    for size, bits in ((0, 4), (1, 1), (511, 5), (512, 16), (5000, 16), (1500, 20)):
        ids = rng.integers(0, min(1 << bits, 300), size)
        shard = Shard([7, None], np.array([size // 3, size - size // 3]), WaveletMatrix.build(ids, bits))
        shard = Shard.from_bytes(shard.to_bytes())
        assert shard.doc_ids == [7, None] and shard.matrix.values().tolist() == ids.tolist()
        for i in rng.integers(0, size, 40) if size else ():
            assert shard.matrix.access(int(i)) == ids[i]
            value = int(ids[i])
            assert shard.matrix.rank(value, int(i)) == (ids[:i] == value).sum()
            places = np.flatnonzero(ids == value)
            assert shard.count(value) == len(places)
            assert [shard.matrix.select(value, k) for k in range(len(places))] == places.tolist()
            assert shard.matrix.select(value, len(places)) == -1
            first = size // 3
            assert shard.occurrences(value) == [(int(p >= first), int(p - first * (p >= first))) for p in places]
        assert shard.matrix.rank(1 << bits, size) == 0


def plain_scan(words, items, window):
    hit, found = set(), set()
    for item, own in items:
        size = min(window, len(own))
        runs = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if own else set()
        for i in range(len(words) - size + 1):
            if tuple(words[i : i + size]) in runs:
                found.add(item)
                hit.update(range(i, i + size))
    return hit, found


def test_automaton_finds_what_a_plain_search_finds():
    rng = random.Random(5)
    for _ in range(300):
        letters = [bytes([c]) for c in b"abcd"[: rng.randrange(1, 5)]]
        items = [(str(i), rng.choices(letters, k=rng.randrange(0, 12))) for i in range(rng.randrange(0, 6))]
        window = rng.randrange(1, 6)
        machine = decontaminate.Automaton(items, window)
        words = rng.choices(letters, k=rng.randrange(0, 40))
        spans, found = machine.scan(words)
        hit, wanted = plain_scan(words, items, window)
        assert {p for a, b in spans for p in range(a, b + 1)} == hit and found == wanted
        assert spans == sorted(spans) and all(b[0] > a[1] + 1 for a, b in zip(spans, spans[1:]))


def test_many_blocks_give_what_one_gives(spark, monkeypatch):
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(12)]
    docs = spark.createDataFrame([(i, " ".join(rng.choices(vocabulary, k=60))) for i in range(40)], "doc_id long, text string")
    items = spark.createDataFrame([(i, " ".join(rng.choices(vocabulary, k=rng.randrange(1, 8)))) for i in range(30)], "item_id long, text string")

    def run():
        found = decontaminate.scan(docs, items, window=3, keep=["doc_id"])
        cleaned = decontaminate.clean(docs, items, max_coverage=0.9, window=3)
        return sorted(map(str, found.collect())), sorted(map(str, cleaned.collect()))

    whole = run()
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 40)
    assert run()[0] == whole[0]


def test_many_blocks_clean_like_one(spark, monkeypatch):
    """Windows that overlap across blocks, seams, and coverage that only all blocks together pass."""
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(12)]
    docs = spark.createDataFrame(
        [(i, i % 3, " ".join(rng.choices(vocabulary, k=rng.randrange(70)))) for i in range(60)] + [(60, 0, None), (61, 0, "")],
        "doc_id long, n_words int, text string",
    )
    items = spark.createDataFrame([(i, " ".join(rng.choices(vocabulary, k=rng.randrange(3, 8)))) for i in range(30)], "item_id long, text string")

    def run(max_coverage):
        return sorted(map(str, decontaminate.clean(docs, items, max_coverage=max_coverage, window=3).collect()))

    whole = {x: run(x) for x in (0.3, 0.9)}
    assert 2 < len(whole[0.3]) < len(whole[0.9])
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 100)
    assert {x: run(x) for x in whole} == whole


def test_cleaning_reads_one_block_at_a_time(spark, monkeypatch):
    items = spark.createDataFrame([(i, f"u{i} v{i} w{i}") for i in range(60)], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a u7 v7 w7 b c d e f")], "doc_id long, text string")
    events, collect, build = [], type(docs).collect, decontaminate.Automaton.__init__

    def collecting(frame):
        if frame.columns == ["id", "text"]:
            events.append("read")
        return collect(frame)

    def building(self, *args):
        events.append("build")
        build(self, *args)

    monkeypatch.setattr(type(docs), "collect", collecting)
    monkeypatch.setattr(decontaminate.Automaton, "__init__", building)
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 150)
    assert [r.text for r in decontaminate.clean(docs, items, window=3).collect()] == ["a\nb c d e f"]
    assert len(events) > 2 and events == ["read", "build"] * (len(events) // 2)


def test_cleaned_texts_hold_no_window(spark):
    items = spark.createDataFrame([(1, "a b c d e f g h i j k l")], "item_id long, text string")
    clean = "Quite another text, of its own words entirely; nothing to cut. "
    texts = [clean, clean * 3 + "A b, c d e f g h i j K l! And so on", "a b c d e f g h i j", clean * 2 + "a b c d a b c d e f g h i j e f g h i j", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.text for r in decontaminate.clean(docs, items).collect()}
    assert found.keys() == {0, 1, 3, 4, 5} and found[0] == clean and found[4] is None and found[5] == ""
    assert "K l" not in found[1] and found[1].startswith(clean) and found[1].endswith("And so on")
    machine = decontaminate.Automaton([("1", decontaminate.words_of("a b c d e f g h i j k l"))])
    assert all(machine.scan(decontaminate.words_of(t)) == ([], set()) for t in found.values())


def test_agreeing_places_estimate_the_similarity():
    rng = np.random.default_rng(2)
    guesses, truths = [], []
    for _ in range(60):
        element = rng.integers(1, 1 << 60, 300).astype(np.uint64)
        a, b = (np.sort(rng.permutation(300)[: rng.integers(150, 300)]) for _ in range(2))
        w = rng.integers(1, 6, 300).astype(float)
        sets = [(np.sort(element[s]), w[s][np.argsort(element[s])]) for s in (a, b)]
        owner = np.repeat([0, 1], [len(a), len(b)])
        signed = neardup.signatures(owner, np.concatenate([s[0] for s in sets]), np.concatenate([s[1] for s in sets]), 2)
        guesses.append((signed[0] == signed[1]).mean())
        truths.append(neardup.similarity(*sets))
    assert np.mean(guesses) == pytest.approx(np.mean(truths), abs=0.02)
    assert np.abs(np.array(guesses) - truths).max() < 0.15


@pytest.mark.parametrize("cell, cell_words", [(1_500, 3_000_000), (4, 3_000_000), (1_500, 500)])
def test_links_between_classes_of_one_bucket_are_not_lost(spark, monkeypatch, cell, cell_words):
    """A chain whose ends are unlike: the least text of a bucket is similar to its neighbour alone."""
    monkeypatch.setattr(neardup, "CELL", cell)
    monkeypatch.setattr(neardup, "CELL_WORDS", cell_words)
    words = [f"t{i}" for i in range(400)]
    docs = [(k, " ".join(words[6 * k : 6 * k + 150])) for k in range(30)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    pairs = [
        (a, b) for a in range(30) for b in range(a)
        if neardup.similarity(*(neardup.weighted_shingles(pa.array([docs[i][1]]))[1:3] for i in (a, b))) >= 0.8
    ]
    assert pairs
    found = {r.doc_id: r.class_id for r in neardup.classes(frame).collect()}
    assert all(found[a] == found[b] for a, b in pairs)


def test_signs_that_agree_by_chance_lose_no_pair(spark):
    """The signs agree in band 0, where the elements differ; the bucket that the pair shares is that of band 5."""
    element = np.arange(1, 101, dtype=np.uint64).tobytes()
    weight = np.ones(100, np.float32).tobytes()
    bands = np.arange(2 * neardup.BANDS, dtype=np.uint64).reshape(2, -1)
    bands[1, 5] = bands[0, 5]
    signs = bytes(neardup.COMPONENTS)
    rows = [(5, 5, node, node, 1, bands[i].tobytes(), signs, element, weight) for i, node in enumerate((10, 20))]
    frame = spark.createDataFrame(
        rows, "band int, key long, node long, root long, blocks long, bands binary, signs binary, element binary, weight binary"
    )
    assert [tuple(r) for r in neardup._cross_links(frame).collect()] == [(10, 20)]


def test_components_of_random_graphs(spark):
    rng = random.Random(8)
    links = [(rng.randrange(120), rng.randrange(120)) for _ in range(80)] + [(500 + i, 501 + i) for i in range(40)]
    root = {x: x for link in links for x in link}
    for _ in root:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {n: r for n, r in root.items() if any(a != b and n in (a, b) for a, b in links)}


def luhn(number):
    digits = [int(c) for c in reversed(re.sub(r"\D", "", number))]
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(digits)) % 10 == 0


def test_pseudonyms_keep_format_and_check_digits(spark):
    values = {
        "4111 1111 1111 1111": r"\d{4} \d{4} \d{4} \d{4}", "4111111111111111": r"\d{16}", "DE89 3704 0044 0532 0130 00": r"DE\d\d( \d{4}){4} \d\d",
        "GB82WEST12345698765432": r"GB\d\d[A-Z]{4}\d{14}", "Jo.Doe+7@Mail.example.com": r"[A-Z][a-z]\.[A-Z][a-z]{2}\+\d@Mail\.example\.com",
        "+1 (555) 010-9999": r"\+1 \(\d{3}\) \d{3}-\d{4}", "(555) 010-9999": r"\(\d{3}\) \d{3}-\d{4}", "192.168.0.1": r"\d+(\.\d+){3}",
        "123-45-6789": r"\d{3}-\d\d-\d{4}", "1985-02-28": r"\d{4}-\d\d-\d\d", "28/02/1985": r"\d\d/\d\d/\d{4}", "31.12.1999": r"\d\d\.\d\d\.\d{4}",
    }
    kept = ["4111111111111112", "1985-02-30", "256.1.1.1", "DE00370400440532013000", "3.14", "no", "2024", "token=1234567890123456",
            "000-00-0000", "000-12-3456", "666-12-3456", "912-34-5678", "123-00-6789", "123-45-0000", "0000-01-01"]
    rows = [(v, f"See <{v}>, again {v}!") for v in [*values, *kept]]
    found = {r.v: r for r in pseudonyms.pseudonymise(spark.createDataFrame(rows, "v string, text string"), "k").collect()}
    for v, form in values.items():
        m = re.fullmatch(rf"See <(.*)>, again (.*)!", found[v].text)
        assert m and m[1] == m[2] != v and re.fullmatch(form, m[1]) and found[v].n_pii == 2, (v, found[v].text)
        if v.startswith("4111"):
            assert luhn(m[1])
        if v[:2] in ("DE", "GB"):
            plain = m[1].replace(" ", "")
            assert int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1
    assert all(found[v].text == f"See <{v}>, again {v}!" and found[v].n_pii == 0 for v in kept)
    datetime.date.fromisoformat(re.search(r"<(.*)>", found["1985-02-28"].text)[1])


def test_values_beside_others_and_inside_failed_matches(spark):
    card, amex, iban = "4111 1111 1111 1111", "3782 822463 10005", "GB82WEST12345698765432"
    cases = {  # values in their texts, as {}
        "{} 123": [card], "{} 12/25": ["4111111111111111"], "{} BIC COBADEFF": ["DE89 3704 0044 0532 0130 00"],
        "{} {}": [iban, "2024-05-01"], "at {}T10:00:00Z": ["2024-05-01"], "No 12 {} 99": [card], "{} 1234 {}": [amex, "4111-1111-1111-1111"],
        "AT12 {}": [card], "1234 5678 9012 3456 7890 {}": [card], "{}, {}": ["4111111111111111", "Jo@example.com"],
        "x {}5 {}": ["jo@example.com", "192.168.0.1"], "+49 30 1234 5678 9012 3456 {}": ["(555) 010-9999"], "4111 1111 1111 1112 é {}": ["31.12.1999"],
    }
    rows = [(f, f.format(*v)) for f, v in cases.items()]
    found = {r.f: r for r in pseudonyms.pseudonymise(spark.createDataFrame(rows, "f string, text string"), "k").collect()}
    alone = [(v,) for some in cases.values() for v in some]
    single = {r.v: r.text for r in pseudonyms.pseudonymise(spark.createDataFrame(alone, "v string").selectExpr("v", "v AS text"), "k").collect()}
    for f, values in cases.items():
        if f.startswith("+49"):
            assert found[f].text.endswith(single[values[0]]) and "1234 5678" not in found[f].text
            continue
        assert found[f].text == f.format(*(single[v] for v in values)) and found[f].n_pii == len(values), (f, found[f].text)
        assert all(single[v] != v for v in values)


def test_permutations_are_one_to_one(spark):
    n = pseudonyms.DAYS
    days = spark.range(n * n).select(
        pseudonyms.permute_number(F.floor(F.col("id") / n), F.col("id") % n, (n, n), "k", "date").alias("p")
    )
    assert days.distinct().count() == n * n
    numbers = spark.range(10_000).select(pseudonyms.permute_chars(F.format_string("%04d", "id"), "k", "x").alias("p"))
    assert numbers.where(F.rlike("p", F.lit("^[0-9]{4}$"))).distinct().count() == 10_000
    other = spark.range(100).select(pseudonyms.permute_chars(F.format_string("%04d", "id"), "k2", "x").alias("p"))
    assert other.exceptAll(numbers.limit(100)).count() > 50


def test_permutations_of_unequal_halves_are_one_to_one(spark):
    rows, sizes = 7 * 30, (7, 30)
    some = spark.range(rows).select(
        pseudonyms.permute_number(F.floor(F.col("id") / 30), F.col("id") % 30, sizes, "k", "x").alias("p")
    )
    assert some.where("p.left < 7 AND p.right < 30").distinct().count() == rows
    # every day that a date can name, once
    assert pseudonyms.LEFT_OVER[0] * pseudonyms.LEFT_OVER[1] == (
        pseudonyms.DAYS_BEFORE % pseudonyms.SPAN + pseudonyms.DAYS_AFTER % pseudonyms.SPAN
    )
    first, last = datetime.date(1, 1, 1).toordinal(), datetime.date(9999, 12, 31).toordinal()
    head, tail = pseudonyms.DAYS_BEFORE % pseudonyms.SPAN, pseudonyms.DAYS_AFTER % pseudonyms.SPAN
    days = spark.range(head).unionByName(spark.range(last - first + 1 - tail, last - first + 1)).select(
        F.date_add(F.lit("0001-01-01").cast("date"), F.col("id").cast("int")).alias("day")
    )
    moved = days.select(pseudonyms.another_day(F.col("day"), "k").alias("day")).distinct()
    assert moved.count() == days.count() == head + tail
    assert moved.join(days, "day", "left_anti").count() == 0


def test_one_pseudonym_however_a_value_is_written(spark):
    alike = [
        ["4111111111111111", "4111 1111 1111 1111", "4111-1111-1111-1111"],
        ["378282246310005", "3782 822463 10005"],
        ["DE89370400440532013000", "DE89 3704 0044 0532 0130 00"],
        ["(555) 010-9999", "555-010-9999", "555.010.9999", "+1 (555) 010-9999", "+1 555-010-9999", "+15550109999"],
        ["+44 20 7946 0958", "+442079460958"],
        ["1985-02-28", "28/02/1985", "28.2.1985", "02/28/1985"],
        ["0850-01-02", "2.1.0850"], ["9998-12-31", "31/12/9998"], ["1600-02-29", "29.02.1600"],
    ]
    values = [(v,) for some in alike for v in some]
    new = {r.v: r.text for r in pseudonyms.pseudonymise(spark.createDataFrame(values, "v string").selectExpr("v", "v AS text"), "k").collect()}

    def plain(text):
        if re.fullmatch(r"\d+([-/.])\d+\1\d{4}|\d{4}-\d\d-\d\d", text) and len(text) <= 10:
            for form in ("%Y-%m-%d", "%d/%m/%Y", "%d.%m.%Y", "%m/%d/%Y"):
                try:
                    return datetime.datetime.strptime(text, form).date()
                except ValueError:
                    continue
        return re.sub("[^A-Z0-9]", "", text)[-10 if text[0] in "+(5" else 0:]

    for some in alike:
        assert all(new[v] != v and len(new[v]) >= len(v) for v in some), some
        assert len({plain(new[v]) for v in some if not v.startswith("02/28")}) == 1, [(v, new[v]) for v in some]
    months_first = datetime.datetime.strptime(new["28.2.1985"], "%d.%m.%Y")
    assert new["02/28/1985"] == months_first.strftime("%m/%d/%Y")


def test_social_security_numbers_stay_issuable(spark):
    numbers = [f"{a:03d}-{g:02d}-{s:04d}" for a in (1, 665, 667, 899) for g in (1, 50, 99) for s in (1, 5000, 9999)]
    frame = spark.createDataFrame([(n, n) for n in numbers], "v string, text string")
    new = {r.v: r.text for r in pseudonyms.pseudonymise(frame, "k").collect()}
    assert len(set(new.values())) == len(numbers)
    for v, n in new.items():
        m = re.fullmatch(r"(\d{3})-(\d\d)-(\d{4})", n)
        assert n != v and 0 < int(m[1]) < 900 and m[1] != "666" and m[2] != "00" and m[3] != "0000"


def test_values_do_not_depend_on_the_parts_of_a_long_text(monkeypatch):
    draw = random.Random(3)
    texts = ["".join(draw.choice("ab cd.É#\n \u03a3 1") for _ in range(draw.choice([0, 1, 5, 80, 700]))) for _ in range(60)]
    texts += ["x" * 900, "." * 900, "ab " * 300, None]
    column = pa.array(texts, pa.string())

    def values():
        tokens._powers.clear()
        owner, element, weight, words = neardup.weighted_shingles(column)
        return [
            owner, element, weight, words.counts, words.starts, neardup.signatures(owner, element, weight, words.docs),
            neighbours.counts(column), language.bundles([t or "" for t in texts]),
            language.bundles([t or "" for t in texts], np.arange(len(texts)) % 3), quality_rules.base_features(texts),
            quality_rules.scores(column, np.arange(quality_rules.BUCKETS) / 7),
        ]

    whole = values()
    try:
        for size in (2, 7, 50):
            for module, name in ((tokens, "BLOCK"), (neardup, "DRAWN"), (neighbours, "PART"), (language, "PART"), (tokens, "PART")):
                monkeypatch.setattr(module, name, size)
            for some, every in zip(values(), whole):
                assert np.array_equal(some, every)
    finally:
        tokens._powers.clear()
    # each alone, where a short way is taken
    for i, text in enumerate(texts):
        one = pa.array([text], pa.string())
        owner, element, weight, words = neardup.weighted_shingles(one)
        assert np.array_equal(neardup.signatures(owner, element, weight, 1)[0], whole[5][i])
        assert np.array_equal(quality_rules.base_features([text])[0], whole[9][i])


LONG = """
import resource, sys
import numpy as np, pyarrow as pa
from shelfmark.llm import language, neardup, neighbours, quality_rules
what, megabytes = sys.argv[1], int(sys.argv[2])
draw = np.random.default_rng(1)
letters = [chr(c) for c in range(0x61, 0x7B)] if what != "op9" else [chr(c) for c in range(0x400, 0x482)] + [chr(c) for c in range(0x5D0, 0x5EB)] + [chr(c) for c in range(0x4E00, 0x4E00 + 163)]
words = np.array(["".join(draw.choice(letters, draw.integers(2, 9))) for _ in range(20_000)], object)
some = " ".join(words[draw.integers(0, 20_000, 200_000)]) + " "
size = len(some.encode())
text = some
while size < megabytes << 20:
    text, size = text + text[::-1], 2 * size
column = pa.array([text], pa.string())
del text, some
used = lambda: int(open("/proc/self/statm").read().split()[1]) * 4096 >> 20
before = used()
if what == "op3":
    quality_rules.base_features(column.to_pylist())
    quality_rules.scores(column, np.zeros(quality_rules.BUCKETS))
elif what == "op6":
    owner, element, weight, words = neardup.weighted_shingles(column)
    neardup.signatures(owner, element, weight, words.docs)
elif what == "op8":
    neighbours.counts(column)
else:
    language.bundles(column.to_pylist())
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024 - before, column.nbytes >> 20)
"""


@pytest.mark.parametrize("what, most", [("op3", 45), ("op6", 35), ("op8", 25), ("op9", 20)])
def test_memory_of_a_long_text(what, most):
    """Megabytes per megabyte of text, and 100 besides; op9 over 320 letters of three scripts."""
    root = Path(tokens.__file__).parents[2]
    done = subprocess.run([sys.executable, "-c", LONG, what, "40"], cwd=root, capture_output=True, text=True, check=True)
    used, size = map(int, done.stdout.split())
    assert size >= 40 and used <= 100 + most * size, (used, size)
