"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

import itertools
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from checks.compare import rows_by_name
from shelfmark.llm import chat, notices, periods, url_rules, variants
from shelfmark.llm.lce import Extensions, cover
from shelfmark.llm.oracles import ORACLES
from shelfmark.llm.queries import QUERIES, VOCABULARY

#: Names that operators use for columns of their own.
CLASHING = {
    "score": "'x'", "kept": "'x'", "N_WORDS": "'x'", "n_tokens": "'x'", "ids_sha256": "'x'", "hit_spans": "'x'",
    "n_pii": "'x'", "class_id": "'x'", "lang_pred": "'x'", "predicted": "'x'", "held_out": "'x'", "id": "'x'",
    "start": "'x'", "verdict": "'x'", "rule": "'x'", "host": "'x'", "turns": "'x'", "formatted": "'x'", "key": "'x'",
}

LONG = " ".join(f"word{i % 977} other{i}" for i in range(30_000))
BOILER = " ".join(f"alpha{i} beta" for i in range(40))
ROWS = {
    "documents": [
        (1, None, "en"), (2, "", None), (3, "   \n ", "en"), (4, "one two", "en"), (4, "one two", "en"), (None, "no id here", "fr"),
        (5, LONG, "en"), (6, LONG, None), (7, BOILER, "en"), (8, BOILER + " gamma", "en"), (8, BOILER + " gamma", "en"),
        (9, "123 456 !!", "de"), (10, "中文 ελληνικάΣ <|endoftext|> É", "zh"), (None, None, None), (11, "one two", "en"),
    ],
    "benchmark": [(1, "one two"), (2, None), (3, ""), (None, "no id"), (1, "one two"), (4, " ".join(f"word{i} other{i}" for i in range(20)))],
    "labels": [(4, 1, 0), (4, 0, None), (5, 1, 0), (9, 0, 1), (None, 1, 1), (7, None, None), (99, 1, 0)],
    "pages": [(1, None), (2, "no scheme"), (3, "HTTP://EXAMPLE.net/en/x?a=b"), (3, "HTTP://EXAMPLE.net/en/x?a=b"), (None, "http://"), (4, "x://a?b/c#d"), (5, "http://h.example.com/de/#/fr/"), (6, "a\nb://Q.org/fr/\nx")],
    "conversations": [
        (1, 0, "user", None), (1, 1, "assistant", ""), (1, None, None, "x"), (None, 0, "user", "y"), (2, 0, "a]b[%5D", "\\ [INST [/INST] \\\\"),
        (2, 0, "assistant", "[/INST"), (2, 0, "assistant", "[/INST"), (2, 1, "assistant", LONG),
    ],
}
PER_DOCUMENT = ["op2_wavelet_tokens", "op3_quality_rules", "op5_decontamination", "op6_near_duplicates", "op7_bpe",
                "op8_quality_classifier", "op9_language_id", "op10_pseudonyms", "op11_periodic_runs", "op12_license_scan"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_odd_rows_and_clashing_columns(spark, tables, name):
    found = QUERIES[name](spark, tables(CLASHING, **ROWS)).collect()
    if name in PER_DOCUMENT:
        assert sorted(str(r.doc_id) for r in found) == sorted(str(r[0]) for r in ROWS["documents"])
    elif name == "op1_url_filters":
        assert sorted(str(r.page_id) for r in found) == sorted(str(r[0]) for r in ROWS["pages"])
    elif name == "op4_chat_format":
        assert sorted(str(r.conv_id) for r in found) == ["-1", "1", "2", "None"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, tables, name):
    found = QUERIES[name](spark, tables()).collect()
    assert len(found) == (name == "op4_chat_format")  # the quoting conversation alone


def test_urls(spark, tables):
    found = {(r.host, r.path, r.rule, r.verdict) for r in QUERIES["op1_url_filters"](spark, tables(**ROWS)).collect()}
    assert found == {
        ("", "", None, "allow"), ("example.net", "/en/x", "example.net/en/", "allow"), ("a", "", None, "allow"),
        ("h.example.com", "/de/", "example.com/de/", "block"), ("q.org", "/fr/\nx", "org/fr/", "allow"),
    }


def test_mined_rules_block_what_the_labels_show(spark):
    pages = [(i, f"http://bad{'-x' * (i % 2)}.example.org/{i}") for i in range(40)] + [
        (100 + i, f"https://good{i % 5}.example.org/{i}") for i in range(200)
    ]
    frame = spark.createDataFrame(pages, "page_id long, url string")
    labels = spark.createDataFrame([(i, i < 100) for i, _ in pages if i % 2 == 0], "page_id long, block boolean")
    rules = url_rules.mine(url_rules.labelled_baskets(frame, labels), 0.01, 0.6, 5)
    found = {r.page_id: r.verdict for r in url_rules.judge(frame, rules, []).collect()}
    assert all(found[i] == ("block" if i < 100 else "allow") for i in found)
    for row in rules.collect():
        assert row.key in row["items"] and row.confidence >= 0.6


def test_bad_tokens_anywhere_in_a_long_url_are_mined(spark):
    forms = ["http://a.example.org/x/y/{}/z", "http://a.example.org/x/y/z-{}-t.html", "http://a.example.org/?k=1&{}=2",
             "http://a.example.org/?k={}", "http://a.{}.b.example.org/", "http://p-{}-q.example.org/"]
    for i, form in enumerate(forms):
        pages = [(100 * i + k, form.format("bad" if k < 24 else f"ok{k}")) for k in range(60)]
        frame = spark.createDataFrame(pages, "page_id long, url string")
        labels = spark.createDataFrame([(n, "bad" in url) for n, url in pages if n % 2], "page_id long, block boolean")
        found = url_rules.judge(frame, url_rules.mine(url_rules.labelled_baskets(frame, labels)), [])
        assert {r.page_id for r in found.where("verdict = 'block'").collect()} == {n for n, url in pages if "bad" in url}, form


def test_four_tokens_that_only_together_tell_pages_apart(spark):
    pages = []
    for i in range(480):  # every combination of three of four tokens is good, all four are bad
        bits = 15 if i < 30 else [7, 11, 13, 14, 3, 5, 6, 9, 10, 12, 1, 2, 4, 8, 0][i % 15]
        pages.append((i, "http://h.example.org/" + "/".join(t for k, t in enumerate("pqrs") if bits >> k & 1) + f"/{i}"))
    frame = spark.createDataFrame(pages, "page_id long, url string")
    labels = spark.createDataFrame([(i, i < 30) for i, _ in pages], "page_id long, block boolean")
    rules = url_rules.mine(url_rules.labelled_baskets(frame, labels))
    found = url_rules.judge(frame, rules, [])
    assert {r.page_id for r in found.where("verdict = 'block'").collect()} == set(range(30))


@pytest.mark.parametrize("seed", range(8))
def test_verdicts_equal_those_of_all_itemsets(spark, seed):
    """Every subset of every basket counted; a page is blocked if one of its subsets is a rule."""
    rng = random.Random(seed)
    names = [f"dir={c}" for c in "abcdefg"]
    rows = []
    for _ in range(rng.randrange(40, 160)):
        items = {n for n in names if rng.random() < rng.choice((0.2, 0.5, 0.8))}
        if "dir=a" in items:
            items |= {"dir=z", "dir=y"}  # always together
        if seed % 2:
            items.add("dir=all")
        bad = rng.random() < (0.8 if {"dir=b", "dir=c"} <= items else 0.2 if "dir=d" in items else 0.05)
        rows.append((sorted(items), bad))
    confidence, least = rng.choice((0.5, 0.6, 0.9)), rng.choice((1, 2, 5))
    counts, blocked = Counter(), Counter()
    for items, bad in rows:
        subsets = [frozenset(x) for k in range(1, len(items) + 1) for x in itertools.combinations(items, k)]
        counts.update(subsets)
        blocked.update(subsets if bad else [])
    wanted = {s for s, b in blocked.items() if b >= least and b / counts[s] >= confidence and counts[s] < len(rows)}
    frame = spark.createDataFrame(rows, "items array<string>, block boolean").repartition(3)
    rules = url_rules.mine(frame, min_confidence=confidence, min_count=least).collect()
    for r in rules:
        assert r["items"] == sorted(r["items"]) and frozenset(r["items"]) in wanted and r.key in r["items"]
        assert r.confidence == pytest.approx(blocked[frozenset(r["items"])] / counts[frozenset(r["items"])])
    others = [sorted(n for n in [*names, "dir=z", "dir=y"] if rng.random() < 0.5) for _ in range(60)]  # what no label showed, too
    for have in [items for items, _ in rows] + others:
        plain = max((blocked[s] / counts[s] for s in wanted if s <= set(have)), default=None)
        fired = max((r.confidence for r in rules if all(set(m) & set(have) for m in r.members)), default=None)
        assert fired == (None if plain is None else pytest.approx(plain)), have


def test_a_large_table_asks_for_no_more_pages(spark):
    rows = spark.range(30_000).selectExpr("array('tld=org', concat('host=', if(id < 12, 'bad', string(id % 50)))) AS items", "id < 12 AS block")
    assert [(r["items"], r.confidence) for r in url_rules.mine(rows).collect()] == [(["host=bad"], 1.0)]


def test_tokens_of_odd_texts(spark, tables):
    library = Tokenizer.from_file(VOCABULARY)
    found = QUERIES["op2_wavelet_tokens"](spark, tables(**ROWS)).collect()
    wanted = sorted(
        (str(i), len(ids := [*library.encode(t or "", add_special_tokens=False).ids, 1]), zlib.crc32(np.array(ids, "<u4").tobytes()))
        for i, t, *_ in ROWS["documents"]
    )
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in found) == wanted
    ordered = sorted(found, key=lambda r: r.start)
    assert [r.start for r in ordered] == np.cumsum([0] + [r.n_tokens for r in ordered])[:-1].tolist()
    assert [r.doc_id or -1 for r in ordered] == sorted(r.doc_id or -1 for r in found)


def test_near_duplicates_of_odd_texts(spark, tables):
    found = {r.doc_id: r.class_id for r in QUERIES["op6_near_duplicates"](spark, tables(**ROWS)).collect()}
    assert found == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 5, 7: 7, 8: 7, 9: 9, 10: 10, 11: 4, None: None}


def test_languages_of_odd_texts(spark, tables):
    found = {r.doc_id: r for r in QUERIES["op9_language_id"](spark, tables(**ROWS)).collect()}
    assert {i for i, r in found.items() if r.lang_pred == "und"} >= {1, 2, 3, 9}
    assert all(found[i].score == 0 for i in (1, 2, 3, 9))
    assert {r.lang_pred for r in found.values()} <= {"und", "en", "fr", "de", "zh"}


def test_control_strings_survive(spark):
    bits = ["[INST", "[/INST]", "[INST* user]", "\\", "\\/", "</s>", " ", "x", "]", "[/INST", "\n", "\\\\[", "é"]
    rng = np.random.default_rng(5)
    rows = [
        (i, j, ["user", "assistant", "", "a[b]%5B", None][rng.integers(5)], "".join(rng.choice(bits, rng.integers(0, 9))))
        for i in range(150) for j in range(rng.integers(1, 5))
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    formatted = chat.format_chats(frame)
    back = formatted.select("conv_id", chat.parse(formatted.formatted).alias("t"), chat.under_mask(formatted.formatted, formatted.loss_runs).alias("m")).collect()
    for r in back:
        wanted = [(role or "", text) for c, _, role, text in rows if c == r.conv_id]
        assert [(t.role, t.text) for t in r.t] == wanted
        assert r.m == [text for role, text in wanted if role == "assistant" and text]
    digests = chat.read_back(formatted).collect()
    assert all(d.loss_chars == sum(len(t) for c, _, role, t in rows if c == d.conv_id and role == "assistant") for d in digests)


def test_pipeline_on_odd_and_empty_tables(spark, tables, tmp_path):
    out = corpus_pipeline.run(spark, tables(CLASHING, **ROWS)).collect()
    assert {5} <= {r.doc_id for r in out} <= {5, 7}  # one of two copies; short texts go


def test_pipeline_of_nothing(spark, tables):
    assert corpus_pipeline.run(spark, tables()).count() == 0


def test_cover_reaches_every_pair_of_residues():
    for v in (64, 256):
        members, shift = cover(v)
        a, b = np.indices((v, v))
        assert (shift >= 0).all() and np.isin((a + shift) % v, members).all() and np.isin((b + shift) % v, members).all()


def test_extensions_equal_plain_comparison():
    rng = np.random.default_rng(3)
    for kind in range(30):
        numbers = rng.integers(0, 1 + kind % 3, rng.integers(1, 700))
        if kind % 2:
            numbers = np.tile(numbers[: 1 + len(numbers) // 7], 8)
        numbers = np.append(numbers, 9)
        a, b = rng.integers(0, len(numbers), (2, 200))
        a, b = a[a != b], b[a != b]
        for x, y, got in zip(a.tolist(), b.tolist(), Extensions(numbers)(a, b).tolist()):
            same = 0
            while numbers[min(x, y) + same] == numbers[max(x, y) + same]:
                same += 1
            assert got == same


def test_runs_of_odd_texts(spark):
    block = [f"b{i}" for i in range(700)]
    texts = {
        1: None, 2: "", 3: " \n", 4: "a " * 5, 5: "a\u00a0b " * 6, 6: "x " * 200_000, 7: " ".join(block * 40),
        8: "a b a b a b a b c a a a a a a", 9: "é é é é é é", 10: "z" * (3 << 20) + " y y\ty\x0by y y",
    }
    frame = spark.createDataFrame([*texts.items(), (8, texts[8])], "doc_id long, text string")
    found = {r.doc_id: [tuple(x) for x in r.runs] for r in periods.find_runs(frame).collect()}
    assert found == {
        1: [], 2: [], 3: [], 4: [], 5: [(0, 6, 1)], 6: [(0, 200_000, 1)], 7: [(0, 28_000, 700)],
        8: [(0, 8, 2), (9, 6, 1)], 9: [(0, 6, 1)], 10: [(1, 6, 1)],
    }
    collapsed = {r.doc_id: r.collapsed for r in periods.find_runs(frame).collect()}
    assert collapsed[8] == "a b c a" and collapsed[6] == "x" and collapsed[7] == " ".join(block) and collapsed[3] == ""
    assert collapsed[10] == "z" * (3 << 20) + " y"


def test_notices_with_edits_are_found_and_clean_texts_are_not(spark):
    rng = np.random.default_rng(2)
    rows, wanted = [], {}
    for number, notice in enumerate(notices.NOTICES):
        for edits in (0, 1, notice.edits):
            text = notice.text
            for at in rng.choice(np.arange(1, len(text) - 1), edits, replace=False):
                text = text[:at] + "q" + text[at + 1 :]
            doc = len(rows)
            rows.append((doc, f"Some words, {text.upper()}. And (more) words"))
            wanted[doc] = number
    rows += [(1000, "the licence of the mill"), (1001, None), (1002, "of " * 500_000 + "RELEASED under teh MIT  License"), (1003, "emit license")]
    found = {r.doc_id: r for r in notices.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for doc, number in wanted.items():
        assert number in {h.notice for h in found[doc].hits}, rows[doc]
        assert all(h.first_word >= 2 for h in found[doc].hits if h.notice == number)
    assert not found[1000].hits and not found[1001].hits and not found[1003].hits and not found[1003].base
    assert [(h.label, h.edits, h.first_word, h.text) for h in found[1002].hits] == [("mit", 2, 500_000, "released under teh mit license")]
    assert [tuple(b) for b in found[1002].base] == [(500_003, "mit")]


def test_pivots_meet_the_prefix_of_every_near_word():
    rng = np.random.default_rng(4)
    for _ in range(300):
        word = "".join(rng.choice(list("abé"), rng.integers(6, 12)))
        at = int(rng.integers(len(word)))
        near = [word[:at] + word[at + 1 :], word[:at] + "c" + word[at:], word[:at] + "b" + word[at + 1 :]][rng.integers(3)]
        grams = {w[i : i + 2] for w in (word, near) for i in range(len(w) - 1)}
        order = {g: int(r) for g, r in zip(sorted(grams), rng.permutation(len(grams)))}
        if near == word:
            continue
        s, r = sorted((word, near), key=lambda w: variants.prefix_and_pivots(w, order)[2])
        _, pivots, _ = variants.prefix_and_pivots(s, order)
        prefix, _, _ = variants.prefix_and_pivots(r, order)
        assert len(pivots) == 2 and pivots[1] - pivots[0] >= 2
        assert any(s[: p + 2] == r[: p + 2] and p in prefix or s[p:] == r[p + len(r) - len(s) :] and p + len(r) - len(s) in prefix for p in pivots)


def test_variants_of_odd_texts(spark, tables):
    words = ["letter", "lettor", "leter", "ÉCOLIÈRE", "écolière", "×÷×÷×÷", "LETTER", "letterz", "looooong" * 3000, "looooong" * 3000 + "x", "five5"]
    counts = [40, 8, 9, 30, 5, 6, 10, 300, 5, 25, 9]
    documents = [(i, " ".join(f"{w}," for w, n in zip(words, counts) if k < n)) for i, k in enumerate(range(300))]
    documents += [(None, "letter letter"), (3, None), (4, ""), (7, "letter"), (7, "letter")]
    folder = tables(CLASHING, documents=documents)
    frame = QUERIES["op13_spelling_variants"](spark, folder)
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    result = connection.execute(ORACLES["op13_spelling_variants"])
    names = [c[0] for c in result.description]
    found = {r.word: r for r in frame.collect()}
    assert rows_by_name(frame.columns, found.values()) == rows_by_name(names, result.fetchall())
    assert found["lettor"].form == "letter" and found["lettor"].root == "letterz" and found["letterz"].form is None
