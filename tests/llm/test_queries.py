"""Every query on the given small tables against a plain version of its contract."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from checks.compare import connect, rows_by_name
from shelfmark.llm import neardup, notices, quality_rules
from shelfmark.llm.oracles import ORACLES
from shelfmark.llm.queries import LISTED, QUERIES, VOCABULARY


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return [r.asDict() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def rows(spark, sf_dir, name):
    return [r.asDict() for r in QUERIES[name](spark, sf_dir).collect()]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, sf_dir, name):
    frame = QUERIES[name](spark, sf_dir)
    result = connect(sf_dir).execute(ORACLES[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(frame.columns)
    assert rows_by_name(frame.columns, frame.collect()) == rows_by_name(names, result.fetchall())


def test_every_operator_has_a_query():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES if n.startswith("op")) == list(range(1, 14))


def test_op1_host_path_and_listed_rules(spark, sf_dir):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    found = rows(spark, sf_dir, "op1_url_filters")
    assert Counter(r["page_id"] for r in found) == Counter(pages.keys())
    for r in found:
        host, path = split_url(pages[r["page_id"]])
        fits = [
            x for x in LISTED
            if (host == x.host or host.endswith("." + x.host)) and path.startswith(x.path)
        ]
        best = max(fits, key=lambda x: len(x.name), default=None)
        assert (r["host"], r["path"], r["rule"]) == (host, path, best and best.name)
        assert r["verdict"] == (best.verdict if best else "block" if r["mined_rule"] else "allow")


def split_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
    return re.sub("[A-Z]+", lambda m: m[0].lower(), host), path


def test_op2_files_give_the_library_ids(spark, sf_dir, documents, library):
    found = {r["doc_id"]: r for r in rows(spark, sf_dir, "op2_wavelet_tokens")}
    start = 0
    for d in sorted(documents, key=lambda d: d["doc_id"]):
        ids = [*library.encode(d["text"] or "", add_special_tokens=False).ids, 1]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert found[d["doc_id"]] == {"doc_id": d["doc_id"], "start": start, "n_tokens": len(ids), "ids_crc32": crc}
        start += len(ids)


def test_op3_features_and_ratio(spark, sf_dir, documents):
    found = {r["doc_id"]: r for r in rows(spark, sf_dir, "op3_quality_rules")}
    trusted = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").collect()}

    def tokens(text):
        return re.findall(rb"[0-9a-z\x80-\xff]+|[!-~]+?(?=[0-9a-z\x80-\xff\x00- \x7f]|$)", text.encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))))

    def grams(text):
        column = pa.array([text], pa.string())
        owner, bucket, _ = quality_rules._buckets(column)
        return bucket.tolist()

    everything, target = Counter(), Counter()
    for d in documents:
        assert len(grams(d["text"])) == max(0, 2 * len(tokens(d["text"])) - 1)
        everything.update(grams(d["text"]))
        if d["doc_id"] in trusted:
            target.update(grams(d["text"]))
    share = target.total() / everything.total()
    k = quality_rules.SMOOTHING
    for d in documents:
        r, text = found[d["doc_id"]], d["text"] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = Counter(zip(words, words[1:], words[2:]))
        again = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
        lines = Counter(x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x))
        base = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), lines.total() - len(lines), len(again))
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == base
        failed = base[0] < 50 or 100 * base[4] > 50 * base[0]
        score = np.mean([np.log((target[g] + k) / (everything[g] * share + k)) for g in grams(text)] or [0])
        assert r["base_failed"] == failed
        assert r["score"] == pytest.approx(score, abs=1e-9)
        assert r["kept"] == (not failed and r["score"] >= quality_rules.THRESHOLD)


def test_op3_keeps_the_good_and_drops_the_bad(spark, sf_dir):
    found = {r["doc_id"]: r for r in rows(spark, sf_dir, "op3_quality_rules") if not r["base_failed"]}
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    good = [found[r.doc_id]["kept"] for r in labels if r.quality == 1 and r.doc_id in found]
    bad = [found[r.doc_id]["kept"] for r in labels if r.quality == 0 and r.doc_id in found]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.1


def test_op6_classes_are_the_components_of_all_similar_pairs(spark, sf_dir, documents):
    found = {r["doc_id"]: r["class_id"] for r in rows(spark, sf_dir, "op6_near_duplicates")}
    sets, holders = {}, defaultdict(list)
    for d in documents:
        _, element, weight, _ = neardup.weighted_shingles(pa.array([d["text"]], pa.string()))
        sets[d["doc_id"]] = (element, weight)
        for e in element.tolist():
            holders[e].append(d["doc_id"])
    root = {d: d for d in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in {(a, b) for h in holders.values() for i, a in enumerate(h) for b in h[i + 1 :]}:
        if slow_similarity(sets[a], sets[b]) >= 0.8 - 1e-9:
            x, y = top(a), top(b)
            root[max(x, y)] = min(x, y)
    assert found == {d: top(d) for d in sets}


def slow_similarity(a, b):
    x, y = (dict(zip(s[0].tolist(), s[1].tolist())) for s in (a, b))
    shared = x.keys() & y.keys()
    if 2 * len(shared) < 0.5 * max(len(x), len(y)):
        return 0.0
    every = sorted(x.keys() | y.keys())
    left, right = (np.array([s.get(e, 0.0) for e in every]) for s in (x, y))
    return sum(1 / np.maximum(left / x[e], right / y[e]).sum() for e in shared)


def test_op7_equals_the_library(spark, sf_dir, documents, library):
    found = {r["doc_id"]: r for r in rows(spark, sf_dir, "op7_bpe")}
    for d in documents:
        ids = library.encode(d["text"] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        r = found[d["doc_id"]]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_op8_ranks_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    found = {r["doc_id"]: r for r in rows(spark, sf_dir, "op8_quality_classifier")}
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in found.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in found.values())
    labels = [r for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect() if found[r.doc_id]["held_out"]]
    good = [found[r.doc_id]["score"] for r in labels if r.quality == 1]
    bad = [found[r.doc_id]["score"] for r in labels if r.quality == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.95


def test_op9_knows_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    found = {r["doc_id"]: r for r in rows(spark, sf_dir, "op9_language_id")}
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 3 == 1) for d, r in found.items())
    assert all(0 <= r["score"] <= 1 for r in found.values())
    right = [found[d.doc_id]["lang_pred"] == d.lang for d in documents if found[d.doc_id]["held_out"] and len(d.text) > 40]
    assert np.mean(right) > 0.99


def test_op10_leaves_no_value_and_keeps_the_rest(spark):
    sf_dir = "/root/testdata/sf0.01"
    before = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    after = {r["doc_id"]: r for r in rows(spark, sf_dir, "op10_pseudonyms")}
    value = re.compile(r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+|\+1 \(\d{3}\) \d{3}-\d{4}|(?<!\w)\d{16}(?!\w)|(?<![\w.])\d+(?:\.\d+){3}(?![\w])")
    seen = {}
    for d, text in before.items():
        old, new = value.findall(text), value.findall(after[d]["text"])
        assert len(old) == len(new)
        # a number that fails the check digit is no card and stays
        assert all(a == b for a, b in zip(old, new) if a.isdigit() and not luhn(a))
        valid = [(a, b) for a, b in zip(old, new) if not a.isdigit() or luhn(a)]
        old, new = [a for a, _ in valid], [b for _, b in valid]
        assert len(old) == after[d]["n_pii"]
        assert value.split(text) == value.split(after[d]["text"])
        for a, b in zip(old, new):
            assert a != b and a not in after[d]["text"]
            assert seen.setdefault(a, b) == b
            if "." not in a or "@" in a:
                assert re.sub("[0-9]", "9", a).rpartition("@")[2] == re.sub("[0-9]", "9", b).rpartition("@")[2]
    assert len(set(seen.values())) == len(seen) > 50


def luhn(number):
    digits = [int(c) for c in reversed(number)]
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(digits)) % 10 == 0


def test_op11_runs_and_texts_equal_brute_force(spark, sf_dir, documents):
    found = {r["doc_id"]: r for r in rows(spark, sf_dir, "op11_periodic_runs")}
    for d in documents:
        words = [w.decode() for w in (d["text"] or "").encode().split()]
        n, h = len(words), zlib.crc32(str(d["doc_id"]).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = plain_runs(words)
        gone = {i for s, length, q in runs for i in range(s + q, s + length)}
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
        assert found[d["doc_id"]] == {
            "doc_id": d["doc_id"], "n_runs": len(runs), "start": best[0], "length": best[1], "period": best[2],
            "exponent_milli": best[0] if best[0] is None else 1000 * best[1] // best[2],
            "runs_sha256": sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
            "collapsed_sha256": sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
        }


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_runs(words):
    """Runs by start, then period: every period compared from end to end."""
    out, n = {}, len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                out.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, length, q) for (s, length), q in out.items()), key=lambda r: (r[0], r[2]))


def test_op12_equals_a_search_without_seeds(spark, sf_dir, documents):
    found = {r["doc_id"]: r for r in rows(spark, sf_dir, "op12_license_scan")}
    for d in documents:
        text = re.sub("[A-Z]+", lambda m: m[0].lower(), d["text"] or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
        places = [
            (i, label) for i in range(len(words)) for phrase, label in notices.PHRASES.items()
            if words[i : i + len(phrase.split())] == phrase.split()
        ]
        least = [(x, least_edits(x.text, " ".join(words))) for x in notices.NOTICES] if re.search("licen|permission|public|source", text) else []
        near = [(x, e) for x, e in least if e <= x.edits]
        r = found[d["doc_id"]]
        assert (r["n_words"], r["n_base"]) == (len(words), len(places))
        assert (r["first_word"], r["last_word"]) == (min(places)[0] if places else None, max(places)[0] if places else None)
        assert r["base_labels"] == ",".join(sorted({label for _, label in places}))
        assert r["labels"] == ",".join(sorted({label for _, label in places} | {x.label for x, _ in near}))
        assert r["score"] == pytest.approx(1 if places else max((1 - e / len(x.text) for x, e in near), default=0))


def least_edits(pattern, text):
    """Least edits between `pattern` and whole words of `text`, one word start after the other."""
    best, limit = len(pattern), len(pattern) // 10
    for start in (m.start() for m in re.finditer(r"(?<![^ ])", text)):
        row = list(range(len(pattern) + 1))
        for j, c in enumerate(text[start : start + len(pattern) + limit + 1]):
            if c == " ":
                best = min(best, row[-1])
            row = edit_row(row, pattern, c, j)
            if min(row) > limit:
                break
        else:
            if start + len(pattern) + limit + 1 >= len(text):
                best = min(best, row[-1])
    return best


def edit_row(row, pattern, c, j):
    out = [j + 1]
    for i, p in enumerate(pattern):
        out.append(min(row[i] + (p != c), row[i + 1] + 1, out[-1] + 1))
    return out
