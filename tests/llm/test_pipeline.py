"""All rows of the pipeline against a plain version of its stages."""

import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from shelfmark.llm import decontaminate, neardup, pseudonyms, quality_rules
from shelfmark.llm.queries import PSEUDONYM_KEY, VOCABULARY

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def rows_of(spark, sf_dir, table):
    return [r.asDict() for r in spark.read.parquet(f"{sf_dir}/{table}.parquet").collect()]


def plain_quality(documents, labels):
    """Documents that pass the base rule and reach the ratio's threshold."""
    trusted = {r["doc_id"] for r in labels if r["quality"] == 1}

    def grams(text):
        return quality_rules._buckets(pa.array([text], pa.string()))[1].tolist()

    everything, target = Counter(), Counter()
    for d in documents:
        everything.update(grams(d["text"]))
        if d["doc_id"] in trusted:
            target.update(grams(d["text"]))
    share, k = target.total() / everything.total(), quality_rules.SMOOTHING
    kept = []
    for d in documents:
        words = re.findall(r"[^\x20\x09-\x0D]+", d["text"] or "")
        windows = Counter(zip(words, words[1:], words[2:]))
        again = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
        score = np.mean([np.log((target[g] + k) / (everything[g] * share + k)) for g in grams(d["text"])] or [0])
        if len(words) >= 50 and 100 * len(again) <= 50 * len(words) and score >= quality_rules.THRESHOLD:
            kept.append(d)
    return kept


def plain_duplicates(documents):
    """The least id of each group that links of similarity 0.8 or more join, from all pairs."""
    sets = {}
    for d in documents:
        _, element, weight, _ = neardup.weighted_shingles(pa.array([d["text"]], pa.string()))
        sets[d["doc_id"]] = dict(zip(element.tolist(), weight.tolist()))
    root = {d: d for d in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            shared = sets[a].keys() & sets[b].keys()
            if len(shared) * 2 < 0.5 * max(len(sets[a]), len(sets[b])):
                continue
            every = sorted(sets[a].keys() | sets[b].keys())
            x, y = (np.array([s.get(e, 0.0) for e in every]) for s in (sets[a], sets[b]))
            if sum(1 / np.maximum(x / sets[a][e], y / sets[b][e]).sum() for e in shared) >= 0.8 - 1e-9:
                low, high = sorted((top(a), top(b)))
                root[high] = low
    return [d for d in documents if top(d["doc_id"]) == d["doc_id"]]


def fold(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text)


def plain_clean(documents, items):
    """Benchmark windows cut out until there are none; documents that are mostly windows go."""
    windows = set()
    for item in items:
        words = WORD.findall(fold(item["text"] or ""))
        windows |= {tuple(words[i : i + 10]) for i in range(max(1, len(words) - 9))} if words else set()
    sizes = {len(w) for w in windows}
    out = []
    for d in documents:
        text, total, cut = d["text"], None, 0
        while text:
            places = [m.span() for m in WORD.finditer(fold(text))]
            words = WORD.findall(fold(text))
            total = len(words) if total is None else total
            hit = {j for i in range(len(words)) for n in sizes if tuple(words[i : i + n]) in windows for j in range(i, i + n)}
            if not hit:
                break
            cut += len(hit)
            kept, at = [], 0
            for first in sorted(i for i in hit if i - 1 not in hit):
                last = first
                while last + 1 in hit:
                    last += 1
                kept.append(text[at : places[first][0]].rstrip(" \t\n\x0b\x0c\r"))
                at = places[last][1]
            text = "\n".join([*kept, text[at:].lstrip(" \t\n\x0b\x0c\r")])
        if cut <= decontaminate.MAX_COVERAGE * (total or 0):
            out.append(d | {"text": text})
    return out


@pytest.mark.parametrize("block_words", [decontaminate.BLOCK_WORDS, 300])
def test_all_rows_equal_a_plain_version(spark, sf_dir, monkeypatch, block_words):
    documents, items, labels = (rows_of(spark, sf_dir, t) for t in ("documents", "benchmark", "labels"))
    good = plain_quality(documents, labels)
    single = plain_duplicates(good)
    clean = plain_clean(single, items)
    assert len(documents) > len(good) > len(single) >= len(clean) and any(a["text"] != b["text"] for a, b in zip(single, clean))
    frame = spark.createDataFrame([(d["doc_id"], d["text"]) for d in clean], "doc_id long, text string")
    # one document at a time goes through the operator for personal data, so no other document's values help
    hidden = {r.doc_id: r.text for r in pseudonyms.pseudonymise(frame.repartition(len(clean)), PSEUDONYM_KEY).collect()}
    assert any(hidden[d["doc_id"]] != d["text"] for d in clean)

    library = Tokenizer.from_file(VOCABULARY)
    library.no_truncation()
    library.no_padding()
    wanted = {}
    for d in clean:
        ids = library.encode(hidden[d["doc_id"]], add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), text)]
        wanted[d["doc_id"]] = (d["lang"], d["source"], ids, len(ids), *digests)

    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block_words)
    found = corpus_pipeline.run(spark, sf_dir)
    columns = ["doc_id", "lang", "source", "token_ids", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(found.columns) == sorted(columns)
    rows = found.select(*columns).collect()
    assert len(rows) == len(wanted) and {r[0]: tuple(r[1:]) for r in rows} == wanted
