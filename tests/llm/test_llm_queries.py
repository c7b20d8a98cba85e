"""Registered queries against their SQL, or against brute force where SQL cannot express them."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from compare import connect, difference, spark_rows, sql_rows

from cardfile.llm import mixing, passages, simhash
from cardfile.llm.catalog import QUERIES, SQL

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").collect()


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, name):
    assert difference(spark_rows(QUERIES[name](spark, SF)), sql_rows(connect(SF), SQL[name])) == ""


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_main_text(spark):
    from html import unescape

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = {r.page_id: r for r in QUERIES["op1_html_extraction"](spark, SF).collect()}
    assert got.keys() == pages.keys()
    for key, html in pages.items():
        article = re.search(r"<article>(.*?)(</article>|\Z)", html, re.S)
        blocks = re.split(r"</?(?:p|h1)\b[^>]*>", article[1]) if article else []
        plain = [" ".join(unescape(re.sub(r"<[^>]*(>|\Z)", " " if "br" in b else "", b)).split()) for b in blocks]
        expected = "\n".join(p for p in plain if p)
        assert got[key].text == expected
        assert got[key].n_chars == len(expected)


def test_mix(spark, docs):
    rows = QUERIES["op5_source_mixing"](spark, SF).collect()
    sizes = {d.doc_id: len(WORD.findall(d.text)) for d in docs}
    assert {r.doc_id: r["size"] for r in rows} == sizes
    by_source = Counter()
    for d in docs:
        by_source[d.source] += sizes[d.doc_id]
    total, weights = sum(by_source.values()), {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(by_source))}
    targets, open_ = {}, set(by_source)
    while True:
        left = total - sum(targets.values())
        share = {s: left * weights[s] / sum(weights[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 3 * by_source[s]]
        if not over:
            break
        for s in over:
            targets[s] = 3 * by_source[s]
            open_.discard(s)
    targets |= share
    source, taken, largest = {d.doc_id: d.source for d in docs}, Counter(), Counter()
    for r in rows:
        s = source[r.doc_id]
        assert r.source_size == by_source[s]
        assert r.target == pytest.approx(targets[s])
        assert r.taken <= 3 * r["size"]
        taken[s] += r.taken
        largest[s] = max(largest[s], r["size"])
    for s in by_source:
        assert abs(taken[s] - targets[s]) <= largest[s]
    again = QUERIES["op5_source_mixing"](spark, SF).repartition(3).collect()
    assert sorted(rows) == sorted(again)


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def base_spans(text: str) -> list:
    ok = {
        "email": lambda m: True,
        "ip": lambda m: all(int(p) <= 255 for p in m.split(".")),
        "card": lambda m: 12 <= len(re.sub("[^0-9]", "", m)) <= 19 and luhn(re.sub("[^0-9]", "", m)),
        "phone": lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15,
    }
    found = [(m.start(), i, m.end(), k) for i, (k, p) in enumerate(BASE.items()) for m in re.finditer(p, text) if ok[k](m[0])]
    return [(k, s, e) for s, _, e, k in sorted(found)]


def test_personal_data(spark, docs):
    got = {r.doc_id: r for r in QUERIES["op6_pii"](spark, SF).collect()}
    for d in docs:
        spans, r = base_spans(d.text), got[d.doc_id]
        text = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for x, _, _ in spans) for k in BASE]
        assert set(text.split(",")) <= set(r.spans.split(","))


def fingerprint(text, k=3) -> int:
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(lowered)
    runs = [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [" ".join(w)] * bool(w)
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints: dict, max_bits: int) -> dict:
    keys = sorted(prints)
    root = {k: k for k in keys}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= max_bits:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: find(k) for k in keys}


def test_simhash(spark, docs):
    prints = {d.doc_id: fingerprint(d.text) for d in docs}
    root = groups(prints, 2)
    got = {(r.doc_id, r.fingerprint, r.component_id) for r in QUERIES["op7_simhash"](spark, SF).collect()}
    assert got == {(k, f"{v:016x}", root[k]) for k, v in prints.items()}


def test_links_over_two_levels_of_blocks(spark, monkeypatch):
    rng = np.random.default_rng(3)
    centres = rng.integers(-(2**63), 2**63, 60)
    flips = [int(c) ^ (1 << int(a)) ^ (1 << int(b)) for c in centres for a, b in rng.integers(0, 63, (20, 2))]
    values = sorted({int(c) for c in centres} | set(flips))
    monkeypatch.setattr(simhash, "BLOCKS_AT_ONCE", 4)
    monkeypatch.setattr(simhash, "VISITORS", 50)
    prints = spark.createDataFrame([(v,) for v in values], "fp bigint")
    found = simhash.components(simhash.links(prints, 2, block=32)).collect()
    root = {r.node: r.root for r in found}
    expected = groups({v: v & (2**64 - 1) for v in values}, 2)
    assert {v: root.get(v, v) for v in values} == expected


def test_decontamination(spark):
    plain = lambda t: " ".join(re.findall(r"[^\W_]+", t.lower()))
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: plain(r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    items = {r.item_id: plain(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id) for r in QUERIES["op10_decontamination"](spark, sf).collect()}
    assert got == {(d, i) for d, t in texts.items() for i, item in items.items() if item in t}


def test_passages(spark):
    """All texts that share 50 words in a row are named, but for runs of one word; nothing is named that is not alike."""
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    words = {k: WORD.findall(t.lower()) for k, t in texts.items()}
    at = defaultdict(set)
    for k, w in words.items():
        for i in range(len(w) - 49):
            if len(set(w[i : i + 50])) > 1:
                at[tuple(w[i : i + 50])].add(k)
    shared = {k for s in at.values() if len(s) > 1 for k in s}
    rows = QUERIES["op9_substring_dedup"](spark, sf).collect()
    assert shared <= {r.doc_id for r in rows} | {r.other_id for r in rows}
    for r in rows:
        a, b = words[r.doc_id][r.start_word : r.end_word], words[r.other_id][r.other_start : r.other_end]
        assert min(len(a), len(b)) >= 50
        assert passages.edits(a, b) <= 0.2 * max(len(a), len(b)) + 1e-9


def test_pivot_keeps_words_and_chances():
    rng = np.random.default_rng(1)
    size, due = rng.integers(1, 500, 200).astype(float), rng.random(200)
    mean = np.zeros(200)
    for _ in range(400):
        out, held = mixing.pivot(size, due, rng.random(200))
        assert size @ out == pytest.approx(size @ due)
        closed = np.delete(out, held) if held >= 0 else out
        assert np.allclose(closed, np.round(closed))
        mean += out / 400
    assert np.abs(mean - due).max() < 0.15
