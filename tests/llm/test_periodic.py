"""Runs of words against a plain search over all periods."""

import random
import re
import zlib
from hashlib import sha256

import numpy as np
import pytest

import __spark_entry__ as contract
from llm import periodic

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words, least=12):
    """(start, length, period) by start, then period."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, 2 * q) and j > i:
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    dropped = {i for s, m, q in runs for i in range(s + q, s + m)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    exponent = 1000 * top[1] // top[2] if runs else None
    return (doc_id, len(runs), *top, exponent, sha256(listed.encode()).hexdigest(), sha256(kept.encode()).hexdigest())


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


@pytest.mark.parametrize("text", [fibonacci(500), "a" * 300, ("ab" * 30 + "c") * 5, ("aab" * 7 + "b") * 12, "abcdefghijkl" * 2, "abc" * 4, "abc" * 3 + "ab"])
def test_structured_words(text):
    words = np.array([ord(c) for c in text])
    found = periodic.find_runs(words, np.zeros(len(words), np.int64))
    assert list(zip(*(f.tolist() for f in found))) == plain_runs(text)


def test_random_texts_side_by_side():
    rng = random.Random(3)
    for _ in range(1500):
        texts = []
        for _ in range(rng.randint(1, 3)):
            k = rng.randint(1, 3)
            words = [rng.randint(0, k) for _ in range(rng.randint(0, 60))]
            part = [rng.randint(0, k) for _ in range(rng.randint(1, 12))]
            at = rng.randint(0, len(words))
            texts.append(words[:at] + (part * 20)[: rng.randint(0, 40)] + words[at:])
        flat = np.array([w for t in texts for w in t], np.int64)
        owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        found = periodic.find_runs(flat, owner)
        want, first = [], 0
        for t in texts:
            want += [(s + first, n, q) for s, n, q in plain_runs(t)]
            first += len(t)
        assert list(zip(*(f.tolist() for f in found))) == want


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_against_plain_search(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = contract.queries()["op13_basic_factors"](spark, sf_dir).collect()
    # The plain search tries every period: texts of thousands of words are left to the next test's kind.
    plain = {r.doc_id: r.text for r in docs if len(r.text or "") < 6000}
    assert len(got) == len(docs)
    assert sorted(tuple(r) for r in got if r.doc_id in plain) == sorted(plain_row(i, t) for i, t in plain.items())
    assert sum(r.n_runs > 0 for r in got) > len(got) // 20


def test_awkward_texts(spark):
    long = " ".join(f"w{i % 900}" for i in range(40_000))
    rows = [(i, t) for i, t in enumerate([None, "", " \n\t ", "a", "a " * 11, "a " * 12, "é\x0bé\x0c" * 8, "a b " * 13, "x y " * 5 + "x", "a b c d e f g h i j k l " * 2, "\x1c " * 20])]
    rows += [(None, "a " * 30), (None, None), (5, "p q r " * 9), (5, "p q r " * 9)]
    table = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "text AS runs", "text AS collapsed", "text AS _words", "doc_id AS _a")
    got = periodic.run_report(table).collect()
    assert sorted(map(tuple, got), key=str) == sorted((plain_row(i, t) for i, t in rows), key=str)
    assert periodic.run_report(table.limit(0)).collect() == []
    found = periodic.collapse_runs(spark.createDataFrame([(1, long)], "doc_id long, text string")).first()
    assert [tuple(r) for r in found.runs] == [(0, 40_000, 900)] and found.collapsed.split() == long.split()[:900]
