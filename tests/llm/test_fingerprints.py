"""Prefix hashes: spans and extensions against slices, the query against plain Python."""

import hashlib
import random

import numpy as np
import pytest

from nextbest.llm import prefix_hash as ph
from nextbest.llm.fingerprint_query import op12_document_fingerprints
from tests.conftest import SF_SMALL


def plain_hash(text, base, modulus):
    return sum((ord(c) + 1) * pow(base, k, modulus) for k, c in enumerate(text)) % modulus


def plain_fingerprint(text):
    a, b = (plain_hash(text, base, m) for base, m in zip(ph.BASES, ph.MODULI))
    return f"{a:08x}{b:08x}-{len(text):x}"


def plain_likeness(a, b):
    """Common prefix and suffix, and every common window that the rule compares, extended."""
    if a == b:
        return 1.0
    p = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    s = next((k for k, (x, y) in enumerate(zip(a[::-1], b[::-1])) if x != y), min(len(a), len(b)))
    s = min(s, min(len(a), len(b)) - p)

    def compared(t):
        return [i for i in range(len(t) - ph.WINDOW + 1)
                if plain_hash(t[i:i + ph.WINDOW], ph.BASES[0], ph.MODULI[0]) % ph.EVERY == 0]

    total = 0
    for x, y in ((a, b), (b, a)):
        covered = set(range(p)) | set(range(len(x) - s, len(x)))
        places = {}
        for j in compared(y):
            places.setdefault(y[j:j + ph.WINDOW], j)
        for i in compared(x):
            if i < p or i + ph.WINDOW > len(x) - s or x[i:i + ph.WINDOW] not in places:
                continue
            lo, j = i, places[x[i:i + ph.WINDOW]]
            k = 0
            while i + k < len(x) and j + k < len(y) and x[i + k] == y[j + k]:
                k += 1
            while lo and j and x[lo - 1] == y[j - 1]:
                lo, j = lo - 1, j - 1
            covered |= set(range(lo, i + k))
        total += len(covered)
    return total / (len(a) + len(b))


def plain_rows(docs):
    docs = sorted(docs, key=lambda r: r[0])
    out = {}
    for k, (d, text) in enumerate(docs):
        text, after = text or "", docs[(k + 1) % len(docs)][1] or ""
        cut = len(text) // 4
        edited = text[:len(text) - cut] + after[:cut]
        out[d] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), text, edited, after)
    return out


@pytest.mark.parametrize("text", ["", "a", "\0", "\0\0", "naïve 𝔘nicode ", "abc" * 100])
def test_fingerprint_is_the_plain_polynomial(text):
    assert ph.PrefixHashes.of(text).fingerprint() == plain_fingerprint(text)


def test_spans_and_extensions_are_those_of_slices():
    rng = random.Random(2)
    a = "".join(rng.choice("ab") for _ in range(300))
    b = a[:120] + "c" + a[100:250] + "ab"
    x, y = ph.PrefixHashes.of(a), ph.PrefixHashes.of(b)
    pairs = [(rng.randrange(len(a) + 1), rng.randrange(len(b) + 1)) for _ in range(400)]
    i, j = map(np.array, zip(*pairs))
    right, left = x.common_prefix(i, y, j), x.common_suffix(i, y, j)
    for (p, q), r, l in zip(pairs, right.tolist(), left.tolist()):
        k = 0
        while p + k < len(a) and q + k < len(b) and a[p + k] == b[q + k]:
            k += 1
        assert r == k
        k = 0
        while k < min(p, q) and a[p - 1 - k] == b[q - 1 - k]:
            k += 1
        assert l == k
        assert x.extension(p, y, q) == r and x.extension(p, y, q, leftwards=True) == l


def test_joined_arrays_are_those_of_the_joined_text():
    a, b = ph.PrefixHashes.of("first é text" * 9), ph.PrefixHashes.of("another one" * 9)
    for mine, its in [(0, 0), (0, 5), (7, 0), (50, 40), (108, 99)]:
        got = a.joined(mine, b, its)
        want = ph.PrefixHashes.of(("first é text" * 9)[:mine] + ("another one" * 9)[:its])
        assert all((g == w).all() for g, w in zip(got.sums, want.sums))
        got.adopt_windows(a, mine)
        assert all((g == w).all() for g, w in zip(got.windows(), want.windows()))


def test_likeness():
    rng = random.Random(5)
    a = "".join(rng.choice("abcdefgh ") for _ in range(3000))
    other = "".join(rng.choice("ijklmnop ") for _ in range(3000))
    moved = a[1500:] + a[:1500]
    poked = "".join(c if k % 400 else "#" for k, c in enumerate(a))
    of = ph.PrefixHashes.of
    for x, y in [(a, a), (a, other), (a, moved), (a, poked), (a, a[:700]), ("", ""), ("", a),
                 ("short one", "short two"), ("x" * 100, "x" * 90), (a + other, other)]:
        got = ph.likeness(of(x), of(y))
        assert got == ph.likeness(of(y), of(x)) == pytest.approx(plain_likeness(x, y), abs=1e-12)
    assert ph.likeness(of(a), of(moved)) > 0.95 and ph.likeness(of(a), of(poked)) > 0.8
    assert ph.likeness(of(a), of(other)) < 0.05


def test_query_matches_the_plain_version(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = plain_rows([tuple(r) for r in docs])
    got = op12_document_fingerprints(spark, SF_SMALL)
    assert got.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                           "near_edited", "near_next"]
    rows = got.collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(want)
    for r in rows:
        n, sha, text, edited, after = want[r["doc_id"]]
        assert (r["n_chars"], r["edited_sha256"]) == (n, sha)
        if n < 700:
            assert r["fingerprint"] == plain_fingerprint(text)
            assert r["edited_fingerprint"] == plain_fingerprint(edited)
            assert r["near_edited"] == pytest.approx(plain_likeness(text, edited), abs=1e-12)
        if n + len(after) < 1200:
            assert r["near_next"] == pytest.approx(plain_likeness(text, after), abs=1e-12)
    by_text = {}
    for r in rows:
        by_text.setdefault(r["fingerprint"], set()).add(want[r["doc_id"]][2])
    assert all(len(texts) == 1 for texts in by_text.values())


def test_odd_rows(spark):
    """Nulls, empty texts, repeated rows and ids, text ids, clashing columns, tables of no or one row."""
    rows = [("b", "x" * 50), (None, "null id text"), ("c", None), ("d", ""), ("a", "y" * 9),
            ("a", "y" * 9), ("e", "long " * 40_000)]
    docs = spark.createDataFrame([(*r, 1, "z") for r in rows],
                                 "doc_id string, text string, task int, h string").repartition(3)
    got = sorted((r["doc_id"] or "", r["n_chars"], r["near_next"], r["edited_sha256"])
                 for r in ph.edited_and_next(docs).collect())
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert [g[:2] for g in got] == [("", 12), ("a", 9), ("a", 9), ("b", 50), ("c", 0), ("d", 0),
                                    ("e", 200_000)]
    assert got[0][3] == sha("null id yyy")[:64] or got[0][3] == sha("null id tyyy"[:9] + "yyy")
    assert [g[2] for g in got[1:3]] == [0.0, 1.0]   # the first copy is like the second
    assert got[3][3] == sha("x" * 38) and got[4][2] == 1.0
    assert got[6][3] == sha(("long " * 40_000)[:150_000] + "null id text")
    one = spark.createDataFrame([(5, "alone here")], "doc_id int, text string")
    r = ph.edited_and_next(one).first()
    assert (r["doc_id"], r["near_next"], r["edited_sha256"]) == (5, 1.0, sha("alone heal"[:8] + "al"))
    assert ph.edited_and_next(one.limit(0)).collect() == []
