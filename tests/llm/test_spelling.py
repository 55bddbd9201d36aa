"""Spelling variants: the index against brute force, dealing, and the query on small tables."""

import random
import re
import zlib
from collections import Counter

import pytest

from nextbest.llm import spelling_fm as fm
from nextbest.llm.spelling_query import op11_spelling_variants
from tests.conftest import SF_SMALL


def edits(word, alphabet):
    out = set()
    for i in range(len(word) + 1):
        out |= {word[:i] + a + word[i:] for a in alphabet}
        if i < len(word):
            out.add(word[:i] + word[i + 1:])
            out |= {word[:i] + a + word[i + 1:] for a in alphabet}
    return out - {word}


def plain_near(words):
    alphabet = set("".join(words))
    return {w: edits(w, alphabet) & set(words) for w in words}


def plain_vocabulary(rows, min_count=2):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            if len(run) >= 7:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= min_count}


def plain_groups(vocab):
    near, forms = plain_near(vocab), {}
    for w in vocab:
        best = min(near[w], key=lambda v: (-vocab[v], v), default=None)
        forms[w] = best if best is not None and vocab[best] >= 10 * vocab[w] else None
    out = set()
    for w, n in vocab.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.add((w, forms[w], root, n, len(near[w]), vocab.get(forms[w])))
    return out


def made_up(alphabet, size, seed=3):
    rng, words = random.Random(seed), set()
    while len(words) < size:
        w = "".join(rng.choice(alphabet) for _ in range(rng.randint(7, 12)))
        words.add(w)
        words |= {x for x in rng.sample(sorted(edits(w, alphabet)), 3) if len(x) >= 7}
    return sorted(words)


@pytest.mark.parametrize("alphabet, size", [("ab", 120), ("abcdé", 300),
                                            ("abcdefghijklmnopqrstuvwxyzàÿ", 500)])
def test_searches_find_every_near_word_once(alphabet, size):
    words = made_up(alphabet, size)
    index, found = fm.BidirectionalIndex(words), {w: [] for w in words}
    for first_half in (True, False):
        for q, w in zip(*(x.tolist() for x in index.near(words, first_half))):
            found[words[q]].append(words[w])
    assert all(len(set(f)) == len(f) for f in found.values())
    assert {w: set(f) for w, f in found.items()} == plain_near(words)


def test_queries_may_have_symbols_that_the_index_lacks():
    index = fm.BidirectionalIndex(["abcdefg"], ["zbcdefg", "abcdefz", "zbcdefz", "qqqqqqq"])
    asked = ["abcdefz", "qqqqqqq", "zbcdefg", "zbcdefz"]
    assert [x.tolist() for x in index.near(asked, True)] == [[0], [0]]
    assert [x.tolist() for x in index.near(asked, False)] == [[2], [0]]


def test_suffix_ranks_are_those_of_sorted_suffixes():
    text = fm._delimited(["abab", "b", "aaaa"])
    assert fm.suffix_ranks(text).tolist() == sorted(
        range(len(text)), key=lambda i: text[i:].tolist())


def test_run_hash_is_that_of_id_and_run():
    rows = [(7, "Straßenbahn Straßenbahn Élancourt xxabcdefg"), (-1, "plain words, notably longer")]
    counter = fm.RunCounter()
    for d in range(200):
        for _, text in rows:
            counter.add(str(d), text)
    assert counter.totals == plain_vocabulary([(d, t) for d in range(200) for _, t in rows], 1)


@pytest.mark.parametrize("max_shard", [20_000, 40, 5])
def test_shards_and_pieces_lose_nothing(spark, max_shard):
    """40 deals hot keys by whole halves; 5 also cuts them into pieces."""
    words = sorted(made_up("ab", 60) + ["prefix" + w for w in made_up("abc", 60, seed=4)])
    rng = random.Random(1)
    vocab = {w: rng.choice([2, 3, 40, 500]) for w in words}
    df = spark.createDataFrame(list(vocab.items()), "word string, n long")
    got = {r["word"]: (r["n_near"], r["form_n"], r["form"])
           for r in fm.near_words(df, max_shard=max_shard).collect()}
    want = {}
    for w, near in plain_near(words).items():
        if near:
            best = min(near, key=lambda v: (-vocab[v], v))
            want[w] = (len(near), vocab[best], best)
    assert got == want


def test_query_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = plain_groups(plain_vocabulary([tuple(r) for r in docs]))
    got = op11_spelling_variants(spark, SF_SMALL)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want


def test_chains_end_at_their_root(spark):
    counts = {"abcdefg": 2, "abcdefgh": 20, "abcdefghi": 300, "abcdefghij": 3000, "zzzzzzzz": 5}
    rows = [(None, " ".join([w] * n)) for w, n in counts.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["word"]: (r["form"], r["root"]) for r in fm.variant_groups(docs, damage=None).collect()}
    assert got == {"abcdefg": ("abcdefgh", "abcdefghij"), "abcdefgh": ("abcdefghi", "abcdefghij"),
                   "abcdefghi": ("abcdefghij", "abcdefghij"), "abcdefghij": (None, "abcdefghij"),
                   "zzzzzzzz": (None, "zzzzzzzz")}


def test_odd_rows(spark):
    """Nulls, empty and very long runs, ties, repeated rows, clashing columns, an empty table."""
    long_run = "ab" * 3000
    rows = [(1, None), (2, ""), (None, "variantx variantx"), (None, "variantx variantx"),
            (3, "varianty " * 4), (4, f"{long_run} {long_run}"), (5, f"{long_run}c " * 2)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows],
                                 "doc_id long, text string, word string, n int")
    want = plain_vocabulary(rows)
    got = {r["word"]: r for r in fm.variant_groups(docs).collect()}
    assert {w: r["n"] for w, r in got.items()} == want
    assert got["variantx"]["n_near"] == 1 and got["variantx"]["form"] is None
    assert fm.variant_groups(docs.limit(0)).collect() == []
