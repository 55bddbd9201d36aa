"""Fingerprints, BK-trees, shard units and components against plain versions."""

import random

import pytest
import xxhash

from nextbest.llm import simhash_bktree as sh
from nextbest.llm.components import UnionFind, connected_components
from nextbest.llm.simhash_query import op3_simhash_dedup
from tests.conftest import SF_SMALL


def plain_fingerprint(text):
    words, word = [], ""
    for ch in (text or "") + " ":
        if ch in " \t\n\x0b\x0c\r":
            if word:
                words.append(word)
            word = ""
        else:
            word += ch.lower() if "A" <= ch <= "Z" else ch
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    out = 0
    for b in range(64):
        ones = sum(xxhash.xxh64(s.encode(), seed=42).intdigest() >> b & 1 for s in shingles)
        out |= (2 * ones > len(shingles)) << b
    return out


def plain_components(fps):
    sets = UnionFind(len(fps))
    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 3:
                sets.union(a, b)
    return [sets.find(i) for i in range(len(fps))]


@pytest.mark.parametrize("text", [None, "", " \n", "One", "one TWO", "É a b c", "a b c " * 50,
                                  "x y z\x1c1 2 3"])
def test_fingerprint_matches_the_plain_version(text):
    assert sh.fingerprint(text) == plain_fingerprint(text)


def test_bk_tree_search_equals_a_scan():
    rng = random.Random(1)
    base = [rng.getrandbits(64) for _ in range(20)]
    values = [b ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64))
              for b in base for _ in range(15)]
    tree = sh.BKTree()
    for v in values:
        tree.insert(v)
    for q in base + values[:30]:
        assert sorted(tree.search(q, 3)) == [i for i, v in enumerate(values)
                                             if (v ^ q).bit_count() <= 3]


@pytest.mark.parametrize("max_shard", [4, 2000])
def test_groups_are_the_same_however_small_the_shards(spark, monkeypatch, max_shard):
    rng = random.Random(2)
    fps = [rng.getrandbits(64) for _ in range(30)]
    for _ in range(150):  # chains and dense balls, in few shards
        fps.append(rng.choice(fps) ^ (1 << rng.randrange(48)) ^ (1 << rng.randrange(48)))
    fps += fps[:20]
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    rows = [(i, s) for i, s in enumerate(signed)]
    monkeypatch.setattr(sh, "add_fingerprints",
                        lambda *a: spark.createDataFrame(rows, "doc_id long, fp long"))
    docs = spark.createDataFrame([], "doc_id long, text string")
    got = {r.doc_id: r.component_id
           for r in sh.near_duplicates(docs, max_shard=max_shard).collect()}
    assert [got[i] for i in range(len(fps))] == plain_components(fps)


def test_odd_rows(spark):
    rows = [(5, None, "x"), (3, "", "y"), (None, "a b c d", None), (9, "a b c d", ""),
            (9, "a b c d", ""), (4, "w " * 30000, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = sorted(map(str, (tuple(r) for r in
                           sh.near_duplicates(docs).select("doc_id", "component_id").collect())))
    assert got == ["(3, 3)", "(4, 4)", "(5, 3)", "(9, 9)", "(9, 9)", "(None, 9)"]
    empty = sh.near_duplicates(docs.limit(0))
    assert empty.count() == 0 and "component_id" in empty.columns


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)],
                                  "src long, dst long")
    got = {r.node: r.root for r in connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").orderBy("doc_id").collect()
    fps = [plain_fingerprint(r.text) for r in rows]
    roots = plain_components(fps)
    want = {r.doc_id: (f"{f:016x}", rows[c].doc_id) for r, f, c in zip(rows, fps, roots)}
    got = {r.doc_id: (r.fingerprint, r.component_id)
           for r in op3_simhash_dedup(spark, SF_SMALL).collect()}
    assert got == want


def test_one_of_each_keeps_any_columns(spark):
    """Columns named like the operator's own, and maps, come back as they were."""
    rows = [(1, "a b c d e f", 5), (2, "a b c d e f", 6), (2, "a b c d e f", 6), (3, "other words here now", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __row int").selectExpr(
        "*", "map('k', __row) as fp", "__row as __id")
    kept = sh.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r["__row"], r.fp["k"]) for r in kept.collect()) == [(1, 5, 5), (3, 7, 7)]
