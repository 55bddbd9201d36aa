"""Quality rules, mixing and decontamination against DuckDB and plain versions."""

import hashlib
import math
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from nextbest.llm import decontam, entropy_mix, queries, weak_rules
from nextbest.llm.common import words
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_duckdb(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "pages", "benchmark", "conversations"):
        con.execute(f"create view {t} as select * from '{SF_SMALL}/{t}.parquet'")
    df = queries.queries()[name](spark, SF_SMALL)
    rel = con.execute(queries.oracle_sql()[name])
    cols = [c[0] for c in rel.description]
    want = sorted(repr(tuple(r[cols.index(c)] for c in df.columns)) for r in rel.fetchall())
    assert sorted(repr(tuple(r)) for r in df.collect()) == want
    assert sorted(cols) == sorted(df.columns) and want


# ------------------------------------------------------------------ quality rules

def plain_statistics(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    again = {x for x in windows if windows.count(x) > 1}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)),
            len({i + o for i, x in enumerate(windows) if x in again for o in range(3)}))


TEXTS = [None, "", " \n\t", "one", "a b c", "a b c a b c", "a a a a a", "x y\nx y\n\nx y\r\n",
         "é # 你好 <b> 😀\x0b|&", "the cat sat on the mat the cat sat", "a b c d a b c d a b c\n" * 7,
         "w" * 5000, "\x1c a\x85b c d", "A!! B!! C!! " * 40]


def test_statistics_equal_a_plain_version(spark):
    rng = random.Random(3)
    texts = TEXTS + [" ".join(rng.choice("abcd") for _ in range(n)) for n in (4, 9, 40, 400)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    got = {r[0]: tuple(r)[1:] for r in
           weak_rules.add_statistics(docs).select("doc_id", *cols).collect()}
    assert got == {i: plain_statistics(t) for i, t in enumerate(texts)}


def test_windows_whose_hashes_collide_are_told_apart(spark, monkeypatch):
    """All hashes equal, so unequal windows stand between equal ones (A B A)."""
    monkeypatch.setattr(weak_rules, "_window_hash", lambda h, i: F.lit(7).cast("long"))
    texts = [*TEXTS, "a b c x y z a b c", "a b c d a b c e a b c d " * 9]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r[0]: r[1] for r in
           weak_rules.add_statistics(docs).select("doc_id", "n_repeat_words").collect()}
    assert got == {i: plain_statistics(t)[4] for i, t in enumerate(texts)}


def test_a_text_of_over_a_million_words(spark):
    words_ = [f"{i * 2654435761 % 2**32:x}" for i in range(1_100_000)]
    text = " ".join([*words_, "p", "q", "r", "s", *words_[500:504], "p", "q", "r"])
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    r = weak_rules.add_statistics(docs).select("n_words", "n_repeat_words").first()
    assert tuple(r) == (1_100_011, 4 + 4 + 3 + 3)


def plain_model(patterns, rules):
    prior, acc = weak_rules.START_PRIOR, [weak_rules.START_ACCURACY] * len(rules)
    logit = lambda p: math.log(p / (1 - p))
    odds = lambda v: logit(prior) + sum(logit(a) * x for a, x in zip(acc, v))
    for _ in range(weak_rules.ITERATIONS):
        good = {v: 1 / (1 + math.exp(-odds(v))) for v in patterns}
        k = weak_rules.PSEUDO
        n = sum(patterns.values())
        new = []
        for j in range(len(rules)):
            votes = sum(c for v, c in patterns.items() if v[j])
            right = sum(c * (good[v] if v[j] == 1 else 1 - good[v])
                        for v, c in patterns.items() if v[j])
            new.append((right + k * weak_rules.START_ACCURACY) / (votes + k))
        prior = (sum(good[v] * c for v, c in patterns.items()) + k * weak_rules.START_PRIOR) / (n + k)
        acc = new
    return prior, acc


def test_label_model_equals_a_plain_version(spark):
    rules = weak_rules.DEFAULT_RULES[:3]
    patterns = {(-1, -1, 0): 30, (0, 0, 0): 200, (-1, 0, 0): 10, (0, 0, -1): 5, (-1, -1, -1): 4}
    df = spark.createDataFrame([(*v, c) for v, c in patterns.items()],
                               ", ".join(f"vote_{r.name} int" for r in rules) + ", n long")
    model = weak_rules.fit_label_model(df, rules)
    prior, acc = plain_model(patterns, rules)
    assert model.prior == pytest.approx(prior)
    assert list(model.accuracy.values()) == pytest.approx(acc)


def test_rules_on_odd_rows_and_clashing_columns(spark):
    rows = [(1, "Plain words that go on. " * 20, 7, "x"), (2, "BUY!! NOW!! " * 60, 8, "y"),
            (None, None, None, None), (3, "", 0, ""), (3, "", 0, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int, kept string")
    whole = weak_rules.keep_good(docs)
    assert whole.columns == docs.columns
    everything = weak_rules.weak_quality(docs)
    assert everything.columns.count("n_words") == everything.columns.count("kept") == 1
    assert {r.doc_id: r.n_words for r in everything.collect()}[1] == 100
    mapped = docs.withColumn("m", F.create_map(F.lit("k"), "n_words"))
    assert weak_rules.keep_good(mapped).columns == mapped.columns
    got = weak_rules.weak_quality(docs, keep=["doc_id"]).select("doc_id", "base_failed", "kept")
    assert {r.doc_id: r.base_failed for r in got.collect()} == {1: True, 2: True, None: True, 3: True}
    assert got.count() == 5
    assert weak_rules.keep_good(docs.limit(0)).collect() == []
    rng = random.Random(5)
    prose = " ".join(f"{rng.randrange(10**6)}" for _ in range(200))
    one = spark.createDataFrame([(1, prose, 7, "x")], docs.schema)
    assert [tuple(r) for r in weak_rules.keep_good(one).collect()] == [(1, prose, 7, "x")]


# ------------------------------------------------------------------------ mixing

def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + (
        [None] if None in sizes else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    capped, total = set(), sum(sizes.values())
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        w = sum(weight[s] for s in names if s not in capped)
        new = {s for s in names if s not in capped and rest * weight[s] / w > 3 * sizes[s]}
        if not new:
            return {s: 3 * sizes[s] if s in capped else rest * weight[s] / w for s in names}
        capped |= new


def plain_taken(rows, fill_rounds):
    """Words taken of every (hash, size), by the rule that the module's text gives, source by source."""
    sizes, by_source = {}, {}
    for doc_id, text, source in rows:
        size = len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        seen = f"{'' if doc_id is None else doc_id}\n{text or ''}"
        docs = by_source.setdefault(source, [])
        h, copies = hashlib.md5(seen.encode()).hexdigest(), sum(d[2] == seen for d in docs) + 1
        if copies > 1:
            h = hashlib.md5(f"{h}\n{copies}".encode()).hexdigest()
        docs.append((h, size, seen))
        sizes[source] = sizes.get(source, 0) + size
    tol, started = entropy_mix.TOL, []

    def prefix(part, room):
        """(how many come before the first that doesn't fit, their words)"""
        words_, n = 0, 0
        while n < len(part) and words_ + part[n][1] <= room + tol:
            words_, n = words_ + part[n][1], n + 1
        return n, words_

    for source, target in plain_targets(sizes).items():
        docs = sorted(d[:2] for d in by_source[source])
        rate = target / sizes[source] if target > 0 else 0.0
        copies = math.floor(rate + 1e-9)
        gap = max(0.0, rate * sizes[source] - copies * sizes[source])
        n, words_ = prefix(docs, gap)
        started.append((docs, copies, gap - words_ if n < len(docs) else 0.0, n))
    out, filling = [], max(s[2] for s in started) >= 1
    for docs, copies, gap, n in started:
        taken, left = {h for h, _ in docs[:n]}, docs[n:]
        at = left[0][0] if left else "g"
        left = [d for d in left if 0 < d[1] < 2 * gap] if filling else []

        def fill(part):
            nonlocal gap
            last, done = None, 0
            while done < fill_rounds:
                fits = [(z, h) for h, z in part if z <= gap + tol and (last is None or (z, h) < last)]
                if not fits:
                    return False
                last, done = max(fits), done + 1
                gap -= last[0]
                taken.add(last[1])
            return True

        more = fill(left) if left else False
        while more:
            fits = [d for d in left if d[0] > at and d[0] not in taken and d[1] <= gap + tol]
            if fits:
                n, words_ = prefix(fits, gap)
                taken |= {h for h, _ in fits[:n]}
                gap -= words_
                at = fits[n][0] if n < len(fits) else "g"
            more = fill([d for d in left if d[0] > at and d[0] not in taken])
        over = [(z, h) for h, z in left if gap + tol < z < 2 * gap - tol and h not in taken]
        if over:
            taken.add(min(over)[1])
        out += [(z, z * (copies + (h in taken))) for h, z in docs]
    return sorted(out)


MIXES = {
    "copies": [(5, "w " * 100, "a")] * 60 + [(5, "w " * 100, "b")] * 60 + [(6, "v " * 90, "b")],
    "copies and others": [(i % 40, "x " * (i % 7 * 30), "ab"[i % 2]) for i in range(300)],
    "a long one at the edge": [(i, "y " * (150 + i * 37 % 250), "a") for i in range(260)]
    + [(i, "z " * 9000, "a") for i in range(900, 904)] + [(-1, "w " * 40_000, None)],
    "many sources": [(i, "u " * (i % 11), f"s{i % 23}") for i in range(400)] + [(0, "u " * 90_000, "t")],
}


@pytest.mark.parametrize("name", MIXES)
@pytest.mark.parametrize("rounds", [16, 2])
def test_mix_equals_a_plain_version(spark, monkeypatch, name, rounds):
    """Repeated rows, fills, spans behind documents that don't fit, and many capped sources."""
    monkeypatch.setattr(entropy_mix, "FILL_ROUNDS", rounds)
    docs = spark.createDataFrame(MIXES[name], "doc_id long, text string, source string").repartition(5)
    want = plain_taken(MIXES[name], rounds)
    got = entropy_mix.mix_sources(docs).collect()
    assert sorted((r["size"], r.taken) for r in got) == want
    if rounds == 16:
        mixed = entropy_mix.apply_mix(docs.withColumn("__copy", F.lit("kept")))
        assert mixed.columns == [*docs.columns, "__copy"]
        assert sum(len(r.text.split()) for r in mixed.collect()) == sum(t for _, t in want)


def test_identical_rows_are_taken_one_by_one(spark):
    rows = [(5, "w " * 100, "a")] * 60 + [(i, "w " * 100, "b") for i in range(100, 160)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = entropy_mix.mix_sources(docs).where("doc_id = 5").collect()
    assert got[0].target == 4000 and sum(r.taken for r in got) == 4000
    assert {r.taken for r in got} == {0, 100}


def test_mix_meets_targets_caps_and_reruns(spark):
    rng = random.Random(1)
    rows = []
    for i in range(1500):
        source = rng.choice(["b", "a", None, "tiny", "é", "hot", "hot", "hot"])
        if source == "tiny" and rng.random() < 0.9:
            source = "hot"
        rows.append((i, "w " * rng.choice([0, 3, 20, 90, 400]), source, i))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    got = entropy_mix.mix_sources(docs).collect()
    by_id = {r.doc_id: r for r in got}
    assert len(got) == len(rows)
    sizes, taken = {}, {}
    for i, text, source, _ in rows:
        r = by_id[i]
        assert r["size"] == len(text.split()) and 0 <= r.taken <= 3 * r["size"]
        sizes[source] = sizes.get(source, 0) + r["size"]
        taken[source] = taken.get(source, 0) + r.taken
    for source, target in plain_targets(sizes).items():
        r = next(by_id[i] for i, _, s, _ in rows if s == source)
        assert r.source_size == sizes[source] and r.target == pytest.approx(target)
        assert abs(taken[source] - target) <= 20
    again = {r.doc_id: r.taken for r in entropy_mix.mix_sources(docs.repartition(5)).collect()}
    assert again == {r.doc_id: r.taken for r in got}
    whole = entropy_mix.apply_mix(docs)
    assert whole.columns == docs.columns
    n = whole.groupBy("source").agg(F.sum(F.size(words(F.col("text")))).alias("n")).collect()
    assert {r.source: r.n for r in n} == {s: t for s, t in taken.items() if t}


def test_mix_of_odd_tables(spark):
    schema = "doc_id long, text string, source string"
    assert entropy_mix.mix_sources(spark.createDataFrame([], schema)).collect() == []
    empty = spark.createDataFrame([(1, None, None), (2, "", "a")], schema)
    assert {(r.doc_id, r.target, r.taken) for r in entropy_mix.mix_sources(empty).collect()} == {
        (1, 0.0, 0), (2, 0.0, 0)}
    same = spark.createDataFrame([(1, "a b", "s")] * 4 + [(None, "c", None)], schema)
    got = entropy_mix.mix_sources(same).collect()
    assert len(got) == 5 and all(r.taken <= 3 * r["size"] for r in got)


def test_newton_reaches_every_ratio(spark):
    rows = [(f"s{i}", 1000, t) for i, t in enumerate([0.0, 1.0, 10.0, 999.0, 1000.0, 2999.0, 3000.0])]
    df = spark.createDataFrame(rows, f"{entropy_mix._KEY} string, source_size long, target double")
    for r in entropy_mix.solve_dual(df).collect():
        assert r.rate * 1000 == pytest.approx(r.target, rel=1e-9)


def test_a_very_long_document_at_the_threshold_is_skipped(spark):
    rng = random.Random(6)
    sizes = {i: rng.randint(150, 400) for i in range(500)}
    digest = lambda i, n: hashlib.md5(f"{i}\n{'w ' * n}".encode()).hexdigest()
    at = {i: digest(i, n) for i, n in sizes.items()}
    rest = (sum(sizes.values()) + 20_000) / 2

    def gap(i):
        return rest - sum(n for j, n in sizes.items() if at[j] < digest(i, 20_000))

    long_one = next(i for i in range(1000, 9000) if 15_000 < gap(i) < 19_000)
    rows = [(i, "w " * n, "a") for i, n in sizes.items()] + [(long_one, "w " * 20_000, "a")]
    for n, source in enumerate("bc"):
        rows += [(10_000 * (n + 1) + i, "w " * 500, source) for i in range(int(rest * 2) // 500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = [r for r in entropy_mix.mix_sources(docs).collect() if r.doc_id < 10_000]
    missing = got[0].target - sum(r.taken for r in got)
    out = [r["size"] for r in got if not r.copies]
    assert len(out) > 100 and abs(missing) <= 0.01 * got[0].target
    assert missing < min(out)
    whole = entropy_mix.apply_mix(docs).where("source = 'a'").agg(F.sum(F.size(words(F.col("text")))))
    assert whole.first()[0] == sum(r.taken for r in got)


# --------------------------------------------------------------- decontamination

def test_containment_of_odd_rows(spark):
    item = "One two, three FOUR five six seven eight nine ten eleven twelve"
    docs = spark.createDataFrame(
        [(1, "x " * 5000 + item.lower() + " y" * 5000, "a"), (2, None, None), (3, "", "b"),
         (4, "one-two three four five", "c"), (5, "one two three four six seven eight", "d"),
         (None, item, "e"), (1, item, "f"), (1, item, "f"), (6, "hi there", "g")],
        "doc_id long, text string, n_common string")
    items = spark.createDataFrame([(7, item), (8, None), (9, ""), (10, "Hi there"), (7, item)],
                                  "item_id long, text string")
    got = sorted(str((r.doc_id, r.item_id, r.containment)) for r in
                 decontam.find_contained(docs, items, block_shingles=4).collect())
    want = [(1, 7, 1.0)] * 6 + [(None, 7, 1.0)] * 2 + [(6, 10, 1.0)]
    assert got == sorted(map(str, want))
    clean = decontam.drop_contaminated(docs, items)
    assert clean.columns == docs.columns
    assert sorted(str(r.doc_id) for r in clean.collect()) == ["2", "3", "4", "5"]
    assert decontam.find_contained(docs, items.limit(0)).collect() == []
    assert decontam.find_contained(docs.limit(0), items).collect() == []


def test_containment_equals_brute_force_around_the_threshold(spark):
    rng = random.Random(2)
    vocab = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice([5, 9, 24, 60])))) for i in range(30)]
    docs = []
    for i in range(120):
        w = rng.choices(vocab, k=rng.choice([8, 100, 900]))
        piece = rng.choice(items)[1].split()
        for _ in range(rng.choice([0, 0, 1, 2])):
            piece[rng.randrange(len(piece))] = "changed"
        at = rng.randrange(len(w))
        docs.append((i, " ".join(w[:at] + piece + w[at:])))
    sh = lambda t: decontam.shingles(t.split(), 5)
    want = {(d, i): len(sh(b) & sh(a)) / len(sh(b)) for d, a in docs for i, b in items}
    want = {k: v for k, v in want.items() if v >= 0.8}
    got = {(r.doc_id, r.item_id): r.containment for r in decontam.find_contained(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == want and 10 < len(got)


def test_items_shorter_than_a_shingle_are_found_inside_longer_texts(spark):
    docs = spark.createDataFrame(
        [(1, "x " * 50 + "Hi, there" + " y" * 50), (2, "there hi"), (3, "a b c d e f"), (4, "hi there you"),
         (5, None), (6, "hith ere")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "hi there"), (2, "b c d e"), (3, "F"), (4, "a b c d e"), (5, "d f")],
                                  "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.n_common, r.n_shingles)
           for r in decontam.find_contained(docs, items).collect()}
    assert got == {(1, 1, 1, 1), (4, 1, 1, 1), (3, 2, 1, 1), (3, 3, 1, 1), (3, 4, 1, 1)}
    left = decontam.drop_contaminated(docs, items).collect()
    assert sorted(r.doc_id for r in left) == [2, 5, 6]


@pytest.mark.parametrize("kind", ["string", "decimal(9,0)", "smallint"])
def test_items_may_have_ids_of_any_type(spark, kind):
    text = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(1, f"before {text} after", 3)], "doc_id int, text string, item_id int")
    items = spark.createDataFrame([("7", text)], "item_id string, text string")
    items = items.withColumn("item_id", items.item_id.cast(kind))
    found = decontam.find_contained(docs, items).collect()
    assert [(r.doc_id, str(r.item_id), r.containment) for r in found] == [(1, "7", 1.0)]
