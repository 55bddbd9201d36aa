"""Spelling variants: words one edit apart, found by search schemes over bidirectional FM-indexes.

The vocabulary is counted first, then dealt into bounded shards.  A shard's
words stand in one delimited text ``#w1#w2#...#``; the index keeps the suffix
ranks of that text and of its reverse as two Burrows-Wheeler transforms, each in
a wavelet matrix.  A state is a pair of suffix-rank intervals, one in either
index, of the same pattern: extending the pattern by a symbol on one side steps
one interval back and narrows the other by the symbols that sort before it.

One edit leaves one half of a word as it is, so two searches find every near word:

* A: match ``#`` and the first half exactly, then extend over the second half
  and the closing ``#``, allowing one inserted, deleted or replaced symbol;
* B: match the second half and ``#`` exactly, then extend over the first half
  and the opening ``#`` likewise.  What A finds too is left to A.

A pattern closed by delimiters on both sides has one suffix rank, which is the
word's place in the sorted vocabulary.

Dealing: all words have at least ``min_chars`` code points, so near words that
share a first (last) half share their first ``min_chars // 2`` (last
``ceil(min_chars / 2)``) code points; words go to one shard by either.  A key of
more than ``max_shard`` words is dealt anew by whole halves; what is still too
large is cut into pieces, and every piece's queries visit every piece's index.
No task holds more than two pieces and no near word is lost.

Edge cases: null texts and texts without a long run give no word; repeated rows
count each time; a null id counts as the text '' in the hash that damages runs;
ties in a form's count go to the first word in code-point order; an empty table
gives an empty result.  Only the id and text columns are read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nextbest.llm.common import checkpointed, column, slices
from nextbest.operators.joins import join_small

MIN_CHARS = 7
MIN_COUNT = 2
DAMAGE = 31
RATIO = 10
MAX_SHARD = 20_000
#: Words whose counts a task gathers before it sends them on, and queries searched at once.
_HELD = 250_000
_QUERIES = 8_000


# ---------------------------------------------------------------- vocabulary

def _lower(text: str) -> str:
    """A-Z only: bytes.lower leaves everything beyond ASCII alone."""
    return text.lower() if text.isascii() else \
        text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


class RunCounter:
    """Counts the words of documents; a run's hash is assembled from its own and its document's.

    crc32 is affine in data and start value, so the hash of ``<id>:<run>`` is
    crc(run) ^ crc(zeros, crc(<id>:)) ^ crc(zeros), with as many zeros as the
    run has bytes: one lookup per run instead of one hash per run and document.
    """

    def __init__(self, min_chars: int = MIN_CHARS, damage: int | None = DAMAGE) -> None:
        self.find = re.compile(f"[a-zÀ-ÿ]{{{min_chars},}}").findall
        self.min_chars, self.damage = min_chars, damage
        self.known: dict[str, tuple[int, int]] = {}
        self.totals: dict[str, int] = {}

    def add(self, doc_id: str, text: str | None) -> None:
        runs = self.find(_lower(text)) if text else []
        if not runs:
            return
        known, totals, damage = self.known, self.totals, self.damage
        start, shifts = zlib.crc32(f"{doc_id}:".encode()), {}
        if len(known) > 2 * _HELD:
            known.clear()
        for run, k in Counter(runs).items():
            own = known.get(run)
            if own is None:
                raw = run.encode()
                own = known[run] = (zlib.crc32(raw), len(raw))
            shift = shifts.get(own[1])
            if shift is None:
                zeros = bytes(own[1])
                shift = shifts[own[1]] = zlib.crc32(zeros, start) ^ zlib.crc32(zeros)
            h = own[0] ^ shift
            if damage and not h % damage:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
                if len(run) < self.min_chars:
                    continue
            totals[run] = totals.get(run, 0) + k

    def take(self) -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays(
            [pa.array(list(self.totals), pa.string()), pa.array(list(self.totals.values()), pa.int64())],
            names=["word", "n"])
        self.totals.clear()
        return out


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
               min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT,
               damage: int | None = DAMAGE) -> DataFrame:
    """``(word, n)``: distinct words and their occurrences over all documents.

    ``damage``: a run whose hash it divides loses one code point (None: none does).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = RunCounter(min_chars, damage)
        for batch in slices(batches, "text"):
            for d, t in zip(column(batch, "id"), column(batch, "text")):
                counter.add(d, t)
                if len(counter.totals) >= _HELD:
                    yield counter.take()
        yield counter.take()

    rows = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"),
                       F.col(text).alias("text"))
    return (rows.mapInArrow(run, "word string, n long").groupBy("word")
            .agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))


# ------------------------------------------------------------------ the index

def suffix_ranks(text: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in sorted order, by prefix doubling."""
    n = len(text)
    rank = text.astype(np.int64)
    width = 1
    while True:
        key = rank * (int(rank.max()) + 2)
        key[:max(0, n - width)] += rank[width:] + 1
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        new = np.cumsum(np.concatenate([[0], ranked[1:] != ranked[:-1]]))
        rank = np.empty(n, dtype=np.int64)
        rank[order] = new
        if new[-1] == n - 1:
            return order
        width *= 2


class WaveletMatrix:
    """Ranks in a Burrows-Wheeler transform: one bit level after the other, high bit first."""

    def __init__(self, bwt: np.ndarray, bits: int) -> None:
        self.bits, self.ones, self.zeros = bits, [], []
        at = bwt
        for level in range(bits):
            bit = (at >> (bits - 1 - level)) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]).astype(np.int32))
            self.zeros.append(len(at) - int(bit.sum()))
            at = np.concatenate([at[bit == 0], at[bit == 1]])
        counts = np.bincount(bwt, minlength=1 << bits)
        self.first = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int32)
        nobody = np.zeros(1 << bits, dtype=np.int32)
        self.base = self._walk(np.arange(1 << bits), nobody, nobody)[0]

    def _walk(self, sym: np.ndarray, lo: np.ndarray, hi: np.ndarray):
        less = np.zeros(len(sym), dtype=np.int32)
        for level in range(self.bits):
            ones, z = self.ones[level], self.zeros[level]
            up = ((sym >> (self.bits - 1 - level)) & 1).astype(bool)
            one_lo, one_hi = ones[lo], ones[hi]
            less += np.where(up, (hi - one_hi) - (lo - one_lo), 0)
            lo, hi = np.where(up, z + one_lo, lo - one_lo), np.where(up, z + one_hi, hi - one_hi)
        return lo, hi, less

    def step(self, sym: np.ndarray, lo: np.ndarray, hi: np.ndarray):
        """Intervals one symbol further, and how many symbols of the old ones sort before it."""
        a, b, less = self._walk(sym, lo, hi)
        shift = self.first[sym] - self.base[sym]
        return a + shift, b + shift, less

    def children(self, lo: np.ndarray, hi: np.ndarray):
        """(state, symbol, lo, hi) for every symbol that occurs in each interval."""
        state, sym = np.arange(len(lo)), np.zeros(len(lo), dtype=np.int64)
        for level in range(self.bits):
            ones, z = self.ones[level], self.zeros[level]
            one_lo, one_hi = ones[lo], ones[hi]
            zero_lo, zero_hi = lo - one_lo, hi - one_hi
            down, up = zero_hi > zero_lo, one_hi > one_lo
            state = np.concatenate([state[down], state[up]])
            sym = np.concatenate([sym[down] << 1, (sym[up] << 1) | 1])
            lo = np.concatenate([zero_lo[down], (z + one_lo)[up]])
            hi = np.concatenate([zero_hi[down], (z + one_hi)[up]])
        shift = self.first[sym] - self.base[sym]
        return state, sym, lo + shift, hi + shift


class BidirectionalIndex:
    """Suffix ranks of ``#w1#w2#...#`` (words sorted) and of the reversed text."""

    def __init__(self, words: list[str], queries: list[str] = ()) -> None:
        """``words``: distinct, in code-point order; no word or query holds a NUL."""
        self.words = words
        points = _delimited(words)
        # queries may have symbols that no word has; the delimiter sorts first
        self.alphabet = np.union1d(points, _delimited(queries))
        text = np.searchsorted(self.alphabet, points)
        bits = max(1, int(len(self.alphabet) - 1).bit_length())
        self.size = len(text)
        self.left = WaveletMatrix(self._bwt(text), bits)         # steps to the left
        self.right = WaveletMatrix(self._bwt(text[::-1]), bits)  # steps to the right
        # place in the order of reversed words -> word
        self.by_reverse = np.array(sorted(range(len(words)), key=lambda i: words[i][::-1]),
                                   dtype=np.int64)

    @staticmethod
    def _bwt(text: np.ndarray) -> np.ndarray:
        return text[suffix_ranks(text) - 1]

    def exact(self, patterns: np.ndarray, begins: np.ndarray, ends: np.ndarray, leftwards: bool):
        """Synchronised intervals of ``patterns[begin:end]``, matched symbol by symbol.

        Matching leftwards starts at the last symbol, else at the first.  Returns
        (lo, lo in the other index, size); a size of 0 is no match.
        """
        matrix = self.left if leftwards else self.right
        n = len(begins)
        lo, other = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        size = np.full(n, self.size, dtype=np.int64)
        for k in range(int((ends - begins).max(initial=0))):
            at = np.flatnonzero((ends - begins > k) & (size > 0))
            sym = patterns[ends[at] - 1 - k] if leftwards else patterns[begins[at] + k]
            a, b, less = matrix.step(sym, lo[at], lo[at] + size[at])
            lo[at], size[at] = a, b - a
            other[at] += less
        return lo, other, size

    def one_error(self, matrix: WaveletMatrix, patterns: np.ndarray, begins: np.ndarray,
                  lengths: np.ndarray, lo: np.ndarray, size: np.ndarray):
        """(query, rank) of closed patterns reached by extending with exactly one error.

        Query i goes on from its interval over ``patterns[begins[i]:][:lengths[i]]``,
        whose last symbol is the delimiter, which no error touches.
        """
        q = np.flatnonzero(size > 0)
        lo, hi = lo[q], (lo + size)[q]
        erred = []
        for t in range(int(lengths.max(initial=0))):
            going = lengths[q] > t
            q, lo, hi = q[going], lo[going], hi[going]
            want = patterns[begins[q] + t]
            at, sym, c_lo, c_hi = matrix.children(lo, hi)
            same, inner = sym == want[at], sym != 0
            swap = inner & ~same & (want[at] != 0)
            drop = want != 0
            step = np.full(len(q), t, dtype=np.int64)
            erred += [(q[at][swap], step[at][swap] + 1, c_lo[swap], c_hi[swap]),   # replaced
                      (q[at][inner], step[at][inner], c_lo[inner], c_hi[inner]),   # inserted
                      (q[drop], step[drop] + 1, lo[drop], hi[drop])]               # deleted
            q, lo, hi = q[at][same], c_lo[same], c_hi[same]
        if not erred:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        q, t, lo, hi = (np.concatenate(c) for c in zip(*erred))
        found = []
        while len(q):
            done = t == lengths[q]
            found.append((q[done], lo[done]))
            q, t, lo, hi = q[~done], t[~done], lo[~done], hi[~done]
            lo, hi, _ = matrix.step(patterns[begins[q] + t], lo, hi)
            live = hi > lo
            q, t, lo, hi = q[live], t[live] + 1, lo[live], hi[live]
        q, rank = (np.concatenate(c).astype(np.int64) for c in zip(*found))
        return np.unique(np.stack([q, rank]), axis=1) if len(q) else (q, rank)

    def near(self, queries: list[str], first_half: bool):
        """(query, word) positions of words one edit away, the first (or else the last) half exact.

        Words whose first half is exact are left out of the second search.
        """
        points = _delimited(queries)
        sym = np.searchsorted(self.alphabet, points)
        cuts = np.flatnonzero(points == 0)
        begin, end = cuts[:-1], cuts[1:]           # the delimiters around each query
        half = (end - begin - 1) // 2
        if first_half:
            cut = begin + 1 + half
            _, lo, size = self.exact(sym, begin, cut, leftwards=True)
            q, rank = self.one_error(self.right, sym, cut, end - cut + 1, lo, size)
            return q, self.by_reverse[rank - 1]    # rank 0 is the delimiter that ends the text
        cut = begin + 1 + half
        _, lo, size = self.exact(sym, cut, end + 1, leftwards=False)
        q, rank = self.one_error(self.left, sym[::-1], len(sym) - cut, half + 1, lo, size)
        found = rank - 1
        keep = [not self.words[w].startswith(queries[i][:len(queries[i]) // 2])
                for i, w in zip(q.tolist(), found.tolist())]
        return q[keep], found[keep]


def _delimited(words: list[str]) -> np.ndarray:
    """Code points of ``#w1#w2#...#`` with NUL as the delimiter."""
    return np.frombuffer(f"\0{'\0'.join(words)}\0".encode("utf-32-le", "surrogatepass"), dtype="<u4")


# ------------------------------------------------------------------ the search on Spark

#: Columns of a search unit; ``role`` 0 is indexed and searched for, 1 only indexed, 2 only searched for.
_UNIT = ["kind", "shard", "i", "j"]
_FOUND = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("form_n", pa.int64()),
                    ("form", pa.string())])


def search_unit(unit: pa.Table) -> pa.Table:
    """Per query word of one unit with a near word: their number, and the most frequent one."""
    words, counts = unit.column("word").to_pylist(), unit.column("n").to_pylist()
    roles = unit.column("role").to_pylist()
    indexed = sorted({w: n for w, n, r in zip(words, counts, roles) if r != 2}.items())
    queries = sorted({w for w, r in zip(words, roles) if r != 1})
    if not indexed or not queries:
        return _FOUND.empty_table()
    names = [w for w, _ in indexed]
    n = np.array([c for _, c in indexed], dtype=np.int64)
    index = BidirectionalIndex(names, queries)
    first_half = unit.column("kind")[0].as_py() == "a"
    out = []
    for at in range(0, len(queries), _QUERIES):
        part = queries[at:at + _QUERIES]
        q, found = index.near(part, first_half)
        if not len(q):
            continue
        order = np.lexsort((found, -n[found], q))  # most frequent first, then code-point order
        q, found = q[order], found[order]
        firsts = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]]))
        best = found[firsts]
        out.append(pa.Table.from_arrays(
            [pa.array([part[i] for i in q[firsts].tolist()], pa.string()),
             pa.array(np.diff(np.append(firsts, len(q))), pa.int64()), pa.array(n[best]),
             pa.array([names[i] for i in best.tolist()], pa.string())], schema=_FOUND))
    return pa.concat_tables(out) if out else _FOUND.empty_table()


def search_units(vocab: DataFrame, words: int, min_chars: int = MIN_CHARS,
                 max_shard: int = MAX_SHARD) -> DataFrame:
    """Rows (kind, shard, i, j, role, word, n) of bounded search units, see the module's text."""
    shards = max(1, math.ceil(words / max_shard))
    length = F.length("word")
    rows = vocab.select("word", "n", F.explode(F.array(
        F.struct(F.lit("a").alias("kind"), F.substring("word", 1, min_chars // 2).alias("key")),
        F.struct(F.lit("b").alias("kind"), F.expr(f"right(word, {min_chars - min_chars // 2})")
                 .alias("key")))).alias("at")).select("word", "n", "at.*")
    # at most 2 * words / max_shard keys
    hot = rows.groupBy("kind", "key").agg(F.count(F.lit(1)).alias("size")).where(
        F.col("size") > max_shard)
    hot = checkpointed(hot)
    marked = join_small(rows, hot, ["kind", "key"], "left")
    none = F.lit(0).cast("int")
    small = marked.where("size is null").select(
        "kind", F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard"), none.alias("i"),
        none.alias("j"), none.alias("role"), "word", "n")
    # oversize keys: queries by their whole half, index words by the halves that queries of one
    # code point less, as many, or one more would have
    half = F.floor(length / 2).cast("int")
    halves = F.when(F.col("kind") == "a", F.array(
        F.floor((length - 1) / 2).cast("int"), F.floor((length + 1) / 2).cast("int"))).otherwise(
        F.array(half, half + 1))
    own = F.when(F.col("kind") == "a", half).otherwise(length - half)
    big = marked.where("size is not null").select(
        "kind", "word", "n", own.alias("own"), F.explode(halves).alias("chars"))
    big = big.select(
        "kind", "word", "n", (F.col("own") == F.col("chars")).alias("asks"),
        F.when(F.col("kind") == "a", F.expr("left(word, chars)")).otherwise(
            F.expr("right(word, chars)")).alias("key"))
    sizes = big.groupBy("kind", "key").agg(F.count(F.lit(1)).alias("size"))
    big = big.join(sizes, ["kind", "key"])
    big = big.withColumn("pieces", F.ceil(F.col("size") / max_shard).cast("int")).withColumn(
        "piece", F.pmod(F.xxhash64("word"), F.col("pieces")).cast("int"))
    # unit (i, j): the index of piece i and the queries of piece j
    others = F.sequence(F.lit(0), F.col("pieces") - 1)
    cells = F.transform(others, lambda o: F.struct(
        F.col("piece").alias("i"), o.alias("j"),
        F.when((o == F.col("piece")) & F.col("asks"), 0).otherwise(1).alias("role")))
    asked = F.when(F.col("asks"), F.transform(
        F.filter(others, lambda o: o != F.col("piece")), lambda o: F.struct(
            o.alias("i"), F.col("piece").alias("j"), F.lit(2).alias("role")))).otherwise(
        F.array().cast("array<struct<i:int,j:int,role:int>>"))
    big = big.select("kind", (F.xxhash64("key").bitwiseOR(F.lit(-1 << 63))).alias("shard"), "word",
                     "n", F.explode(F.concat(cells, asked)).alias("cell"))
    return small.unionByName(big.select("kind", "shard", "cell.*", "word", "n"))


def near_words(vocab: DataFrame, min_chars: int = MIN_CHARS, max_shard: int = MAX_SHARD,
               words: int | None = None) -> DataFrame:
    """``(word, n_near, form_n, form)`` of every word with a near word.

    ``form`` is the near word of the largest count (ties: the first in code-point order).
    """
    words = vocab.count() if words is None else words
    units = search_units(vocab, words, min_chars, max_shard)
    found = units.groupBy(*_UNIT).applyInArrow(
        search_unit, "word string, n_near long, form_n long, form string")
    best = F.min(F.struct((-F.col("form_n")).alias("rank"), "form"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", (-F.col("best.rank")).alias("form_n"), F.col("best.form").alias("form"))


def variant_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT,
                   damage: int | None = DAMAGE, ratio: int = RATIO,
                   max_shard: int = MAX_SHARD) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for every word of the vocabulary.

    A form is at least ``ratio`` times as frequent as its word, so chains of
    forms are short: doubling the reach of each step, a few joins of the words
    that have a form follow every chain to its root.
    """
    vocab = checkpointed(vocabulary(docs, doc_id, text, min_chars, min_count, damage))
    words, most = vocab.agg(F.count(F.lit(1)), F.max("n")).first()
    near = near_words(vocab, min_chars, max_shard, words)
    own = vocab.join(near, "word", "left")
    fits = F.col("form_n") >= ratio * F.col("n")
    own = checkpointed(own.select(
        "word", F.when(fits, F.col("form")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(fits, F.col("form_n")).alias("form_n")))
    links = own.where("form is not null").select("word", F.col("form").alias("root"))
    steps = math.log(max(most or 1, 1), ratio) if ratio > 1 else words
    for _ in range(math.ceil(math.log2(steps)) if steps > 1 else 0):
        # written, as each round would compute the one before twice
        links = checkpointed(links.alias("a").join(
            links.select(F.col("word").alias("root"), F.col("root").alias("next")), "root", "left")
            .select("word", F.coalesce("next", "root").alias("root")))
    return own.join(links, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
