"""Document fingerprints from prefix polynomial hashes.

A text's code points c_0, c_1, ... give the prefix arrays
``sum of (c_k + 1) * base^k, k < i`` modulo two primes.  From them any span's
hash follows in a few operations, so:

* two spans are compared in constant time (``same``);
* the longest common extension of two positions, to the right or to the left,
  is found by binary search over span lengths (``common_prefix``,
  ``common_suffix``), for many pairs of positions at once;
* the arrays of a text that is put together from others' prefixes are put
  together too (``joined``), without hashing it again.

A fingerprint is the hash of the whole text under both primes and its length:
equal texts have equal fingerprints.  The likeness of two is the share of both
texts' code points that lie in spans they have in common: the longest common
prefix and suffix, and every extension of a common window.  Windows of ``WINDOW``
code points whose hash is a multiple of ``EVERY`` are compared, so a common span
shows itself by the windows in it wherever it lies in either text.

On Spark the documents are range-partitioned in the order of their ids and each
task walks its rows once, holding two documents; a task's last document meets
the next task's first one afterwards, through one row a task.  Texts are
shuffled once.

Edge cases: a null text counts as empty; an empty text's likeness to an empty
one is 1, to any other 0.  Null ids come first; rows of one id are in the order
of their texts' hashes; repeated rows stay, each next to its copy; a corpus of
one row is followed by itself; an empty table gives an empty result.  A task's
memory grows with the longest single text (about 60 bytes a code point), not
with the number of rows.  Only the id and text columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nextbest.llm.common import checkpointed, column, slices

#: Primes just below 2^31, so that products fit 64 bits, and a base for each.
MODULI = (2147483647, 2147483629)
BASES = (1000003, 998244353)
WINDOW = 32
EVERY = 16


class _Powers:
    """base^k and base^-k modulo a prime for k = 0, 1, ..., grown by doubling."""

    def __init__(self, base: int, modulus: int) -> None:
        self.modulus = modulus
        self.steps = (base, pow(base, -1, modulus))
        self.tables = [np.ones(1, dtype=np.int64), np.ones(1, dtype=np.int64)]

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.tables[0]) <= n:
            for k, (table, step) in enumerate(zip(self.tables, self.steps)):
                self.tables[k] = np.concatenate(
                    [table, table * pow(step, len(table), self.modulus) % self.modulus])
        return self.tables[0], self.tables[1]


_POWERS = [_Powers(b, m) for b, m in zip(BASES, MODULI)]


class PrefixHashes:
    """The prefix arrays of one text."""

    def __init__(self, sums: list[np.ndarray]) -> None:
        self.sums = sums
        self.n = len(sums[0]) - 1
        self._windows: tuple[np.ndarray, np.ndarray] | None = None
        self._places: tuple[np.ndarray, np.ndarray] | None = None

    @classmethod
    def of(cls, text: str) -> "PrefixHashes":
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        points = np.add(points, 1, dtype=np.int64)
        sums = []
        for powers in _POWERS:
            table, _ = powers.upto(len(points))
            out = np.zeros(len(points) + 1, dtype=np.int64)
            np.cumsum(points * table[:len(points)] % powers.modulus, out=out[1:])
            sums.append(out % powers.modulus)
        return cls(sums)

    def joined(self, mine: int, other: "PrefixHashes", its: int) -> "PrefixHashes":
        """Of this text's first ``mine`` code points followed by the other's first ``its``."""
        sums = []
        for own, more, powers in zip(self.sums, other.sums, _POWERS):
            table, _ = powers.upto(mine)
            tail = (own[mine] + more[1:its + 1] * table[mine]) % powers.modulus
            sums.append(np.concatenate([own[:mine + 1], tail]))
        return PrefixHashes(sums)

    def fingerprint(self) -> str:
        return f"{int(self.sums[0][-1]):08x}{int(self.sums[1][-1]):08x}-{self.n:x}"

    def same(self, at, other: "PrefixHashes", its, length):
        """Are the spans of ``length`` from ``at`` here and ``its`` there equal?"""
        out = True
        for own, more, powers in zip(self.sums, other.sums, _POWERS):
            table, _ = powers.upto(max(self.n, other.n))
            a = (own[at + length] - own[at]) % powers.modulus * table[its]
            b = (more[its + length] - more[its]) % powers.modulus * table[at]
            out = out & ((a - b) % powers.modulus == 0)
        return out

    def _same_one(self, at: int, other: "PrefixHashes", its: int, length: int) -> bool:
        """``same`` for one pair, in Python's numbers: far cheaper than arrays of one."""
        for own, more, powers in zip(self.sums, other.sums, _POWERS):
            table = powers.tables[0]
            a = (own.item(at + length) - own.item(at)) * table.item(its)
            b = (more.item(its + length) - more.item(its)) * table.item(at)
            if (a - b) % powers.modulus:
                return False
        return True

    def extension(self, at: int, other: "PrefixHashes", its: int, leftwards: bool = False) -> int:
        """Longest common extension of one pair of positions: doubling lengths, then bisection."""
        most = min(at, its) if leftwards else min(self.n - at, other.n - its)
        for powers in _POWERS:
            powers.upto(max(self.n, other.n))

        def holds(k: int) -> bool:
            return self._same_one(at - k, other, its - k, k) if leftwards else \
                self._same_one(at, other, its, k)

        good, step = 0, 1
        while good < most and holds(min(good + step, most)):
            good, step = min(good + step, most), 2 * step
        bad = min(good + step, most + 1)
        while bad - good > 1:
            middle = (good + bad) // 2
            if holds(middle):
                good = middle
            else:
                bad = middle
        return good

    def _search(self, holds, most: np.ndarray) -> np.ndarray:
        """The largest length up to ``most`` at which each pair still agrees."""
        low, high = np.zeros_like(most), most.copy()
        for _ in range(int(most.max(initial=0)).bit_length()):
            middle = (low + high + 1) // 2
            agree = holds(middle)
            low, high = np.where(agree, middle, low), np.where(agree, high, middle - 1)
        return low

    def common_prefix(self, at, other: "PrefixHashes", its) -> np.ndarray:
        """Longest common extensions to the right of pairs of positions."""
        at, its = np.atleast_1d(at), np.atleast_1d(its)
        return self._search(lambda k: self.same(at, other, its, k),
                            np.minimum(self.n - at, other.n - its))

    def common_suffix(self, at, other: "PrefixHashes", its) -> np.ndarray:
        """Longest common extensions to the left of pairs of (exclusive) ends."""
        at, its = np.atleast_1d(at), np.atleast_1d(its)
        return self._search(lambda k: self.same(at - k, other, its - k, k), np.minimum(at, its))

    def windows(self, first: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(start, hash) of the compared windows that start at ``first`` or later."""
        if first == 0 and self._windows is not None:
            return self._windows
        own, (_, inverse) = self.sums[0], _POWERS[0].upto(self.n)
        count, modulus = max(0, self.n - WINDOW + 1 - first), MODULI[0]
        h = (own[first + WINDOW:first + WINDOW + count] - own[first:first + count]) % modulus
        h = h * inverse[first:first + count] % modulus
        at = np.flatnonzero(h % EVERY == 0)
        found = at + first, h[at]
        if first == 0:
            self._windows = found
        return found

    def places(self) -> tuple[np.ndarray, np.ndarray]:
        """(hash, first start) of the compared windows, hashes ascending."""
        if self._places is None:
            at, h = self.windows()
            values, first = np.unique(h, return_index=True)
            self._places = values, at[first]
        return self._places

    def adopt_windows(self, whole: "PrefixHashes", shared: int) -> None:
        """The windows, given those of a text with the same first ``shared`` code points."""
        at, h = whole.windows()
        old = max(0, shared - WINDOW + 1)  # windows that start before this are the same
        more_at, more_h = self.windows(old) if old else self.windows()
        keep = at < old
        self._windows = np.concatenate([at[keep], more_at]), np.concatenate([h[keep], more_h])


def _covered(spans: list[tuple[np.ndarray, np.ndarray]]) -> int:
    """Positions in the union of (start, length) spans."""
    starts = np.concatenate([s for s, _ in spans])
    ends = starts + np.concatenate([n for _, n in spans])
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], ends[order]
    before = np.concatenate([[0], np.maximum.accumulate(ends)[:-1]])
    return int(np.maximum(0, ends - np.maximum(starts, before)).sum())


def _extensions(a: PrefixHashes, b: PrefixHashes, prefix: int, suffix: int):
    """Spans of ``a``, between its common prefix and suffix, that occur anywhere in ``b``."""
    nothing = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    at, h = a.windows()
    low, high = np.searchsorted(at, [prefix, a.n - suffix - WINDOW + 1])
    at, h = at[low:high], h[low:high]
    values, starts = b.places()
    if not len(at) or not len(values):
        return nothing
    place = np.minimum(np.searchsorted(values, h), len(values) - 1)
    hit = values[place] == h
    if not hit.any():
        return nothing
    at, its = at[hit], starts[place[hit]]
    right = a.common_prefix(at, b, its)
    true = right >= WINDOW
    at, its, right = at[true], its[true], right[true]
    left = a.common_suffix(at, b, its)
    return at - left, left + right


def likeness(a: PrefixHashes, b: PrefixHashes) -> float:
    """Share of both texts' code points that lie in common spans."""
    if a.n == b.n and (a.n == 0 or a.fingerprint() == b.fingerprint()):
        return 1.0
    prefix = a.extension(0, b, 0)
    suffix = min(a.extension(a.n, b, b.n, leftwards=True), min(a.n, b.n) - prefix)
    covered = 0
    for x, y in ((a, b), (b, a)):
        found = _extensions(x, y, prefix, suffix)
        if len(found[0]):
            ends = np.array([0, x.n - suffix]), np.array([prefix, suffix])
            covered += _covered([ends, found])
        else:
            covered += prefix + suffix
    return covered / (a.n + b.n)


# ------------------------------------------------------------------ on Spark

class _Doc:
    def __init__(self, doc_id, text: str | None) -> None:
        self.doc_id, self.text = doc_id, text or ""
        self.hashes = PrefixHashes.of(self.text)


def compared(doc: _Doc, after: _Doc) -> tuple:
    """A document's result row, given the next document."""
    n = len(doc.text)
    cut = n // 4
    taken = min(cut, len(after.text))
    edited_text = doc.text[:n - cut] + after.text[:cut]
    edited = doc.hashes.joined(n - cut, after.hashes, taken)
    edited.adopt_windows(doc.hashes, n - cut)
    return (doc.doc_id, n, hashlib.sha256(edited_text.encode("utf-8", "surrogatepass")).hexdigest(),
            doc.hashes.fingerprint(), edited.fingerprint(), likeness(doc.hashes, edited),
            likeness(doc.hashes, after.hashes))


_RESULT = [("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
           ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()),
           ("near_next", pa.float64())]
_RESULT_SQL = ("n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
               "near_edited double, near_next double")
#: Rows of a task's two ends also carry the task, the end and the text.
_ENDS = [("task", pa.int32()), ("end", pa.string()), ("text", pa.string())]
_HELD = 1000


def _walk(id_type: pa.DataType):
    schema = pa.schema([("doc_id", id_type), *_RESULT, *_ENDS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        task, last, rows = TaskContext.get().partitionId(), None, []

        def flush() -> pa.RecordBatch:
            cols = list(zip(*rows))
            rows.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

        def end(doc: _Doc, which: str) -> tuple:
            return (doc.doc_id, *[None] * len(_RESULT), task, which, doc.text)

        for batch in slices(batches, "text"):
            for d, t in zip(column(batch, "doc_id"), column(batch, "text")):
                doc = _Doc(d, t)
                rows.append(end(doc, "first") if last is None else
                            (*compared(last, doc), None, None, None))
                last = doc
                if len(rows) >= _HELD:
                    yield flush()
        if last is not None:
            rows.append(end(last, "last"))
            yield flush()

    return run


def _meet(id_type: pa.DataType):
    schema = pa.schema([("doc_id", id_type), *_RESULT])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            rows = [compared(_Doc(d, t), _Doc(None, a)) for d, t, a in zip(
                column(batch, "doc_id"), column(batch, "text"), column(batch, "after"))]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return run


def edited_and_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its id, length and fingerprint, those of the text whose last quarter
    is replaced by the beginning of the next document, and the likenesses of the two and of the
    document and the next one."""
    from pyspark.sql.pandas.types import to_arrow_type
    field = docs.schema[doc_id]
    id_type, kind = to_arrow_type(field.dataType), field.dataType.simpleString()
    # copies of one row can't be told apart, so they are dealt out by the task that read them
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
                       F.xxhash64(text).alias("h"), F.spark_partition_id().alias("part"))
    order = [F.col("doc_id").asc_nulls_first(), "h", "part"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    out = checkpointed(ordered.mapInArrow(
        _walk(id_type), f"doc_id {kind}, {_RESULT_SQL}, task int, end string, text string"))
    whole = out.where("end is null").drop("task", "end", "text")
    first = out.where("end = 'first'").select(F.col("task").alias("next"), F.col("text").alias("after"))
    last = out.where("end = 'last'").select("doc_id", "text", "task")
    # one row a task
    row = Window.orderBy("task")
    following = last.select("task", F.coalesce(
        F.lead("task").over(row), F.first("task").over(row)).alias("next"))
    meeting = last.join(following, "task").join(first, "next").select("doc_id", "text", "after")
    met = meeting.mapInArrow(_meet(id_type), f"doc_id {kind}, {_RESULT_SQL}")
    return whole.unionByName(met).withColumnRenamed("doc_id", doc_id)
