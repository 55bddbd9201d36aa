"""SimHash near-duplicates, linked through BK-trees.

1. Every text gets a 64-bit fingerprint from the XXH64 hashes of its word
   shingles, repeats included.  Texts with equal fingerprints collapse to one
   row before anything else, so a group of copies is one fingerprint.
2. A BK-tree keys children by their integer Hamming distance to the parent; a
   search of radius r follows only edges within r of the distance at a node.
   One tree over a whole corpus can neither be broadcast nor pruned well (random
   fingerprints all lie about 32 bits apart), so fingerprints are dealt into
   shard trees: two fingerprints at most r bits apart agree in at least one of
   r + 1 bit blocks, so each is sent to one shard for each of its blocks.
3. A shard over ``max_shard`` fingerprints is dealt again by r + 1 blocks of the
   bits that its key doesn't fix.  What is still too large is cut into pieces:
   each piece's tree is sent to every later piece of the shard, whose members
   search it.  No task ever holds more than two pieces, and no link is lost.
4. A task returns a spanning forest of the links it finds, never all pairs;
   connected components of those edges give the groups.

Edge cases: null and empty texts (no words) have fingerprint zero and link like
any other; a text of fewer words than a shingle hashes the whole sequence;
repeated rows share a component; null ids are ignored when the smallest id of a
component is sought (component_id is null when it has no other); an empty table
gives an empty result.  Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nextbest.llm.common import WORD, checkpointed, column, py_lower_ascii, slices
from nextbest.llm.components import UnionFind, connected_components

BITS = 64
SEED = 42
#: Shingles whose bits are summed at once; bounds memory on very long texts.
_CHUNK = 1 << 16


def fingerprint(text: str | None, shingle_words: int = 3) -> int:
    """A bit is 1 if it is set in more than half of the shingle hashes."""
    found = WORD.findall(py_lower_ascii(text)) if text else []
    if not found:
        return 0
    if len(found) < shingle_words:
        shingles = [" ".join(found)]
    else:
        shingles = list(map(" ".join, zip(*(found[i:] for i in range(shingle_words)))))
    digest, counts = xxhash.xxh64_intdigest, np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(shingles), _CHUNK):
        part = shingles[at:at + _CHUNK]
        h = np.fromiter((digest(s.encode("utf-8", "surrogatepass"), SEED) for s in part),
                        dtype="<u8", count=len(part))
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(shingles), bitorder="little").tobytes(),
                          "little")


def add_fingerprints(docs: DataFrame, text: str = "text", shingle_words: int = 3,
                     keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``fp``, the fingerprint as a signed long."""
    schema = docs.select(*keep).schema.add("fp", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            fps = np.array([fingerprint(t, shingle_words) for t in column(batch, text)],
                           dtype=np.uint64).view(np.int64)
            cols = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(fps)], names=[*keep, "fp"])

    return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(run, schema)


class BKTree:
    """Children of a node are keyed by their Hamming distance to it."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def insert(self, value: int) -> None:
        self.values.append(value)
        self.children.append({})
        new = len(self.values) - 1
        at = 0
        while at != new:
            d = (value ^ self.values[at]).bit_count()
            at = self.children[at].setdefault(d, new)

    def search(self, value: int, radius: int) -> list[int]:
        """Positions of all values within ``radius``."""
        found, stack = [], [0] if self.values else []
        values, children = self.values, self.children
        while stack:
            at = stack.pop()
            d = (value ^ values[at]).bit_count()
            if d <= radius:
                found.append(at)
            kids = children[at]
            if kids:
                for k in range(max(0, d - radius), d + radius + 1):
                    nxt = kids.get(k)
                    if nxt is not None:
                        stack.append(nxt)
        return found


#: Rows of a search unit: ``role`` 0 is in the tree and searched, 1 only in the
#: tree, 2 only searched.
_UNIT = ["k1", "k2", "i", "j"]


def _unit_edges(radius: int):
    """For mapInArrow over rows sorted by unit: a spanning forest of each unit's links."""

    def solve(fps: list[int], roles: list[int], out: list[tuple[int, int]]) -> None:
        if len(fps) < 2:
            return
        tree, sets = BKTree(), UnionFind(len(fps))
        order = sorted(range(len(fps)), key=lambda n: (roles[n] == 2, n))
        placed: list[int] = []
        for n in order:
            for hit in tree.search(fps[n], radius):
                if sets.union(n, placed[hit]):
                    out.append((fps[n], fps[placed[hit]]))
            if roles[n] != 2:
                tree.insert(fps[n])
                placed.append(n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.RecordBatch | None = None

        def solved(batch: pa.RecordBatch, last: bool) -> tuple[list, pa.RecordBatch | None]:
            keys = np.stack([batch.column(batch.schema.get_field_index(c)).to_numpy()
                             .astype(np.int64) for c in _UNIT])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            bounds = [0, *cuts.tolist(), batch.num_rows]
            fps = batch.column(batch.schema.get_field_index("fp")).to_numpy().view(np.uint64)
            roles = batch.column(batch.schema.get_field_index("role")).to_numpy()
            edges: list[tuple[int, int]] = []
            ends = bounds if last else bounds[:-1]
            for a, b in zip(ends[:-1], ends[1:]):
                if b - a > 1:
                    solve(fps[a:b].tolist(), roles[a:b].tolist(), edges)
            return edges, None if last else batch.slice(bounds[-2])

        def table(edges: list[tuple[int, int]]) -> pa.RecordBatch:
            both = np.array(edges, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])],
                                              names=["src", "dst"])

        for batch in batches:
            if batch.num_rows == 0:
                continue
            if rest is not None:
                batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
            edges, rest = solved(batch, last=False)
            if edges:
                yield table(edges)
        if rest is not None:
            edges, _ = solved(rest, last=True)
            if edges:
                yield table(edges)

    return run


def _blocks(low: int, high: int, parts: int) -> list[tuple[int, int]]:
    """(shift, width) of ``parts`` near-equal blocks of the bits low..high-1."""
    edges = [low + (high - low) * i // parts for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(edges[:-1], edges[1:])]


def _bits(col, shift: int, width: int):
    return F.shiftrightunsigned(col, shift).bitwiseAND(F.lit((1 << width) - 1))


def shard_units(fps: DataFrame, radius: int, max_shard: int) -> DataFrame:
    """Rows (k1, k2, i, j, role, fp) of bounded search units, see the module's text."""
    parts = max(2, radius + 1)
    first = _blocks(0, BITS, parts)
    fp = F.col("fp")
    rows = fps.select("fp", F.explode(F.array(*[
        F.lit(n << 32).bitwiseOR(_bits(fp, s, w)) for n, (s, w) in enumerate(first)]))
        .alias("k1"))
    sizes = rows.groupBy("k1").agg(F.count(F.lit(1)).alias("size"))
    rows = rows.join(sizes.where(F.col("size") > 1), "k1")
    small = rows.where(F.col("size") <= max_shard).select(
        "k1", F.lit(-1).cast("long").alias("k2"), F.lit(0).alias("i"), F.lit(0).alias("j"),
        F.lit(0).alias("role"), "fp")
    # oversize shards: deal the other bits, which lie around the block that k1 fixes
    big = rows.where(F.col("size") > max_shard)
    n = F.shiftrightunsigned(F.col("k1"), 32)
    free = F.lit(None).cast("long")
    width = 0
    for i, (s, w) in enumerate(first):
        below = fp.bitwiseAND(F.lit((1 << s) - 1)) if s else F.lit(0).cast("long")
        above = F.shiftleft(F.shiftrightunsigned(fp, s + w), s) if s + w < BITS else F.lit(0)
        free = F.when(n == i, above.bitwiseOR(below)).otherwise(free)
        width = max(width, BITS - w)
    second = _blocks(0, width, parts)
    big = big.withColumn("__free", free)
    big = big.select("k1", "fp", F.explode(F.array(*[
        F.lit(m << 32).bitwiseOR(_bits(F.col("__free"), s, w))
        for m, (s, w) in enumerate(second)])).alias("k2"))
    sizes2 = big.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("size"))
    big = big.join(sizes2.where(F.col("size") > 1), ["k1", "k2"])
    pieces = F.ceil(F.col("size") / F.lit(max_shard)).cast("int")
    big = big.withColumn("__pieces", pieces).withColumn(
        "__own", F.pmod(F.xxhash64("fp"), F.col("__pieces")).cast("int"))
    # unit (i, j), i <= j: the tree of piece i is searched by piece j
    big = big.withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__pieces") - 1)))
    big = big.select(
        "k1", "k2", F.least("__own", "__other").alias("i"), F.greatest("__own", "__other").alias("j"),
        F.when(F.col("__own") == F.col("__other"), 0).when(F.col("__own") < F.col("__other"), 1)
        .otherwise(2).alias("role"), "fp")
    return small.unionByName(big)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    shingle_words: int = 3, radius: int = 3, max_shard: int = 2000,
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: ``doc_id``, ``keep`` columns, ``fp``, ``component_id``, ``group``.

    ``group`` is the smallest fingerprint of the component (never null).
    """
    named = checkpointed(add_fingerprints(docs, text, shingle_words, (doc_id, *keep)))
    groups = checkpointed(named.groupBy("fp").agg(F.min(doc_id).alias("first_id")))
    units = shard_units(groups.select("fp"), radius, max_shard)
    units = units.repartition(*_UNIT).sortWithinPartitions(*_UNIT, "fp")
    edges = units.mapInArrow(_unit_edges(radius), "src long, dst long").distinct()
    roots = connected_components(edges)
    # fingerprint -> smallest id of its component; an unlinked one keeps its own
    linked = groups.join(roots, F.col("fp") == F.col("node"))
    smallest = linked.groupBy("root").agg(F.min("first_id").alias("low"))
    lows = linked.join(smallest, "root").select("fp", "root", "low")
    # written, so that both sides of the last join are plain exchanges: AQE can then
    # split the task of a fingerprint that a third of all documents share
    labels = checkpointed(groups.join(lows, "fp", "left").select(
        "fp", F.coalesce("low", "first_id").alias("component_id"),
        F.coalesce("root", "fp").alias("group")))
    return named.join(labels, "fp")


def keep_one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                     shingle_words: int = 3, radius: int = 3, max_shard: int = 2000) -> DataFrame:
    """The rows of ``docs``, all columns, with one row for each component: its smallest id's.

    Rows without an id go last; of several rows with the smallest id the one
    with the smallest row hash stays.  Only ids and hashes are grouped; the rows
    themselves are shuffled once, to meet the ids that stay.
    """
    rows = docs.select(F.struct("*").alias("__all"), F.col(doc_id).alias("__id"),
                       F.col(text).alias("__text"))
    hashed = rows.withColumn("__row", F.xxhash64(F.to_json("__all")))  # maps can't be hashed
    found = near_duplicates(hashed, "__id", "__text", shingle_words, radius, max_shard, ("__row",))
    first = found.groupBy("group").agg(F.min(F.struct(
        F.col("__id").isNull().alias("none"), F.col("__id").alias("id"), F.col("__row").alias("row")))
        .alias("first")).select("first.id", F.col("first.row").alias("row"))
    whole = hashed.drop("__text")  # the rows have it
    kept = whole.join(first, whole["__id"].eqNullSafe(first["id"])
                      & (whole["__row"] == first["row"]), "left_semi")
    return kept.dropDuplicates(["__id", "__row"]).select("__all.*")


def hex_fingerprint(fp):
    """16 lowercase hexadecimal digits of a signed long column."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
