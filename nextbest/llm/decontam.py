"""Benchmark decontamination by size-partitioned MinHash containment search.

A test item is short and a document may be long, so their Jaccard similarity
says little; what matters is containment, the share of the item's distinct
shingles that occur in the document.

* Items are partitioned by the size of their shingle sets (powers of two).  Each
  partition has its own sketch size: an item's sketch is its bottom-k MinHash,
  the k shingles with the smallest hashes.  k is at least ``sketch`` and always
  over (1 - threshold) * n, so a document that holds ``threshold`` of the n
  shingles holds at least one of the sketch: no candidate can be missed.
* A document is scanned once: the hashes of its shingles are looked up among the
  sketch hashes.  The share of an item's sketch found estimates its containment;
  items whose count is below the number that the threshold forces are dropped,
  and so are whole partitions of items larger than the document allows.
* Survivors are verified by exact containment of the shingle strings.
* Items of fewer words than a shingle are partitions of their own, one for each
  number of words: windows of that length are looked up by hash and compared.

Documents are neither shuffled nor collected.  Items are broadcast in blocks of
at most ``block_shingles`` shingles; with more items than one block holds, the
documents are scanned once for each block, all against whole texts.

Words are runs of letters and digits (any non-ASCII character counts as one)
after lower-casing A-Z, so punctuation and case don't hide a copy.

Edge cases: null and empty texts and items have no shingles and match nothing; an
item shorter than a shingle is one shingle of all its words; repeated document
rows give repeated pairs, repeated items one pair each; an empty side gives an
empty result; null ids are carried as they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from nextbest.llm.common import checkpointed, column, py_lower_ascii, slices

_WORDS = re.compile(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
_MULT = np.uint64(0x9E3779B97F4A7C15)

#: Words whose hashes a worker remembers; the memory is emptied when it is full.
_REMEMBERED = 500_000


def content_words(text: str | None) -> list[str]:
    return _WORDS.findall(py_lower_ascii(text)) if text else []


def shingles(found: list[str], size: int) -> set[str]:
    if not found:
        return set()
    if len(found) < size:
        return {" ".join(found)}
    return set(map(" ".join, zip(*(found[i:] for i in range(size)))))


class WordHashes(dict):
    """word -> 64-bit hash, with bounded memory."""

    def __missing__(self, word: str) -> int:
        if len(self) >= _REMEMBERED:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h


def shingle_hashes(found: list[str], size: int, memory: WordHashes) -> np.ndarray:
    """One 64-bit hash for each window of ``size`` words, mixed from the words' hashes."""
    if not found:
        return np.empty(0, dtype=np.uint64)
    h = np.array([memory[w] for w in found], dtype=np.uint64)
    n = max(1, len(found) - size + 1)
    out = np.zeros(n, dtype=np.uint64)
    for i in range(min(size, len(found))):
        out ^= h[i:i + n]
        out *= _MULT
        out ^= out >> np.uint64(29)
    return out


class ItemBlock:
    """Sketches and shingle sets of some items, ready to be searched."""

    def __init__(self, items: list[tuple[int, list[str]]], shingle_words: int, threshold: float,
                 sketch: int) -> None:
        self.size, self.threshold = shingle_words, threshold
        self.ids = [i for i, _ in items]
        self.sets = [set(s) for _, s in items]
        self.need = [_at_least(threshold, len(s)) for s in self.sets]
        memory = WordHashes()
        short: dict[int, dict[str, list[int]]] = {}  # words -> text -> items
        for n, s in enumerate(self.sets):
            if len(s) == 1 and (k := next(iter(s)).count(" ") + 1) < shingle_words:
                short.setdefault(k, {}).setdefault(next(iter(s)), []).append(n)
        self.short = {k: (np.unique(np.concatenate([
            shingle_hashes(t.split(" "), k, memory) for t in texts])), texts)
            for k, texts in short.items()}
        apart = {n for texts in short.values() for some in texts.values() for n in some}
        parts: dict[int, int] = {}  # size partition -> sketch size
        for s in self.sets:
            top = 1 << (len(s) - 1).bit_length()  # largest set of the partition
            parts[top] = max(sketch, top - _at_least(threshold, top) + 1)
        keys, owners, self.sketch_need = [], [], []
        for n, s in enumerate(self.sets):
            if n in apart:
                self.sketch_need.append(1)
                continue
            hashes = sorted(int(shingle_hashes(x.split(" "), shingle_words, memory)[0]) for x in s)
            k = min(len(hashes), parts[1 << (len(s) - 1).bit_length()])
            # of n shingles n - need may be absent, all of them from the sketch
            self.sketch_need.append(max(1, k - (len(s) - self.need[n])))
            keys += hashes[:k]
            owners += [n] * k
        order = np.argsort(np.array(keys, dtype=np.uint64), kind="stable")
        self.keys = np.array(keys, dtype=np.uint64)[order]
        self.owners = np.array(owners, dtype=np.int64)[order]
        self.sketch_need = np.array(self.sketch_need, dtype=np.int64)
        self.smallest = min((c for n, c in enumerate(self.need) if n not in apart), default=0)

    def search(self, text: str | None, memory: WordHashes) -> list[tuple[int, int, int]]:
        """(item's position, shingles found, shingles) of the items that the text contains."""
        found = content_words(text)
        return self._search_short(found, memory) + self._search_long(found, memory)

    def _search_short(self, found: list[str], memory: WordHashes) -> list[tuple[int, int, int]]:
        """Items of fewer words than a shingle, by windows of their own length."""
        hits: set[int] = set()
        for k, (keys, texts) in self.short.items():
            if len(found) < k:
                continue
            hashes = shingle_hashes(found, k, memory)
            at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
            _, first = np.unique(hashes, return_index=True)
            for i in first[keys[at[first]] == hashes[first]].tolist():
                hits.update(texts.get(" ".join(found[i:i + k]), ()))
        return [(n, 1, 1) for n in sorted(hits)]

    def _search_long(self, found: list[str], memory: WordHashes) -> list[tuple[int, int, int]]:
        if not len(self.keys):
            return []
        hashes = shingle_hashes(found, self.size, memory)
        if len(hashes) < self.smallest:
            return []
        at = np.searchsorted(self.keys, hashes)
        hit = np.unique(hashes[self.keys[np.minimum(at, len(self.keys) - 1)] == hashes])
        if not len(hit):
            return []
        lo, hi = np.searchsorted(self.keys, hit), np.searchsorted(self.keys, hit, side="right")
        owners = np.concatenate([self.owners[a:b] for a, b in zip(lo, hi)])
        counts = np.bincount(owners, minlength=len(self.ids))
        candidates = np.flatnonzero(counts >= self.sketch_need)
        if not len(candidates):
            return []
        whole = shingles(found, self.size)
        out = []
        for n in candidates.tolist():
            common = len(self.sets[n] & whole)
            if common >= self.need[n]:
                out.append((n, common, len(self.sets[n])))
        return out


def _at_least(threshold: float, n: int) -> int:
    """Smallest count c with c / n >= threshold, free of rounding."""
    c = int(threshold * n)
    while c / n < threshold:
        c += 1
    while c > 0 and (c - 1) / n >= threshold:
        c -= 1
    return c


def _item_sets(items: DataFrame, item_id: str, text: str, size: int) -> DataFrame:
    """(item_id, shingles as a sorted list) of every item with a word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [sorted(shingles(content_words(t), size)) for t in column(batch, text)]
            ids = batch.column(batch.schema.get_field_index(item_id))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(sets, pa.list_(pa.string()))], names=["item_id", "shingles"])

    kind = items.schema[item_id].dataType.simpleString()
    return items.select(item_id, text).mapInArrow(
        run, f"item_id {kind}, shingles array<string>").where("size(shingles) > 0")


def item_blocks(items: DataFrame, item_id: str, item_text: str, shingle_words: int,
                threshold: float, sketch: int, block_shingles: int) -> Iterator:
    """Broadcast ItemBlocks of about ``block_shingles`` shingles that together hold all items."""
    sets = checkpointed(_item_sets(items, item_id, item_text, shingle_words))
    total = sets.agg(F.sum(F.size("shingles"))).first()[0] or 0
    blocks = max(1, -(-total // block_shingles))
    sets = sets.withColumn("__block", F.pmod(F.xxhash64("item_id", "shingles"), F.lit(blocks)))
    for b in range(blocks):
        rows = sets.where(F.col("__block") == b).select("item_id", "shingles").collect()
        here = sorted(((r[0], r[1]) for r in rows), key=lambda r: (r[0] is None, r[0], r[1]))
        yield items.sparkSession.sparkContext.broadcast(
            ItemBlock(here, shingle_words, threshold, sketch))


def find_contained(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   item_id: str = "item_id", item_text: str = "text", shingle_words: int = 5,
                   threshold: float = 0.8, sketch: int = 16, block_shingles: int = 500_000,
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """Pairs (doc_id, ``keep`` columns, item_id, n_common, n_shingles, containment)."""
    kept = [doc_id, *keep]
    kind = items.schema[item_id].dataType
    schema = docs.select(*kept).schema.add("__item", kind).add("n_common", "integer").add(
        "n_shingles", "integer")
    found = []
    for block in item_blocks(items, item_id, item_text, shingle_words, threshold, sketch,
                             block_shingles):
        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            memory, searched = WordHashes(), block.value
            for batch in slices(batches, text):
                rows, hits = [], []
                for n, t in enumerate(column(batch, text)):
                    new = searched.search(t, memory)
                    rows += [n] * len(new)
                    hits += new
                if not rows:
                    continue
                cols = [batch.column(batch.schema.get_field_index(c)).take(pa.array(rows))
                        for c in kept]
                cols.append(pa.array([searched.ids[h[0]] for h in hits], to_arrow_type(kind)))
                cols += [pa.array([h[i] for h in hits], pa.int32()) for i in (1, 2)]
                yield pa.RecordBatch.from_arrays(
                    cols, names=[*kept, "__item", "n_common", "n_shingles"])

        found.append(docs.select(*dict.fromkeys([*kept, text])).mapInArrow(run, schema))
    return reduce(DataFrame.unionByName, found).select(
        *kept, F.col("__item").alias("item_id"), "n_common", "n_shingles",
        (F.col("n_common") / F.col("n_shingles")).alias("containment"))


def drop_contaminated(docs: DataFrame, items: DataFrame, text: str = "text",
                      item_id: str = "item_id", item_text: str = "text", shingle_words: int = 5,
                      threshold: float = 0.8, sketch: int = 16,
                      block_shingles: int = 500_000) -> DataFrame:
    """The rows of ``docs``, all columns, that contain no item; nothing is shuffled."""
    for block in item_blocks(items, item_id, item_text, shingle_words, threshold, sketch,
                             block_shingles):
        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            memory, searched = WordHashes(), block.value
            for batch in slices(batches, text):
                clean = [not searched.search(t, memory) for t in column(batch, text)]
                yield batch if all(clean) else batch.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
