"""Quality classifier: a generalised additive model with pairwise interactions.

Every feature is cut into bins (quantiles of the training rows) and has a lookup
table of one number a bin.  The tables are learned by cyclic boosting: round
after round, each feature in turn gets a shallow tree fitted to the gradient
that all others leave, and the tree's leaves are added to its table.  Then the
pairs of features that still explain most get two-dimensional tables the same
way.  A score is the sum of table entries, looked up with whole arrays at once.

Features are shape statistics of a whole text (lengths, repeats, case,
punctuation), computed in one pass over the texts and written once; training
reads at most ``max_rows`` labelled rows of them, those with the smallest hash.

Edge cases: null and empty texts have all features 0 and are scored like any
row; ties in a bin edge go to the upper bin; repeated rows score alike; without
a single label every score is 0.5; an empty table gives an empty result; rows
with a null label are no training rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nextbest.llm.common import WORD, checkpointed, column, fold, hash_sample, slices

FEATURES = ("log_words", "mean_word", "long_words", "short_words", "symbols", "upper", "digits",
            "marks", "stops", "commas", "distinct", "top_word", "stutter", "repeat_pairs",
            "dup_lines", "log_line", "upper_words", "non_ascii")


def features(text: str | None) -> list[float]:
    """The shape of a text; every ratio is over its words, lines or characters."""
    found = WORD.findall(text) if text else []
    n = len(found)
    if not n:
        return [0.0] * len(FEATURES)
    chars = sum(map(len, found))
    counts = Counter(found)
    lengths = np.fromiter(map(len, found), dtype=np.int64, count=n)
    pairs = len(set(zip(found, found[1:])))
    lines = [x for x in text.split("\n") if x.strip(" \t\r\x0b\x0c")]
    count = text.count
    return [
        float(np.log1p(n)), chars / n, float((lengths > 14).mean()), float((lengths < 4).mean()),
        sum(map(count, "#*$%&|<>")) / n,
        sum(map(count, "ABCDEFGHIJKLMNOPQRSTUVWXYZ")) / chars,
        sum(map(count, "0123456789")) / chars, (count("!") + count("?")) / n, count(".") / n,
        count(",") / n, len(counts) / n, max(counts.values()) / n,
        sum(a == b for a, b in zip(found, found[1:])) / n, 1 - pairs / max(1, n - 1) if n > 1 else 0.0,
        1 - len(set(lines)) / len(lines), float(np.log1p(chars / len(lines))),
        sum(c for w, c in counts.items() if w.isupper()) / n,
        (len(text.encode("utf-8", "surrogatepass")) - len(text)) / chars]


def add_features(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            rows = [features(t) for t in column(batch, text)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(doc_id)),
                 pa.array(rows, pa.list_(pa.float64()))], names=["doc_id", "x"])

    return docs.select(doc_id, text).mapInArrow(run, f"doc_id {kind}, x array<double>")


# ------------------------------------------------------------------ the model

def _tree(grad: np.ndarray, hess: np.ndarray, leaves: int, least: float, ridge: float) -> np.ndarray:
    """Leaf value of every bin for a tree over ordered bins, grown best split first."""
    g, h = np.concatenate([[0], np.cumsum(grad)]), np.concatenate([[0], np.cumsum(hess)])

    def best(a: int, b: int) -> tuple[float, int]:
        cut = np.arange(a + 1, b)
        hl, hr = h[cut] - h[a], h[b] - h[cut]
        gl, gr = g[cut] - g[a], g[b] - g[cut]
        gain = gl ** 2 / (hl + ridge) + gr ** 2 / (hr + ridge) - (g[b] - g[a]) ** 2 / (
            h[b] - h[a] + ridge)
        gain = np.where((hl >= least) & (hr >= least), gain, -1.0)
        k = int(gain.argmax()) if len(cut) else -1
        return (float(gain[k]), int(cut[k])) if k >= 0 else (-1.0, -1)

    parts = [(0, len(grad))]
    while len(parts) < leaves:
        options = [(*best(a, b), i) for i, (a, b) in enumerate(parts)]
        gain, cut, i = max(options, key=lambda o: o[0])
        if gain <= 1e-9:
            break
        a, b = parts.pop(i)
        parts += [(a, cut), (cut, b)]
    out = np.zeros(len(grad))
    for a, b in parts:
        out[a:b] = (g[b] - g[a]) / (h[b] - h[a] + ridge)
    return out


class AdditiveModel:
    """Bins, one table a feature, and tables for some pairs of features."""

    def __init__(self, max_bins: int = 64, pair_bins: int = 12, pairs: int = 8, rounds: int = 150,
                 pair_rounds: int = 60, rate: float = 0.1, leaves: int = 4, ridge: float = 1.0,
                 least: float = 2.0) -> None:
        self.max_bins, self.pair_bins, self.n_pairs = max_bins, pair_bins, pairs
        self.rounds, self.pair_rounds, self.rate = rounds, pair_rounds, rate
        self.leaves, self.ridge, self.least = leaves, ridge, least
        self.base, self.tables, self.pair_tables = 0.0, [], []

    @staticmethod
    def _edges(x: np.ndarray, bins: int) -> np.ndarray:
        return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1], method="lower"))

    def _bins(self, x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)])

    def fit(self, x: np.ndarray, y: np.ndarray) -> AdditiveModel:
        n, width = x.shape
        if not n:
            return self
        self.edges = [self._edges(x[:, j], self.max_bins) for j in range(width)]
        self.coarse = [self._edges(x[:, j], self.pair_bins) for j in range(width)]
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        self.pair_tables = []
        mean = (y.sum() + 1) / (n + 2)
        self.base = float(np.log(mean / (1 - mean)))
        if y.min() == y.max():
            return self
        bins, score = self._bins(x, self.edges), np.full(n, self.base)

        def slopes() -> tuple[np.ndarray, np.ndarray]:
            p = 1 / (1 + np.exp(-score))
            return y - p, p * (1 - p)

        for _ in range(self.rounds):
            for j in range(width):
                grad, hess = slopes()
                size = len(self.tables[j])
                step = self.rate * _tree(np.bincount(bins[j], grad, size),
                                         np.bincount(bins[j], hess, size), self.leaves,
                                         self.least, self.ridge)
                self.tables[j] += step
                score += step[bins[j]]
        # pairs: those whose coarse grid explains most of what is left
        rough = self._bins(x, self.coarse)
        grad, hess = slopes()
        found = []
        for a, b in combinations(range(width), 2):
            wide = len(self.coarse[b]) + 1
            cell = rough[a] * wide + rough[b]
            size = (len(self.coarse[a]) + 1) * wide
            g, h = np.bincount(cell, grad, size), np.bincount(cell, hess, size)
            found.append((float((g ** 2 / (h + self.ridge)).sum()), a, b))
        chosen = sorted(found, reverse=True)[:self.n_pairs]
        cells = {}
        for _, a, b in chosen:
            shape = (len(self.coarse[a]) + 1, len(self.coarse[b]) + 1)
            cells[a, b] = rough[a] * shape[1] + rough[b]
            self.pair_tables.append((a, b, np.zeros(shape)))
        for _ in range(self.pair_rounds):
            for a, b, table in self.pair_tables:
                grad, hess = slopes()
                g = np.bincount(cells[a, b], grad, table.size).reshape(table.shape)
                h = np.bincount(cells[a, b], hess, table.size).reshape(table.shape)
                step = self.rate * self._pair_tree(g, h)
                table += step
                score += step.reshape(-1)[cells[a, b]]
        return self

    def _pair_tree(self, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        """The best cut of the first feature with one cut of the second on each side of it."""
        best, out = -1.0, np.zeros_like(g)
        for cut in range(1, max(2, g.shape[0])):
            step = np.zeros_like(g)
            for part in (slice(0, cut), slice(cut, None)):
                if g[part].size:
                    step[part] = _tree(g[part].sum(axis=0), h[part].sum(axis=0), 2, self.least,
                                       self.ridge)[None, :]
            gain = float((g * step).sum())  # the loss that a full step would take off, doubled
            if gain > best:
                best, out = gain, step
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for every row."""
        total = np.full(len(x), self.base)
        for j, table in enumerate(self.tables):
            total += table[np.searchsorted(self.edges[j], x[:, j], side="left")]
        for a, b, table in self.pair_tables:
            total += table[np.searchsorted(self.coarse[a], x[:, a], side="left"),
                           np.searchsorted(self.coarse[b], x[:, b], side="left")]
        return 1 / (1 + np.exp(-total))


def training_rows(featured: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int,
                  max_rows: int) -> DataFrame:
    """(x, y) of labelled rows outside the held-out fold: at most ``max_rows``, by smallest hash.

    An id with several labels takes the largest, one with several texts the
    smallest features.  The picked labels are bounded by ``max_rows``, so they
    are broadcast and no other features are shuffled.
    """
    use = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()
                       & (fold(F.col("doc_id"), folds) != held_out))
    use = use.groupBy("doc_id").agg(F.max(F.col(label).cast("double")).alias("y"))
    picked = checkpointed(hash_sample(use, "doc_id", max_rows))
    return featured.join(F.broadcast(picked), "doc_id").groupBy("doc_id").agg(
        F.min("x").alias("x"), F.max("y").alias("y"))


def score_quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  label: str = "quality", folds: int = 5, held_out: int = 0,
                  max_rows: int = 20_000, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    featured = checkpointed(add_features(docs, doc_id, text))
    labels = labels.select(F.col(doc_id).alias("doc_id"), label)
    rows = training_rows(featured, labels, label, folds, held_out, max_rows).collect()
    rows.sort(key=lambda r: r["doc_id"])
    x = np.array([r["x"] for r in rows], dtype=float).reshape(-1, len(FEATURES))
    model = AdditiveModel().fit(x, np.array([r["y"] for r in rows], dtype=float))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(batch.schema.get_field_index("x")).flatten().to_numpy(
                zero_copy_only=False)
            p = shared.value.score(flat.reshape(-1, len(FEATURES)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("doc_id")), pa.array(p)],
                names=["doc_id", "score"])

    kind = docs.schema[doc_id].dataType.simpleString()
    scored = featured.mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select("doc_id", (fold(F.col("doc_id"), folds) == held_out).alias("held_out"),
                         "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
