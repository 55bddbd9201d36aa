"""Toxicity: a convolutional text classifier in numpy.

A word is hashed into two buckets and its vector is the sum of their embeddings,
so a chance collision brings in half a stranger at most.  Filters of several
widths slide over the words; each keeps its largest response over the whole text
(max pooling), and a logistic layer weighs them.  Training (Adam) sends
gradients through the windows that won the pooling.  Buckets seen in fewer than
``min_docs`` training texts stay zero: a word met once could only be learned by
heart.  Embeddings start from the buckets' log odds.

A text's language is guessed from its words (naive Bayes over frequent buckets,
learned on the same rows); for each language a threshold is calibrated on rows
that trained no weights, and scores are shifted so that it lies at 0.5.

Only labelled rows outside the held-out fold train: at most ``max_positive`` and
``max_negative`` of them, chosen by hash, without texts over ``max_words`` words.
Scoring reads whole texts of any length, in pieces that overlap by a window.

Edge cases: null and empty texts have no window and score by the bias alone;
without labels of both kinds every score is the smoothed share of positives;
null labels are no training rows; repeated rows score alike; an empty table
gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nextbest.llm.common import checkpointed, column, fold, hash_sample, slices

_WORDS = re.compile(r"[^\W_]+")
_REMEMBERED = 500_000
#: Words that are convolved at once.
_CHUNK = 1 << 15


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= _REMEMBERED:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h


def word_hashes(text: str | None, memory: _Hashes) -> np.ndarray:
    found = _WORDS.findall(text.lower()) if text else []
    return np.array([memory[w] for w in found], dtype=np.uint64)


class TextCNN:
    def __init__(self, bits: int = 18, dim: int = 8, widths: tuple[int, ...] = (1, 2, 3),
                 filters: int = 8, min_docs: int = 3, epochs: int = 5, batch: int = 64,
                 rate: float = 0.01, seed: int = 7) -> None:
        self.bits, self.dim, self.widths, self.filters = bits, dim, widths, filters
        self.min_docs, self.epochs, self.batch, self.rate, self.seed = (
            min_docs, epochs, batch, rate, seed)
        self.bias, self.trained = 0.0, False
        self.languages: list[str] = []
        self.shift = np.zeros(1)

    def buckets(self, hashes: np.ndarray) -> np.ndarray:
        """(words, 2) bucket numbers."""
        mask = np.uint64((1 << self.bits) - 1)
        return np.stack([hashes & mask, (hashes >> np.uint64(32)) & mask], axis=1).astype(np.int64)

    # ------------------------------------------------------------- forward

    def _responses(self, vectors: np.ndarray, n: int) -> np.ndarray:
        """Filter responses at the first ``n`` words; the text ends in zero vectors."""
        outs = []
        for w, kernel, offset in zip(self.widths, self.kernels, self.offsets):
            out = np.repeat(offset[None, :], n, axis=0)
            for k in range(w):
                part = vectors[k:k + n]
                out[:len(part)] += part @ kernel[k]
            outs.append(out)
        return np.maximum(np.concatenate(outs, axis=1), 0)

    def _pool(self, buckets: np.ndarray) -> np.ndarray:
        pooled = np.zeros(len(self.widths) * self.filters, dtype=np.float32)
        ahead = max(self.widths) - 1
        for at in range(0, len(buckets), _CHUNK):
            part = buckets[at:at + _CHUNK + ahead]
            vectors = self.table[part[:, 0]] + self.table[part[:, 1]]
            pooled = np.maximum(pooled, self._responses(
                vectors, min(_CHUNK, len(buckets) - at)).max(axis=0))
        return pooled

    def _language(self, buckets: np.ndarray) -> int:
        if not self.languages:
            return 0
        return int((self.prior + self.spoken[buckets[:, 0]].sum(axis=0)).argmax())

    def score(self, hashes: np.ndarray) -> float:
        if not self.trained:
            return float(1 / (1 + np.exp(-self.bias)))
        buckets = self.buckets(hashes)
        logit = float(self._pool(buckets) @ self.weights) + self.bias
        return float(1 / (1 + np.exp(-(logit - self.shift[self._language(buckets)]))))

    # ------------------------------------------------------------ training

    def fit(self, texts: list[np.ndarray], labels: np.ndarray, langs: list[str | None],
            apart: np.ndarray) -> TextCNN:
        """``texts`` are word hashes; rows with ``apart`` calibrate and train no weight."""
        y = np.asarray(labels, dtype=np.float64)
        share = (y.sum() + 1) / (len(y) + 2)
        self.bias = float(np.log(share / (1 - share)))
        found = [self.buckets(t) for t in texts]
        train = [i for i in range(len(y)) if not apart[i]] or list(range(len(y)))
        if len(y) == 0 or y[train].min() == y[train].max():
            return self
        rng = np.random.default_rng(self.seed)
        size, total = 1 << self.bits, len(self.widths) * self.filters
        seen = [np.zeros(size), np.zeros(size)]
        for i in train:
            seen[int(y[i])][np.unique(found[i])] += 1
        known = (seen[0] + seen[1]) >= self.min_docs
        n0, n1 = (y[train] == 0).sum(), (y[train] == 1).sum()
        odds = np.log((seen[1] + 0.5) / (n1 + 1)) - np.log((seen[0] + 0.5) / (n0 + 1))
        self.table = rng.normal(0, 0.05, (size, self.dim)).astype(np.float32)
        self.table[:, 0] = np.clip(odds, -2, 4) / 4
        self.table[~known] = 0
        self.kernels = [rng.normal(0, 0.3, (w, self.dim, self.filters)).astype(np.float32)
                        for w in self.widths]
        for kernel in self.kernels:
            kernel[:, 0, : self.filters // 2] = 1.0  # half of them look for toxic words at once
        self.offsets = [np.zeros(self.filters, dtype=np.float32) for _ in self.widths]
        self.weights = np.full(total, 0.5, dtype=np.float32)
        self.bias = -1.0
        self._learn_languages(found, langs, train)
        dense = [*self.kernels, *self.offsets, self.weights]
        moment, square, steps = [np.zeros_like(p) for p in dense], [np.zeros_like(p) for p in dense], 0
        table_square = np.zeros(size, dtype=np.float32)
        ahead = max(self.widths) - 1
        weight = np.where(y == 1, 0.5 / max(n1, 1), 0.5 / max(n0, 1)) * len(train)
        for _ in range(self.epochs):
            order = rng.permutation(train)
            for b in range(0, len(order), self.batch):
                rows = order[b:b + self.batch]
                grads = [np.zeros_like(p) for p in dense]
                g_bias, touched, pushes = 0.0, [], []
                for i in rows:
                    bk = found[i]
                    if not len(bk):
                        continue
                    vectors = np.concatenate([self.table[bk[:, 0]] + self.table[bk[:, 1]],
                                              np.zeros((ahead, self.dim), np.float32)])
                    out = self._responses(vectors, len(bk))
                    at = out.argmax(axis=0)
                    pooled = out[at, np.arange(total)]
                    p = 1 / (1 + np.exp(-(float(pooled @ self.weights) + self.bias)))
                    err = (p - y[i]) * weight[i] / len(rows)
                    g_bias += err
                    grads[-1] += (err * pooled).astype(np.float32)
                    back = np.where(pooled > 0, err * self.weights, 0).astype(np.float32)
                    for j, w in enumerate(self.widths):
                        mine = slice(j * self.filters, (j + 1) * self.filters)
                        grads[len(self.widths) + j] += back[mine]
                        for k in range(w):
                            pos = at[mine] + k
                            grads[j][k] += vectors[pos].T * back[mine]
                            ok = pos < len(bk)
                            touched.append(bk[pos[ok]])
                            pushes.append((self.kernels[j][k] * back[mine]).T[ok])
                steps += 1
                self.bias -= self.rate * 10 * g_bias
                for q, (p_, g) in enumerate(zip(dense, grads)):
                    moment[q] = 0.9 * moment[q] + 0.1 * g
                    square[q] = 0.999 * square[q] + 0.001 * g * g
                    p_ -= self.rate * (moment[q] / (1 - 0.9 ** steps)) / (
                        np.sqrt(square[q] / (1 - 0.999 ** steps)) + 1e-8)
                if touched:
                    both = np.concatenate(touched)
                    push = np.concatenate(pushes)
                    rows_, where = np.unique(both, return_inverse=True)
                    g = np.zeros((len(rows_), self.dim), dtype=np.float32)
                    np.add.at(g, where.reshape(-1), np.repeat(push, 2, axis=0))
                    g[~known[rows_]] = 0
                    table_square[rows_] += (g * g).mean(axis=1)
                    self.table[rows_] -= 0.02 * g / (np.sqrt(table_square[rows_])[:, None] + 1e-6)
        self.trained = True
        self._calibrate([i for i in range(len(y)) if apart[i]] or train, found, y)
        return self

    def _learn_languages(self, found: list[np.ndarray], langs: list[str | None],
                         train: list[int], frequent: int = 2000) -> None:
        names = sorted({langs[i] for i in train if langs[i] is not None})
        if not names:
            return
        counts = np.zeros((1 << self.bits, len(names)))
        rows = np.zeros(len(names))
        for i in train:
            if langs[i] is not None and len(found[i]):
                j = names.index(langs[i])
                rows[j] += 1
                np.add.at(counts[:, j], found[i][:, 0], 1)
        top = np.argsort(-counts.sum(axis=1), kind="stable")[:frequent]
        self.spoken = np.zeros((1 << self.bits, len(names)), dtype=np.float32)
        self.spoken[top] = np.log((counts[top] + 0.5) / (counts[top].sum(axis=0) + 0.5 * len(top)))
        self.prior = np.log((rows + 1) / (rows.sum() + len(names)))
        self.languages = names

    def _calibrate(self, rows: list[int], found: list[np.ndarray], y: np.ndarray,
                   least: int = 10) -> None:
        """Shift of each language's logit: the cut with the best F1, halfway to its neighbours.

        A language with fewer than ``least`` rows of either label takes the cut
        of all rows.
        """
        logits = np.array([float(self._pool(found[i]) @ self.weights) + self.bias for i in rows])
        spoken = np.array([self._language(found[i]) for i in rows])
        truth = y[rows]

        def cut(mask: np.ndarray) -> float:
            z, t = logits[mask], truth[mask]
            order = np.argsort(-z, kind="stable")
            z, t = z[order], t[order]
            hits = np.cumsum(t)
            f1 = 2 * hits / (np.arange(1, len(t) + 1) + t.sum())
            f1[:-1][z[:-1] == z[1:]] = -1  # equal scores can't be parted
            k = int(f1.argmax())
            return float((z[k] + z[k + 1]) / 2) if k + 1 < len(z) else float(z[k]) - 1e-3

        everyone = np.ones(len(rows), dtype=bool)
        common = cut(everyone) if 0 < truth.sum() < len(truth) else 0.0
        self.shift = np.full(max(1, len(self.languages)), common)
        for j in range(len(self.languages)):
            mine = spoken == j
            if min((truth[mine] == 1).sum(), (truth[mine] == 0).sum()) >= least:
                self.shift[j] = cut(mine)


def training_sample(labels: DataFrame, label: str, folds: int, held_out: int, max_positive: int,
                    max_negative: int) -> DataFrame:
    """(doc_id, y): at most the given numbers of rows, those with the smallest hash.

    An id with several labels takes the largest.
    """
    rows = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()
                        & (fold(F.col("doc_id"), folds) != held_out)).groupBy("doc_id").agg(
        F.max(F.col(label).cast("int")).alias("y"))
    return hash_sample(rows.where("y = 1"), "doc_id", max_positive).unionByName(
        hash_sample(rows.where("y = 0"), "doc_id", max_negative))


def score_toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   lang: str = "lang", label: str = "toxic", folds: int = 5, held_out: int = 0,
                   max_positive: int = 3000, max_negative: int = 4000, max_words: int = 20_000,
                   max_total_words: int = 12_000_000, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted.

    The training texts reach the driver as word hashes: at most the given
    numbers of rows, of at most ``max_words`` words each, and in the order of
    their ids' hashes up to ``max_total_words`` (96 MB).  An id with several
    texts trains with the one of the smallest hash.
    """
    spark = docs.sparkSession
    sample = checkpointed(training_sample(labels.select(F.col(doc_id).alias("doc_id"), label), label,
                                          folds, held_out, max_positive, max_negative))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = _Hashes()
        for batch in slices(batches, text):
            got = [word_hashes(t, memory) for t in column(batch, text)]
            keep = pa.array([len(h) <= max_words for h in got])
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "y", "lang")]
                + [pa.array([h.tobytes() for h in got], pa.binary())],
                names=["doc_id", "y", "lang", "words"]).filter(keep)

    # the sample is bounded by its two limits, so it may be broadcast
    picked = docs.select(F.col(doc_id).alias("doc_id"), F.col(text), F.col(lang).alias("lang")).join(
        F.broadcast(sample), "doc_id").select("doc_id", "y", "lang", text)
    kind = docs.schema[doc_id].dataType.simpleString()
    one = F.min(F.struct(F.xxhash64("words").alias("h"), "words", "lang", "y")).alias("one")
    texts = checkpointed(picked.mapInArrow(
        hashed, f"doc_id {kind}, y int, lang string, words binary").groupBy("doc_id").agg(one).select(
        "doc_id", "one.y", "one.lang", "one.words",
        (F.xxhash64(F.lit("calibrate"), "doc_id") % 4 == 0).alias("apart")))
    # a window over the ids of the bounded sample
    upto = F.sum("n").over(Window.orderBy(F.xxhash64("doc_id"), "doc_id"))
    within = texts.select("doc_id", (F.octet_length("words") / 8).alias("n")).withColumn(
        "upto", upto).where(F.col("upto") <= max_total_words).select("doc_id")
    rows = texts.join(F.broadcast(within), "doc_id").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["words"]))
    model = TextCNN().fit([np.frombuffer(r["words"], dtype=np.uint64) for r in rows],
                          np.array([r["y"] for r in rows]), [r["lang"] for r in rows],
                          np.array([r["apart"] for r in rows], dtype=bool))
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = _Hashes()
        for batch in slices(batches, text):
            scores = [shared.value.score(word_hashes(t, memory)) for t in column(batch, text)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(doc_id)), pa.array(scores, pa.float64())],
                names=["doc_id", "score"])

    scored = docs.select(doc_id, text).mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select("doc_id", (fold(F.col("doc_id"), folds) == held_out).alias("held_out"),
                         "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
