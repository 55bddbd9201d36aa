"""Language identification by rank-order n-gram profiles.

A profile is a list of n-grams (one to three letters, word ends marked) from the
most frequent down.  Each language's profile comes from the counts over all
training documents; a document gets the language whose profile has the smallest
out-of-place distance: for each of the document's n-grams, how far its rank is
from its rank there, or the profile's length if it is missing there.

N-grams are packed integers cut from whole texts with array operations.  Tasks
add up counts by language before the shuffle, so what is shuffled is one row per
language, n-gram and task.

Edge cases: a null text, or one without a letter, is ``und`` with score 0, as is
every row when nothing was learned; equal distances go to the first language in
code-point order; equally frequent n-grams rank in order of their letters; a
text of any length is counted whole, in pieces cut between words; null languages
are never learned; repeated rows count each time; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nextbest.llm.common import column, fold, slices

UNKNOWN = "und"
PROFILE = 300
_PIECE = 1 << 20
#: Distinct n-grams that a task holds for a language before it sends them on.
_HELD = 1 << 20
_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool,
                                    count=0x110000))
    return _LETTERS[0]


def _pieces(text: str) -> Iterator[str]:
    """``text`` in pieces of about a million characters, cut where a word can't go on."""
    at, n = 0, len(text)
    while n - at > _PIECE:
        end = at + _PIECE
        while end < n and text[end].isalpha():
            end += 1
        yield text[at:end]
        at = end
    yield text[at:]


def _grams(text: str) -> np.ndarray:
    """All n-grams of a text: 21 bits a character (plus one), 1 for a word's end."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    x = np.zeros(len(points) + 2, dtype=np.int64)
    x[1:-1] = np.where(_letters()[points], points, 0)
    x = x[np.concatenate([[True], (x[1:] != 0) | (x[:-1] != 0)])] + 1
    if len(x) < 3:
        return np.empty(0, dtype=np.int64)
    two = (x[:-1] << 21) | x[1:]
    three = ((two[:-1] << 21) | x[2:])[x[1:-1] != 1]
    return np.concatenate([x[x != 1], two, three])


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, where = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
    return codes, np.bincount(where, np.concatenate([n for _, n in parts]),
                              len(codes)).astype(np.int64)


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(codes ascending, counts) of a whole text."""
    if not text:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    parts = [np.unique(_grams(p), return_counts=True) for p in _pieces(text)]
    return parts[0] if len(parts) == 1 else _merge(parts)


def top_grams(codes: np.ndarray, counts: np.ndarray, size: int = PROFILE) -> np.ndarray:
    """The ``size`` most frequent codes, ties in code order."""
    return codes[np.argsort(-counts, kind="stable")[:size]]


def learn_profiles(docs: DataFrame, text: str = "text", lang: str = "lang",
                   size: int = PROFILE) -> dict[str, list[int]]:
    """The profile of every language; ``size`` rows a language reach the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def rows(names: list[str]) -> pa.RecordBatch:
            got = [(name, *held.pop(name)) for name in names]
            return pa.RecordBatch.from_arrays(
                [pa.array([name for name, c, _ in got for _ in range(len(c))], pa.string()),
                 pa.array(np.concatenate([c for _, c, _ in got])),
                 pa.array(np.concatenate([n for _, _, n in got]))], names=["lang", "gram", "n"])

        for batch in slices(batches, text, 2 << 20):
            texts = defaultdict(list)
            for name, t in zip(column(batch, lang), column(batch, text)):
                if t:
                    texts[name].append(t)
            for name, some in texts.items():
                new = gram_counts("\n".join(some))
                held[name] = _merge([held[name], new]) if name in held else new
            full = [name for name, (c, _) in held.items() if len(c) > _HELD]
            if full:
                yield rows(full)
        if held:
            yield rows(list(held))

    counts = docs.where(F.col(lang).isNotNull()).select(lang, text).mapInArrow(
        run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    top = counts.withColumn("rank", rank).where(F.col("rank") <= size).collect()
    out: dict[str, list[int]] = defaultdict(list)
    for r in sorted(top, key=lambda r: (r["lang"], r["rank"])):
        out[r["lang"]].append(r["gram"])
    return dict(out)


class Profiles:
    """Ranks of all profiles' n-grams, one column a language."""

    def __init__(self, profiles: dict[str, list[int]], size: int = PROFILE) -> None:
        self.names, self.size = sorted(profiles), size
        self.codes = np.array(sorted({g for p in profiles.values() for g in p}), dtype=np.int64)
        self.ranks = np.full((len(self.codes) + 1, len(self.names)), -1, dtype=np.int64)
        for j, name in enumerate(self.names):
            at = np.searchsorted(self.codes, np.array(profiles[name], dtype=np.int64))
            self.ranks[at, j] = np.arange(len(profiles[name]))

    def predict(self, text: str | None) -> tuple[str, float]:
        codes, counts = gram_counts(text)
        if not len(codes) or not self.names:
            return UNKNOWN, 0.0
        top = top_grams(codes, counts, self.size)
        at = np.minimum(np.searchsorted(self.codes, top), len(self.codes) - 1)
        at = np.where(self.codes[at] == top, at, len(self.codes))  # last row: in no profile
        ranks = self.ranks[at]
        away = np.where(ranks < 0, self.size, np.abs(ranks - np.arange(len(top))[:, None]))
        near = 1 - away.sum(axis=0) / (self.size * len(top))  # 1: same ranks, 0: nothing shared
        best = int(near.argmax())
        whole = float(near.sum())
        return self.names[best], float(near[best]) / whole if whole > 0 else 1 / len(self.names)


def identify(docs: DataFrame, profiles: dict[str, list[int]], doc_id: str = "doc_id",
             text: str = "text", size: int = PROFILE) -> DataFrame:
    """doc_id, lang_pred, score."""
    shared = docs.sparkSession.sparkContext.broadcast(Profiles(profiles, size))
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            got = [shared.value.predict(t) for t in column(batch, text)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(doc_id)),
                 pa.array([g[0] for g in got], pa.string()),
                 pa.array([g[1] for g in got], pa.float64())],
                names=["doc_id", "lang_pred", "score"])

    return docs.select(doc_id, text).mapInArrow(
        run, f"doc_id {kind}, lang_pred string, score double")


def language_id(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
                folds: int = 4, held_out: int = 2, size: int = PROFILE) -> DataFrame:
    """Learn outside the held-out fold, predict all: doc_id, held_out, lang_pred, score."""
    learn = docs.where(fold(F.col(doc_id), folds) != held_out)
    found = identify(docs, learn_profiles(learn, text, lang, size), doc_id, text, size)
    return found.select("doc_id", (fold(F.col("doc_id"), folds) == held_out).alias("held_out"),
                        "lang_pred", "score")
