"""Token ids in Huffman-coded files.

Writing: texts are tokenised, ids are counted over the whole corpus, and one
canonical length-limited Huffman code is built from the counts (package-merge,
so no code is longer than ``max_bits``).  Documents are range-partitioned by id
and each partition writes blocks of whole documents in ascending order.

A block can be decoded alone: it has the documents' ids and lengths, the packed
bits and the bit offset of every ``CHECKPOINT``-th id.  Decoding looks
``max_bits`` bits up in a table that gives the id and its code length; as every
checkpoint is a place to start, one numpy step decodes an id in each stretch
between checkpoints at once.

Layout under the target folder, all Parquet so that the writes commit or don't:

* ``blocks``: shard (ascending id ranges), block, first_token (ids before the
  block in its shard), n_tokens, doc_ids, doc_tokens, checkpoints, bits
* ``shards``: shard, first_token (ids before the shard), n_tokens
* ``code``: id, count, bits (code length); codes follow canonically

Only the vocabulary's counts (bounded by the tokenizer) and one total per shard
reach the driver.  Edge cases: null and empty texts are a lone end id; null
doc_ids come first; repeated rows are encoded each time; ties between equal
doc_ids are ordered by their ids' hash; an empty table writes empty files.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from nextbest.llm.common import WORD, checkpointed, column, crc, slices

CHECKPOINT = 64
BLOCK_TOKENS = 1 << 16
MAX_BITS = 18
#: Pieces of words that a worker remembers; the memory is emptied when it is full.
_REMEMBERED = 600_000


# ---------------------------------------------------------------- tokenising

class _Codes(dict):
    """piece -> its number; ``pool[starts[n]:starts[n + 1]]`` are the ids of piece n."""

    def __init__(self, ids_of: Callable[[str], list[int]]) -> None:
        super().__init__()
        self.ids_of, self.pool, self.starts = ids_of, array("I"), array("q", [0])

    def __missing__(self, piece: str) -> int:
        code = self[piece] = len(self)
        self.pool.extend(self.ids_of(piece))
        self.starts.append(len(self.pool))
        return code


class WordTokenizer:
    """Ids of whole texts by a tokenizers BPE file, remembering pieces of words.

    The file's tokenizer drops white space and never joins text across it, so a
    text's ids are its words' ids in a row.  A text, or else each word of it, of
    plain letters, digits and signs is cut into the pieces that go to the
    library's BPE model; any other word goes through the library's whole
    pipeline.  A piece met again is one lookup, and ids are gathered by numpy.
    """

    #: printable ASCII and precomposed Latin letters, which no normaliser but
    #: lower-casing changes
    _SIGNS = "\x21-\x7eÀ-ÖØ-öø-įı-ňŊ-ž"
    _PLAIN = re.compile(f"[{_SIGNS}]+")
    _PLAIN_TEXT = re.compile(f"[{_SIGNS}\x20\x09-\x0D]*")
    _PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ž]+|[0-9]|"
                        "[^\\sa-zß-öø-ž0-9]+")
    #: Marks a word that goes through the whole pipeline; no piece holds it.
    _WHOLE = "\0"

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = False
        self.model = self.whole.model
        byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.to_bytes = lambda s: byte_level.pre_tokenize_str(s)[0][0]
        self.steady = self._is_steady()
        self.codes = _Codes(self._piece)

    def _is_steady(self) -> bool:
        """True if the file has the pipeline that the shortcut stands for."""
        import json
        spec = json.loads(self.whole.to_str())
        norm, pre = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
        steps = [n.get("type") for n in norm.get("normalizers", [])]
        split = (pre.get("pretokenizers") or [{}])[0]
        return (steps == ["NFC", "Replace", "Lowercase"] and split.get("invert") is True
                and split.get("pattern", {}).get("Regex")
                == "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
                and spec["model"].get("dropout") is None)

    def _whole_ids(self, text: str) -> list[int]:
        return self.whole.encode(text, add_special_tokens=False).ids

    def _piece(self, piece: str) -> list[int]:
        if piece.startswith(self._WHOLE):
            return self._whole_ids(piece[1:])
        return [t.id for t in self.model.tokenize(piece if piece.isascii() else self.to_bytes(piece))]

    def pieces(self, text: str) -> list[str]:
        """What the ids of a text are looked up by."""
        if self._PLAIN_TEXT.fullmatch(text) and "<|" not in text:
            return self._PIECE.findall(text.lower())
        out: list[str] = []
        for word in WORD.findall(text):
            if "<|" not in word and self._PLAIN.fullmatch(word):
                out += self._PIECE.findall(word.lower())
            else:
                out.append(self._WHOLE + word)
        return out

    def encode_column(self, texts: list[str | None], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ends, ids): all ids of the texts, each closed by ``end_id``, and where each ends."""
        if not self.steady:
            parts = [np.array([*(self._whole_ids(t) if t else ()), end_id], dtype="<u4") for t in texts]
            return np.cumsum([len(p) for p in parts]), np.concatenate([*parts, np.zeros(0, "<u4")])
        if len(self.codes) >= _REMEMBERED:
            self.codes = _Codes(self._piece)
        flat, upto_text = [], []
        for t in texts:
            flat += self.pieces(t) if t else ()
            upto_text.append(len(flat))
        # Arrow finds the distinct pieces, far fewer, faster than a Python dictionary
        distinct = pa.array(flat, pa.string()).dictionary_encode()
        del flat
        known = distinct.dictionary.to_pylist()
        codes = np.fromiter(map(self.codes.__getitem__, known), dtype=np.int64, count=len(known))[
            distinct.indices.to_numpy(zero_copy_only=False)]
        pool, starts = np.array(self.codes.pool, dtype="<u4"), np.array(self.codes.starts)
        each = (starts[1:] - starts[:-1])[codes]
        upto = np.concatenate([[0], np.cumsum(each)])
        found = pool[np.repeat(starts[codes] - upto[:-1], each) + np.arange(upto[-1])]
        ends = upto[np.array(upto_text, dtype=np.int64)] + np.arange(1, len(texts) + 1)
        out = np.full(len(found) + len(texts), end_id, dtype="<u4")
        free = np.ones(len(out), dtype=bool)
        free[ends - 1] = False
        out[free] = found
        return ends, out


_TOKENIZERS: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """One a worker process, so that remembered words serve all its tasks."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


class _Packer:
    """Ids as compressed bytes, in two bytes an id where all of a document's fit."""

    def __init__(self) -> None:
        self.compress = zstandard.ZstdCompressor(1).compress
        self.decompress = zstandard.ZstdDecompressor().decompress

    def pack(self, ids: np.ndarray) -> bytes:
        small = not len(ids) or ids.max() < 1 << 16
        return (b"\2" if small else b"\4") + self.compress(ids.astype("<u2" if small else "<u4").tobytes())

    def unpack(self, packed: bytes) -> np.ndarray:
        body = self.decompress(packed[1:])
        return np.frombuffer(body, dtype="<u2" if packed[0] == 2 else "<u4").astype(np.int64)


def tokenized(docs: DataFrame, path: str, end_id: int, doc_id: str = "doc_id",
              text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids: packed bytes), the end id appended; and one row a task that
    has ``counts`` instead: packed, each id's number in the task's documents."""
    kind = docs.schema[doc_id].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, packer, total = tokenizer(path), _Packer(), np.zeros(0, dtype=np.int64)
        names = ["doc_id", "n_tokens", "ids", "counts"]
        for batch in slices(batches, text, 4 << 20):
            ends, ids = enc.encode_column(column(batch, text), end_id)
            got = np.bincount(ids, minlength=len(total))
            got[:len(total)] += total
            total = got
            starts = np.concatenate([[0], ends])
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(doc_id)), pa.array(np.diff(starts)),
                 pa.array([packer.pack(ids[a:b]) for a, b in zip(starts[:-1], ends)], pa.binary()),
                 pa.nulls(len(ends), pa.binary())], names=names)
        seen = np.flatnonzero(total)
        packed = packer.compress(np.stack([seen, total[seen]]).astype("<i8").tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(1, to_arrow_type(kind)), pa.array([0], pa.int64()), pa.nulls(1, pa.binary()),
             pa.array([packed], pa.binary())], names=names)

    return docs.select(doc_id, text).mapInArrow(
        run, f"doc_id {kind.simpleString()}, n_tokens long, ids binary, counts binary")


# ------------------------------------------------------------------- the code

def code_lengths(counts: dict[int, int], max_bits: int = MAX_BITS) -> dict[int, int]:
    """Optimal code lengths of at most ``max_bits`` bits, by package-merge.

    The coins of a symbol with count c are worth c at each level; the 2n - 2
    cheapest packages of the last level hold a symbol as often as its code has
    bits.
    """
    symbols = sorted((c, s) for s, c in counts.items() if c > 0)
    n = len(symbols)
    if n == 1:
        return {symbols[0][1]: 1}
    if n > 1 << max_bits:
        raise ValueError(f"{n} ids don't fit codes of {max_bits} bits")
    weights = np.array([c for c, _ in symbols], dtype=np.int64)
    # each level: which sorted positions are single coins (True) and which packages
    levels, packages = [], np.empty(0, dtype=np.int64)
    for _ in range(max_bits):
        merged = np.concatenate([weights, packages])
        order = np.argsort(merged, kind="stable")
        levels.append(order < n)
        ranked = merged[order]
        even = len(ranked) // 2 * 2
        packages = ranked[0:even:2] + ranked[1:even:2]
    lengths = np.zeros(n, dtype=np.int64)
    take = 2 * n - 2
    for single in reversed(levels):  # from the last level back
        coins = int(single[:take].sum())
        lengths[:coins] += 1  # coins come in ascending order of weight
        take = 2 * (take - coins)
    return {s: int(b) for (_, s), b in zip(symbols, lengths)}


class Code:
    """Canonical codes from lengths: shorter first, then by id."""

    def __init__(self, lengths: dict[int, int]) -> None:
        pairs = sorted((b, s) for s, b in lengths.items())
        self.ids = np.array([s for _, s in pairs], dtype=np.int64)
        self.bits = np.array([b for b, _ in pairs], dtype=np.int64)
        self.width = int(self.bits.max()) if len(pairs) else 1
        steps = np.left_shift(1, self.width - self.bits)
        starts = np.concatenate([[0], np.cumsum(steps)[:-1]]) if len(pairs) else steps
        self.codes = starts >> (self.width - self.bits)
        top = int(self.ids.max()) + 1 if len(pairs) else 0
        self.code_of, self.bits_of = np.zeros(top, np.int64), np.zeros(top, np.int64)
        self.code_of[self.ids], self.bits_of[self.ids] = self.codes, self.bits
        # tables: the next ``width`` bits -> id and bits of the code that they start with
        room = (1 << self.width) - int(steps.sum())
        self.table_ids = np.pad(np.repeat(self.ids, steps), (0, room))
        self.table_bits = np.pad(np.repeat(self.bits, steps), (0, room))

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """(packed bits, bit offset of every CHECKPOINT-th id)."""
        bits = self.bits_of[ids]
        ends = np.cumsum(bits)
        starts = ends - bits
        total = int(ends[-1]) if len(ids) else 0
        # a code lies within four bytes from the byte in which it starts
        word = self.code_of[ids] << (32 - bits - (starts & 7))
        at, size = starts >> 3, (total + 7) // 8 + 4
        out = np.zeros(size, dtype=np.uint8)
        for k in range(4):
            part = (word >> (24 - 8 * k)) & 0xFF
            out += np.bincount(at + k, weights=part, minlength=size).astype(np.uint8)
        return out[:(total + 7) // 8].tobytes(), starts[::CHECKPOINT]

    def decode(self, packed: bytes, checkpoints: np.ndarray, n: int) -> np.ndarray:
        raw = np.concatenate([np.frombuffer(packed, dtype=np.uint8),
                              np.zeros(8, dtype=np.uint8)]).astype(np.int64)
        words = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
        lanes = len(checkpoints)
        out = np.zeros((CHECKPOINT, lanes), dtype=np.int64)
        at, mask = np.asarray(checkpoints, dtype=np.int64).copy(), (1 << self.width) - 1
        last = n - (lanes - 1) * CHECKPOINT  # ids of the last stretch
        for k in range(CHECKPOINT if lanes > 1 else last):
            if k == last:
                at = at[:-1]
            code = (words[at >> 3] >> (32 - self.width - (at & 7))) & mask
            out[k, :len(at)] = self.table_ids[code]
            at += self.table_bits[code]
        return out.T.reshape(-1)[:n]


def code_from_counts(counts: DataFrame, max_bits: int = MAX_BITS) -> Code:
    rows = counts.collect()  # one row an id of the vocabulary at most
    return Code(code_lengths({r["id"]: r["count"] for r in rows}, max_bits))


# --------------------------------------------------------------------- files

def id_counts(tokens: DataFrame) -> DataFrame:
    """(id, count) over all documents, from the tasks' own counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer()
        for batch in batches:
            for packed in column(batch, "counts"):
                ids, counts = np.frombuffer(packer.decompress(packed), dtype="<i8").reshape(2, -1)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(counts)],
                                                 names=["id", "count"])

    return tokens.where("counts is not null").select("counts").mapInArrow(
        run, "id long, count long").groupBy("id").agg(F.sum("count").alias("count"))


_BLOCK = ("shard int, block long, first_token long, n_tokens long, doc_ids array<{kind}>, "
          "doc_tokens array<long>, checkpoints array<long>, bits binary")


def encoded_blocks(tokens: DataFrame, code, kind: DataType, block_tokens: int) -> DataFrame:
    """Blocks of whole documents from range-partitioned, sorted rows."""
    types = pa.schema([("shard", pa.int32()), ("block", pa.int64()), ("first_token", pa.int64()),
                       ("n_tokens", pa.int64()), ("doc_ids", pa.list_(to_arrow_type(kind))),
                       ("doc_tokens", pa.list_(pa.int64())),
                       ("checkpoints", pa.list_(pa.int64())), ("bits", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        shard, block, first = TaskContext.get().partitionId(), 0, 0
        unpack = _Packer().unpack
        ids: list = []
        parts: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal ids, parts, held, block, first
            whole = np.concatenate(parts)
            bits, checks = code.value.encode(whole)
            row = {"shard": shard, "block": block, "first_token": first, "n_tokens": held,
                   "doc_ids": ids, "doc_tokens": [len(p) for p in parts],
                   "checkpoints": checks.tolist(), "bits": bits}
            block, first, ids, parts, held = block + 1, first + held, [], [], 0
            return pa.RecordBatch.from_pylist([row], schema=types)

        for batch in batches:
            for d, packed in zip(column(batch, "doc_id"), column(batch, "ids")):
                ids.append(d)
                parts.append(unpack(packed))
                held += len(parts[-1])
                if held >= block_tokens:
                    yield flush()
        if parts:
            yield flush()

    return tokens.select("doc_id", "ids").mapInArrow(run, _BLOCK.format(kind=kind.simpleString()))


def write_tokens(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 1,
                 doc_id: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS,
                 block_tokens: int = BLOCK_TOKENS) -> str:
    """Write the corpus under ``folder`` (a path that all executors share)."""
    kind = docs.schema[doc_id].dataType
    tokens = checkpointed(tokenized(docs, tokenizer_path, end_id, doc_id, text))
    counts = checkpointed(id_counts(tokens))
    code = code_from_counts(counts, max_bits)
    spark = docs.sparkSession
    lengths = spark.createDataFrame(
        [(int(i), int(b)) for i, b in zip(code.ids, code.bits)], "id long, bits int")
    counts.join(lengths, "id").orderBy("id").write.parquet(f"{folder}/code")
    shared = spark.sparkContext.broadcast(code)
    ordered = tokens.where("ids is not null").withColumn("__h", F.xxhash64("ids")).repartitionByRange(
        F.col("doc_id").asc_nulls_first(), "__h").sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), "__h")
    encoded_blocks(ordered, shared, kind, block_tokens).write.parquet(f"{folder}/blocks")
    blocks = spark.read.parquet(f"{folder}/blocks")
    totals = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n_tokens"))
    before = F.coalesce(F.sum("n_tokens").over(
        Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    totals.select("shard", before.cast("long").alias("first_token"), "n_tokens").write.parquet(
        f"{folder}/shards")
    return folder


def read_code(spark: SparkSession, folder: str) -> Code:
    rows = spark.read.parquet(f"{folder}/code").select("id", "bits").collect()
    return Code({r["id"]: r["bits"] for r in rows})


def decode_rows(batch: pa.RecordBatch, code: Code) -> Iterator[tuple]:
    """(doc_id, ids before it in the corpus, ids) of every document of the blocks."""
    for r in batch.to_pylist():
        ids = code.decode(r["bits"], np.array(r["checkpoints"], dtype=np.int64), r["n_tokens"])
        at = 0
        for d, n in zip(r["doc_ids"], r["doc_tokens"]):
            yield d, r["before"] + at, ids[at:at + n]
            at += n


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the files."""
    code = spark.sparkContext.broadcast(read_code(spark, folder))
    blocks = spark.read.parquet(f"{folder}/blocks")
    shards = spark.read.parquet(f"{folder}/shards").select(
        "shard", F.col("first_token").alias("shard_first"))
    # one row a shard, far fewer than blocks
    placed = blocks.join(shards, "shard").withColumn(
        "before", F.col("shard_first") + F.col("first_token"))
    kind = blocks.schema["doc_ids"].dataType.elementType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows = [(d, start, len(ids), crc(ids.astype("<u4").tobytes()))
                        for d, start, ids in decode_rows(batch.slice(i, 1), code.value)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), to_arrow_type(kind) if n == 0 else pa.int64())
                     for n, c in enumerate(zip(*rows))],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return placed.select("before", "n_tokens", "doc_ids", "doc_tokens", "checkpoints",
                         "bits").mapInArrow(
        run, f"doc_id {kind.simpleString()}, start long, n_tokens long, ids_crc32 long")
