"""Tokenising by words, Huffman codes, block files: exact round trips."""

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from nextbest.llm import token_huffman as th
from nextbest.llm.token_query import END_ID, default_tokenizer, op7_token_files, token_files
from tests.conftest import SF_SMALL

PATH = default_tokenizer()
WHOLE = Tokenizer.from_file(PATH)
ENC = th.WordTokenizer(PATH)


def plain_ids(text):
    return WHOLE.encode(text or "", add_special_tokens=False).ids


def plain_rows(rows):
    """(doc_id, start, n_tokens, crc) by one pass over sorted rows."""
    out, start = [], 0
    for d, text in sorted(rows, key=lambda r: r[0]):
        ids = plain_ids(text) + [END_ID]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def word_ids(text):
    return ENC.encode_column([text], END_ID)[1].tolist()[:-1]


@pytest.mark.parametrize("text", [
    "", " ", "Hello, World's best--'s don't 12,345!", "ÀÉÎÕÜ ßtraße Ŀ ŉ ſ İstanbul ıI ΣΑΣ ΌΣ",
    "<|endoftext|> a<|startoftext|>b <|endof text|>", "a\x1cb\x1fc \x85x\xa0y z", "é ́x",
    "각 中文 字 🎉🎉 ²³¼ ªº µ", "nbsp  　z", "x​y﻿\x00\x07"])
def test_words_give_the_whole_texts_ids(text):
    assert word_ids(text) == plain_ids(text)


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n\t'’<|>ÀéŉſİΣς\x1c\x85")),
               max_size=60))
def test_words_give_any_texts_ids(text):
    assert word_ids(text) == plain_ids(text)


ODD_TEXTS = [None, "", " ", "a b  c\n", "Hello, World's", None, "x\x0by\x0cz \x1cq\x85r\xa0s t",
             "<|endoftext|> 12", "é ́x \u2028y", "a"]


def test_a_columns_ids_are_its_texts_ids():
    for texts in (ODD_TEXTS, ODD_TEXTS[1:2], ODD_TEXTS[:1], ["b"]):
        ends, ids = ENC.encode_column(texts, END_ID)
        starts = [0, *ends.tolist()]
        got = [ids[a:b].tolist() for a, b in zip(starts, starts[1:])]
        assert got == [plain_ids(t) + [END_ID] for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n\t'<|>\x1c\x85")),
                        max_size=30), max_size=5))
def test_any_columns_ids_are_its_texts_ids(texts):
    ends, ids = ENC.encode_column(texts, END_ID)
    assert ids.tolist() == [i for t in texts for i in [*plain_ids(t), END_ID]]


def test_lengths_are_limited_and_optimal():
    counts = {i: 2 ** i for i in range(12)}  # unlimited Huffman needs 11 bits
    for limit in (4, 6, 11, 15):
        lengths = th.code_lengths(counts, limit)
        assert max(lengths.values()) <= limit
        assert sum(2.0 ** -b for b in lengths.values()) == 1
    assert sorted(th.code_lengths(counts, 15).values()) == [*range(1, 12), 11]
    assert th.code_lengths({7: 3}) == {7: 1} and th.code_lengths({}) == {}
    with pytest.raises(ValueError):
        th.code_lengths({i: 1 for i in range(5)}, 2)


def test_limited_lengths_cost_what_a_search_finds():
    counts = [1, 1, 2, 9, 30, 100]
    best = min(sum(c * b for c, b in zip(counts, bits)) for bits in _all_lengths(6, 4))
    got = th.code_lengths(dict(enumerate(counts)), 4)
    assert sum(counts[s] * b for s, b in got.items()) == best


def _all_lengths(n, limit):
    def grow(prefix, room):
        if len(prefix) == n:
            if room >= 0:
                yield prefix
            return
        for b in range(1, limit + 1):
            if room - 2.0 ** -b >= 0:
                yield from grow([*prefix, b], room - 2.0 ** -b)
    return grow([], 1.0)


@pytest.mark.parametrize("n", [1, 2, 63, 64, 65, 128, 5000])
def test_block_round_trip(n):
    rng = random.Random(n)
    ids = np.array([int(rng.paretovariate(0.7)) % 40000 for _ in range(n)], dtype=np.int64)
    counts = dict(zip(*(x.tolist() for x in np.unique(ids, return_counts=True))))
    code = th.Code(th.code_lengths(counts))
    bits, checks = code.encode(ids)
    assert (code.decode(bits, checks, n) == ids).all()


def test_query_equals_a_plain_pass(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = sorted((tuple(r) for r in op7_token_files(spark, SF_SMALL).collect()), key=lambda r: r[1])
    assert got == plain_rows(rows)


def test_odd_rows(spark):
    rows = [(3, None, "a"), (1, "", "b"), (1, "One two", "c"), (1, "One two", "c"),
            (None, "x", None), (2, "long " * 40000, "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sorted((tuple(r) for r in token_files(docs).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [None, 1, 1, 1, 2, 3]
    assert [r[2] for r in got][-2:] == [40001, 1]
    assert [r[1] for r in got] == np.cumsum([0] + [r[2] for r in got])[:-1].tolist()
    assert sorted(r[2] for r in got[1:4]) == [1, 3, 3]
    assert token_files(docs.limit(0)).collect() == []


@pytest.mark.parametrize("kind", ["smallint", "decimal(10,2)", "date", "string"])
def test_ids_of_any_ordered_type(spark, kind):
    docs = spark.createDataFrame([(f"200{n}-01-0{n}" if kind == "date" else str(n), f"word {n}", n, n)
                                  for n in (3, 1, 2)], "doc_id string, text string, start int, counts int")
    docs = docs.withColumn("doc_id", docs.doc_id.cast(kind))
    got = token_files(docs)
    assert got.schema["doc_id"].dataType == docs.schema["doc_id"].dataType
    rows = sorted((tuple(r) for r in got.collect()), key=lambda r: r[1])
    assert [r[0] for r in rows] == sorted(r.doc_id for r in docs.collect())
    assert [r[2] for r in rows] == [3, 3, 3]
