"""Token files: against the tokenizers library, exact round trips, edge cases."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cohortalloc.llm import token_file as T

PATH = public_tokenizers.path("word_bpe_49k.json")
HARD = [
    "", None, "   ", "Don't STOP", "a\x1cb\x1dc", "é É ß ÿ × ÷ µ", "ΑΣ ς İ", "x<|endoftext|>y <|startoftext|>",
    "中文 テスト 😀", "a.b,c...d", "1234 ²", "word " * 5000, "x" * 3000, "é   z", "'s 're I'll",
]


def expected(texts):
    tok = Tokenizer.from_file(PATH)
    return [e.ids + [2] for e in tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def result(docs):
    files, lengths = T.write_token_files(docs, PATH, end_id=2)
    return T.with_checksums(T.read_token_files(files, lengths)).collect()


def test_pieces_encode_like_the_whole_text():
    got = T.PieceEncoder(PATH).encode([t or "" for t in HARD])
    assert [np.frombuffer(x, "<u2").tolist() + [2] for x in got] == expected(HARD)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=4))
def test_any_text_encodes_like_the_library(texts):
    got = _ENCODER.encode(texts)
    assert [np.frombuffer(x, "<u2").tolist() + [2] for x in got] == expected(texts)


_ENCODER = T.PieceEncoder(PATH)


def test_files_hold_every_document_in_order(make_docs):
    ids = [7, 3, 100, 50, 2, 900, 11, 12, 13, 14, 15, 16, 17, 18, 19]
    rows = sorted(result(make_docs(list(zip(ids, HARD)))))
    start = 0
    for row, (doc_id, want) in zip(rows, sorted(zip(ids, expected(HARD))), strict=True):
        crc = zlib.crc32(np.array(want, "<u4").tobytes())
        assert tuple(row) == (doc_id, start, len(want), crc)
        start += len(want)


def test_null_and_repeated_keys_all_stay(make_docs):
    rows = result(make_docs([(None, "b"), (1, "a"), (1, "a"), (1, "c"), (None, None)]))
    assert sorted(r.start for r in rows if r.doc_id is None)[0] == 0
    assert len(rows) == 5 and sum(r.n_tokens for r in rows) == 9
    ends = sorted((r.start, r.start + r.n_tokens) for r in rows)
    assert all(a[1] == b[0] for a, b in zip(ends, ends[1:]))


def test_empty_table(make_docs):
    assert result(make_docs([])) == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3000), max_size=2000), st.integers(12, 18))
def test_blocks_round_trip(ids, bits):
    ids = np.array(ids, "<u2")
    lengths = T.code_lengths(np.bincount(ids, minlength=3001), bits)
    if not len(ids):
        return
    assert lengths.max() <= bits and sum(2.0 ** -int(x) for x in lengths if x) <= 1
    blob = T.make_blob([5], [ids.tobytes()], T.canonical_codes(lengths), lengths)
    doc_ids, counts, got = T.read_blob(blob, T.decode_table(lengths))
    assert (doc_ids, counts.tolist(), got.tolist()) == ([5], [len(ids)], ids.tolist())


def test_code_lengths_are_optimal_and_limited():
    assert sorted(T.code_lengths(np.array([1, 1, 2, 4, 8]), 10).tolist()) == [1, 2, 3, 4, 4]
    assert sorted(T.code_lengths(np.array([1, 1, 2, 4, 8]), 3).tolist()) == [1, 3, 3, 3, 3]
    assert T.code_lengths(np.array([0, 9, 0])).tolist() == [0, 1, 0]
    with pytest.raises(ValueError):
        T.code_lengths(np.ones(9), 3)


def test_tables_of_words_turn_over(monkeypatch):
    monkeypatch.setattr(T, "CACHE_PIECES", 3)
    enc = T.PieceEncoder(PATH)
    for text in [*filter(None, HARD), *filter(None, HARD)]:
        assert np.frombuffer(enc.encode([text])[0], "<u2").tolist() + [2] == expected([text])[0]


def test_registered_query_equals_the_library(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    got = sorted(map(tuple, T.op5_token_file(spark, folder).collect()))
    want, start = [], 0
    for row, ids in zip(docs, expected([r.text for r in docs])):
        want.append((row.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want
