"""BPE by chunks against the tokenizers library."""

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cohortalloc.llm import bpe_chunks as B

PATHS = [public_tokenizers.path(f"byte_bpe_50k.{k}") for k in ("json", "tiktoken")]
TOK = Tokenizer.from_file(PATHS[0])
SIGNS = ["a", "b", "'", "s", "re", " ", "  ", "\n", "\t", "1", "23", "!", "é", "ß", "中", "😀", "́", "<|endoftext|>",
         "'ll", "don't", " x", "\x85", " ", "\x1c", "²", "ª", " the", " of"]


@pytest.mark.parametrize("mask,least,most", [(511, 128, 4096), (7, 1, 9), (1, 1, 3)])
def test_chunks_join_to_the_library_ids(monkeypatch, mask, least, most):
    monkeypatch.setattr(B, "CUT_MASK", mask)
    monkeypatch.setattr(B, "LEAST_CHUNK", least)
    monkeypatch.setattr(B, "MOST_CHUNK", most)
    rnd = random.Random(mask)
    texts = ["".join(rnd.choice(SIGNS) for _ in range(rnd.randint(0, 300))) for _ in range(300)]
    texts += ["a" * 9000, " " * 5000 + "b", "ab " * 4000, "\n" * 999 + "x", "é" * 5000, ""]
    encoder = B.ChunkEncoder(*PATHS)
    got = encoder.encode(texts)
    want = [e.ids for e in TOK.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u2").tolist() for x in got] == want
    assert [encoder.decode(x) for x in got] == [TOK.decode(w, skip_special_tokens=False) for w in want]
    assert all("".join(B.chunks(t)) == t for t in texts)


def test_shared_passages_share_chunks():
    rnd = random.Random(4)
    passage = " ".join("".join(rnd.choices("etaoinsh", k=5)) for _ in range(3000))
    one, two = B.chunks("start one " + passage), B.chunks("another beginning here " + passage)
    assert len(set(one) & set(two)) > 0.8 * min(len(one), len(two))


def test_edge_cases(make_docs):
    docs = make_docs([(1, None), (None, ""), (2, "x y"), (2, "x y"), (3, "z " * 50_000)])
    rows = B.digests(B.encode_texts(docs, *PATHS, decode=True)).collect()
    assert sorted(r.n_tokens for r in rows) == [0, 0, 2, 2, len(TOK.encode("z " * 50_000).ids)]
    assert B.encode_texts(make_docs([]), *PATHS).count() == 0
    back = B.decode_ids(B.encode_texts(docs, *PATHS), *PATHS).collect()
    assert sorted((r.decoded for r in back), key=len)[:2] == ["", ""]


def test_registered_query_equals_the_library(spark):
    import hashlib

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    ids = [e.ids for e in TOK.encode_batch([r.text or "" for r in docs], add_special_tokens=False)]
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    want = sorted((r.doc_id, len(x), sha(",".join(map(str, x))), sha(TOK.decode(x, skip_special_tokens=False)))
                  for r, x in zip(docs, ids))
    got = B.op9_bpe_chunks(spark, folder).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(tuple, got)) == want
