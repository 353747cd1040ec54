import base64

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from panelcast.llm import byte_bpe
from tests.llm import brute
from tests.llm.conftest import documents

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def texts(rng, prose, odd_texts):
    alphabets = ["a", "ab", "abcdefghijklmnopqrstuvwxyz", "éèß日本語の", "0123456789", "!?-=", " \n", "aA1 '!"]
    return [*odd_texts, prose(300), *["".join(rng.choices(a, k=n)) for a in alphabets for n in (1, 2, 7, 40, 255, 256, 257, 700, 4000)]]


def test_ids_and_round_trip(spark, texts, reference):
    done = byte_bpe.decode(byte_bpe.encode(documents(spark, list(enumerate(texts))), PATH, P.PATTERN), PATH).collect()
    for r in done:
        text = texts[r.doc_id] or ""
        assert list(r.ids) == reference.encode_ordinary(text)
        assert r.n_tokens == len(r.ids) and r.decoded == text


def test_digests(spark, texts, reference):
    for r in byte_bpe.round_trip_digests(documents(spark, list(enumerate(texts))), PATH, P.PATTERN).collect():
        ids = np.array(reference.encode_ordinary(texts[r.doc_id] or ""), "<u4")
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), brute.sha(ids.tobytes()), brute.sha(texts[r.doc_id] or ""))


def test_empty_table_and_clash(spark):
    df = documents(spark, [(1, "a b")]).selectExpr("*", "'x' AS n_tokens")
    out = byte_bpe.encode(df, PATH, P.PATTERN)
    assert out.columns.count("n_tokens") == 1 and out.first().n_tokens == 2
    assert byte_bpe.encode(documents(spark, []), PATH, P.PATTERN).count() == 0
    assert byte_bpe.decode(spark.createDataFrame([(None,), ([],)], "ids array<int>"), PATH).select("decoded").collect() == [("",), ("",)]
