"""Byte-level BPE against the tiktoken library on whole texts."""

import base64
import hashlib
import random

import numpy as np
import pytest
import tiktoken

from vitrine.llm import bytebpe
from vitrine.llm.queries import byte_ranks, op11_bytebpe

ODD = [
    "a", "B", "the", " ", "  ", "\n", "\r\n", "\t", "\x1c", "\x85", "\xa0", chr(0x2003), chr(0x3000), "É", "ß", "'", "'s", "'S", "'ll",
    "n't", "1", "22", "²", "½", "日本", "。", "🎉", "<|endoftext|>", "_", "--", "!!", "'re", "\0", "\x7f", chr(0x301), ".",
]


@pytest.fixture(scope="module")
def library():
    path, pattern = byte_ranks()
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("whole", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def coder():
    return bytebpe.ByteCoder(*byte_ranks())


def ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


def test_every_size_of_chunk_gives_the_same_ids(library, coder, monkeypatch):
    random.seed(5)
    texts = ["".join(random.choices(ODD, k=random.randint(0, 30))) for _ in range(3000)]
    for size in (1, 3, 10):
        for text in texts:
            pieces = list(bytebpe.chunks(text, size))
            assert "".join(pieces) == text
            assert [i for p in pieces for i in library.encode_ordinary(p)] == library.encode_ordinary(text), (text, pieces)
    for text in texts:
        packed = coder.encode(text)
        assert ids(packed) == library.encode_ordinary(text) and coder.decode(packed) == text.encode()


def test_long_texts(library, coder):
    for text in ("word, it's 12 " * 60_000, "x" * 300_000, " " * 300_000, " " * 300_000 + "x", "日本語" * 60_000, "a1" * 200_000):
        packed = coder.encode(text)
        assert coder.decode(packed) == text.encode()
        assert ids(packed) == library.encode_ordinary(text)
    assert max(map(len, bytebpe.chunks("word, it's 12 " * 60_000))) <= bytebpe.CHUNK + 16


def test_query_equals_library(spark, data, library):
    rows = {r.doc_id: r for r in op11_bytebpe(spark, data).collect()}
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(docs)
    for doc in docs:
        want = library.encode_ordinary(doc.text or "")
        row = rows[doc.doc_id]
        assert row.n_tokens == len(want)
        assert row.ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode_bytes(want)).hexdigest()


def test_edges(spark, library):
    df = spark.createDataFrame(
        [(1, None, "x"), (2, "", "y"), (2, "", "y"), (None, "long text " * 50_000, None)],
        "doc_id long, text string, ids string",
    )
    ranks = byte_ranks()
    out = bytebpe.decode(bytebpe.encode(df, *ranks), *ranks).collect()
    assert len(out) == 4 and set(out[0].asDict()) == {"doc_id", "text", "ids", "decoded"}
    by = {r.doc_id: r for r in out}
    assert by[1].ids == b"" and by[1].decoded == b"" and by[2].ids == b""
    assert by[None].decoded.decode() == by[None].text and ids(by[None].ids) == library.encode_ordinary(by[None].text)
    both = bytebpe.round_trip(df, *ranks)
    assert sorted(map(repr, both.select("doc_id", "ids", "decoded").collect())) == sorted(
        repr(r) for r in bytebpe.decode(bytebpe.encode(df, *ranks), *ranks).select("doc_id", "ids", "decoded").collect()
    )
    assert bytebpe.encode(df.limit(0), *ranks).count() == 0


def test_unknown_ids_are_skipped(spark, library):
    packed = np.array([320, 49_999_999, 50_256, 320], "<u4").tobytes()
    df = spark.createDataFrame([(bytearray(packed),), (None,)], "ids binary")
    got = [bytes(r.decoded) for r in bytebpe.decode(df, *byte_ranks()).collect()]
    assert got == [library.decode_bytes([320, 320]), b""]


def test_a_character_may_be_cut(coder, library):
    first = ids(coder.encode("🎉"))[:1]
    assert coder.decode(np.array(first, "<u4").tobytes()) == library.decode_bytes(first)
    with pytest.raises(UnicodeDecodeError):
        library.decode_bytes(first).decode()
