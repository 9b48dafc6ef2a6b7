"""BPE against the tokenizers library."""

import hashlib
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vitrine.llm import bpe
from vitrine.llm.queries import op5_bpe, vocabulary_path

ODD = [
    "a", "b", "the", " ", "  ", "\n", "\x1c", "\x85", "\xa0", "É", "ß", "İ", "ŉ", "Σ", "ς", "'S", "'s", "’s", "1", "²",
    "½", "日本", "ﬁ", "Å", "́", "🎉", "<|endoftext|>", "<|startoftext|>", "<|END", "|>", "\0", "_", "--", "!!",
    "Ɓ", "aaaa", "ſ", "ẞ", "\U0001d7d8", "'ll", "\x7f", "K",
]


@pytest.fixture(scope="module")
def library():
    out = Tokenizer.from_file(vocabulary_path())
    out.no_truncation()
    out.no_padding()
    return out


def ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


def test_odd_texts(library):
    random.seed(3)
    texts = ["".join(random.choices(ODD, k=random.randint(0, 12))) for _ in range(4000)]
    texts += [f"x{chr(c)}y{chr(c)}" for c in range(0x600) if not 0xD800 <= c < 0xE000]
    got = bpe.Encoder(vocabulary_path()).encode(texts)
    assert [ids(x) for x in got] == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]


def test_query_equals_library(spark, data, library):
    rows = {r.doc_id: r for r in op5_bpe(spark, data).collect()}
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(docs)
    for doc in docs:
        want = library.encode(doc.text or "", add_special_tokens=False).ids
        row = rows[doc.doc_id]
        assert row.n_tokens == len(want)
        assert row.ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        text = library.decode(want, skip_special_tokens=False)
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_edges(spark):
    df = spark.createDataFrame(
        [(1, None, "x"), (2, "", "y"), (2, "", "y"), (None, "word " * 50_000, None)], "doc_id long, text string, ids string"
    )
    path = vocabulary_path()
    out = bpe.decode(bpe.encode(df, path), path).withColumn("list", bpe.unpack(F.col("ids"))).collect()
    assert len(out) == 4 and "text" in out[0].asDict()
    by = {r.doc_id: r for r in out}
    assert by[1].decoded == "" and by[1].ids == b"" and by[2].decoded == ""
    assert len(by[None].list) == 50_000 and by[None].list == ids(by[None].ids)
    assert bpe.encode(df.limit(0), path).count() == 0


def test_unknown_ids_are_skipped(spark):
    packed = np.array([320, 49_999_999, 320], "<u4").tobytes()
    df = spark.createDataFrame([(bytearray(packed),), (None,)], "ids binary")
    got = [r.decoded for r in bpe.decode(df, vocabulary_path()).collect()]
    assert got[0] == " ".join([Tokenizer.from_file(vocabulary_path()).id_to_token(320)] * 2) and got[1] == ""


def test_merges_out_of_order(tmp_path):
    """A file whose merges use parts made later: single places at a time, as the library does."""
    with open(vocabulary_path(), encoding="utf-8") as file:
        data = json.load(file)
    letters = bpe.byte_letters()
    vocab = {c: i for i, c in enumerate([*letters, *[c + "</w>" for c in letters]])}
    merges = [["ab", "ab"], ["a", "b"], ["b", "a"]]
    for left, right in merges:
        vocab.setdefault(left, len(vocab))
        vocab.setdefault(left + right, len(vocab))
    data["model"] |= {"vocab": vocab, "merges": merges}
    data["added_tokens"] = []
    path = tmp_path / "v.json"
    path.write_text(json.dumps(data))
    encoder, library = bpe.Encoder(str(path)), Tokenizer.from_file(str(path))
    assert not encoder.index.ordered
    random.seed(1)
    texts = ["".join(random.choices("ab ", k=14)) for _ in range(200)]
    assert [ids(x) for x in encoder.encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]
