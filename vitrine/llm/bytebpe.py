"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

A text is cut by the splitting pattern, and every match is merged by the ranks on its own;
no special tokens exist.  Long texts are cut beforehand, at the next safe boundary after
``CHUNK`` code points: a place where a match ends and the next one starts whatever stands
around it, so the ids do not depend on ``CHUNK``.  Ids are decoded to raw bytes, since a token
may hold a part of a character.

Defined cases: NULL and empty texts give no ids and no bytes; NULL ids decode to no bytes;
an id outside the rank file is skipped in decoding; repeated rows are encoded alike; other
columns pass through, and a column that has the name of a result is replaced by it.
"""

from __future__ import annotations

import base64
import re

import numpy as np
from pyspark.sql import DataFrame

from vitrine.llm.common import per_text

CHUNK = 1 << 16
SLICE = 3 << 20
# The characters that ``\s`` stands for in the splitting pattern.
BLANK = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# A match holds no blank after another character, and not both a letter and a digit; only
# an apostrophe is held together with letters after it; of a run of blanks before
# other text the last one stands apart.  Beyond blanks only ASCII is judged, as the
# classes of other characters differ between Unicode versions.
SAFE = re.compile(
    rf"(?<=[^{BLANK}])(?=[{BLANK}])|(?<=[{BLANK}])(?=[{BLANK}][^{BLANK}])"
    r"|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])"
    r"|(?<=[A-Za-z0-9])(?=[!-/:-@\[-`{-~])|(?<=[!-&(-/:-@\[-`{-~])(?=[A-Za-z0-9])"
)


def chunks(text: str, size: int = CHUNK):
    """Pieces of a text that are encoded alike alone and together."""
    start = 0
    while len(text) - start > size:
        found = SAFE.search(text, start + size)
        if found is None:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:] if start else text


class ByteCoder:
    """Texts to packed ids and packed ids to bytes; one per task."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as file:
            pairs = [line.split() for line in file if line.strip()]
        ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.encoding = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.known = np.zeros(max(ranks.values()) + 1, bool)
        self.known[list(ranks.values())] = True

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        coded = self.encoding.encode_to_numpy
        return b"".join([coded(piece, disallowed_special=()).astype("<u4").tobytes() for piece in chunks(text)])

    def decode(self, ids: bytes | None) -> bytes:
        numbers = np.frombuffer(ids or b"", "<u4")
        numbers = numbers[numbers < len(self.known)]
        return self.encoding.decode_bytes(numbers[self.known[numbers]].tolist())


def _step(docs, column, made, schema, path, pattern, keep, work):
    def make():
        coder = ByteCoder(path, pattern)
        return lambda values: work(coder, values)

    keep = [c for c in (docs.columns if keep is None else keep) if c not in made]
    return per_text(docs, column, schema, make, keep, False, SLICE)


def encode(
    docs: DataFrame, path: str, pattern: str, text_col: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """``docs`` (columns ``keep``, default all) with ``ids``, packed.

    ``path`` names the rank file on the executors.
    """
    def work(coder, texts):
        return {"ids": [coder.encode(t) for t in texts]}

    return _step(docs, text_col, ("ids",), "ids binary", path, pattern, keep, work)


def decode(
    encoded: DataFrame, path: str, pattern: str, ids_col: str = "ids", keep: list[str] | None = None
) -> DataFrame:
    """``encoded`` with ``decoded``: the bytes of packed ids."""
    def work(coder, packed):
        return {"decoded": [coder.decode(ids) for ids in packed]}

    return _step(encoded, ids_col, ("decoded",), "decoded binary", path, pattern, keep, work)


def round_trip(
    docs: DataFrame, path: str, pattern: str, text_col: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """``docs`` with ``ids`` and, decoded from them, ``decoded``: one step, one vocabulary a task."""
    def work(coder, texts):
        ids = [coder.encode(t) for t in texts]
        return {"ids": ids, "decoded": [coder.decode(i) for i in ids]}

    return _step(docs, text_col, ("ids", "decoded"), "ids binary, decoded binary", path, pattern, keep, work)
