"""BPE encoding and decoding with a pair occurrence index.

Texts are cut into words as the vocabulary file says.  The words new to a task are laid
out in one flat list of symbol numbers; an index maps every adjacent pair that has a
merge rank to all its positions.  A heap holds the active ranks; the lowest is applied to
all its positions, and the position lists of the pairs that this creates are extended.  Positions that an earlier merge has made stale are recognised by comparing the
symbols that stand there now.

Defined cases: NULL and empty texts give no ids and an empty decoded text; NULL ids decode
to an empty text; an id outside the vocabulary is skipped in decoding, as the library does;
repeated rows are encoded alike; other columns pass through, and a column that has the name
of a result is replaced by it.

Words are gathered over ``SLICE`` bytes of text at a time, which bounds the memory of a task.
"""

from __future__ import annotations

import heapq
import json
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

from vitrine.llm.common import per_text

SLICE = 3 << 20
# Below this code point, composing and lower-casing are the same in every Unicode version;
# texts with others are cut by the tokenizer library's own normaliser and splitter.
OTHER = re.compile("[^\\x00-\u017f]")
# Letters, numbers and blanks below that code point.
LETTER, NUMBER, BLANK = "a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u017f", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
WORD = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTER}]+|[{NUMBER}]|[^{BLANK}{LETTER}{NUMBER}]+")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: printable ones for themselves, the others from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


@dataclass
class Vocabulary:
    """A word-level BPE file: tokens, merges, and the strings that are tokens by themselves."""

    tokens: list[str | None]  # by id
    merges: dict[int, tuple[int, int]]  # left * size + right -> rank, merged id
    letters: list[tuple[int, int]]  # by byte: id inside a word, id at the end of a word
    special: dict[str, int]
    ordered: bool  # every merge ranks after the merges that make its parts


def load_vocabulary(path: str) -> Vocabulary:
    """Read a ``tokenizers`` JSON file of the kind: byte letters, word ends, ranked merges."""
    with open(path, encoding="utf-8") as file:
        data = json.load(file)
    model = data["model"]
    ids = dict(model["vocab"])
    special = {t["content"]: t["id"] for t in data["added_tokens"]}
    size = max([*ids.values(), *special.values()]) + 1
    tokens: list[str | None] = [None] * size
    for token, i in [*ids.items(), *special.items()]:
        tokens[i] = token
    end = model["end_of_word_suffix"]
    merges, made = {}, {}
    pairs = [pair if isinstance(pair, list) else pair.split(" ") for pair in model["merges"]]
    for rank, (left, right) in enumerate(pairs):
        merges[ids[left] * size + ids[right]] = (rank, ids[left + right])
        made[left + right] = rank  # the last merge that makes it
    ordered = all(made.get(part, -1) < rank for rank, pair in enumerate(pairs) for part in pair)
    letters = [(ids[c], ids[c + end]) for c in byte_letters()]
    return Vocabulary(tokens, merges, letters, special, ordered)


class PairIndex:
    """Merges the words of a set together.

    ``symbols`` holds all words back to back, each closed by -1; ``after`` and ``before``
    link the live symbols.  ``places`` maps the rank of a pair to arrays of positions of its
    left part; the heap holds the ranks that have places.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.size = len(vocabulary.tokens)
        self.ordered = vocabulary.ordered
        self.letters = np.array(vocabulary.letters, np.int32)
        keys = np.fromiter(vocabulary.merges, np.int64, len(vocabulary.merges))
        values = np.array(list(vocabulary.merges.values()), np.int64).reshape(-1, 2)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], values[order, 0].astype(np.int32)
        self.pairs = {rank: (*divmod(key, self.size), joined) for key, (rank, joined) in vocabulary.merges.items()}

    def encode(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of each word (little-endian unsigned 32 bit); no word is empty."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        stops = np.cumsum(lengths + 1) - 1  # place of the -1 that closes a word
        total = int(stops[-1]) + 1
        symbols = np.full(total, -1, np.int32)
        inside = np.ones(total, bool)
        inside[stops] = False
        raw = np.frombuffer(b"".join(words), np.uint8)
        symbols[inside] = self.letters[raw, 0]
        symbols[stops - 1] = self.letters[raw[np.cumsum(lengths) - 1], 1]
        after = np.arange(1, total + 1, dtype=np.int32)
        before = np.arange(-1, total - 1, dtype=np.int32)
        places: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []
        keys, ranks, size, last = self.keys, self.ranks, self.size, len(self.keys) - 1

        def note(at: np.ndarray, left: np.ndarray, right: np.ndarray) -> int:
            """Index pairs by the positions and symbols of their parts; the least rank found."""
            key = left.astype(np.int64) * size + right
            slot = np.minimum(keys.searchsorted(key), last)
            known = (keys[slot] == key) & (left >= 0) & (right >= 0)
            at, rank = at[known], ranks[slot[known]]
            if not len(at):
                return 1 << 60
            order = rank.argsort(kind="stable")
            at, rank = at[order], rank[order]
            cuts = [0, *((rank[1:] != rank[:-1]).nonzero()[0] + 1).tolist(), len(at)]
            least = rank[cuts[:-1]].tolist()
            for r, i, j in zip(least, cuts, cuts[1:]):
                if r in places:
                    places[r].append(at[i:j])
                else:
                    places[r] = [at[i:j]]
                    heapq.heappush(heap, r)
            return least[0]

        note(np.arange(total - 1, dtype=np.int32), symbols[:-1], symbols[1:])
        while heap:
            rank = heapq.heappop(heap)
            lists = places.pop(rank)
            left, right, joined = self.pairs[rank]
            at = lists[0] if len(lists) == 1 else np.concatenate(lists)
            at = at[symbols[at] == left]
            gone = after[at]
            fits = symbols[gone] == right
            at, gone = at[fits], gone[fits]
            if not len(at):
                continue
            if len(lists) > 1 or left == right:
                at = np.unique(at)
                gone = after[at]
            if left == right:
                # overlapping pairs of one chain: take every second one from the left
                keep, taken = np.zeros(len(at), bool), -1
                for i, (p, q) in enumerate(zip(at.tolist(), gone.tolist())):
                    if p != taken:
                        keep[i], taken = True, q
                at, gone = at[keep], gone[keep]
            if not self.ordered:
                # a merge may bring up a pair of lower rank: only the first place in each word now
                word = np.searchsorted(stops, at)
                order = np.lexsort((at, word))
                first = order[np.r_[True, np.diff(word[order]) != 0]]
                later = np.ones(len(at), bool)
                later[first] = False
                if later.any():
                    places[rank] = [at[later]]
                    heapq.heappush(heap, rank)
                    at, gone = at[first], gone[first]
            symbols[at] = joined
            symbols[gone] = -2
            follow = after[gone]
            after[at] = follow
            before[follow] = at
            back = before[at]
            # the pair to the left of every new symbol, then the pair to its right
            both = np.concatenate([back, at])
            note(both, symbols[both], symbols[np.concatenate([at, follow])])
        live = symbols >= 0
        packed = symbols[live].astype("<u4").tobytes()
        bounds = [0, *(np.cumsum(live)[stops] * 4).tolist()]
        return [packed[a:b] for a, b in zip(bounds, bounds[1:])]


class Encoder:
    """Texts to packed ids.

    No word crosses a blank, so texts are split at ASCII blanks first; the distinct words
    of the distinct chunks go through the pair index together.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        vocabulary = load_vocabulary(path)
        self.index = PairIndex(vocabulary)
        self.special = {s: np.uint32(i).astype("<u4").tobytes() for s, i in vocabulary.special.items()}
        names = sorted(self.special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        library = Tokenizer.from_file(path)
        self.normalizer, self.splitter = library.normalizer, library.pre_tokenizer
        self.byte_of = {c: b for b, c in enumerate(byte_letters())}

    def words(self, chunk: str) -> list[str]:
        """Normalised words of a chunk without special strings."""
        if OTHER.search(chunk):
            normal = self.normalizer.normalize_str(chunk)
            pieces = self.splitter.pre_tokenize_str(normal)
            return [bytes(map(self.byte_of.__getitem__, piece)).decode() for piece, _ in pieces]
        return WORD.findall(chunk.lower())

    def learn(self, chunks: list[bytes]) -> dict[bytes, bytes]:
        """Packed ids of distinct chunks."""
        cut: list[list[list[str] | bytes]] = []
        for chunk in chunks:
            text = chunk.decode()
            # odd places hold special strings
            pieces = self.cut.split(text) if self.cut and self.cut.search(text) else [text]
            cut.append([self.words(p) if i % 2 == 0 else self.special[p] for i, p in enumerate(pieces)])
        order = list({w for groups in cut for group in groups[::2] for w in group})
        parts = dict(zip(order, self.index.encode([w.encode() for w in order]))) if order else {}
        return {
            chunk: b"".join([g if isinstance(g, bytes) else b"".join(map(parts.__getitem__, g)) for g in groups])
            for chunk, groups in zip(chunks, cut)
        }

    def encode(self, texts: list[str | bytes | None]) -> list[bytes]:
        raw = [t.encode() if isinstance(t, str) else t or b"" for t in texts]
        every: set[bytes] = set()
        for text in raw:
            every.update(text.split())
        known = self.learn(list(every))
        return [b"".join(map(known.__getitem__, text.split())) for text in raw]


def _replacing(docs: DataFrame, keep: list[str] | None, *made: str) -> list[str]:
    return [c for c in (docs.columns if keep is None else keep) if c not in made]


def encode(docs: DataFrame, path: str, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``ids``: the token ids as little-endian unsigned 32-bit integers, packed.

    ``path`` names the vocabulary file on the executors.  Strings of special tokens inside
    a text become these tokens; none is added.
    """

    def make():
        encoder = Encoder(path)
        return lambda texts: {"ids": encoder.encode(texts)}

    return per_text(docs, text_col, "ids binary", make, _replacing(docs, keep, "ids"), True, SLICE)


def _reader(path: str):
    """Packed ids to text: their tokens, joined by blanks as the file asks for."""
    tokens = np.array(load_vocabulary(path).tokens, object)

    def text(ids):
        numbers = np.frombuffer(ids or b"", "<u4")
        found = tokens[numbers[numbers < len(tokens)]].tolist()
        return " ".join(found if None not in found else [t for t in found if t is not None])

    return text


def decode(encoded: DataFrame, path: str, ids_col: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """``encoded`` with ``decoded``: the text that packed ids stand for."""

    def make():
        text = _reader(path)
        return lambda packed: {"decoded": [text(ids) for ids in packed]}

    return per_text(encoded, ids_col, "decoded string", make, _replacing(encoded, keep, "decoded"), False, SLICE)


def round_trip(docs: DataFrame, path: str, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``ids`` and, decoded from them, ``decoded``: one step, so one process a core."""

    def make():
        encoder, text = Encoder(path), _reader(path)

        def work(texts):
            packed = encoder.encode(texts)
            return {"ids": packed, "decoded": [text(ids) for ids in packed]}

        return work

    keep = _replacing(docs, keep, "ids", "decoded")
    return per_text(docs, text_col, "ids binary, decoded string", make, keep, True, SLICE)


def unpack(ids) -> "F.Column":
    """Packed ids as an array of long."""
    digits, size = F.hex(ids), F.floor(F.length(ids) / 4).cast("int")
    numbers = F.transform(
        F.sequence(F.lit(0), size - 1),
        lambda i: F.conv(F.concat(*[F.substring(digits, i * 8 + 1 + 2 * k, 2) for k in (3, 2, 1, 0)]), 16, 10).cast("long"),
    )
    return F.when(size > 0, numbers).otherwise(F.array().cast("array<bigint>"))
