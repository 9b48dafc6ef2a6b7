"""Quality rules by repetition coverage.

Per text: how many characters lie inside word n-grams that occur more than once, and
inside lines that occur more than once, for several n.  N-grams are compared by rolling
hashes over word numbers, in numpy, one text at a time; no shuffle.

Defined cases: NULL and empty texts have no words and fail the base rule; a text shorter
than n words has no n-gram; repeated rows are judged alike; other columns pass through
untouched unless their name is one of ``COLUMNS`` (then the judged value replaces it).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

from vitrine.llm.common import per_text

SPACES = "\x20\t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class QualityRules:
    """Limits of the verdict.

    ``ngrams``: lengths whose duplicated n-grams are measured; a text is rejected if they
    cover more than ``max_ngram_chars`` of its word characters, if repeated lines hold
    more than ``max_line_chars`` of them, or if it has more than ``max_symbols`` symbols
    per word.  ``min_words`` and ``max_repeat_words`` are the base rule.
    """

    ngrams: tuple[int, ...] = (5, 8, 13)
    max_ngram_chars: float = 0.5
    max_line_chars: float = 0.5
    max_symbols: float = 0.25
    min_words: int = 50
    max_repeat_words: float = 0.5


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def columns(rules: QualityRules) -> list[str]:
    """Names of the measured columns."""
    return [*BASE, "line_chars", *[f"ngram{n}_chars" for n in rules.ngrams]]


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Mask of the entries that occur more than once."""
    order = np.argsort(keys, kind="stable")
    same = np.diff(keys[order]) == 0
    hit = np.zeros(len(keys), bool)
    hit[1:] |= same
    hit[:-1] |= same
    mask = np.empty_like(hit)
    mask[order] = hit
    return mask


def _covered(windows: np.ndarray, n: int, total: int) -> np.ndarray:
    """Words that lie in a marked window of n words."""
    edge = np.zeros(total + 1, np.int64)
    starts = np.flatnonzero(windows)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + n, -1)
    return np.cumsum(edge[:-1]) > 0


def _triples(ids: np.ndarray, vocabulary: int) -> np.ndarray:
    """Exact numbers for 3-word windows; pairs are renumbered when the product would overflow."""
    pairs = ids[:-1] * vocabulary + ids[1:]
    if vocabulary >= 1 << 20:
        pairs = np.unique(pairs, return_inverse=True)[1]
    return pairs[:-1] * vocabulary + ids[2:]


def measure(text: str | None, ngrams: tuple[int, ...]) -> list[int]:
    """The measured columns of one text, in the order of ``columns``."""
    text = text or ""
    raw = text.encode()
    words = raw.split()  # bytes split at exactly \x20 and \x09-\x0D
    n = len(words)
    word_chars = len(text) - sum(map(text.count, SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    dup_lines = len(lines) - len(set(lines))
    line_chars = 0
    if dup_lines:
        seen: dict[str, int] = {}
        for line in lines:
            seen[line] = seen.get(line, 0) + 1
        line_chars = sum(
            k * (len(line) - sum(map(line.count, SPACES))) for line, k in seen.items() if k > 1
        )
    out = [n, word_chars, symbols, dup_lines, 0, line_chars, *[0] * len(ngrams)]
    short = min(ngrams, default=3) < 3  # single words or pairs are measured too
    if n < (2 if short else 4):
        return out
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    if len(numbers) == n:
        return out
    if n >= 4:
        hit = _repeated(_triples(ids, len(numbers)))
        out[4] = int(_covered(hit, 3, n).sum())
    if not out[4] and not short:
        return out
    flat = np.frombuffer(raw, np.uint8)
    if len(flat) == len(text):
        sizes = np.fromiter(map(len, words), np.int64, n)
    else:
        sizes = np.fromiter((len(w.decode()) for w in words), np.int64, n)
    # rolling hash over word numbers, modulo 2**64, carried on from one length to the next
    base = np.uint64(0x9E3779B97F4A7C15)
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0x94D049BB133111EB)
    mixed ^= mixed >> np.uint64(29)
    roll, length = mixed.copy(), 1
    for at, size in sorted(enumerate(ngrams), key=lambda x: x[1]):
        if size > n:
            break
        while length < size:
            roll = roll[:-1] * base + mixed[length:]
            length += 1
        hit = _repeated(roll.view(np.int64))
        if not hit.any():
            break  # a longer n-gram repeats only where the shorter one does
        out[6 + at] = int(sizes[_covered(hit, size, n)].sum())
    return out


def measure_quality(
    docs: DataFrame, rules: QualityRules = QualityRules(), text_col: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """``docs`` (columns ``keep``, default all) with the measured columns, ``base_failed`` and ``kept``."""
    names = columns(rules)
    keep = [c for c in (docs.columns if keep is None else keep) if c not in (*names, "base_failed", "kept")]
    ngrams = rules.ngrams

    def make():
        def work(texts):
            rows = [measure(text, ngrams) for text in texts]
            return dict(zip(names, zip(*rows))) if rows else {n: [] for n in names}

        return work

    schema = ", ".join(f"{n} long" for n in names)
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    failed = (F.col("n_words") < rules.min_words) | (
        F.col("n_repeat_words") > rules.max_repeat_words * F.col("n_words")
    )
    good = (F.col("line_chars") <= rules.max_line_chars * chars) & (
        F.col("n_symbols") <= rules.max_symbols * F.col("n_words")
    )
    for n in ngrams:
        good &= F.col(f"ngram{n}_chars") <= rules.max_ngram_chars * chars
    measured = per_text(docs, text_col, schema, make, keep)
    return measured.withColumn("base_failed", failed).withColumn("kept", ~failed & good)


def keep_good(docs: DataFrame, rules: QualityRules = QualityRules(), text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, with the columns of ``docs``, whatever their names."""
    # own names for all columns, so that none clashes and the text goes to Python once
    names = {c: f"column{i}" for i, c in enumerate(docs.columns)}
    plain = docs.select(*[docs[c].alias(name) for c, name in names.items()])
    judged = measure_quality(plain, rules, names[text_col], keep=list(names.values()))
    return judged.filter("kept").select(*[F.col(name).alias(c) for c, name in names.items()])
