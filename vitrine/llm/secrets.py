"""Secret scan by assignment-aware lexing.

A text is lexed as source or configuration: names, string literals, bare values, the
operators ``= : := =>`` and ``+``.  Name-literal pairs follow from ``name op value`` (a JSON
key is a name too); names on the right are replaced by the literals assigned to them,
through any number of steps and through concatenation.  A literal is scored by the words
of the name it ends up in and by its own look; high scores become spans.  Plain patterns
for well-known shapes run beside it, and their spans are always kept.

One text at a time inside Arrow batches, no shuffle.  A text is read once: the lexer never reads
a line again, every assignment is put together once from its parts, and spans are looked up by bisection.

Defined cases: NULL and empty texts have no spans; spans are in code points, end exclusive;
repeated rows are scanned alike; cyclic assignments end; columns in ``keep`` pass through,
and one named ``spans`` is replaced.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, functions as F

from vitrine.llm.common import per_text

KINDS = ("assign", "access", "hex", "literal")  # order of spans with equal starts
LOW = 16  # least length of a hex run

ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A | re.I
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # runs are maximal, so shorter ones are dropped by the count

LEX = re.compile(
    r"""(?P<escape>\\.)|(?P<string>"(?:[^"\\\n]|\\.)*+"|'(?:[^'\\\n]|\\.)*+'|`[^`]*+`)"""
    r"""|(?P<op>=>|:=|==+|!=|<=|>=|=|:(?!//))"""
    r"""|(?P<plus>\+|\.\.(?!\.))"""
    r"""|(?P<name>[A-Za-z_$][\w$]*+(?:[.-][A-Za-z_$][\w$]*+)*+)"""
    r"""|(?P<bare>[A-Za-z0-9_/+=.~!@%^&*-]++)"""
    r"""|(?P<line>[\n;])|(?P<close>[\])])|(?P<open>[\[(])|(?P<comma>,)""",
    re.A,
)
BARE = re.compile(r"[A-Za-z0-9_/+=.~!@#$%^&*-]++", re.A)
WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
# weight of a word in a name; pairs of words as "access key"
NAMES = {
    "password": 1.0, "passwd": 1.0, "pwd": 0.9, "pass": 0.6, "passphrase": 1.0, "secret": 1.0, "token": 0.9,
    "apikey": 1.0, "api key": 1.0, "access key": 0.9, "private key": 1.0, "secret key": 1.0, "auth key": 0.9,
    "credential": 0.8, "credentials": 0.8, "bearer": 0.9, "auth": 0.5, "authorization": 0.7, "key": 0.3,
}
# a name with a score holds one of these
STEMS = tuple(sorted({words.split()[-1] for words in NAMES}))
SOFTER = {"test": 0.6, "example": 0.5, "sample": 0.5, "dummy": 0.4, "public": 0.5, "name": 0.4, "file": 0.4,
          "path": 0.4, "url": 0.4, "type": 0.4, "length": 0.3, "count": 0.3}
EMPTY = re.compile(r"(?i)^(?:x+|\*+|\.+|changeme|todo|none|null|true|false|undefined|your[_-].*|<.*>|\$\{.*\}|%.*%|example.*)$")


def name_score(name: str) -> float:
    """How likely a variable of this name holds a secret, from its words."""
    words = [w.lower() for w in WORD.findall(name)]
    pairs = [f"{a} {b}" for a, b in zip(words, words[1:])]
    best = max((NAMES.get(w, 0.0) for w in (*words, *pairs)), default=0.0)
    for word in words:
        best *= SOFTER.get(word, 1.0)
    return best


def literal_score(value: str) -> float:
    """How much a literal looks like a secret: length, mix of characters, no placeholder."""
    return Value.of(value).score()


HEAD = 32  # longer than every fixed part of a placeholder


@dataclass
class Value:
    """What the score of a string needs to know; values of joined strings come from those of their parts."""

    head: str
    last: str
    counts: Counter  # of characters

    @classmethod
    def of(cls, text: str) -> "Value":
        return cls(text[:HEAD], text[-1:], Counter(text))

    @classmethod
    def joined(cls, parts: list["Value"]) -> "Value":
        parts = [p for p in parts if p.last]
        if len(parts) == 1:
            return parts[0]
        out = cls("", "", Counter())
        for part in parts:
            if len(out.head) < HEAD and out.counts.total() == len(out.head):
                out.head = (out.head + part.head)[:HEAD]
            out.last = part.last
            out.counts.update(part.counts)
        return out

    def score(self) -> float:
        n = self.counts.total()
        if n < 8 or any(c.isspace() for c in self.counts) or self.placeholder(n):
            return 0.0
        bits = -sum(k / n * math.log2(k / n) for k in self.counts.values())
        kinds = any(c.islower() for c in self.counts) + any(c.isupper() for c in self.counts)
        kinds += any(c.isdigit() for c in self.counts) + any(not c.isalnum() for c in self.counts)
        return min(1.0, 0.25 * min(kinds, 3) + 0.1 * bits)

    def placeholder(self, n: int) -> bool:
        if n <= len(self.head):
            return bool(EMPTY.match(self.head))
        # runs of one character are told by the counts, the rest by both ends
        if len(self.counts) <= 2 and {c.lower() for c in self.counts} in ({"x"}, {"*"}, {"."}):
            return True
        return len({c.lower() for c in self.head}) > 1 and bool(EMPTY.match(self.head + self.last))


def assignments(text: str) -> list[tuple[str, int, list[tuple]]]:
    """``(name, position, parts)``; a part is ``("lit", start, end)`` or ``("ref", name, start, end)``."""
    tokens = [(m.lastgroup, m.start(), m.end()) for m in LEX.finditer(text) if m.lastgroup != "escape"]
    starts = [start for _, start, _ in tokens]
    out = []
    run_end = 0  # end of the bare run looked at last; a run is read once however many values start in it
    for i, (kind, start, end) in enumerate(tokens):
        if kind != "op" or text[start:end] in ("==", "===", "!=", "<=", ">="):
            continue
        at = i - 1
        while at >= 0 and tokens[at][0] == "close":  # os.environ["NAME"] = ...
            at -= 1
        if at < 0 or tokens[at][0] not in ("name", "string"):
            continue
        name = text[tokens[at][1] : tokens[at][2]].strip("\"'`")
        parts: list[tuple] = []
        k, expected = i + 1, True
        while k < len(tokens):
            what, a, b = tokens[k]
            if expected and what == "string":
                parts.append(("lit", a + 1, b - 1))
            elif expected and what in ("name", "bare"):
                if a >= run_end:
                    run_end = BARE.match(text, a).end()
                follows = tokens[k + 1] if k + 1 < len(tokens) else ("line", b, b)
                if what == "name" and follows[0] == "open" and follows[1] == b:
                    break  # a call
                if what == "name" and run_end == b:
                    parts.append(("ref", text[a:b], a, b))
                else:
                    parts.append(("lit", a, run_end))
                    k = bisect_left(starts, run_end, k + 1) - 1
            elif not expected and what == "plus":
                pass
            else:
                break
            expected = not expected
            k += 1
        if parts:
            out.append((name, start, parts))
    return out


def literals(text: str, threshold: float = 0.5) -> list[tuple[int, int]]:
    """Spans of literals that reach a sensitive name with a score of at least ``threshold``.

    A name on the right stands for its latest assignment before, else for its first one.  The value
    of an assignment is put together once, from the values of its parts; a name that is part of
    its own value adds nothing.  A single bare word that no assignment explains is a literal.
    """
    low = text.lower()
    if not any(stem in low for stem in STEMS):
        return []
    pairs = assignments(text)
    first: dict[str, int] = {}
    for at, (name, _, _) in enumerate(pairs):
        first.setdefault(name, at)
    latest: dict[str, int] = {}
    sources = []  # per assignment: literal spans and the numbers of other assignments
    for at, (name, _, parts) in enumerate(pairs):
        source = []
        for part in parts:
            if part[0] == "lit":
                source.append(part[1:3])
            elif part[1] in first:
                source.append(latest.get(part[1], first[part[1]]))
            elif len(parts) == 1:
                source.append(part[2:4])
        sources.append(source)
        latest[name] = at

    # bare literals of one run share its end: each is what stands before the next, and that
    runs: dict[int, list[int]] = {}
    for a, b in {part for source in sources for part in source if isinstance(part, tuple)}:
        runs.setdefault(b, []).append(a)
    nested: dict[tuple, Value] = {}
    for b, begins in runs.items():
        if len(begins) > 1:
            rest, after = Value.of(""), b
            for a in sorted(begins, reverse=True):
                rest, after = Value.joined([Value.of(text[a:after]), rest]), a
                nested[a, b] = rest

    values: dict[int, Value | None] = {}  # None while its parts are looked at

    def value(at: int) -> Value:
        todo = [at]
        while todo:
            here = todo[-1]
            if here not in values:
                values[here] = None
                todo += [s for s in sources[here] if isinstance(s, int) and s not in values]
                continue
            todo.pop()
            if values[here] is None:
                parts = [
                    values[s] if isinstance(s, int) else nested[s] if s in nested else Value.of(text[s[0] : s[1]])
                    for s in sources[here]
                ]
                values[here] = Value.joined([p for p in parts if p is not None])
        return values[at]

    found, marked = set(), set()
    for at, (name, _, _) in enumerate(pairs):
        weight = name_score(name)
        if weight <= 0 or at in marked or weight * value(at).score() < threshold:
            continue
        todo = [at]
        marked.add(at)
        while todo:
            for source in sources[todo.pop()]:
                if isinstance(source, tuple):
                    found.add(source)
                elif source not in marked:
                    marked.add(source)
                    todo.append(source)
    return sorted((a, b) for a, b in found if b > a)


def scan(text: str | None, threshold: float = 0.5) -> list[dict]:
    """All spans of a text, by start, then kind."""
    text = text or ""
    spans = [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    low = text.lower()
    if any(word in low for word in ("passw", "secret", "token", "api")):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    base = sorted(spans)
    starts = [start for start, _, _ in base]
    reach = list(accumulate((end for _, _, end in base), max, initial=0))  # of the spans up to each
    added = []
    for a, b in literals(text, threshold):
        if reach[bisect_right(starts, a)] < b:  # in no plain span
            added.append((a, 3, b))
    return [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in sorted(base + added)]


def find_secrets(
    docs: DataFrame, threshold: float = 0.5, text_col: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """``docs`` (columns ``keep``) with ``spans``: array of (kind, start, end)."""
    def make():
        return lambda texts: {"spans": [scan(t, threshold) for t in texts]}

    keep = [c for c in (docs.columns if keep is None else keep) if c != "spans"]
    return per_text(docs, text_col, "spans array<struct<kind: string, start: long, end: long>>", make, keep)


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def of_kinds(spans: Column, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))
