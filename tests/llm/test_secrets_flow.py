"""Propagation of literals against recursion over whole strings, and time on long texts."""

import math
import random
import time
from collections import Counter

import pytest

from vitrine.llm import secrets


def plain_score(value):
    if len(value) < 8 or any(c.isspace() for c in value) or secrets.EMPTY.match(value):
        return 0.0
    bits = -sum(k / len(value) * math.log2(k / len(value)) for k in Counter(value).values())
    tests = (str.islower, str.isupper, str.isdigit, lambda c: not c.isalnum())
    return min(1.0, 0.25 * min(sum(any(map(t, value)) for t in tests), 3) + 0.1 * bits)


def plain(program):
    """Values of literals that reach a sensitive name; ``program`` holds (name, parts), parts literals or names."""
    latest, flows = {}, []
    for name, parts in program:
        flow = []
        for kind, what in parts:
            flow += [what] if kind == "lit" else latest[what]
        latest[name] = flow
        flows.append((name, flow))
    found = set()
    for name, flow in flows:
        if secrets.name_score(name) * plain_score("".join(v for v in flow)) >= 0.5:
            found.update(v for v in flow if v)
    return found


def test_random_programs():
    random.seed(11)
    names = ["a", "b", "token", "db_password", "key", "api_key", "test_token", "c"]
    pieces = ["abc", "Zq8#", "k!Lm2pQ9w", "xxxxxxxxxxxx", "changeme", "", "<your>", "two words", "9f3A", "example", "${x}", "%d", "your_x1Y"]
    hits = 0
    for _ in range(3000):
        program, known = [], []
        for number in range(random.randint(1, 9)):
            name = random.choice(names)
            parts = []
            for _ in range(random.randint(1, 3)):
                if known and random.random() < 0.5:
                    parts.append(("ref", random.choice(known)))
                else:  # numbered, so that equal literals are told apart
                    parts.append(("lit", random.choice(pieces)))
            program.append((name, parts))
            known.append(name)
        lines = [f"{n} = " + " + ".join(f'"{w}"' if k == "lit" else w for k, w in ps) for n, ps in program]
        text = "token_kind\n" + "\n".join(lines)
        got = {text[a:b] for a, b in secrets.literals(text)}
        want = plain(program)
        assert got == want, (text, got, want)
        hits += bool(want)
    assert hits > 300


@pytest.mark.parametrize("value", ["x" * 50, "X" * 9, "*" * 60, "x" * 40 + "Y9!", "your_" + "a1B" * 30, "<" + "aB3" * 40 + ">", "<" + "aB3" * 40, "${" + "q7R" * 20 + "}", "%" + "q7R" * 20 + "%", "Example" + "z9" * 30, "aB3$" * 30])
def test_scores_of_long_values(value):
    assert secrets.literal_score(value) == pytest.approx(plain_score(value))
    cut = len(value) // 3
    parts = [secrets.Value.of(p) for p in (value[:cut], "", value[cut : cut + 1], value[cut + 1 :])]
    assert secrets.Value.joined(parts).score() == pytest.approx(plain_score(value))


CHAIN = "secret0 = 'abcD3fgh9'\n"
LONG = {
    "same name": "token=token\n" * 80_000,
    "arguments": "token=token," * 80_000,
    "bare run": "token=" * 60_000,
    "chain": CHAIN + "".join(f"secret{i} = secret{i - 1}\n" for i in range(1, 40_000)),
    "sums": CHAIN + "".join(f"secret{i} = secret{i - 1} + 'x'\n" for i in range(1, 30_000)),
    "doubling": "token = 'aB3'\n" + "token = token + token\n" * 30_000,
    "forward": "".join(f"secret{i} = secret{i + 1}\n" for i in range(40_000)),
    "escaped": "token " + '\\"' * 500_000,
    "open quotes": "token " + "\"a' " * 250_000,
    "no value": "password = " * 90_000,
    "many spans": "token = '0123456789abcdef0123'\n" * 30_000,
}


@pytest.mark.parametrize("name", LONG)
def test_long_texts_take_linear_time(name):
    start = time.perf_counter()
    secrets.scan(LONG[name])
    assert time.perf_counter() - start < 10  # 1 to 3 s alone; the old walk took hours


def test_escaped_source():
    text = '{\\"password\\": \\"hunTer2-hunTer2\\"} and "token": "it\\"s-Zq8kLm2pQ9w"'
    assert {text[a:b] for a, b in secrets.literals(text)} == {"hunTer2-hunTer2", 'it\\"s-Zq8kLm2pQ9w'}


def test_names_that_hold_themselves():
    text = 'token = token + "Zq8#kLm2pQ9w"\npassword = other\nother = password\nsecret = "aB3$efGh1"\n'
    assert {text[a:b] for a, b in secrets.literals(text)} == {"Zq8#kLm2pQ9w", "aB3$efGh1"}
