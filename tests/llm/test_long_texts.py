"""Doubling an adversarial text must at most about double the time."""

import random
import re
import time

import pytest

from tallyframe.llm import pii, secrets

PII = {
    "blanks": lambda n: "а" + " " * n,
    "digits": lambda n: "1" * n + " at example.com",
    "brackets": lambda n: "[ at " * (n // 5),
    "signs": lambda n: "[at]  " * (n // 6),
    "cyrillic": lambda n: "привет мир " * (n // 11),
    "spelled": lambda n: "one two dot " * (n // 12),
    "at": lambda n: "a1 at b " * (n // 8),
}
SECRETS = {
    "escaped": lambda n: '\\"token\\":' * (n // 10),
    "quotes": lambda n: "token don't " * (n // 12),
    "chain": lambda n: "\n".join(f"token{i} = token{i + 1}" for i in range(n // 20)),
    "many": lambda n: "\n".join(f'token_{i} = "Zx81mm{i}qq"' for i in range(n // 25)),
}


def seconds(find, text):
    laps = []
    for _ in range(2):
        start = time.process_time()
        find(text)
        laps.append(time.process_time() - start)
    return min(laps)


@pytest.mark.parametrize("find, make", [
    *[pytest.param(pii.find, v, id=f"pii-{k}") for k, v in PII.items()],
    *[pytest.param(secrets.find, v, id=f"secrets-{k}") for k, v in SECRETS.items()],
])
def test_time_grows_with_the_length(find, make):
    short, long = seconds(find, make(250_000)), seconds(find, make(1_000_000))
    assert long < 8 * short + 0.2


def test_offsets_take_little_memory():
    clear = pii.normalise("привет at мир [at] x " * 20_000)
    held = clear.start.itemsize + clear.end.itemsize + 1
    assert held < 20 and len(clear.start) == len(clear.text) == len(clear.changed)


def plain_named_at(text):
    """The pattern as it reads, tried at every place."""
    old = re.compile(
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9%+-]*(?:[0-9_]|\.(?=[A-Za-z0-9]))[A-Za-z0-9._%+-]*(\s+at\s+)"
        r"(?=(?:[A-Za-z0-9-]{1,63}\.){1,5}(?:" + "|".join(pii.LAST_LABELS.split()) + r")(?![A-Za-z0-9-]))", re.I)
    return [m.span(1) for m in old.finditer(text)]


def test_linear_patterns_find_the_same():
    source = random.Random(4)
    parts = ["a", "1", "_", ".", " at ", "  at  ", "x.com", "b.c.org", " ", "%", "[at]", "[ dot ]", "  ", "(@)", "\n"]
    old_at = re.compile(r"\s*[\[({<]\s*(?:at|@)\s*[\])}>]\s*", re.I)
    old_dot = re.compile(r"\s*[\[({<]\s*(?:dot|punkt|punto|point|\.)\s*[\])}>]\s*", re.I)
    for _ in range(4000):
        text = "".join(source.choices(parts, k=source.randrange(1, 14)))
        assert [m.span(1) for m in pii._NAMED_AT.finditer(text)] == plain_named_at(text)
        assert [m.span() for m in pii._BRACKET_AT.finditer(text)] == [m.span() for m in old_at.finditer(text)]
        assert [m.span() for m in pii._BRACKET_DOT.finditer(text)] == [m.span() for m in old_dot.finditer(text)]


def test_strings_are_lexed_as_one_pattern_would():
    old = re.compile(r"\"(?P<dq>(?:[^\"\\\n]|\\.)*)\"|'(?P<sq>(?:[^'\\\n]|\\.)*)'|`(?P<bq>[^`\n]*)`"
                     + secrets._LEX.pattern[secrets._LEX.pattern.index("|(?P<name>"):])
    source = random.Random(5)
    for _ in range(4000):
        text = "".join(source.choices(['"', "'", "`", "\\", "\n", "a", " ", "=", "b1", "+"], k=source.randrange(1, 25)))
        want = []
        for m in old.finditer(text):
            quoted = m.lastgroup in ("dq", "sq", "bq")
            want.append(("literal", *m.span(m.lastgroup)) if quoted else (m.lastgroup, *m.span()))
        assert [(t.kind, t.start, t.end) for t in secrets.lex(text)] == want


def test_constants_reach_every_name_behind_them():
    source = random.Random(6)
    for _ in range(300):
        every = [f"n{i}" for i in range(8)] + ["password", "token", "auth_x"]
        names = {}
        for _ in range(source.randrange(12)):
            names.setdefault(source.choice(every), set()).add(source.choice(every))
        literals = {n: [] for n in source.sample(every, 4)}
        found = secrets.reached(literals, names)
        for name in literals:
            seen, todo = set(), [name]
            while todo:
                one = todo.pop()
                if one not in seen:
                    seen.add(one)
                    todo += names.get(one, ())
            assert found[name] == max(secrets.name_score(n) for n in seen)
