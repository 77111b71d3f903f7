"""Disguises that touch a base span, or that a pre-filter may miss."""

import random

from tallyframe.llm import pii


def added(module, text):
    return [(k, text[a:b]) for k, a, b in module.find(text)[1]]


def test_homoglyphs_beside_a_plain_at():
    for address in ("j\u043ehn@example.com", "john@example.c\u043em", "john@mail.ex\u0430mple.com", "al\u200bice@example.com"):
        text = f"mail {address} now"
        assert added(pii, text) == [("email", address)], address
        assert pii.find(text)[0] == pii.detect(text) != []
    assert added(pii, "call +1 (988) 555-2485 \u0430") == []


def test_the_filter_misses_no_disguise(monkeypatch):
    cases = {
        "eight point eight point four point four": "ip", "plus 1 988 555 2485": "phone",
        "joe@example[punkt]com": "email", "joe@example (punto) com": "email", "joe@example{point}com": "email",
        "call plus 4 nine three zero 1 2 three 4 5 six 7": "phone", "al\u200bice@exa\u200bmple.com": "email",
    }
    for text, kind in cases.items():
        assert [k for k, _ in added(pii, text)] == [kind], text
    random.seed(7)
    words = ["at", "dot", "point", "dash", "plus", "punkt", "[", "]", "(", ")", "@", ".", "-", ",", " ", " ", " ", "\n",
             "one", "four", "8", "42", "joe", "j.d", "example", "com", "\u043e", "\u00e9"]
    texts = ["".join(random.choices(words, k=random.randrange(1, 30))) for _ in range(40_000)]
    for text in texts:
        assert pii.may_hide(text) or pii.normalise(text).text == text, text
    gated = [pii.find(text) for text in [*cases, *texts]]
    monkeypatch.setattr(pii, "may_hide", lambda text: True)
    assert gated == [pii.find(text) for text in [*cases, *texts]]
