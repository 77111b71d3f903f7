"""Secrets in plain matches and in assignments of source and configuration syntax.

Base spans are plain matches. Beside them, a lexer splits lines with a sensitive word
into names, literals and operators and parses name-literal pairs: assignments
(`=`, `:=`, `:`, `=>`), quoted keys, calls such as set("name", "value"), XML
attributes and elements, and concatenations of literals. Names that are assigned other
names pass constants on, in any order. A literal is a secret if a name that reaches it
is sensitive and the literal looks like a value rather than prose or a placeholder;
its span is that of the literal, of kind `literal`. Literals inside a base span are
left out. Null texts are empty.

Strings and chains of names take time in proportion to the length of a text. Repeated rows have
a row each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import DataFrame

from tallyframe.llm.spans import Covered, Span, span_rows

KINDS = ("assign", "access", "hex", "+literal")
#: Least score of a literal, and least length.
THRESHOLD = 0.5
LEAST = 6

_ASSIGN = re.compile(
    r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
_KEYWORD = re.compile(r"password|passwd|secret|token|api_?key", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")

# Parts of names, and how strongly they say that a value is secret.
NAME_SCORES = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "pass": 0.6, "secret": 0.9,
    "token": 0.8, "apikey": 0.9, "credential": 0.9, "credentials": 0.9, "privatekey": 1.0,
    "accesskey": 0.9, "secretkey": 1.0, "authkey": 0.9, "bearer": 0.8, "signingkey": 0.9,
    "encryptionkey": 0.9, "clientsecret": 1.0, "auth": 0.5,
}
PLACEHOLDERS = re.compile(
    r"^(?:x+|\*+|\.+|-+|<.*>|\$\{.*\}|\{\{.*\}\}|%.*%|changeme|example|placeholder|none|null|true|false|"
    r"undefined|todo|your.*|my.*|test|password|secret|token)$", re.I)
# The letters of any scored name, with what may stand between them in a name.
_SENSITIVE = re.compile("|".join(
    r"[^A-Za-z\s]*".join(name) for name in NAME_SCORES
    if not any(other != name and other in name for other in NAME_SCORES)), re.I | re.A)

_STRINGS = {
    '"': re.compile(r"\"((?:[^\"\\\n]|\\.)*+)\""), "'": re.compile(r"'((?:[^'\\\n]|\\.)*+)'"),
    "`": re.compile(r"`([^`\n]*+)`"),
}
_LEX = re.compile(
    r"(?P<quote>[\"'`])"
    r"|(?P<name>[A-Za-z_$][A-Za-z0-9_$]*(?:[.-][A-Za-z_$][A-Za-z0-9_$]*)*)"
    r"|(?P<num>[0-9][A-Za-z0-9_]*)|(?P<op>:=|=>|==|!=|<=|>=|->|=|:|\+|,|\(|\)|\[|\]|;|<|>|\n)")
_BARE = re.compile(r"[^\s,;\"'<>(){}\[\]]+")
_WORDS = re.compile(r"[A-Z]+(?=[A-Z][a-z])|[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_ASSIGNS = {"=", ":=", ":", "=>"}


def base_spans(text: str) -> list[Span]:
    out = []
    if _KEYWORD.search(text):
        out += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 6]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    return out + [("hex", *m.span()) for m in _HEX.finditer(text)]


def name_score(name: str) -> float:
    """The largest score of a word of the name, or of two neighbouring ones."""
    words = [w.lower() for w in _WORDS.findall(name)]
    both = words + [a + b for a, b in zip(words, words[1:])]
    best = max((NAME_SCORES.get(w, 0.0) for w in both), default=0.0)
    if words and words[-1] in ("name", "field", "length", "url", "path", "type", "count", "id", "hint"):
        best *= 0.4  # says something about a secret
    return best


def value_score(value: str) -> float:
    """How much a literal looks like a secret: no prose, no placeholder, mixed characters."""
    if len(value) < LEAST or PLACEHOLDERS.match(value) or re.search(r"\s", value):
        return 0.0
    n = len(value)
    entropy = -sum(k / n * math.log2(k / n) for k in Counter(value).values())
    kinds = sum(bool(re.search(p, value)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    if value.isalpha() and (value.islower() or value.istitle()):
        return 0.3 if n < 16 else 0.5
    return min(1.0, 0.35 + 0.1 * kinds + entropy / 10)


class Token:
    __slots__ = ("kind", "text", "start", "end")

    def __init__(self, kind: str, text: str, start: int, end: int):
        self.kind, self.text, self.start, self.end = kind, text, start, end


def lex(text: str) -> list[Token]:
    """Names, numbers, signs and string literals.

    A quote that is not closed on its line is passed over. So are all others of its kind up to
    the end of the line: each was escaped on the way, and the rest after it was read just so.
    """
    out, at = [], 0
    open_until = dict.fromkeys(_STRINGS, 0)
    while m := _LEX.search(text, at):
        kind, at = m.lastgroup, m.end()
        if kind != "quote":
            out.append(Token(kind, m[0], m.start(), m.end()))
        elif m.start() >= open_until[m[0]]:
            string = _STRINGS[m[0]].match(text, m.start())
            if string:
                out.append(Token("literal", string[1], *string.span(1)))
                at = string.end()
            else:
                end = text.find("\n", at)
                open_until[m[0]] = len(text) if end < 0 else end
    return out


def pairs(text: str) -> tuple[dict[str, list], dict[str, set[str]]]:
    """Literals (value, start, end) by the name they are assigned to, and names by the name they get."""
    tokens = lex(text)
    literals: dict[str, list] = {}
    names: dict[str, set[str]] = {}
    for i, token in enumerate(tokens):
        if token.kind not in ("name", "literal") or i + 2 >= len(tokens):
            continue
        name, sign, value = token.text, tokens[i + 1], tokens[i + 2]
        if token.kind == "literal" and not re.fullmatch(r"[\w$.-]{1,64}", name):
            continue
        if sign.text == ">" and i and tokens[i - 1].text == "<":  # <name>value</name>
            bare = _BARE.match(text, sign.end)
            if bare and text.startswith(f"</{name}", bare.end()):
                literals.setdefault(name, []).append((bare[0], bare.start(), bare.end()))
            continue
        if sign.text == ",":  # set("name", "value")
            if token.kind == "literal" and value.kind == "literal" and i and tokens[i - 1].text == "(":
                literals.setdefault(name, []).append((value.text, value.start, value.end))
            continue
        if sign.text not in _ASSIGNS or "\n" in text[sign.end:value.start]:
            continue
        parts, at = [], i + 2
        while at < len(tokens) and tokens[at].kind == "literal":  # "ab" + "cd"
            parts.append(tokens[at])
            if at + 2 < len(tokens) and tokens[at + 1].text == "+" and tokens[at + 2].kind == "literal":
                at += 2
            else:
                break
        if parts:
            joined = "".join(p.text for p in parts)
            literals.setdefault(name, []).append((joined, parts[0].start, parts[-1].end))
            continue
        bare = _BARE.match(text, value.start)
        if value.kind == "name" and bare and bare[0].rstrip(".") == value.text:
            names.setdefault(value.text, set()).add(name)
        if bare:
            literals.setdefault(name, []).append((bare[0].rstrip("."), bare.start(), bare.start() + len(bare[0].rstrip("."))))
    return literals, names


def reached(literals: dict[str, list], names: dict[str, set[str]]) -> dict[str, float]:
    """For each name the largest score of the names its literals get to, itself included.

    Names are taken from the largest score down, and each gives its score to all that lead to
    it and have none yet, so that every name is passed once.
    """
    before: dict[str, list[str]] = {name: [] for name in literals}
    for source, targets in names.items():
        before.setdefault(source, [])
        for target in targets:
            before.setdefault(target, []).append(source)
    own = {name: name_score(name) for name in before}
    found: dict[str, float] = {}
    for name in sorted(own, key=own.get, reverse=True):
        todo = [name]
        while todo:
            one = todo.pop()
            if one not in found:
                found[one] = own[name]
                todo += before[one]
    return found


def find(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans, and those of literals that reach sensitive names."""
    base = base_spans(text)
    if not _SENSITIVE.search(text):
        return base, []
    literals, names = pairs(text)
    strengths = reached(literals, names)
    taken = Covered((a, b) for _, a, b in base)
    added = set()
    for name, values in literals.items():
        strength = strengths[name]
        if not strength:
            continue
        for value, a, b in values:
            # a bare name is a constant's name, not a value
            known = value in literals or value in names
            if not known and strength * value_score(value) >= THRESHOLD and not taken.holds(a, b):
                added.add(("literal", a, b))
    return base, sorted(added, key=lambda s: s[1:])


def spans(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_<kind> (base spans), base_sha256, spans (all), n_added."""
    return span_rows(docs, find, KINDS)
