"""Personal data in plain and disguised form.

Base spans are plain matches in the text. For disguises, three transducers rewrite a
text and keep, for every character they write, the source span it came from:
homoglyphs (look-alike letters, other scripts' digits, invisible characters), spelled
digits, and at/dot disguises. The same detectors run over the result, and a find is
mapped back to the source characters from its first to its last one. Finds without a
rewritten character are base spans already; finds inside a base span of their kind
are left out. Null texts are empty.

Time and memory are in proportion to the length of a text, whatever it holds. Repeated rows
have a row each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from array import array
from collections.abc import Iterable

from pyspark.sql import DataFrame

from tallyframe.llm.spans import Covered, Span, span_rows

KINDS = ("email", "ip", "card", "phone")

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(text: str) -> list[Span]:
    """Leftmost matches, found from their @: nothing before it is tried twice."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        if at >= free:
            domain = _DOMAIN.match(text, at + 1)
            if domain:
                start = at
                # a local part ends the last stretch of local characters before the @
                while start > free and not _NOT_LOCAL.match(text, start - 1):
                    start -= 1
                if start < at:
                    out.append(("email", start, domain.end()))
                    free = domain.end()
        at = text.find("@", at + 1)
    return out


def detect(text: str) -> list[Span]:
    """The base spans of all kinds."""
    out = emails(text)
    if _DIGIT.search(text):
        out += [("ip", *m.span()) for m in _IP.finditer(text)
                if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m.groups())]
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
        if "+" in text:
            out += [("phone", *m.span()) for m in _PHONE.finditer(text)
                    if 10 <= sum("0" <= c <= "9" for c in m[0]) <= 15]
    return out


# Letters and signs of other scripts that look like ASCII ones, and
# characters without width.
LOOK_ALIKES = (
    "аa АA еe ЕE оo ОO рp РP сc СC хx ХX уy УY кk КK мM МM тT ТT вB ВB нH НH іi ІI јj ЈJ ѕs ЅS ԁd ɡg "
    "αa ΑA εe ΕE οo ΟO ρp ΡP νv ΝN κk ΚK τt ΤT ιi ΙI ΒB ΗH ΜM ΧX ΥY ΖZ "
    "․. 。. ‐- ‑- ‒- –- −- ﹫@ ＠@"
)
INVISIBLE = "­​‌‍⁠﻿"
# English digit words.
DIGIT_WORDS = {"zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4",
               "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9"}
SPOKEN = DIGIT_WORDS | {"dot": ".", "point": ".", "dash": "-"}


def _homoglyphs() -> dict[str, str]:
    table = {pair[0]: pair[1] for pair in LOOK_ALIKES.split()}
    table |= dict.fromkeys(INVISIBLE, "")
    for code in [*range(0xFF01, 0xFF5F), *range(0x1D400, 0x1D800), *range(0x2460, 0x24EA)]:
        plain = unicodedata.normalize("NFKC", chr(code))
        if len(plain) == 1 and plain.isascii():
            table[chr(code)] = plain
    for code in range(0x660, 0x1100):
        if unicodedata.category(chr(code)) == "Nd":
            table[chr(code)] = str(unicodedata.digit(chr(code)))
    return table


HOMOGLYPHS = _homoglyphs()
GLYPHS = frozenset(HOMOGLYPHS)
_NUMBER = "(?:" + "|".join(DIGIT_WORDS) + ")"
_JOINED = rf"(?:[ ]+(?:dot|point|dash)[ ]+|[ ,.-]{{1,2}})(?:{_NUMBER}|[0-9]+)(?![A-Za-z])"
_SPELLED = re.compile(rf"(?<![A-Za-z]){_NUMBER}(?:{_JOINED})+", re.I)
_SPELLED_PART = re.compile(rf"{_NUMBER}|dot|point|dash|[ ,]+", re.I)
_PLUS = re.compile(r"(?<![A-Za-z])plus\s+(?=[0-9])", re.I)
_AT_SIGN = r"[\[({<]\s*+(?:at|@)\s*+[\])}>]"
_DOT_SIGN = r"[\[({<]\s*+(?:dot|punkt|punto|point|\.)\s*+[\])}>]"
# Blanks before a sign are tried from the start of their run alone, so long runs stay linear.
_BRACKET_AT = re.compile(rf"(?:(?<!\s)\s++)?{_AT_SIGN}\s*+", re.I)
_BRACKET_DOT = re.compile(rf"(?:(?<!\s)\s++)?{_DOT_SIGN}\s*+", re.I)
# Last labels that let a bare `at` and `dot` count.
LAST_LABELS = ("com org net edu gov mil int info biz name io dev app ai co me tv eu uk us ca de fr "
               "es it nl at ch pl se no be pt ru cn jp kr in br mx au nz example test invalid")
_BARE_AT = re.compile(
    r"(?<=[A-Za-z0-9])\s+at\s+(?=[A-Za-z0-9-]{1,63}(?:\s+dot\s+[A-Za-z0-9-]{1,63}){0,4}\s+dot\s+(?:"
    + "|".join(LAST_LABELS.split()) + r")(?![A-Za-z0-9-]))", re.I)
# behind a name with a digit, an underscore or an inner dot, before a plain domain
_NAMED_AT = re.compile(
    r"(?<![A-Za-z0-9._%+-])(?=[A-Za-z%+-]*+(?:[0-9_]|\.(?=[A-Za-z0-9])))[A-Za-z0-9._%+-]++(\s++at\s++)"
    r"(?=(?:[A-Za-z0-9-]{1,63}\.){1,5}(?:" + "|".join(LAST_LABELS.split()) + r")(?![A-Za-z0-9-]))", re.I)
_BARE_DOT = re.compile(r"(?<=[A-Za-z0-9])\s+dot\s+(?=[A-Za-z0-9])", re.I)
# One of these is in every ASCII text that a pattern above matches: its parts without
# the blanks around them; _BARE_AT and _BARE_DOT need a bare `dot`, _NAMED_AT an _AT_DOMAIN.
_HINT = re.compile(
    rf"{_AT_SIGN}|{_DOT_SIGN}|\sdot\s|(?<![A-Za-z])(?:{_NUMBER}{_JOINED}|{_PLUS.pattern.partition(')')[2]})", re.I)
_AT_DOMAIN = re.compile(r"\sat\s+[A-Za-z0-9-]+\.[A-Za-z0-9-]", re.I)


class Normalised:
    """A text with, for each character, the source span it stands for: nine bytes a character."""

    def __init__(self, text: str):
        self.text = text
        self.start, self.end = array("i", range(len(text))), array("i", range(1, len(text) + 1))
        self.changed = bytearray(len(text))

    def rewrite(self, edits: Iterable[tuple[int, int, str]]) -> None:
        """Replace text[a:b] by a string, for edits in order and apart."""
        text, start, end, changed, last = [], array("i"), array("i"), bytearray(), 0
        for a, b, new in edits:
            text += [self.text[last:a], new]
            start.extend(self.start[last:a])
            end.extend(self.end[last:a])
            changed += self.changed[last:a]
            for _ in new:
                start.append(self.start[a])
                end.append(self.end[b - 1])
                changed.append(1)
            if not new and changed:
                changed[-1] = 1  # a neighbour stands for what left
            last = b
        if last:
            start.extend(self.start[last:])
            end.extend(self.end[last:])
            self.text = "".join([*text, self.text[last:]])
            self.start, self.end, self.changed = start, end, changed + self.changed[last:]

    def source(self, a: int, b: int) -> tuple[int, int]:
        return self.start[a], self.end[b - 1]


def normalise(text: str) -> Normalised:
    """Homoglyphs, then spelled digits, then at/dot disguises."""
    out = Normalised(text)
    if not text.isascii():
        out.rewrite((i, i + 1, HOMOGLYPHS[c]) for i, c in enumerate(text) if c in GLYPHS)
    out.rewrite(
        (a + w.start(), a + w.end(), SPOKEN.get(w[0].lower(), ""))  # blanks between them go
        for a, run in ((m.start(), m[0]) for m in _SPELLED.finditer(out.text))
        for w in _SPELLED_PART.finditer(run)
    )
    out.rewrite((m.start(), m.end(), "+") for m in _PLUS.finditer(out.text))
    if _AT_DOMAIN.search(out.text):
        out.rewrite((*m.span(1), "@") for m in _NAMED_AT.finditer(out.text))
    for pattern, sign in ((_BRACKET_AT, "@"), (_BRACKET_DOT, "."), (_BARE_AT, "@"), (_BARE_DOT, ".")):
        out.rewrite((m.start(), m.end(), sign) for m in pattern.finditer(out.text))
    return out


def may_hide(text: str) -> bool:
    """Whether `normalise` may change the text."""
    return bool(_HINT.search(text) or _AT_DOMAIN.search(text)) or (
        not text.isascii() and not GLYPHS.isdisjoint(set(text)))


def find(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans, and those of disguised identifiers."""
    base = detect(text)
    if not may_hide(text):
        return base, []
    clear = normalise(text)
    taken = {k: Covered((a, b) for kind, a, b in base if kind == k) for k in KINDS}
    added = []
    for kind, a, b in detect(clear.text):
        if any(clear.changed[a:b]):
            start, end = clear.source(a, b)
            if not taken[kind].holds(start, end):
                added.append((kind, start, end))
    return base, added


def spans(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_<kind> (base spans), base_sha256, spans (all), n_added."""
    return span_rows(docs, find, KINDS)
