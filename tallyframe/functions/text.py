"""String normalisation and ordered rename rules."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

# All Unicode white space, and the four separator controls Java leaves out.
_OUTER_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def strip(column: Column) -> Column:
    """Remove white space of every kind from both ends."""
    return F.regexp_replace(column, _OUTER_SPACE, "")


def normalize(column: Column) -> Column:
    """Lower-case and strip."""
    return strip(F.lower(column))


@dataclass(frozen=True)
class Rule:
    """Rename a value that starts with / contains `text` to `name`."""

    kind: str
    text: str
    name: str

    def test(self, column: Column) -> Column:
        if self.kind == "prefix":
            return column.startswith(self.text)
        if self.kind == "contains":
            return column.contains(self.text)
        raise ValueError(f"unknown rule kind {self.kind!r}")


# Component families, tested in this order.
COMPONENT_PREFIXES = (
    "tptp", "update", "git", "ci", "user", "sql", "ruby",
    "gef", "cdt", "wst", "ecf", "jst", "xtest", "cdo",
)
COMPONENT_SUBSTRINGS = ("package", "connector", "report")


def family_rules(prefixes: Sequence[str], substrings: Sequence[str]) -> list[Rule]:
    """Rules that map each family to its own name, prefixes before substrings."""
    return [Rule("prefix", p, p) for p in prefixes] + [
        Rule("contains", s, s) for s in substrings
    ]


COMPONENT_RULES = family_rules(COMPONENT_PREFIXES, COMPONENT_SUBSTRINGS)


def apply_rules(column: Column, rules: Sequence[Rule]) -> Column:
    """The name of the first rule that holds, else the value itself."""
    if not rules:
        return column
    chain = None
    for rule in rules:
        branch = F.when if chain is None else chain.when
        chain = branch(rule.test(column), F.lit(rule.name))
    return chain.otherwise(column)
