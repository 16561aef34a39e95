"""Ordered rules over text: first match wins, or all reasons are listed. Patterns stay within what RE2 and Java share."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def any_word(words: Sequence[str]) -> str:
    """A pattern for any of the words between ASCII word boundaries, the same in RE2 and Java (no \\b, no lookaround)."""
    return "(^|[^A-Za-z0-9_])(" + "|".join(words) + ")([^A-Za-z0-9_]|$)"


def first_match(text: Column, rules: Sequence[tuple[str, str]], default: str | None = None) -> Column:
    """The name of the first rule (name, pattern) whose pattern is found in ``text``."""
    name, pattern = rules[0]
    out = reduce(lambda c, r: c.when(text.rlike(r[1]), r[0]), rules[1:], F.when(text.rlike(pattern), name))
    return out.otherwise(F.lit(default))


def first_of(cases: Sequence[tuple[Column, str]], default: str | None = None) -> Column:
    """The name of the first condition that holds."""
    out = reduce(lambda c, r: c.when(r[0], r[1]), cases[1:], F.when(*cases[0]))
    return out.otherwise(F.lit(default))


def first_reason(cases: Sequence[tuple[Column, Column]]) -> Column:
    """The text beside the first condition that holds; null if none does. An unknown condition doesn't hold."""
    return F.coalesce(*[F.when(F.coalesce(c, F.lit(False)), text) for c, text in cases])


def sql_case(text: str, rules: Sequence[tuple[str, str]], default: str | None = None) -> str:
    """The CASE expression over regexp_matches that gives the name of the first rule; ``text`` is an SQL expression."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    cases = " ".join(f"WHEN regexp_matches({text}, {quoted(p)}) THEN {quoted(n)}" for n, p in rules)
    return f"CASE {cases} ELSE {'NULL' if default is None else quoted(default)} END"


def all_reasons(cases: Sequence[tuple[Column, str]]) -> Column:
    """Names of all conditions that hold, in order."""
    return F.array_compact(F.array(*[F.when(c, F.lit(n)) for c, n in cases]))


def bands(value: Column, edges: Sequence[float], names: Sequence[str], missing: str = "none") -> Column:
    """The name of the band that ``value`` falls in: below edges[0], below edges[1], and so on; ``missing`` for null."""
    out = F.when(value.isNull(), missing)
    for edge, name in zip(edges, names, strict=False):
        out = out.when(value < edge, name)
    return out.otherwise(names[-1])
