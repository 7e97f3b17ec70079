"""Personal-data patterns as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import PY_WHITESPACE_CLASS

# The three kinds and their patterns, in report order.
PII_PATTERNS = {
    "ssn": r"\b\d{3}-\d{2}-\d{4}\b",
    "phone": r"\b(?:\+1[-.\s]?)?\(?\d{3}\)?[-.\s]?\d{3}[-.\s]?\d{4}\b",
    "email": r"\b[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}\b",
}

# What every match contains, as something quick to look for.
_CORES = {
    "ssn": r"\d{3}-\d{2}-\d{4}",
    "phone": r"\d{3}\)?[-.\s]?\d{3}[-.\s]?\d{4}",
    "email": r"[A-Za-z0-9._%+\-]@[A-Za-z0-9.\-]+\.[A-Za-z]{2}",
}

# \b, \d and \s spelled out with their Unicode meaning, since Java's defaults
# are ASCII and its (?U) mode counts combining marks as word characters.
_WORD = r"[\p{L}\p{N}_]"
_BOUNDARY = rf"(?:(?<={_WORD})(?!{_WORD})|(?<!{_WORD})(?={_WORD}))"


def _java_pattern(pattern: str) -> str:
    return (
        pattern.replace(r"\b", _BOUNDARY)
        .replace(r"\d", r"\p{Nd}")
        .replace(r"\s", PY_WHITESPACE_CLASS)
    )


def has_pii(c: Column, kind: str) -> Column:
    """Whether the text holds a match; null for null.

    Three tests, each run only if the one before holds: an '@' or four digits
    in a row, the core of the pattern, the pattern with its word boundaries.
    """
    rare = F.contains(c, F.lit("@")) if kind == "email" else F.rlike(c, F.lit(r"\p{Nd}{4}"))
    core = F.rlike(c, F.lit(_java_pattern(_CORES[kind])))
    return rare & core & F.rlike(c, F.lit(_java_pattern(PII_PATTERNS[kind])))
