"""Sort load-error messages into categories."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values: (category, needles matched as is, needles matched in lower case);
# the first rule that matches wins.
ERROR_RULES = [
    ("not_found", ["404"], ["doesn't exist"]),
    ("auth", ["401", "403"], ["authentication"]),
    ("subset", [], ["config", "subset"]),
    ("split", [], ["split"]),
]
GENERIC = "generic"

ERROR_HINTS = {
    "not_found": "Dataset not found → check the name, or ask for access if it is private",
    "auth": "Access denied → check the credentials and their read permission",
    "subset": "A subset name is needed → set 'subset' in the registry entry",
    "split": "Split not found → set 'split' to one that exists",
    "generic": "Could not be loaded → check the path, the format and the storage",
}

# Messages after which the next source may be tried.
LEGACY_SCRIPT_MESSAGES = (["scripts are no longer supported"], ["loading script"])


def error_category(message: Column) -> Column:
    lower = F.lower(message)
    out = F.when(F.lit(False), F.lit(GENERIC))
    for category, as_is, lowered in ERROR_RULES:
        for needle in as_is:
            out = out.when(F.contains(message, F.lit(needle)), F.lit(category))
        for needle in lowered:
            out = out.when(F.contains(lower, F.lit(needle)), F.lit(category))
    return out.otherwise(F.lit(GENERIC))


def error_hint(category: Column) -> Column:
    out = F.when(F.lit(False), F.lit(""))
    for name, hint in ERROR_HINTS.items():
        out = out.when(category == name, F.lit(hint))
    return out


def mentions(message: str, as_is: list[str], lowered: list[str]) -> bool:
    low = message.lower()
    return any(n in message for n in as_is) or any(n in low for n in lowered)


def category_of(message: str) -> str:
    """The same rules for one message on the driver."""
    return next((c for c, a, b in ERROR_RULES if mentions(message, a, b)), GENERIC)
