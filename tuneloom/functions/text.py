"""String helpers as Column expressions (all JVM-side, no UDFs)."""

from __future__ import annotations

import string
from functools import reduce
from typing import Callable

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

# Every character for which Python's str.isspace() is true.
# Spark's own trim only removes U+0020 and Java's \s is ASCII-only.
PY_WHITESPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0" + "".join(
    map(chr, [0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)
# The same set as the body of a regex character class.
PY_WHITESPACE_CLASS = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)


# Tests over more columns than this loop over an array, since code generated
# for each column would become too large.
WIDE = 20


def strip(c: Column) -> Column:
    """Unicode-aware ``str.strip()``."""
    return F.btrim(c, F.lit(PY_WHITESPACE))


def is_blank(c: Column) -> Column:
    """True when nothing is left after a Unicode strip; null for null."""
    return F.ltrim(c, F.lit(PY_WHITESPACE)) == F.lit("")


def same_stripped(a: Column, b: Column) -> Column:
    """strip(a) == strip(b), without stripping texts that have no space at either end."""

    def edges_filled(c: Column) -> Column:
        spaces = F.lit(PY_WHITESPACE)
        return ~F.contains(spaces, F.substring(c, 1, 1)) & ~F.contains(spaces, F.substring(c, -1, 1))

    return F.when(edges_filled(a) & edges_filled(b), a == b).otherwise(strip(a) == strip(b))


def truthy(name: str, dtype: T.DataType) -> Column:
    """Python's truth value of a cell; null for null."""
    c = F.col(quoted(name))
    if is_string(dtype):
        return c != F.lit("")
    if isinstance(dtype, T.NumericType):
        return c != F.lit(0)
    if isinstance(dtype, T.BooleanType):
        return c
    if isinstance(dtype, (T.ArrayType, T.MapType)):
        return F.size(c) > 0
    return F.when(c.isNotNull(), F.lit(True))


def is_string(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StringType, T.VarcharType, T.CharType))


def null_or_blank(name: str, dtype: T.DataType) -> Column:
    """Null, or (strings only) blank. Never null itself."""
    c = F.col(quoted(name))
    if is_string(dtype):
        return F.coalesce(is_blank(c), F.lit(True))
    return c.isNull()


def all_blank(cells: dict[str, T.DataType]) -> Column:
    """Every cell null or blank; true without cells."""
    if len(cells) <= WIDE:
        return all_of([null_or_blank(name, kind) for name, kind in cells.items()])
    texts, flags = _cells(cells)
    return F.forall(texts, lambda c: F.coalesce(is_blank(c), F.lit(True))) & F.forall(
        flags, lambda missing: missing
    )


def any_blank(cells: dict[str, T.DataType]) -> Column:
    """Some cell null or blank; false without cells."""
    if len(cells) <= WIDE:
        return ~all_of([~null_or_blank(name, kind) for name, kind in cells.items()])
    texts, flags = _cells(cells)
    return F.exists(texts, lambda c: F.coalesce(is_blank(c), F.lit(True))) | F.exists(
        flags, lambda missing: missing
    )


def count_cells(names: list[str], test: Callable[[Column], Column]) -> Column:
    """How many of the string cells pass the test; null cells do not."""

    def passes(c: Column) -> Column:
        return F.coalesce(test(c), F.lit(False))

    if len(names) <= WIDE:
        return sum((passes(F.col(quoted(n))).cast("int") for n in names), F.lit(0))
    return F.size(F.filter(F.array(*map(F.col, map(quoted, names))), passes))


def _cells(cells: dict[str, T.DataType]) -> tuple[Column, Column]:
    """Strings as one array, and as another whether each other cell is null."""
    texts = [F.col(quoted(n)) for n, t in cells.items() if is_string(t)]
    others = [F.col(quoted(n)).isNull() for n, t in cells.items() if not is_string(t)]
    return F.array(*texts).cast("array<string>"), F.array(*others).cast("array<boolean>")


def quoted(name: str) -> str:
    """Column name safe for F.col even when it contains dots."""
    return "`" + name.replace("`", "``") + "`"


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def remove_prefix(c: Column, prefix: str) -> Column:
    return F.when(c.startswith(prefix), F.substr(c, F.lit(len(prefix) + 1))).otherwise(c)


def strip_chars_left(c: Column, chars: str) -> Column:
    return F.ltrim(c, F.lit(chars))


def strip_chars_right(c: Column, chars: str) -> Column:
    return F.rtrim(c, F.lit(chars))


def truncate(c: Column, n: int) -> Column:
    return F.substring(c, 1, n)


def last_segment(c: Column, sep: str = "/") -> Column:
    return F.substring_index(c, sep, -1)


def extension(path: Column) -> Column:
    """Lower-cased extension with its dot; '' when there is none. Leading dots
    of the base name do not start an extension ('.csv' has none)."""
    return F.regexp_extract(F.lower(path), r"[^/.][^/]*(\.[^/.]*)$", 1)


def join_or_default(items: Column, sep: str, default: str) -> Column:
    """Join an array; null or empty gives ``default``."""
    return F.coalesce(F.nullif(F.array_join(items, sep), F.lit("")), F.lit(default))


def text_of(name: str, dtype: T.DataType) -> Column:
    """Printable form of any value; null prints as 'None'."""
    c = F.col(quoted(name))
    if is_string(dtype):
        shown = c
    elif isinstance(dtype, T.BooleanType):
        shown = F.when(c, F.lit("True")).otherwise(F.lit("False"))
    elif isinstance(dtype, T.ArrayType) and is_string(dtype.elementType):
        shown = list_text(c)
    elif isinstance(dtype, (T.ArrayType, T.StructType, T.MapType)):
        shown = F.to_json(c, {"ignoreNullFields": "false"})
    else:
        shown = c.cast("string")
    return F.when(c.isNull(), F.lit("None")).otherwise(shown)


def list_text(items: Column) -> Column:
    """array<string> printed the way Python prints a list of str."""

    def one(x: Column) -> Column:
        esc = x
        for raw, shown in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
            esc = F.replace(esc, F.lit(raw), F.lit(shown))
        double = F.contains(x, F.lit("'")) & ~F.contains(x, F.lit('"'))
        return (
            F.when(x.isNull(), F.lit("None"))
            .when(double, F.concat(F.lit('"'), esc, F.lit('"')))
            .otherwise(F.concat(F.lit("'"), F.replace(esc, F.lit("'"), F.lit("\\'")), F.lit("'")))
        )

    return F.concat(F.lit("["), F.array_join(F.transform(items, one), ", "), F.lit("]"))


def fill_template(template: str, values: dict[str, Column]) -> Column:
    """Fill ``{name}`` placeholders. ``{{`` and ``}}`` stand for braces."""
    parts: list[Column] = []
    for literal, field, _, _ in string.Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if field is not None:
            parts.append(values[field])
    return F.concat(*parts) if parts else F.lit("")
