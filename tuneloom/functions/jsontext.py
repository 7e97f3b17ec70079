"""JSON in string columns: render, check, parse."""

from __future__ import annotations

from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .text import quoted


def json_scalar(c: Column) -> Column:
    """One value as JSON text (to_json only takes nested types, so wrap and unwrap)."""
    wrapped = F.to_json(F.array(c))
    return F.substring(wrapped, 2, F.length(wrapped) - 2)


def row_json(df: DataFrame, keys: list[str]) -> Column:
    """Row as a JSON object: the listed keys that exist, in list order, nulls
    kept, ', ' and ': ' as separators, non-ASCII text as is."""
    fields = [
        F.concat(json_scalar(F.lit(k)), F.lit(": "), json_scalar(F.col(quoted(k))))
        for k in keys
        if k in df.columns
    ]
    body = F.concat_ws(", ", *fields) if fields else F.lit("")
    return F.concat(F.lit("{"), body, F.lit("}"))


# The functions below are nested on purpose: nested functions travel to the
# Python workers by value, so executors need no copy of this package.


@lru_cache(maxsize=None)
def _valid_udf():
    @F.pandas_udf("boolean")
    def valid(texts: pd.Series) -> pd.Series:
        import json

        def ok(t):
            if t is None:
                return None
            try:
                json.loads(t)
            except (ValueError, RecursionError):
                return False
            return True

        return pd.Series([ok(t) for t in texts], dtype="object")

    return valid


def json_valid(c: Column, exact: bool = True) -> Column:
    """Whether the text is one JSON document; null for null.

    ``exact`` uses Python's parser in an Arrow UDF. The native form stays in
    the JVM but accepts trailing text and rejects NaN and repeated keys.
    """
    if exact:
        return _valid_udf()(c)
    return F.when(c.isNotNull(), F.try_parse_json(c).isNotNull())


@lru_cache(maxsize=None)
def _pair_udf(first: str, second: str):
    @F.pandas_udf("first string, second string")
    def pair(texts: pd.Series) -> pd.DataFrame:
        import json

        def read(t):
            try:
                obj = json.loads(t)
            except (TypeError, ValueError, RecursionError):
                return "", ""
            if not isinstance(obj, dict):
                return "", ""
            # A lone surrogate cannot be stored as UTF-8.
            return tuple(
                str(obj.get(k, "")).encode("utf-8", "replace").decode() for k in (first, second)
            )

        return pd.DataFrame([read(t) for t in texts], columns=["first", "second"])

    return pair


def parse_pair(c: Column, first: str, second: str, exact: bool = True) -> Column:
    """Two keys of a JSON object as struct(first, second). A missing key, text
    that does not parse and anything but an object give ''.

    ``exact`` prints values as Python does; the native form prints JSON
    (null gives '', true stays 'true').
    """
    if exact:
        return _pair_udf(first, second)(c)
    obj = F.from_json(F.when(json_valid(c, exact=False), c), f"`{first}` string, `{second}` string")
    return F.struct(
        F.coalesce(obj[first], F.lit("")).alias("first"),
        F.coalesce(obj[second], F.lit("")).alias("second"),
    )
