"""Quality reports of datasets with different columns, each against its own
contract, in one aggregation."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.pii import PII_PATTERNS, has_pii
from ..functions.text import is_blank, is_string, same_stripped, text_of, truthy
from .quality import COUNTS, JSON_COLUMNS, PII_COUNTS, bad_json_flag, count_columns, report_columns

#: Bits of a long that say which required columns a row has.
WORD = 62
CELLS = "map<string,struct<value:string,text:boolean,truth:boolean>>"


def as_cells(df: DataFrame, dataset_id: str, by: str = "dataset_id") -> DataFrame:
    """``by``, cells, header: rows of any table in one shape, so that tables with
    different columns can be put together. A cell has its printed value (null for
    null), whether it is a text, and Python's truth value. One row more, the
    header, has the columns without values, so that a table without rows still
    has its columns."""
    types = {f.name: f.dataType for f in df.schema}

    def cells(empty: bool) -> Column:
        found = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")).cast(CELLS)
        parts = []
        for name, kind in types.items():
            value = F.lit(None).cast("string") if empty else F.when(F.col(_q(name)).isNotNull(), text_of(name, kind))
            truth = F.lit(None).cast("boolean") if empty else truthy(name, kind)
            parts += [
                F.lit(name),
                F.struct(value.alias("value"), F.lit(is_string(kind)).alias("text"), truth.alias("truth")),
            ]
        return F.create_map(*parts).cast(CELLS) if parts else found

    key = F.lit(dataset_id).alias(by)
    rows = df.select(key, cells(False).alias("cells"), F.lit(False).alias("header"))
    header = df.sparkSession.range(1).select(key, cells(True).alias("cells"), F.lit(True).alias("header"))
    return rows.union(header)


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def union_cells(tables: dict[str, DataFrame], by: str = "dataset_id") -> DataFrame:
    """The rows of many tables, each named by its id, in one shape."""
    return reduce(DataFrame.union, [as_cells(df, name, by) for name, df in tables.items()])


def contract_report(
    rows: DataFrame, contracts: DataFrame, by: str = "dataset_id", default_min: int = 1, exact_json: bool = True
) -> DataFrame:
    """The report of ``quality_report``, one row per dataset, each checked by its
    own contract.

    ``rows`` has ``by``, cells (a map from column names, as ``as_cells`` makes it,
    or to plain strings) and, if it has such rows, header. ``contracts`` has ``by`` (once
    each) and any of required (array<string>), min_rows, output_type ("structured"
    has its JSON checked) and json_columns (array<string>, the first one that the
    dataset has is checked). What is null or absent there takes its default: all
    columns that there are, ``default_min`` rows, no JSON, the usual columns. A dataset
    without a contract gets these too; a contract without rows is a report of 0
    rows. All rows are read once, and a dataset's counts are added up before the
    shuffle.
    """
    config = _with_defaults(contracts, by, default_min)
    words = -(-(config.agg(F.max(F.size("required")).alias("n")).first()["n"] or 1) // WORD) or 1
    if "header" not in rows.columns:
        rows = rows.withColumn("header", F.lit(False))
    if not rows.schema["cells"].dataType.valueType.simpleString().startswith("struct"):
        cell = lambda _, v: F.struct(v.alias("value"), F.lit(True).alias("text"), (v != "").alias("truth"))
        rows = rows.withColumn("cells", F.transform_values("cells", cell).cast(CELLS))
    checked = rows.select(by, "cells", "header").join(config.drop("min_rows"), by, "left")
    required = F.coalesce("required", F.array().cast("array<string>"))
    candidates = F.coalesce("json_columns", F.array(*map(F.lit, JSON_COLUMNS)))
    looked_at = F.coalesce("required", F.map_keys("cells"), F.array().cast("array<string>"))
    flags = {n: F.when(F.col("header"), 0).otherwise(c) for n, c in _flags(looked_at).items()}
    masks = {f"has_{w}": _present(required, w) for w in range(words)}
    narrow = checked.select(
        by,
        "header",
        *[c.alias(n) for n, c in (flags | masks).items()],
        _json_text(candidates).alias("json"),
        _json_name(candidates).alias("json_name"),
    )
    totals = count_columns({n: F.col(n) for n in flags} | {"n_bad_json": bad_json_flag(F.col("json"), exact_json)})
    totals[0] = F.count_if(~F.col("header")).alias("n_rows")
    seen = [F.bit_or(n).alias(n) for n in masks]
    counts = narrow.groupBy(by).agg(*totals, *seen, F.min("json_name").alias("json_name"))
    counts = counts.join(config, by, "full").fillna(0, subset=[*COUNTS, *masks])
    counts = counts.withColumns({"required": required, "min_rows": F.coalesce("min_rows", F.lit(default_min).cast("long"))})
    counts = counts.withColumn("missing", _missing(words))
    report = counts.withColumns(report_columns(F.col("missing"), F.col("min_rows"), F.col("json_name")))
    return report.drop("required", "output_type", "json_columns", *masks)


def _with_defaults(contracts: DataFrame, by: str, default_min: int) -> DataFrame:
    defaults = {
        "required": F.lit(None).cast("array<string>"),
        "min_rows": F.lit(default_min).cast("long"),
        "output_type": F.lit("default"),
        "json_columns": F.array(*map(F.lit, JSON_COLUMNS)),
    }
    given = {n: F.coalesce(F.col(n).cast(_kinds[n]), d) if n in contracts.columns else d for n, d in defaults.items()}
    return contracts.select(by, *[c.alias(n) for n, c in given.items()])


_kinds = {"required": "array<string>", "min_rows": "long", "output_type": "string", "json_columns": "array<string>"}


def _cell(name: Column) -> Column:
    return F.col("cells")[name]


def _flags(required: Column) -> dict[str, Column]:
    """Per-row integers that add up to the counts of the report."""
    present = F.filter(required, lambda c: F.map_contains_key("cells", c))
    blank = lambda c: F.when(c["text"], F.coalesce(is_blank(c["value"]), F.lit(True))).otherwise(c["value"].isNull())
    a, b = (F.col("cells")[n] for n in ("instruction", "response"))
    same = a["truth"] & b["truth"] & same_stripped(a["value"], b["value"])
    flags = {
        "n_empty": F.forall(present, lambda c: blank(_cell(c))).cast("int"),
        "n_degenerate": F.coalesce(same, F.lit(False)).cast("int"),
    }
    texts = F.transform(F.filter(F.map_values("cells"), lambda c: c["text"]), lambda c: c["value"])
    for kind, name in zip(PII_PATTERNS, PII_COUNTS):
        flags[name] = F.size(F.filter(texts, partial(_holds, kind)))
    return flags


def _holds(kind: str, c: Column) -> Column:
    return F.coalesce(has_pii(c, kind), F.lit(False))


def _present(required: Column, word: int) -> Column:
    """A bit for each required column of a word of them that the row has."""
    part = F.slice(required, 1 + word * WORD, WORD)
    bit = lambda c, i: F.when(F.map_contains_key("cells", c), F.call_function("shiftleft", F.lit(1).cast("bigint"), i))
    bits = F.transform(part, lambda c, i: F.coalesce(bit(c, i), F.lit(0).cast("bigint")))
    return F.aggregate(bits, F.lit(0).cast("bigint"), lambda a, b: a.bitwiseOR(b))


def _missing(words: int) -> Column:
    """The required columns whose bit no row has set."""
    parts = []
    for w in range(words):
        part = F.slice("required", 1 + w * WORD, WORD)
        bit = lambda i, w=w: F.call_function("shiftright", F.col(f"has_{w}"), i).bitwiseAND(F.lit(1))
        parts.append(F.filter(part, lambda c, i: bit(i) == 0))
    return F.concat(*parts)


def _json_name(candidates: Column) -> Column:
    """The first candidate among the columns, if JSON is wanted."""
    found = F.filter(candidates, lambda c: F.map_contains_key("cells", c))
    return F.when((F.col("output_type") == "structured") & (F.size(found) > 0), F.try_element_at(found, F.lit(1)))


def _json_text(candidates: Column) -> Column:
    cell = F.col("cells")[_json_name(candidates)]
    return F.when(~F.col("header") & cell["text"], cell["value"])
