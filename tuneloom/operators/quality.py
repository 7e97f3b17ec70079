"""Quality checks: one pass over the data, one aggregation, one report row
(or one per dataset id)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.jsontext import json_valid
from ..functions.pii import PII_PATTERNS, has_pii
from ..functions.text import (
    all_blank,
    all_of,
    count_cells,
    is_string,
    quoted,
    same_stripped,
    text_of,
    truthy,
)

# Check names in report order; the hard ones decide the verdict.
CHECKS = [
    "required_columns_present",
    "no_fully_empty_rows",
    "no_degenerate_pairs",
    "min_row_count",
    "pii_scan",
    "json_valid",
]
HARD_CHECKS = ["required_columns_present", "no_fully_empty_rows", "min_row_count"]
# Where structured text is looked for, first hit wins.
JSON_COLUMNS = ["output", "response", "completion"]

PII_COUNTS = [f"n_{kind}" for kind in PII_PATTERNS]
COUNTS = ["n_rows", "n_empty", "n_degenerate", *PII_COUNTS, "n_bad_json"]


def default_min_rows(rows: int, min_rows_output: int | None = None) -> int:
    """The registry's own minimum, else 80 % of the rows asked for."""
    return min_rows_output or int(rows * 0.8)


def min_rows_column(rows: Column, min_rows_output: Column) -> Column:
    share = F.floor(rows * F.lit(0.8)).cast("long")
    return F.coalesce(F.nullif(min_rows_output.cast("long"), F.lit(0).cast("long")), share)


def json_column(columns: list[str], candidates: list[str] = JSON_COLUMNS) -> str | None:
    return next((c for c in candidates if c in columns), None)


def row_flags(df: DataFrame, required: list[str], exclude: list[str] = ()) -> dict[str, Column]:
    """Per-row integers that add up to the counts of the report. ``exclude``
    names columns that are no part of the dataset (such as its id)."""
    types = {f.name: f.dataType for f in df.schema}
    texts = [n for n, t in types.items() if is_string(t) and n not in exclude]
    present = [c for c in required if c in types]
    empty = all_blank({c: types[c] for c in present})

    same = F.lit(False)
    if "instruction" in types and "response" in types:
        a, b = [(c, types[c]) for c in ("instruction", "response")]
        same = truthy(*a) & truthy(*b) & same_stripped(text_of(*a), text_of(*b))

    flags = {
        "n_empty": empty.cast("int"),
        "n_degenerate": F.coalesce(same, F.lit(False)).cast("int"),
    }
    for kind, name in zip(PII_PATTERNS, PII_COUNTS):
        flags[name] = count_cells(texts, lambda c, kind=kind: has_pii(c, kind))

    return flags


def checked_column(
    df: DataFrame, output_type: str, json_columns: list[str], exclude: list[str] = ()
) -> str | None:
    """The string column whose JSON is checked, if any."""
    if output_type != "structured":
        return None
    name = json_column([c for c in df.columns if c not in exclude], json_columns)
    return name if name and is_string(df.schema[name].dataType) else None


def bad_json_flag(c: Column, exact: bool = True) -> Column:
    """1 for text that is not JSON; null has nothing to check."""
    return F.coalesce((~json_valid(c, exact)).cast("int"), F.lit(0))


def count_columns(flags: dict[str, Column]) -> list[Column]:
    """Aggregates over row flags; also usable in DataFrame.observe."""
    totals = [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(n) for n, c in flags.items()]
    return [F.count(F.lit(1)).alias("n_rows"), *totals]


def quality_counts(
    df: DataFrame,
    required: list[str],
    output_type: str = "default",
    by: str | None = None,
    json_columns: list[str] = JSON_COLUMNS,
    exact_json: bool = True,
) -> DataFrame:
    """Counts behind the report: one row, or one per value of ``by``."""
    exclude = [by] if by else []
    keys = [F.col(quoted(by))] if by else []
    flags = row_flags(df, required, exclude)
    checked = checked_column(df, output_type, json_columns, exclude)
    # From here on rows hold small numbers and, if it is checked, one text.
    to_parse = [F.col(quoted(checked)).alias("__json")] if checked else []
    narrow = df.select(*keys, *[c.alias(n) for n, c in flags.items()], *to_parse)
    bad = bad_json_flag(F.col("__json"), exact_json) if checked else F.lit(0)
    totals = count_columns({**{n: F.col(n) for n in flags}, "n_bad_json": bad})
    return narrow.groupBy(*keys).agg(*totals)


def report_columns(
    missing: list[str] | Column,
    min_rows: Column,
    json_name: str | Column | None = None,
    rows_in: Column | None = None,
) -> dict[str, Column]:
    """Checks, verdict and messages from the counts. The missing columns and the
    name of the JSON column are known beforehand or, where every row is a
    dataset of its own, columns of the counts."""
    if not isinstance(missing, Column):
        missing = F.array(*map(F.lit, missing)).cast("array<string>")
    if not isinstance(json_name, Column):
        json_name = F.lit(str(json_name))
    n = {name: F.col(name) for name in COUNTS}
    pii_total = sum((n[c] for c in PII_COUNTS), F.lit(0))
    passed = {
        "required_columns_present": F.size(missing) == 0,
        "no_fully_empty_rows": n["n_empty"] == 0,
        "no_degenerate_pairs": n["n_degenerate"] == 0,
        "min_row_count": n["n_rows"] >= min_rows,
        "pii_scan": pii_total == 0,
        "json_valid": n["n_bad_json"] == 0,
    }

    def message(name: str, *parts) -> Column:
        return F.when(~passed[name], F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts]))

    found = F.array_compact(
        F.array(
            *[
                F.when(n[c] > 0, F.concat(F.lit(f"'{kind}': "), n[c].cast("string")))
                for kind, c in zip(PII_PATTERNS, PII_COUNTS)
            ]
        )
    )
    quotes = F.transform(missing, lambda c: F.concat(F.lit("'"), c, F.lit("'")))
    names = F.concat(F.lit("["), F.array_join(quotes, ", "), F.lit("]"))
    errors = [
        message("required_columns_present", "Missing required columns: ", names),
        message("no_fully_empty_rows", n["n_empty"].cast("string"), " rows have no required value"),
        message(
            "min_row_count",
            "Row count ", n["n_rows"].cast("string"), " is below the minimum of ", min_rows.cast("string"),
        ),
    ]
    warnings = [
        message("no_degenerate_pairs", n["n_degenerate"].cast("string"), " rows have instruction == response"),
        message("pii_scan", "Possible PII, review before publishing: {", F.array_join(found, ", "), "}"),
        message(
            "json_valid",
            n["n_bad_json"].cast("string"), " rows in '", F.coalesce(json_name, F.lit("None")), "' are not valid JSON",
        ),
    ]
    return {
        "passed": all_of([passed[c] for c in HARD_CHECKS]),
        "checks": F.create_map(*[x for c in CHECKS for x in (F.lit(c), passed[c])]),
        "warnings": F.array_compact(F.array(*warnings)),
        "errors": F.array_compact(F.array(*errors)),
        "rows_in": (rows_in if rows_in is not None else n["n_rows"]).cast("long"),
        "rows_out": n["n_rows"],
    }


def report_from_counts(
    counts: DataFrame, missing: list[str], min_rows: int | Column, json_name: str | None = None,
    rows_in: Column | None = None,
) -> DataFrame:
    limit = min_rows if isinstance(min_rows, Column) else F.lit(min_rows).cast("long")
    return counts.withColumns(report_columns(missing, limit, json_name, rows_in))


def quality_report(
    df: DataFrame,
    required: list[str],
    min_rows: int | Column,
    output_type: str = "default",
    by: str | None = None,
    json_columns: list[str] = JSON_COLUMNS,
    exact_json: bool = True,
    limits: DataFrame | None = None,
    default_min: int = 1,
) -> DataFrame:
    """Report of one dataset, or one row per dataset id in column ``by``.

    ``min_rows`` may be a column of ``limits``, a frame with one row per id
    that is joined to the (already aggregated) counts. An id with a limit but
    without rows has counts of 0; one without a limit needs ``default_min`` rows.
    """
    counts = quality_counts(df, required, output_type, by, json_columns, exact_json)
    if limits is not None:
        counted = [c for c in counts.columns if c != by]
        counts = counts.join(limits, by, "full").fillna(0, subset=counted)
        limit = min_rows if isinstance(min_rows, Column) else F.lit(min_rows)
        min_rows = F.coalesce(limit.cast("long"), F.lit(default_min).cast("long"))
    columns = [c for c in df.columns if c != by]
    missing = [c for c in required if c not in df.columns]
    return report_from_counts(counts, missing, min_rows, json_column(columns, json_columns))


def report_long(report: DataFrame, by: str | None = None) -> DataFrame:
    """One row per check: its severity, whether it passed and the count behind it."""
    behind = {
        "required_columns_present": F.lit(None).cast("long"),
        "no_fully_empty_rows": F.col("n_empty"),
        "no_degenerate_pairs": F.col("n_degenerate"),
        "min_row_count": F.col("n_rows"),
        "pii_scan": sum((F.col(c) for c in PII_COUNTS), F.lit(0)).cast("long"),
        "json_valid": F.col("n_bad_json"),
    }
    rows = [
        F.struct(
            F.lit(c).alias("check"),
            F.lit("hard" if c in HARD_CHECKS else "soft").alias("severity"),
            F.col("checks")[c].alias("passed"),
            behind[c].alias("n"),
        )
        for c in CHECKS
    ]
    keys = [quoted(by)] if by else []
    return report.select(*keys, F.inline(F.array(*rows)))


def report_text(report: DataFrame, by: str | None = None) -> DataFrame:
    """The report as a few lines of text."""
    state = F.when(F.col("passed"), F.lit("PASSED")).otherwise(F.lit("FAILED"))
    first = F.concat(
        F.lit("Validation "), state, F.lit(" — "),
        F.col("rows_out").cast("string"), F.lit("/"), F.col("rows_in").cast("string"), F.lit(" rows"),
    )
    checks = [
        F.concat(F.when(F.col("checks")[c], F.lit("  ✓ ")).otherwise(F.lit("  ✗ ")), F.lit(c))
        for c in CHECKS
    ]
    lines = F.concat(
        F.array(first, *checks),
        F.transform("warnings", lambda w: F.concat(F.lit("  ⚠  "), w)),
        F.transform("errors", lambda e: F.concat(F.lit("  ✗ "), e)),
    )
    keys = [quoted(by)] if by else []
    return report.select(*keys, F.array_join(lines, "\n").alias("summary"))
