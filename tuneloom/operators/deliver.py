"""Delivery: snappy parquet, a second sink, dataset cards."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ..functions.schema import LONG, struct_of
from ..functions.text import fill_template, last_segment, truncate
from ..sources.storage import path_exists
from .quality import (
    COUNTS,
    JSON_COLUMNS,
    bad_json_flag,
    checked_column,
    count_columns,
    json_column,
    report_from_counts,
    row_flags,
)

log = logging.getLogger(__name__)

# Layout of the card, with {placeholders} filled per dataset.
CARD_TEMPLATE = """---
license: {license_tag}
tags:
  - {project_tag}
  - {recipe_target}
---

# {title}

## Dataset Details

| Field | Value |
|-------|-------|
| Source | {repo} |
| Rows | {rows} |
| Augmentation | {augmentation} |
| Fine-Tuning Target | {recipe_target} |
| Project | {project} |
| Processed | {date} |
| License | {license} |
"""


def delivery_path(base: str, subdir: str, dataset_id: str) -> str:
    return f"{base.rstrip('/')}/{subdir}/{dataset_id}.parquet"


def write_snappy(df: DataFrame, path: str, max_records_per_file: int = 0, *metrics) -> dict:
    """Write a folder of snappy files and return what was counted on the way.

    The counts come from the tasks that write, each counted once even if it
    ran twice.
    """
    seen = Observation()
    watched = df.observe(seen, F.count(F.lit(1)).alias("n_rows"), *metrics)
    writer = watched.write.mode("overwrite").option("compression", "snappy")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.parquet(path)
    return seen.get


def write_checked(
    df: DataFrame,
    path: str,
    required: list[str],
    min_rows: int,
    output_type: str = "default",
    json_columns: list[str] = JSON_COLUMNS,
    metrics: dict[str, Column] | None = None,
    drop: list[str] = (),
) -> DataFrame:
    """Write ``df`` and return its quality report. Rows are computed and checked
    once, while they are written: no second scan, and no second call of a model.
    ``metrics`` are further aggregates for the report; the columns in ``drop`` may be
    counted but are not written."""
    metrics = metrics or {}
    flags = row_flags(df, required, drop)
    checked = checked_column(df, output_type, json_columns)
    flags["n_bad_json"] = bad_json_flag(F.col(checked)) if checked else F.lit(0)
    helpers = {f"__{name}": c for name, c in flags.items()}
    seen = Observation()
    rows = df.withColumns(helpers).observe(
        seen,
        *count_columns({name: F.col(f"__{name}") for name in flags}),
        *[c.alias(name) for name, c in metrics.items()],
    )
    rows.drop(*helpers, *drop).write.mode("overwrite").option("compression", "snappy").parquet(path)
    counted = seen.get
    kinds = df.agg(*[c.alias(name) for name, c in metrics.items()]).schema if metrics else []
    schema = struct_of(**{name: LONG for name in COUNTS}, **{f.name: f.dataType for f in kinds})
    counts = df.sparkSession.createDataFrame([tuple(counted[c] for c in schema.names)], schema)
    missing = [c for c in required if c not in df.columns]
    return report_from_counts(counts, missing, min_rows, json_column(df.columns, json_columns))


def deliver(
    df: DataFrame,
    base: str,
    subdir: str,
    dataset_id: str,
    processed_at: str,
    publish_to: str | None = None,
    max_records_per_file: int = 0,
) -> DataFrame:
    """Write the dataset and, if asked, publish it. One row: where it went and
    how many rows it has. ``processed_at`` is given, so that runs can be repeated."""
    path = delivery_path(base, subdir, dataset_id)
    counted = write_snappy(df, path, max_records_per_file)
    published = publish(df.sparkSession, path, publish_to) if publish_to else False
    return delivery_result(
        df.sparkSession, dataset_id, path, publish_to, published, counted["n_rows"], processed_at
    )


def delivery_result(
    spark: SparkSession, dataset_id, path, publish_to, published, rows, processed_at
) -> DataFrame:
    return spark.createDataFrame(
        [(dataset_id, path, publish_to, published, rows, processed_at)],
        "dataset_id string, local_path string, published_to string, published boolean,"
        " rows long, processed_at string",
    )


def rescan(spark: SparkSession, path: str) -> DataFrame:
    """A delivered dataset; a missing one is an error."""
    if not path or not path_exists(spark, path):
        raise FileNotFoundError(f"nothing delivered at {path}")
    return spark.read.parquet(path)


def publish(spark: SparkSession, path: str, target: str) -> bool:
    """Copy a delivered dataset to a second folder (anything with a '/') or a
    catalog table. A failure is logged and reported, never raised: the first
    copy stays."""
    try:
        writer = rescan(spark, path).write.mode("overwrite").option("compression", "snappy")
        if "/" in target:
            writer.parquet(target)
        else:
            writer.saveAsTable(target)
        return True
    except Exception as e:  # any sink may fail in its own way
        log.error("publishing %s to %s failed: %s", path, target, e)
        return False


def dataset_cards(ledger: DataFrame, license: str = "CC-BY-4.0") -> DataFrame:
    """dataset_id, card: Markdown with front matter, one row per ledger entry."""
    values = {
        "license_tag": F.lit(license.lower()),
        "license": F.lit(license),
        "project_tag": F.lower("project"),
        "title": last_segment(F.col("output_name")),
        "rows": F.col("rows_out").cast("string"),
        "date": truncate(F.col("processed_at"), 10),
        **{c: F.col(c) for c in ("recipe_target", "repo", "augmentation", "project")},
    }
    known = {k: F.coalesce(v, F.lit("")) for k, v in values.items()}
    return ledger.select("dataset_id", fill_template(CARD_TEMPLATE, known).alias("card"))


def publish_card(entry: DataFrame, target: str) -> bool:
    """Put the card of one ledger entry into the published folder, where readers
    of the data skip it. A failure is logged, never raised."""
    try:
        text = dataset_cards(entry).select(F.col("card").alias("value"))
        text.coalesce(1).write.mode("overwrite").text(f"{target}/_card")
        return True
    except Exception as e:
        log.warning("no card for %s: %s", target, e)
        return False


def write_cards(cards: DataFrame, path: str) -> None:
    """One folder per dataset, holding its card."""
    cards.select("dataset_id", F.col("card").alias("value")).write.mode("overwrite").partitionBy(
        "dataset_id"
    ).text(path)
