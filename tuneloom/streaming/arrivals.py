"""Incremental preparation of newly arriving files with Structured Streaming."""

from __future__ import annotations

import re
import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from ..functions.pii import PII_PATTERNS, has_pii
from ..functions.text import is_string, quoted
from ..operators import ledger as led
from ..operators.deliver import write_checked
from ..operators.generate import Generator, augment
from ..operators.select import drop_blank_rows, keep_columns
from ..sources.storage import delete, is_file, partition_folders, promote


def read_arrivals(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    fmt: str = "parquet",
    pattern: str | None = None,
    max_files: int | None = None,
    nested: bool = False,
) -> DataFrame:
    """Stream of the rows of files as they appear in a folder, or of the one file
    that ``folder`` is. Source files stay in place; the checkpoint remembers which
    were read. With ``nested`` files of the folders in it count too, at any depth;
    as with ``read_file`` only where none is named key=value at the start."""
    reader = spark.readStream.schema(schema).format(fmt)
    if is_file(spark, folder):
        folder, name = folder.rstrip("/").rsplit("/", 1)
        pattern = re.sub(r"([\\*?\[\]{}])", r"\\\1", name)
    elif nested and not partition_folders(spark, folder):
        reader = reader.option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder)


def prepare_rows(df: DataFrame, columns_keep: list[str]) -> DataFrame:
    """Whitelist, blank-row removal and one flag column per personal-data kind.
    Stateless, so the same for a batch and a stream."""
    kept = drop_blank_rows(keep_columns(df, columns_keep))
    texts = [F.col(quoted(f.name)) for f in kept.schema if is_string(f.dataType)]
    flags = {}
    for kind in PII_PATTERNS:
        hit = F.lit(False)
        for c in texts:
            hit = hit | has_pii(c, kind)
        flags[f"has_{kind}"] = hit
    return kept.withColumns(flags)


def deliver_arrivals(
    stream: DataFrame,
    columns_keep: list[str],
    out_dir: str,
    checkpoint: str,
    ledger_root: str,
    dataset_id: str,
    processed_at: str | Callable[[int], str],
    trigger: dict | None = None,
    deliver_failed: bool = False,
    quarantine: str | None = None,
    kind: str | None = None,
    generator: Generator | None = None,
    **options,
) -> StreamingQuery:
    """Write each micro-batch to a staging folder, check it on the way, move it to
    ``<out_dir>/batch=<n>`` and record it in the ledger as ``<dataset_id>/<n>``
    (``roll_up`` has the totals of the dataset). A batch that fails its checks goes
    to ``<quarantine>/batch=<n>`` (by default ``<out_dir>_quarantine``), its entry
    has no path and its rows don't count; with ``deliver_failed`` it is delivered all
    the same. ``kind`` and ``generator`` augment it first. A batch that runs twice
    after a failure overwrites its own folder and ledger entry, so nothing is
    counted twice. ``trigger`` defaults to one run over what is there; pass
    {"processingTime": "1 minute"} to keep looking."""
    apart = quarantine or f"{out_dir.rstrip('/')}_quarantine"

    def one_batch(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        path, failed = f"{out_dir}/batch={number}", f"{apart}/batch={number}"
        staged = f"{out_dir}/_staged-{uuid.uuid4().hex}"
        try:
            report = write_checked(augment(batch, kind, generator, **options), staged, columns_keep, 0).first()
        except Exception:
            delete(spark, staged)
            raise
        good = report["passed"] or deliver_failed
        promote(spark, staged, path if good else failed)
        delete(spark, failed if good else path)  # what an earlier run of the batch may have left there
        at = processed_at(number) if callable(processed_at) else processed_at
        update = spark.createDataFrame(
            [(f"{dataset_id}/{number}", number, path if good else None, report["rows_out"], kind or "none", report["passed"], at)],
            "dataset_id string, batch long, local_path string, rows_out long, augmentation string,"
            " validation_passed boolean, processed_at string",
        )
        led.ledger_write(update, ledger_root)

    return (
        prepare_rows(stream, columns_keep)
        .writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
