"""End-to-end runs: read, select, augment, check, deliver, record."""

from __future__ import annotations

import logging
import uuid
from concurrent.futures import ThreadPoolExecutor, as_completed
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone
from typing import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..functions.schema import BOOL, LONG, STRING, struct_of
from ..operators import deliver as out
from ..operators import ledger as led
from ..operators.generate import (
    AUGMENTATIONS,
    BATCH_SIZE,
    RECORD_KEYS,
    ROWS_PER_TASK,
    STATUS_COLUMNS,
    Generator,
    augment,
    failure_reasons,
)
from ..operators.quality import JSON_COLUMNS, default_min_rows, quality_report
from ..operators.select import (
    drop_blank_rows,
    missing_columns,
    preview,
    sample_exact,
    shape,
)
from ..sources.archives import read_archives, scan_archives
from ..sources.listing import list_files, pick_files
from ..sources.readers import (
    DatasetReadError,
    is_legacy_script,
    read_dataset,
    read_file,
    read_first_available,
)
from ..sources.storage import delete, promote

log = logging.getLogger(__name__)

# The target whose datasets have their JSON checked.
STRUCTURED_TARGET = "structured_outputs_jinja"


@dataclass(frozen=True)
class Recipe:
    """What a run needs to know; the fields of a registry entry."""

    id: str
    repo: str
    columns_keep: list[str]
    split: str = "train"
    subset: str | None = None
    rows: int = 2000
    min_rows_output: int | None = None
    random_seed: int = 42
    data_url: str | None = None
    data_url_file: str | None = None
    augmentation: str | None = "none"
    augmentation_llm: str | None = None
    output_name: str = ""
    local_subdir: str = ""
    recipe_target: str = ""
    project: str = ""
    status: str | None = "pending"
    fmt: str | None = None
    multiline: bool = True
    spread: int | None = None
    known_issues: list[str] = field(default_factory=list)
    notes: str | None = None

    @property
    def min_rows(self) -> int:
        return default_min_rows(self.rows, self.min_rows_output)

    @property
    def output_type(self) -> str:
        return "structured" if self.recipe_target == STRUCTURED_TARGET else "default"

    @property
    def kind(self) -> str:
        """The augmentation that will run; an unknown one does not."""
        return self.augmentation if self.augmentation in AUGMENTATIONS else "none"

    @property
    def json_columns(self) -> list[str]:
        """The generated JSON column is checked first, then the usual ones."""
        return ["structured_json", *JSON_COLUMNS]


# The five kinds of run; columns, folder and target as users know them.
RECIPES = {
    "instruction_from_answer": Recipe(
        "instruction-from-answer", "dialog", ["context", "response", "rots", "safety_label"],
        augmentation="instruction_from_answer",
        local_subdir="01-instruction-from-answer", recipe_target="instruction_from_answer",
    ),
    "text_generation": Recipe(
        "question-answer", "multiple_choice", ["question", "choices", "answer"], split="test",
        augmentation="text_generation",
        local_subdir="01-instruction-from-answer", recipe_target="instruction_from_answer",
    ),
    "structured_output": Recipe(
        "structured-output", "scenarios", RECORD_KEYS,
        augmentation="structured_output",
        local_subdir="06-structured-outputs", recipe_target=STRUCTURED_TARGET,
    ),
    "text_to_sql": Recipe(
        "text-to-sql", "sql", ["question", "context", "answer"],
        local_subdir="05-text-to-sql", recipe_target="text_to_sql",
    ),
    "text_to_python": Recipe(
        "text-to-python", "python", ["instruction", "input", "output"],
        local_subdir="04-text-to-python", recipe_target="text_to_python",
    ),
}


def utc_now() -> str:
    return datetime.now(timezone.utc).isoformat()


def recipe_of(entry) -> Recipe:
    """A registry row as a recipe."""
    values = entry.asDict()
    known = {k: v for k, v in values.items() if k in Recipe.__dataclass_fields__ and v is not None}
    return Recipe(**known)


def open_source(
    spark: SparkSession, recipe: Recipe, root: str | None, schema: T.StructType | None = None
) -> DataFrame:
    """The named dataset; if it only has a loading script, its best raw data
    file; without one, the archives or plain files the entry names."""

    def named() -> DataFrame:
        return read_dataset(
            spark, root, recipe.repo, recipe.split, recipe.subset, recipe.fmt, schema, multiline=recipe.multiline
        )

    def raw_file() -> DataFrame:
        listing = list_files(spark, root, recipe.repo)
        best = pick_files(listing).where(F.col("path").isNotNull()).head(1)
        if not best:
            raise DatasetReadError(recipe.repo, "no loadable data files")
        return read_file(spark, f"{root.rstrip('/')}/{recipe.repo}/{best[0].path}", schema, multiline=recipe.multiline)

    def archive() -> DataFrame:
        columns = schema or T.StructType(
            [T.StructField(c, T.StringType()) for c in recipe.columns_keep]
        )
        if scan_archives(spark, recipe.data_url, content=False).isEmpty():
            return read_file(spark, recipe.data_url, schema, recipe.fmt, multiline=recipe.multiline)
        records = read_archives(spark, recipe.data_url, columns, recipe.data_url_file, recipe.spread)
        return records.drop("archive", "member")

    sources: list[Callable[[], DataFrame]] = [named]
    if root is not None:
        sources.append(raw_file)
    if recipe.data_url:
        sources.append(archive)
    return read_first_available(sources, lambda e: is_legacy_script(e.__cause__ or e))


def prepare(df: DataFrame, recipe: Recipe, key: list[str] | None = None) -> DataFrame:
    """Sample the kept columns, then drop blank rows: a source with many
    blank rows is over-fetched on purpose. Of the other columns only the key is read. After the sample there are never more
    than ``rows`` rows, so there is nothing left to sample a second time."""
    absent = missing_columns(df, recipe.columns_keep)
    if absent:
        log.warning("%s: columns not found, going on without: %s", recipe.id, absent)
    return drop_blank_rows(
        sample_exact(df, recipe.rows, recipe.random_seed, key, columns=recipe.columns_keep)
    )


def augment_parallel(
    df: DataFrame, recipe: Recipe, generator: Generator | None, parallelism: int | None, **options
) -> DataFrame:
    """Augment in ``parallelism`` partitions, by default as many as there are cores
    and batches; a small sample sits in one partition, which would make one caller.
    A partition has no more than ROWS_PER_TASK rows or so, since a lost task asks
    again for all of its own."""
    if recipe.kind == "none":
        return df
    if not options.get("store"):  # which deals prompts out itself
        batches = -(-recipe.rows // options.get("batch_size", BATCH_SIZE))
        cores = df.sparkSession.sparkContext.defaultParallelism
        parts = max(1, min(cores, batches), -(-recipe.rows // ROWS_PER_TASK))
        df = df.repartition(parallelism or parts)
    return augment(df, recipe.kind, generator, **options)


def recipe_frame(
    df: DataFrame,
    recipe: Recipe,
    generator: Generator | None = None,
    key: list[str] | None = None,
    parallelism: int | None = None,
    **options,
) -> DataFrame:
    """The dataset a run would deliver, as one lazy frame; with the option ``store``
    (see ``generate_resumed``) replies are asked for here and now."""
    return augment_parallel(prepare(df, recipe, key), recipe, generator, parallelism, **options)


RESULT_SCHEMA = struct_of(
    dataset_id=STRING,
    status=STRING,
    message=STRING,
    local_path=STRING,
    published_to=STRING,
    rows_in=LONG,
    rows_out=LONG,
    rows_failed=LONG,
    failure_reasons=T.ArrayType(struct_of(reason=STRING, n=LONG)),
    augmentation=STRING,
    validation_passed=BOOL,
    processed_at=STRING,
)


def run_recipe(
    df: DataFrame,
    recipe: Recipe,
    base: str,
    processed_at: str | None = None,
    generator: Generator | None = None,
    key: list[str] | None = None,
    publish_to: str | None = None,
    parallelism: int | None = None,
    **options,
) -> dict:
    """Run one recipe on a source frame. The dataset is written to a staging
    folder with its checks and moved into place if it passes; nothing is
    delivered if it fails. Rows whose batch got no reply are counted in
    ``rows_failed``, and ``failure_reasons`` says how many of them had which error,
    counted in the tasks that write. Give ``processed_at`` to make a run repeatable."""
    spark = df.sparkSession
    metrics, drop = {}, []
    if recipe.kind == "none":
        made = recipe_frame(df, recipe, generator, key, parallelism, **options)
    else:
        drop = [] if options.pop("status", False) else STATUS_COLUMNS
        made = recipe_frame(df, recipe, generator, key, parallelism, status=True, **options)
        # Few files instead of one per caller; and replies that are in a shuffle
        # are not asked for again when a write is retried.
        made = made.hint("rebalance")
        metrics = {"n_failed": F.count_if(F.col("generation_status") == "failed"), "reasons": failure_reasons()}
    final = out.delivery_path(base, recipe.local_subdir, recipe.id)
    staged = f"{base.rstrip('/')}/_staged-{uuid.uuid4().hex}"
    try:
        report = out.write_checked(
            made, staged, recipe.columns_keep, recipe.min_rows, recipe.output_type,
            recipe.json_columns, metrics, drop,
        ).first()
    except Exception:
        delete(spark, staged)
        raise
    result = {
        "dataset_id": recipe.id,
        "rows_in": report["rows_in"],
        "rows_out": report["rows_out"],
        "rows_failed": report["n_failed"] if metrics else 0,
        "failure_reasons": [(r["item"], r["count"]) for r in report["reasons"] if r["item"]] if metrics else [],
        "augmentation": recipe.kind,
        "validation_passed": report["passed"],
        "message": "; ".join([*report["errors"], *report["warnings"]]),
    }
    if not report["passed"]:
        delete(spark, staged)
        return {**result, "status": "failed"}
    if result["rows_failed"]:
        why = "; ".join(f"{n} x {reason}" for reason, n in result["failure_reasons"])
        log.warning("%s: no reply for %d rows (%s)", recipe.id, result["rows_failed"], why)
    if report["rows_out"] < recipe.rows:
        log.warning("%s: %d rows, fewer than the %d asked for", recipe.id, report["rows_out"], recipe.rows)
    promote(spark, staged, final)
    published = publish_to if publish_to and out.publish(spark, final, publish_to) else None
    return {
        **result,
        "status": "success",
        "local_path": final,
        "published_to": published,
        "processed_at": processed_at or utc_now(),
    }


def run_registry(
    spark: SparkSession,
    registry: DataFrame,
    ledger_root: str,
    root: str | None,
    base: str,
    processed_at: str | None = None,
    generators: dict[str, Generator] | None = None,
    dataset_id: str | None = None,
    recipe_target: str | None = None,
    project: str | None = None,
    all_datasets: bool = False,
    force: bool = False,
    augment_rows: bool = True,
    keys: dict[str, list[str]] | None = None,
    schemas: dict[str, T.StructType] | None = None,
    publish_base: str | None = None,
    max_parallel: int = 4,
    **options,
) -> DataFrame:
    """Run the selected registry entries and record them in the ledger. One
    result row per entry: success, failed or skipped (complete already).

    ``generators`` maps an augmentation kind to its callable. Entries are
    configuration, a few values each; their data stay on the cluster. The
    ledger is told of each finished dataset at once.
    """
    targets = led.select_targets(registry, dataset_id, recipe_target, project, all_datasets, force)
    to_run = led.skip_completed(targets, led.ledger_read(spark, ledger_root), force)
    ids = {r["id"] for r in to_run.select("id").collect()}
    wanted = targets.collect()
    if not wanted and not all_datasets:
        raise LookupError(f"no registry entry for {dataset_id or recipe_target or project!r}")
    recipes = [recipe_of(r) for r in wanted if r["id"] in ids]
    if not augment_rows:
        recipes = [replace(r, augmentation="none", augmentation_llm=None) for r in recipes]

    def one(recipe: Recipe) -> dict:
        try:
            df = open_source(spark, recipe, root, (schemas or {}).get(recipe.id))
            target = f"{publish_base.rstrip('/')}/{recipe.output_name}" if publish_base else None
            return run_recipe(
                df, recipe, base, processed_at,
                (generators or {}).get(recipe.kind),
                (keys or {}).get(recipe.id), target, **options,
            )
        except Exception as e:  # one failed dataset does not stop the others
            log.error("%s failed: %s", recipe.id, e)
            return {
                "dataset_id": recipe.id,
                "status": "failed",
                "message": str(e),
                "augmentation": recipe.kind,
            }

    results = []
    with ThreadPoolExecutor(max_workers=max_parallel) as pool:
        for done in as_completed([pool.submit(one, r) for r in recipes]):
            result = done.result()
            results.append(result)
            if result["status"] == "success":
                record = led.provenance(registry, _results_frame(spark, [result]))
                led.ledger_write(record, ledger_root)
                if result["published_to"]:
                    out.publish_card(record, result["published_to"])
    results += [
        {"dataset_id": r["id"], "status": "skipped", "message": "complete already"}
        for r in wanted
        if r["id"] not in ids
    ]
    return _results_frame(spark, results)


def _results_frame(spark: SparkSession, results: list[dict]) -> DataFrame:
    rows = [tuple(r.get(f.name) for f in RESULT_SCHEMA) for r in results]
    return spark.createDataFrame(rows, RESULT_SCHEMA)


def preview_dataset(
    spark: SparkSession, recipe: Recipe, root: str | None, key: list[str] | None = None
) -> DataFrame:
    """Three rows of what a run would augment; nothing is written."""
    ready = prepare(open_source(spark, recipe, root), recipe, key)
    return preview(ready, ready.columns)


def preview_shape(
    spark: SparkSession, recipe: Recipe, root: str | None, key: list[str] | None = None
) -> DataFrame:
    """How many rows and columns a run would augment."""
    return shape(prepare(open_source(spark, recipe, root), recipe, key))


def revalidate(
    spark: SparkSession, ledger: DataFrame, dataset_id: str, registry: DataFrame | None = None
) -> DataFrame:
    """Report on a delivered dataset: required columns from the registry, or all."""
    entry = led.ledger_get(ledger, dataset_id).head(1)
    if not entry:
        raise LookupError(f"{dataset_id} is not in the ledger, run it first")
    df = out.rescan(spark, entry[0]["local_path"])
    config = registry.where(F.col("id") == dataset_id).head(1) if registry is not None else []
    required = config[0]["columns_keep"] if config else df.columns
    return quality_report(df, required, 1)


def republish(spark: SparkSession, ledger: DataFrame, dataset_id: str, target: str) -> bool:
    """Publish a delivered dataset again."""
    entry = led.ledger_get(ledger, dataset_id).head(1)
    if not entry:
        raise LookupError(f"{dataset_id} is not in the ledger")
    out.rescan(spark, entry[0]["local_path"])
    return out.publish(spark, entry[0]["local_path"], target)
