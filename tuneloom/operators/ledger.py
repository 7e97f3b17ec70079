"""Registry and ledger as relations: selection, skipping, merge, status."""

from __future__ import annotations

import logging
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..functions.schema import BOOL, LONG, STRING, STRINGS, struct_of
from ..functions.jsontext import json_valid
from ..functions.text import join_or_default, quoted, truncate
from ..sources.storage import matching_paths, path_exists

log = logging.getLogger(__name__)

LEDGER_SCHEMA = struct_of(
    dataset_id=STRING,
    repo=STRING,
    output_name=STRING,
    local_path=STRING,
    published_to=STRING,
    rows_in=LONG,
    rows_out=LONG,
    augmentation=STRING,
    augmentation_llm=STRING,
    validation_passed=BOOL,
    processed_at=STRING,
    recipe_target=STRING,
    project=STRING,
    known_issues_resolved=STRINGS,
)
# Column of a stored change: field → when it was given, in nanoseconds.
AT = "__at"


# -- storage ---------------------------------------------------------------
# A ledger is a folder of parquet folders, one for each update that was recorded;
# of each field the value given last counts.


def _updates(spark: SparkSession, root: str) -> list[str]:
    """The folders of finished updates; Spark marks them when a write is done."""
    found = matching_paths(spark, f"{root.rstrip('/')}/change-*/_SUCCESS")
    return [path.rsplit("/", 1)[0] for path in found]


def ledger_read(spark: SparkSession, root: str) -> DataFrame:
    """The ledger as it is now: one row per dataset, of each field the value given
    last; an empty frame when there is none."""
    found = _updates(spark, root)
    if not found:
        return spark.createDataFrame([], LEDGER_SCHEMA)
    rows = spark.read.option("mergeSchema", True).parquet(*found)
    names = [c for c in rows.columns if c not in ("dataset_id", AT)]
    last = {c: F.max_by(F.col(quoted(c)), F.try_element_at(F.col(AT), F.lit(c))).alias(c) for c in names}
    last |= {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in LEDGER_SCHEMA if f.name not in last}
    others = [c for c in names if c not in LEDGER_SCHEMA.names]
    return rows.groupBy("dataset_id").agg(*[last[c] for c in [*LEDGER_SCHEMA.names[1:], *others]])


def ledger_write(update: DataFrame, root: str) -> str:
    """Record the fields of ``update``, one row per dataset; what it does not have
    stays as it is (``ledger_upsert`` for frames). An explicit null is a value.
    Only the update is written, to a folder of its own, so any number of writers
    may do so at a time. A ledger of very many updates is put together by
    recording ``ledger_read`` of it in a new place."""
    kinds = {f.name: f.dataType for f in LEDGER_SCHEMA}
    names = [c for c in update.columns if c != "dataset_id"]
    values = [F.col(quoted(c)).cast(kinds.get(c, update.schema[c].dataType)).alias(c) for c in names]
    now = F.lit(time.time_ns()).cast("long")
    times = F.map_from_arrays(F.array(*map(F.lit, names)), F.array_repeat(now, len(names)))
    path = f"{root.rstrip('/')}/change-{time.time_ns():020d}-{uuid.uuid4().hex}"
    update.select("dataset_id", *values, times.alias(AT)).write.parquet(path)
    return path


def ledger_save(ledger: DataFrame, path: str) -> None:
    """One JSON object per line and dataset, nulls kept."""
    ledger.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def ledger_read_json(spark: SparkSession, path: str, rename: dict[str, str] | None = None) -> DataFrame:
    """A ledger kept as one JSON object, id → entry. A missing, empty or
    malformed file gives an empty frame. The file is one document and is read by
    one task; a ledger that outgrows that is kept with ``ledger_write``. Fields that are not part of the ledger
    schema go to the map ``extra``; ``rename`` maps field names in the file."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    text = spark.read.text(path, wholetext=True)
    entries = text.select(
        F.from_json("value", "map<string,map<string,string>>").alias("entries"),
        (F.trim("value") != "").alias("filled"),
        (~F.coalesce(json_valid(F.col("value")), F.lit(False))).alias("broken"),
    )
    if not entries.where("filled and broken").isEmpty():
        log.warning("%s is malformed, starting with an empty ledger", path)
    listed = entries.where("filled and not broken").select(F.posexplode(F.map_entries("entries")).alias("n", "e"))
    # of an id that is written twice the last entry counts
    rows = listed.groupBy(F.col("e.key").alias("dataset_id")).agg(F.max_by("e.value", "n").alias("fields"))
    source_of = {new: old for old, new in (rename or {}).items()}
    typed = []
    for f in LEDGER_SCHEMA.fields[1:]:
        value = F.col("fields")[source_of.get(f.name, f.name)]
        if isinstance(f.dataType, T.ArrayType):
            value = F.from_json(value, f.dataType)
        typed.append(value.cast(f.dataType).alias(f.name))
    known = [source_of.get(f.name, f.name) for f in LEDGER_SCHEMA.fields]
    extra = F.map_filter("fields", lambda k, _: ~k.isin(known))
    return rows.select("dataset_id", *typed, extra.alias("extra"))


# -- lookups and merge -----------------------------------------------------


def ledger_get(ledger: DataFrame, wanted: str | DataFrame, key: str = "dataset_id") -> DataFrame:
    """The entry of one id, or those of all ids in a frame with that column."""
    if isinstance(wanted, DataFrame):
        return ledger.join(wanted.select(key), key, "left_semi")
    return ledger.where(F.col(key) == wanted)


def is_completed() -> Column:
    """Passed validation and has a processing time. Never null."""
    return F.col("validation_passed").eqNullSafe(True) & F.col("processed_at").isNotNull()


def completed(ledger: DataFrame) -> DataFrame:
    return ledger.where(is_completed())


def skip_completed(targets: DataFrame, ledger: DataFrame, force: bool = False) -> DataFrame:
    """Registry entries that still have to run."""
    if force:
        return targets
    done = completed(roll_up(ledger)).select(F.col("dataset_id").alias("id"))
    return targets.join(done, "id", "left_anti")


def ledger_upsert(ledger: DataFrame, update: DataFrame, key: str = "dataset_id") -> DataFrame:
    """Merge field by field. Fields of ``update`` overwrite, an explicit null
    too; fields it does not have keep their old value; other ids stay as they
    are. ``update`` holds one row per id; give updates with different fields one
    after the other."""
    old = ledger.alias("old")
    new = update.withColumn("__new", F.lit(True)).alias("new")
    joined = old.join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "full_outer")
    out = [F.coalesce(F.col(f"new.{key}"), F.col(f"old.{key}")).alias(key)]
    names = [c for c in ledger.columns if c != key]
    names += [c for c in update.columns if c != key and c not in names]
    for name in names:
        q = quoted(name)
        if name not in update.columns:
            value = F.col(f"old.{q}")
        elif name not in ledger.columns:
            value = F.col(f"new.{q}")
        else:
            kind = ledger.schema[name].dataType
            value = F.when(F.col("new.__new"), F.col(f"new.{q}").cast(kind)).otherwise(F.col(f"old.{q}"))
        out.append(value.alias(name))
    return joined.select(out)


def select_targets(
    registry: DataFrame,
    dataset_id: str | None = None,
    recipe_target: str | None = None,
    project: str | None = None,
    all_datasets: bool = False,
    force: bool = False,
) -> DataFrame:
    """Entries to run: by id, else by recipe target, else by project, else all
    that are not marked complete (with ``force`` really all)."""
    if dataset_id:
        return registry.where(F.col("id") == dataset_id)
    if recipe_target:
        return registry.where(F.col("recipe_target") == recipe_target)
    if project:
        return registry.where(F.col("project") == project)
    if not all_datasets:
        raise ValueError("give a dataset id, a recipe target, a project or all_datasets=True")
    if force:
        return registry
    return registry.where(~F.col("status").eqNullSafe("complete"))


def roll_up(ledger: DataFrame) -> DataFrame:
    """One entry per dataset: those of a stream's batches, ``<id>/<batch>`` with the
    number in the column batch, are added to that of ``<id>``. Rows of batches
    that were not delivered don't count, and a dataset passes if all its batches
    do. A batch that ran twice has one entry, so it is counted once."""
    if "batch" not in ledger.columns:
        return ledger
    suffix = F.concat(F.lit("/"), F.col("batch").cast("string"))
    own = F.substr("dataset_id", F.lit(1), F.length("dataset_id") - F.length(suffix))
    named = ledger.withColumn("__id", F.when(F.col("batch").isNull(), F.col("dataset_id")).otherwise(own))
    counted = F.when(F.col("batch").isNull() | F.col("local_path").isNotNull(), F.col("rows_out")).otherwise(0)
    folder = F.when(F.col("batch").isNull(), F.col("local_path")).otherwise(
        F.regexp_replace("local_path", r"/batch=\d+$", "")
    )
    latest = F.struct("processed_at", "dataset_id")
    special = {
        "rows_in": F.sum("rows_in"),
        "rows_out": F.sum(counted),
        "validation_passed": F.bool_and(F.coalesce("validation_passed", F.lit(False))),
        "processed_at": F.max("processed_at"),
        "local_path": F.max(folder),
    }
    names = [c for c in ledger.columns if c not in ("dataset_id", "batch")]
    kept = [special.get(c, F.max_by(F.col(quoted(c)), latest)).alias(c) for c in names]
    return named.groupBy(F.col("__id").alias("dataset_id")).agg(*kept)


def status_board(registry: DataFrame, ledger: DataFrame) -> DataFrame:
    """One line per registry entry, over runs and streams. Spark broadcasts the
    ledger if it is small."""
    entry = roll_up(ledger).select(
        F.col("dataset_id").alias("id"), "validation_passed", "rows_out", "processed_at"
    )
    done = F.col("validation_passed").eqNullSafe(True)
    dash = F.lit("—")
    status = (
        F.when(done, F.lit("complete"))
        .when(F.col("status") == "ready", F.lit("ready"))
        .otherwise(F.lit("pending"))
    )
    return registry.join(entry, "id", "left").select(
        "id",
        status.alias("status"),
        "project",
        "recipe_target",
        F.when(done, F.coalesce(F.col("rows_out").cast("string"), dash)).otherwise(dash).alias("rows_out"),
        F.when(done, F.coalesce(truncate(F.col("processed_at"), 10), F.lit("")))
        .otherwise(dash)
        .alias("processed_at"),
        join_or_default(F.col("known_issues"), ", ", "none").alias("known_issues"),
    )


def run_tally(results: DataFrame) -> DataFrame:
    """How many datasets ended in each status."""
    return results.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def failed(results: DataFrame) -> DataFrame:
    """The datasets that failed, one row each."""
    return results.where(F.col("status") == "failed")


def provenance(registry: DataFrame, results: DataFrame) -> DataFrame:
    """Ledger entries for finished runs. ``results`` has dataset_id, local_path,
    published_to, rows_in, rows_out, validation_passed, processed_at and the
    augmentation that really ran."""
    ran = results.select(
        F.col("dataset_id").alias("id"),
        "local_path",
        "published_to",
        "rows_in",
        "rows_out",
        F.col("augmentation").alias("__ran"),
        "validation_passed",
        "processed_at",
    )
    joined = registry.join(ran, "id")
    augmentation = F.coalesce("__ran", F.lit("none"))
    return joined.select(
        F.col("id").alias("dataset_id"),
        "repo",
        "output_name",
        "local_path",
        "published_to",
        F.col("rows_in").cast("long"),
        F.col("rows_out").cast("long"),
        augmentation.alias("augmentation"),
        F.when(augmentation != "none", F.col("augmentation_llm")).alias("augmentation_llm"),
        "validation_passed",
        "processed_at",
        "recipe_target",
        "project",
        F.coalesce("known_issues", F.array().cast("array<string>")).alias("known_issues_resolved"),
    )
