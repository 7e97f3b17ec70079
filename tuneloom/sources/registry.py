"""The registry of datasets to prepare, kept as YAML."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.schema import BOOL, INT, STRING, STRINGS, struct_of

REGISTRY_SCHEMA = struct_of(
    id=STRING,
    repo=STRING,
    known_issues=STRINGS,
    split=STRING,
    subset=STRING,
    rows=INT,
    min_rows_output=INT,
    random_seed=INT,
    columns_keep=STRINGS,
    data_url=STRING,
    data_url_file=STRING,
    augmentation=STRING,
    augmentation_llm=STRING,
    output_name=STRING,
    local_subdir=STRING,
    recipe_target=STRING,
    project=STRING,
    status=STRING,
    notes=STRING,
    fmt=STRING,
    multiline=BOOL,
    spread=INT,
)
# Values of absent fields.
DEFAULTS = {"split": "train", "rows": 2000, "random_seed": 42, "augmentation": "none"}


def registry_frame(
    spark: SparkSession, entries: list[dict], rename: dict[str, str] | None = None
) -> DataFrame:
    """Entries as a frame. ``rename`` maps field names of the file to ours."""
    rename = rename or {}
    rows = []
    for entry in entries:
        named = {rename.get(k, k): v for k, v in entry.items()}
        rows.append(
            tuple(named.get(f.name, DEFAULTS.get(f.name)) for f in REGISTRY_SCHEMA.fields)
        )
    return spark.createDataFrame(rows, REGISTRY_SCHEMA)


def read_registry(spark: SparkSession, path: str, rename: dict[str, str] | None = None) -> DataFrame:
    """The list under ``datasets``; a file without one gives an empty frame."""
    try:
        import yaml
    except ImportError as e:
        raise RuntimeError("reading a YAML registry needs PyYAML; or use registry_frame") from e
    text = spark.read.text(path, wholetext=True).head(1)
    data = yaml.safe_load(text[0].value) if text else None
    return registry_frame(spark, (data or {}).get("datasets") or [], rename)
