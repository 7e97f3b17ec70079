"""Files and named datasets as DataFrames."""

from __future__ import annotations

import json
import logging
import os
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from itertools import chain, islice
from typing import Callable, Iterator
from urllib.parse import unquote

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession, functions as F
from pyspark.sql import types as T

from ..functions.messages import ERROR_HINTS, LEGACY_SCRIPT_MESSAGES, category_of, mentions
from .storage import data_files, matching_names, matching_paths, partition_folders, path_exists, start_of
from .streams import open_path, reachable

log = logging.getLogger(__name__)

# Extension → format.
FORMATS = {
    ".jsonl": "json",
    ".json": "json",
    ".csv": "csv",
    ".tsv": "csv",
    ".parquet": "parquet",
}


# What is read of a '.json' file to see how it is laid out.
START_BYTES = 64 << 10
# Spark's conditions for a table or path that is not there.
NOT_FOUND = {"TABLE_OR_VIEW_NOT_FOUND", "PATH_NOT_FOUND"}


class DatasetReadError(Exception):
    """A dataset could not be read. The message says what to do about it."""

    def __init__(self, name: str, cause: Exception | str):
        self.category = category_of(str(cause))
        super().__init__(f"{name}: {ERROR_HINTS[self.category]}\n  → Cause: {cause}")


def format_of(path: str) -> str:
    ext = os.path.splitext(path.rstrip("/").lower())[1]
    if ext not in FORMATS:
        raise ValueError(f"Cannot load file type '{ext}' from {path}")
    return FORMATS[ext]


def _extension(path: str) -> str:
    return os.path.splitext(path.rstrip("/").lower())[1]


def _listing(spark: SparkSession, path: str | list[str], only: str | None = None) -> DataFrame:
    """path of every file below folders, at any depth; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return (reader.option("pathGlobFilter", only) if only else reader).load(path).select("path")


def _patterns_inside(spark: SparkSession, path: str) -> dict[str, str]:
    """Of the data files below a folder: the extensions, each with a pattern for
    the names that have it (in any spelling that occurs)."""
    if "*" not in path and not path_exists(spark, path):
        return {}
    ext = F.regexp_extract("path", r"(\.[^./]*)$", 1).alias("ext")
    found: dict[str, list[str]] = {}
    for row in _listing(spark, path).select(ext).distinct().sort("ext").collect():
        if row.ext.lower() in FORMATS:
            found.setdefault(row.ext.lower(), []).append(row.ext)
    return {ext: f"*{{{','.join(spelled)}}}" for ext, spelled in found.items()}


def _is_json_lines(start: str) -> bool:
    """Whether a '.json' file that begins like this holds a document per line. It
    does not if its first line is only a part of a document, or an array alone."""
    line, _, more = start.lstrip().partition("\n")
    if line.startswith("["):
        if not more.strip():
            return False
    elif not more:
        return True
    try:
        json.loads(line)
    except ValueError:
        return False
    return True


def _json_kinds(spark: SparkSession, path: str | list[str], only: str | None = None) -> dict[bool, list[str]]:
    """The '.json' files of a path by whether they hold a document per line. The
    first START_BYTES of each file are looked at, by tasks; where Arrow does not
    know the store, by the driver."""
    files = _listing(spark, path, only)
    size = START_BYTES
    kinds: dict[bool, list[str]] = {}
    if reachable(path if isinstance(path, str) else path[0]):

        def look(batches):
            import pandas as pd

            for batch in batches:
                lines = []
                for file in batch["path"]:
                    with open_path(file) as f:
                        lines.append(_is_json_lines(f.read(size).decode("utf-8-sig", "ignore")))
                yield pd.DataFrame({"path": batch["path"], "lines": lines})

        for row in files.mapInPandas(look, "path string, lines boolean").sort("path").collect():
            kinds.setdefault(row.lines, []).append(row.path)
        return kinds
    found = sorted(row.path for row in files.collect())
    with ThreadPoolExecutor(16) as pool:
        for file, start in zip(found, pool.map(lambda f: start_of(spark, f, size), found)):
            kinds.setdefault(_is_json_lines(start), []).append(file)
    return kinds


def _together(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_file(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    fmt: str | None = None,
    infer: bool = False,
    multiline: bool = True,
    base: str | None = None,
) -> DataFrame:
    """Read a file, a folder or a list of both by their extensions (or ``fmt``).

    A folder is read with all folders in it. Those named key=value right below it
    become columns; then deeper ones must be so named too. The data files of a
    folder whose name has no extension are read each by its own and put
    together by name, other files are passed over. CSV and TSV columns stay
    strings unless a schema is given or ``infer`` is set. Quoted line breaks are
    read with ``multiline``; turn it off for large files without them, since only
    then can Spark split a file. A '.json' file may hold an array, one object or
    one object per line, each file in its own way; broken JSON, and a CSV row
    that is longer or shorter than the header, is an error. ``base`` is the
    folder whose key=value folders listed files are in.
    """
    options = (infer, multiline, base)
    if not isinstance(path, str) and fmt is None:
        by_ext: dict[str, list[str]] = {}
        for one in path:
            by_ext.setdefault(_extension(one), []).append(one)
        parts = []
        for ext, some in by_ext.items():
            if ext in FORMATS:
                parts.append(_load(spark, some, schema, FORMATS[ext], ext, *options))
            else:
                parts += [read_file(spark, one, schema, None, *options) for one in some]
        return _together(parts)
    ext = _extension(path if isinstance(path, str) else path[0])
    if fmt is None and ext not in FORMATS:
        inside = _patterns_inside(spark, path)
        if not inside:
            format_of(path)
        return _together([_load(spark, path, schema, FORMATS[e], e, *options, only) for e, only in inside.items()])
    return _load(spark, path, schema, fmt or FORMATS[ext], ext, *options)


def _load(spark, path, schema, fmt, ext, infer=False, multiline=True, base=None, only=None) -> DataFrame:
    paths = [path] if isinstance(path, str) else path
    folders = [p for p in paths if not isinstance(path, list) or _extension(p) not in FORMATS]

    def reader() -> DataFrameReader:
        found = spark.read if schema is None else spark.read.schema(schema)
        if base is not None:
            return found.option("basePath", base)
        if not any(partition_folders(spark, p) for p in folders):
            found = found.option("recursiveFileLookup", "true")
        return found.option("pathGlobFilter", only) if only else found

    if fmt == "parquet":
        return reader().parquet(*paths)
    if fmt == "csv":
        sep = "\t" if ext == ".tsv" else ","
        return reader().csv(
            path, header=True, sep=sep, quote='"', escape='"', multiLine=multiline, inferSchema=infer, mode="FAILFAST"
        )
    if fmt == "json":
        kinds = {True: []} if ext == ".jsonl" else _json_kinds(spark, path, only)
        if len(kinds) < 2:  # also a path without files
            return reader().json(path, multiLine=False in kinds, mode="FAILFAST")
        if base is None and isinstance(path, str) and partition_folders(spark, path):
            base = path
        return _together([reader().json(files, multiLine=not lines, mode="FAILFAST") for lines, files in kinds.items()])
    raise ValueError(f"Cannot load file type '{fmt}' from {path}")


def _resolve(spark: SparkSession, root: str, repo: str, split: str, subset: str | None) -> str:
    """Where a split lives: <root>/<repo>[/<subset>][/data]/<split>[.ext], numbered
    files <split>-00000-of-00001.ext there (as a glob pattern), or one file
    <root>/<repo>.ext that is the whole dataset."""
    base = f"{root.rstrip('/')}/{repo}"
    folder = f"{base}/{subset}" if subset else base
    for place in (folder, f"{folder}/data"):
        for name in (split, *(split + ext for ext in FORMATS)):
            if path_exists(spark, f"{place}/{name}"):
                return f"{place}/{name}"
        for ext in FORMATS:
            if matching_names(spark, f"{place}/{split}-[0-9]*-of-[0-9]*{ext}"):
                return f"{place}/{split}-[0-9]*-of-[0-9]*{ext}"
    if matching_names(spark, f"{folder}/*.py"):
        raise FileNotFoundError(f"{repo} has a loading script but no split '{split}'")
    if path_exists(spark, folder):
        raise FileNotFoundError(f"split '{split}' of {repo}")
    if subset:
        raise FileNotFoundError(f"subset '{subset}' of {repo}")
    for ext in FORMATS:
        if path_exists(spark, base + ext):
            return base + ext
    raise FileNotFoundError(f"{base} doesn't exist")


def read_dataset(
    spark: SparkSession,
    root: str | None,
    repo: str,
    split: str = "train",
    subset: str | None = None,
    fmt: str | None = None,
    schema: T.StructType | str | None = None,
    head: int | None = None,
    multiline: bool = True,
) -> DataFrame:
    """A named dataset. Without ``root`` the name is a catalog table. A table or
    folder with ``split`` (and ``subset``) partition columns is filtered on
    them, so that Spark only lists and reads those partitions; their format is that
    of the files in them unless ``fmt`` says so; a folder without the
    one asked for, or with several subsets and none asked for, is an error. ``head`` stops
    after that many rows, without a sample."""
    try:
        if root is None or matching_names(spark, f"{root.rstrip('/')}/{repo}/{{split,subset}}=*"):
            df = _partitioned(spark, root, repo, split, subset, fmt, schema, multiline)
            return df if head is None else df.limit(head)
        path = _resolve(spark, root, repo, split, subset)
        if head is not None:
            return read_head(spark, path, head, schema, fmt=fmt, multiline=multiline)
        return read_file(spark, path, schema, fmt, multiline=multiline)
    except (PySparkException, FileNotFoundError, ValueError) as e:
        absent = isinstance(e, PySparkException) and e.getCondition() in NOT_FOUND
        raise DatasetReadError(repo, f"{repo} doesn't exist" if absent else e) from e


def _check_partitions(spark: SparkSession, base: str, repo: str, split: str, subset: str | None) -> None:
    """An error if partition folders hold neither the subset nor the split, or
    several subsets and none is asked for. Only folder names are looked at."""
    found = {}
    for name in ("subset", "split"):
        folders = matching_names(spark, f"{base}/{{{name}=*,*=*/{name}=*}}")
        found[name] = {unquote(f.split("=", 1)[1]) for f in folders}
    if subset is None and len(found["subset"]) > 1:
        raise FileNotFoundError(f"subset of {repo} is not given; there are {sorted(found['subset'])}")
    if subset and found["subset"] and subset not in found["subset"]:
        raise FileNotFoundError(f"subset '{subset}' of {repo}")
    if split and found["split"]:
        within = matching_names(spark, f"{base}/subset={subset}/split=*") if subset else []
        here = {unquote(f.split("=", 1)[1]) for f in within} or found["split"]
        if split not in here:
            raise FileNotFoundError(f"split '{split}' of {repo}")


def _partitioned(spark, root, repo, split, subset, fmt, schema, multiline) -> DataFrame:
    wanted = {"split": split, "subset": subset}
    if root is None:
        df = spark.table(repo)
        keys = {c.name for c in spark.catalog.listColumns(repo) if c.isPartition}
        by = {name: value for name, value in wanted.items() if name in keys}
    else:
        base = f"{root.rstrip('/')}/{repo}"
        _check_partitions(spark, base, repo, split, subset)
        ext = next((e for e in FORMATS if matching_names(spark, f"{base}/{{*=*,*=*/*=*}}/*{e}")), ".parquet")
        df = _load(spark, base, schema, fmt or FORMATS[ext], ext, multiline=multiline)
        by = {name: value for name, value in wanted.items() if name in df.columns}
    for name, value in by.items():
        if value:
            df = df.where(F.col(name) == value)
            if root is None and df.isEmpty():  # partitions only, at most one row is read
                raise FileNotFoundError(f"{name} '{value}' of {repo}")
    return df.drop(*by)


def _files_in_order(spark: SparkSession, path: str, fmt: str | None) -> Iterator[str]:
    """The data files of a path one by one, folders opened as they come."""
    known = fmt is not None or _extension(path) in FORMATS
    for place in matching_paths(spark, path) if "*" in path else [path]:
        yield from (f for f in data_files(spark, place) if known or _extension(f) in FORMATS)


def read_head(
    spark: SparkSession, path: str, rows: int, schema: T.StructType | str | None = None, **options
) -> DataFrame:
    """``rows`` rows of a file or folder of any size, without a look at all of
    it: the first file, then four times as many, until they hold enough. (A
    plain ``limit`` inside a plan starts a task for every partition.) Without a
    schema the columns are those of the files that are read."""
    fmt = options.pop("fmt", None)
    if fmt is None and _extension(path) in FORMATS:
        # files in a folder with an extension are read by the folder's
        fmt, sep = FORMATS[_extension(path)], _extension(path)
    else:
        sep = None
    base = path if "*" not in path and partition_folders(spark, path) else None
    found, files = _files_in_order(spark, path, fmt), []
    while True:
        files += islice(found, max(1, 3 * len(files)))
        after = next(found, None)
        if not files:
            return read_file(spark, path, schema, fmt, **options).limit(rows)
        if sep is not None:
            some = _load(spark, files, schema, fmt, sep, base=base, **options)
        else:
            some = read_file(spark, files, schema, fmt, base=base, **options)
        first = some.limit(rows)
        if after is None or first.count() >= rows:
            return first
        found = chain([after], found)


def is_legacy_script(error: Exception) -> bool:
    return mentions(str(error), *LEGACY_SCRIPT_MESSAGES)


def read_first_available(
    sources: list[Callable[[], DataFrame]],
    may_fall_back: Callable[[Exception], bool] = is_legacy_script,
) -> DataFrame:
    """The first source that can be opened. The sources after the first are only
    tried if ``may_fall_back`` accepts the first one's error; the last error is
    raised when all fail. Opening reads the schema, not the data."""
    if not sources:
        raise ValueError("no sources given")
    for i, source in enumerate(sources):
        try:
            return source()
        except Exception as e:  # sources are user code
            if i + 1 == len(sources) or (i == 0 and not may_fall_back(e)):
                raise
            log.info("source %d failed, trying the next: %s", i + 1, e)
    raise AssertionError("unreachable")
