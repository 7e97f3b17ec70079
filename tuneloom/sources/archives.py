"""Tables packed in .tgz archives."""

from __future__ import annotations

import json
import re
from typing import Iterator, TextIO

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..functions.text import quoted
from .readers import FORMATS
from .streams import Opener, open_path, reachable

ROWS_PER_CHUNK = 2_000


def json_objects(text: TextIO, name: str, step: int = 1 << 16) -> Iterator[str]:
    """The objects of a JSON text, as they are written: the elements of an array,
    or one object after the other. Only the object at hand is held; anything else
    in the text is an error."""
    decode, blank = json.JSONDecoder().raw_decode, re.compile(r"[\s]*")
    buffer, at, array, after, first = "", 0, None, False, True
    while True:
        at = blank.match(buffer, at).end()
        if at == len(buffer):
            buffer, at = text.read(step), 0
            if not buffer:
                if array:
                    raise ValueError(f"{name} ends within an array")
                return
            continue
        if array is None:
            array = buffer[at] == "["
            at += array
            continue
        if array and buffer[at] == "]" and (first or after):
            at += 1
            if buffer[at:].strip() or any(part.strip() for part in iter(lambda: text.read(step), "")):
                raise ValueError(f"{name} goes on after its array")
            return
        if after:
            if buffer[at] != ",":
                raise ValueError(f"{name} lacks a comma between elements")
            at, after = at + 1, False
            continue
        try:
            value, end = decode(buffer, at)
        except json.JSONDecodeError as e:
            more = text.read(max(step, len(buffer)))
            if not more:
                raise ValueError(f"{name} holds broken JSON: {e.msg}") from None
            buffer, at = buffer[at:] + more, 0
            continue
        if not isinstance(value, dict):
            raise ValueError(f"{name} holds a JSON value that is no object")
        yield buffer[at:end]
        at, after, first = end, array, False


def scan_archives(spark: SparkSession, path: str, content: bool = True) -> DataFrame:
    """path, content of the archives below a folder, one row each; without
    ``content`` only their paths, and files are listed, not read. Spark holds a
    content whole, so an archive over 2 GB is only read by its path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    columns = ["path", "content"] if content else ["path"]
    return files.where(F.col("path").rlike(r"(?i)\.(tgz|tar\.gz)$")).select(*columns)


def read_archives(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    member: str | None = None,
    spread: int | None = None,
    opener: Opener | None = None,
) -> DataFrame:
    """Rows of the archives below a folder, of any size (see ``archive_records``).
    Each is unpacked by one task while it is read, through ``opener`` or Arrow's
    file systems; a task holds a buffer of the archive and a few thousand rows.
    Where Arrow does not know the store and no ``opener`` is given, Spark
    reads the archives whole, which limits them to 2 GB."""
    by_path = opener is not None or reachable(path)
    return archive_records(scan_archives(spark, path, not by_path), schema, member, spread, opener)


def archive_records(
    archives: DataFrame,
    schema: T.StructType,
    member: str | None = None,
    spread: int | None = None,
    opener: Opener | None = None,
) -> DataFrame:
    """Rows of one member of each archive: the first whose name ends with
    ``member``, else the first loadable one. CSV, TSV, parquet, JSON lines, and JSON
    arrays and objects. An archive without such a member is an error that lists its
    members; so are broken JSON and a CSV row that is longer or shorter than the header.

    Adds ``archive`` and ``member`` to the columns of ``schema``. Archives come
    with their ``content`` or as paths alone, which ``opener`` (by default
    ``open_path``) then opens. They are read in parallel and members row by row,
    so a task holds a few thousand rows next to the content, if there is one. A
    packed archive cannot be split, so when a few hold most of the rows,
    ``spread`` deals their rows out to that many partitions before anything else
    is done with them.
    """
    formats = dict(FORMATS)
    chunk = ROWS_PER_CHUNK

    def unpack(batches: Iterator) -> Iterator:
        import csv
        import io
        import json
        import os
        import sys
        import tarfile

        import pandas as pd
        import pyarrow.parquet as pq

        def loadable(name):
            return os.path.splitext(name.lower())[1] in formats

        def pick(archive, packed):
            names = []
            # not a stream ("r|gz"): parquet members are read from several places
            with packed, tarfile.open(fileobj=packed, mode="r:gz") as tar:
                for info in tar:
                    names.append(info.name)
                    tar.members.clear()  # or all headers are kept
                    if info.isfile() and (
                        info.name.endswith(member) if member else loadable(info.name)
                    ):
                        yield info.name, tar.extractfile(info)
                        return
            raise ValueError(f"no member to load in {archive}; it contains {names}")

        def records(name, raw):
            ext = os.path.splitext(name.lower())[1]
            if formats.get(ext) == "parquet":
                for batch in pq.ParquetFile(raw).iter_batches(batch_size=chunk):
                    for row in batch.to_pylist():
                        yield json.dumps(row, ensure_ascii=False, default=str)
                return
            text = io.TextIOWrapper(raw, encoding="utf-8-sig", newline="")
            if formats.get(ext) == "csv":
                csv.field_size_limit(sys.maxsize)
                rows = csv.reader(text, delimiter="\t" if ext == ".tsv" else ",")
                header = next(rows, [])
                for row in filter(None, rows):
                    if len(row) != len(header):
                        raise ValueError(f"{name}, line {rows.line_num}: {len(row)} values for {len(header)} columns")
                    yield json.dumps({k: v for k, v in zip(header, row) if v != ""}, ensure_ascii=False)
            elif formats.get(ext) == "json":
                yield from json_objects(text, name)
            else:
                raise ValueError(f"Cannot load file type '{ext}' from {name}")

        def frame(archive, name, rows):
            return pd.DataFrame({"archive": archive, "member": name, "record": rows})

        for batch in batches:
            for n, archive in enumerate(batch["path"]):
                packed = io.BytesIO(batch["content"][n]) if "content" in batch else (opener or open_path)(archive)
                for name, raw in pick(archive, packed):
                    rows = []
                    for record in records(name, raw):
                        rows.append(record)
                        if len(rows) == chunk:
                            yield frame(archive, name, rows)
                            rows = []
                    if rows:
                        yield frame(archive, name, rows)

    given = ["path", "content"] if "content" in archives.columns else ["path"]
    raw = archives.select(*given).mapInPandas(
        unpack, "archive string, member string, record string"
    )
    if spread:
        raw = raw.repartition(spread)
    # CSV cells arrive as JSON strings, so read text first and cast afterwards.
    as_text = T.StructType([T.StructField(f.name, _text_type(f.dataType)) for f in schema])
    parsed = raw.withColumn("row", F.from_json("record", as_text, {"mode": "FAILFAST"}))
    return parsed.select(
        "archive",
        "member",
        *[F.col(f"row.{quoted(f.name)}").cast(f.dataType).alias(f.name) for f in schema],
    )


def _text_type(dtype: T.DataType) -> T.DataType:
    nested = (T.ArrayType, T.StructType, T.MapType)
    return dtype if isinstance(dtype, nested) else T.StringType()
