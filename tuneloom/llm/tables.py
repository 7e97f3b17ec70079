"""Scratch tables in the shared folder, and Arrow batches cut to bounded pieces."""

from __future__ import annotations

import tempfile
import uuid
from typing import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Text that one step inside a task works on at a time. A longer text comes alone.
PIECE_BYTES = 2 << 20
PIECE_ROWS = 2048
#: Bytes of an Arrow batch between the JVM and Python, unless the application sets its own.
BATCH_BYTES = 8 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"

#: bytes.translate table: A-Z to a-z, all other bytes as they are.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder of spark.checkpoint.dir, which driver and
    executors share. Only a local session may do without that setting."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
        base = tempfile.mkdtemp(prefix="corpus-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/corpus/{uuid.uuid4().hex}/{name}"


def stored(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """The frame, written once in the shared folder and read from there: lineage
    ends, and a lost executor costs no more than its running tasks."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_arrow(df: DataFrame, run, schema) -> DataFrame:
    """df.mapInArrow with batches that are bounded in bytes, not only in rows:
    the rows of a batch are held by the JVM and by Python at a time."""
    if not df.sparkSession.sparkContext.getConf().contains(_BATCH):
        df.sparkSession.conf.set(_BATCH, str(BATCH_BYTES))
    return df.mapInArrow(run, schema)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def content_key(text: Column) -> Column:
    """128 bits that stand for a text; null counts as empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def cuts(sizes: np.ndarray, max_bytes: int, max_rows: int) -> Iterator[tuple[int, int]]:
    """Runs of rows whose sizes add up to at most max_bytes, one row at least."""
    total = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    start = 0
    while start < len(sizes):
        end = int(np.searchsorted(total, total[start] + max_bytes, "right")) - 1
        end = min(max(end, start + 1), start + max_rows, len(sizes))
        yield start, end
        start = end


def pieces(
    batches: Iterable[pa.RecordBatch],
    column: str,
    max_bytes: int = PIECE_BYTES,
    max_rows: int = PIECE_ROWS,
) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows with a bounded amount of text."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        for start, end in cuts(sizes, max_bytes, max_rows):
            yield batch.slice(start, end - start)
        pa.default_memory_pool().release_unused()  # workers stay; what they don't use shouldn't


def raw_text(column: pa.Array) -> tuple[bytes, np.ndarray]:
    """The UTF-8 bytes of all rows, one after the other, and where rows begin
    (with the end at last). Null is empty."""
    rows = pc.fill_null(column, pa.scalar("", column.type)).cast(pa.large_string())
    if len(rows) == 0 or rows.buffers()[2] is None:
        return b"", np.zeros(len(rows) + 1, np.int64)
    at = np.frombuffer(rows.buffers()[1], np.int64)[rows.offset : rows.offset + len(rows) + 1]
    data = rows.buffers()[2].slice(int(at[0]), int(at[-1] - at[0])).to_pybytes()
    return data, at - at[0]


def split_words(data: bytes, at: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Words between ASCII white space (tab to carriage return, space) of the
    rows, and how many each row has."""
    if not data:
        return pa.array([], pa.large_string()), np.zeros(len(at) - 1, np.int64)
    rows = pa.Array.from_buffers(
        pa.large_string(), len(at) - 1, [None, pa.py_buffer(np.ascontiguousarray(at)), pa.py_buffer(data)]
    )
    lists = pc.ascii_split_whitespace(rows)
    begin = np.asarray(lists.offsets)
    words = lists.flatten()
    filled = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0
    before = np.concatenate([[0], np.cumsum(filled)])
    return words.filter(pa.array(filled)), before[begin[1:]] - before[begin[:-1]]


def spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows with so many members each: the row of every member, and the
    member's place in its row."""
    owner = np.repeat(np.arange(len(counts)), counts)
    first = np.cumsum(counts) - counts
    return owner, np.arange(len(owner)) - first[owner]
