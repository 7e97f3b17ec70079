"""Token counts from flat token files that have no index."""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .tables import map_arrow, pieces, raw_text, shared_path
from .tokens import encoder

#: The id after each document of a flat file; no text has it.
SEPARATOR = 50256
#: Ids of a block, wherever documents end.
BLOCK_IDS = 1 << 20


def write_flat(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    text: str = "text",
    key: str = "doc_id",
    separator: int = SEPARATOR,
    block_ids: int = BLOCK_IDS,
) -> None:
    """Write the documents' ids as flat files of little-endian u2, each document
    followed by the separator, cut into blocks (``path``/ids: file, block,
    payload), and beside them the keys in the order of the documents
    (``path``/keys: file, first, doc_ids). Blocks say nothing about documents.
    Null text has no ids; the name of a special token is ordinary text. A file is what one task read; nothing is shuffled."""
    rows = docs.select(docs[key].alias("id"), docs[text].alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, block, done = TaskContext.get().partitionId(), 0, 0
        left = np.zeros(0, "<u2")
        for piece in pieces(batches, "text"):
            flat, counts = encoder(tokenizer, names_as_text=True).encode(*raw_text(piece.column("text")))
            if flat.max(initial=0) > 0xFFFF or (flat == separator).any():
                raise ValueError("an id is the separator or takes more than two bytes")
            stream = np.concatenate([left, np.insert(flat, np.cumsum(counts), separator).astype("<u2")])
            keys = piece.column("id")
            yield _row("keys", file, done, None, keys, keys.type)
            done += len(keys)
            while len(stream) >= block_ids:
                yield _row("ids", file, block, stream[:block_ids].tobytes(), None, keys.type)
                stream, block = stream[block_ids:], block + 1
            left = stream
        if len(left):
            yield _row("ids", file, block, left.tobytes(), None, rows_type)

    from pyspark.sql.pandas.types import to_arrow_type

    rows_type = to_arrow_type(rows.schema["id"].dataType)
    schema = f"file int, n bigint, payload binary, doc_ids array<{kind}>, part string"
    made = map_arrow(rows, encode, schema)
    made.write.partitionBy("part").option("compression", "zstd").parquet(path)


def _row(part: str, file: int, n: int, payload: bytes | None, keys, kind) -> pa.RecordBatch:
    names = pa.array([None], pa.list_(kind)) if keys is None else pa.ListArray.from_arrays([0, len(keys)], keys)
    return pa.RecordBatch.from_arrays(
        [pa.array([file], pa.int32()), pa.array([n], pa.int64()), pa.array([payload], pa.binary()), names, pa.array([part])],
        ["file", "n", "payload", "doc_ids", "part"],
    )


def scan(blocks: DataFrame, separator: int = SEPARATOR, width: int = 2) -> DataFrame:
    """file, block, head, tail, lengths of each block of a flat file (columns
    file, block, payload): the ids before its first separator, those after its
    last one, and those between two. Without a separator all ids are tail and
    head is null. One vectorised comparison and one search per block."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for payload in batch.column("payload"):
                ids = np.frombuffer(payload.as_buffer(), f"<u{width}")
                ends = np.flatnonzero(ids == separator)
                if len(ends) == 0:
                    rows.append((None, len(ids), []))
                else:
                    rows.append((int(ends[0]), len(ids) - 1 - int(ends[-1]), np.diff(ends) - 1))
            head, tail, lengths = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("file"),
                    batch.column("block"),
                    pa.array(head, pa.int64()),
                    pa.array(tail, pa.int64()),
                    pa.array(lengths, pa.list_(pa.int64())),
                ],
                ["file", "block", "head", "tail", "lengths"],
            )

    kind = blocks.schema["file"].dataType.simpleString()
    schema = f"file {kind}, block bigint, head bigint, tail bigint, lengths array<bigint>"
    return map_arrow(blocks.select("file", F.col("block").cast("bigint").alias("block"), "payload"), search, schema)


def count_documents(blocks: DataFrame, separator: int = SEPARATOR, width: int = 2) -> DataFrame:
    """file, nth (from 0), n_tokens (without the separator) of every document.

    Documents that reach over blocks are stitched by running sums over the
    blocks of a file, from a row of a few numbers for each block: how many
    documents have ended before, and how many ids have gathered since the last
    separator. Ids after a file's last separator are a document too, unless there
    are none. No blocks give no rows."""
    scanned = scan(blocks, separator, width)
    so_far = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ended = F.when(F.col("head").isNull(), 0).otherwise(F.size("lengths") + 1)
    tails = F.coalesce(F.sum("tail").over(so_far), F.lit(0))
    # the running sum of tails just before the last separator's block, taken off
    at_end = F.max(F.when(F.col("head").isNotNull(), F.struct("block", "tails"))).over(so_far)
    carried = (
        scanned.withColumn("ended", ended)
        .withColumn("first", F.coalesce(F.sum("ended").over(so_far), F.lit(0)))
        .withColumn("tails", tails)
        .withColumn("carry", F.col("tails") - F.coalesce(at_end["tails"], F.lit(0)))
    )
    whole = carried.where("head IS NOT NULL").select(
        "file",
        F.posexplode(
            F.concat(F.array(F.col("carry") + F.col("head")), F.col("lengths"))
        ).alias("k", "n_tokens"),
        "first",
    )
    whole = whole.select("file", (F.col("first") + F.col("k")).alias("nth"), "n_tokens")
    last = F.max(F.struct("block", F.col("first") + F.col("ended"), _open())).alias("last")
    rest = carried.groupBy("file").agg(last).select("file", "last.*").toDF("file", "block", "nth", "n_tokens")
    return whole.union(rest.where("n_tokens > 0").select("file", "nth", "n_tokens"))


def _open():
    """Ids after the last separator so far, the block's own included."""
    return F.when(F.col("head").isNull(), F.col("carry") + F.col("tail")).otherwise(F.col("tail"))


def token_counts(docs: DataFrame, tokenizer: str, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """id, n_tokens of every row: flat files are written to the shared folder
    without an index, scanned for separators, and the counts given back to the
    keys by their order."""
    path = shared_path(docs.sparkSession, "flat")
    write_flat(docs, path, tokenizer, text, key, **options)
    kind = docs.schema[key].dataType.simpleString()
    schema = f"file int, n bigint, payload binary, doc_ids array<{kind}>, part string"
    made = docs.sparkSession.read.schema(schema).parquet(path)
    blocks = made.where("part = 'ids'").select("file", F.col("n").alias("block"), "payload")
    keys = made.where("part = 'keys'").select("file", "n", F.posexplode("doc_ids").alias("k", "id"))
    keys = keys.select("file", (F.col("n") + F.col("k")).alias("nth"), "id")
    counts = count_documents(blocks)
    return keys.join(counts, ["file", "nth"], "left").select("id", F.coalesce("n_tokens", F.lit(0)).alias("n_tokens"))
