"""Near duplicates by SimHash fingerprints and multi-index hashing."""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from .components import components
from .tables import LOWER, content_key, free_name, map_arrow, pieces, raw_text, spread, stored

SHINGLE = 3
SEED = 42
#: Shingles whose bits are counted in one byte each.
BLOCK = 255


def simhash(data: bytes, at: np.ndarray, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """64-bit fingerprints of rows of UTF-8 text, as unsigned integers.

    A bit is set if it is set in over half of the XXH64 hashes of the row's
    shingles: runs of ``shingle`` words between ASCII white space, joined by a
    space, A-Z lower-cased, repeats included; all words if there are fewer. A
    row without words has the fingerprint zero.
    """
    lowered = data.translate(LOWER)
    words: list[bytes] = []
    n_words = np.zeros(len(at) - 1, np.int64)
    ends = at.tolist()
    for row, (begin, end) in enumerate(zip(ends, ends[1:])):
        found = lowered[begin:end].split()
        n_words[row] = len(found)
        words += found
    prints = np.zeros(len(n_words), np.uint64)
    if not words:
        return prints
    size = np.fromiter(map(len, words), np.int64, len(words))
    word_end = np.cumsum(size + 1) - 1
    word_begin = word_end - size
    line = b" ".join(words)
    first_word = np.cumsum(n_words) - n_words
    n = np.where(n_words > 0, np.maximum(n_words - shingle + 1, 1), 0)
    owner, place = spread(n)
    first = first_word[owner] + place
    last = np.minimum(first + shingle, (first_word + n_words)[owner]) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(line[b:e], seed) for b, e in zip(word_begin[first].tolist(), word_end[last].tolist())),
        np.uint64,
        len(first),
    )
    # Bits j, 8 + j, 16 + j ... of up to 255 hashes are added up as the bytes of one number.
    has = n > 0
    blocks = -(-n[has] // BLOCK)
    row_of_block, block = spread(blocks)
    begin = (np.cumsum(n[has]) - n[has])[row_of_block] + block * BLOCK
    row_begin = np.cumsum(blocks) - blocks
    result = np.zeros(int(has.sum()), np.uint64)
    ones = np.uint64(0x0101010101010101)
    for j in range(8):
        sums = np.add.reduceat((hashes >> np.uint64(j)) & ones, begin)
        counts = np.add.reduceat(sums.view(np.uint8).reshape(-1, 8).astype(np.int64), row_begin, axis=0)
        for byte in range(8):
            bit = (2 * counts[:, byte] > n[has]).astype(np.uint64)
            result |= bit << np.uint64(8 * byte + j)
    prints[has] = result
    return prints


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id", **more: Column) -> DataFrame:
    """id, fingerprint (its 64 bits as a long) of every row, and the ``more``
    columns. Null text has no words and the fingerprint zero; other columns of
    the documents are not read."""
    names = list(more)
    rows = docs.select(docs[key].alias("id"), docs[text].alias("text"), *[more[n].alias(n) for n in names])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            prints = simhash(*raw_text(piece.column("text")))
            yield pa.RecordBatch.from_arrays(
                [piece.column("id"), pa.array(prints.view(np.int64)), *[piece.column(n) for n in names]],
                ["id", "fingerprint", *names],
            )

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    extra = "".join(f", {n} {kinds[n]}" for n in names)
    return map_arrow(rows, of, f"id {kinds['id']}, fingerprint bigint{extra}")


def as_hex(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


#: All bit flips that stay inside one segment and change one bit at most. With two
#: fingerprints two bits apart, flipping one of these bits in one and the other in
#: the other gives the same key, whether the two bits share a segment or not.
SEGMENTS = 4
BALL = [0] + [
    1 << (segment * (64 // SEGMENTS) + bit) for segment in range(SEGMENTS) for bit in range(64 // SEGMENTS)
]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _ball(df: DataFrame, centre: str, name: str) -> DataFrame:
    """The frame with every key one bit or less away from ``centre``."""
    masks = F.array(*[F.lit(_signed(m)).cast("bigint") for m in BALL])
    exploded = df.withColumn("mask", F.explode(masks))
    return exploded.withColumn(name, F.col(centre).bitwiseXOR(F.col("mask"))).drop("mask")


def links(prints: DataFrame) -> DataFrame:
    """a, b: links that connect all different fingerprints at two or fewer bits.

    Multi-index hashing: each fingerprint is filed under every key in the
    radius-1 Hamming balls of its segments, the other segments staying whole in
    the key. Two fingerprints at two bits or fewer share a key, and a key holds
    at most 65 fingerprints, since they all are within one bit of it: no bucket
    grows with the data, however many near copies there are. A key's members are
    all linked to its smallest one; those of keys with over two are fetched by
    looking the key's own ball up in the table of fingerprints.
    """
    # dealt out evenly, as many tasks as a shuffle has, since small rows that each make
    # 65 must not be coalesced; by key Spark would drop this as what distinct() does anyway
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    table = stored(prints.select("fingerprint").distinct(), "different")
    filed = _ball(table.repartition(parts), "fingerprint", "key").groupBy("key")
    buckets = filed.agg(F.count("*").alias("n"), F.min("fingerprint").alias("a"), F.max("fingerprint").alias("b"))
    shared = stored(buckets.where("n > 1"), "buckets")
    more = _ball(shared.where("n > 2").select("key", "a"), "key", "fingerprint").join(table, "fingerprint")
    found = shared.select("a", "b").union(more.select("a", F.col("fingerprint").alias("b")))
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    return found.where("a <> b").where(apart <= 2).distinct()


def groups(prints: DataFrame) -> DataFrame:
    """The rows with their component_id: the smallest id whose fingerprint can
    be reached over links of two bits or fewer.

    Equal fingerprints are one node. A null id never is a smallest one, unless
    its group has no other; repeated rows stay as they are."""
    prints = stored(prints, "fingerprints")
    nodes = prints.groupBy("fingerprint").agg(F.min("id").alias("least"))
    roots = components(links(prints))
    tied = nodes.join(
        roots.withColumnRenamed("node", "fingerprint").union(roots.select(F.col("root"), F.col("root")).distinct()),
        "fingerprint",
    )
    smallest = tied.groupBy("root").agg(F.min("least").alias("component_id"))
    of_tied = tied.join(smallest, "root").select("fingerprint", "component_id")
    named = nodes.join(of_tied.withColumnRenamed("component_id", "of_group"), "fingerprint", "left").select(
        F.col("fingerprint").alias("node"), F.coalesce("of_group", "least").alias("component_id")
    )
    return prints.join(named, prints["fingerprint"] == named["node"]).drop("node")


def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The documents without near duplicates: of each group the one with the
    smallest id, with all its columns. Of rows with equal id and text one stays.
    Where a group's smallest id (or null, if it has no other) stands for several
    texts, each of them stays, so no text is lost to a mistaken id."""
    prints = fingerprints(docs, text, key, content=content_key(docs[text]))
    chosen = groups(prints).where(F.col("id").eqNullSafe(F.col("component_id")))
    chosen = chosen.select(F.col("id").alias("chosen_id"), F.col("content").alias("chosen_text")).distinct()
    content, place = free_name(docs, "content"), free_name(docs, "place")
    named = docs.withColumn(content, content_key(docs[text]))
    same = named[key].eqNullSafe(chosen["chosen_id"]) & (named[content] == chosen["chosen_text"])
    kept = named.join(chosen, same, "left_semi")
    first = F.row_number().over(Window.partitionBy(key, content).orderBy(content))
    return kept.withColumn(place, first).where(F.col(place) == 1).drop(place, content)
