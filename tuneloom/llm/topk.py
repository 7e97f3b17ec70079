"""Exact nearest vectors by a vector-approximation file."""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from .tables import cuts, map_arrow, stored

#: A component x counts as floor(SCALE * x).
SCALE = 256
#: Components of this size or more have no place in the four bytes that each takes.
LIMIT = 1 << 31
#: Bits of the cell that stands for a component in the approximation file.
BITS = 6
#: Vectors of a slice of the file, and bytes of the queries that meet it at a time.
SLICE = 32_768
QUERY_BYTES = 8 << 20
#: Scores that one step holds at a time.
TILE = 1 << 22
#: Doubles hold whole numbers up to here. Bounds are doubled, so they stay under half of it.
EXACT = float(1 << 52)


def whole_vectors(rows: DataFrame, key: str, vector: str, scale: float = SCALE) -> DataFrame:
    """id, vector: floor(scale * x) of every component, as little-endian integers
    of four bytes. Rows whose id is null or whose vector is null or has a null or
    non-finite component take no part; larger components than four bytes hold are
    an error."""
    rows = rows.select(rows[key].alias("id"), rows[vector].cast("array<double>").alias("vector"))

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id")
            lists = batch.column("vector")
            length = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = lists.flatten()
            x = pc.fill_null(flat, np.nan).to_numpy(zero_copy_only=False)
            owner = np.repeat(np.arange(len(length)), length)
            fit = pc.and_(pc.is_valid(lists), pc.is_valid(ids)).to_numpy(zero_copy_only=False)
            np.logical_and.at(fit, owner, np.isfinite(x))
            whole = np.floor(scale * x[fit[owner]])
            if len(whole) and np.abs(whole).max() >= LIMIT:
                raise ValueError(f"a component is {LIMIT / scale} or more")
            ends = 4 * np.concatenate([[0], np.cumsum(length[fit])])
            data = whole.astype("<i4").tobytes()
            vectors = pa.Array.from_buffers(
                pa.large_binary(), int(fit.sum()), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)]
            )
            yield pa.RecordBatch.from_arrays([ids.filter(pa.array(fit)), vectors.cast(pa.binary())], ["id", "vector"])

    return map_arrow(rows, turn, "id bigint, vector binary")


def first_rows(rows: DataFrame, by: list[str], order: list, n: int) -> DataFrame:
    """The n first rows of each group. Spark keeps n of each in every task before
    the shuffle, so a group of any size stays small."""
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return rows.withColumn("place", place).where(F.col("place") <= n).drop("place")


def different(rows: DataFrame, k: int) -> DataFrame:
    """unit, vector, length, least, ids: every different vector once, with its
    k + 1 smallest ids. A query's k nearest rows are among these: of equal
    vectors the smaller ids go first, and one may be the query's own."""
    few = first_rows(rows.distinct(), ["vector"], [F.col("id")], k + 1)
    found = few.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    return found.select(unit(), "vector", length(), F.col("ids")[0].alias("least"), "ids")


def unit() -> Column:
    """128 bits that stand for a vector."""
    return F.unhex(F.md5("vector")).alias("unit")


def length() -> Column:
    return (F.octet_length("vector") / 4).cast("int").alias("length")


def approximate(units: DataFrame, slices: int, bits: int = BITS) -> DataFrame:
    """The approximation file: a row for each slice of the vectors of one length,
    with the smallest value and the cell width of every component, the cell of
    each vector in every component (one byte each), and what ``units`` has as
    unit and least, in the order of least."""
    dealt = units.withColumn("slice", F.pmod(F.xxhash64("unit"), F.lit(slices)).cast("int"))
    schema = "length int, slice int, low binary, width binary, cells binary, least binary, units binary"

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by([("least", "ascending"), ("unit", "ascending")])
        n, d = len(table), table.column("length")[0].as_py()
        x = np.frombuffer(joined(table, "vector"), "<i4").reshape(n, d).astype(np.int64)
        low = x.min(axis=0)
        width = -(-(x.max(axis=0) - low + 1) // (1 << bits))
        cells = ((x - low) // width).astype(np.uint8)
        least = table.column("least").to_numpy()
        packed = [low.tobytes(), width.tobytes(), cells.tobytes(), least.tobytes(), joined(table, "unit")]
        arrays = [table.column(c).slice(0, 1).combine_chunks() for c in ("length", "slice")]
        return pa.table([*arrays, *(pa.array([v], pa.binary()) for v in packed)], names(schema))

    used = dealt.select("length", "slice", "unit", "least", "vector")
    return stored(used.groupBy("length", "slice").applyInArrow(pack, schema), "cells")


def joined(table, column: str) -> bytes:
    return b"".join(table.column(column).to_pylist())


def names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def query_blocks(queries: DataFrame, slices: int, block_bytes: int = QUERY_BYTES) -> DataFrame:
    """length, slice, asked, queries: the different queries packed into blocks of
    bounded size, each block once for every slice."""
    schema = "length int, asked binary, queries binary"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            for d in np.unique(lengths).tolist():
                rows = batch.filter(pa.array(lengths == d))
                for start, end in cuts(np.full(len(rows), 4 * d + 16), block_bytes, len(rows)):
                    part = rows.slice(start, end - start)
                    packed = [pa.array([joined(part, c)], pa.binary()) for c in ("unit", "vector")]
                    yield pa.RecordBatch.from_arrays([pa.array([d], pa.int32()), *packed], names(schema))

    packed = map_arrow(queries.select("length", "unit", "vector"), pack, schema)
    return packed.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))


def bounds(low, width, cells, query) -> tuple[np.ndarray, np.ndarray]:
    """The least and the largest score that each query (a row) can have with each
    vector (a column) of which only the cells are known: the score with the
    middles of the cells, and half a cell less or more in every component."""
    middle2 = 2.0 * (low + cells * width) + (width - 1)
    score2 = query @ middle2.T
    half2 = (np.abs(query) @ (width - 1.0))[:, None]
    return np.ceil((score2 - half2) / 2), np.floor((score2 + half2) / 2)


def unbeaten(lo: np.ndarray, hi: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns that may be among a row's k best, columns to the left
    going first in ties: all but those that k columns beat for certain."""
    if lo.shape[1] <= k:
        return np.nonzero(np.ones(lo.shape, bool))
    bar = np.partition(lo, -k, axis=1)[:, -k][:, None]
    row, column = np.nonzero(hi >= bar)
    tied = hi[row, column] == bar[row, 0]
    last = np.full(len(lo), lo.shape[1])
    for r in np.unique(row[tied]).tolist():
        over = np.count_nonzero(lo[r] > bar[r])
        last[r] = np.flatnonzero(lo[r] == bar[r])[k - over - 1]
    stay = ~tied | (column <= last[row])
    return row[stay], column[stay]


def candidates(cells: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """query, unit, least, lo, hi: for each query the vectors of every slice that
    may be among its k best, with the least and the largest score they can have.
    Left out are only those that k others of the slice beat for certain."""
    schema = "query binary, unit binary, least bigint, lo bigint, hi bigint"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for of in (row for batch in batches for row in rows_of(batch)):
            low, width, least = (np.frombuffer(of[c], np.int64) for c in ("low", "width", "least"))
            d = of["length"]
            cell = np.frombuffer(of["cells"], np.uint8).reshape(len(least), d)
            query = np.frombuffer(of["queries"], "<i4").reshape(len(of["asked"]) // 16, d)
            most = max(np.abs(low).max(initial=0), np.abs(low + 256 * width).max(initial=0))
            if np.abs(query.astype(np.float64)).sum(axis=1).max(initial=0) * most >= EXACT:
                raise ValueError("the scores are too large to be exact")
            step = max(1, TILE // len(least))
            for start in range(0, len(query), step):
                lo, hi = bounds(low, width, cell, query[start : start + step].astype(np.float64))
                q, v = unbeaten(lo, hi, k)
                arrays = [keys(of["asked"]).take(pa.array(start + q)), keys(of["units"]).take(pa.array(v))]
                arrays += [pa.array(x.astype(np.int64)) for x in (least[v], lo[q, v], hi[q, v])]
                yield pa.RecordBatch.from_arrays(arrays, names(schema))

    return map_arrow(blocks.join(cells, ["length", "slice"]), scan, schema)


def rows_of(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows one by one, as they may be of several megabytes."""
    for row in range(len(batch)):
        yield batch.slice(row, 1).to_pylist()[0]


def keys(data: bytes) -> pa.Array:
    """Keys of 16 bytes that follow one another."""
    fixed = pa.Array.from_buffers(pa.binary(16), len(data) // 16, [None, pa.py_buffer(data)])
    return fixed.cast(pa.binary())


def scores(pairs: DataFrame) -> DataFrame:
    """query, unit, score: inner products of the columns asked and vector."""
    schema = "query binary, unit binary, score bigint"

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(joined(batch, c), "<i4").astype(np.int64) for c in ("asked", "vector"))
            ends = pc.binary_length(batch.column("vector")).to_numpy(zero_copy_only=False).astype(np.int64) // 4
            ends = np.concatenate([[0], np.cumsum(ends)])
            total = np.concatenate([[0], np.cumsum(a * b)])
            arrays = [batch.column("query"), batch.column("unit"), pa.array(total[ends[1:]] - total[ends[:-1]])]
            yield pa.RecordBatch.from_arrays(arrays, names(schema))

    return map_arrow(pairs.select("query", "unit", "asked", "vector"), multiply, schema)


def certain(found: DataFrame, units: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """query, unit, score: the k best vectors of each query, ties to the smaller
    least. Exact vectors are read in the order of the bounds, of each query a
    few and then four times as many, until no unread one can be among the k."""
    order = [F.desc("lo"), F.col("least"), F.col("unit")]
    now, read = found, 4 * k
    while True:
        top = first_rows(now, ["query"], order, k)
        last = F.min(F.struct("lo", (-F.col("least")).alias("less")))
        bar = top.groupBy("query").agg(F.count("*").alias("n"), last.alias("bar"))
        beaten = (F.col("n") == k) & (F.struct("hi", -F.col("least")) < F.struct("bar.lo", "bar.less"))
        now = stored(now.join(bar, "query").where(~beaten).select("query", "unit", "least", "lo", "hi"), "candidates")
        unread = now.where("lo < hi")
        if unread.isEmpty():
            return first_rows(now, ["query"], order, k).select("query", "unit", F.col("lo").alias("score"))
        few = first_rows(unread, ["query"], [F.desc("hi"), F.col("least"), F.col("unit")], read)
        asked = queries.select(F.col("unit").alias("query"), F.col("vector").alias("asked"))
        pairs = few.join(units.select("unit", "vector"), "unit").join(asked, "query")
        score = stored(scores(pairs), "scores")
        exact = [F.coalesce("score", c).alias(c) for c in ("lo", "hi")]
        now = now.join(score, ["query", "unit"], "left").select("query", "unit", "least", *exact)
        read *= 4


def nearest(
    rows: DataFrame,
    is_query: Column,
    k: int = 5,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: float = SCALE,
    bits: int = BITS,
    slice_rows: int = SLICE,
) -> DataFrame:
    """query_id, rank, vec_id, score: for every row that meets ``is_query`` (a
    condition on the column ``key``) the k other rows with the highest inner
    product, ties to the smaller id; fewer, if there are no more.

    Components count as floor(scale * x). A row whose vector is null or has a
    null or non-finite component takes no part, nor does one with a null id;
    vectors of other lengths than the query's don't either. Repeats of a row with
    its id count once; rows that share an id, but not the vector, are rows of
    their own, each a query if the id is. Equal vectors are searched once,
    however many rows have them. An empty table has no result. Scores that a
    double cannot hold exactly and components from 2**31 / scale on are errors.
    """
    whole = stored(whole_vectors(rows, key, vector, scale), "vectors")
    units = stored(different(whole, k), "units")
    queries = whole.withColumnRenamed("id", key).where(is_query).select(F.col(key).alias("query_id"), "vector")
    queries = stored(queries.distinct().select("query_id", unit(), "vector", length()), "queries")
    asked = queries.select("unit", "vector", "length").distinct()
    slices = max(1, -(-units.count() // slice_rows))
    found = candidates(approximate(units, slices, bits), query_blocks(asked, slices), k + 1)
    best = certain(stored(found, "candidates"), units, asked, k + 1)
    rows_of = best.join(units.select("unit", F.explode("ids").alias("vec_id")), "unit")
    rows_of = first_rows(rows_of, ["query"], [F.desc("score"), F.col("vec_id"), F.col("unit")], k + 1)
    each = queries.select("query_id", F.col("unit").alias("query")).join(rows_of, "query")
    others = each.where((F.col("vec_id") != F.col("query_id")) | (F.col("unit") != F.col("query")))
    by = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id", "unit")
    ranked = others.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
