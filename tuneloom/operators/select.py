"""Column whitelist, blank-row removal and reproducible exact-size samples."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import all_of, any_blank, is_string, quoted, text_of, truncate

_HASH = "__sample_hash"

# Rows that may meet in the last task of a top-n before sample_exact switches
# to cutting by hash value. They are held in memory, texts and all.
TOPN_MAX_ROWS = 20_000
# Distinct hashes that may be counted one by one.
FINE_MAX_GROUPS = 1_000_000
# Copies of one row written by one task.
COPIES_PER_TASK = 100_000


def keep_columns(df: DataFrame, columns_keep: list[str]) -> DataFrame:
    """Drop every column not listed. Source order stays; unknown names are ignored."""
    wanted = set(columns_keep)
    return df.select([quoted(c) for c in df.columns if c in wanted])


def missing_columns(df: DataFrame, columns: list[str]) -> list[str]:
    return sorted(set(columns) - set(df.columns))


def drop_blank_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Keep rows where no listed column is null and no listed string is blank."""
    names = df.columns if columns is None else [c for c in columns if c in df.columns]
    if not names:
        return df
    # The null tests are stated on their own, so that they reach the scan.
    filled = all_of([F.col(quoted(n)).isNotNull() for n in names])
    texts = {n: df.schema[n].dataType for n in names if is_string(df.schema[n].dataType)}
    return df.where(filled & ~any_blank(texts))


def head(df: DataFrame, rows: int, order_by: list[str] | None = None) -> DataFrame:
    """First ``rows`` rows: any (no sort, the scan stops early) or by key."""
    return (df.orderBy(*map(quoted, order_by)) if order_by else df).limit(rows)


def preview(df: DataFrame, order_by: list[str], rows: int = 3, width: int = 200) -> DataFrame:
    """The first rows by key, each cell printed and cut to ``width`` characters."""
    first = head(df, rows, order_by)
    return first.select(
        [truncate(text_of(f.name, f.dataType), width).alias(f.name) for f in df.schema]
    )


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).alias("columns"))


def filter_metrics(df: DataFrame, columns_keep: list[str], rows: int) -> DataFrame:
    """What select_rows does to ``df``, counted in one pass over the kept columns."""
    kept = [c for c in columns_keep if c in df.columns]
    blank = any_blank({c: df.schema[c].dataType for c in kept})
    valid = F.count_if(~blank)
    return df.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(blank).alias("dropped_blank"),
        F.least(valid, F.lit(rows).cast("long")).alias("rows_out"),
        F.lit(len(kept)).alias("columns_kept"),
        (valid < rows).alias("shortfall"),
    )


def _row_hash(df: DataFrame, seed: int) -> Column:
    whole = F.to_json(F.struct(*map(quoted, df.columns)), {"ignoreNullFields": "false"})
    return F.md5(F.concat(F.lit(f"{seed}:"), whole))


def _sample_hash(df: DataFrame, seed: int, key: list[str] | None) -> Column:
    if not key:
        return _row_hash(df, seed)
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(quoted(k)).cast("string") for k in key]))


def _scan_tasks(df: DataFrame) -> int | None:
    """Rough number of scan tasks from the size of what is read; None if unknown."""
    try:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    except AttributeError:  # a Connect session has no JVM handle
        return None
    return sum(size // (128 << 20) + 1 for size in sizes)


def _octave() -> Column:
    """Groups of hash values that halve in size towards zero, each cut in 32: as
    fine around the first few hashes of very many as around all hashes of few,
    with a few hundred groups at most in a task."""
    bits = F.conv(F.substring(_HASH, 1, 10), 16, 2)
    return F.struct(F.length(bits), F.substring(bits, 1, 6))


def _crossing(hashed: DataFrame, group: Column, rows: int):
    """The group of hashes in which the running count reaches ``rows``: its count,
    its least and largest hash and the rows below it; None if there are fewer rows.
    Only counts are shuffled. One task adds them up: some thousands, or at most
    FINE_MAX_GROUPS or so."""
    counts = hashed.groupBy(group.alias("place")).agg(
        F.count(F.lit(1)).alias("n"), F.min(_HASH).alias("least"), F.max(_HASH).alias("most")
    )
    before = Window.orderBy("least").rowsBetween(Window.unboundedPreceding, -1)
    return (
        counts.withColumn("below", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .where((F.col("below") < rows) & (F.col("below") + F.col("n") >= rows))
        .first()
    )


def _copies(row: DataFrame, n: int) -> DataFrame:
    """``n`` copies of a one-row frame, written by as many tasks as it takes."""
    tasks = -(-n // COPIES_PER_TASK)
    size = F.least(F.lit(COPIES_PER_TASK), F.lit(n) - F.col("__task") * COPIES_PER_TASK)
    spread = row.withColumn("__task", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))))
    if tasks > 1:
        spread = spread.repartition(tasks, "__task")
    return spread.withColumn("__copy", F.explode(F.sequence(F.lit(1), size))).drop(
        "__task", "__copy"
    )


def _top(hashed: DataFrame, plain: DataFrame, rows: int, seed: int) -> DataFrame:
    # The second key is only evaluated for equal hashes.
    return hashed.orderBy(_HASH, _row_hash(plain, seed)).limit(rows).drop(_HASH)


def _take_by_hash(hashed: DataFrame, rows: int, seed: int, keyed: bool, method: str) -> DataFrame:
    """The ``rows`` first rows in hash order, without the hash column.

    Counts hashes by ever finer groups until the place of the cut is known. The
    first count mostly tells which hashes come into question, a few per cent more
    than are wanted; later ones only look inside the group that holds the cut. A
    group whose least and largest hash are equal is known to the last digit.
    """
    plain = hashed.drop(_HASH)
    if rows <= 0:
        return plain.limit(0)
    tasks = _scan_tasks(hashed)
    small = tasks is not None and rows * tasks <= TOPN_MAX_ROWS
    if method == "topn" or (method == "auto" and small):
        return _top(hashed, plain, rows, seed)
    part, group, need = hashed, _octave(), rows
    while True:
        hit = _crossing(part, group, need)
        if hit is None:
            return plain
        need -= hit["below"]
        least, most = hit["least"], hit["most"]
        if method == "auto" and rows - need + hit["n"] <= TOPN_MAX_ROWS:
            return _top(hashed.where(F.col(_HASH) <= most), plain, rows, seed)
        if least == most:
            break
        part = hashed.where(F.col(_HASH).between(least, most))
        same = len(os.path.commonprefix([least, most]))
        fine = hit["n"] <= FINE_MAX_GROUPS
        group = F.col(_HASH) if fine else F.substring(_HASH, 1, same + 3)
    if hit["n"] == need:  # all rows with the last hash belong to the sample
        return hashed.where(F.col(_HASH) <= most).drop(_HASH)
    at_cut = hashed.where(F.col(_HASH) == most).drop(_HASH)
    if keyed:  # the key is not unique here: go on by whole row
        at_cut = at_cut.withColumn(_HASH, _row_hash(at_cut, seed))
        rest = _take_by_hash(at_cut, need, seed, False, method)
    else:  # equal hashes of whole rows are copies
        rest = _copies(at_cut.limit(1), need)
    return hashed.where(F.col(_HASH) < most).drop(_HASH).unionByName(rest)


def _hashed(
    df: DataFrame, columns: list[str] | None, seed: int, key: list[str] | None
) -> DataFrame:
    """The kept columns and the sample hash; of the others only the key is read."""
    kept = df if columns is None else keep_columns(df, columns)
    hash_of = _sample_hash(df if key else kept, seed, key)
    return df.select(*map(quoted, kept.columns), hash_of.alias(_HASH))


def sample_exact(
    df: DataFrame,
    rows: int,
    seed: int = 42,
    key: list[str] | None = None,
    method: str = "auto",
    columns: list[str] | None = None,
) -> DataFrame:
    """Exactly ``min(rows, count)`` rows, the same ones for the same seed however
    the data are partitioned; of ``columns`` only, if given.

    Rows are taken in the order of md5(seed, key), or of the whole row (of the
    columns taken) without a key. ``topn`` keeps a heap per task and merges the
    heaps in one task; ``cut`` first finds the hash value that has exactly ``rows``
    rows up to it (counts only) and then filters by it, so no rows meet in one
    task. ``auto`` takes ``topn`` where the merge stays small, after a filter by
    hash if need be. Both but ``topn`` count while the frame is built.
    """
    return _take_by_hash(_hashed(df, columns, seed, key), rows, seed, bool(key), method)


def select_rows(
    df: DataFrame,
    columns_keep: list[str],
    rows: int,
    seed: int = 42,
    key: list[str] | None = None,
    method: str = "auto",
) -> DataFrame:
    """Whitelist, then blank-row removal, then an exact sample. Key columns may
    lie outside the whitelist."""
    hashed = _hashed(df, columns_keep, seed, key)
    valid = drop_blank_rows(hashed, keep_columns(df, columns_keep).columns)
    return _take_by_hash(valid, rows, seed, bool(key), method)
