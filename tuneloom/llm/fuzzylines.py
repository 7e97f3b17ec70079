"""Fuzzy line dedup: near-equal lines of all documents, one occurrence kept."""

from __future__ import annotations

from itertools import combinations
from operator import ne
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from .components import components
from .rules import FOLD
from .tables import content_key, free_name, map_arrow, pieces, raw_text, split_words, spread, stored

#: Bits in which the fingerprints of two linked lines may differ.
BITS = 3
#: Blocks that a fingerprint is cut into. Two fingerprints that differ in up to
#: BITS bits agree in at least BLOCKS - BITS of them.
BLOCKS = 5
#: Least edit similarity of linked lines: 1 - distance / length of the longer one, in words
#: or in letters, as the caller says.
SIMILARITY = 0.8
#: Lines of a bucket with which all others are compared first.
PIVOTS = 8
#: Lines of a large bucket that one step compares with as many others.
CELL = 1000
#: Lines of a bucket up to which a task compares all of them while it reads it.
SMALL = 256
#: Lines that agree in a block, up to which a task holds all of them to make their buckets.
GROUP = 1 << 19
#: Lines that a task files under their buckets in one go.
STEP = 1 << 16
#: Bits of the filter that keeps lines without a candidate out of the shuffle of texts.
FILTER_BITS = 1 << 25
#: Bits of one of Spark's bitmaps.
PART_BITS = 1 << 15
#: Between the places of a text's lines; odd, so that they differ.
PLACE_STEP = 0x1E3779B97F4A7C15

EDGES = [round(64 * b / BLOCKS) for b in range(BLOCKS + 1)]
#: Every choice of blocks that may agree, and the mask of its bits. Lines that agree in the
#: first block of a choice are brought together once for all choices that begin with it.
TABLES = list(combinations(range(BLOCKS), BLOCKS - BITS))
MASKS = [sum(((1 << EDGES[b + 1]) - (1 << EDGES[b])) for b in chosen) for chosen in TABLES]
#: Bits that the largest block has; a group's number is that of its block and the block's bits.
WIDTH = max(b - a for a, b in zip(EDGES, EDGES[1:]))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _hashes(data: bytes, at: np.ndarray) -> np.ndarray:
    """64 signed bits of every text of ``data``, which begin at ``at``."""
    ends = at.tolist()
    each = (xxhash.xxh3_64_intdigest(data[b:e]) for b, e in zip(ends, ends[1:]))
    return np.fromiter(each, np.uint64, len(ends) - 1).view(np.int64)


def _word_hashes(words: pa.Array) -> np.ndarray:
    """64 bits of every word in lower case with digits as 0. No word holds a line end."""
    whole = pa.LargeListArray.from_arrays(pa.array([0, len(words)], pa.int64()), words)
    data, _ = raw_text(pc.binary_join(whole, pa.scalar("\n", words.type)))
    each = map(xxhash.xxh3_64_intdigest, data.translate(FOLD).split(b"\n"))
    return np.fromiter(each, np.uint64, len(words))


def _word_prints(words: pa.Array, counts: np.ndarray) -> np.ndarray:
    """SimHash of lines that have so many words each."""
    prints = np.zeros(len(counts), np.uint64)
    if len(words) == 0:
        return prints.view(np.int64)
    coded = words.dictionary_encode()
    known = _word_hashes(coded.dictionary)
    pairs = np.repeat(np.arange(len(counts)) << 32, counts) | coded.indices.to_numpy()
    pairs.sort()
    pairs = pairs[np.concatenate([[True], pairs[1:] != pairs[:-1]])]
    hashes, counts = known[pairs & 0xFFFFFFFF], np.bincount(pairs >> 32, minlength=len(counts))
    blocks = -(-counts // 255)
    row, nth = spread(blocks)
    begin = (np.cumsum(counts) - counts)[row] + nth * 255
    filled = blocks > 0
    first = (np.cumsum(blocks) - blocks)[filled]
    for j in range(8):
        sums = np.add.reduceat((hashes >> np.uint64(j)) & np.uint64(0x0101010101010101), begin)
        ones = np.add.reduceat(sums.view(np.uint8).reshape(-1, 8).astype(np.int64), first, axis=0)
        for byte in range(8):
            prints[filled] |= (2 * ones[:, byte] > counts[filled]).astype(np.uint64) << np.uint64(8 * byte + j)
    return prints.view(np.int64)


def line_prints(lines: list[list[bytes]]) -> np.ndarray:
    """64-bit SimHash of each line's different words, hashed in lower case with
    digits as 0, as signed integers. A bit is set if it is in more than half of the
    words' hashes. Repeats don't count: the frequent words of a language would
    make all its long lines alike."""
    words = [w for line in lines for w in line]
    at = np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))])
    coded = pa.Array.from_buffers(pa.large_string(), len(words), [None, pa.py_buffer(at), pa.py_buffer(b"".join(words))])
    return _word_prints(coded, np.fromiter(map(len, lines), np.int64, len(lines)))


def _lines(column: pa.Array, only: np.ndarray | None = None) -> tuple:
    """Of every line with a word in the rows of a column: its row, its number
    from 0, its place; the words of all of them, and how many each line has. A place
    is 64 bits that stand for the row's text and the line's number in it. ``only``:
    a filter of places, lines of others are not split into words."""
    data, at = raw_text(column)
    ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 10)
    per_row = 1 + np.searchsorted(ends, at[1:]) - np.searchsorted(ends, at[:-1])
    owner, nth = spread(per_row)
    places = _hashes(data, at)[owner] + nth * PLACE_STEP
    begin = np.concatenate([np.sort(np.concatenate([at[:-1], ends + 1])), at[-1:]])
    if only is not None:
        wanted = _passes(only, places)
        lines = pa.Array.from_buffers(
            pa.large_string(), len(owner), [None, pa.py_buffer(begin), pa.py_buffer(data)]
        )
        data, begin = raw_text(lines.filter(pa.array(wanted)))
        owner, nth, places = owner[wanted], nth[wanted], places[wanted]
    words, counts = split_words(data, begin)
    filled = counts > 0
    return owner[filled], nth[filled], places[filled], words, counts[filled]


def _joined(words: pa.Array, counts: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The normalised lines that words make up, one after the other, where they
    begin (with the end at last), and their hashes."""
    offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int64())
    lines = pc.binary_join(pa.LargeListArray.from_arrays(offsets, words), pa.scalar(" ", words.type))
    data, at = raw_text(lines)
    data = data.translate(FOLD)
    return data, at, _hashes(data, at)


def occurrences(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """id, content, n_lines, nth, place, line, print: every line with a word: its
    document, its number from 0, both of them hashed, a hash of its normalised text (A-Z
    lower-cased, digits as 0, one space between words) and its SimHash. Besides them one row for every row of ``docs``,
    without a line, has how many such lines there are (n_lines, null in the others).
    Null text has no lines. Rows with equal id and text repeat each other's lines."""
    rows = docs.select(
        docs[key].alias("id"), content_key(docs[text]).alias("content"), docs[text].alias("text")
    )
    names = ["id", "content", "n_lines", "nth", "place", "line", "print"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            owner, nth, places, words, counts = _lines(piece.column("text"))
            take = pa.array(owner, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("id").take(take),
                    piece.column("content").take(take),
                    pa.nulls(len(owner), pa.int64()),
                    pa.array(nth, pa.int64()),
                    pa.array(places),
                    pa.array(_joined(words, counts)[2]),
                    pa.array(_word_prints(words, counts)),
                ],
                names,
            )
            n_lines = pa.array(np.bincount(owner, minlength=piece.num_rows), pa.int64())
            none = pa.nulls(piece.num_rows, pa.int64())
            whole = [piece.column("id"), piece.column("content"), n_lines, none, none, none, none]
            yield pa.RecordBatch.from_arrays(whole, names)

    kind = rows.schema["id"].dataType.simpleString()
    measures = ", ".join(f"{name} bigint" for name in names[2:])
    return map_arrow(rows, read, f"id {kind}, content binary, {measures}")


def hash_filter(lines: DataFrame, column: str = "line") -> np.ndarray:
    """FILTER_BITS bits, set where a line (its hash in ``column``) has it modulo their
    number. At most 4 MB reach the driver, however many lines there are."""
    at = F.pmod(column, F.lit(FILTER_BITS))
    parts = lines.groupBy(F.bitmap_bucket_number(at).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")
    )
    out = np.zeros((FILTER_BITS // PART_BITS + 2, PART_BITS // 8), np.uint8)
    for part, bits in parts.collect():
        out[part] = np.frombuffer(bits, np.uint8)
    # a part's number and a place in it follow from the hash as in Spark
    return out.reshape(-1)


def _passes(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    # part 0 has only bit 0; part k the bits from (k - 1) * PART_BITS + 1 to k * PART_BITS
    at = hashes % FILTER_BITS
    at = np.where(at > 0, at - 1 + PART_BITS, 0)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _sifted(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows whose line (column line) ``wanted`` has, and a few others, by a filter of
    fixed size: what follows shuffles few of the rest."""
    bits = rows.sparkSession.sparkContext.broadcast(hash_filter(wanted))

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_passes(bits.value, batch.column("line").to_numpy())))

    return map_arrow(rows, sift, rows.schema)


def line_texts(docs: DataFrame, wanted: DataFrame, text: str = "text", lines: DataFrame | None = None) -> DataFrame:
    """line, words: the hash and the normalised text of the lines of ``wanted``
    (column line), once each. Tasks leave out most others by a filter of fixed
    size before anything is shuffled; a join then leaves out the rest.

    ``lines`` (line, place) has a place in ``docs`` of every line. With it, only lines
    in places of wanted ones are split into words and hashed."""
    rows = docs.select(docs[text].alias("text"))
    context = docs.sparkSession.sparkContext
    bits, only = context.broadcast(hash_filter(wanted)), context.broadcast(None)
    if lines is not None:
        places = _sifted(lines.select("line", "place"), wanted).join(wanted, "line", "left_semi")
        only = context.broadcast(hash_filter(places, "place"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            *_, words, counts = _lines(piece.column("text"), only.value)
            data, at, hashes = _joined(words, counts)
            found = {int(hashes[i]): data[at[i] : at[i + 1]] for i in np.flatnonzero(_passes(bits.value, hashes))}
            texts = [line.decode("utf-8", "replace") for line in found.values()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.int64()), pa.array(texts, pa.string())], ["line", "words"]
            )

    texts = map_arrow(rows, read, "line bigint, words string")
    return stored(texts.join(wanted, "line", "left_semi").dropDuplicates(["line"]), "texts")


def _near(bucket: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows in the order of their buckets: how many rows the bucket of each has, and
    whether the row differs from another one of it in at most BITS bits. In buckets of
    over SMALL rows every row counts as one that does."""
    start = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    sizes = np.diff(np.concatenate([start, [len(bucket)]]))
    n = np.repeat(sizes, sizes)
    near = n > SMALL
    here = np.flatnonzero((n > 1) & ~near)
    end = np.repeat(start + sizes, sizes)
    for step in range(1, SMALL):
        here = here[here + step < end[here]]
        if len(here) == 0:
            break
        hit = here[np.bitwise_count((prints[here] ^ prints[here + step]).view(np.uint64)) <= BITS]
        near[hit] = near[hit + step] = True
    return n, near


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows in the order of their buckets, those of _near, with the size of the
    bucket; null where it has over SMALL rows, which leave as they come."""
    names = ["bucket", "line", "print"]
    held, large = [np.empty(0, np.int64)] * 3, None

    def out(rows: list[np.ndarray]) -> pa.RecordBatch:
        n, near = _near(rows[0], rows[2])
        if large is not None:
            more = rows[0] == large
            n, near = np.where(more, SMALL + 1, n), near | more
        sizes = pa.array(n[near], pa.int64(), mask=n[near] > SMALL)
        return pa.RecordBatch.from_arrays([*(pa.array(r[near]) for r in rows), sizes], [*names, "n"])

    for batch in batches:
        rows = [np.concatenate([h, batch.column(c).to_numpy()]) for h, c in zip(held, names)]
        if len(rows[0]) == 0:
            continue
        # the last bucket waits for its other rows, unless it is known to be large
        last = int(np.flatnonzero(np.concatenate([[True], rows[0][1:] != rows[0][:-1]]))[-1])
        whole = len(rows[0]) if rows[0][-1] == large or len(rows[0]) - last > SMALL else last
        if whole:
            yield out([r[:whole] for r in rows])
            if whole > last:
                large = int(rows[0][-1])
        held = [r[whole:] for r in rows]
    if len(held[0]):
        yield out(held)


def _tables(part: np.ndarray, line: np.ndarray, prints: np.ndarray) -> Iterator[pa.RecordBatch]:
    """bucket, line, print, n: the rows of _near in all buckets of whole groups (sorted by
    part), with the size of the bucket."""
    ends = np.searchsorted(part, np.arange(BLOCKS + 1) << WIDTH)
    for table, (mask, chosen) in enumerate(zip(MASKS, TABLES)):
        mine = slice(ends[chosen[0]], ends[chosen[0] + 1])
        key = prints[mine] & _signed(mask)
        order = np.argsort(key)
        if len(order) == 0:
            continue
        n, near = _near(key[order], prints[mine][order])
        order = order[near]
        # one number for a table and its bits
        bucket = (key[order].view(np.uint64) ^ np.uint64(0x9E3779B97F4A7C15 * (table + 1) % (1 << 64))) * np.uint64(0xBF58476D1CE4E5B9)
        bucket = (bucket ^ (bucket >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
        columns = [bucket.view(np.int64), line[mine][order], prints[mine][order], n[near]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["bucket", "line", "print", "n"])


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """_tables of rows in the order of their groups (part, line, print). Groups of over GROUP
    rows leave as they come, with their part in place of a bucket and null for its size; one
    that ends with the rows of the next STEP may still be held."""
    held, fresh, large = [[np.empty(0, np.int64)] * 3], 0, None

    def cut(end: bool) -> Iterator[pa.RecordBatch]:
        nonlocal held, large
        rows = [np.concatenate(c) for c in zip(*held)]
        part = rows[0]
        if len(part) == 0:
            return
        past = 0 if large is None else int(np.searchsorted(part, large, "right"))
        # the last group waits for its other rows
        last = len(part) if end else max(past, int(np.searchsorted(part, part[-1])))
        yield from _tables(*(r[past:last] for r in rows))
        if len(part) - last > GROUP:
            large = int(part[-1])
            yield raw([r[last:] for r in rows])
            last = len(part)
        if past:
            yield raw([r[:past] for r in rows])
        held = [[r[last:] for r in rows]]

    def raw(rows: list[np.ndarray]) -> pa.RecordBatch:
        columns = [*(pa.array(r) for r in rows), pa.nulls(len(rows[0]), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["bucket", "line", "print", "n"])

    for batch in batches:
        held.append([batch.column(c).to_numpy() for c in ("part", "line", "print")])
        fresh += batch.num_rows
        if fresh >= STEP:
            yield from cut(False)
            fresh = 0
    yield from cut(True)


def buckets(lines: DataFrame) -> DataFrame:
    """bucket, line, print, n, pivot: the lines (columns line, print) filed under
    the bits of every choice of BLOCKS - BITS blocks, with the number of lines of
    the bucket. Left out are buckets with one line and, in buckets of up to SMALL
    lines, those without another one within BITS bits. About PIVOTS lines of a
    bucket, chosen by hash, are its pivots; in a bucket of fewer than twice as
    many all lines are.

    A line is shuffled once for every block that a choice begins with. Tasks hold the
    lines that agree in such a block, up to GROUP of them at a time, and make the buckets;
    those of larger groups are sorted by Spark. What is stored are lines with a
    candidate, and large buckets."""
    firsts = sorted({chosen[0] for chosen in TABLES})
    bits = [
        F.shiftrightunsigned("print", EDGES[b]).bitwiseAND(F.lit((1 << EDGES[b + 1] - EDGES[b]) - 1).cast("bigint"))
        for b in firsts
    ]
    parts = F.explode(F.array(*[x + F.lit(b << WIDTH).cast("bigint") for b, x in zip(firsts, bits)]))
    filed = lines.select(parts.alias("part"), "line", "print").repartition("part").sortWithinPartitions("part")
    rows = stored(map_arrow(filed, _grouped, "bucket bigint, line bigint, print bigint, n bigint"), "near")
    step = F.greatest(F.lit(1), F.floor(F.col("n") / PIVOTS))
    chosen = F.pmod(F.xxhash64("line", "bucket"), step) == 0
    left = rows.where("n IS NULL").withColumnRenamed("bucket", "part")
    found = rows.where("n IS NOT NULL")
    if not left.isEmpty():
        found = found.unionByName(_sorted_buckets(left))
    return stored(found.withColumn("pivot", chosen), "members")


def _sorted_buckets(rows: DataFrame) -> DataFrame:
    """bucket, line, print, n of ``buckets`` for the lines (part, line, print) of groups that
    no task holds: they are filed one by one, and Spark sorts them by their buckets."""
    tables = F.array(*[
        F.array(*[F.lit(t) for t, chosen in enumerate(TABLES) if chosen[0] == b]).cast("array<int>") for b in range(BLOCKS)
    ])
    masks = F.array(*[F.lit(_signed(m)).cast("bigint") for m in MASKS])
    of_block = F.explode(F.get(tables, F.shiftright("part", WIDTH).cast("int")))
    filed = rows.select("line", "print", of_block.alias("table"))
    # only the table's number is shuffled with a line, its bucket follows from that
    bucket = F.xxhash64("table", F.col("print").bitwiseAND(F.get(masks, F.col("table"))))
    ordered = filed.repartition(bucket).select(bucket.alias("bucket"), "line", "print").sortWithinPartitions("bucket")
    found = stored(map_arrow(ordered, _members, "bucket bigint, line bigint, print bigint, n bigint"), "sorted")
    large = found.where("n IS NULL").withColumn("n", F.count("*").over(Window.partitionBy("bucket")))
    return found.where("n IS NOT NULL").unionByName(large)


def _pairs(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def candidates(members: DataFrame) -> DataFrame:
    """a, b: pairs of lines of a bucket that differ in at most BITS bits, one of
    which is a pivot. A bucket of n lines costs a multiple of n, not n * n."""
    p = members.where("pivot").select(F.col("bucket").alias("of"), F.col("line").alias("a"), F.col("print").alias("p"))
    near = F.bit_count(F.col("p").bitwiseXOR(F.col("print"))) <= BITS
    once = (F.col("line") != F.col("a")) & (~F.col("pivot") | (F.col("line") > F.col("a")))
    both = members.join(p, (F.col("bucket") == F.col("of")) & near & once)
    return _pairs(both.select("a", F.col("line").alias("b")))


def others(members: DataFrame, roots: DataFrame) -> DataFrame:
    """a, b: the remaining pairs of lines of a bucket that differ in at most BITS
    bits: those without a pivot. Left out are only pairs of one group already
    (``roots``: node, root), since they can't connect anything; a bucket that is
    all one group is not looked at.

    A bucket of many lines is dealt out to cells, each of which compares about
    CELL lines with as many others, so no task gets a whole one.
    """
    plain = members.where("NOT pivot").drop("pivot")
    named = plain.join(roots, F.col("line") == F.col("node"), "left").select(
        "bucket", "line", "print", "n", F.coalesce("root", "line").alias("root")
    )
    named = stored(named, "named")
    mixed = named.groupBy("bucket").agg(F.min("root").alias("r"), F.max("root").alias("s")).where("r <> s")
    open_ = named.join(mixed.select("bucket"), "bucket", "left_semi")
    last = F.ceil(F.col("n") / CELL) - 1
    dealt = open_.withColumn("last", last).withColumn("part", F.pmod(F.xxhash64("line"), F.col("last") + 1))
    left = dealt.select(
        "bucket", F.col("part").alias("i"), F.explode(F.sequence("part", "last")).alias("j"),
        F.col("line").alias("a"), F.col("print").alias("p"), F.col("root").alias("of_a"),
    )
    right = dealt.select(
        "bucket", F.explode(F.sequence(F.lit(0).cast("bigint"), "part")).alias("i"), F.col("part").alias("j"),
        F.col("line").alias("b"), F.col("print").alias("q"), F.col("root").alias("of_b"),
    )
    near = F.bit_count(F.col("p").bitwiseXOR(F.col("q"))) <= BITS
    met = left.join(right, ["bucket", "i", "j"]).where(
        near & (F.col("of_a") != F.col("of_b")) & ((F.col("i") < F.col("j")) | (F.col("a") < F.col("b")))
    )
    return _pairs(met)


def links(lines: DataFrame, docs: DataFrame, text: str = "text", unit: str = "words") -> DataFrame:
    """node, root: the lines (line, print, place) of ``docs`` that are linked to others,
    each with the smallest line of its group.

    Two lines are linked if they differ in at most BITS bits and are similar
    in words or letters (``unit``).
    Lines are first compared with the pivots of their buckets; most groups are
    whole after that. Then all other pairs are compared that two of the groups
    found so far, or lines without one, might be connected by. So the groups are
    those of all links, while pairs within a group are not made."""
    members = buckets(lines)
    pairs = stored(candidates(members), "candidates")
    # texts are looked up once, also of lines that meet no pivot and may be compared later
    known = line_texts(docs, stored(members.select("line").distinct(), "wanted"), text, lines)
    near = stored(compared(pairs, known, unit=unit), "links")
    roots = components(near)
    more = stored(others(members, roots), "others")
    if more.isEmpty():
        return roots
    found = stored(compared(more, known, unit=unit), "found")
    return roots if found.isEmpty() else components(roots.toDF("a", "b").union(found))


def _alike(x: str | list, y: str | list, most: int, part) -> int:
    """How many members x and y share from one end on, ``most`` at most; ``part``
    gives those from the i-th to the j-th."""
    low, step = 0, 16
    while low < most and part(x, low, min(low + step, most)) == part(y, low, min(low + step, most)):
        low, step = min(low + step, most), 2 * step
    high = min(low + step, most)
    while low < high:
        middle = (low + high + 1) // 2
        if part(x, low, middle) == part(y, low, middle):
            low = middle
        else:
            high = middle - 1
    return low


def within(x: str | list, y: str | list, limit: int) -> bool:
    """Whether so many insertions, deletions and replacements turn x into y:
    letters of texts, or members of lists.

    What both have in front and at the end is left out. If x and y are equally
    long and differ in few places that is enough, or if texts differ in so few words
    that their letters can't be more; else the rows of the table of
    distances are found one by one, each as two numbers with a bit per place
    (up or down by one), and no more of them than the limit allows."""
    n, m = len(x), len(y)
    if abs(n - m) > limit:
        return False
    front = _alike(x, y, min(n, m), lambda z, i, j: z[i:j])
    k = min(n, m) - front
    back = _alike(x, y, k, lambda z, i, j: z[len(z) - j : len(z) - i])
    x, y = x[front : n - back], y[front : m - back]
    n, m = len(x), len(y)
    if min(n, m) == 0 or limit == 0 or max(n, m) <= limit:
        return max(n, m) <= limit
    if isinstance(x, str):
        # a word that is inserted, deleted or replaced is as many letters and a space at most
        a, b = x.split(" "), y.split(" ")
        if within(a, b, limit // (1 + max(map(len, a + b)))):
            return True
    if n == m and sum(map(ne, x, y)) <= limit:
        return True
    places: dict = {}
    for i, w in enumerate(x):
        places[w] = places.get(w, 0) | 1 << i
    last, whole = 1 << (n - 1), (1 << n) - 1
    up, down, far = whole, 0, n
    for j, w in enumerate(y, 1):
        same = places.get(w, 0)
        level = same | down
        across = (((same & up) + up) ^ up) | same
        more = down | (whole & ~(across | up))
        less = up & across
        if more & last:
            far += 1
        elif less & last:
            far -= 1
        if far - (m - j) > limit:
            return False
        more = (more << 1 | 1) & whole
        up = ((less << 1) & whole) | (whole & ~(level | more))
        down = more & level
    return far <= limit


def similar(
    pairs: DataFrame, docs: DataFrame, text: str = "text", least: float = SIMILARITY, unit: str = "words"
) -> DataFrame:
    """The pairs of lines whose edit similarity is ``least`` or more: words, or
    letters, are inserted, deleted or replaced, and counted against those of the
    longer line. Only lines of a pair are shuffled with their texts."""
    wanted = stored(pairs.select(F.explode(F.array("a", "b")).alias("line")).distinct(), "wanted")
    return compared(pairs, line_texts(docs, wanted, text), least, unit)


def compared(pairs: DataFrame, known: DataFrame, least: float = SIMILARITY, unit: str = "words") -> DataFrame:
    """The pairs of ``similar``, by the texts in ``known`` (line, words)."""
    if unit not in ("words", "letters"):
        raise ValueError(f"unit must be words or letters, not {unit!r}")
    both = pairs.join(known.toDF("a", "x"), "a").join(known.toDF("b", "y"), "b")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                if unit == "words":
                    x, y = x.split(" "), y.split(" ")
                keep.append(within(x, y, int((1 - least) * max(len(x), len(y)) + 1e-9)))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return map_arrow(both.select("a", "b", "x", "y"), verify, "a bigint, b bigint")


def removed_lines(found: DataFrame, docs: DataFrame, text: str = "text", unit: str = "words") -> DataFrame:
    """id, content, nth: the lines of ``docs`` that go, of ``found``, their
    ``occurrences``. Of every group one stays: the first by id (null last) and
    number. Groups are connected over links between similar lines; equal
    normalised lines are one. Rows with equal id and text are one document."""
    found = found.where("line IS NOT NULL")
    counted = found.groupBy("line", "print").agg(F.count("*").alias("n"), F.min("place").alias("place"))
    lines = stored(counted, "lines")
    roots = links(lines.drop("n"), docs, text, unit)
    tied = stored(roots.union(roots.select("root", "root").distinct()).toDF("line", "root"), "tied")
    # a line that occurs once and has no group stays. Words in capitals and not, or of other
    # digits, are different ones, so a normalised line may have several fingerprints
    twice = lines.groupBy("line").agg(F.sum("n").alias("n")).where("n > 1").join(tied, "line", "left_anti")
    named = stored(twice.select("line", F.col("line").alias("root")).union(tied), "named")
    # most others are left out before anything is shuffled
    sifted = _sifted(found.select("id", "content", "nth", "line"), named)
    mine = F.struct(F.col("id").isNull().alias("unnamed"), "id", "nth", "content")
    grouped = stored(sifted.join(named, "line").select("id", "content", "nth", "root"), "grouped")
    # a large group's occurrences are one side of a plain join, which Spark can split
    keepers = stored(grouped.groupBy("root").agg(F.min(mine).alias("keeper")), "keepers")
    return grouped.join(keepers, "root").where(~mine.eqNullSafe(F.col("keeper"))).select("id", "content", "nth")


def line_report(docs: DataFrame, text: str = "text", key: str = "doc_id", unit: str = "words") -> DataFrame:
    """id, n_lines, n_removed, removed (the numbers of the lines that go, from 0)
    of every row. Documents without lines have zeros."""
    found = stored(occurrences(docs, text, key), "occurrences")
    by_doc = _by_doc(removed_lines(found, docs, text, unit))
    rows = found.where("line IS NULL").select("id", "content", "n_lines")
    same = rows["id"].eqNullSafe(by_doc["of_id"]) & (rows["content"] == by_doc["of_content"])
    return rows.join(by_doc, same, "left").select(
        "id",
        "n_lines",
        F.coalesce(F.size("removed"), F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce("removed", F.array().cast("array<bigint>")).alias("removed"),
    )


def _by_doc(gone: DataFrame) -> DataFrame:
    # of one document: its own lines, no more; copies of a row name the same ones
    return gone.groupBy(F.col("id").alias("of_id"), F.col("content").alias("of_content")).agg(
        F.sort_array(F.collect_set("nth")).alias("removed")
    )


def dedup_lines(docs: DataFrame, text: str = "text", key: str = "doc_id", unit: str = "words") -> DataFrame:
    """The documents without the lines that go; lines without a word stay."""
    found = stored(occurrences(docs, text, key), "occurrences")
    by_doc = _by_doc(removed_lines(found, docs, text, unit))
    content, numbers = free_name(docs, "content"), free_name(docs, "numbers")
    named = docs.withColumn(content, content_key(docs[text]))
    by_doc = by_doc.withColumnRenamed("removed", numbers)
    same = named[key].eqNullSafe(by_doc["of_id"]) & (named[content] == by_doc["of_content"])
    joined = named.join(by_doc, same, "left")
    split = F.split(F.col(text), "\n")
    kept = F.filter(split, lambda line, n: ~F.array_contains(F.col(numbers), n.cast("bigint")))
    left = F.when(F.size(numbers) > 0, F.array_join(kept, "\n")).otherwise(F.col(text))
    return joined.withColumn(text, left).select(*docs.columns)
