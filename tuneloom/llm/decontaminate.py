"""Benchmark decontamination with suffix arrays of the training text."""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from .tables import free_name, map_arrow, pieces, raw_text, split_words, spread

WINDOW = 10
#: Benchmark text that one pass over the documents holds in memory.
BLOCK_BYTES = 8 << 20
#: Training text of one shard, that is, of one suffix array.
SHARD_BYTES = 8 << 20
#: Pairs of a match and a place in an item that are looked at together.
PAIRS = 1 << 21

#: A word is a run of 0-9, a-z (A-Z lower-cased) and bytes of other
#: scripts; everything else becomes a space.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)

FOUND = (
    "struct<n_words: bigint, n_hit: bigint, spans: array<struct<start: bigint, stop: bigint>>,"
    " items: array<struct<item_id: string, words: bigint, doc_start: bigint, item_start: bigint>>>"
)


class TestSet:
    """The items of one block: vocabulary, distinct windows, and where they are."""

    def __init__(self, ids: list, texts: list, window: int = WINDOW):
        data, at = raw_text(pa.array(texts, pa.string()))
        words, counts = split_words(data.translate(WORD_BYTES), at)
        coded = words.dictionary_encode()
        self.window = window
        self.item_ids = [None if i is None else str(i) for i in ids]
        self.vocabulary = coded.dictionary
        codes = np.asarray(coded.indices, np.int64) + 1  # 0 stands for any other word
        first = np.cumsum(counts) - counts
        self.by_length: dict[int, tuple] = {}
        for length in range(1, window + 1):
            whole = counts >= window if length == window else counts == length
            rows = np.flatnonzero(whole)
            if len(rows) == 0:
                continue
            owner, offset = spread(counts[rows] - length + 1)
            item = rows[owner]
            keys = rows_as_bytes(codes, first[item] + offset, length)
            distinct, window_of = np.unique(keys, return_inverse=True)
            order = np.argsort(window_of, kind="stable")
            begin = np.searchsorted(window_of[order], np.arange(len(distinct) + 1))
            self.by_length[length] = (distinct, begin, item[order], offset[order])

    @property
    def shortest(self) -> int:
        return min(self.by_length, default=0)


def rows_as_bytes(codes: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """The ``length`` codes from each start as byte strings that sort like the codes."""
    table = codes[starts[:, None] + np.arange(length)].astype(">u4")
    return np.ascontiguousarray(table).view(f"S{4 * length}").ravel()


def suffix_array(codes: np.ndarray, starts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The starts in the order of their suffixes' first ``depth`` words, and
    those words."""
    keys = rows_as_bytes(codes, starts, depth)
    order = np.argsort(keys, kind="stable")
    return starts[order], keys[order]


def search_shard(codes: np.ndarray, test: TestSet) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Binary search of the test windows in the suffix array of a shard: for
    each window length the places in the shard, and which window starts there.

    ``codes`` has a 0 between documents and ``window`` of them at the end. A
    suffix whose first words aren't all test words cannot match and is left out.
    """
    if not test.by_length:
        return
    other = np.flatnonzero(codes == 0)
    run = other[np.searchsorted(other, np.arange(len(codes) - test.window))] - np.arange(len(codes) - test.window)
    starts, keys = suffix_array(codes, np.flatnonzero(run >= test.shortest), test.window)
    for length, (windows, *_) in test.by_length.items():
        low = np.searchsorted(keys, pad(windows, 0, test.window), "left")
        high = np.searchsorted(keys, pad(windows, 255, test.window), "right")
        owner, place = spread(high - low)
        places = starts[low[owner] + place]
        inside = run[places] >= length
        yield length, places[inside], owner[inside]


def pad(windows: np.ndarray, byte: int, depth: int) -> np.ndarray:
    """The windows with this byte after them, up to ``depth`` words."""
    width = windows.dtype.itemsize
    table = np.full((len(windows), 4 * depth), byte, np.uint8)
    table[:, :width] = windows.view(np.uint8).reshape(len(windows), width)
    return table.view(f"S{4 * depth}").ravel()


def longest_runs(doc: np.ndarray, place: np.ndarray, window: np.ndarray, length: int, test: TestSet) -> Iterator[tuple]:
    """doc, item, words, doc_start, item_start of the longest verbatim match
    between each document and each item (the first one of those that tie).

    Neighbouring windows on one diagonal make one match. Documents are taken in
    runs with a bounded number of pairs, one document at least.
    """
    _, begin, item_of, offset_of = test.by_length[length]
    order = np.lexsort((place, doc))
    doc, place, window = doc[order], place[order], window[order]
    many = begin[window + 1] - begin[window]
    docs, first = np.unique(doc, return_index=True)
    weight = np.add.reduceat(many, first) if len(first) else many
    stops = np.append(first, len(doc))
    start = 0
    while start < len(docs):
        end = start + 1
        total = weight[start]
        while end < len(docs) and total + weight[end] <= PAIRS:
            total += weight[end]
            end += 1
        part = slice(stops[start], stops[end])
        owner, nth = spread(many[part])
        at = begin[window[part]][owner] + nth
        d, p, i, o = doc[part][owner], place[part][owner], item_of[at], offset_of[at]
        line = np.lexsort((p, p - o, i, d))
        d, p, i, o = d[line], p[line], i[line], o[line]
        new = np.ones(len(d), bool)
        same = (d[1:] == d[:-1]) & (i[1:] == i[:-1])
        new[1:] = ~(same & (p[1:] - o[1:] == p[:-1] - o[:-1]) & (p[1:] == p[:-1] + 1))
        heads = np.flatnonzero(new)
        words = np.diff(np.append(heads, len(d))) + length - 1
        best = np.lexsort((o[heads], p[heads], -words, i[heads], d[heads]))
        heads, words = heads[best], words[best]
        lead = np.ones(len(heads), bool)
        lead[1:] = (d[heads[1:]] != d[heads[:-1]]) | (i[heads[1:]] != i[heads[:-1]])
        heads, words = heads[lead], words[lead]
        yield from zip(d[heads].tolist(), i[heads].tolist(), words.tolist(), p[heads].tolist(), o[heads].tolist())
        start = end


def examine(column: pa.Array, test: TestSet) -> list[dict]:
    """What the test set has in common with each row of text; see find_overlap."""
    data, at = raw_text(column)
    words, counts = split_words(data.translate(WORD_BYTES), at)
    known = pc.index_in(words, value_set=test.vocabulary.cast(words.type))
    own = pc.fill_null(known, -1).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    owner, _ = spread(counts)
    codes = np.zeros(len(own) + len(counts) + test.window, np.int64)
    codes[np.arange(len(own)) + owner] = own  # a 0 after each document
    first = np.cumsum(counts) - counts + np.arange(len(counts))
    found = [{"n_words": n, "n_hit": 0, "spans": [], "items": {}} for n in counts.tolist()]
    edges = np.zeros(len(codes) + 1, np.int64)
    for length, places, windows in search_shard(codes, test):
        np.add.at(edges, places, 1)
        np.add.at(edges, places + length, -1)
        doc = np.searchsorted(first, places, "right") - 1
        for d, i, n, p, o in longest_runs(doc, places, windows, length, test):
            found[d]["items"][i] = {
                "item_id": test.item_ids[i], "words": n, "doc_start": p - int(first[d]), "item_start": o,
            }
    hit = np.concatenate([[0], (np.cumsum(edges) > 0).astype(np.int8), [0]])
    begins, stops = np.flatnonzero(np.diff(hit) == 1), np.flatnonzero(np.diff(hit) == -1)
    for d, b, e in zip((np.searchsorted(first, begins, "right") - 1).tolist(), begins.tolist(), stops.tolist()):
        found[d]["spans"].append({"start": b - int(first[d]), "stop": e - int(first[d])})
        found[d]["n_hit"] += e - b
    for row in found:
        row["items"] = list(row["items"].values())
    return found


def test_blocks(items: DataFrame, text: str, key: str, window: int, block_bytes: int = BLOCK_BYTES) -> Iterator[TestSet]:
    """The test items in blocks of about ``block_bytes``, chosen by a hash. An
    empty set of items gives one empty block."""
    rows = items.select(items[key].alias("id"), items[text].alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    for block in range(blocks):
        mine = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block)
        got = mine.toArrow() if blocks > 1 else rows.toArrow()
        yield TestSet(got.column("id").to_pylist(), got.column("text").to_pylist(), window)


def find_overlap(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_text: str = "text",
    item_key: str = "item_id",
    window: int = WINDOW,
    found: str = "found",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The documents with a column of what they share with the test items.

    Each task splits its documents into shards of bounded size, builds a suffix
    array of each, and looks every test window (``window`` words in a row, or a
    whole shorter item) up by binary search; matches are then extended to the
    longest verbatim ones. ``found`` has n_words, n_hit (words inside a match),
    spans (word ranges of the document that match, merged) and items (for each
    item with a match its id as text, and the length and places of the longest).

    Nothing is shuffled. The test set is broadcast in blocks of a bounded size,
    one pass over the text each; each pass adds its findings to the row's.
    Null text has no words; items without words match nothing; rows that repeat
    and items that repeat are each judged on their own. A document longer than a
    shard has a shard of its own.
    """
    spark = docs.sparkSession
    schema = T.StructType(list(docs.schema.fields)).add(found, T._parse_datatype_string(FOUND))
    done = docs
    for block, test in enumerate(test_blocks(items, item_text, item_key, window, block_bytes)):
        done = map_arrow(done, _pass(spark.sparkContext.broadcast(test), text, found, block), schema)
    return done


def _pass(test, text: str, found: str, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, text, SHARD_BYTES, 1 << 20):
            rows = examine(piece.column(text), test.value)
            columns = {name: piece.column(name) for name in piece.schema.names}
            if block:
                rows = [merged(a, b) for a, b in zip(columns[found].to_pylist(), rows)]
            columns[found] = pa.array(rows, FOUND_ARROW)
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


SPAN = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
ITEM = pa.struct(
    [("item_id", pa.string()), ("words", pa.int64()), ("doc_start", pa.int64()), ("item_start", pa.int64())]
)
FOUND_ARROW = pa.struct(
    [("n_words", pa.int64()), ("n_hit", pa.int64()), ("spans", pa.list_(SPAN)), ("items", pa.list_(ITEM))]
)


def merged(a: dict, b: dict) -> dict:
    """The findings of two blocks of test items together."""
    spans: list[dict] = []
    for span in sorted(a["spans"] + b["spans"], key=lambda s: (s["start"], s["stop"])):
        if spans and span["start"] <= spans[-1]["stop"]:
            spans[-1]["stop"] = max(spans[-1]["stop"], span["stop"])
        else:
            spans.append(dict(span))
    n_hit = sum(s["stop"] - s["start"] for s in spans)
    return {"n_words": a["n_words"], "n_hit": n_hit, "spans": spans, "items": a["items"] + b["items"]}


def remove_affected(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents that share no window with a test item, with their columns."""
    found = free_name(docs, "found")
    marked = find_overlap(docs, items, text, found=found, **options)
    return marked.where(F.col(found)["n_hit"] == 0).drop(found)
