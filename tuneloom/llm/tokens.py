"""Token ids in directly addressable files."""

from __future__ import annotations

import os
import re
import zlib
from array import array
from functools import lru_cache
from typing import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window, functions as F

from .tables import map_arrow, pieces, raw_text, shared_path, spread

#: Id after each document.
END = 2
#: Ids of one segment, about: a document is not cut.
SEGMENT_IDS = 1 << 21
#: Bits of an id on each level but the last, which takes the rest of 32.
CHUNK = 8
LEVELS = 4
#: Continuation bits between two entries of a rank directory.
RANK_BITS = 512
#: Bytes that a task's memory of cuttings may take, about, and those that each
#: takes besides its text and its ids. Longer cuttings than this are not remembered.
REMEMBERED_BYTES = 192 << 20
ENTRY_BYTES = 180
REMEMBERED_LETTERS = 64
# File magic and version.
MAGIC = b"DACT"
VERSION = 1

# Bytes after which, and before which, one space always begins a
# new piece of a byte-level tokenizer: ASCII that is not white space. Of two-byte
# characters only those after U+00BF, none of which is white space.
_SOLID = np.zeros(256, bool)
_SOLID[0x21:0x7F] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_STOP = np.zeros(256, bool)
_STOP[[*b".,;:!?"]] = True
#: Letters below this (IPA extensions) are letters to Python and to the tokenizer alike.
_LATIN_END = "\u0250"
# The characters that a byte-level tokenizer writes for bytes. Bytes
# that print stand for themselves, the others for the characters from U+0100 on.
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_OTHERS = [b for b in range(256) if b not in _PRINTED]
_BYTE_CHARS = {b: chr(b) for b in _PRINTED} | {b: chr(0x100 + n) for n, b in enumerate(_OTHERS)}


class Encoder:
    """Ids of texts by a byte-level tokenizer file.

    A text is cut where the tokenizer's own pre-tokenizer always cuts: before a
    single space between two characters that aren't white space, and between an
    ASCII letter and one of . , ; : ! ? after it. The ids of a text are those of
    its cuttings, so each different cutting needs to be encoded only once; the
    short ones are remembered from batch to batch, up to a number of bytes. The
    name of a special token in a text is that token, as the tokenizer has it, or
    ordinary text with ``names_as_text``.
    Only for tokenizers without a normalizer and with a byte-level pre-tokenizer;
    others are an error.
    """

    def __init__(self, path: str, names_as_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = names_as_text
        before = self.tokenizer.pre_tokenizer
        if self.tokenizer.normalizer is not None or type(before).__name__ != "ByteLevel" or before.add_prefix_space:
            raise ValueError(f"{path} is no byte-level tokenizer that takes texts as they are")
        special = self.tokenizer.get_added_tokens_decoder().values()
        divided = re.compile("[^ ] [^ ]|[A-Za-z][.,;:!?]|^[^ ]*[A-Za-z]$")
        if any(t.lstrip or t.rstrip or t.single_word or divided.search(t.content) for t in special):
            raise ValueError(f"{path} has special tokens that a cut may divide")
        self.known: dict[str, bytes] = {}
        self.held = 0

    def encode(self, data: bytes, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the rows, and how many each row has."""
        n = len(at) - 1
        if not data:
            return np.zeros(0, np.uint32), np.zeros(n, np.int64)
        raw = np.frombuffer(data, np.uint8)
        solid = _SOLID[raw]
        two = np.zeros(len(raw), bool)
        two[:-1] = (raw[:-1] >= 0xC3) & (raw[:-1] <= 0xDF)
        opens = solid | two
        closes = solid.copy()
        closes[1:] |= two[:-1]
        cut = np.zeros(len(raw), bool)
        cut[1:-1] = (raw[1:-1] == 0x20) & closes[:-2] & opens[2:]
        cut[1:] |= _STOP[raw[1:]] & _LETTER[raw[:-1]]
        filled = at[:-1][np.diff(at) > 0]
        cut[filled] = True
        begin = np.flatnonzero(cut)
        offsets = np.append(begin, len(raw))
        cuttings = pa.Array.from_buffers(
            pa.large_string(), len(begin), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)]
        )
        coded = cuttings.dictionary_encode()
        coded_ids = pa.array(self._distinct(coded.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary()).take(coded.indices)
        total = np.frombuffer(coded_ids.buffers()[1], np.int64, len(begin) + 1) // 4
        flat = np.frombuffer(coded_ids.buffers()[2], "<u4", int(total[-1]))
        return flat, np.diff(total[np.searchsorted(begin, at)])

    def _distinct(self, texts: list[str]) -> list[bytes]:
        """The ids of different cuttings, four bytes each."""
        known, model = self.known, self.tokenizer.model
        if self.held > REMEMBERED_BYTES:
            known.clear()
            self.held = 0
        out = [known.get(t) for t in texts]
        mixed = []
        for n in [n for n, ids in enumerate(out) if ids is None]:
            t = texts[n]
            word = t[1:] if t[0] == " " else t
            if word.isalpha() and (t.isascii() or max(t) < _LATIN_END):
                # one word is one piece, so the model may be asked without the rest
                form = t.replace(" ", _BYTE_CHARS[0x20])
                if not t.isascii():
                    form = t.encode("utf-8").decode("latin-1").translate(_BYTE_CHARS)
                out[n] = array("I", [x.id for x in model.tokenize(form)]).tobytes()
                self._remember(t, out[n])
            else:
                mixed.append(n)
        for start in range(0, len(mixed), 4096):
            part = mixed[start : start + 4096]
            for n, e in zip(part, self.tokenizer.encode_batch_fast([texts[n] for n in part], add_special_tokens=False)):
                out[n] = array("I", e.ids).tobytes()
                self._remember(texts[n], out[n])
        return out

    def _remember(self, text: str, ids: bytes) -> None:
        if len(text) <= REMEMBERED_LETTERS:
            self.known[text] = ids
            self.held += len(text) + len(ids) + ENTRY_BYTES


@lru_cache(maxsize=2)
def encoder(path: str, names_as_text: bool = False) -> Encoder:
    return Encoder(path, names_as_text)


def pack(ids: np.ndarray) -> bytes:
    """Ids as a directly addressable code.

    Level 0 has the lowest CHUNK bits of every id; each further level has the
    next bits of those ids that are longer, in the same order. A level's
    continuation bits say which of its ids go on, and its rank directory how many
    do before every RANK_BITS of them: with it an id's place on the next level
    is one addition and one count of bits away. Layout: magic, version, then the
    number of levels (u4 each), then per level its number of ids (u8), chunks,
    continuation bits and directory (u4), all little-endian."""
    parts = [MAGIC, np.array([VERSION, 0], "<u4").tobytes()]
    left = ids.astype(np.uint64)
    n_levels = 0
    for level in range(LEVELS):
        n_levels += 1
        more = left >= (1 << CHUNK)
        bits = np.packbits(more, bitorder="little")
        padded = np.zeros(-(-max(len(more), 1) // RANK_BITS) * RANK_BITS, np.int64)
        padded[: len(more)] = more
        ranks = np.cumsum(padded.reshape(-1, RANK_BITS).sum(axis=1))
        parts += [
            np.array([len(left)], "<u8").tobytes(),
            (left & ((1 << CHUNK) - 1)).astype(np.uint8).tobytes(),
            bits.tobytes(),
            np.concatenate([[0], ranks[:-1]]).astype("<u4").tobytes(),
        ]
        left = left[more] >> CHUNK
        if len(left) == 0:
            break
    parts[1] = np.array([VERSION, n_levels], "<u4").tobytes()
    return b"".join(parts)


class Packed:
    """Access to a code made by pack()."""

    def __init__(self, payload: bytes):
        if payload[:4] != MAGIC:
            raise ValueError("not a token segment")
        version, n_levels = np.frombuffer(payload, "<u4", 2, 4)
        if version != VERSION:
            raise ValueError(f"unknown version {version}")
        at, self.levels = 12, []
        for _ in range(n_levels):
            n = int(np.frombuffer(payload, "<u8", 1, at)[0])
            chunks = np.frombuffer(payload, np.uint8, n, at + 8)
            n_bits, n_ranks = -(-n // 8), -(-max(n, 1) // RANK_BITS)
            bits = np.frombuffer(payload, np.uint8, n_bits, at + 8 + n)
            ranks = np.frombuffer(payload, "<u4", n_ranks, at + 8 + n + n_bits)
            self.levels.append((chunks, bits, ranks))
            at += 8 + n + n_bits + 4 * n_ranks

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def get(self, places: np.ndarray) -> np.ndarray:
        """The ids at these places; reads their chunks and at most RANK_BITS
        continuation bits for each, no others."""
        places = np.asarray(places, np.int64)
        ids = np.zeros(len(places), np.uint64)
        live = np.arange(len(places))
        for level, (chunks, bits, ranks) in enumerate(self.levels):
            ids[live] |= chunks[places].astype(np.uint64) << np.uint64(CHUNK * level)
            goes_on = (bits[places >> 3] >> (places & 7).astype(np.uint8)) & 1 == 1
            live, places = live[goes_on], places[goes_on]
            if len(live) == 0:
                break
            places = ranks[places // RANK_BITS].astype(np.int64) + _ones(bits, places)
        return ids.astype(np.uint32)

    def all(self) -> np.ndarray:
        """All ids, level by level."""
        ids = self.levels[0][0].astype(np.uint32)
        live = None
        for level, (chunks, bits, _) in enumerate(self.levels):
            if level:
                ids[live] |= chunks.astype(np.uint32) << np.uint32(CHUNK * level)
            more = np.unpackbits(bits, bitorder="little", count=len(chunks)).astype(bool)
            live = np.flatnonzero(more) if live is None else live[more]
        return ids


def _ones(bits: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Set bits from the last directory entry up to each place."""
    step = np.arange(RANK_BITS // 8)
    at = places % RANK_BITS
    full, rest = (at >> 3)[:, None], ((1 << (at & 7)) - 1)[:, None]
    wanted = np.where(step < full, 255, np.where(step == full, rest, 0)).astype(np.uint8)
    found = ((places - at) >> 3)[:, None] + step
    return np.bitwise_count(bits[np.minimum(found, len(bits) - 1)] & wanted).sum(axis=1, dtype=np.int64)


SEGMENT = (
    "part int, segment int, n_ids bigint, doc_ids array<{id}>, doc_sizes array<bigint>, payload binary"
)


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    text: str = "text",
    key: str = "doc_id",
    end: int = END,
    segment_ids: int = SEGMENT_IDS,
    order: Sequence[Column] = (),
) -> None:
    """Encode the documents and write their ids in ascending order of the key, or of
    the columns ``order``.

    The documents are range-partitioned and sorted by key (null first, rows with
    equal keys by a hash of the text) or by ``order`` (ties likewise). Null text is
    empty, a text of any length is one document, repeated rows are documents of their
    own, and no documents give no segments. Each partition becomes segments of about ``segment_ids``
    ids, whole documents each, with the id ``end`` after each document: parquet
    rows with the packed ids, the keys and the sizes of their documents. A lost
    executor's partitions are encoded again and committed once."""
    by = [f"by{i}" for i in range(len(order))]
    rows = docs.select(
        docs[key].alias("id"),
        F.coalesce(docs[text], F.lit("")).alias("text"),
        *[c.alias(name) for c, name in zip(order, by)],
    )
    by = by or ["id"]
    kind = rows.schema["id"].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, segment = TaskContext.get().partitionId(), 0
        tokens, names, sizes, held = [], [], [], 0
        for piece in pieces(batches, "text"):
            flat, counts = encoder(tokenizer).encode(*raw_text(piece.column("text")))
            ends = np.cumsum(counts)
            flat = np.insert(flat, ends, end)
            stops = ends + np.arange(1, len(counts) + 1)
            keys, start, first = piece.column("id").to_pylist(), 0, 0
            for row, stop in enumerate(stops.tolist()):
                if held + stop - start >= segment_ids or row == len(keys) - 1:
                    tokens.append(flat[start:stop])
                    names += keys[first : row + 1]
                    sizes += (counts[first : row + 1] + 1).tolist()
                    held += stop - start
                    start, first = stop, row + 1
                    if held >= segment_ids:
                        yield _segment(part, segment, tokens, names, sizes, piece.column("id").type)
                        segment, tokens, names, sizes, held = segment + 1, [], [], [], 0
        if names:
            yield _segment(part, segment, tokens, names, sizes, piece.column("id").type)

    sorted_ = rows.repartitionByRange(*by).sortWithinPartitions(*by, F.md5("text")).select("id", "text")
    segments = map_arrow(sorted_, encode, SEGMENT.format(id=kind))
    segments.write.option("compression", "zstd").parquet(path)


def _segment(part: int, segment: int, tokens: list, names: list, sizes: list, kind) -> pa.RecordBatch:
    ids = np.concatenate(tokens)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([part], pa.int32()),
            pa.array([segment], pa.int32()),
            pa.array([len(ids)], pa.int64()),
            pa.array([names], pa.list_(kind)),
            pa.array([sizes], pa.list_(pa.int64())),
            pa.array([pack(ids)], pa.binary()),
        ],
        ["part", "segment", "n_ids", "doc_ids", "doc_sizes", "payload"],
    )


def segment_starts(segments: DataFrame) -> DataFrame:
    """part, segment, first: the ids before each segment. Running sums go over
    partitions and, within a partition, over its segments; no payload is read."""
    sizes = segments.select("part", "segment", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("of_part"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("of_part").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    within = sizes.withColumn("within", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)))
    return within.join(parts, "part").select("part", "segment", (F.col("before") + F.col("within")).alias("first"))


def read_tokens(segments: DataFrame) -> DataFrame:
    """id, start (ids of all documents before), n_tokens (with the end id) and
    ids_crc32 (of the ids as little-endian u4) of every document, in the files."""
    kind = segments.schema["doc_ids"].dataType.elementType.simpleString()

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids = Packed(batch.column("payload")[row].as_py()).all().astype("<u4")
                names = batch.column("doc_ids")[row].values
                sizes = np.asarray(batch.column("doc_sizes")[row].values)
                stops = np.cumsum(sizes)
                if len(ids) != (stops[-1] if len(stops) else 0):
                    raise ValueError("a segment has lost ids")
                flat = ids.tobytes()
                sums = [zlib.crc32(flat[4 * (e - n) : 4 * e]) for e, n in zip(stops.tolist(), sizes.tolist())]
                n = len(names)
                yield pa.RecordBatch.from_arrays(
                    [
                        names,
                        pa.array(np.full(n, batch.column("part")[row].as_py(), np.int32)),
                        pa.array(np.full(n, batch.column("segment")[row].as_py(), np.int32)),
                        pa.array(stops - sizes),
                        pa.array(sizes),
                        pa.array(sums, pa.int64()),
                    ],
                    ["id", "part", "segment", "offset", "n_tokens", "ids_crc32"],
                )

    schema = f"id {kind}, part int, segment int, offset bigint, n_tokens bigint, ids_crc32 bigint"
    rows = map_arrow(segments.select("part", "segment", "doc_ids", "doc_sizes", "payload"), unpack, schema)
    return rows.join(segment_starts(segments), ["part", "segment"]).select(
        "id", (F.col("first") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )


def tokens_at(segments: DataFrame, places: DataFrame, place: str = "place") -> DataFrame:
    """place, token: the ids at these places of the whole stream. A place outside
    it, and null, gives no row. Only the segments that are asked for are opened,
    and of each only the chunks that are needed.

    Places are matched to segments by the range of ids of a fixed size that both
    touch, so no place meets all segments."""
    step = SEGMENT_IDS
    starts = segment_starts(segments).join(segments.select("part", "segment", "n_ids"), ["part", "segment"])
    cells = starts.where("n_ids > 0").withColumn(
        "cell",
        F.explode(F.sequence(F.floor(F.col("first") / step), F.floor((F.col("first") + F.col("n_ids") - 1) / step))),
    )
    asked = places.select(F.col(place).cast("bigint").alias("place")).where("place is not null")
    asked = asked.withColumn("cell", F.floor(F.col("place") / step))
    inside = (F.col("place") >= F.col("first")) & (F.col("place") < F.col("first") + F.col("n_ids"))
    hits = asked.join(cells, "cell").where(inside).select(
        "part", "segment", "place", (F.col("place") - F.col("first")).alias("at")
    )
    bundle = F.floor(F.col("at") / F.lit(1 << 16)).alias("bundle")
    wanted = hits.select("part", "segment", "place", "at", bundle)
    opened = segments.select("part", "segment", "payload").join(
        wanted.groupBy("part", "segment", "bundle").agg(F.collect_set("at").alias("at")), ["part", "segment"]
    )

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                at = np.asarray(batch.column("at")[row].values)
                ids = Packed(batch.column("payload")[row].as_py()).get(at)
                n = len(at)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, batch.column("part")[row].as_py(), np.int32)),
                        pa.array(np.full(n, batch.column("segment")[row].as_py(), np.int32)),
                        pa.array(at),
                        pa.array(ids.astype(np.int64)),
                    ],
                    ["part", "segment", "at", "token"],
                )

    found = map_arrow(opened, look, "part int, segment int, at bigint, token bigint")
    return hits.join(found, ["part", "segment", "at"]).select("place", "token")


def written_order(docs: DataFrame) -> list[Column]:
    """Columns that sort the rows of a parquet folder as they were written: by the
    number of the task that wrote the file, which follows the order of a range sort,
    the file, and the row's place in it. Files of other names come first. None if the
    frame was not read from files."""
    try:
        of_file = docs.metadataColumn("_metadata")
    except AnalysisException:
        return []
    task = F.regexp_extract(of_file["file_name"], r"^part-(\d+)", 1).try_cast("bigint")
    return [task, of_file["file_path"], of_file["row_index"]]


def token_files(docs: DataFrame, tokenizer: str, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """The segments of the documents, written to the shared folder and read again."""
    path = shared_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer, text, key, **options)
    kind = docs.schema[key].dataType.simpleString()
    return docs.sparkSession.read.schema(SEGMENT.format(id=kind)).parquet(path)
