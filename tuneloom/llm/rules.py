"""Quality rules: word and repetition counts of a text, and lines that too many
documents of a host share."""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .tables import content_key, free_name, map_arrow, pieces, raw_text, stored

# Characters that count as symbols; words in a window.
SYMBOLS = b"#*$%&|<>"
WINDOW = 5
#: base_failed: fewer words, or a larger share of words in repeated windows, in percent.
MIN_WORDS = 10
MAX_REPEATED = 20
#: A line goes if more different texts of its host hold it, however large the host.
LINE_TEXTS = 10
#: A document is depleted if fewer words, and a smaller share of them, are left.
LEFT_WORDS = 10
LEFT_SHARE = 1 / 3
#: Parts that the copies of one line are dealt out to.
SALTS = 8

#: For normalised lines: A-Z to a-z, every digit to 0.
FOLD = bytes(b + 32 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else b for b in range(256))


def fold_line(words: list[bytes]) -> bytes:
    """A normalised line: its words in lower case, digits as 0, one space between."""
    return b" ".join(words).translate(FOLD)


def line_hash(words: list[bytes]) -> int:
    """64 signed bits that stand for a normalised line."""
    value = xxhash.xxh3_64_intdigest(fold_line(words))
    return value - (1 << 64) if value >> 63 else value


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words in windows found twice or more in the text, the first one included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    codes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    keys = np.zeros(n, np.uint64)
    for k in range(window):
        keys = (keys ^ (keys >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + codes[k : k + n]
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edges = np.zeros(len(words) + 1, np.int64)
    begin = np.flatnonzero(twice)
    np.add.at(edges, begin, 1)
    np.add.at(edges, begin + window, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


MEASURES = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"
LINES = "lines array<struct<line: bigint, words: bigint>>"


def measure(docs: DataFrame, text: str = "text", key: str = "doc_id", host: str = "source") -> DataFrame:
    """id, host, content (128 bits that stand for the text), the base counts and
    the normalised lines of every row, each with the words it makes up.

    Words stand between ASCII white space. Null text is empty: no words, no
    lines. A null host is a host of its own."""
    rows = docs.select(
        docs[key].alias("id"),
        docs[host].alias("host"),
        content_key(docs[text]).alias("content"),
        docs[text].alias("text"),
    )

    def count(data: bytes) -> tuple:
        words: list[bytes] = []
        n_lines, exact, folded = 0, set(), {}
        for line in data.split(b"\n"):
            own = line.split()
            if own:
                words += own
                n_lines += 1
                exact.add(line)
                code = line_hash(own)
                folded[code] = folded.get(code, 0) + len(own)
        letters = b"".join(words)
        points = len(letters) if letters.isascii() else len(letters.decode("utf-8", "replace"))
        symbols = len(data) - len(data.translate(None, SYMBOLS))
        lines = [{"line": code, "words": n} for code, n in folded.items()]
        return len(words), points, symbols, n_lines - len(exact), repeated_words(words), lines

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = f"id {kinds['id']}, host {kinds['host']}, content binary, {MEASURES}, {LINES}"
    line_type = pa.list_(pa.struct([("line", pa.int64()), ("words", pa.int64())]))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            data, at = raw_text(piece.column("text"))
            ends = at.tolist()
            *counts, lines = zip(*(count(data[b:e]) for b, e in zip(ends, ends[1:])))
            yield pa.RecordBatch.from_arrays(
                [piece.column(c) for c in ("id", "host", "content")]
                + [pa.array(c, pa.int64()) for c in counts]
                + [pa.array(lines, line_type)],
                ["id", "host", "content"]
                + ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lines"],
            )

    return map_arrow(rows, of, schema)


def frequent_lines(measured: DataFrame, texts: int = LINE_TEXTS) -> DataFrame:
    """host, content, line, words, n_words: the lines to be removed, once for
    each different text of a host that loses them.

    Copies of a text count as one document, so a text is not boilerplate because
    it was copied. A line is over the limit if more than ``texts`` texts of its
    host hold it: the limit does not grow with the host. The text with the smallest
    id (null last) keeps the line, all others lose it. Null is a host like any other.
    """
    lines = measured.select("id", "host", "content", "n_words", F.explode("lines").alias("at"))
    held = lines.groupBy("host", "content", F.col("at.line").alias("line")).agg(
        F.min("id").alias("id"), F.first("at.words").alias("words"), F.first("n_words").alias("n_words")
    )
    first = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "content"))
    spread_ = held.groupBy("host", "line").agg(F.count("*").alias("n"), first.alias("first"))
    over = spread_.where(F.col("n") > texts).select(
        F.col("host").alias("of_host"),
        F.col("line").alias("of_line"),
        F.col("first.content").alias("keeper"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("of_salt"),
    )
    salted = held.withColumn("salt", F.pmod(F.xxhash64("content"), F.lit(SALTS)).cast("int"))
    hit = salted["line"].eqNullSafe(over["of_line"]) & (salted["salt"] == over["of_salt"])
    hit = hit & salted["host"].eqNullSafe(over["of_host"])
    lost = salted.join(over, hit).where("content <> keeper")
    return lost.select("host", "content", "line", "words", "n_words")


def judge(measured: DataFrame, left_words: int = LEFT_WORDS, left_share: float = LEFT_SHARE) -> DataFrame:
    """The measured rows with base_failed, removed_words and kept, without their lines.

    base_failed: fewer than MIN_WORDS words, or over MAX_REPEATED percent of them
    in repeated windows. kept: not base_failed, and at least ``left_words`` words,
    or ``left_share`` of them, are left when the host's frequent lines are gone."""
    lost = frequent_lines(measured).groupBy("host", "content").agg(
        F.sum("words").alias("removed_words"), F.max("n_words").alias("had")
    )
    left = F.col("had") - F.col("removed_words")
    depleted = lost.where((left < left_words) & (left < left_share * F.col("had"))).select(
        F.col("host").alias("of_host"), F.col("content").alias("of_content"), F.lit(True).alias("depleted")
    )
    same = (F.col("content") == F.col("of_content")) & F.col("host").eqNullSafe(F.col("of_host"))
    few = F.col("n_words") < MIN_WORDS
    failed = few | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    judged = measured.drop("lines").join(depleted, same, "left").withColumn("base_failed", failed)
    kept = ~F.col("base_failed") & F.col("depleted").isNull()
    return judged.withColumn("kept", kept).drop("of_host", "of_content", "depleted")


def verdicts(docs: DataFrame, text: str = "text", key: str = "doc_id", host: str = "source") -> DataFrame:
    """id, host, content, the base counts, base_failed and kept of every row."""
    return judge(stored(measure(docs, text, key, host), "measures"))


def apply_rules(docs: DataFrame, text: str = "text", key: str = "doc_id", host: str = "source") -> DataFrame:
    """The documents that are kept, without their host's frequent lines and with
    all their columns; ``n_chars``, if there is such a column, follows the text. Null
    and empty texts fail the base rules; repeated rows stay or go together; a text of
    any length is read whole; no documents give none."""
    measured = stored(measure(docs, text, key, host), "measures")
    lines = frequent_lines(measured).groupBy("host", "content").agg(F.collect_set("line").alias("gone"))
    judged = judge(measured).where("kept").select("host", "content").distinct()
    same = (judged["content"] == lines["content"]) & judged["host"].eqNullSafe(lines["host"])
    kept = judged.join(lines, same, "left").select(
        judged["host"].alias("of_host"), judged["content"].alias("of_content"), "gone"
    )
    content, gone = free_name(docs, "content"), free_name(docs, "gone")
    named = docs.withColumn(content, content_key(docs[text]))
    mine = (named[content] == kept["of_content"]) & named[host].eqNullSafe(kept["of_host"])
    left = named.join(kept.withColumnRenamed("gone", gone), mine).drop("of_host", "of_content", content)
    out = docs.schema
    has_length = "n_chars" in docs.columns

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text).to_pylist()
            for row, codes in enumerate(batch.column(gone).to_pylist()):
                if codes and texts[row]:
                    texts[row] = without_lines(texts[row], set(codes))
            columns = {name: batch.column(name) for name in out.names}
            columns[text] = pa.array(texts, batch.column(text).type)
            if has_length:
                size = [None if t is None else len(t) for t in texts]
                columns["n_chars"] = pa.array(size).cast(batch.column("n_chars").type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return map_arrow(left, clean, out)


def without_lines(text: str, codes: set[int]) -> str:
    """The text without the lines that have one of these hashes."""

    def stays(line: str) -> bool:
        words = line.encode("utf-8").split()
        return not words or line_hash(words) not in codes

    return "\n".join(line for line in text.split("\n") if stays(line))
