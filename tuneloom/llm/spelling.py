"""Words that differ by one letter, and the form each is a variant of."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .tables import LOWER, map_arrow, pieces, raw_text, stored

#: A run of letters, once A-Z are lower-cased.
LETTERS = "a-zÀ-ÿ"
#: Of the runs whose key's crc32 this number divides, one letter is left out.
TYPO = 199
LEAST_LETTERS, LEAST_COUNT = 6, 5
#: A word is a variant of one that occurs at least so many times as often.
RATIO = 5
#: Symbols that letters are hashed to. More make the neighbourhoods longer and the
#: words that share a reduced word fewer.
SYMBOLS = 8
#: Different words that a task counts before it hands the counts on.
COUNTED = 200_000
#: Letters of a text, or of words, that one step works on at a time.
STEP_LETTERS = 1 << 20
STEP_EDITS = 1 << 15
#: Base of the rolling hash, odd so that it has an inverse modulo 2^64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def parts(text: str, size: int) -> Iterator[str]:
    """The text in parts of about ``size`` characters that cut no run of letters."""
    other, start = re.compile(f"[^{LETTERS}]"), 0
    while start < len(text):
        end = start + size
        if end < len(text):
            found = other.search(text, end)
            end = found.start() if found else len(text)
        yield text[start:end]
        start = max(end, start + 1)


def word_counts(
    docs: DataFrame, text: str = "text", key: str = "doc_id", least_letters: int = LEAST_LETTERS, typo: int = TYPO
) -> DataFrame:
    """word, n: how often each word occurs in the whole texts.

    A word is a maximal run of A-Z, a-z and U+00C0 to U+00FF with A-Z in lower
    case and at least ``least_letters`` code points. Where ``typo`` divides h,
    the crc32 of ``<key>:<run>``, code point h % length is left out first. Null
    and empty texts have no words; a null key counts as empty; repeated rows
    count again. A task adds its counts up before they are shuffled, so a word
    that every document has is a few rows; a long text is read in parts.
    """
    rows = docs.select(docs[key].cast("string").alias("key"), docs[text].alias("text"))
    run = re.compile(f"[{LETTERS}]{{{least_letters},}}")

    def batch(total: dict[str, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"]
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, int] = {}
        for piece in pieces(batches, "text"):
            data, at = raw_text(piece.column("text"))
            lowered, ends = data.translate(LOWER), at.tolist()
            for name, begin, end in zip(piece.column("key").to_pylist(), ends, ends[1:]):
                seed = zlib.crc32(f"{name or ''}:".encode())
                for part in parts(lowered[begin:end].decode(), STEP_LETTERS):
                    for word, n in Counter(run.findall(part)).items():
                        h = zlib.crc32(word.encode(), seed)
                        if h % typo == 0:
                            at_letter = h % len(word)
                            word = word[:at_letter] + word[at_letter + 1 :]
                            if len(word) < least_letters:
                                continue
                        total[word] = total.get(word, 0) + n
                    if len(total) > COUNTED:
                        yield batch(total)
                        total = {}
        yield batch(total)

    return map_arrow(rows, count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


class Reduced:
    """Words with each letter hashed to one of a few symbols, all in flat arrays.

    The key of a sequence of symbols s is the sum of s[i] * BASE**i modulo 2^64,
    so that of a sequence with one edit follows from the sums before and after
    the edit, however long the word is.
    """

    def __init__(self, words: pa.Array, symbols: int = SYMBOLS):
        letters = np.frombuffer(raw_text(words)[0].decode().encode("utf-32-le"), np.uint32)
        self.length = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        self.symbols = symbols
        # symbols count from 1, so that a longer word is another sum
        hashed = letters.astype(np.uint64) * np.uint64(BASE) >> np.uint64(40)
        self.symbol = hashed % np.uint64(symbols) + np.uint64(1)
        first = np.cumsum(self.length) - self.length
        self.word = np.repeat(np.arange(len(words)), self.length)
        place = np.arange(len(letters)) - first[self.word]
        longest = int(self.length.max(initial=0)) + 1
        powers = np.full(longest + 1, BASE, np.uint64)
        powers[0] = 1
        self.power = np.cumprod(powers)[place]
        self.end_power = np.cumprod(powers)[self.length]
        term = self.symbol * self.power
        running = np.concatenate([[np.uint64(0)], np.cumsum(term)])
        self.before = running[:-1] - running[first][self.word]
        self.key = running[first + self.length] - running[first]
        # the symbol before, 0 at the start of a word
        self.last = np.where(place > 0, np.roll(self.symbol, 1), np.uint64(0))
        self.last_of_word = np.zeros(len(words), np.uint64)
        full = self.length > 0
        self.last_of_word[full] = self.symbol[(first + self.length - 1)[full]]

    def neighbourhood(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Word numbers and keys: the reduced word itself and every sequence of
        symbols one deleted, replaced or inserted symbol away, each one once. Of
        equal symbols in a row the first is deleted, and a symbol is inserted
        before its like, never after it, so that no sequence is made twice."""
        yield np.arange(len(self.key)), self.key
        for t in range(1, self.symbols + 1):  # inserted at the end
            t = np.uint64(t)
            other = np.flatnonzero(self.last_of_word != t)
            yield other, self.key[other] + t * self.end_power[other]
        for start in range(0, len(self.word), STEP_EDITS):
            cut = slice(start, start + STEP_EDITS)
            word, symbol, power, before = self.word[cut], self.symbol[cut], self.power[cut], self.before[cut]
            after = self.key[word] - before - symbol * power
            gone = symbol != self.last[cut]
            yield word[gone], (before + after * np.uint64(INVERSE))[gone]
            for t in range(1, self.symbols + 1):
                t = np.uint64(t)
                other = symbol != t
                yield word[other], (before + t * power + after)[other]
                other = self.last[cut] != t
                yield word[other], (before + t * power + (self.key[word] - before) * np.uint64(BASE))[other]


def one_edit(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced code point makes a of b."""
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    if len(long) - len(short) > 1 or short == long:
        return False
    same, end = 0, len(short)  # how long the beginnings are equal
    while same < end:
        middle = (same + end + 1) // 2
        if short[same:middle] == long[same:middle]:
            same = middle
        else:
            end = middle - 1
    return short[same + (len(short) == len(long)) :] == long[same + 1 :]


def near_words(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """word, near, n: pairs of words that differ by exactly one inserted, deleted
    or replaced code point, in both directions, with the near word's count.

    Words one edit apart stay at most one edit apart when their letters are
    hashed to a few ``symbols``. So the full neighbourhood of each reduced word
    is joined with the reduced vocabulary, and what meets is compared letter by
    letter. Of the word itself only a number goes along with its neighbourhood,
    which has a row for each of its letters and symbols. ``words`` has unique
    words; null is near nothing.
    """

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "near", STEP_EDITS):
            key = pa.array(Reduced(piece.column("near"), symbols).key.view(np.int64))
            yield pa.RecordBatch.from_arrays([key, *piece.columns], ["key", "near", "n"])

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "word", STEP_EDITS):
            number = piece.column("number")
            for word, key in Reduced(piece.column("word"), symbols).neighbourhood():
                arrays = [pa.array(key.view(np.int64)), number.take(pa.array(word))]
                yield pa.RecordBatch.from_arrays(arrays, ["key", "number"])

    full = words.where("word IS NOT NULL").select("word", "n")
    full = stored(full.withColumn("number", F.monotonically_increasing_id()), "vocabulary")
    # dealt out evenly, for a small table of words makes a hundred times as many rows
    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    probe = map_arrow(full.select("word", "number").repartition(parts), edit, "key bigint, number bigint")
    table = map_arrow(full.select(F.col("word").alias("near"), "n"), reduce, "key bigint, near string, n bigint")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "word"):
            pairs = zip(piece.column("word").to_pylist(), piece.column("near").to_pylist())
            yield piece.filter(pa.array([one_edit(a, b) for a, b in pairs], pa.bool_()))

    # Spark takes the neighbourhoods for as small as the words they are made of
    met = probe.hint("merge").join(table, "key").select("number", "near", "n")
    found = met.hint("merge").join(full.select("number", "word"), "number").select("word", "near", "n")
    return map_arrow(found.where("word <> near"), verify, found.schema)


def forms(words: DataFrame, ratio: int = RATIO, symbols: int = SYMBOLS) -> DataFrame:
    """The words with n_near, the number of words near them (0 if none), and
    form and form_n: the near word of largest n (of equal ones the first in
    code-point order) and its n, if that is ``ratio`` times the word's own n or
    more, else null."""
    best = F.min(F.struct((-F.col("n")).alias("less"), F.col("near").alias("form")))
    near = near_words(words, symbols).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    far = words.join(near, "word", "left").withColumn("form_n", -F.col("best.less"))
    enough = F.col("form_n") >= ratio * F.col("n")
    return far.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(enough, F.col("best.form")).alias("form"),
        F.when(enough, F.col("form_n")).alias("form_n"),
    )


def roots(named: DataFrame) -> DataFrame:
    """word, root: where the forms lead from each word that has one. Every form
    is more frequent than its word, so there are no circles; each round follows
    twice as many steps as the one before, until no root has a form."""
    now = stored(named.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = now.join(further, "root", "left")
        ahead = stored(moved.select("word", F.coalesce("next", "root").alias("root"), "next"), "roots")
        now = ahead.select("word", "root")
        if ahead.where("next IS NOT NULL").isEmpty():
            return now


def variants(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    least_count: int = LEAST_COUNT,
    ratio: int = RATIO,
    symbols: int = SYMBOLS,
) -> DataFrame:
    """word, n, n_near, form, form_n and root of every word of the documents that
    occurs ``least_count`` times or more. root follows the forms to the last one
    and is the word itself if it has none. Other columns of the documents are not
    read; without documents or words there are no rows. See ``word_counts`` for
    null, empty and long texts and repeated rows, ``forms`` for ties."""
    words = stored(word_counts(docs, text, key).where(F.col("n") >= least_count), "words")
    named = stored(forms(words, ratio, symbols), "forms")
    return named.join(roots(named), "word", "left").withColumn("root", F.coalesce("root", "word"))
