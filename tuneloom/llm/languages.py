"""Language identification by the nearest of several centroids per language."""

from __future__ import annotations

import unicodedata
from functools import lru_cache
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .tables import map_arrow, pieces, raw_text

#: Cells of a text's vector; n-grams of 1 to 3 letters are hashed into them.
CELLS = 4096
GRAMS = 3
#: Labelled texts per language that the centroids are fitted on, about. The
#: document frequencies are those of all labelled texts.
SAMPLE = 400
CENTROIDS = 3
ROUNDS = 12
#: A text that is less like the nearest centroid than this is rejected.
REJECT = 0.15
#: Text and rows that are turned into vectors together.
STEP_BYTES = 2 << 20
STEP_ROWS = 512


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For every code point a number that stands for its lower-cased letter; 0
    for all that is no letter."""
    table = np.zeros(0x110000, np.uint32)
    for point in range(0x110000):
        c = chr(point)
        if unicodedata.category(c)[0] == "L":
            table[point] = ord(c.lower()[0])
    return table


def vectors(data: bytes, at: np.ndarray, cells: int = CELLS) -> tuple[np.ndarray, np.ndarray]:
    """How often the n-grams of each cell are in each row of text, and which
    rows have a letter. N-grams stay inside a word and its two borders: what is
    no letter, however long, is one border."""
    n = len(at) - 1
    has = np.zeros(n, bool)
    if not data:
        return np.zeros((n, cells), np.float32), has
    points = np.frombuffer(data.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    starts = np.frombuffer(data, np.uint8)
    count = np.concatenate([[0], np.cumsum((starts & 0xC0) != 0x80)])  # code points before each byte
    owner = np.repeat(np.arange(n), np.diff(count[at]))
    codes = _letters()[points].astype(np.uint64)
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] > 0) | (codes[:-1] > 0) | (owner[1:] != owner[:-1])
    codes, owner = codes[keep], owner[keep]
    has[owner[codes > 0]] = True
    total = np.zeros(n * cells, np.float32)
    gram = np.zeros(len(codes), np.uint64)
    for size in range(1, GRAMS + 1):
        m = len(codes) - size + 1
        if m <= 0:
            break
        gram = gram[:m] * np.uint64(0x100000001B3) + codes[size - 1 :] + np.uint64(size)
        inside = owner[:m] == owner[size - 1 :]
        # no gram of borders only, none with a border in its middle
        inside &= codes[:m] > 0 if size == 1 else (codes[:m] > 0) | (codes[size - 1 :] > 0)
        for k in range(1, size - 1):
            inside &= codes[k : k + m] > 0
        mixed = (gram ^ (gram >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        cell = (mixed >> np.uint64(40)).astype(np.int64) % cells
        total += np.bincount(owner[:m][inside] * cells + cell[inside], minlength=n * cells).astype(np.float32)
    return total.reshape(n, cells), has


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF rows of length 1; rows without n-grams stay zero."""
    rows = np.sqrt(counts) * idf
    size = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, size, out=np.zeros_like(rows), where=size > 0)


def spherical_kmeans(rows: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """At most k centroids of length 1. It starts at the row nearest to the mean
    and at those farthest from the centroids so far, so runs agree."""
    mean = rows.mean(axis=0)
    chosen = [int(np.argmax(rows @ mean))]
    while len(chosen) < min(k, len(rows)):
        near = (rows @ rows[chosen].T).max(axis=1)
        chosen.append(int(np.argmin(near)))
    centres = rows[chosen]
    for _ in range(rounds):
        own = np.argmax(rows @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, rows)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(size > 0, sums / np.maximum(size, 1e-12), centres)
    return centres


class Model:
    """Languages, their centroids and the weights of the cells."""

    def __init__(self, languages: list[str], centres: np.ndarray, idf: np.ndarray, cells: int = CELLS):
        self.languages, self.centres, self.idf, self.cells = languages, centres, idf, cells

    def predict(self, data: bytes, at: np.ndarray) -> tuple[list[str], np.ndarray]:
        counts, has = vectors(data, at, self.cells)
        if not self.languages:
            return ["und"] * len(has), np.zeros(len(has))
        likeness = weighted(counts, self.idf) @ self.centres.T
        best = np.argmax(likeness, axis=1)
        score = np.clip(likeness[np.arange(len(best)), best].astype(np.float64), 0.0, 1.0)
        named = [self.languages[b] if h else "und" for b, h in zip(best.tolist(), has.tolist())]
        return named, np.where(has, score, 0.0)


def fit(
    labelled: DataFrame,
    text: str = "text",
    lang: str = "lang",
    key: str = "doc_id",
    cells: int = CELLS,
    sample: int = SAMPLE,
    centroids: int = CENTROIDS,
) -> Model:
    """Fit centroids to texts with a language; rows without one are left out.

    Document frequencies count all texts: each task adds its own up and sends
    one number per cell. The centroids of a language come from about ``sample``
    of its texts, chosen by a hash of key and text, clustered in one task per
    language; so only tables whose size does not depend on the data come to the
    driver (``cells`` numbers, and ``centroids`` times ``cells`` per language)."""
    rows = labelled.select(
        labelled[text].alias("text"), labelled[lang].alias("lang"), labelled[key].cast("string").alias("key")
    ).where("lang IS NOT NULL AND text IS NOT NULL")

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        in_texts, n = np.zeros(cells, np.int64), 0
        for piece in pieces(batches, "text", STEP_BYTES, STEP_ROWS):
            counts, has = vectors(*raw_text(piece.column("text")), cells)
            in_texts += (counts > 0).sum(axis=0)
            n += int(has.sum())
        yield pa.RecordBatch.from_pydict({"cell": np.arange(-1, cells), "n": np.append([n], in_texts)})

    got = map_arrow(rows.select("text"), frequencies, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    known = {r.cell: r.n for r in got.collect()}  # cells + 1 numbers
    in_texts = np.array([known.get(c, 0) for c in range(cells)], np.float64)
    idf = (np.log((1 + known.get(-1, 0)) / (1 + in_texts)) + 1).astype(np.float32)
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # languages
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((0, cells), np.float32), idf, cells)
    share = F.element_at(F.create_map(*[v for n in languages for v in (F.lit(n), F.lit(min(1.0, sample / sizes[n])))]), F.col("lang"))
    chance = F.pmod(F.xxhash64("key", "text"), F.lit(1_000_003)) / 1_000_003.0
    chosen = rows.where(chance < share).select("lang", "text")

    def cluster(group: pa.Table) -> pa.Table:
        parts = []
        for piece in pieces(group.select(["text"]).combine_chunks().to_batches(), "text", STEP_BYTES, STEP_ROWS):
            counts, has = vectors(*raw_text(piece.column("text")), cells)
            parts.append(weighted(counts, idf)[has])
        found = np.concatenate(parts)
        order = np.lexsort(found[:, :8].T)  # the same centroids in whichever order the rows come
        centres = spherical_kmeans(found[order], centroids) if len(found) else found
        name = group.column("lang")[0].as_py()
        return pa.table({"lang": pa.array([name] * len(centres), pa.string()), "centre": pa.array(list(centres), pa.list_(pa.float32()))})

    fitted = chosen.groupBy("lang").applyInArrow(cluster, "lang string, centre array<float>").toArrow()
    pairs = sorted(zip(fitted.column("lang").to_pylist(), fitted.column("centre").to_pylist()))
    centres = np.array([c for _, c in pairs], np.float32).reshape(len(pairs), cells)
    return Model([name for name, _ in pairs], centres, idf, cells)


def predict(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id", reject: float = REJECT, **more: Column) -> DataFrame:
    """id, lang_pred, score (cosine to the nearest centroid, 0 to 1), rejected
    (less than ``reject``) and the ``more`` columns of every row. Null text, and
    text without a letter, is 'und' with score 0 and rejected. Only the text is
    looked at. The model is of fixed size and is broadcast."""
    names = list(more)
    rows = docs.select(docs[key].alias("id"), docs[text].alias("text"), *[more[n].alias(n) for n in names])
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text", STEP_BYTES, STEP_ROWS):
            named, score = shipped.value.predict(*raw_text(piece.column("text")))
            yield pa.RecordBatch.from_arrays(
                [piece.column("id"), pa.array(named, pa.string()), pa.array(score), pa.array(score < reject)]
                + [piece.column(n) for n in names],
                ["id", "lang_pred", "score", "rejected", *names],
            )

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    extra = "".join(f", {n} {kinds[n]}" for n in names)
    return map_arrow(rows, of, f"id {kinds['id']}, lang_pred string, score double, rejected boolean{extra}")
