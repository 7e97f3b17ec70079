"""Sources mixed to target weights along a time-varying curriculum, with
DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from .tables import stored

#: No source is repeated more often than this.
CAP = 3
#: Documents whose order is found by one sort, about.
BUCKET_ROWS = 4096
#: The weights of the sources in order, repeating.
WEIGHTS = (5, 2, 1)
#: Over time a source's weight runs from the first to the second number times its
#: mean, in a straight line; the sources in order take turns.
SLOPES = ((1.5, 0.5), (0.5, 1.5), (1.0, 1.0))
# Fixed value: what a word is.
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    """Words between ASCII white space; none in null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def place(key: Column, text: Column) -> Column:
    """32 hex digits by which the documents of a source are put in order: by
    chance, but the same in every run. Only rows with equal key and text tie."""
    parts = F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit("/"), F.md5(F.coalesce(text, F.lit(""))))
    return F.md5(parts)


def turns(sources: DataFrame, weights=WEIGHTS, slopes=SLOPES) -> DataFrame:
    """source, knots: weight schedules given by the place of each source among
    all sources by code point, null last. Knots are (t, weight) with t from 0 to
    1, weights in between lie on straight lines."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1

    def pick(values, n):
        return F.element_at(F.array(*[F.lit(float(v)) for v in values]), (F.col("rank") % n + 1).cast("int"))

    weight = pick(weights, len(weights))
    begin, end = pick([a for a, _ in slopes], len(slopes)), pick([b for _, b in slopes], len(slopes))
    knots = F.array(
        F.struct(F.lit(0.0).alias("t"), (weight * begin).alias("weight")),
        F.struct(F.lit(1.0).alias("t"), (weight * end).alias("weight")),
    )
    return sources.withColumn("rank", rank).select("source", knots.alias("knots"))


def segments(knots: Column) -> Column:
    """The straight pieces of a schedule with the area before each of them."""
    pairs = F.transform(
        F.sequence(F.lit(1), F.size(knots) - 1),
        lambda k: F.struct(F.element_at(knots, k).alias("a"), F.element_at(knots, k + 1).alias("b")),
    )

    def area(p):
        return (p["b"]["t"] - p["a"]["t"]) * (p["a"]["weight"] + p["b"]["weight"]) / 2

    return F.transform(
        pairs,
        lambda p, i: F.struct(
            F.aggregate(F.slice(pairs, F.lit(1), i), F.lit(0.0), lambda sum_, q: sum_ + area(q)).alias("before"),
            area(p).alias("area"),
            p["a"]["t"].alias("t"),
            p["a"]["weight"].alias("weight"),
            ((p["b"]["weight"] - p["a"]["weight"]) / (p["b"]["t"] - p["a"]["t"])).alias("slope"),
        ),
    )


def moment(pieces: Column, demand: Column) -> Column:
    """The time at which the area under a schedule reaches ``demand``: the piece
    by its area before, then the root of a quadratic within it."""
    piece = F.element_at(F.filter(pieces, lambda p: (p["before"] <= demand) & (p["area"] > 0)), -1)
    rest = demand - piece["before"]
    speed = piece["weight"] + F.sqrt(
        F.greatest(piece["weight"] * piece["weight"] + F.lit(2.0) * piece["slope"] * rest, F.lit(0.0))
    )
    return piece["t"] + F.when(speed > 0, F.lit(2.0) * rest / speed).otherwise(F.lit(0.0))


def targets(sizes: DataFrame, schedules: DataFrame, cap: int = CAP) -> DataFrame:
    """source, source_size, target, pieces, area: words each source should give.

    The targets share the size of all sources by the areas under their schedules;
    none is above ``cap`` times its source's size, and what is cut off goes to
    the others by weight until none is above. That is water-filling: sources
    reach their limits in the order of limit over weight, so one running sum
    in that order gives the level at which all is shared out. Sources without
    a schedule or without area get nothing.
    """
    pieces = schedules.select(F.col("source").alias("of"), segments(F.col("knots")).alias("pieces"))
    area = F.aggregate("pieces", F.lit(0.0), lambda sum_, p: sum_ + p["area"])
    known = sizes.join(pieces, F.col("source").eqNullSafe(F.col("of")), "left").drop("of")
    known = known.withColumn("area", F.coalesce(area, F.lit(0.0)))
    takes_part = (F.col("area") > 0) & (F.col("source_size") > 0)
    total = F.sum("source_size").over(Window.partitionBy())
    limit = (F.col("source_size") * cap).cast("double")
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    filled = (
        known.withColumn("total", total.cast("double"))
        .withColumn("limit", F.when(takes_part, limit).otherwise(F.lit(0.0)))
        .withColumn("part", F.when(takes_part, F.col("area")).otherwise(F.lit(0.0)))
        .withColumn("ratio", F.when(takes_part, F.col("limit") / F.col("part")).otherwise(F.lit(0.0)))
        .withColumn("left", F.col("total") - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
        .withColumn(
            "parts",
            F.sum("part").over(Window.partitionBy()) - F.coalesce(F.sum("part").over(before), F.lit(0.0)),
        )
        .withColumn("level", F.max(F.when(F.col("part") > 0, F.col("left") / F.col("parts"))).over(Window.partitionBy()))
    )
    target = F.coalesce(F.least(F.col("limit"), F.col("level") * F.col("part")), F.lit(0.0))
    return filled.select("source", "source_size", target.alias("target"), "pieces", "area")


def mix(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    source: str = "source",
    schedules=turns,
    cap: int = CAP,
    carry: bool = False,
) -> DataFrame:
    """One row per document: id, source, size (words), source_size, target (of
    its source), taken (words the mix takes of it, repeats counted), positions (times
    from 0 to 1 at which the first word of each of its copies is due, rising; null if
    it gives none), position (the first of them), before (words of its source that
    come earlier in a pass) and place. The rows are not sorted; ``training_order`` and
    the query do that. With ``carry`` all columns of the documents come along, in the
    column ``doc``.

    ``schedules`` gives source and knots for a frame of sources. A source's
    documents are in the order of ``place``. The mix takes the source over and
    over until its target is reached, and of the last document the words that
    are still missing; so the words taken of a source are its target to the word.

    Running sums are found in two steps, sums of buckets and sums within a
    bucket, so no source has to fit into a task. Null text has no words, null is
    a source of its own, a null key is a key like any other; rows with equal key
    and text get neighbouring places. No documents give no rows.
    """
    measures = [docs[source].alias("source"), n_words(docs[text]).alias("size"), place(docs[key], docs[text]).alias("place")]
    light = stored(docs.select(docs[key].alias("id"), *measures), "sizes")
    digits = max(1, math.ceil(math.log(max(1, light.count() / BUCKET_ROWS), 16)))
    bucket = F.substring("place", 1, digits).alias("bucket")
    sums = stored(light.groupBy("source", bucket).agg(F.sum("size").alias("words")), "buckets")
    sizes = sums.groupBy("source").agg(F.sum("words").alias("source_size"))
    aims = targets(sizes, schedules(sizes.select("source")), cap)
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("earlier", F.coalesce(F.sum("words").over(earlier), F.lit(0))).drop("words")
    offsets = offsets.join(aims.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    offsets = offsets.withColumnsRenamed({"source": "of_source", "bucket": "of_bucket"})
    rows = light
    if carry:
        rows = docs.select(docs[key].alias("id"), *measures, F.struct(*[docs[c] for c in docs.columns]).alias("doc"))
    rows = rows.withColumn("bucket", bucket)
    same = (F.col("bucket") == F.col("of_bucket")) & F.col("source").eqNullSafe(F.col("of_source"))
    inside = Window.partitionBy("source", "bucket").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(offsets, same)
    before = F.col("earlier") + F.col("within")
    words = F.round("target").cast("bigint")
    passes = F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size"))).otherwise(F.lit(0))
    placed = placed.withColumn("before", before).withColumn("passes", passes.cast("bigint"))
    rest = words - F.col("passes") * F.col("source_size")
    last = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before")))
    taken = F.col("passes") * F.col("size") + last
    placed = placed.withColumn("taken", taken.cast("bigint"))
    copies = F.ceil(F.col("taken") / F.greatest("size", F.lit(1))).cast("int")
    due = F.transform(
        F.sequence(F.lit(0), copies - 1),
        lambda k: _due(F.least(F.col("before") + k * F.col("source_size"), F.col("target"))),
    )
    placed = placed.withColumn("positions", F.when(F.col("taken") > 0, due))
    return placed.select(
        "id",
        "source",
        "size",
        "source_size",
        "target",
        "taken",
        "positions",
        F.get("positions", F.lit(0)).alias("position"),
        "before",
        "place",
        *(["doc"] if carry else []),
    )


def _due(words: Column) -> Column:
    """The time, from 0 to 1, at which a source has given so many words."""
    return moment(F.col("pieces"), words.cast("double") / F.col("target") * F.col("area"))


def training_order(
    docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source", **options
) -> DataFrame:
    """The documents of the mix with all their columns, as often as they are
    taken, range-sorted by the time at which they are due, those due at one time by
    ``place``. A document of which the mix takes only some words more comes whole
    once more. What is written of the frame as it is has this order from file to
    file and within files (``tokens.written_order`` reads it back). Nulls, empty texts,
    repeated rows and empty tables are as in ``mix``; a document without words is
    never taken."""
    plan = mix(docs, text, key, source, carry=True, **options).where("taken > 0")
    copies = plan.select(F.explode("positions").alias("due"), "place", "doc")
    return copies.orderBy("due", "place").select("doc.*")
