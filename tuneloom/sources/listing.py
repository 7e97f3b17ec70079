"""File listings and the choice of the file to load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.text import extension
from .readers import FORMATS

# Earlier words are preferred.
FILE_PREFERENCE = ["full", "train", "all"]


def list_files(spark: SparkSession, root: str, repo: str | None = None) -> DataFrame:
    """repo, path, position for the files below ``<root>/<repo>/``, of all repos
    or of one. Contents are not read."""
    uri = root.rstrip("/")
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    files = reader.load(f"{uri}/{repo}" if repo else uri).select("path")
    inside = F.regexp_extract("path", r"\Q" + uri.split("://")[-1] + r"\E/+(.*)$", 1)
    return files.select(
        F.substring_index(inside, "/", 1).alias("repo"),
        F.regexp_replace(inside, r"^[^/]*/", "").alias("path"),
    ).withColumn("position", F.col("path"))


def is_loadable(path: Column) -> Column:
    return extension(path).isin(list(FORMATS)) & ~path.startswith(".")


def preference(path: Column) -> Column:
    """Place of the first preferred word the path contains; the number of words if none."""
    lower = F.lower(path)
    out = F.when(F.lit(False), F.lit(0))
    for rank, word in enumerate(FILE_PREFERENCE):
        out = out.when(F.contains(lower, F.lit(word)), F.lit(rank))
    return out.otherwise(F.lit(len(FILE_PREFERENCE)))


def pick_files(listing: DataFrame, by: str = "repo") -> DataFrame:
    """The file to load per repo: best preference, then first in the listing.
    A min over structs, so partial results are merged and no listing is sorted.
    A repo without loadable files has a null path."""
    loadable = is_loadable(F.col("path"))
    best = F.min(F.when(loadable, F.struct(preference(F.col("path")).alias("r"), "position", "path")))
    picked = listing.groupBy(by).agg(best.alias("best"), F.count_if(loadable).alias("n_candidates"))
    return picked.select(by, F.col("best.path").alias("path"), "n_candidates")
