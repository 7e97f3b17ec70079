"""URL rules, and trust that spreads over links between hosts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .tables import LOWER, stored

#: Share of a host's trust that it hands on over its links.
DAMPING = 0.85
#: The propagation ends when less than this much of the mass moves. What moves
#: shrinks by DAMPING a round, so about 90 are enough; more than ROUNDS are an error.
TOLERANCE = 1e-6
ROUNDS = 120
#: A host is blocked if more than this share of its trust and distrust is distrust.
THRESHOLD = 0.75
#: Significant digits to which ranks are rounded, so that the order of additions doesn't show.
DIGITS = 12
#: Ranks under this are not rounded, since a power of ten that scales them up may not exist.
LEAST_ROUNDED = 1e-280

_UPPER = "".join(map(chr, range(65, 91)))
_HREF = r"""(?i)\shref\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s<>]+)"""


def _lower(c: Column) -> Column:
    return F.translate(c, _UPPER, _UPPER.lower())


def host_of(url: Column) -> Column:
    """What stands between the first :// and the next / ? or #, A-Z lower-cased;
    empty for null and for text without ://."""
    return _lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to ? or #."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """struct(rule, verdict) of the longest rule that fits, or null. A rule is a
    verdict and a text 'host/path': it fits its host and all subdomains if the
    path begins with its own. Of equally long ones the last by code point counts."""
    if not rules:
        return F.lit(None).cast("struct<length: int, rule: string, verdict: string>")
    known = F.array(
        *[
            F.struct(
                F.lit(len(rule)).alias("length"),
                F.lit(rule).alias("rule"),
                F.lit(verdict).alias("verdict"),
                F.lit(rule.split("/", 1)[0].translate(LOWER.decode("latin-1"))).alias("host"),
                F.lit("/" + rule.split("/", 1)[1]).alias("path"),
            )
            for verdict, rule in rules
        ]
    )

    def fits(r: Column) -> Column:
        below = host.endswith(F.concat(F.lit("."), r["host"]))
        return ((host == r["host"]) | below) & path.startswith(r["path"])

    return F.array_max(
        F.transform(
            F.filter(known, fits),
            lambda r: F.struct(r["length"].alias("length"), r["rule"].alias("rule"), r["verdict"].alias("verdict")),
        )
    )


def bare(host: Column) -> Column:
    """A host without user and port, under which it is known in the graph."""
    return F.regexp_replace(F.regexp_replace(host, "^[^@]*@", ""), ":[0-9]*$", "")


def host_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """src, dst: the different links from one host to another one in the pages,
    both without user and port."""
    found = pages.select(
        bare(host_of(pages[url])).alias("src"),
        F.explode(F.array_distinct(F.regexp_extract_all(pages[html], F.lit(_HREF), 1))).alias("to"),
    )
    return found.select("src", bare(_lower(F.col("to"))).alias("dst")).where("src <> '' AND dst <> '' AND src <> dst").distinct()


def _rounded(rank: Column) -> Column:
    """To DIGITS digits from the first one that is not 0, however small it is."""
    scale = F.pow(F.lit(10.0), F.lit(DIGITS - 1.0) - F.floor(F.log10(rank)))
    return F.when(rank > LEAST_ROUNDED, F.rint(rank * scale) / scale).otherwise(rank)


def propagate(seeds: DataFrame, links: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """host, trust, distrust: two personalised PageRanks. ``seeds`` has host,
    trusted and blocked (weights, 0 or more) for every host.

    Trust starts at trusted hosts and follows the links; distrust starts at
    blocked hosts and goes against them, to those who link there. What a host
    without links would hand on returns to the seeds. Each sums up to 1, or is 0
    where there are no seeds. If ``rounds`` are not enough for TOLERANCE it is an
    error. A round is one join on the giving host and one sum
    by the receiving host, aggregated before the shuffle, and is written to the
    shared folder; only the mass that moved comes to the driver.
    """
    ways = links.select(F.lit("trust").alias("kind"), F.col("src").alias("from"), F.col("dst").alias("to")).union(
        links.select(F.lit("distrust").alias("kind"), F.col("dst").alias("from"), F.col("src").alias("to"))
    )
    fan = ways.groupBy("kind", "from").agg(F.count("*").alias("fan"))
    # how a share is divided is kept with each way, so a round needs no second join
    ways = stored(ways.join(fan, ["kind", "from"]), "ways")
    hosts = seeds.select("host", "trusted", "blocked").union(
        links.select("src", F.lit(0.0), F.lit(0.0)).union(links.select("dst", F.lit(0.0), F.lit(0.0)))
    )
    hosts = hosts.groupBy("host").agg(F.sum("trusted").alias("trusted"), F.sum("blocked").alias("blocked"))
    base = hosts.select(
        "host",
        F.explode(
            F.array(
                F.struct(F.lit("trust").alias("kind"), F.col("trusted").alias("weight")),
                F.struct(F.lit("distrust").alias("kind"), F.col("blocked").alias("weight")),
            )
        ).alias("s"),
    ).select("s.kind", "host", "s.weight")
    total = base.groupBy("kind").agg(F.sum("weight").alias("total"))
    givers = fan.select("kind", F.col("from").alias("host"), F.lit(True).alias("gives"))
    base = base.join(F.broadcast(total), "kind").join(givers, ["kind", "host"], "left")  # total: two rows
    start = F.when(F.col("total") > 0, _rounded(F.col("weight") / F.col("total"))).otherwise(F.lit(0.0))
    now = stored(base.select("kind", "host", start.alias("seed"), "gives", start.alias("rank")), "ranks")
    if ways.isEmpty():
        return _wide(now)
    for _ in range(rounds):
        given = now.join(ways, (now["kind"] == ways["kind"]) & (now["host"] == ways["from"])).select(
            ways["kind"].alias("k"), ways["to"].alias("h"), (F.col("rank") / F.col("fan")).alias("share")
        )
        got = given.groupBy("k", "h").agg(F.sum("share").alias("got"))
        kept = {r.kind: r.kept for r in now.groupBy("kind").agg(F.sum(F.expr("IF(gives, 0, rank)")).alias("kept")).collect()}
        back = F.when(F.col("kind") == "trust", F.lit(kept["trust"])).otherwise(F.lit(kept["distrust"]))
        moved = now.join(got, (F.col("kind") == F.col("k")) & (F.col("host") == F.col("h")), "left")
        rank = (1 - DAMPING) * F.col("seed") + DAMPING * (F.coalesce("got", F.lit(0.0)) + back * F.col("seed"))
        new = stored(
            moved.select("kind", "host", "seed", "gives", _rounded(rank).alias("rank"), F.col("rank").alias("old")),
            "ranks",
        )
        change = new.agg(F.sum(F.abs(F.col("rank") - F.col("old")))).first()[0]
        now = new.drop("old")
        if change < TOLERANCE:
            return _wide(now)
    raise RuntimeError(f"{change} of the mass still moves after {rounds} rounds, more than {TOLERANCE}")


def _wide(ranks: DataFrame) -> DataFrame:
    def of(kind: str) -> Column:
        return F.sum(F.when(F.col("kind") == kind, F.col("rank")).otherwise(F.lit(0.0))).alias(kind)

    return ranks.groupBy("host").agg(of("trust"), of("distrust"))


def judge_pages(
    pages: DataFrame,
    rules: list[tuple[str, str]],
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """key, host, path, rule, verdict, and the host's trust and distrust, of every row.

    Pages that a rule fits have its verdict and are the seeds: a host's weight is
    its number of allowed, or blocked, pages. For the others their host (without
    user and port, which are left in the output) decides:
    block if distrust is more than ``threshold`` of trust and distrust together,
    else allow, so hosts of which nothing is known are allowed. ``rules`` is a
    list of settings, not data. Null or broken URLs have an empty host, which
    neither links nor spreads anything; null html has no links."""
    rule = fitting_rule(F.col("host"), F.col("path"), rules)
    judged = pages.select(pages[key].alias("key"), host_of(pages[url]).alias("host"), path_of(pages[url]).alias("path"))
    judged = judged.withColumn("fit", rule).withColumn("node", bare(F.col("host")))
    counted = judged.groupBy(F.col("node").alias("host")).agg(
        F.count(F.when(F.col("fit.verdict") == "allow", 1)).cast("double").alias("trusted"),
        F.count(F.when(F.col("fit.verdict") == "block", 1)).cast("double").alias("blocked"),
    )
    # several steps start from the links, which are found by reading all html
    links = stored(host_links(pages, url, html), "links")
    ranks = propagate(counted, links).withColumnRenamed("host", "of")
    both = F.col("trust") + F.col("distrust")
    bad = (both > 0) & (F.col("distrust") > threshold * both)
    by_host = F.when(bad, F.lit("block")).otherwise(F.lit("allow"))
    named = judged.join(ranks, F.col("node") == F.col("of"), "left")
    return named.select(
        "key",
        "host",
        "path",
        F.col("fit.rule").alias("rule"),
        F.coalesce(F.col("fit.verdict"), by_host).alias("verdict"),
        "trust",
        "distrust",
    )
