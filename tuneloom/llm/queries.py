"""The queries of this subpackage over the test tables, and the SQL of those
that SQL can express. Each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import arc, curriculum, decontaminate, fuzzylines, hosts, languages, neardup, prefixes, rules, separators, spelling, tokens, topk
from .tables import stored

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def byte_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


# -- SQL that several queries share ------------------------------------------

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACED = r"'[^\x20\x09-\x0D]+'"


def lowered(c: str) -> str:
    return f"translate({c}, '{UPPER}', '{LOWER}')"


def words(c: str) -> str:
    return f"regexp_extract_all(coalesce({c}, ''), {SPACED})"


#: The table of crc32 with the reflected polynomial 0xEDB88320, as column tab.
CRC_TABLE = """(SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda a, z: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS tab)"""


def crc32(c: str) -> str:
    """The unsigned crc32 of a text in UTF-8, next to CRC_TABLE."""
    octets = f"""list_transform(range(octet_length(encode({c}))),
      lambda i: ('0x' || substr(hex(encode({c})), (2 * i + 1)::INT, 2))::BIGINT)"""
    step = "lambda a, b: xor(a >> 8, tab[((xor(a, b) & 255) + 1)::INT])"
    return f"xor(list_reduce(list_prepend(4294967295, {octets}), {step}), 4294967295)"


# -- benchmark decontamination -------------------------------------------------

ITEM_WORDS = r"'[0-9a-z\x{80}-\x{10FFFF}]+'"


@query(f"""
  WITH d AS (SELECT doc_id, regexp_extract_all({lowered("coalesce(text, '')")}, {ITEM_WORDS}) AS w FROM documents),
  b AS (SELECT item_id, regexp_extract_all({lowered("coalesce(text, '')")}, {ITEM_WORDS}) AS w FROM benchmark),
  bw AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n,
      array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS win
    FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS i FROM b WHERE len(w) > 0)),
  dw AS (
    SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS win
    FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i
          FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
  hit AS (SELECT dw.doc_id, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON bw.n = dw.n AND bw.win = dw.win),
  covered AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hit))
    GROUP BY doc_id),
  named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id)
  SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
    coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
  FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)""")
def op1_decontaminate(spark, d):
    """1: documents that share a window with a benchmark item."""
    found = decontaminate.find_overlap(
        table(spark, d, "documents").select("doc_id", "text"), table(spark, d, "benchmark")
    )
    ids = F.array_sort(F.array_distinct(F.transform("found.items", lambda i: i["item_id"])))
    return found.withColumn("ids", ids).select(
        "doc_id",
        F.col("found.n_words").alias("n_words"),
        F.col("found.n_hit").alias("n_hit"),
        F.size("ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("ids", ","), 256).alias("items_sha256"),
        (F.col("found.n_hit") > 0).alias("contaminated"),
    )


# -- mixing sources to target weights -------------------------------------------

#: When the first, second and third copy of a document are due; there are no more.
DUE = ("due", "due_2", "due_3")
assert len(DUE) == curriculum.CAP


@query(f"""
  WITH d AS (
    SELECT doc_id, source, len({words("text")})::BIGINT AS size,
      md5(concat(coalesce(doc_id::VARCHAR, ''), '/', md5(coalesce(text, '')))) AS place
    FROM documents),
  s AS (
    SELECT source, sum(size)::BIGINT AS source_size,
      row_number() OVER (ORDER BY source NULLS LAST) - 1 AS k FROM d GROUP BY source),
  w AS (
    SELECT source, source_size, [5.0, 2.0, 1.0][(k % 3 + 1)::INT]::DOUBLE AS weight,
      [1.5, 0.5, 1.0][(k % 3 + 1)::INT]::DOUBLE AS a, [0.5, 1.5, 1.0][(k % 3 + 1)::INT]::DOUBLE AS b FROM s),
  v AS (
    SELECT *, weight * a AS w0, weight * b AS w1, source_size > 0 AS part,
      (source_size * 3)::DOUBLE AS lim FROM w),
  l AS (
    SELECT *, (sum(source_size) OVER ())::DOUBLE - coalesce(sum(CASE WHEN part THEN lim ELSE 0 END) OVER o, 0) AS rest,
      sum(CASE WHEN part THEN weight ELSE 0 END) OVER ()
        - coalesce(sum(CASE WHEN part THEN weight ELSE 0 END) OVER o, 0) AS parts
    FROM v WINDOW o AS (ORDER BY CASE WHEN part THEN lim / weight ELSE 0 END, source NULLS LAST
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
  m AS (SELECT *, max(CASE WHEN part THEN rest / parts END) OVER () AS level FROM l),
  t AS (SELECT *, CASE WHEN part THEN least(lim, level * weight) ELSE 0 END AS target FROM m),
  c AS (
    SELECT d.doc_id, d.size, t.*, coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.place
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM d JOIN t ON t.source IS NOT DISTINCT FROM d.source),
  k AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(round(target) / source_size) ELSE 0 END::BIGINT AS passes FROM c),
  x AS (
    SELECT *, (passes * size + greatest(0, least(size, round(target)::BIGINT - passes * source_size - before)))::BIGINT AS taken,
      {", ".join(f"least((before + {k} * source_size)::DOUBLE, target) / target * ((w0 + w1) / 2) AS q{k}" for k in range(3))}
    FROM k)
  SELECT doc_id, size, source_size, target::DOUBLE AS target, taken, {", ".join(
      f"""CASE WHEN taken > {k} * size
        THEN 2.0::DOUBLE * q{k} / (w0 + sqrt(greatest(w0 * w0 + 2.0::DOUBLE * (w1 - w0) * q{k}, 0.0::DOUBLE))) END AS {name}"""
      for k, name in enumerate(DUE))}
  FROM x""")
def op2_curriculum(spark, d):
    """2: words taken of each document and when in the training its copies are due;
    rows range-sorted by the time of the first, those of which nothing is taken last."""
    due = [F.get("positions", F.lit(k)).alias(name) for k, name in enumerate(DUE)]
    mixed = curriculum.mix(table(spark, d, "documents"))
    rows = mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", *due)
    return rows.orderBy(F.col("due").asc_nulls_last(), "doc_id")


# -- token ids --------------------------------------------------------------------


@query()
def op3_token_files(spark, d):
    """3: token files written and read again."""
    read = tokens.read_tokens(tokens.token_files(table(spark, d, "documents"), byte_bpe()))
    return read.withColumnRenamed("id", "doc_id")


# -- quality rules ------------------------------------------------------------------


@query(f"""
  WITH d AS (
    SELECT doc_id, source, coalesce(text, '') AS text, md5(coalesce(text, '')) AS content,
      {words("text")} AS w FROM documents),
  win AS (
    SELECT doc_id, i, list_slice(w, i, i + 4) AS g
    FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 4)) AS i FROM d WHERE len(w) >= 5)),
  twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1),
  rep AS (
    SELECT doc_id, count(DISTINCT p) AS n_repeat_words
    FROM (SELECT doc_id, unnest(generate_series(i, i + 4)) AS p FROM twice) GROUP BY doc_id),
  l AS (
    SELECT doc_id, source, content, n, line, {words("line")} AS lw
    FROM (SELECT doc_id, source, content, len(w) AS n, unnest(string_split(text, chr(10))) AS line FROM d)),
  dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM l WHERE len(lw) > 0 GROUP BY doc_id),
  f AS (
    SELECT source, content, min(doc_id) AS doc_id, any_value(n) AS n, norm, any_value(words) AS words
    FROM (SELECT doc_id, source, content, n, sum(len(lw)) AS words,
            regexp_replace({lowered("array_to_string(lw, ' ')")}, '[0-9]', '0', 'g') AS norm
          FROM l WHERE len(lw) > 0 GROUP BY ALL)
    GROUP BY source, content, norm),
  o AS (SELECT source, norm, count(*) AS n_texts, arg_min(content, doc_id) AS keeper FROM f GROUP BY source, norm),
  bad AS (SELECT source, norm, keeper FROM o WHERE n_texts > {rules.LINE_TEXTS}),
  gone AS (
    SELECT f.source, f.content, sum(f.words) AS words, max(f.n) AS n
    FROM f JOIN bad ON bad.norm = f.norm AND bad.source IS NOT DISTINCT FROM f.source
    WHERE f.content <> bad.keeper GROUP BY ALL),
  x AS (
    SELECT d.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
      (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols,
      coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
      coalesce(g.n - g.words < {rules.LEFT_WORDS} AND 3 * (g.n - g.words) < g.n, FALSE) AS depleted
    FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id)
      LEFT JOIN gone g ON g.content = d.content AND g.source IS NOT DISTINCT FROM d.source),
  y AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM x)
  SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND NOT depleted AS kept
  FROM y""")
def op7_quality_rules(spark, d):
    """7: base counts, and whether a document survives its host's frequent lines."""
    judged = rules.verdicts(table(spark, d, "documents"))
    return judged.select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


# -- SimHash near-dedup ----------------------------------------------------------------


@query()
def op9_simhash(spark, d):
    """9: fingerprints and the groups that they form."""
    prints = neardup.fingerprints(table(spark, d, "documents"))
    return neardup.groups(prints).select(
        F.col("id").alias("doc_id"), neardup.as_hex(F.col("fingerprint")).alias("fingerprint"), "component_id"
    )


# -- token counts -----------------------------------------------------------------------


@query()
def op4_token_counts(spark, d):
    """4: ids of each document, counted in flat files without an index."""
    counts = separators.token_counts(table(spark, d, "documents"), byte_bpe())
    return counts.withColumnRenamed("id", "doc_id")


# -- language ----------------------------------------------------------------------------


@query()
def op5_language(spark, d):
    """5: the language of each document, learned from four fifths of them."""
    docs = table(spark, d, "documents").select("doc_id", "text", "lang")
    fifth = F.crc32(F.col("doc_id").cast("string")) % 5
    model = languages.fit(docs.where(fifth != 0))
    held_out = F.coalesce(fifth == 0, F.lit(False))
    return languages.predict(docs, model, held_out=held_out).withColumnRenamed("id", "doc_id")


# -- URL rules ------------------------------------------------------------------------------

RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]


@query()
def op6_url_rules(spark, d):
    """6: rules for URLs, and the trust of hosts where no rule fits."""
    return hosts.judge_pages(table(spark, d, "pages"), RULES).withColumnRenamed("key", "page_id")


# -- fuzzy lines ------------------------------------------------------------------------------


@query()
def op8_fuzzy_lines(spark, d):
    """8: lines of each document that repeat another one, or nearly."""
    report = fuzzylines.line_report(table(spark, d, "documents"), unit="letters")
    return report.select(
        F.col("id").alias("doc_id"), "n_lines", "n_removed", F.array_join("removed", ",").alias("removed")
    )


# -- archives -----------------------------------------------------------------------------------


@query("""
  WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS n, sha256(coalesce(html, '')) AS h FROM pages),
  f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS least FROM p)
  SELECT page_id, n AS payload_bytes, h AS payload_digest,
    CASE WHEN n >= 100 AND page_id <> least THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN n >= 100 AND page_id <> least THEN least END AS refers_to
  FROM f""")
def op10_archives(spark, d):
    """10: pages in legacy archives, converted, and read back."""
    archives = stored(arc.to_archives(table(spark, d, "pages")), "arc")
    return arc.converted(archives).withColumnRenamed("key", "page_id")


# -- spelling variants --------------------------------------------------------------------------


@query(f"""
  WITH RECURSIVE t AS (
    SELECT coalesce(doc_id::VARCHAR, '') AS key, run, count(*) AS n
    FROM (SELECT doc_id, unnest(regexp_extract_all({lowered("coalesce(text, '')")}, '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS run
          FROM documents)
    WHERE length(run) >= 6 GROUP BY ALL),
  h AS (SELECT run, n, {crc32("concat(key, ':', run)")} AS h FROM t, {CRC_TABLE}),
  w AS (
    SELECT CASE WHEN h % 199 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run) + 2)::INT)
      ELSE run END AS word, n FROM h),
  v AS (SELECT word, sum(n)::BIGINT AS n FROM w WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
  e AS (
    SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS less
    FROM (SELECT word, n, unnest(range(1, length(word) + 1))::INT AS i FROM v)),
  p AS (
    SELECT a.word, b.word AS near, b.n FROM e a JOIN e b ON a.i = b.i AND a.less = b.less AND a.word <> b.word
      AND length(a.word) = length(b.word)
    UNION SELECT e.word, v.word, v.n FROM e JOIN v ON e.less = v.word
    UNION SELECT v.word, e.word, e.n FROM e JOIN v ON e.less = v.word),
  b AS (SELECT word, count(*) AS n_near, max(n) AS best FROM p GROUP BY word),
  f AS (
    SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN best >= 5 * v.n THEN best END AS form_n,
      CASE WHEN best >= 5 * v.n THEN (SELECT min(near) FROM p WHERE p.word = v.word AND p.n = b.best) END AS form
    FROM v LEFT JOIN b USING (word)),
  r AS (
    SELECT word, form, word AS root, form AS next FROM f
    UNION ALL SELECT r.word, r.form, f.word, f.form FROM r JOIN f ON f.word = r.next)
  SELECT f.word, n, n_near::BIGINT AS n_near, f.form, form_n, r.root
  FROM f JOIN r ON r.word = f.word AND r.next IS NULL""")
def op11_spelling(spark, d):
    """11: words, the words one letter away, and the form each is a variant of."""
    return spelling.variants(table(spark, d, "documents"))


# -- nearest vectors ------------------------------------------------------------------------------


@query("""
  WITH x AS (SELECT vec_id, list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
  s AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM x q JOIN x c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
  r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
  SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""")
def op12_nearest(spark, d):
    """12: the five nearest vectors of every fiftieth vector."""
    return topk.nearest(table(spark, d, "embeddings"), F.col("vec_id") % 50 == 0)


# -- prefixes of conversations ----------------------------------------------------------------------


@query(f"""
  WITH t AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
        PARTITION BY conv_id ORDER BY turn NULLS FIRST,
          md5(concat(octet_length(encode(coalesce(role, ''))), ':', coalesce(role, ''), coalesce(text, '')))) AS p
    FROM conversations WHERE conv_id IS NOT NULL),
  c AS (
    SELECT conv_id, {crc32("conv_id::VARCHAR")} % 9 AS h, conv_id - conv_id % 5 AS base
    FROM (SELECT DISTINCT conv_id FROM t), {CRC_TABLE}),
  r AS (
    SELECT c.conv_id, p, role, text FROM c JOIN t ON t.conv_id = c.base AND p <= h
    UNION ALL SELECT c.conv_id, p + 8, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND p > h),
  s AS (SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY p) AS said FROM r GROUP BY conv_id),
  l AS (SELECT conv_id, coalesce(said, []) AS said, len(coalesce(said, [])) AS n FROM c LEFT JOIN s USING (conv_id)),
  m AS (
    SELECT conv_id, n, d, octet_length(encode(said[d].text)) AS bytes, md5(to_json(said[1:d])::VARCHAR) AS node,
      CASE WHEN d > 0 THEN md5(to_json(said[1:d - 1])::VARCHAR) END AS parent
    FROM (SELECT *, unnest(generate_series(0, n)) AS d FROM l)),
  k AS (
    SELECT node, any_value(parent) AS parent, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
      (count(*) - 1) * coalesce(any_value(bytes), 0) AS saved,
      sha256(coalesce(string_agg(CASE WHEN d = n THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends_sha256
    FROM m GROUP BY node),
  f AS (
    SELECT k.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM k x WHERE x.parent = k.node) AS n_children
    FROM k LEFT JOIN k p ON p.node = k.parent),
  u AS (
    SELECT m.node, sum((f.n_children = 0)::INT) AS n_leaves, sum(f.saved) AS saved_tokens
    FROM f JOIN m ON m.conv_id = f.conv_id AND m.d <= f.depth GROUP BY m.node)
  SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves::BIGINT AS n_leaves,
    saved_tokens::BIGINT AS saved_tokens, ends_sha256
  FROM f JOIN u USING (node)""")
def op13_prefix_trie(spark, d):
    """13: the beginnings that rebuilt conversations share."""
    return prefixes.trie(table(spark, d, "conversations"))
