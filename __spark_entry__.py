"""Queries over the test tables, each with the SQL that gives the same result.

``queries()`` and ``oracle_sql()`` are filled by the ``query`` decorator below.
"""

from __future__ import annotations

import os
import sys
import tempfile
import uuid
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession, functions as F  # noqa: E402

from tuneloom.functions import jsontext, messages, text  # noqa: E402
from tuneloom.functions.pii import PII_PATTERNS  # noqa: E402
from tuneloom.functions.text import PY_WHITESPACE_CLASS, is_string  # noqa: E402
from tuneloom.operators import deliver as out  # noqa: E402
from tuneloom.operators import generate as gen  # noqa: E402
from tuneloom.operators import ledger as led  # noqa: E402
from tuneloom.operators import quality as qual  # noqa: E402
from tuneloom.operators import select as sel  # noqa: E402
from tuneloom.operators.contracts import contract_report, union_cells  # noqa: E402
from tuneloom.plans import recipes as rec  # noqa: E402
from tuneloom.sources import archives, listing, readers, registry, storage  # noqa: E402
from tuneloom.streaming import arrivals  # noqa: E402

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLE: dict[str, str] = {}

NOW = "2024-01-01T00:00:00+00:00"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        _QUERIES[fn.__name__] = fn
        if sql is not None:
            _ORACLE[fn.__name__] = sql
        return fn

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)


def entry(spark: SparkSession) -> DataFrame:
    """Question/answer pairs → whitelist → blank rows out → sample → report."""
    return report_long(spark, "/root/testdata/sf0.001")


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return readers.read_dataset(spark, d, name)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder of spark.checkpoint.dir, which all executors see;
    only a local session may do without that setting."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
        base = tempfile.mkdtemp(prefix="tuneloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/tuneloom/{uuid.uuid4().hex}/{name}"


# -- inputs derived from the tables ----------------------------------------

#: Text that one file of a table written in several files holds, on the average.
PART_BYTES = 64 << 20


def write_parts(df: DataFrame, path: str, least: int = 3) -> int:
    """The rows as parquet in ``least`` files, more if these would hold over
    PART_BYTES of text each; returns how many. No task reads more than a file's rows."""
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema if is_string(f.dataType)]
    size = df.agg(F.sum(sum(texts, F.lit(0)).cast("long"))).first()[0] or 0
    parts = max(least, -(-size // PART_BYTES))
    df.repartition(parts).write.parquet(path)
    return parts


WS = f"[{PY_WHITESPACE_CLASS}]"


def sql_strip(c: str) -> str:
    return f"regexp_replace(regexp_replace({c}, '^{WS}+', ''), '{WS}+$', '')"


def sql_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_fill(template: str, **values: str) -> str:
    """concat(...) that fills a template the way fill_template does."""
    import string

    parts = []
    for literal, name, _, _ in string.Formatter().parse(template):
        if literal:
            parts.append(sql_text(literal))
        if name is not None:
            parts.append(values[name])
    return "concat(" + ", ".join(parts) + ")"


def pairs(spark: SparkSession, d: str) -> DataFrame:
    """Each user turn with the assistant turn that follows it, if any."""
    turns = table(spark, d, "conversations")
    asked = turns.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("instruction"))
    replied = turns.where("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("response")
    )
    return asked.join(replied, ["conv_id", "turn"], "left")


PAIRS = """
  SELECT u.conv_id, u.turn, u.text AS instruction, a.text AS response
  FROM conversations u LEFT JOIN conversations a
    ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
  WHERE u.role = 'user'"""


def labelled(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")


LABELLED = """
  SELECT d.*, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id"""

NBSP, IDEOGRAPHIC_SPACE, EM_SPACE = chr(0xA0), chr(0x3000), chr(0x2003)


def noted(spark: SparkSession, d: str) -> DataFrame:
    """Documents with a note that is null, blank (Unicode spaces only) or a text."""
    note = F.when(F.col("quality") == 0, F.lit(NBSP + IDEOGRAPHIC_SPACE + EM_SPACE)).when(
        F.col("quality") == 1, F.concat(F.lit(IDEOGRAPHIC_SPACE + " "), "source", F.lit(NBSP))
    )
    return labelled(spark, d).select("doc_id", "lang", "quality", note.alias("note"))


NOTED = f"""
  SELECT doc_id, lang, quality,
    CASE WHEN quality = 0 THEN chr(160) || chr(12288) || chr(8195)
         WHEN quality = 1 THEN chr(12288) || ' ' || source || chr(160) END AS note
  FROM ({LABELLED})"""


def replies(spark: SparkSession, d: str) -> DataFrame:
    """Replies of a model, in the shape its language gives them."""
    obj = F.concat(
        F.lit('{"instruction": "about '), "source", F.lit('", "response": "'),
        F.md5("text"), F.lit('", "n": 1}'),
    )
    raw = (
        F.when(F.col("lang") == "en", F.concat(F.lit("```json\n"), obj, F.lit("\n```  ")))
        .when(F.col("lang") == "fr", F.concat(F.lit(NBSP + " Instruction: "), "source", F.lit("\n")))
        .when(F.col("lang") == "de", F.concat(F.lit("  "), obj))
        .otherwise(F.concat(F.lit('{"instruction": "'), "source"))
    )
    return table(spark, d, "documents").select("doc_id", raw.alias("raw"))


_OBJ = """'{"instruction": "about ' || source || '", "response": "' || md5(text) || '", "n": 1}'"""
REPLIES = f"""
  SELECT doc_id, CASE lang
    WHEN 'en' THEN '```json' || chr(10) || {_OBJ} || chr(10) || '```  '
    WHEN 'fr' THEN chr(160) || ' Instruction: ' || source || chr(10)
    WHEN 'de' THEN '  ' || {_OBJ}
    ELSE '{{"instruction": "' || source END AS raw
  FROM documents"""
UNFENCED = f"""
  SELECT doc_id, {sql_strip("rtrim(ltrim(" + sql_strip("raw") + ", '`json'), '`')")} AS clean
  FROM ({REPLIES})"""


def entries(spark: SparkSession, d: str) -> DataFrame:
    """One registry entry per customer."""
    balance = F.col("c_acctbal")
    status = (
        F.when(balance < 0, F.lit("complete"))
        .when(balance < 2000, F.lit(None))
        .when(balance < 5000, F.lit("ready"))
        .otherwise(F.lit("pending"))
    )
    segment = F.col("c_mktsegment")
    issues = (
        F.when(segment == "BUILDING", F.array(F.lit("zstd_compression"), F.lit("legacy_script")))
        .when(segment == "MACHINERY", F.array(F.lit("legacy_script")))
        .when(segment == "HOUSEHOLD", F.array().cast("array<string>"))
    )
    return table(spark, d, "customer").select(
        F.col("c_name").alias("id"),
        F.concat(F.lit("market/"), F.lower("c_mktsegment")).alias("repo"),
        (F.col("c_nationkey") * 100 + 55).alias("rows"),
        F.when(balance < 0, F.lit(0)).when(balance < 3000, F.lit(7)).alias("min_rows_output"),
        segment.alias("recipe_target"),
        F.concat(F.lit("Nation-"), "c_nationkey").alias("project"),
        status.alias("status"),
        issues.alias("known_issues"),
        F.concat(F.lit("org/"), F.lower(F.replace("c_name", F.lit("#"), F.lit("-")))).alias(
            "output_name"
        ),
        F.when(balance > 6000, F.lit("hosted")).alias("augmentation_llm"),
    )


ENTRIES = """
  SELECT c_name AS id, 'market/' || lower(c_mktsegment) AS repo, c_nationkey * 100 + 55 AS rows,
    CASE WHEN c_acctbal < 0 THEN 0 WHEN c_acctbal < 3000 THEN 7 END AS min_rows_output,
    c_mktsegment AS recipe_target, 'Nation-' || c_nationkey AS project,
    CASE WHEN c_acctbal < 0 THEN 'complete' WHEN c_acctbal < 2000 THEN NULL
         WHEN c_acctbal < 5000 THEN 'ready' ELSE 'pending' END AS status,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'zstd_compression, legacy_script'
         WHEN 'MACHINERY' THEN 'legacy_script' ELSE 'none' END AS issues,
    'org/' || lower(replace(c_name, '#', '-')) AS output_name,
    CASE WHEN c_acctbal > 6000 THEN 'hosted' END AS augmentation_llm
  FROM customer"""


def ledger(spark: SparkSession, d: str) -> DataFrame:
    """One ledger entry per customer with orders."""
    top, n = F.max("o_totalprice"), F.count(F.lit(1))
    name = F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"))
    last = F.date_format(F.max("o_orderdate"), "yyyy-MM-dd")
    return (
        table(spark, d, "orders")
        .groupBy(name.alias("dataset_id"))
        .agg(
            n.alias("rows_out"),
            F.when(top > 450000, F.lit(True)).when(top > 300000, F.lit(False)).alias("validation_passed"),
            F.when(n > 5, F.concat(last, F.lit("T00:00:00+00:00"))).alias("processed_at"),
            F.concat(F.lit("/data/"), F.max("o_orderkey")).alias("local_path"),
        )
    )


LEDGER = """
  SELECT 'Customer#' || lpad(o_custkey::VARCHAR, 9, '0') AS dataset_id, count(*) AS rows_out,
    CASE WHEN max(o_totalprice) > 450000 THEN true WHEN max(o_totalprice) > 300000 THEN false END
      AS validation_passed,
    CASE WHEN count(*) > 5 THEN strftime(max(o_orderdate), '%Y-%m-%d') || 'T00:00:00+00:00' END
      AS processed_at,
    '/data/' || max(o_orderkey) AS local_path
  FROM orders GROUP BY o_custkey"""


# -- sources ---------------------------------------------------------------


@query("SELECT doc_id, lang, source, n_chars, text FROM documents")
def source_scan(spark, d):
    """A named dataset."""
    return table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars", "text")


@query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def parquet_zstd(spark, d):
    """Zstd files read like any other."""
    path = scratch_path(spark, "zstd.parquet")
    table(spark, d, "documents").write.option("compression", "zstd").parquet(path)
    return readers.read_file(spark, path)


@query("SELECT doc_id, text, lang, quality FROM (" + LABELLED + ")")
def json_lines_scan(spark, d):
    """S3."""
    path = scratch_path(spark, "lines.jsonl")
    labelled(spark, d).select("doc_id", "text", "lang", "quality").write.json(path)
    return readers.read_file(spark, path, "doc_id long, text string, lang string, quality int")


@query("SELECT conv_id, turn, role, text FROM conversations")
def csv_scan(spark, d):
    """Quoted line breaks, quotes and commas."""
    path = scratch_path(spark, "turns.csv")
    _write_csv(table(spark, d, "conversations"), path, ",")
    return readers.read_file(spark, path, "conv_id long, turn long, role string, text string")


@query("SELECT page_id, url, html FROM pages")
def tsv_scan(spark, d):
    """S5."""
    path = scratch_path(spark, "pages.tsv")
    _write_csv(table(spark, d, "pages"), path, "\t")
    return readers.read_file(spark, path, "page_id long, url string, html string")


def _write_csv(df, path, sep):
    df.write.csv(
        path, header=True, sep=sep, quote='"', escape='"',
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )


@query("SELECT conv_id, turn, role, text FROM conversations")
def mixed_folder_scan(spark, d):
    """A folder with CSV, JSON lines, TSV and parquet files, some of them in folders of their own."""
    path = scratch_path(spark, "mixed")
    turns = table(spark, d, "conversations")
    _write_csv(turns.where("role = 'user' AND turn < 4"), path, ",")
    _write_csv(turns.where("role = 'user' AND turn >= 4"), f"{path}/later/tabs", "\t")
    for tabs in storage.matching_paths(spark, f"{path}/later/tabs/*.csv"):
        storage.promote(spark, tabs, tabs.replace(".csv", ".tsv"))
    turns.where("role = 'assistant' AND turn < 4").write.mode("append").json(path)
    turns.where("role = 'assistant' AND turn >= 4").write.mode("append").json(f"{path}/later")
    turns.where("role NOT IN ('user', 'assistant') OR turn IS NULL OR role IS NULL").write.parquet(f"{path}/other/deep")
    return readers.read_file(spark, path, "conv_id long, turn long, role string, text string")


@query("SELECT conv_id, turn, role, text FROM conversations")
def sharded_scan(spark, d):
    """A split in numbered files under data/."""
    base = scratch_path(spark, "root")
    parts = write_parts(table(spark, d, "conversations"), f"{base}/staged")
    for n, part in enumerate(storage.matching_paths(spark, f"{base}/staged/*.parquet")):
        storage.promote(spark, part, f"{base}/org/turns/data/train-{n:05d}-of-{parts:05d}.parquet")
    return readers.read_dataset(spark, base, "org/turns", "train")


@query("SELECT conv_id, turn, text FROM conversations WHERE role = 'user'")
def partitioned_scan(spark, d):
    """A split in a partition folder of JSON lines."""
    base = scratch_path(spark, "root")
    turns = table(spark, d, "conversations").withColumnRenamed("role", "split")
    turns.write.partitionBy("split").json(f"{base}/org/turns")
    return readers.read_dataset(spark, base, "org/turns", "user").select("conv_id", "turn", "text")


def _packed(df, columns):
    """The rows as .tgz archives, one per Arrow batch, each with a notes file
    and the rows in a CSV member."""

    def pack(batches):
        import csv
        import io
        import tarfile

        import pandas as pd

        for pdf in batches:
            text_io = io.StringIO(newline="")
            writer = csv.writer(text_io)
            writer.writerow(columns)
            writer.writerows(pdf[columns].itertuples(index=False))
            blob = io.BytesIO()
            with tarfile.open(fileobj=blob, mode="w:gz") as tar:
                for name, data in (("x/notes.txt", "hello"), ("x/part.trn.csv", text_io.getvalue())):
                    raw = data.encode()
                    info = tarfile.TarInfo(name)
                    info.size = len(raw)
                    tar.addfile(info, io.BytesIO(raw))
            path = f"batch-{pdf[columns[0]].iloc[0]}.tgz"
            yield pd.DataFrame({"path": [path], "content": [blob.getvalue()]})

    return df.select(columns).mapInPandas(pack, "path string, content binary")


@query("SELECT conv_id, turn, role, text, 'x/part.trn.csv' AS member FROM conversations")
def archive_rows(spark, d):
    """A CSV member out of .tgz archives."""
    turns = table(spark, d, "conversations")
    packed = _packed(turns, ["conv_id", "turn", "role", "text"])
    return archives.archive_records(packed, turns.schema, "part.trn.csv").drop("archive")


def _packed_as(df, columns, kind):
    """The rows as .tgz archives, one per Arrow batch, with a member of that kind."""

    def pack(batches):
        import io
        import tarfile

        for pdf in batches:
            if kind == "parquet":
                data = pdf.to_parquet(index=False)
            else:
                data = pdf.to_json(orient="records", lines=kind == "jsonl", force_ascii=False).encode()
            blob, info = io.BytesIO(), tarfile.TarInfo(f"x/part.{kind}")
            info.size = len(data)
            with tarfile.open(fileobj=blob, mode="w:gz") as tar:
                tar.addfile(info, io.BytesIO(data))
            yield pd.DataFrame({"path": [f"{kind}.tgz"], "content": [blob.getvalue()]})

    import pandas as pd

    return df.select(columns).mapInPandas(pack, "path string, content binary")


@query("""
  SELECT conv_id, turn, role, text, 'x/part.' || kind AS member
  FROM conversations, (VALUES ('json'), ('jsonl'), ('parquet')) AS k(kind)""")
def archive_members(spark, d):
    """JSON arrays, JSON lines and parquet out of .tgz archives."""
    turns = table(spark, d, "conversations")
    columns = ["conv_id", "turn", "role", "text"]
    json, lines, parquet = (_packed_as(turns, columns, kind) for kind in ("json", "jsonl", "parquet"))
    packed = json.union(lines).union(parquet)
    return archives.archive_records(packed, turns.schema).drop("archive")


@query("SELECT doc_id, lang, text FROM documents ORDER BY doc_id LIMIT 100")
def head_ordered(spark, d):
    """S10."""
    return sel.head(table(spark, d, "documents").select("doc_id", "lang", "text"), 100, ["doc_id"])


@query("SELECT least(count(*), 120)::BIGINT AS n, least(count(*), 120)::BIGINT AS n_known FROM documents")
def head_any(spark, d):
    """S10, ST1: any 120 rows, all of them real and none twice."""
    some = readers.read_head(spark, f"{d}/documents.parquet", 120).select("doc_id", "text")
    known = table(spark, d, "documents").select("doc_id", "text")
    return some.join(known.withColumn("known", F.lit(1)), ["doc_id", "text"], "left").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct(F.when(F.col("known") == 1, F.col("doc_id"))).alias("n_known")
    )


@query("""
  WITH l AS (
    SELECT p_brand AS repo, p_partkey AS position,
      CASE WHEN p_retailprice < 950 THEN '.' ELSE '' END || lower(p_type) || '/' ||
        CASE WHEN p_size < 4 THEN 'FULL-' WHEN p_size < 12 THEN 'Train-' WHEN p_size < 20 THEN 'all-'
             ELSE 'x-' END || replace(p_name, ' ', '-') ||
        CASE WHEN p_size = 49 THEN '.PARQUET' WHEN p_size > 40 THEN '.md' WHEN p_size > 30 THEN '.csv'
             WHEN p_size > 20 THEN '.JSONL' WHEN p_size > 5 THEN '.tsv' ELSE '.py' END AS path
    FROM part),
  c AS (
    SELECT *, CASE WHEN contains(lower(path), 'full') THEN 0 WHEN contains(lower(path), 'train') THEN 1
                   WHEN contains(lower(path), 'all') THEN 2 ELSE 3 END AS r
    FROM l WHERE NOT starts_with(path, '.')
      AND regexp_matches(lower(path), '\\.(jsonl|json|csv|tsv|parquet)$'))
  SELECT b.repo, p.path, coalesce(p.n, 0)::BIGINT AS n_candidates
  FROM (SELECT DISTINCT repo FROM l) b LEFT JOIN (
    SELECT repo, path, count(*) OVER (PARTITION BY repo) AS n,
      row_number() OVER (PARTITION BY repo ORDER BY r, position) AS k FROM c) p
  ON p.repo = b.repo AND p.k = 1""")
def pick_files(spark, d):
    """The file to load per repo, from a listing."""
    size = F.col("p_size")
    word = (
        F.when(size < 4, F.lit("FULL-")).when(size < 12, F.lit("Train-"))
        .when(size < 20, F.lit("all-")).otherwise(F.lit("x-"))
    )
    ext = (
        F.when(size == 49, F.lit(".PARQUET")).when(size > 40, F.lit(".md"))
        .when(size > 30, F.lit(".csv")).when(size > 20, F.lit(".JSONL"))
        .when(size > 5, F.lit(".tsv")).otherwise(F.lit(".py"))
    )
    hidden = F.when(F.col("p_retailprice") < 950, F.lit(".")).otherwise(F.lit(""))
    files = table(spark, d, "part").select(
        F.col("p_brand").alias("repo"),
        F.concat(
            hidden, F.lower("p_type"), F.lit("/"), word, F.replace("p_name", F.lit(" "), F.lit("-")), ext
        ).alias("path"),
        F.col("p_partkey").alias("position"),
    )
    return listing.pick_files(files)


_MESSAGE = """CASE event_type
      WHEN 'error' THEN 'HTTP 4' || lpad(user_id::VARCHAR, 2, '0') || ' for event ' || event_id
      WHEN 'click' THEN 'Dataset ' || user_id || ' DOESN''T EXIST'
      WHEN 'view' THEN 'Authentication needed by user ' || user_id
      WHEN 'signup' THEN 'Config name missing: pick a Subset of ' || props
      ELSE 'Unknown Split "' || event_type || '"' || CASE WHEN value > 20 THEN '.' ELSE ' timeout' END
    END"""


@query(f"""
  WITH m AS (SELECT event_id, {_MESSAGE} AS message FROM events),
  c AS (SELECT event_id, message, CASE
    WHEN contains(message, '404') OR contains(lower(message), 'doesn''t exist') THEN 'not_found'
    WHEN contains(message, '401') OR contains(message, '403')
      OR contains(lower(message), 'authentication') THEN 'auth'
    WHEN contains(lower(message), 'config') OR contains(lower(message), 'subset') THEN 'subset'
    WHEN contains(lower(message), 'split') THEN 'split' ELSE 'generic' END AS category FROM m)
  SELECT event_id, message, category, CASE category
    {" ".join(f"WHEN {sql_text(k)} THEN {sql_text(v)}" for k, v in messages.ERROR_HINTS.items())}
    END AS hint FROM c""")
def classify_errors(spark, d):
    """An error log sorted into categories."""
    log = table(spark, d, "events").select("event_id", F.expr(_MESSAGE.replace("''", "\\'").replace("::VARCHAR", "::STRING")).alias("message"))
    sorted_log = log.withColumn("category", messages.error_category(F.col("message")))
    return sorted_log.withColumn("hint", messages.error_hint(F.col("category")))


# -- selection -------------------------------------------------------------


@query("SELECT doc_id, text FROM documents")
def column_whitelist(spark, d):
    """P1."""
    return sel.keep_columns(table(spark, d, "documents"), ["text", "doc_id", "absent"])


@query(f"SELECT * FROM ({PAIRS}) WHERE response IS NOT NULL")
def drop_blank_pairs(spark, d):
    """User turns without a reply go."""
    return sel.drop_blank_rows(pairs(spark, d))


@query(f"SELECT doc_id, quality, toxic, text FROM ({LABELLED}) WHERE quality IS NOT NULL")
def drop_blank_labels(spark, d):
    """Nulls in non-string columns; zeros stay."""
    return sel.drop_blank_rows(labelled(spark, d).select("doc_id", "quality", "toxic", "text"))


@query(f"SELECT doc_id, lang, note FROM ({NOTED}) WHERE {sql_strip('note')} <> ''")
def drop_blank_unicode(spark, d):
    """Texts of Unicode spaces only are blank."""
    return sel.drop_blank_rows(noted(spark, d).select("doc_id", "lang", "note"))


@query(f"SELECT doc_id, {sql_strip('note')} AS stripped, length(note) AS n FROM ({NOTED})")
def strip_unicode(spark, d):
    """F1."""
    return noted(spark, d).select(
        "doc_id", text.strip(F.col("note")).alias("stripped"), F.length("note").cast("long").alias("n")
    )


_SAMPLE = "SELECT doc_id, lang, text FROM documents ORDER BY md5(concat('42:', doc_id)), doc_id LIMIT 150"


@query(_SAMPLE)
def sample_exact(spark, d):
    """P4, heap per task."""
    return sel.sample_exact(
        table(spark, d, "documents").select("doc_id", "lang", "text"), 150, 42, ["doc_id"], "topn"
    )


@query(_SAMPLE)
def sample_exact_cut(spark, d):
    """P4, by hash value: the plan for samples too large for one task."""
    return sel.sample_exact(
        table(spark, d, "documents").select("doc_id", "lang", "text"), 150, 42, ["doc_id"], "cut"
    )


@query("""
  SELECT l_returnflag, l_linestatus FROM lineitem
  ORDER BY md5(concat('7:{"l_returnflag":"', l_returnflag, '","l_linestatus":"', l_linestatus, '"}'))
  LIMIT 4321""")
def sample_copies(spark, d):
    """P4 without a key: six distinct rows, each with a great many copies."""
    flags = table(spark, d, "lineitem").select("l_returnflag", "l_linestatus")
    return sel.sample_exact(flags, 4321, 7, method="cut")


@query(f"""
  WITH s AS (SELECT * FROM ({LABELLED}) ORDER BY md5(concat('42:', doc_id)) LIMIT 400),
  v AS (SELECT doc_id, text, quality FROM s WHERE quality IS NOT NULL)
  SELECT text, quality FROM v ORDER BY md5(concat('42:', doc_id)) LIMIT 60""")
def sample_two_stage(spark, d):
    """P5: sample, whitelist, drop, sample."""
    first = sel.sample_exact(labelled(spark, d), 400, 42, ["doc_id"])
    return sel.select_rows(first, ["quality", "text"], 60, 42, ["doc_id"])


@query(f"""
  SELECT count(*) AS rows_in, count(*) FILTER (quality IS NULL) AS dropped_blank,
    least(count(quality), 500)::BIGINT AS rows_out, 2 AS columns_kept, count(quality) < 500 AS shortfall
  FROM ({LABELLED})""")
def filter_metrics(spark, d):
    """P6, P7."""
    return sel.filter_metrics(labelled(spark, d), ["text", "quality", "absent"], 500)


@query("""
  SELECT p_partkey::VARCHAR AS p_partkey, p_name, p_brand, p_type, p_size::VARCHAR AS p_size
  FROM part ORDER BY part.p_partkey LIMIT 3""")
def preview_cells(spark, d):
    """P8."""
    parts = table(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    return sel.preview(parts, ["p_partkey"])


@query("""
  SELECT doc_id::VARCHAR AS doc_id, left(text, 200) AS text FROM documents
  ORDER BY documents.doc_id LIMIT 3""")
def preview_texts(spark, d):
    """Long cells are cut."""
    return sel.preview(table(spark, d, "documents").select("doc_id", "text"), ["doc_id"])


@query('SELECT count(*) AS "rows", 5 AS "columns" FROM documents')
def frame_shape(spark, d):
    """P8."""
    return sel.shape(table(spark, d, "documents"))


# -- prompts and replies ---------------------------------------------------


@query(f"""
  SELECT conv_id, turn, {sql_fill(gen.INSTRUCTION_TEMPLATE, response="coalesce(response, 'None')")} AS prompt
  FROM ({PAIRS})""")
def prompt_from_answer(spark, d):
    """A1."""
    df = pairs(spark, d)
    prompt = gen.prompt_from_columns(df, gen.INSTRUCTION_TEMPLATE, {"response": gen.answer_column(df)})
    return df.select("conv_id", "turn", prompt.alias("prompt"))


def questions(spark, d):
    return table(spark, d, "part").select(
        "p_partkey",
        F.col("p_name").alias("question"),
        F.array("p_brand", "p_type", "p_name").alias("choices"),
        F.col("p_size").alias("answer"),
    )


_CHOICES = "'[''' || p_brand || ''', ''' || p_type || ''', ''' || p_name || ''']'"
_ASK = sql_fill(gen.QUESTION_TEMPLATE, question="p_name", choices=_CHOICES, answer="p_size")


@query(f"SELECT p_partkey, {_ASK} AS prompt FROM part")
def prompt_from_choices(spark, d):
    """A3."""
    df = questions(spark, d)
    fields = {c: c for c in ("question", "choices", "answer")}
    return df.select("p_partkey", gen.prompt_from_columns(df, gen.QUESTION_TEMPLATE, fields).alias("prompt"))


def sql_json(pairs_: dict[str, str]) -> str:
    inside = " || ', ' || ".join(f"""'"{k}": ' || coalesce({v}::VARCHAR, 'null')""" for k, v in pairs_.items())
    return f"'{{' || {inside} || '}}'"


def sql_json_text(c: str) -> str:
    return f"to_json({c})"


_RECORD = sql_json(
    {"text": sql_json_text("text"), "lang": sql_json_text("lang"), "quality": "quality", "doc_id": "doc_id"}
)


@query(f"SELECT doc_id, {_RECORD} AS row_as_json FROM ({LABELLED})")
def row_json(spark, d):
    """A4: listed keys that exist, in list order, nulls kept."""
    df = labelled(spark, d)
    keys = ["text", "lang", "absent", "quality", "doc_id"]
    return df.select("doc_id", jsontext.row_json(df, keys).alias("row_as_json"))


@query(f"""
  SELECT doc_id, {sql_fill(gen.RECORD_TEMPLATE, row_as_json=_RECORD)} AS prompt FROM ({LABELLED})""")
def prompt_from_record(spark, d):
    """A5."""
    df = labelled(spark, d)
    prompt = gen.prompt_from_record(df, gen.RECORD_TEMPLATE, ["text", "lang", "quality", "doc_id"])
    return df.select("doc_id", prompt.alias("prompt"))


def digest_generator():
    """A stand-in for a model: the reply to a prompt is its md5."""

    def reply(prompts):
        import hashlib

        return [[hashlib.md5(p.encode()).hexdigest()] for p in prompts]

    return reply


def picky_generator():
    """Fails for prompts about 'de'."""

    def reply(prompts):
        if any(p.startswith("de:") for p in prompts):
            raise RuntimeError("no")
        return [p.upper() for p in prompts]

    return reply


@query("SELECT doc_id, md5(text) AS raw, 'ok' AS status, 1 AS attempts FROM documents")
def generate_batches(spark, d):
    """A6."""
    df = table(spark, d, "documents").select("doc_id", "text")
    made = gen.generate(df, F.col("text"), digest_generator())
    return made.select("doc_id", "generation.raw", "generation.status", "generation.attempts")


@query("""
  SELECT doc_id, CASE WHEN lang = 'de' THEN '' ELSE upper(lang || ':' || source) END AS raw,
    CASE WHEN lang = 'de' THEN 'failed' ELSE 'ok' END AS status,
    CASE WHEN lang = 'de' THEN 3 ELSE 1 END AS attempts FROM documents""")
def generate_failures(spark, d):
    """Three attempts, then an empty reply that says so."""
    df = table(spark, d, "documents").select("doc_id", F.concat_ws(":", "lang", "source").alias("prompt"))
    made = gen.generate(df, F.col("prompt"), picky_generator(), batch_size=1, backoff=0.0)
    return made.select("doc_id", "generation.raw", "generation.status", "generation.attempts")


@query("""
  SELECT doc_id, 'ok' AS status, CASE WHEN lang = 'de' THEN md5(lang || ':' || source)
    ELSE upper(lang || ':' || source) END AS raw FROM documents""")
def generate_resumed(spark, d):
    """A second run asks only for what the first one did not get."""
    df = table(spark, d, "documents").select("doc_id", F.concat_ws(":", "lang", "source").alias("prompt"))
    store = scratch_path(spark, "replies")
    gen.generate_resumed(df, F.col("prompt"), picky_generator(), store, batch_size=1, max_attempts=1)
    made = gen.generate_resumed(df, F.col("prompt"), digest_generator(), store)
    return made.select("doc_id", "generation.status", "generation.raw")


def failing_generator():
    """Fails for prompts about two languages, in two ways."""

    def reply(prompts):
        for prompt in prompts:
            if prompt.startswith("de:"):
                raise RuntimeError("no German")
            if prompt.startswith("fr:"):
                raise ValueError("no French")
        return prompts

    return reply


@query("""
  SELECT reason, count(*) AS n FROM (
    SELECT CASE lang WHEN 'de' THEN 'RuntimeError: no German' WHEN 'fr' THEN 'ValueError: no French' END AS reason FROM documents)
  WHERE reason IS NOT NULL GROUP BY reason""")
def failure_reasons(spark, d):
    """Why how many rows of a run got no reply, counted while they are written."""
    docs = table(spark, d, "documents")
    df = docs.select("doc_id", F.concat(F.coalesce("lang", F.lit("")), F.lit(":"), F.coalesce("source", F.lit(""))).alias("response"))
    recipe = _recipe("instruction_from_answer", rows=docs.count(), columns_keep=["response"])
    result = rec.run_recipe(
        df, recipe, scratch_path(spark, "out"), NOW, failing_generator(), ["doc_id"],
        template="{response}", batch_size=1, max_attempts=1, backoff=0.0,
    )
    return spark.createDataFrame(result["failure_reasons"], "reason string, n long")


@query("""
  SELECT CASE WHEN lang = 'de' THEN 'failed' ELSE 'ok' END AS status, count(*) AS n
  FROM documents GROUP BY 1""")
def generation_progress(spark, d):
    """A16."""
    return generate_failures(spark, d).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query("""
  SELECT doc_id, CASE lang WHEN 'en' THEN source WHEN 'fr' THEN '' ELSE '' END AS reply FROM documents""")
def first_generation(spark, d):
    """A8."""
    lang = F.col("lang")
    generations = (
        F.when(lang == "en", F.array("source", "text"))
        .when(lang == "fr", F.array().cast("array<string>"))
        .when(lang == "de", F.array(F.lit(None).cast("string"), F.col("text")))
    )
    return table(spark, d, "documents").select("doc_id", gen.first_generation(generations).alias("reply"))


@query(f"""
  SELECT doc_id, {sql_strip("regexp_replace(" + sql_strip("raw") + ", '^Instruction:', '')")} AS instruction
  FROM ({REPLIES})""")
def clean_instruction(spark, d):
    """A9."""
    return replies(spark, d).select("doc_id", gen.clean_instruction(F.col("raw")).alias("instruction"))


@query(UNFENCED)
def strip_fences(spark, d):
    """A10."""
    return replies(spark, d).select("doc_id", gen.strip_fences(F.col("raw")).alias("clean"))


_ANCHORED = f"regexp_replace(regexp_replace({sql_strip('raw')}, '^```(?:json)?', ''), '```$', '')"


@query(f"SELECT doc_id, {sql_strip(_ANCHORED)} AS clean FROM ({REPLIES})")
def strip_fences_anchored(spark, d):
    """A10, whole fences only."""
    return replies(spark, d).select("doc_id", gen.strip_fences(F.col("raw"), "anchored").alias("clean"))


_PAIR = f"""
  SELECT doc_id, CASE WHEN json_valid(clean) THEN coalesce(clean->>'$.instruction', '') ELSE '' END
      AS instruction,
    CASE WHEN json_valid(clean) THEN coalesce(clean->>'$.response', '') ELSE '' END AS response
  FROM ({UNFENCED})"""


@query(_PAIR)
def parse_pair(spark, d):
    """A11."""
    return _parsed(spark, d, True)


@query(_PAIR)
def parse_pair_native(spark, d):
    """A11 without Python."""
    return _parsed(spark, d, False)


def _parsed(spark, d, exact):
    pair = jsontext.parse_pair(gen.strip_fences(F.col("raw")), "instruction", "response", exact)
    parsed = replies(spark, d).select("doc_id", pair.alias("pair"))
    return parsed.select(
        "doc_id", F.col("pair.first").alias("instruction"), F.col("pair.second").alias("response")
    )


@query(f"""
  SELECT doc_id, CASE WHEN json_valid(clean) THEN clean ELSE '{{}}' END AS structured_json
  FROM ({UNFENCED})""")
def json_or_default(spark, d):
    """A12."""
    clean = replies(spark, d).select("doc_id", gen.strip_fences(F.col("raw")).alias("clean"))
    return clean.select("doc_id", gen.json_or_default(F.col("clean")).alias("structured_json"))


# -- quality ---------------------------------------------------------------

def sql_pii(kind: str, *columns: str) -> str:
    cells = " + ".join(f"coalesce(regexp_matches({c}, '{PII_PATTERNS[kind]}')::INT, 0)" for c in columns)
    return f"coalesce(sum({cells}), 0)::BIGINT AS n_{kind}"


def sql_counts(source: str, required: list[str], texts: list[str], bad_json: str = "0", by: str = "") -> str:
    """The counts of the report over a subquery."""
    empty = " AND ".join(f"coalesce({sql_strip(c)} = '', true)" for c in required) or "true"
    pair = "0"
    if {"instruction", "response"} <= set(texts):
        pair = (
            "(coalesce(instruction <> '' AND response <> '' AND "
            f"{sql_strip('instruction')} = {sql_strip('response')}, false))::INT"
        )
    return f"""
  SELECT {by + "," if by else ""} count(*) AS n_rows,
    coalesce(sum(({empty})::INT), 0)::BIGINT AS n_empty,
    coalesce(sum({pair}), 0)::BIGINT AS n_degenerate,
    {", ".join(sql_pii(k, *texts) for k in PII_PATTERNS)},
    coalesce(sum({bad_json}), 0)::BIGINT AS n_bad_json
  FROM ({source}) {"GROUP BY " + by if by else ""}"""


def sql_long(counts: str, min_rows: str, missing: bool = False, by: str = "") -> str:
    rows = [
        ("required_columns_present", "hard", "false" if missing else "true", "NULL"),
        ("no_fully_empty_rows", "hard", "n_empty = 0", "n_empty"),
        ("no_degenerate_pairs", "soft", "n_degenerate = 0", "n_degenerate"),
        ("min_row_count", "hard", f"n_rows >= {min_rows}", "n_rows"),
        ("pii_scan", "soft", "n_ssn + n_phone + n_email = 0", "n_ssn + n_phone + n_email"),
        ("json_valid", "soft", "n_bad_json = 0", "n_bad_json"),
    ]
    key = by + ", " if by else ""
    parts = [
        f"SELECT {key}'{c}' AS \"check\", '{s}' AS severity, {p} AS passed, ({n})::BIGINT AS n FROM c"
        for c, s, p, n in rows
    ]
    return f"WITH c AS ({counts}) " + " UNION ALL ".join(parts)


_KEPT = f"""
  SELECT instruction, response FROM ({PAIRS}) WHERE response IS NOT NULL
  ORDER BY md5(concat('42:', conv_id, ':', turn)) LIMIT 200"""


@query(sql_long(sql_counts(_KEPT, ["instruction", "response"], ["instruction", "response"]), "160"))
def report_long(spark, d):
    """V1-V9 over selected pairs."""
    kept = sel.select_rows(pairs(spark, d), ["instruction", "response"], 200, 42, ["conv_id", "turn"])
    report = qual.quality_report(kept, ["instruction", "response"], qual.default_min_rows(200))
    return qual.report_long(report)


_OPENING = """
  SELECT text AS instruction, regexp_extract(text, '^[^\\n]*') AS response FROM documents"""


def openings(spark, d):
    """Each document against its first line: equal when it has only one."""
    return table(spark, d, "documents").select(
        F.col("text").alias("instruction"), F.substring_index("text", "\n", 1).alias("response")
    )


@query(f"""
  WITH c AS ({sql_counts(_OPENING, ["instruction"], ["instruction", "response"])})
  SELECT n_rows, n_degenerate, false AS passed FROM c""")
def degenerate_pairs(spark, d):
    """V3, with a required column that is missing."""
    report = qual.quality_report(openings(spark, d), ["instruction", "answer"], 1)
    return report.select("n_rows", "n_degenerate", "passed")


_SYSTEM = """
  SELECT conv_id, max(CASE WHEN role = 'system' THEN text END) AS opening,
    max(CASE WHEN role = 'user' AND turn > 6 THEN text END) AS late
  FROM conversations GROUP BY conv_id"""


@query(f"""
  WITH c AS ({sql_counts(_SYSTEM, ["opening", "late"], ["opening", "late"])})
  SELECT n_rows, n_empty, n_rows >= 90 AS enough, n_empty = 0 AND n_rows >= 90 AS passed FROM c""")
def empty_rows(spark, d):
    """V2, V4, V7: rows where every required column is empty."""
    role, turn = F.col("role"), F.col("turn")
    shapes = table(spark, d, "conversations").groupBy("conv_id").agg(
        F.max(F.when(role == "system", F.col("text"))).alias("opening"),
        F.max(F.when((role == "user") & (turn > 6), F.col("text"))).alias("late"),
    )
    report = qual.quality_report(shapes, ["opening", "late"], 90)
    return report.select("n_rows", "n_empty", F.col("checks.min_row_count").alias("enough"), "passed")


@query("SELECT " + ", ".join(sql_pii(k, "text", "lang", "source") for k in PII_PATTERNS) + " FROM documents")
def pii_documents(spark, d):
    """V5."""
    return qual.quality_counts(table(spark, d, "documents"), ["text"]).select(qual.PII_COUNTS)


@query("SELECT " + ", ".join(sql_pii(k, "url", "html") for k in PII_PATTERNS) + " FROM pages")
def pii_pages(spark, d):
    """V5."""
    return qual.quality_counts(table(spark, d, "pages"), ["html"]).select(qual.PII_COUNTS)


_NUMBERS = """
  SELECT substr(c_name, 10, 3) || '-' || substr(c_name, 13, 2) || '-' || substr(c_name, 15, 4) AS number,
    'mail ' || lower(replace(c_name, '#', '.')) || '@example.com, or call (555) 010-'
      || substr(c_name, 15, 4) AS contact FROM customer"""


@query("SELECT " + ", ".join(sql_pii(k, "number", "contact") for k in PII_PATTERNS) + f" FROM ({_NUMBERS})")
def pii_customers(spark, d):
    """V5: all three kinds in every row."""

    def digits(start, n):
        return F.substring("c_name", start, n)

    contact = F.concat(
        F.lit("mail "), F.lower(F.replace("c_name", F.lit("#"), F.lit("."))),
        F.lit("@example.com, or call (555) 010-"), digits(15, 4),
    )
    number = F.concat_ws("-", digits(10, 3), digits(13, 2), digits(15, 4))
    df = table(spark, d, "customer").select(number.alias("number"), contact.alias("contact"))
    return qual.quality_counts(df, []).select(qual.PII_COUNTS)


_PROPS = """
  SELECT event_id, CASE WHEN event_type = 'error' THEN left(props, length(props) - 1) ELSE props END AS output
  FROM events"""


def props(spark, d):
    cut = F.expr("left(props, length(props) - 1)")
    broken = F.when(F.col("event_type") == "error", cut).otherwise(F.col("props"))
    return table(spark, d, "events").select("event_id", broken.alias("output"))


_BAD = sql_long(sql_counts(_PROPS, ["output"], ["output"], "(NOT json_valid(output))::INT"), "1")


@query(_BAD)
def json_validity(spark, d):
    """V6, Python's parser."""
    return qual.report_long(qual.quality_report(props(spark, d), ["output"], 1, "structured"))


@query(_BAD)
def json_validity_native(spark, d):
    """V6, JVM parser."""
    report = qual.quality_report(props(spark, d), ["output"], 1, "structured", exact_json=False)
    return qual.report_long(report)


@query(f"""
  WITH c AS ({sql_counts(_OPENING, ["instruction"], ["instruction", "response"])}),
  t AS (SELECT *, n_ssn + n_phone + n_email AS n_pii, concat_ws(', ',
      CASE WHEN n_ssn > 0 THEN '''ssn'': ' || n_ssn END, CASE WHEN n_phone > 0 THEN '''phone'': ' || n_phone END,
      CASE WHEN n_email > 0 THEN '''email'': ' || n_email END) AS found FROM c)
  SELECT concat_ws(chr(10),
    'Validation ' || CASE WHEN n_rows >= 800 THEN 'PASSED' ELSE 'FAILED' END || ' — ' || n_rows || '/' || n_rows
      || ' rows',
    '  ✓ required_columns_present', '  ✓ no_fully_empty_rows',
    CASE WHEN n_degenerate = 0 THEN '  ✓' ELSE '  ✗' END || ' no_degenerate_pairs',
    CASE WHEN n_rows >= 800 THEN '  ✓' ELSE '  ✗' END || ' min_row_count',
    CASE WHEN n_pii = 0 THEN '  ✓' ELSE '  ✗' END || ' pii_scan', '  ✓ json_valid',
    CASE WHEN n_degenerate > 0 THEN '  ⚠  ' || n_degenerate || ' rows have instruction == response' END,
    CASE WHEN n_pii > 0 THEN '  ⚠  Possible PII, review before publishing: {{' || found || '}}' END,
    CASE WHEN n_rows < 800 THEN '  ✗ Row count ' || n_rows || ' is below the minimum of 800' END) AS summary
  FROM t""")
def report_text(spark, d):
    """V8."""
    report = qual.quality_report(openings(spark, d), ["instruction"], qual.default_min_rows(1000))
    return qual.report_text(report)


_BY_SOURCE = "SELECT source, text, lang FROM documents"


@query(sql_long(sql_counts(_BY_SOURCE, ["text"], ["text", "lang"], by="source"), "50", by="source"))
def validate_many(spark, d):
    """Every source is a dataset, one job for all."""
    df = table(spark, d, "documents").select("source", "text", "lang")
    return qual.report_long(qual.quality_report(df, ["text"], 50, by="source"), "source")


@query(f"""
  WITH c AS (SELECT 'Customer#' || lpad(o_custkey::VARCHAR, 9, '0') AS id, count(*) AS n_rows
             FROM orders GROUP BY o_custkey),
  m AS (SELECT id, coalesce(nullif(min_rows_output, 0), floor(rows * 0.8))::BIGINT AS min_rows FROM ({ENTRIES}))
  SELECT coalesce(c.id, m.id) AS id, coalesce(n_rows, 0)::BIGINT AS n_rows, min_rows,
    coalesce(n_rows, 0) >= coalesce(min_rows, 1) AS passed
  FROM c FULL JOIN m ON m.id = c.id""")
def validate_many_limits(spark, d):
    """Each dataset against the minimum of its registry entry; ids without
    rows and ids without an entry are reported too."""
    limit = qual.min_rows_column(F.col("rows"), F.col("min_rows_output")).alias("min_rows")
    limits = entries(spark, d).select("id", limit)
    name = F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"))
    df = table(spark, d, "orders").select(name.alias("id"), "o_orderpriority")
    report = qual.quality_report(df, ["o_orderpriority"], F.col("min_rows"), by="id", limits=limits)
    return report.select("id", "n_rows", "min_rows", "passed")


_CONTRACTS = [
    ("documents", ["text", "lang"], 50, "default", None),
    ("events", ["output", "event_type", "no_such_column"], 1, "structured", ["reply", "output"]),
    ("pairs", ["instruction"], 10**9, "default", None),
    ("nations", ["n_name", "n_comment"], None, None, None),
    ("absent", ["text"], 5, "default", None),
]


def _contract_sql(name: str, source: str, texts: list[str], bad_json: str = "0") -> str:
    required = next(c[1] for c in _CONTRACTS if c[0] == name)
    present = [c for c in required if c != "no_such_column"]
    return f"SELECT '{name}' AS dataset_id, * FROM ({sql_counts(source, present, texts, bad_json)})"


@query(f"""
  WITH c AS (
    {_contract_sql("documents", "SELECT text, lang, n_chars FROM documents", ["text", "lang"])}
    UNION ALL {_contract_sql(
        "events", f"SELECT p.output, e.event_type FROM ({_PROPS}) p JOIN events e USING (event_id)",
        ["output", "event_type"], "(NOT json_valid(output))::INT")}
    UNION ALL {_contract_sql(
        "pairs", f"SELECT instruction, response FROM ({PAIRS})", ["instruction", "response"])}
    UNION ALL {_contract_sql("nations", "SELECT n_name, n_comment FROM (SELECT n_name, n_name AS n_comment FROM nation)", ["n_name", "n_comment"])}
    UNION ALL SELECT 'absent', 0, 0, 0, 0, 0, 0, 0),
  m AS (SELECT *, CASE dataset_id WHEN 'documents' THEN 50 WHEN 'pairs' THEN 1000000000 WHEN 'absent' THEN 5 ELSE 1 END AS min_rows,
    CASE dataset_id WHEN 'events' THEN '[''no_such_column'']' WHEN 'absent' THEN '[''text'']' ELSE '[]' END AS missing FROM c)
  SELECT dataset_id, n_rows::BIGINT AS n_rows, n_empty, n_degenerate, n_ssn::BIGINT AS n_ssn, n_phone::BIGINT AS n_phone,
    n_email::BIGINT AS n_email, n_bad_json, missing,
    missing = '[]' AND n_empty = 0 AND n_rows >= min_rows AS passed FROM m""")
def validate_contracts(spark, d):
    """Tables of different columns, each against its own contract, in one job."""
    events = props(spark, d).join(table(spark, d, "events").select("event_id", "event_type"), "event_id")
    tables = {
        "documents": table(spark, d, "documents").select("text", "lang", "n_chars"),
        "events": events.select("output", "event_type"),
        "pairs": pairs(spark, d).select("instruction", "response"),
        "nations": table(spark, d, "nation").selectExpr("n_name", "n_name AS n_comment"),
    }
    kinds = "dataset_id string, required array<string>, min_rows long, output_type string, json_columns array<string>"
    contracts = spark.createDataFrame(_CONTRACTS, kinds)
    report = contract_report(union_cells(tables), contracts)
    missing = F.concat(F.lit("["), F.array_join(F.transform("missing", lambda c: F.concat(F.lit("'"), c, F.lit("'"))), ", "), F.lit("]"))
    return report.select("dataset_id", *qual.COUNTS, missing.alias("missing"), "passed")


# -- delivery --------------------------------------------------------------


@query(f"SELECT * FROM ({PAIRS}) WHERE response IS NOT NULL")
def deliver_rescan(spark, d):
    """What was delivered, read again."""
    base = scratch_path(spark, "base")
    kept = sel.drop_blank_rows(pairs(spark, d))
    where = out.deliver(kept, base, "01-pairs", "pairs", NOW).head()["local_path"]
    return out.rescan(spark, where)


@query(f"""
  SELECT 'docs' AS dataset_id, count(*) AS rows, '{NOW}' AS processed_at, true AS published FROM documents""")
def delivery_result(spark, d):
    """K2, K3: rows counted while writing; a second copy."""
    base = scratch_path(spark, "base")
    result = out.deliver(
        table(spark, d, "documents"), base, "docs", "docs", NOW, publish_to=f"{base}/second/docs"
    )
    return result.select("dataset_id", "rows", "processed_at", "published")


@query("SELECT page_id, url, html FROM pages")
def republish_rescan(spark, d):
    """K4: published again from the ledger entry."""
    base = scratch_path(spark, "base")
    result = out.deliver(table(spark, d, "pages"), base, "pages", "pages", NOW)
    rec.republish(spark, result, "pages", f"{base}/again/pages")
    return out.rescan(spark, f"{base}/again/pages")


@query(sql_long(sql_counts("SELECT url, html FROM pages", ["url", "html"], ["url", "html"]), "1"))
def revalidate_delivered(spark, d):
    """Deliver, read again, check."""
    base = scratch_path(spark, "base")
    result = out.deliver(table(spark, d, "pages").select("url", "html"), base, "pages", "pages", NOW)
    return qual.report_long(rec.revalidate(spark, result, "pages"))


def finished(spark, d):
    """Registry entries with the results of their runs, as ledger entries."""
    results = ledger(spark, d).select(
        "dataset_id", "local_path", F.lit(None).cast("string").alias("published_to"),
        F.col("rows_out").alias("rows_in"), "rows_out",
        F.when(F.col("rows_out") > 8, F.lit("text_generation")).alias("augmentation"),
        "validation_passed", "processed_at",
    )
    return led.provenance(entries(spark, d), results)


_FINISHED = f"""
  SELECT l.dataset_id, e.repo, e.output_name, l.local_path, NULL::VARCHAR AS published_to,
    l.rows_out AS rows_in, l.rows_out,
    CASE WHEN l.rows_out > 8 THEN 'text_generation' ELSE 'none' END AS augmentation,
    CASE WHEN l.rows_out > 8 THEN e.augmentation_llm END AS augmentation_llm,
    l.validation_passed, l.processed_at, e.recipe_target, e.project,
    CASE e.issues WHEN 'none' THEN '' ELSE e.issues END AS known_issues_resolved
  FROM ({ENTRIES}) e JOIN ({LEDGER}) l ON l.dataset_id = e.id"""


@query(_FINISHED)
def provenance(spark, d):
    """L8."""
    return finished(spark, d).withColumn("known_issues_resolved", F.array_join("known_issues_resolved", ", "))


@query(_FINISHED)
def ledger_saved(spark, d):
    """K6: ledger written as JSON lines and read again."""
    path = scratch_path(spark, "ledger.jsonl")
    led.ledger_save(finished(spark, d), path)
    again = readers.read_file(spark, path, led.LEDGER_SCHEMA)
    return again.withColumn("known_issues_resolved", F.array_join("known_issues_resolved", ", "))


_CARD_VALUES = {
    "license_tag": "'cc-by-4.0'",
    "license": "'CC-BY-4.0'",
    "project_tag": "lower(project)",
    "title": "regexp_extract(output_name, '[^/]*$')",
    "rows": "rows_out::VARCHAR",
    "date": "coalesce(left(processed_at, 10), '')",
    **{c: c for c in ("recipe_target", "repo", "augmentation", "project")},
}


@query(f"SELECT dataset_id, {sql_fill(out.CARD_TEMPLATE, **_CARD_VALUES)} AS card FROM ({_FINISHED})")
def dataset_cards(spark, d):
    """K5."""
    return out.dataset_cards(finished(spark, d))


# -- registry and ledger ---------------------------------------------------


@query(f"""
  SELECT * FROM ({LEDGER}) WHERE dataset_id IN (SELECT c_name FROM customer WHERE c_acctbal > 5000)""")
def ledger_lookup(spark, d):
    """L1: the entries of the ids another table names."""
    rich = table(spark, d, "customer").where("c_acctbal > 5000")
    return led.ledger_get(ledger(spark, d), rich.select(F.col("c_name").alias("dataset_id")))


@query(f"SELECT * FROM ({LEDGER}) WHERE validation_passed AND processed_at IS NOT NULL")
def completed_entries(spark, d):
    """L2."""
    return led.completed(ledger(spark, d))


@query(f"""
  SELECT id, status FROM ({ENTRIES}) WHERE id NOT IN (
    SELECT dataset_id FROM ({LEDGER}) WHERE validation_passed AND processed_at IS NOT NULL)""")
def skip_completed(spark, d):
    """L3."""
    return led.skip_completed(entries(spark, d), ledger(spark, d)).select("id", "status")


@query(f"SELECT id, status, project FROM ({ENTRIES}) WHERE recipe_target = 'BUILDING'")
def targets_by_recipe(spark, d):
    """L4: the recipe target wins over the project."""
    chosen = led.select_targets(entries(spark, d), recipe_target="BUILDING", project="Nation-3")
    return chosen.select("id", "status", "project")


@query(f"SELECT id, status, project FROM ({ENTRIES}) WHERE status IS DISTINCT FROM 'complete'")
def targets_all(spark, d):
    """L4: everything not marked complete; no status counts as not complete."""
    return led.select_targets(entries(spark, d), all_datasets=True).select("id", "status", "project")


def updates(spark, d):
    """Building customers run again: a null row count, a new field, no path."""
    changed = entries(spark, d).where("recipe_target = 'BUILDING'")
    return changed.select(
        F.col("id").alias("dataset_id"),
        F.when(F.col("rows") > 1000, F.col("rows")).alias("rows_out"),
        F.lit(NOW).alias("processed_at"),
        F.col("project").alias("owner"),
    )


UPSERT = f"""
  WITH u AS (SELECT id AS dataset_id, CASE WHEN rows > 1000 THEN rows END AS rows_out,
               '{NOW}' AS processed_at, project AS owner, true AS seen
             FROM ({ENTRIES}) WHERE recipe_target = 'BUILDING')
  SELECT coalesce(u.dataset_id, l.dataset_id) AS dataset_id,
    (CASE WHEN u.seen THEN u.rows_out ELSE l.rows_out END)::BIGINT AS rows_out, l.validation_passed,
    CASE WHEN u.seen THEN u.processed_at ELSE l.processed_at END AS processed_at, l.local_path, u.owner
  FROM ({LEDGER}) l FULL OUTER JOIN u ON u.dataset_id = l.dataset_id"""


@query(UPSERT)
def ledger_upsert(spark, d):
    """L5."""
    return led.ledger_upsert(ledger(spark, d), updates(spark, d))


@query(UPSERT)
def ledger_changes(spark, d):
    """The same through the stored ledger, to which two writers add."""
    root = scratch_path(spark, "ledger")
    before = led.ledger_read(spark, root)
    led.ledger_write(ledger(spark, d), root)
    assert before.isEmpty()  # the second writer knows nothing of the first
    led.ledger_write(updates(spark, d), root)
    once = f"{root}-once"
    led.ledger_write(led.ledger_read(spark, root), once)  # how a user puts updates together
    names = ["dataset_id", "rows_out", "validation_passed", "processed_at", "local_path", "owner"]
    return led.ledger_read(spark, once).select(names)


@query(f"""
  SELECT e.id, CASE WHEN l.validation_passed THEN 'complete' WHEN e.status = 'ready' THEN 'ready'
      ELSE 'pending' END AS status, e.project, e.recipe_target,
    CASE WHEN l.validation_passed THEN l.rows_out::VARCHAR ELSE '—' END AS rows_out,
    CASE WHEN l.validation_passed THEN coalesce(left(l.processed_at, 10), '') ELSE '—' END AS processed_at,
    e.issues AS known_issues
  FROM ({ENTRIES}) e LEFT JOIN ({LEDGER}) l ON l.dataset_id = e.id""")
def status_board(spark, d):
    """L6."""
    return led.status_board(entries(spark, d), ledger(spark, d))


def outcomes(spark, d):
    done = F.col("validation_passed").eqNullSafe(True)
    status = F.when(done, F.lit("success")).otherwise(F.lit("failed"))
    return ledger(spark, d).select("dataset_id", status.alias("status"))


_OUTCOMES = f"""
  SELECT dataset_id, CASE WHEN validation_passed THEN 'success' ELSE 'failed' END AS status FROM ({LEDGER})"""


@query(f"SELECT status, count(*) AS n FROM ({_OUTCOMES}) GROUP BY status")
def run_tally(spark, d):
    """L7."""
    return led.run_tally(outcomes(spark, d))


@query(f"SELECT dataset_id, status FROM ({_OUTCOMES}) WHERE status = 'failed'")
def run_failures(spark, d):
    """L7."""
    return led.failed(outcomes(spark, d))


# -- whole recipes ---------------------------------------------------------


def prefixed_generator():
    def reply(prompts):
        import hashlib

        return [f" Instruction: {hashlib.md5(p.encode()).hexdigest()}\n" for p in prompts]

    return reply


def fenced_pair_generator():
    def reply(prompts):
        import hashlib
        import json

        made = []
        for p in prompts:
            digest = hashlib.md5(p.encode()).hexdigest()
            obj = {"instruction": f"What is {digest}?", "response": digest}
            made.append("```json\n" + json.dumps(obj) + "\n```")
        return made

    return reply


def echo_record_generator():
    """Returns the record in the prompt, fenced; something else without one."""

    def reply(prompts):
        made = []
        for p in prompts:
            record = next((line for line in p.split("\n") if line.startswith("{")), "no record")
            made.append(record if "URGENT" in record else f"```json\n{record}\n```")
        return made

    return reply


def _recipe(name: str, **changes) -> rec.Recipe:
    from dataclasses import replace

    return replace(rec.RECIPES[name], **changes)


_R1 = f"""
  WITH s AS (SELECT conv_id, turn, instruction AS context, response FROM ({PAIRS})
             ORDER BY md5(concat('42:', conv_id, ':', turn)) LIMIT 250)
  SELECT context, response FROM s WHERE response IS NOT NULL"""


@query(f"""
  SELECT context, response, md5({sql_fill(gen.INSTRUCTION_TEMPLATE, response="response")}) AS instruction
  FROM ({_R1})""")
def recipe_instruction(spark, d):
    """R1."""
    df = pairs(spark, d).withColumnRenamed("instruction", "context")
    recipe = _recipe("instruction_from_answer", rows=250)
    return rec.recipe_frame(df, recipe, prefixed_generator(), ["conv_id", "turn"])


@query(f"""
  WITH s AS (SELECT * FROM part ORDER BY md5(concat('42:', p_partkey)) LIMIT 1500)
  SELECT p_name AS question, {_CHOICES} AS choices, p_size AS answer,
    'What is ' || md5({_ASK}) || '?' AS instruction, md5({_ASK}) AS response FROM s""")
def recipe_questions(spark, d):
    """R2."""
    recipe = _recipe("text_generation", rows=1500)
    made = rec.recipe_frame(questions(spark, d), recipe, fenced_pair_generator(), ["p_partkey"])
    return made.withColumn("choices", text.list_text(F.col("choices")))


def scenarios(spark, d):
    """Order facts under the names of a scenario record."""
    return table(spark, d, "orders").select(
        "o_orderkey",
        F.col("o_orderpriority").alias("norm"),
        F.col("o_orderstatus").alias("situation"),
        F.concat(F.lit("customer \""), "o_custkey", F.lit("\"")).alias("intention"),
        F.concat(F.lit("keep\t"), "o_orderkey").alias("moral_action"),
        F.concat(F.lit("drop\\"), "o_orderkey").alias("immoral_action"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("moral_consequence"),
        F.lower("o_orderpriority").alias("immoral_consequence"),
    )


_SCENARIOS = """
  SELECT o_orderkey, o_orderpriority AS norm, o_orderstatus AS situation,
    'customer "' || o_custkey || '"' AS intention, 'keep' || chr(9) || o_orderkey AS moral_action,
    'drop\\' || o_orderkey AS immoral_action, strftime(o_orderdate, '%Y-%m-%d') AS moral_consequence,
    lower(o_orderpriority) AS immoral_consequence FROM orders"""
_SCENARIO_JSON = sql_json({k: sql_json_text(k) for k in gen.RECORD_KEYS})


@query(f"""
  SELECT {", ".join(gen.RECORD_KEYS)}, {_SCENARIO_JSON} AS structured_json FROM (
    SELECT * FROM ({_SCENARIOS}) ORDER BY md5(concat('42:', o_orderkey)) LIMIT 2000)""")
def recipe_structured(spark, d):
    """R3."""
    recipe = rec.RECIPES["structured_output"]
    return rec.recipe_frame(scenarios(spark, d), recipe, echo_record_generator(), ["o_orderkey"])


@query(sql_long(sql_counts(f"""
  SELECT *, {_SCENARIO_JSON} AS structured_json FROM (
    SELECT {", ".join(gen.RECORD_KEYS)} FROM ({_SCENARIOS}) ORDER BY md5(concat('42:', o_orderkey)) LIMIT 2000)""",
  gen.RECORD_KEYS, [*gen.RECORD_KEYS, "structured_json"], "(NOT json_valid(structured_json))::INT"), "1600"))
def recipe_structured_report(spark, d):
    """The report made while the dataset is written."""
    recipe = rec.RECIPES["structured_output"]
    made = rec.recipe_frame(scenarios(spark, d), recipe, echo_record_generator(), ["o_orderkey"])
    report = out.write_checked(
        made, scratch_path(spark, "made.parquet"), recipe.columns_keep, recipe.min_rows,
        recipe.output_type, recipe.json_columns,
    )
    return qual.report_long(report)


@query("""
  SELECT 'documents in ' || lang AS question, source AS context, text AS answer
  FROM documents ORDER BY md5(concat('42:', doc_id)) LIMIT 300""")
def recipe_text_to_sql(spark, d):
    """No augmentation."""
    df = table(spark, d, "documents").select(
        "doc_id",
        F.concat(F.lit("documents in "), "lang").alias("question"),
        F.col("source").alias("context"),
        F.col("text").alias("answer"),
    )
    return rec.recipe_frame(df, _recipe("text_to_sql", rows=300), key=["doc_id"])


@query(f"""
  WITH s AS (SELECT doc_id, source AS instruction, note AS input, lang AS output
             FROM (SELECT n.*, d.source FROM ({NOTED}) n JOIN documents d ON d.doc_id = n.doc_id)
             ORDER BY md5(concat('42:', doc_id)) LIMIT 300)
  SELECT instruction, input, output FROM s WHERE {sql_strip("input")} <> ''""")
def recipe_text_to_python(spark, d):
    """Rows with a blank input go."""
    base = table(spark, d, "documents").select("doc_id", F.col("source").alias("instruction"))
    df = noted(spark, d).join(base, "doc_id").select(
        "doc_id", "instruction", F.col("note").alias("input"), F.col("lang").alias("output")
    )
    return rec.recipe_frame(df, _recipe("text_to_python", rows=300), key=["doc_id"])


_RUN = [
    # id, table, columns, rows, required minimum, augmentation, target
    ("docs", "documents", ["text", "lang"], 200, None, "none", "text_to_sql"),
    ("turns", "conversations", ["role", "text"], 500, 100, "none", "text_to_sql"),
    ("pages", "pages", ["url", "html"], 1000000, None, "none", "text_to_python"),
    ("lines", "lineitem", ["l_returnflag", "missing"], 100, None, "none", "text_to_python"),
    ("nowhere", "absent_table", ["text"], 100, None, "none", "text_to_sql"),
]


@query("""
  SELECT 'docs' AS dataset_id, 'success' AS status, least(count(*), 200)::BIGINT AS rows_out FROM documents
  UNION ALL SELECT 'turns', CASE WHEN count(*) >= 100 THEN 'success' ELSE 'failed' END,
    least(count(*), 500)::BIGINT FROM conversations
  UNION ALL SELECT 'pages', CASE WHEN count(*) >= 800000 THEN 'success' ELSE 'failed' END,
    least(count(*), 1000000)::BIGINT FROM pages
  UNION ALL SELECT 'lines', 'failed', least(count(*), 100)::BIGINT FROM lineitem
  UNION ALL SELECT 'nowhere', 'failed', NULL""")
def registry_run(spark, d):
    """A registry over the tables; too few rows, a missing column and a
    missing source fail without stopping the others."""
    keys = {"docs": ["doc_id"], "turns": ["conv_id", "turn"], "pages": ["page_id"]}
    entries_ = [
        {
            "id": i, "repo": t, "columns_keep": c, "rows": n, "min_rows_output": m, "augmentation": a,
            "recipe_target": r, "output_name": f"org/{i}", "local_subdir": r, "project": "p",
            "known_issues": [], "status": "pending",
        }
        for i, t, c, n, m, a, r in _RUN
    ]
    base = scratch_path(spark, "run")
    results = rec.run_registry(
        spark, registry.registry_frame(spark, entries_), f"{base}/ledger", d, f"{base}/out", NOW,
        all_datasets=True, keys=keys,
    )
    return results.select("dataset_id", "status", "rows_out")


# -- streaming -------------------------------------------------------------


_ARRIVED = ", ".join(f"regexp_matches(text, '{p}') AS has_{k}" for k, p in PII_PATTERNS.items())


@query(f"SELECT doc_id, text, {_ARRIVED} FROM documents")
def stream_arrivals(spark, d):
    """ST2: files read as a stream, delivered per micro-batch."""
    base = scratch_path(spark, "stream")
    schema = table(spark, d, "documents").schema
    stream = arrivals.read_arrivals(spark, f"{d}/documents.parquet", schema, nested=True)
    run = arrivals.deliver_arrivals(
        stream, ["doc_id", "text"], f"{base}/out", f"{base}/checkpoint", f"{base}/ledger", "docs", NOW
    )
    run.awaitTermination()
    return out.rescan(spark, f"{base}/out").drop("batch")


@query(f"""
  WITH n AS (SELECT count(*) AS n, count(*) FILTER (WHERE NOT coalesce({sql_strip("text")} = '', true)) AS good FROM documents)
  SELECT 'docs' AS id, 'complete' AS status, good::VARCHAR AS rows_out, 'docs' AS batches_of, good AS rows_delivered, 0::BIGINT AS rows_apart FROM n
  UNION ALL SELECT 'odd', 'pending', '—', 'odd', 0, good FROM n""")
def stream_board(spark, d):
    """ST2, L6: a stream in several batches, and one whose batches fail, on the board."""
    base = scratch_path(spark, "streams")
    docs = table(spark, d, "documents").select("doc_id", "text", "source")
    files = write_parts(docs, f"{base}/in")
    for name, columns in (("docs", ["doc_id", "text"]), ("odd", ["doc_id", "text", "absent"])):
        stream = arrivals.read_arrivals(spark, f"{base}/in", docs.schema, max_files=files - files // 3)
        for _ in range(2):  # the second run finds nothing new
            arrivals.deliver_arrivals(
                stream, columns, f"{base}/{name}", f"{base}/check-{name}", f"{base}/ledger", name, NOW
            ).awaitTermination()
    entries = spark.createDataFrame(
        [("docs", "pending", "p", "t", None), ("odd", "pending", "p", "t", None)],
        "id string, status string, project string, recipe_target string, known_issues array<string>",
    )
    board = led.status_board(entries, led.ledger_read(spark, f"{base}/ledger")).select("id", "status", "rows_out")
    rows = out.rescan(spark, f"{base}/docs").select(F.lit("docs").alias("batches_of"), F.lit(1).alias("in"), F.lit(0).alias("apart"))
    apart = out.rescan(spark, f"{base}/odd_quarantine").select(F.lit("odd"), F.lit(0), F.lit(1))
    sums = rows.union(apart).groupBy("batches_of").agg(F.sum("in").alias("rows_delivered"), F.sum("apart").alias("rows_apart"))
    return board.join(sums, board["id"] == sums["batches_of"])


# -- training corpora --------------------------------------------------------
# A subpackage of its own, which may be absent together with corpus_pipeline.py.

try:
    import corpus_pipeline
    from tuneloom.llm import queries as corpus_queries
except ModuleNotFoundError as absent:
    if absent.name not in {"corpus_pipeline", "tuneloom.llm"}:
        raise
else:
    _QUERIES.update(corpus_queries.QUERIES, pipeline=corpus_pipeline.run)
    _ORACLE.update(corpus_queries.ORACLE)
    if corpus_pipeline.ORACLE_SQL is not None:
        _ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
