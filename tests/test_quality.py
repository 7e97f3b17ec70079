import json
import random
import re

import pytest
from pyspark.sql import functions as F

from tuneloom.functions.pii import PII_PATTERNS
from tuneloom.operators import quality as q


def pairs(spark, n=10, pii=False):
    data = [(f"Instruction {i}", f"Response {i}") for i in range(n)]
    if pii:
        data[0] = (data[0][0], "Write to test@example.com or 555-123-4567")
    return spark.createDataFrame(data, "instruction string, response string")


BOTH = ["instruction", "response"]


def test_clean_dataset_passes(spark):
    r = q.quality_report(pairs(spark), BOTH, 8).first()
    assert r.passed and r.errors == [] and r.warnings == [] and r.rows_in == r.rows_out == 10
    assert r.checks == {c: True for c in q.CHECKS}


def test_missing_column_fails(spark):
    df = spark.createDataFrame([("Q1",)], "instruction string")
    r = q.quality_report(df, BOTH, 1).first()
    assert not r.passed and not r.checks["required_columns_present"]
    assert r.errors == ["Missing required columns: ['response']"]


def test_too_few_rows_fails(spark):
    r = q.quality_report(pairs(spark, 5), BOTH, 9).first()
    assert not r.passed and not r.checks["min_row_count"] and "5" in r.errors[0] and "9" in r.errors[0]


def test_degenerate_pair_is_a_warning(spark):
    df = spark.createDataFrame(
        [("same", " same\u3000"), ("a", "b"), (" ", " "), ("", ""), (None, None), ("x", None)], "instruction string, response string"
    )
    r = q.quality_report(df, ["instruction"], 1).first()
    assert r.n_degenerate == 2  # a text of one space is not empty before the strip
    assert r.checks["no_fully_empty_rows"] is False
    r = q.quality_report(df.limit(2), BOTH, 1).first()
    assert r.passed and any("instruction == response" in w for w in r.warnings)


def test_pairs_of_other_types(spark):
    df = spark.createDataFrame([(0, 0), (1, 1), (2, 1), (None, 1)], "instruction int, response long")
    assert q.quality_counts(df, []).first().n_degenerate == 1
    df = spark.createDataFrame([([], []), (["a"], ["a"]), (["a"], ["b"])], "instruction array<string>, response array<string>")
    assert q.quality_counts(df, []).first().n_degenerate == 1
    df = spark.createDataFrame([("1", 1), (" 1\n", 1), ("1.0", 1)], "instruction string, response int")
    assert q.quality_counts(df, []).first().n_degenerate == 2


def test_pii_is_a_warning(spark):
    r = q.quality_report(pairs(spark, pii=True), BOTH, 8).first()
    assert r.passed and not r.checks["pii_scan"]
    assert r.warnings == ["Possible PII, review before publishing: {'phone': 1, 'email': 1}"]


def test_empty_frame_and_vacuous_requirements(spark):
    empty = spark.createDataFrame([], "instruction string")
    r = q.quality_report(empty, [], 0).first()
    assert r.passed and r.rows_out == 0
    r = q.quality_report(pairs(spark, 3), ["absent"], 1).first()
    assert r.n_empty == 3  # no required column present: every row counts as empty
    nothing = spark.range(3).select()
    assert q.quality_report(nothing, [], 0).first().n_empty == 3


def test_non_string_columns_are_only_tested_for_null(spark):
    df = spark.createDataFrame([(0, []), (None, None), (None, [])], "n int, a array<string>")
    assert q.quality_report(df, ["n", "a"], 1).first().n_empty == 1


def test_json_check(spark):
    df = spark.createDataFrame(
        [("{}", "x"), ("{bad", "x"), (None, "x"), ("", "x"), ("NaN", "x")], "output string, response string"
    )
    assert q.quality_report(df, ["response"], 1).first().checks["json_valid"]
    r = q.quality_report(df, ["response"], 1, "structured").first()
    assert r.passed and r.n_bad_json == 2 and "2 rows in 'output' are not valid JSON" in r.warnings
    r = q.quality_report(df, ["response"], 1, "structured", json_columns=["nope", "response"]).first()
    assert r.n_bad_json == 5
    numbers = spark.createDataFrame([(1,)], "output int")
    assert q.quality_report(numbers, [], 0, "structured").first().n_bad_json == 0
    assert q.quality_report(pairs(spark).select("instruction"), [], 0, "structured").first().checks["json_valid"]


def brute_force(rows, names, required, json_name):
    def blank(v):
        return v is None or (isinstance(v, str) and v.strip() == "")

    present = [c for c in required if c in names]
    out = dict.fromkeys(q.COUNTS, 0)
    for row in rows:
        d = dict(zip(names, row))
        out["n_rows"] += 1
        out["n_empty"] += all(blank(d[c]) for c in present)
        a, b = d["instruction"], d["response"]
        out["n_degenerate"] += bool(a and b and a.strip() == b.strip())
        for kind, pattern in PII_PATTERNS.items():
            out[f"n_{kind}"] += sum(bool(re.search(pattern, v)) for v in d.values() if isinstance(v, str))
        if isinstance(d[json_name], str):
            try:
                json.loads(d[json_name])
            except ValueError:
                out["n_bad_json"] += 1
    return out


def test_counts_against_brute_force(spark):
    rng = random.Random(5)
    bits = ["", " ", "x", "{}", '{"a": 1}', "a@b.org", "555 123 4567", "123-45-6789", "\u00a0", None, "{'a'}", "[1]"]
    rows = [
        (rng.randrange(3), rng.choice(bits), rng.choice(bits), rng.choice(bits), rng.choice([None, 1]))
        for _ in range(500)
    ]
    names = ["k", "instruction", "response", "output", "n"]
    df = spark.createDataFrame(rows, "k int, instruction string, response string, output string, n int")
    required = ["instruction", "response", "n", "absent"]
    got = q.quality_counts(df.drop("k"), required, "structured").first().asDict()
    assert got == brute_force([r[1:] for r in rows], names[1:], required, "output")
    again = q.quality_counts(df.drop("k").repartition(9), required, "structured").first().asDict()
    assert again == got
    by = {r.k: r.asDict() for r in q.quality_counts(df, required, "structured", by="k").collect()}
    for k, counts in by.items():
        part = [r[1:] for r in rows if r[0] == k]
        assert {c: counts[c] for c in q.COUNTS} == brute_force(part, names[1:], required, "output")


def test_wide_tables_give_the_same(spark, monkeypatch):
    from tuneloom.functions import text
    from tuneloom.operators import select as sel

    rng = random.Random(6)
    bits = ["", "\u3000", "x", "a@b.org", "555 123 4567", None, "y", "z"]
    rows = [(None if rng.random() < 0.3 else 1, *(rng.choice(bits) for _ in range(6))) for _ in range(300)]
    rows += [(None, *[None] * 6), (None, *[" "] * 6)]
    names = ["n", "instruction", "response", "output", "d", "e", "f"]
    df = spark.createDataFrame(rows, "n int, instruction string, response string, output string, d string, e string, f string")
    want = brute_force(rows, names, names, "output") | {"n_bad_json": 0}
    valid = [r for r in rows if r[0] is not None and all((v or "").strip() for v in r[1:4])]
    for wide in (0, 20):
        monkeypatch.setattr(text, "WIDE", wide)
        assert q.quality_counts(df, names).first().asDict() == want
        kept = ["n", "instruction", "response", "output"]
        assert sorted(map(tuple, sel.drop_blank_rows(df, kept).collect()), key=str) == sorted(valid, key=str)
        assert sel.filter_metrics(df, kept, 1000).first().rows_out == len(valid)
        assert q.quality_counts(df, []).first().n_empty == len(rows)
        assert q.quality_counts(df.select("n"), ["n"]).first().n_empty == sum(r[0] is None for r in rows)


def test_hundreds_of_columns(spark):
    n = 400
    df = spark.range(50).select(*[F.concat(F.lit("a@b.org "), "id").alias(f"c{i}") for i in range(n)])
    r = q.quality_report(df, df.columns, 1).first()
    assert r.passed and r.n_email == 50 * n


def test_long_and_text_form(spark):
    report = q.quality_report(pairs(spark, 3, pii=True), BOTH, 9)
    long = {r.check: (r.severity, r.passed, r.n) for r in q.report_long(report).collect()}
    assert list(long) == q.CHECKS
    assert long["min_row_count"] == ("hard", False, 3) and long["pii_scan"] == ("soft", False, 2)
    lines = q.report_text(report).first().summary.split("\n")
    assert lines[0] == "Validation FAILED — 3/3 rows"
    assert "  ✓ json_valid" in lines and "  ✗ min_row_count" in lines
    assert lines[-2].startswith("  ⚠  Possible PII") and lines[-1].startswith("  ✗ Row count 3")


def test_minimum_rows(spark):
    assert q.default_min_rows(228) == 182 and q.default_min_rows(2000, 1600) == 1600
    assert q.default_min_rows(2000, 0) == 1600
    df = spark.createDataFrame([(228, None), (2000, 0), (2000, 7)], "rows int, m int")
    got = [r.x for r in df.select(q.min_rows_column(F.col("rows"), F.col("m")).alias("x")).collect()]
    assert got == [182, 1600, 7]


def test_limits_per_dataset(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "z")], "id string, t string")
    limits = spark.createDataFrame([("a", 2), ("b", 2)], "id string, m int")
    got = {r.id: r.passed for r in q.quality_report(df, ["t"], F.col("m"), by="id", limits=limits).collect()}
    assert got == {"a": True, "b": False}


def plan(df):
    return df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]


def test_one_aggregation_and_no_python(spark, tmp_path):
    pairs(spark, 50).write.parquet(str(tmp_path / "p"))
    df = spark.read.parquet(str(tmp_path / "p"))
    p = plan(q.quality_report(df, BOTH, 1))
    assert "Python" not in p and "Python" not in plan(q.quality_report(df, BOTH, 1, "structured", exact_json=False))
    assert p.count("Exchange") == 1 and p.count("FileScan") == 1
    exact = plan(q.quality_report(df, BOTH, 1, "structured"))
    assert exact.count("ArrowEvalPython") == 1 and exact.count("FileScan") == 1


@pytest.mark.parametrize("by", [None, "k"])
def test_unused_columns_are_not_read(spark, tmp_path, by):
    df = pairs(spark, 5).withColumn("k", F.lit(1)).withColumn("n", F.lit(2.0))
    df.write.parquet(str(tmp_path / "p"))
    df = spark.read.parquet(str(tmp_path / "p"))
    p = plan(q.quality_report(df, BOTH, 1, by=by))
    assert "n:double" not in p.split("ReadSchema")[1]
