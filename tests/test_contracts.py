import pytest
from pyspark.sql import functions as F

from tuneloom.operators import quality
from tuneloom.operators.contracts import as_cells, contract_report, union_cells

KINDS = "dataset_id string, required array<string>, min_rows long, output_type string, json_columns array<string>"
FIELDS = ["passed", "checks", "warnings", "errors", "rows_in", "rows_out", *quality.COUNTS]


@pytest.fixture(scope="module")
def tables(spark):
    pairs = [("a", "a "), ("a", "b"), (None, " "), ("", ""), ("call 555-123-4567", "x@example.com"), (" ", None)]
    typed = [(1, 0.0, True, ["x"], "{}"), (None, None, None, None, "{broken"), (0, 1.5, False, [], None), (2, 2.0, None, ["y"], "[1]")]
    return {
        "pairs": spark.createDataFrame(pairs, "instruction string, response string"),
        "typed": spark.createDataFrame(typed, "n int, x double, b boolean, l array<string>, `out.put` string"),
        "numbers": spark.createDataFrame([(1, 1), (2, 3)], "instruction int, response int"),
        "json": spark.createDataFrame([("{}", "x"), ("nope", "{}"), (None, "{}")], "response string, completion string"),
        "untyped json": spark.createDataFrame([(1, "{")], "output int, response string"),
        "empty": spark.createDataFrame([], "text string, n int"),
    }


CONTRACTS = [
    ("pairs", ["instruction", "response"], 6, "default", None),
    ("typed", ["n", "x", "b", "l", "out.put", "absent", "lost"], 5, "structured", ["out.put"]),
    ("numbers", ["instruction"], None, None, None),
    ("json", None, 3, "structured", None),
    ("untyped json", ["response"], 1, "structured", None),
    ("empty", ["text", "absent"], 0, "structured", ["text"]),
]


def plain(row):
    return {n: row[n] for n in FIELDS}


def test_same_as_the_report_of_each_dataset(spark, tables):
    contracts = spark.createDataFrame(CONTRACTS, KINDS)
    got = {r.dataset_id: r for r in contract_report(union_cells(tables), contracts).collect()}
    assert set(got) == set(tables)
    for name, required, least, kind, columns in CONTRACTS:
        want = quality.quality_report(
            tables[name], required or tables[name].columns, 1 if least is None else least, kind or "default",
            json_columns=columns or quality.JSON_COLUMNS,
        ).first()
        assert plain(got[name]) == plain(want), name
    assert got["typed"]["missing"] == ["absent", "lost"] and got["json"]["json_name"] == "response"


def test_contracts_without_rows_and_rows_without_a_contract(spark, tables):
    contracts = spark.createDataFrame([("nothing", ["a"], 1, "default", None)], KINDS)
    got = {r.dataset_id: r for r in contract_report(as_cells(tables["pairs"], "pairs"), contracts, default_min=7).collect()}
    assert (got["nothing"].n_rows, got["nothing"].passed, got["nothing"].missing) == (0, False, ["a"])
    assert got["pairs"].n_rows == 6 and not got["pairs"].checks["min_row_count"] and got["pairs"].missing == []
    assert contract_report(as_cells(tables["pairs"], "pairs"), contracts.where("false")).first().passed in (True, False)


def test_contracts_of_few_columns(spark, tables):
    contracts = spark.createDataFrame([("numbers", 3)], "dataset_id string, min_rows int")
    report = contract_report(as_cells(tables["numbers"], "numbers"), contracts).first()
    assert report.errors == ["Row count 2 is below the minimum of 3"]


def test_maps_of_plain_strings(spark):
    rows = [("a", {"text": "x"}), ("a", {"text": " ", "more": "1"}), ("b", {"text": None}), ("b", None)]
    df = spark.createDataFrame(rows, "id string, cells map<string,string>")
    contracts = spark.createDataFrame([("a", ["text", "more"]), ("b", ["text", "more"])], "id string, required array<string>")
    got = {r.id: r for r in contract_report(df, contracts, by="id").collect()}
    assert (got["a"].n_rows, got["a"].n_empty, got["a"].missing) == (2, 0, [])
    assert (got["b"].n_rows, got["b"].missing) == (2, ["more"])


def test_more_required_columns_than_a_word_has_bits(spark):
    names = [f"c{i}" for i in range(150)]
    df = spark.range(3).select(*[F.lit("x").alias(n) for n in names if n not in ("c7", "c62", "c149")])
    contracts = spark.createDataFrame([("wide", names)], "dataset_id string, required array<string>")
    report = contract_report(as_cells(df, "wide"), contracts).first()
    assert report.missing == ["c7", "c62", "c149"] and report.n_empty == 0


def test_counts_are_added_up_before_the_shuffle(spark, tables):
    contracts = spark.createDataFrame(CONTRACTS, KINDS)
    plan = contract_report(union_cells(tables), contracts)._jdf.queryExecution().executedPlan().toString()
    assert "partial_bit_or" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
