import os
import json

import pytest
from pyspark.sql import functions as F

from tuneloom.operators import deliver as out
from tuneloom.operators import ledger as led
from tuneloom.sources.registry import read_registry, registry_frame

ENTRIES = [
    {"id": "a", "recipe_target": "t1", "project": "p1", "status": "pending", "known_issues": ["x", "y"], "repo": "r/a", "output_name": "org/a-2k"},
    {"id": "b", "recipe_target": "t1", "project": "p2", "status": "ready", "known_issues": []},
    {"id": "c", "recipe_target": "t2", "project": "p1", "status": "complete"},
    {"id": "d", "recipe_target": "t2", "project": "P2", "status": None, "augmentation_llm": "local", "augmentation": "text_generation"},
]


@pytest.fixture()
def registry(spark):
    return registry_frame(spark, ENTRIES)


@pytest.fixture()
def ledger(spark):
    rows = [
        ("a", True, "2024-05-06T07:08:09+00:00", 10, "keep"),
        ("b", False, "2024-05-06T07:08:09+00:00", 5, "keep"),
        ("d", True, None, None, "keep"),
    ]
    return spark.createDataFrame(
        rows, "dataset_id string, validation_passed boolean, processed_at string, rows_out long, extra string"
    )


def ids(df, name="id"):
    return sorted(r[name] for r in df.collect())


def test_lookup_and_completed(ledger):
    assert led.ledger_get(ledger, "b").first().rows_out == 5
    assert led.ledger_get(ledger, "zz").isEmpty()
    wanted = ledger.select("dataset_id").where("dataset_id > 'a'")
    assert ids(led.ledger_get(ledger, wanted), "dataset_id") == ["b", "d"]
    assert ids(led.completed(ledger), "dataset_id") == ["a"]


def test_skip_completed(registry, ledger):
    assert ids(led.skip_completed(registry, ledger)) == ["b", "c", "d"]
    assert ids(led.skip_completed(registry, ledger, force=True)) == ["a", "b", "c", "d"]


def test_select_targets(registry):
    select = led.select_targets
    assert ids(select(registry, dataset_id="b", recipe_target="t2")) == ["b"]
    assert ids(select(registry, recipe_target="t2", project="p1")) == ["c", "d"]
    assert ids(select(registry, project="p1")) == ["a", "c"]
    assert ids(select(registry, all_datasets=True)) == ["a", "b", "d"]
    assert ids(select(registry, all_datasets=True, force=True)) == ["a", "b", "c", "d"]
    with pytest.raises(ValueError):
        select(registry)


def test_status_board(registry, ledger):
    got = {r.id: (r.status, r.rows_out, r.processed_at, r.known_issues) for r in led.status_board(registry, ledger).collect()}
    assert got == {
        "a": ("complete", "10", "2024-05-06", "x, y"),
        "b": ("ready", "—", "—", "none"),
        "c": ("pending", "—", "—", "none"),
        "d": ("complete", "—", "", "none"),
    }


def test_upsert_merges_fields(spark, ledger):
    update = spark.createDataFrame([("a", None, "new"), ("n", 3, "new")], "dataset_id string, rows_out int, owner string")
    merged = led.ledger_upsert(ledger, update)
    got = {r.dataset_id: r for r in merged.collect()}
    assert merged.schema["rows_out"].dataType.typeName() == "long"
    assert set(got) == {"a", "b", "d", "n"}
    assert (got["a"].rows_out, got["a"].owner, got["a"].extra, got["a"].validation_passed) == (None, "new", "keep", True)
    assert (got["b"].rows_out, got["b"].owner) == (5, None)
    assert (got["n"].rows_out, got["n"].extra, got["n"].validation_passed) == (3, None, None)
    again = led.ledger_upsert(merged, update)
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, merged.collect()), key=str)


def test_changes(spark, ledger, tmp_path):
    root = str(tmp_path / "ledger")
    assert led.ledger_read(spark, root).isEmpty()
    led.ledger_write(ledger, root)
    held = led.ledger_read(spark, root)
    update = spark.createDataFrame([("z", 1)], "dataset_id string, rows_out long")
    led.ledger_write(led.ledger_upsert(led.ledger_read(spark, root), update), root)
    assert ids(led.ledger_read(spark, root), "dataset_id") == ["a", "b", "d", "z"]
    for _ in range(15):
        led.ledger_write(led.ledger_read(spark, root), root)
    assert ids(held, "dataset_id") == ["a", "b", "d"]  # nothing goes under a reader
    assert ids(led.ledger_read(spark, root), "dataset_id") == ["a", "b", "d", "z"]
    assert not [p for p in (tmp_path / "ledger").iterdir() if p.name.startswith("_staged")]


def test_two_writers_lose_nothing(spark, tmp_path):
    root = str(tmp_path / "ledger")
    led.ledger_write(spark.createDataFrame([("a", 1, "x")], "dataset_id string, rows_in long, repo string"), root)
    seen = [led.ledger_read(spark, root), led.ledger_read(spark, root)]
    assert [f.count() for f in seen] == [1, 1]
    led.ledger_write(spark.createDataFrame([("a", None)], "dataset_id string, repo string"), root)
    led.ledger_write(spark.createDataFrame([("a", 5), ("b", 2)], "dataset_id string, rows_out int"), root)
    want = {"a": (1, 5, None), "b": (None, 2, None)}
    for _ in range(2):
        now = led.ledger_read(spark, root)
        assert now.columns == led.LEDGER_SCHEMA.names
        assert {r.dataset_id: (r.rows_in, r.rows_out, r.repo) for r in now.collect()} == want
        led.ledger_write(now, f"{root}-once")
        root = f"{root}-once"  # put together by an ordinary rewrite
    assert len(list((tmp_path / "ledger-once").iterdir())) == 1


def test_updates_of_many_rows_and_unfinished_ones(spark, tmp_path):
    root = str(tmp_path / "ledger")
    for n in range(5):
        rows = spark.range(0, 200, 1, 8).selectExpr("concat('d', id) AS dataset_id", f"id * {n} AS rows_out")
        path = led.ledger_write(rows, root)
    assert len(list((tmp_path / "ledger").glob("*/part-*"))) > 5 * 4  # by as many tasks as the update has
    assert {r.dataset_id: r.rows_out for r in led.ledger_read(spark, root).collect()} == {f"d{i}": 4 * i for i in range(200)}
    os.remove(f"{path}/_SUCCESS")  # a write that has not ended
    assert {r.rows_out for r in led.ledger_read(spark, root).where("dataset_id = 'd7'").collect()} == {21}


def test_batches_of_a_stream_add_up(spark):
    rows = [
        ("a/0", 0, "/x/a/batch=0", 5, True, "2024-01-01"), ("a/1", 1, "/x/a/batch=1", 7, True, "2024-01-03"),
        ("b/0", 0, "/x/b/batch=0", 5, True, "2024-01-01"), ("b/12", 12, None, 9, False, "2024-01-02"),
        ("c", None, "/x/c", 3, True, "2024-01-01"), ("c/0", 0, "/x/c/batch=0", 4, True, "2024-01-05"),
        ("org/7", None, "/x/7", 1, True, None), ("d", None, None, None, None, None),
    ]
    kinds = "dataset_id string, batch long, local_path string, rows_out long, validation_passed boolean, processed_at string"
    df = spark.createDataFrame(rows, kinds)
    got = {r.dataset_id: (r.rows_out, r.validation_passed, r.processed_at) for r in led.roll_up(df).collect()}
    assert got == {
        "a": (12, True, "2024-01-03"), "b": (5, False, "2024-01-02"), "c": (7, True, "2024-01-05"),
        "org/7": (1, True, None), "d": (None, False, None),
    }
    assert led.roll_up(df).where("dataset_id = 'a'").first().local_path == "/x/a"
    assert led.roll_up(df.drop("batch")).count() == 8
    names = ["a", "b", "c", "org/7", "d", "e"]
    entries = spark.createDataFrame([(n, None, "p", "t", None) for n in names], "id string, status string, project string, recipe_target string, known_issues array<string>")
    board = {r.id: (r.status, r.rows_out) for r in led.status_board(entries, df).collect()}
    assert board["a"] == ("complete", "12") and board["b"] == ("pending", "—") and board["e"] == ("pending", "—")
    assert {r.id for r in led.skip_completed(entries, df).collect()} == {"b", "org/7", "d", "e"}


def test_json_ledger(spark, tmp_path):
    path = tmp_path / "ledger.json"
    assert led.ledger_read_json(spark, str(path)).isEmpty()
    for bad in ("", "  \n", "{broken"):
        path.write_text(bad)
        assert led.ledger_read_json(spark, str(path)).isEmpty()
    entry = {
        "source": "x/y", "rows_in": 3, "validation_passed": True, "processed_at": "2024", "note": "n",
        "known_issues_resolved": ["i"],
    }
    path.write_text(json.dumps({"one": entry, "two": {"rows_out": None}}, indent=2))
    got = {r.dataset_id: r for r in led.ledger_read_json(spark, str(path), {"source": "repo"}).collect()}
    assert got["one"].repo == "x/y" and got["one"].rows_in == 3 and got["one"].validation_passed is True
    assert got["one"].known_issues_resolved == ["i"] and got["one"].extra == {"note": "n"}
    assert got["two"].rows_out is None and got["two"].repo is None


def test_save_json_lines(spark, ledger, tmp_path):
    led.ledger_save(ledger, str(tmp_path / "l"))
    lines = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "l")).collect()]
    d = next(x for x in lines if x["dataset_id"] == "d")
    assert d["rows_out"] is None and d["extra"] == "keep"


def test_tally(spark):
    results = spark.createDataFrame([("a", "success"), ("b", "failed"), ("c", "failed")], "dataset_id string, status string")
    assert {r.status: r.n for r in led.run_tally(results).collect()} == {"success": 1, "failed": 2}
    assert ids(led.failed(results), "dataset_id") == ["b", "c"]


def test_provenance(spark, registry):
    results = spark.createDataFrame(
        [("a", "/p", None, 4, 4, "none", True, "now"), ("d", "/q", "t", 4, 4, "text_generation", True, "now")],
        "dataset_id string, local_path string, published_to string, rows_in int, rows_out int, augmentation string,"
        " validation_passed boolean, processed_at string",
    )
    got = {r.dataset_id: r for r in led.provenance(registry, results).collect()}
    assert set(got) == {"a", "d"} and got["a"].known_issues_resolved == ["x", "y"]
    assert got["a"].augmentation_llm is None and got["d"].augmentation_llm == "local"
    assert led.provenance(registry, results).schema.names == led.LEDGER_SCHEMA.names


def test_cards(spark, registry, tmp_path):
    results = spark.createDataFrame(
        [("a", "/p", None, 4, 4, "none", True, "2024-05-06T07")],
        "dataset_id string, local_path string, published_to string, rows_in int, rows_out int, augmentation string,"
        " validation_passed boolean, processed_at string",
    )
    cards = out.dataset_cards(led.provenance(registry, results))
    card = cards.first().card
    assert card.startswith("---\nlicense: cc-by-4.0\ntags:\n  - p1\n  - t1\n---\n\n# a-2k\n")
    assert "| Rows | 4 |\n" in card and "| Processed | 2024-05-06 |\n" in card
    out.write_cards(cards, str(tmp_path / "cards"))
    again = spark.read.text(str(tmp_path / "cards" / "dataset_id=a"), wholetext=True).first().value
    assert again.rstrip("\n") == card.rstrip("\n")


def test_registry_file(spark, tmp_path):
    path = tmp_path / "r.yaml"
    path.write_text("datasets:\n  - id: a\n    source: x/y\n    rows: 5\n    columns_keep: [q]\n    owner_project: p\n")
    row = read_registry(spark, str(path), {"source": "repo", "owner_project": "project"}).first()
    assert (row.id, row.repo, row.rows, row.random_seed, row.split, row.columns_keep, row.project) == ("a", "x/y", 5, 42, "train", ["q"], "p")
    for text in ("", "other: 1\n", "datasets:\n"):
        path.write_text(text)
        assert read_registry(spark, str(path)).isEmpty()


def test_join_kind(registry, ledger):
    plan = led.skip_completed(registry, ledger)._jdf.queryExecution().toString()
    assert "LeftAnti" in plan and "Cartesian" not in plan


def test_null_flag_is_not_completed(spark):
    df = spark.createDataFrame([("a", None, "x")], "dataset_id string, validation_passed boolean, processed_at string")
    assert df.select(led.is_completed()).first()[0] is False
    assert led.completed(df).agg(F.count("*")).first()[0] == 0
