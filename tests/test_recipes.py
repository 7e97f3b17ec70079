import json
import os

import pytest
from pyspark.sql import functions as F

from tuneloom.operators import deliver as out
from tuneloom.operators import ledger as led
from tuneloom.operators import quality as q
from tuneloom.plans import recipes as rec
from tuneloom.sources.registry import registry_frame
from tuneloom.streaming import arrivals

NOW = "2024-01-02T03:04:05+00:00"


def files(path):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def pairs(spark, n=20):
    return spark.range(n).selectExpr("id", "concat('Q', id) AS question", "concat('A', id) AS answer", "if(id % 5 = 0, null, 'c') AS context")


def test_deliver_and_rescan(spark, tmp_path):
    df = pairs(spark)
    result = out.deliver(df, str(tmp_path), "05-x", "one", NOW, publish_to=str(tmp_path / "second")).first()
    assert result.asDict() == {
        "dataset_id": "one", "local_path": f"{tmp_path}/05-x/one.parquet", "published_to": str(tmp_path / "second"),
        "published": True, "rows": 20, "processed_at": NOW,
    }
    assert sorted(out.rescan(spark, result.local_path).collect()) == sorted(df.collect())
    assert spark.read.parquet(str(tmp_path / "second")).count() == 20
    assert all("snappy" in f for f in files(result.local_path))
    with pytest.raises(FileNotFoundError):
        out.rescan(spark, str(tmp_path / "nothing"))


def test_failed_publish_keeps_the_first_copy(spark, tmp_path):
    blocked = tmp_path / "file"
    blocked.write_text("x")
    result = out.deliver(pairs(spark), str(tmp_path), "s", "one", NOW, publish_to=f"{blocked}/below").first()
    assert result.published is False and spark.read.parquet(result.local_path).count() == 20


def test_publish_to_a_table(spark, tmp_path):
    out.write_snappy(pairs(spark), str(tmp_path / "p"))
    assert out.publish(spark, str(tmp_path / "p"), "published_pairs")
    assert spark.table("published_pairs").count() == 20
    spark.sql("DROP TABLE published_pairs")


def test_counts_while_writing(spark, tmp_path):
    counted = out.write_snappy(
        pairs(spark).repartition(7), str(tmp_path / "p"), 2, F.count_if(F.col("context").isNull()).alias("n_null")
    )
    assert counted == {"n_rows": 20, "n_null": 4}
    assert len(files(tmp_path / "p")) >= 10


RECIPE = rec.Recipe("sql", "sql", ["question", "context", "answer"], rows=10, local_subdir="05", recipe_target="text_to_sql")


def test_run_recipe(spark, tmp_path):
    result = rec.run_recipe(pairs(spark), RECIPE, str(tmp_path), NOW, key=["id"])
    kept = rec.recipe_frame(pairs(spark), RECIPE, key=["id"])
    delivered = out.rescan(spark, result["local_path"])
    assert result["status"] == "success" and result["rows_out"] == kept.count() == delivered.count()
    assert sorted(delivered.collect()) == sorted(kept.collect())
    assert delivered.columns == ["question", "answer", "context"]


def test_failed_recipe_delivers_nothing(spark, tmp_path):
    strict = rec.replace(RECIPE, min_rows_output=10)  # blank contexts leave fewer
    result = rec.run_recipe(pairs(spark), strict, str(tmp_path), NOW, key=["id"])
    assert result["status"] == "failed" and "below the minimum" in result["message"]
    assert files(tmp_path) == [] and "local_path" not in result
    strict = rec.replace(RECIPE, columns_keep=["question", "absent"])
    assert rec.run_recipe(pairs(spark), strict, str(tmp_path), NOW)["status"] == "failed"


def test_failed_run_leaves_the_old_delivery(spark, tmp_path):
    first = rec.run_recipe(pairs(spark), RECIPE, str(tmp_path), NOW, key=["id"])
    rec.run_recipe(pairs(spark), rec.replace(RECIPE, min_rows_output=99), str(tmp_path), NOW, key=["id"])
    assert out.rescan(spark, first["local_path"]).count() == first["rows_out"]


def test_model_is_called_once_per_row(spark, tmp_path):
    calls = str(tmp_path / "calls")

    def reply(prompts):
        with open(calls, "a") as f:
            f.write("x" * len(prompts))
        return ["Instruction: made" for _ in prompts]

    df = spark.range(30).selectExpr("id", "concat('A', id) AS response")
    recipe = rec.replace(rec.RECIPES["instruction_from_answer"], columns_keep=["response"], rows=30)
    result = rec.run_recipe(df, recipe, str(tmp_path / "out"), NOW, reply, ["id"], parallelism=3)
    assert result["status"] == "success" and result["rows_out"] == 30
    assert len(open(calls).read()) == 30
    assert len(files(result["local_path"])) == 1  # not one per caller
    rows = out.rescan(spark, result["local_path"]).collect()
    assert {r.instruction for r in rows} == {"made"}


def test_report_made_while_writing_is_the_report(spark, tmp_path):
    df = spark.createDataFrame(
        [("a@b.org", "x", "{}"), ("same", "same", "{"), (None, " ", "[1]")], "instruction string, response string, structured_json string"
    )
    recipe = rec.replace(rec.RECIPES["structured_output"], columns_keep=["instruction", "response"], rows=3)
    made = out.write_checked(
        df.repartition(3), str(tmp_path / "p"), recipe.columns_keep, recipe.min_rows, recipe.output_type, recipe.json_columns
    )
    plain = q.quality_report(df, recipe.columns_keep, recipe.min_rows, "structured", json_columns=recipe.json_columns)
    assert made.first().asDict() == plain.first().asDict()
    assert made.first().n_bad_json == 1
    assert spark.read.parquet(str(tmp_path / "p")).columns == df.columns


def test_failed_batches_are_counted(spark, tmp_path):
    def reply(prompts):
        if "A7." in "".join(prompts):
            raise RuntimeError("down")
        return ["Instruction: i"] * len(prompts)

    df = spark.range(30).selectExpr("id", "concat('A', id, '.') AS response")
    recipe = rec.replace(rec.RECIPES["instruction_from_answer"], columns_keep=["response"], rows=30)
    options = {"batch_size": 5, "backoff": 0.0, "parallelism": 2}
    result = rec.run_recipe(df, recipe, str(tmp_path), NOW, reply, ["id"], **options)
    assert result["status"] == "success" and result["rows_failed"] == 5
    assert result["failure_reasons"] == [("RuntimeError: down", 5)]
    rows = out.rescan(spark, result["local_path"]).collect()
    assert rows[0].asDict().keys() == {"response", "instruction"} and sum(r.instruction == "" for r in rows) == 5
    strict = rec.replace(recipe, columns_keep=["response"], id="strict")
    kept = rec.run_recipe(df, strict, str(tmp_path), NOW, reply, ["id"], status=True, **options)
    delivered = out.rescan(spark, kept["local_path"])
    assert delivered.where("generation_status = 'failed'").count() == 5


def test_reasons_of_failures(spark, tmp_path):
    def reply(prompts):
        n = int(prompts[0].split("#")[1])
        if n % 3 == 0:
            raise ValueError("a very long story " * 100)
        if n % 3 == 1:
            raise KeyError(f"no {n % 2}")
        return [None]

    df = spark.range(60).selectExpr("id", "concat('A#', id, '#') AS response")
    recipe = rec.replace(rec.RECIPES["instruction_from_answer"], columns_keep=["response"], rows=60)
    result = rec.run_recipe(
        df, recipe, str(tmp_path), NOW, reply, ["id"], batch_size=1, max_attempts=1, backoff=0.0, template="{response}"
    )
    why = dict(result["failure_reasons"])
    assert result["rows_failed"] == 40 and sum(why.values()) == 40
    assert {k[:20]: n for k, n in why.items()} == {"ValueError: a very l": 20, "KeyError: 'no 0'": 10, "KeyError: 'no 1'": 10}
    assert max(map(len, why)) <= 300
    none = rec.run_recipe(df, rec.replace(RECIPE, columns_keep=["response"], rows=60), str(tmp_path), NOW, key=["id"])
    assert none["failure_reasons"] == []
    frame = rec._results_frame(spark, [result, none])
    assert frame.where("dataset_id = 'instruction-from-answer'").selectExpr("inline(failure_reasons)").count() == 3


def test_unknown_augmentation_passes_through(spark, tmp_path):
    odd = rec.replace(RECIPE, augmentation="not_a_real_type")
    result = rec.run_recipe(pairs(spark), odd, str(tmp_path), NOW, key=["id"])
    assert result["status"] == "success" and result["augmentation"] == "none"


def test_the_five_recipes():
    assert set(rec.RECIPES) == {"instruction_from_answer", "text_generation", "structured_output", "text_to_sql", "text_to_python"}
    assert rec.RECIPES["structured_output"].output_type == "structured"
    assert rec.RECIPES["text_to_sql"].output_type == "default" and rec.RECIPES["text_to_sql"].min_rows == 1600


@pytest.fixture()
def world(spark, tmp_path):
    root = str(tmp_path / "root")
    pairs(spark).drop("context").write.parquet(f"{root}/one/train.parquet")
    pairs(spark).write.parquet(f"{root}/two.parquet")
    os.makedirs(f"{root}/legacy")
    open(f"{root}/legacy/load.py", "w").close()
    pairs(spark).drop("context").toPandas().to_csv(f"{root}/legacy/data-full.csv", index=False)
    entries = [
        {"id": "one", "repo": "one", "columns_keep": ["question", "answer"], "rows": 10, "recipe_target": "t", "project": "p",
         "output_name": "o/one", "local_subdir": "s", "known_issues": ["k"], "augmentation": "instruction_from_answer", "augmentation_llm": "m"},
        {"id": "two", "repo": "two", "columns_keep": ["question", "context"], "rows": 20, "min_rows_output": 20, "recipe_target": "t",
         "project": "p2", "output_name": "o/two", "local_subdir": "s"},
        {"id": "legacy", "repo": "legacy", "columns_keep": ["question"], "rows": 15, "recipe_target": "u", "project": "p",
         "output_name": "o/legacy", "local_subdir": "s"},
        {"id": "gone", "repo": "gone", "columns_keep": ["question"], "rows": 15, "recipe_target": "u", "project": "p2",
         "output_name": "o/gone", "local_subdir": "s"},
        {"id": "old", "repo": "two", "columns_keep": ["question"], "rows": 15, "recipe_target": "u", "project": "p2", "status": "complete"},
    ]
    return registry_frame(spark, entries), root, str(tmp_path / "ledger"), str(tmp_path / "out")


def run(spark, world, **options):
    registry, root, ledger, base = world
    generators = {"instruction_from_answer": lambda prompts: ["Instruction: i"] * len(prompts)}
    options = {"answer": "answer", **options}
    results = rec.run_registry(spark, registry, ledger, root, base, NOW, generators, **options)
    return {r.dataset_id: r for r in results.collect()}


def test_registry_run(spark, world, tmp_path):
    registry, _, ledger_root, _ = world
    got = run(spark, world, all_datasets=True, publish_base=str(tmp_path / "pub"))
    assert {k: r.status for k, r in got.items()} == {"one": "success", "two": "failed", "legacy": "success", "gone": "failed"}
    assert "below the minimum" in got["two"].message and "not found" in got["gone"].message
    ledger = led.ledger_read(spark, ledger_root)
    entries = {r.dataset_id: r for r in ledger.collect()}
    assert set(entries) == {"one", "legacy"}
    assert entries["one"].augmentation == "instruction_from_answer" and entries["one"].augmentation_llm == "m"
    assert entries["one"].known_issues_resolved == ["k"] and entries["one"].rows_out == 10
    assert spark.read.parquet(entries["one"].published_to).count() == 10
    card = spark.read.text(f"{entries['one'].published_to}/_card", wholetext=True).first().value
    assert "# one\n" in card and "| Rows | 10 |" in card

    again = run(spark, world, all_datasets=True)
    assert {k: r.status for k, r in again.items()} == {"one": "skipped", "two": "failed", "legacy": "skipped", "gone": "failed"}
    forced = run(spark, world, dataset_id="one", force=True, augment_rows=False)
    assert forced["one"].status == "success"
    entry = led.ledger_get(led.ledger_read(spark, ledger_root), "one").first()
    assert entry.augmentation == "none" and entry.augmentation_llm is None
    assert "instruction" not in out.rescan(spark, entry.local_path).columns

    report = rec.revalidate(spark, ledger, "legacy", registry).first()
    assert report.passed and report.rows_out == 15
    assert rec.revalidate(spark, ledger, "one").first().passed
    assert rec.republish(spark, ledger, "legacy", str(tmp_path / "again"))
    assert spark.read.parquet(str(tmp_path / "again")).count() == 15
    with pytest.raises(LookupError):
        rec.revalidate(spark, ledger, "two")
    with pytest.raises(LookupError):
        rec.republish(spark, ledger, "two", "x")


def test_registry_selection(spark, world):
    assert set(run(spark, world, project="p", recipe_target=None)) == {"one", "legacy"}
    with pytest.raises(LookupError):
        run(spark, world, recipe_target="nope")
    with pytest.raises(LookupError):
        run(spark, world, dataset_id="nope")


def test_preview_writes_nothing(spark, world):
    registry, root, _, base = world
    recipe = rec.recipe_of(registry.where("id = 'one'").first())
    shown = rec.preview_dataset(spark, recipe, root, ["id"])
    assert shown.count() == 3 and shown.columns == ["question", "answer"] and not os.path.exists(base)


def test_archive_is_the_last_resort(spark, tmp_path):
    import io
    import tarfile

    os.makedirs(tmp_path / "root" / "only_script")
    open(tmp_path / "root" / "only_script" / "load.py", "w").close()
    with tarfile.open(tmp_path / "a.tgz", "w:gz") as tar:
        data = b"post,other\nhello,1\n,2\n"
        info = tarfile.TarInfo("x/t.trn.csv")
        info.size = len(data)
        tar.addfile(info, io.BytesIO(data))
    recipe = rec.Recipe("x", "only_script", ["post"], data_url=str(tmp_path / "a.tgz"), data_url_file="t.trn.csv")
    df = rec.open_source(spark, recipe, str(tmp_path / "root"))
    assert [tuple(r) for r in rec.prepare(df, recipe).collect()] == [("hello",)]
    with pytest.raises(Exception, match="no loadable data files"):
        rec.open_source(spark, rec.replace(recipe, data_url=None), str(tmp_path / "root"))


def test_stream_with_augmentation(spark, tmp_path):
    source, base = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(30).selectExpr("concat('A', id) AS response").write.parquet(source)
    stream = arrivals.read_arrivals(spark, source, spark.read.parquet(source).schema, max_files=1)
    arrivals.deliver_arrivals(
        stream, ["response", "absent"], f"{base}/data", f"{base}/checkpoint", f"{base}/ledger", "x", NOW,
        kind="instruction_from_answer", generator=lambda prompts: ["Instruction: i"] * len(prompts),
        deliver_failed=True,
    ).awaitTermination()
    rows = spark.read.parquet(f"{base}/data").collect()
    assert len(rows) == 30 and {r.instruction for r in rows} == {"i"}
    entries = led.ledger_read(spark, f"{base}/ledger").collect()
    assert sum(r.rows_out for r in entries) == 30
    assert {(r.augmentation, r.validation_passed) for r in entries} == {("instruction_from_answer", False)}


def test_stream(spark, tmp_path):
    source, base = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "id long, text string, extra string"

    def add(lo, hi):
        df = spark.range(lo, hi).selectExpr("id", "if(id % 3 = 0, ' ', concat('mail a', id, '@b.org')) AS text", "'e' AS extra")
        df.coalesce(1).write.mode("append").json(source)

    def go():
        stream = arrivals.read_arrivals(spark, source, spark.createDataFrame([], schema).schema, "json", "*.json")
        run_ = arrivals.deliver_arrivals(
            stream, ["text", "id"], f"{base}/data", f"{base}/checkpoint", f"{base}/ledger", "mails", lambda n: f"at {n}"
        )
        run_.awaitTermination()
        return spark.read.parquet(f"{base}/data")

    add(0, 6)
    assert sorted(r.id for r in go().collect()) == [1, 2, 4, 5]
    assert go().count() == 4  # nothing new, nothing read twice
    add(6, 9)
    rows = go().collect()
    assert sorted(r.id for r in rows) == [1, 2, 4, 5, 7, 8] and all(r.has_email and not r.has_ssn for r in rows)
    entries = {r.dataset_id: (r.rows_out, r.processed_at) for r in led.ledger_read(spark, f"{base}/ledger").collect()}
    assert entries == {"mails/0": (4, "at 0"), "mails/1": (2, "at 1")}
    assert len(json.dumps(sorted(os.listdir(source)))) > 0  # source files stay
    assert len([f for f in os.listdir(source) if f.endswith(".json")]) == 2
