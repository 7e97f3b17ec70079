"""Inputs that were once read or judged wrongly."""

import glob
import io
import json
import shutil
import tarfile

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import tuneloom as tl
from tuneloom.operators import generate as gen
from tuneloom.plans import recipes
from tuneloom.sources import archives
from tuneloom.streaming import arrivals


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_folder_with_several_formats(spark, tmp_path):
    write(tmp_path / "d" / "a.csv", "a,b\n1,2\n")
    write(tmp_path / "d" / "b.tsv", "a\tb\n3\t4\n")
    write(tmp_path / "d" / "c.jsonl", '{"a": "5", "c": "6"}\n')
    got = {tuple(r) for r in tl.read_file(spark, str(tmp_path / "d")).select("a", "b", "c").collect()}
    assert got == {("1", "2", None), ("3", "4", None), ("5", None, "6")}


def test_csv_row_longer_than_the_header_is_an_error(spark, tmp_path):
    write(tmp_path / "x.csv", "a,b\n1,2,3\n")
    with pytest.raises(Exception):
        tl.read_file(spark, str(tmp_path / "x.csv")).collect()


def test_head_of_a_path_with_a_space(spark, tmp_path):
    path = str(tmp_path / "with space")
    spark.range(100).repartition(4).write.parquet(path)
    assert tl.read_head(spark, path, 60).count() == 60


def test_limits_without_rows_and_rows_without_limit(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "y")], "id string, text string")
    limits = spark.createDataFrame([("a", 2), ("c", 1), ("d", 0)], "id string, least int")
    report = tl.quality_report(df, ["text"], F.col("least"), by="id", limits=limits)
    got = {r.id: (r.n_rows, r.passed) for r in report.collect()}
    assert got == {"a": (1, False), "b": (1, True), "c": (0, False), "d": (0, True)}


def test_json_ledger_is_valid_as_python_says(spark, tmp_path):
    write(tmp_path / "twice.json", '{"a": {"status": "old"}, "a": {"status": "done"}}')
    write(tmp_path / "after.json", '{"a": {"status": "done"}} tail')
    assert [r.dataset_id for r in tl.ledger_read_json(spark, str(tmp_path / "twice.json")).collect()] == ["a"]
    assert tl.ledger_read_json(spark, str(tmp_path / "after.json")).count() == 0


def test_failed_generation_says_why(spark):
    def broken(prompts):
        raise RuntimeError("no quota")

    df = spark.createDataFrame([("p",)], "p string")
    row = tl.generate(df, F.col("p"), broken, max_attempts=2, backoff=0).first().generation
    assert (row.status, row.error) == ("failed", "RuntimeError: no quota")


AB = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])


def unpacked(spark, folder, name, data):
    folder.mkdir()
    with tarfile.open(folder / "x.tgz", "w:gz") as tar:
        info = tarfile.TarInfo(name)
        info.size = len(data)
        tar.addfile(info, io.BytesIO(data))
    rows = archives.archive_records(archives.scan_archives(spark, str(folder)), AB)
    return sorted((tuple(r) for r in rows.select("a", "b").collect()), key=str)


def test_archive_members_of_all_kinds(spark, tmp_path):
    pretty = b'{\n  "a": "1",\n  "b": "2"\n}\n'
    assert unpacked(spark, tmp_path / "object", "x.json", pretty) == [("1", "2")]
    assert unpacked(spark, tmp_path / "objects", "x.json", pretty * 3) == [("1", "2")] * 3
    assert unpacked(spark, tmp_path / "empty", "x.json", b" [ ] ") == []
    table = io.BytesIO()
    pq.write_table(pa.table({"a": ["1", None], "b": [2, 3]}), table)
    assert unpacked(spark, tmp_path / "parquet", "x.parquet", table.getvalue()) == [("1", "2"), (None, "3")]


@pytest.mark.parametrize(
    "name,text",
    [
        ("x.csv", "a,b\n1,2,3\n"), ("x.csv", "a,b\n1\n"), ("x.jsonl", '{"a": "1"}\n{broken\n'),
        ("x.json", '[{"a": "1"}'), ("x.json", '[{"a": "1"} {"a": "2"}]'), ("x.json", '[{"a": "1"}] tail'), ("x.json", "[1]"),
        ("x.json", '[{"a": "1"},]'),
    ],
)
def test_broken_archive_members_are_errors(spark, tmp_path, name, text):
    with pytest.raises(Exception):
        unpacked(spark, tmp_path / "d", name, text.encode())


@pytest.mark.parametrize("step", [1, 7, 1 << 16])
def test_json_objects_in_any_pieces(step):
    want = ['{"a": [1, "}]"]}', '{"b": {"c": "é, \\" ["}}', "{}"]
    for text in ("[" + ", \n".join(want) + " ]\n", "\n".join(want), "".join(want), " \n" + want[0]):
        got = list(archives.json_objects(io.StringIO(text), "x", step))
        assert got == (want[:1] if text.startswith(" ") else want)


def test_plain_file_where_an_archive_may_be(spark, tmp_path):
    write(tmp_path / "x.tsv", "a\tb\n1\t2\n")
    (tmp_path / "absent").mkdir()
    write(tmp_path / "absent" / "old" / "load.py", "")
    recipe = recipes.Recipe("r", "old", ["a", "b"], data_url=str(tmp_path / "x.tsv"))
    assert [tuple(r) for r in recipes.open_source(spark, recipe, str(tmp_path / "absent")).collect()] == [("1", "2")]


@pytest.mark.parametrize("place", ["one", "one/data", "one/sub", "one/sub/data"])
def test_numbered_files_of_a_split(spark, tmp_path, place):
    for n in range(2):
        write(tmp_path / place / f"train-0000{n}-of-00002.csv", f"a,b\n{n},x\n")
    write(tmp_path / place / "test-00000-of-00001.csv", "a,b\n9,x\n")
    subset = "sub" if "sub" in place else None
    got = tl.read_dataset(spark, str(tmp_path), "one", "train", subset)
    assert sorted(r.a for r in got.collect()) == ["0", "1"]
    assert tl.read_dataset(spark, str(tmp_path), "one", "train", subset, head=1).count() == 1


def test_partitions_that_are_not_there(spark, tmp_path):
    rows = [(1, "x", "train"), (2, "x", "test"), (3, "y", "train")]
    df = spark.createDataFrame(rows, "id int, subset string, split string")
    df.write.partitionBy("subset", "split").parquet(str(tmp_path / "one"))
    assert [r.id for r in tl.read_dataset(spark, str(tmp_path), "one", "train", "y").collect()] == [3]
    for split, subset, category in [("train", None, "subset"), ("train", "z", "subset"), ("test", "y", "split"), ("dev", "x", "split")]:
        with pytest.raises(tl.DatasetReadError) as e:
            tl.read_dataset(spark, str(tmp_path), "one", split, subset)
        assert e.value.category == category


def test_stream_batch_that_fails_is_not_delivered(spark, tmp_path):
    spark.createDataFrame([("same", "same")] * 3, "a string, b string").write.parquet(str(tmp_path / "in"))
    stream = arrivals.read_arrivals(spark, str(tmp_path / "in"), AB)
    run = arrivals.deliver_arrivals(
        stream, ["a", "b", "absent"], str(tmp_path / "out"), str(tmp_path / "check"), str(tmp_path / "ledger"), "s", "now"
    )
    run.awaitTermination(120)
    entry = tl.ledger_read(spark, str(tmp_path / "ledger")).first()
    assert (entry.validation_passed, entry.local_path) == (False, None)
    assert not [p for p in (tmp_path / "out").glob("*") if not p.name.startswith(".")]
    apart = spark.read.parquet(str(tmp_path / "out_quarantine"))
    assert apart.count() == 3 and "batch" in apart.columns
    total = tl.roll_up(tl.ledger_read(spark, str(tmp_path / "ledger"))).first()
    assert (total.dataset_id, total.rows_out, total.validation_passed) == ("s", 0, False)


@pytest.mark.parametrize("layout", ["file", "folder", "nested"])
def test_stream_of_a_table_in_one_file_or_in_folders(spark, tmp_path, layout):
    import __spark_entry__ as entry

    rows = spark.range(0, 30, 1, 3).selectExpr("id AS doc_id", "concat('text ', id) AS text", "'s' AS source", "'en' AS lang")
    at = tmp_path / "documents.parquet"
    if layout == "file":
        rows.coalesce(1).write.parquet(str(tmp_path / "written"))
        shutil.copy(one_file(tmp_path / "written"), at)
    else:
        for part in range(3):
            inside = at / f"{part}" if layout == "nested" else at
            rows.where(f"doc_id % 3 = {part}").write.mode("append").parquet(str(inside))
    got = entry.queries()["stream_arrivals"](spark, str(tmp_path))
    assert sorted(r.doc_id for r in got.collect()) == list(range(30))


@pytest.mark.parametrize("name", ["stream_board", "sharded_scan"])
def test_files_of_a_table_grow_in_number_not_in_size(spark, monkeypatch, name):
    import __spark_entry__ as entry
    from oracle_compare import compare, connect

    sf, written = "/root/testdata/sf0.001", []
    if not glob.glob(f"{sf}/documents.parquet"):
        pytest.skip("no test tables")
    monkeypatch.setattr(entry, "PART_BYTES", 5_000)
    write_parts = entry.write_parts
    monkeypatch.setattr(entry, "write_parts", lambda df, path: written.append((df, path, write_parts(df, path))) or written[-1][2])
    assert compare(spark, connect(sf), name, sf, entry.queries(), entry.oracle_sql()) is None
    ((df, path, parts),) = written
    size = df.selectExpr("sum(octet_length(text))").first()[0]
    assert parts >= size / 5_000 > 3
    if name == "stream_board":
        sizes = spark.read.parquet(path).groupBy("_metadata.file_path").agg(F.sum(F.octet_length("text")).alias("n"))
        assert max(r.n for r in sizes.collect()) < size / 4


def test_stream_of_a_file_with_pattern_letters_in_its_name(spark, tmp_path):
    spark.createDataFrame([("a", "b")], AB).coalesce(1).write.parquet(str(tmp_path / "written"))
    path = tmp_path / "in" / "x{1}[2].parquet"
    path.parent.mkdir()
    shutil.copy(one_file(tmp_path / "written"), path)
    spark.createDataFrame([("c", "d")], AB).write.mode("append").parquet(str(tmp_path / "in"))
    run = arrivals.deliver_arrivals(
        arrivals.read_arrivals(spark, str(path), AB), ["a", "b"], str(tmp_path / "out"), str(tmp_path / "check"),
        str(tmp_path / "ledger"), "s", "now",
    )
    run.awaitTermination(120)
    assert [r.a for r in spark.read.parquet(str(tmp_path / "out")).collect()] == ["a"]


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path):
    """The checkpoint forgets that the batches ended, as after a crash before the commit."""
    import shutil

    spark.range(0, 40, 1, 4).selectExpr("concat('a', id) AS a", "'b' AS b").write.parquet(str(tmp_path / "in"))

    def go():
        stream = arrivals.read_arrivals(spark, str(tmp_path / "in"), AB, max_files=1)
        arrivals.deliver_arrivals(
            stream, ["a", "b"], str(tmp_path / "out"), str(tmp_path / "check"), str(tmp_path / "ledger"), "s", "now"
        ).awaitTermination(120)
        total = tl.roll_up(tl.ledger_read(spark, str(tmp_path / "ledger"))).first()
        return total.dataset_id, total.rows_out, spark.read.parquet(str(tmp_path / "out")).select("a").distinct().count()

    assert go() == ("s", 40, 40)
    commits = tmp_path / "check" / "commits"
    shutil.move(str(commits / "3"), str(tmp_path / "forgotten"))
    if (commits / ".3.crc").exists():
        shutil.move(str(commits / ".3.crc"), str(tmp_path / "forgotten.crc"))
    assert go() == ("s", 40, 40)


def test_json_files_of_one_folder_each_in_its_own_way(spark, tmp_path):
    write(tmp_path / "d" / "a.json", '{"a": "1"}\n{"a": "2"}\n')
    write(tmp_path / "d" / "b.json", '[{"a": "3"}, {"a": "4"}]')
    write(tmp_path / "d" / "c.json", '\n{\n"a": "5"}\n')
    write(tmp_path / "d" / "d.json", '[{"a": "6"},\n{"a": "7", "b": "x"}]\n')
    write(tmp_path / "d" / "e.json", "")
    write(tmp_path / "d" / "f.json", json.dumps({"a": "é" * 100_000}))
    got = sorted(r.a[:1] for r in tl.read_file(spark, str(tmp_path / "d")).collect())
    assert got == ["1", "2", "3", "4", "5", "6", "7", "é"]
    two = tl.read_file(spark, [str(tmp_path / "d" / n) for n in ("a.json", "b.json")])
    assert two.count() == 4
    write(tmp_path / "e" / "a.json", '{"a": "1"}\n{broken\n')
    with pytest.raises(Exception):
        tl.read_file(spark, str(tmp_path / "e")).collect()


def test_head_reads_few_files_of_many(spark, tmp_path):
    path = str(tmp_path / "many")
    spark.range(60).repartition(12).write.parquet(path)
    assert len(tl.read_head(spark, path, 3).inputFiles()) == 1
    assert tl.read_head(spark, path, 60).count() == 60 and tl.read_head(spark, path, 99).count() == 60
    assert tl.read_head(spark, one_file(path), 99).count() < 60


def one_file(folder):
    return glob.glob(f"{folder}/*.parquet")[0]


@pytest.mark.parametrize("kind", ["json", "csv", "parquet"])
def test_format_of_partitions(spark, tmp_path, kind):
    df = spark.createDataFrame([("1", "x", "train"), ("2", "y", "test")], "a string, subset string, split string")
    writer = df.write.partitionBy("subset", "split")
    (writer.option("header", True) if kind == "csv" else writer).format(kind).save(str(tmp_path / "one"))
    assert [r.a for r in tl.read_dataset(spark, str(tmp_path), "one", "test", "y").collect()] == ["2"]


def test_prepare_reads_the_kept_columns_and_the_key(spark, tmp_path):
    rows = [(i, f"q{i}", f"a{i}", "long") for i in range(30)]
    spark.createDataFrame(rows, "id int, q string, a string, text string").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    for key, want in ((["id"], {"id", "q"}), (None, {"q"})):
        for limit in (20_000, 0):
            recipe = recipes.Recipe("r", "t", ["q"], rows=7)
            with pytest.MonkeyPatch.context() as patch:
                patch.setitem(recipes.sample_exact.__globals__, "TOPN_MAX_ROWS", limit)
                made = recipes.prepare(df, recipe, key)
            plan = made._jdf.queryExecution().executedPlan().toString()
            read = plan.split("ReadSchema: struct<")[1].split(">")[0]
            assert {f.split(":")[0] for f in read.split(",")} == want
            assert made.columns == ["q"] and made.count() == 7


def test_replies_are_asked_for_once(spark, tmp_path):
    calls, store = str(tmp_path / "calls"), str(tmp_path / "store")

    def model(mark, broken):
        def reply(prompts):
            with open(calls, "a") as f:
                f.writelines(f"{p}\n" for p in prompts)
            if any(p in broken for p in prompts):
                raise RuntimeError("no")
            return [mark + p for p in prompts]

        return reply

    def asked():
        with open(calls) as f:
            return sorted(f.read().split())

    df = spark.createDataFrame([(i, p) for i, p in enumerate("aabcc")] + [(9, None)], "id int, p string")

    def run(reply):
        made = tl.generate_resumed(df, F.col("p"), reply, store, batch_size=1, max_attempts=1, backoff=0)
        return {r.id: (r.generation.raw, r.generation.status) for r in made.collect()}

    first = run(model("1", {"c"}))
    assert first == {0: ("1a", "ok"), 1: ("1a", "ok"), 2: ("1b", "ok"), 3: ("", "failed"), 4: ("", "failed"), 9: ("1", "ok")}
    assert asked() == ["a", "b", "c"]
    second = run(model("2", set()))
    assert second == {**first, 3: ("2c", "ok"), 4: ("2c", "ok")} and asked() == ["a", "b", "c", "c"]
    assert run(model("3", set())) == second and asked() == ["a", "b", "c", "c"]


def test_replies_of_a_run_that_dies_are_kept(spark, tmp_path):
    store = str(tmp_path / "store")
    df = spark.range(40).selectExpr("id", "string(id) AS p")

    def dies(prompts):
        import time

        if "7" in prompts:
            time.sleep(3)
            raise SystemExit("gone")
        return prompts

    with pytest.raises(Exception):
        tl.generate_resumed(df, F.col("p"), dies, store, batch_size=1, rows_per_task=1)
    kept = gen.stored_replies(spark, store).count()
    assert 0 < kept < 40
    made = tl.generate_resumed(df, F.col("p"), lambda ps: ["x" for _ in ps], store)
    assert made.where("generation.raw = 'x'").count() == 40 - kept
