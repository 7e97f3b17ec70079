import csv
import io
import json
import tarfile

import pytest
from pyspark.sql import types as T

from tuneloom.sources import archives, listing, readers, storage

ROWS = [("a,b", 'say "x"', "1.0"), ("line\nbreak", "tab\there", "2"), ("é文", "plain", "")]
TEXTS = T.StructType([T.StructField(c, T.StringType()) for c in "xyz"])


def table_text(sep):
    f = io.StringIO(newline="")
    w = csv.writer(f, delimiter=sep)
    w.writerow("xyz")
    w.writerows(ROWS)
    return f.getvalue()


def expected():
    return sorted((x, y, z or None) for x, y, z in ROWS)


def got(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("ext,sep", [(".csv", ","), (".tsv", "\t"), (".CSV", ",")])
def test_delimited(spark, tmp_path, ext, sep):
    (tmp_path / f"f{ext}").write_text(table_text(sep), newline="")
    df = readers.read_file(spark, str(tmp_path / f"f{ext}"))
    assert got(df) == expected()
    assert {t for _, t in df.dtypes} == {"string"}  # never cast on its own


@pytest.mark.parametrize(
    "name,text",
    [
        ("f.jsonl", '{"a": 1}\n{"a": 2}\n'),
        ("f.json", '{"a": 1}\n{"a": 2}\n'),
        ("f.json", '[{"a": 1}, {"a": 2}]'),
        ("f.json", '\n[\n  {"a": 1},\n  {"a": 2}\n]\n'),
    ],
)
def test_json(spark, tmp_path, name, text):
    (tmp_path / name).write_text(text)
    assert sorted(r.a for r in readers.read_file(spark, str(tmp_path / name)).collect()) == [1, 2]


def test_json_object_over_lines_and_broken(spark, tmp_path):
    (tmp_path / "f.json").write_text('{\n  "a": 1\n}\n')
    assert [r.a for r in readers.read_file(spark, str(tmp_path / "f.json")).collect()] == [1]
    (tmp_path / "g.jsonl").write_text('{"a": 1}\n{broken\n')
    with pytest.raises(Exception):
        readers.read_file(spark, str(tmp_path / "g.jsonl"), "a int").collect()


@pytest.mark.parametrize("codec", ["zstd", "snappy", "gzip"])
def test_parquet_codecs(spark, tmp_path, codec):
    path = str(tmp_path / "f.parquet")
    spark.range(5).write.option("compression", codec).parquet(path)
    assert readers.read_file(spark, path).count() == 5


def test_unknown_extension(spark, tmp_path):
    (tmp_path / "f.xlsx").write_text("x")
    with pytest.raises(ValueError, match="Cannot load file type '.xlsx'"):
        readers.read_file(spark, str(tmp_path / "f.xlsx"))


def test_named_datasets(spark, tmp_path):
    root = str(tmp_path)
    spark.range(3).write.parquet(f"{root}/org/one/train.parquet")
    spark.range(4).write.json(f"{root}/org/two/sub/test")
    spark.range(6).selectExpr("id", "if(id < 2, 'train', 'test') AS split").write.partitionBy("split").parquet(f"{root}/three")
    spark.range(7).write.parquet(f"{root}/four.parquet")
    read = readers.read_dataset
    assert read(spark, root, "org/one").count() == 3
    assert read(spark, root, "org/one", head=2).count() == 2
    assert read(spark, root, "three", "test", head=3).count() == 3
    assert read(spark, root, "org/two", "test", "sub", schema="id long").count() == 4
    assert read(spark, root, "four").count() == 7
    three = read(spark, root, "three", "test")
    assert three.columns == ["id"] and three.count() == 4
    assert "PartitionFilters: [isnotnull(split" in three._jdf.queryExecution().toString()


def test_head_reads_few_files(spark, tmp_path):
    path = str(tmp_path / "many.parquet")
    spark.range(0, 200, 1, 20).write.parquet(path)  # 20 files of 10 rows
    for n, files in ((5, 1), (10, 1), (11, 4), (41, 16), (190, 20), (500, 20)):
        df = readers.read_head(spark, path, n)
        assert df.count() == min(n, 200) and len(df.inputFiles()) == files
        assert df.distinct().count() == min(n, 200)
    spark.range(0, 30, 1, 3).write.json(str(tmp_path / "l.jsonl"))
    assert readers.read_head(spark, str(tmp_path / "l.jsonl"), 12, "id long").count() == 12
    spark.range(0).write.parquet(str(tmp_path / "none.parquet"))
    assert readers.read_head(spark, str(tmp_path / "none.parquet"), 5).count() == 0


def test_catalog_table(spark):
    """Partition columns choose rows; a data column that happens to be called split is one like any other."""
    rows = spark.range(6).selectExpr("id", "if(id < 2, 'train', 'test') AS split", "'x' AS subset")
    rows.write.mode("overwrite").saveAsTable("six_rows")
    rows.write.mode("overwrite").partitionBy("split").saveAsTable("six_parted")
    try:
        df = readers.read_dataset(spark, None, "six_rows")
        assert df.columns == ["id", "split", "subset"] and df.count() == 6
        df = readers.read_dataset(spark, None, "six_parted", "test", "anything")
        assert df.columns == ["id", "subset"] and df.count() == 4
        with pytest.raises(readers.DatasetReadError, match="split 'dev'") as e:
            readers.read_dataset(spark, None, "six_parted", "dev")
        assert e.value.category == "split"
    finally:
        spark.sql("DROP TABLE six_rows")
        spark.sql("DROP TABLE six_parted")


def test_read_errors(spark, tmp_path):
    root = str(tmp_path)
    spark.range(3).write.parquet(f"{root}/one/train.parquet")
    cases = [
        (("absent",), "not_found"), (("one", "test"), "split"), (("one", "train", "sub"), "subset"),
    ]
    for args, category in cases:
        with pytest.raises(readers.DatasetReadError) as e:
            readers.read_dataset(spark, root, *args)
        assert e.value.category == category and "→" in str(e.value)


def test_absent_table(spark):
    with pytest.raises(readers.DatasetReadError) as e:
        readers.read_dataset(spark, None, "no_such_table")
    assert e.value.category == "not_found"


def test_fallback_order(spark):
    log = []

    def source(name, error=None):
        def open_():
            log.append(name)
            if error:
                raise error
            return name

        return open_

    legacy = RuntimeError("Dataset scripts are no longer supported")
    first = readers.read_first_available
    assert first([source("a"), source("b")]) == "a"
    assert first([source("a", legacy), source("b")]) == "b"
    assert first([source("a", legacy), source("b", OSError("x")), source("c")]) == "c"
    log.clear()
    with pytest.raises(ValueError, match="other"):
        first([source("a", ValueError("other")), source("b")])
    assert log == ["a"]
    with pytest.raises(OSError, match="last"):
        first([source("a", legacy), source("b", OSError("last"))])


def test_pick_files(spark):
    lists = {
        "r1": ["readme.md", "all.csv", "train.csv", "data-full.jsonl", "full2.csv"],
        "r2": [".hidden-full.csv", "x/ALL.tsv", "x/Train.JSON", "train2.csv"],
        "r3": ["b.csv", "a.parquet"],
        "r4": ["script.py", "train.txt", ".csv"],
        "r5": ["z-all.csv", "a-all.csv"],
    }
    rows = [(r, i, p) for r, paths in lists.items() for i, p in enumerate(paths)]
    df = spark.createDataFrame(rows, "repo string, position int, path string")
    picked = {r.repo: r.path for r in listing.pick_files(df).collect()}
    assert picked == {"r1": "data-full.jsonl", "r2": "x/Train.JSON", "r3": "b.csv", "r4": None, "r5": "z-all.csv"}
    assert "Window" not in listing.pick_files(df)._jdf.queryExecution().toString()


def test_list_files(spark, tmp_path):
    for p in ("org/a.csv", "org/sub/b.csv", "other/c.json"):
        (tmp_path / p).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / p).write_text("x")
    for df in (listing.list_files(spark, str(tmp_path)), listing.list_files(spark, str(tmp_path), "org")):
        rows = {(r.repo, r.path) for r in df.collect()}
        assert {("org", "a.csv"), ("org", "sub/b.csv")} <= rows


def pack(path, members):
    with tarfile.open(path, "w:gz") as tar:
        for name, text in members.items():
            data = text.encode()
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))


def test_archives(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(archives, "ROWS_PER_CHUNK", 2)
    lines = "\n".join(json.dumps(dict(zip("xyz", r)), ensure_ascii=False) for r in ROWS)
    array = json.dumps([dict(zip("xyz", r)) for r in ROWS], indent=1)
    for i, (name, text) in enumerate(
        [("d/t.csv", table_text(",")), ("d/t.tsv", table_text("\t")), ("d/t.jsonl", lines), ("d/t.json", array)]
    ):
        folder = tmp_path / str(i)
        folder.mkdir()
        pack(folder / "a.tgz", {"notes.txt": "n", name: text, "later.csv": "x,y,z\n9,9,9\n"})
        (folder / "ignored.bin").write_text("x")
        want = expected() if i < 2 else sorted(ROWS)
        for member, spread in ((name.split("/")[1], None), (None, 3)):
            df = archives.archive_records(archives.scan_archives(spark, str(folder)), TEXTS, member, spread)
            assert {r.member for r in df.collect()} == {name}
            assert got(df.drop("archive", "member")) == want


def test_archive_types_and_missing_member(spark, tmp_path):
    pack(tmp_path / "a.tar.gz", {"t.csv": "n,b,d\n1,true,2.5\n,,\n"})
    schema = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("b", T.BooleanType()), T.StructField("d", T.DoubleType())])
    scan = archives.scan_archives(spark, str(tmp_path))
    df = archives.archive_records(scan, schema).drop("archive", "member")
    assert [tuple(r) for r in df.collect()] == [(1, True, 2.5), (None, None, None)]
    with pytest.raises(Exception, match="it contains"):
        archives.archive_records(scan, schema, "other.csv").collect()


def write(folder, files):
    for name, text in files.items():
        (folder / name).parent.mkdir(parents=True, exist_ok=True)
        (folder / name).write_text(text, newline="")
    return str(folder)


LINES, ARRAY = '{"a": 1}\n{"a": 2}\n', '[\n{"a": 3},\n{"a": 4}\n]\n'


@pytest.mark.parametrize(
    "files,want",
    [
        ({"a.json": LINES, "sub/b.json": LINES}, [1, 1, 2, 2]),
        ({"a.json": LINES, "sub/b.json": LINES, "sub/c.json": ARRAY}, [1, 1, 2, 2, 3, 4]),
        ({"sub/deep/c.json": ARRAY}, [3, 4]),
        ({"a.jsonl": LINES, "x/y/b.JSONL": LINES, "x/README.md": "a"}, [1, 1, 2, 2]),
        ({"a.csv": "a\n1\n", "sub/b.tsv": "a\n2\n"}, [1, 2]),
        ({"a.csv": "a\n1\n", "sub/b.CSV": "a\n2\n", "notes.txt": "x,y\n"}, [1, 2]),
        ({"x/a.csv": "a\n1\n", "b.tsv": "a\n2\n", "y/c.json": ARRAY, "y/d.jsonl": LINES}, [1, 1, 2, 2, 3, 4]),
        ({"a.csv": "a\n1\n", "_temporary/b.csv": "a\n2\n", "sub/.hidden.csv": "a\n3\n"}, [1]),
    ],
)
def test_nested_folders_give_the_rows_of_flat_ones(spark, tmp_path, files, want):
    nested = write(tmp_path / "nested", files)
    flat = write(tmp_path / "flat", {n.replace("/", "-") if n[0] != "_" else n: t for n, t in files.items()})
    for folder in (nested, flat):
        for schema in ("a int", None):
            if folder == flat and any(".hidden" in n for n in files):
                continue  # no longer hidden
            found = sorted(int(r.a) for r in readers.read_file(spark, folder, schema).collect())
            assert found == want, (folder, schema)


def test_nested_parquet_and_partition_folders(spark, tmp_path):
    for place in ("p.parquet", "p.parquet/sub", "p.parquet/sub/sub"):
        spark.range(2).write.mode("append").parquet(str(tmp_path / place))
    assert readers.read_file(spark, str(tmp_path / "p.parquet")).count() == 6
    rows = spark.range(4).selectExpr("id", "id % 2 AS k")
    for fmt in ("json", "parquet", "csv"):
        rows.write.partitionBy("k").format(fmt).option("header", True).save(str(tmp_path / fmt))
        df = readers.read_file(spark, str(tmp_path / fmt))
        assert sorted((int(r.id), r.k) for r in df.collect()) == [(0, 0), (1, 1), (2, 0), (3, 1)]
    write(tmp_path / "json", {"k=7/x.json": '[\n{"id": 9}\n]'})  # another layout in a partition
    assert (9, 7) in {(r.id, r.k) for r in readers.read_file(spark, str(tmp_path / "json")).collect()}


def test_lists_of_several_formats(spark, tmp_path):
    base = write(tmp_path, {"a.csv": "a\n1\n", "b.json": ARRAY, "c/d.tsv": "a\n5\n"})
    df = readers.read_file(spark, [f"{base}/a.csv", f"{base}/b.json", f"{base}/c"])
    assert sorted(int(r.a) for r in df.collect()) == [1, 3, 4, 5]


def test_layouts_are_looked_at_by_the_driver_where_tasks_cannot(spark, tmp_path, monkeypatch):
    base = write(tmp_path, {"a.json": LINES, "b/c.json": ARRAY})
    monkeypatch.setattr(readers, "reachable", lambda path: False)
    assert sorted(r.a for r in readers.read_file(spark, base).collect()) == [1, 2, 3, 4]
    monkeypatch.undo()
    monkeypatch.setattr(readers, "start_of", None)  # and else not by the driver
    assert sorted(r.a for r in readers.read_file(spark, base).collect()) == [1, 2, 3, 4]


def test_heads_of_mixed_folders_and_patterns(spark, tmp_path):
    base = write(tmp_path, {"a.csv": "a\n1\n", "n/b.json": ARRAY, "n/c.jsonl": LINES, "README.md": "x"})
    for n in (1, 3, 5, 9):
        for path in (base, f"{base}/*"):
            rows = [int(r.a) for r in readers.read_head(spark, path, n, "a int").collect()]
            assert len(rows) == min(n, 5) and set(rows) <= {1, 2, 3, 4}
    many = [f"part/{i:02d}.csv" for i in range(20)]
    base = write(tmp_path / "many", {name: "a\n1\n2\n" for name in many})
    assert len(readers.read_head(spark, base, 2).inputFiles()) == 1
    rows = spark.range(4).selectExpr("id", "id % 2 AS k")
    rows.write.partitionBy("k").parquet(str(tmp_path / "k.parquet"))
    assert sorted(map(tuple, readers.read_head(spark, str(tmp_path / "k.parquet"), 9).collect())) == sorted(
        map(tuple, rows.collect())
    )


def test_archives_are_read_by_their_path(spark, tmp_path, monkeypatch):
    """An archive that Spark would not hold whole is read all the same."""
    n = 3000
    text = "x,y,z\n" + "".join(f"{i},{i * 7919 % 1000003},é{i}\n" for i in range(n))
    folder = tmp_path / "with space" / "deep"
    folder.mkdir(parents=True)
    pack(folder / "a.tgz", {"notes.txt": "n", "t.csv": text})
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "1000")
    try:
        with pytest.raises(Exception, match="length|LENGTH"):
            archives.archive_records(archives.scan_archives(spark, str(tmp_path)), TEXTS).count()
        df = archives.read_archives(spark, str(tmp_path), TEXTS)
        assert df.count() == n and df.select("z").distinct().count() == n
        assert df.where("archive LIKE '%with space/deep/a.tgz'").count() == n
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    opened = archives.read_archives(spark, str(tmp_path), TEXTS, opener=lambda path: open(path.removeprefix("file:"), "rb"))
    assert opened.count() == n
    monkeypatch.setattr(archives, "reachable", lambda path: False)
    assert archives.read_archives(spark, str(tmp_path), TEXTS).count() == n  # whole, by Spark


def test_parquet_members_are_read_by_their_path(spark, tmp_path):
    spark.range(5000).selectExpr("id AS x", "uuid() AS y").coalesce(1).write.parquet(str(tmp_path / "p"))
    part = next((tmp_path / "p").glob("*.parquet")).read_bytes()
    with tarfile.open(tmp_path / "a.tgz", "w:gz") as tar:
        for name, data in (("pad.bin", b"0" * 100_000), ("x/t.parquet", part)):
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
    schema = T.StructType([T.StructField("x", T.LongType()), T.StructField("y", T.StringType())])
    df = archives.read_archives(spark, str(tmp_path), schema)
    want = spark.read.parquet(str(tmp_path / "p"))
    assert df.select("x", "y").exceptAll(want).isEmpty() and df.count() == 5000


def test_a_task_holds_a_buffer_of_an_archive(tmp_path):
    """60 MB of random bytes pass by while far less is held."""
    import os
    import tracemalloc

    from tuneloom.sources.streams import open_path

    with tarfile.open(tmp_path / "a.tgz", "w:gz", compresslevel=1) as tar:
        info = tarfile.TarInfo("big.bin")
        info.size = 60 << 20
        tar.addfile(info, io.BytesIO(os.urandom(60 << 20)))
    tracemalloc.start()
    with open_path(f"file:{tmp_path}/a.tgz") as packed, tarfile.open(fileobj=packed, mode="r:gz") as tar:
        assert [info.name for info in tar] == ["big.bin"]
    assert tracemalloc.get_traced_memory()[1] < 8 << 20
    tracemalloc.stop()


def test_stores_of_paths(tmp_path):
    from tuneloom.sources import streams

    (tmp_path / "a b").write_text("x")
    for path in (f"{tmp_path}/a b", f"file:{tmp_path}/a b", f"file://{tmp_path}/a b"):
        assert streams.reachable(path) and streams.open_path(path).read() == b"x"
    assert not streams.reachable("nosuchstore://x/y")


def test_storage(spark, tmp_path):
    final, staged = str(tmp_path / "x" / "final"), str(tmp_path / "staged")
    for n in (3, 4):
        spark.range(n).write.parquet(staged)
        storage.promote(spark, staged, final)
        assert spark.read.parquet(final).count() == n and not storage.path_exists(spark, staged)
    assert list(storage.children(spark, str(tmp_path / "x"))) == ["final"]
    assert list(storage.children(spark, str(tmp_path / "none"))) == []
    assert storage.matching_names(spark, f"{tmp_path}/x/fin*") == ["final"]
    assert storage.matching_names(spark, f"{tmp_path}/none/*") == []


def test_scratch_is_in_the_shared_folder(spark):
    import __spark_entry__ as entry

    base = spark.conf.get("spark.checkpoint.dir")
    assert entry.scratch_path(spark, "a").startswith(base)
    assert entry.scratch_path(spark, "a") != entry.scratch_path(spark, "a")
