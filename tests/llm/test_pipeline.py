import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tuneloom.llm import curriculum
from tuneloom.llm.queries import byte_bpe
from tuneloom.llm.tables import stored

import test_decontaminate
import test_neardup
import test_rules
import test_tokens


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    docs, items = test_decontaminate.data()
    rows = [(i, t, "en", f"s{(i or 0) % 3}", len(t or "")) for i, t in docs]
    clean = test_rules.rows_of_all_kinds()
    rows += [(None if i is None else 1000 + i, t, "en", s, len(t or "")) for i, t, s in clean]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame(rows, schema).write.parquet(os.path.join(path, "documents.parquet"))
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(os.path.join(path, "benchmark.parquet"))
    return path


def pairs(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_every_stage_is_that_of_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["quality_rules", "near_duplicates", "benchmark_overlap", "mixing", "token_ids"]

    def step(name, df):
        out = stored(steps[name](spark, df, folder), name)
        assert name == "token_ids" or out.columns == columns
        return out

    one = step("quality_rules", docs)
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    assert sorted((r.doc_id for r in one.collect()), key=str) == sorted((r[0] for r in test_rules.brute(rows) if r[-1]), key=str)

    two = step("near_duplicates", one)
    before = pairs(one)
    chosen = {(g[0], t) for g, (_, t) in zip(_groups(before), before) if g[0] == g[2]}
    assert pairs(two) == sorted(chosen, key=str)

    three = step("benchmark_overlap", two)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    assert pairs(three) == [(i, t) for i, t in pairs(two) if test_decontaminate.brute(t, items)[1] == 0]

    four = step("mixing", three)
    want = [(p.id, -(-p.taken // p.size)) for p in curriculum.mix(three).collect() if p.taken]
    assert sorted((i for i, _ in pairs(four)), key=str) == sorted((i for i, n in want for _ in range(n)), key=str)

    five = step("token_ids", four)
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(byte_bpe())
    ids = test_tokens.brute(pairs(four), lambda text: t.encode(text or "", add_special_tokens=False).ids)
    got = sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in five.collect()), key=str)
    assert got == sorted(((i, n, c) for i, _, n, c in ids), key=str)
    assert five.count() > 20


def _groups(rows):
    """brute_groups keeps the order of its input only before sorting."""
    found = {}
    for g in test_neardup.brute_groups(rows):
        found.setdefault((g[0], g[1]), g)
    return [found[i, f"{test_neardup.brute_print(t):016x}"] for i, t in rows]


def test_run_and_empty_tables(spark, folder, tmp_path):
    assert corpus_pipeline.run(spark, folder).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_token_files_are_in_the_order_of_the_mix(spark, folder):
    """Files hold the copies as the curriculum has them; another schedule, other files."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("text is not null").repartition(5)
    orders = []
    for slopes in (curriculum.SLOPES, ((0.1, 1.9), (1.9, 0.1), (1.0, 1.0))):
        plan = curriculum.mix(docs, schedules=lambda s: curriculum.turns(s, slopes=slopes))
        rows = plan.where("taken > 0").select("id", "place", F.explode("positions").alias("due")).collect()
        want = [r.id for r in sorted(rows, key=lambda r: (r.due, r.place))]
        mixed = curriculum.training_order(docs, schedules=lambda s: curriculum.turns(s, slopes=slopes))
        got = corpus_pipeline.token_ids(spark, stored(mixed, "mixing"), folder).orderBy("start").collect()
        assert [r.doc_id for r in got] == want
        assert [r.start for r in got] == [sum(x.n_tokens for x in got[:i]) for i in range(len(got))]
        orders.append(want)
    assert sorted(orders[0], key=str) == sorted(orders[1], key=str) and orders[0] != orders[1]


def test_token_ids_of_rows_that_no_file_holds(spark, folder):
    docs = spark.createDataFrame([(5, "b c"), (None, "x"), (2, None)], "doc_id bigint, text string")
    got = corpus_pipeline.token_ids(spark, docs, folder).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, 2, 5]
