import json
import os
import time

import pytest
from pyspark.sql import functions as F

from tuneloom.operators import generate as gen


def dialog(spark, n=3):
    return spark.createDataFrame(
        [(f"ctx_{i}", f"This is response number {i}.", ["be kind"], "safe") for i in range(n)],
        "context string, response string, rots array<string>, safety_label string",
    )


def posts(spark, n=3):
    return spark.createDataFrame(
        [(f"Social post number {i}", "group", "stereotype", "1.0") for i in range(n)],
        "post string, targetMinority string, targetStereotype string, offensiveYN string",
    )


def questions(spark, n=3):
    return spark.createDataFrame(
        [(f"What is concept {i}?", ["A", "it's B"], 0) for i in range(n)],
        "question string, choices array<string>, answer int",
    )


def scenarios(spark, n=3):
    return spark.createDataFrame([tuple(f"{k}_{i}" for k in gen.RECORD_KEYS) for i in range(n)], gen.RECORD_KEYS)


class Reply:
    def __init__(self, text):
        self.text = text


def always(*texts):
    """A generator that gives reply i % len(texts) to prompt i of a batch."""

    def reply(prompts):
        return [[texts[i % len(texts)]] for i in range(len(prompts))]

    return reply


def run(spark, generator, n=1, **options):
    df = spark.range(0, n, 1, 1).select(F.concat(F.lit("p"), "id").alias("prompt"))
    made = gen.generate(df, F.col("prompt"), generator, backoff=0.0, **options).select("generation.*").collect()
    assert all((r.error is None) == (r.status == "ok") for r in made)
    return [(r.raw, r.status, r.attempts) for r in made]


def test_reply_forms(spark):
    def reply(prompts):
        class Obj:
            text = "from text"

        class Empty:
            text = None

        return ["plain", ["first", "second"], [Obj()], [Empty()], [None], [], None, [7]]

    got = [raw for raw, _, _ in run(spark, reply, 8)]
    assert got == ["plain", "first", "from text", "", "", "", "", "7"]


def test_retries_then_empty(spark, tmp_path):
    calls = str(tmp_path / "calls")

    def reply(prompts):
        with open(calls, "a") as f:
            f.write(f"{len(prompts)}\n")
        raise RuntimeError("down")

    assert run(spark, reply, 2) == [("", "failed", 3)] * 2
    assert open(calls).read() == "2\n2\n2\n"


def test_second_attempt_succeeds(spark, tmp_path):
    flag = str(tmp_path / "seen")

    def reply(prompts):
        if not os.path.exists(flag):
            open(flag, "w").close()
            raise RuntimeError("transient")
        return ["recovered"]

    assert run(spark, reply) == [("recovered", "ok", 2)]


def test_wrong_number_of_replies_is_a_failure(spark):
    assert run(spark, lambda prompts: ["x"], 3) == [("", "failed", 3)] * 3


def test_backoff_doubles(spark):
    def reply(prompts):
        raise RuntimeError("down")

    df = spark.range(1).select(F.lit("p").alias("prompt"))
    start = time.time()
    gen.generate(df, F.col("prompt"), reply, backoff=0.2).collect()
    assert time.time() - start >= 0.2 + 0.4


def test_batches_of_ten_in_order(spark, tmp_path):
    sizes = str(tmp_path / "sizes")

    def reply(prompts):
        with open(sizes, "a") as f:
            f.write(f"{len(prompts)}\n")
        return [p.upper() for p in prompts]

    got = run(spark, reply, 25)
    assert [raw for raw, _, _ in got] == [f"P{i}" for i in range(25)]
    assert open(sizes).read().split() == ["10", "10", "5"]


def test_each_prompt_is_sent_once(spark, tmp_path):
    calls = str(tmp_path / "calls")

    def reply(prompts):
        with open(calls, "a") as f:
            f.write("x" * len(prompts))
        return ['{"instruction": "i", "response": "r"}' for _ in prompts]

    made = gen.augment(questions(spark, 12).coalesce(1), "text_generation", reply, status=True)
    made.where("instruction = 'i' and response != '' and generation_status = 'ok'").collect()
    assert len(open(calls).read()) == 12


def test_instruction_from_answer(spark):
    made = gen.augment(dialog(spark), "instruction_from_answer", always(" Instruction: What?  "))
    assert made.columns == ["context", "response", "rots", "safety_label", "instruction"]
    assert {r.instruction for r in made.collect()} == {"What?"}


def test_answer_column(spark):
    assert gen.answer_column(dialog(spark)) == "response" and gen.answer_column(posts(spark)) == "post"
    echo = lambda prompts: prompts
    made = gen.augment(posts(spark, 1), "instruction_from_answer", echo, template="Instruction:<{response}>")
    assert made.first().instruction == "<Social post number 0>" and "post" in made.columns


def test_text_generation(spark):
    replies = ['{"instruction": "Q?", "response": "A."}', '```json\n{"instruction": "Q", "response": "R"}\n```', "no"]
    made = gen.augment(questions(spark).coalesce(1), "text_generation", always(*replies))
    assert [(r.instruction, r.response) for r in made.collect()] == [("Q?", "A."), ("Q", "R"), ("", "")]


def test_question_prompt_prints_the_list(spark):
    df = questions(spark, 1)
    prompt = gen.prompt_from_columns(df, "{question}|{choices}|{answer}", {c: c for c in df.columns})
    assert df.select(prompt).first()[0] == "What is concept 0?|['A', \"it's B\"]|0"


def test_structured_output(spark):
    valid = json.dumps({k: "v" for k in gen.RECORD_KEYS})
    made = gen.augment(scenarios(spark).coalesce(1), "structured_output", always(valid, "here: {broken}", f"```json\n{valid}```"))
    assert [r.structured_json for r in made.collect()] == [valid, "{}", valid]


def test_record_prompt(spark):
    df = scenarios(spark, 1)
    got = df.select(gen.prompt_from_record(df, "{row_as_json}")).first()[0]
    assert got == json.dumps({k: f"{k}_0" for k in gen.RECORD_KEYS})
    got = df.select(gen.prompt_from_record(df.select("intention", "norm"), "{row_as_json}")).first()[0]
    assert got == '{"norm": "norm_0", "intention": "intention_0"}'


def test_fences(spark):
    texts = ["```json\n{}\n```", "  {}  ", "```\n[1]\n```", "null", "{`}", "json{}", "```{}", ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")

    def got(mode):
        return [r.x for r in df.select("i", gen.strip_fences(F.col("t"), mode).alias("x")).orderBy("i").collect()]

    assert got("charset") == [t.strip().lstrip("```json").lstrip("```").rstrip("```").strip() for t in texts]
    assert got("anchored") == ["{}", "{}", "[1]", "null", "{`}", "json{}", "{}", ""]
    with pytest.raises(ValueError):
        gen.strip_fences(F.col("t"), "other")


def test_first_generation(spark):
    df = spark.createDataFrame([(["a", "b"],), ([],), (None,), ([None, "b"],)], "g array<string>")
    assert [r[0] for r in df.select(gen.first_generation(F.col("g"))).collect()] == ["a", "", "", ""]


@pytest.mark.parametrize("kind", [None, "", "none", "not_a_real_type"])
def test_pass_through_is_the_same_frame(spark, kind):
    df = dialog(spark)
    assert gen.augment(df, kind) is df


def test_errors(spark):
    with pytest.raises(ValueError, match="needs a generator"):
        gen.augment(dialog(spark), "instruction_from_answer")
    with pytest.raises(ValueError, match="exist already"):
        gen.augment(dialog(spark).withColumn("instruction", F.lit("x")), "instruction_from_answer", always("x"))


def test_only_the_prompt_goes_to_python(spark, tmp_path):
    dialog(spark).write.parquet(str(tmp_path / "p"))
    df = spark.read.parquet(str(tmp_path / "p"))
    made = gen.augment(df, "instruction_from_answer", always("x"))
    plan = made._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert plan.count("ArrowEvalPython") == 1 and "MapInPandas" not in plan and "Exchange" not in plan
