"""Prompts, batched generation and reply clean-up."""

from __future__ import annotations

import time
import uuid
from typing import Any, Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.jsontext import json_valid, parse_pair, row_json
from ..functions.text import (
    fill_template,
    remove_prefix,
    strip,
    strip_chars_left,
    strip_chars_right,
    text_of,
)
from ..sources.storage import delete, matching_paths

BATCH_SIZE = 10
MAX_ATTEMPTS = 3
# Prompts of one task, where the number of tasks is ours to choose.
ROWS_PER_TASK = 500

INSTRUCTION_TEMPLATE = """Below is a reply. Write the instruction or question that a person
might have sent to get it. Use one to three sentences and no names of people,
places or organisations.

Reply: {response}

Instruction:"""

QUESTION_TEMPLATE = """Turn this multiple-choice question into a teaching example.

Question: {question}
Options: {choices}
Index of the right option: {answer}

Answer with a JSON object that has two keys: "instruction", a direct question
about the idea, and "response", a clear answer of two to four sentences that
names no option letters. Return the JSON object alone."""

RECORD_TEMPLATE = """Rewrite this record as one JSON object with the same keys.

Record:
{row_as_json}

Return the JSON object alone."""

# Columns of a scenario record, in output order.
RECORD_KEYS = [
    "norm",
    "situation",
    "intention",
    "moral_action",
    "immoral_action",
    "moral_consequence",
    "immoral_consequence",
]
# Where an answer text is looked for, first hit wins.
ANSWER_COLUMNS = ["response", "post"]
STATUS_COLUMNS = ["generation_status", "generation_attempts", "generation_error"]
# Letters of an error that tell one reason from another, and the reasons a sketch keeps.
REASON_LETTERS, REASONS_TRACKED = 300, 1000
INSTRUCTION_PREFIX = "Instruction:"
FENCE_CHARS = "`json"

Generator = Callable[[list[str]], list[Any]]


def answer_column(df: DataFrame, candidates: list[str] = ANSWER_COLUMNS) -> str:
    """First candidate the frame has; the last one if it has none."""
    return next((c for c in candidates if c in df.columns), candidates[-1])


def prompt_from_columns(df: DataFrame, template: str, fields: dict[str, str]) -> Column:
    """Fill a template from columns: placeholder name → column name."""
    return fill_template(
        template, {p: text_of(c, df.schema[c].dataType) for p, c in fields.items()}
    )


def prompt_from_record(df: DataFrame, template: str, keys: list[str] = RECORD_KEYS) -> Column:
    return fill_template(template, {"row_as_json": row_json(df, keys)})


def generation_udf(generator: Generator, batch_size: int, max_attempts: int, backoff: float):
    """prompt → struct(raw, status, attempts, error). Calls ``generator`` with up to
    ``batch_size`` prompts; a batch that still fails after ``max_attempts`` calls
    (waiting backoff, 2*backoff, ... between them) gives '' and 'failed', and the
    last exception as its error.

    Nested, so that it reaches the executors by value together with ``generator``.
    """
    def first_text(reply) -> str:
        if reply is None or isinstance(reply, str):
            return reply or ""
        if isinstance(reply, (list, tuple)):
            return first_text(reply[0]) if reply else ""
        if hasattr(reply, "text"):
            return reply.text or ""
        return str(reply)

    def call(prompts: list) -> list[tuple]:
        import time

        error = None
        for attempt in range(1, max_attempts + 1):
            try:
                replies = [first_text(r) for r in generator(prompts)]
                if len(replies) != len(prompts):
                    raise ValueError(f"{len(replies)} replies for {len(prompts)} prompts")
                return [(r, "ok", attempt, None) for r in replies]
            except Exception as e:
                error = f"{type(e).__name__}: {e}"
                if attempt < max_attempts:
                    time.sleep(backoff * 2 ** (attempt - 1))
        return [("", "failed", max_attempts, error)] * len(prompts)

    @F.pandas_udf("raw string, status string, attempts int, error string")
    def generate_batches(chunks: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for chunk in chunks:
            prompts = chunk.tolist()
            out = []
            for i in range(0, len(prompts), batch_size):
                out.extend(call(prompts[i : i + batch_size]))
            yield pd.DataFrame(out, columns=["raw", "status", "attempts", "error"])

    # Never evaluated twice or moved below a filter: each call may cost money.
    return generate_batches.asNondeterministic()


def generate(
    df: DataFrame,
    prompt: Column,
    generator: Generator,
    batch_size: int = BATCH_SIZE,
    max_attempts: int = MAX_ATTEMPTS,
    backoff: float = 1.0,
    output: str = "generation",
) -> DataFrame:
    """Add struct(raw, status, attempts, error). Only the prompt goes to Python; the
    other columns stay in the JVM. The number of partitions is the number of
    parallel callers. Write the result before using it in several actions."""
    udf = generation_udf(generator, batch_size, max_attempts, backoff)
    return df.withColumn(output, udf(prompt))


REPLY = "struct<raw:string,status:string,attempts:int,error:string>"


def stored_replies(spark: SparkSession, store: str) -> DataFrame:
    """prompt_key, reply: of every prompt asked so far one reply, a good one if
    there is any, else the last."""
    schema = f"prompt_key string, reply {REPLY}, at bigint"
    files = matching_paths(spark, f"{store.rstrip('/')}/replies-*/*.parquet")
    if not files:
        return spark.createDataFrame([], schema).drop("at")
    better = F.struct(F.col("reply.status") == "ok", "at")
    rows = spark.read.schema(schema).parquet(*files)
    return rows.groupBy("prompt_key").agg(F.max_by("reply", better).alias("reply"))


def generate_resumed(
    df: DataFrame,
    prompt: Column,
    generator: Generator,
    store: str,
    batch_size: int = BATCH_SIZE,
    max_attempts: int = MAX_ATTEMPTS,
    backoff: float = 1.0,
    output: str = "generation",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """As ``generate``, with replies kept in the folder ``store``: a prompt that has
    a good reply there is not asked again, by this run or a later one. Calls are
    made at once. Every finished task's replies are in the store even if the run
    dies; prompts that failed are asked again next time.

    Replies are filed by a hash of the prompt, so equal prompts share one, and a
    changed template asks anew; keep a store per model. A null prompt counts as
    empty.
    """
    spark, store = df.sparkSession, store.rstrip("/")
    filled = F.coalesce(prompt, F.lit(""))
    key = F.sha2(filled, 256)
    known = stored_replies(spark, store).where("reply.status = 'ok'").select("prompt_key")
    wanted = df.select(key.alias("prompt_key"), filled.alias("prompt")).dropDuplicates(["prompt_key"])
    asked = f"{store}/_asked-{uuid.uuid4().hex}"
    try:
        wanted.join(known, "prompt_key", "left_anti").write.parquet(asked)
        todo = spark.read.schema("prompt_key string, prompt string").parquet(asked)
        n = todo.count()
        if n:
            dealt = todo.repartition(-(-n // rows_per_task))
            made = generate(dealt, F.col("prompt"), generator, batch_size, max_attempts, backoff, "reply")
            # version 2: a task's file is in place when the task ends, not when the job does
            made.select("prompt_key", "reply", F.lit(time.time_ns()).cast("bigint").alias("at")).write.option(
                "mapreduce.fileoutputcommitter.algorithm.version", "2"
            ).parquet(f"{store}/replies-{uuid.uuid4().hex}")
    finally:
        delete(spark, asked)
    replies = stored_replies(spark, store).select("prompt_key", F.col("reply").alias(output))
    return df.withColumn("__prompt_key", key).join(
        replies.withColumnRenamed("prompt_key", "__prompt_key"), "__prompt_key", "left"
    ).drop("__prompt_key")


def first_generation(replies: Column) -> Column:
    """First text of array<string>; null, empty and a null first text give ''."""
    return F.coalesce(F.try_element_at(replies, F.lit(1)), F.lit(""))


def clean_instruction(c: Column) -> Column:
    return strip(remove_prefix(strip(c), INSTRUCTION_PREFIX))


def strip_fences(c: Column, mode: str = "charset") -> Column:
    """Remove a Markdown code fence.

    ``charset`` strips the characters of '`json' on the left and '`' on the
    right, so a bare ``null`` loses its n; ``anchored`` removes whole fences only.
    """
    text = strip(c)
    if mode == "charset":
        return strip(strip_chars_right(strip_chars_left(text, FENCE_CHARS), "`"))
    if mode == "anchored":
        return strip(F.regexp_replace(F.regexp_replace(text, r"^```(?:json)?", ""), r"```\z", ""))
    raise ValueError(f"unknown mode {mode!r}")


def json_or_default(c: Column, default: str = "{}", exact: bool = True) -> Column:
    return F.when(json_valid(c, exact), c).otherwise(F.lit(default))


def append_columns(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns; a name that exists already is an error, never replaced."""
    taken = [c for c in columns if c in df.columns]
    if taken:
        raise ValueError(f"columns exist already: {taken}")
    return df.withColumns(columns)


def _run(df: DataFrame, prompt: Column, names: list[str], generator: Generator, **options):
    taken = [c for c in names if c in df.columns]
    if taken:  # before any prompt is sent
        raise ValueError(f"columns exist already: {taken}")
    if options.get("store"):
        return generate_resumed(df, prompt, generator, output="__generation", **options)
    options.pop("store", None)
    return generate(df, prompt, generator, output="__generation", **options)


def _finish(df: DataFrame, columns: dict[str, Column], status: bool) -> DataFrame:
    out = append_columns(df, columns)
    if status:
        values = (F.col(f"__generation.{name}") for name in ("status", "attempts", "error"))
        out = append_columns(out, dict(zip(STATUS_COLUMNS, values)))
    return out.drop("__generation")


def failure_reasons(error: str = "generation_error", k: int = 10) -> Column:
    """An aggregate: the most frequent errors of failed rows, and no error at all,
    as array<struct<item, count>>. A sketch of fixed size, which is merged from
    task to task and may be observed while the rows are written; counts are exact
    as long as there are fewer different reasons than it keeps."""
    return F.call_function(
        "approx_top_k", F.substring(F.col(error), 1, REASON_LETTERS), F.lit(k + 1), F.lit(REASONS_TRACKED)
    )


def _raw() -> Column:
    return F.col("__generation.raw")


def instruction_from_answer(
    df, generator, template=INSTRUCTION_TEMPLATE, answer=None, status=False, **options
) -> DataFrame:
    """Add ``instruction``: the request that the answer text replies to."""
    prompt = prompt_from_columns(df, template, {"response": answer or answer_column(df)})
    made = _run(df, prompt, ["instruction"], generator, **options)
    return _finish(made, {"instruction": clean_instruction(_raw())}, status)


def text_generation(
    df, generator, template=QUESTION_TEMPLATE, fields=None, status=False, exact=True, **options
) -> DataFrame:
    """Add ``instruction`` and ``response`` made from a question, its choices and answer."""
    fields = fields or {"question": "question", "choices": "choices", "answer": "answer"}
    prompt = prompt_from_columns(df, template, fields)
    made = _run(df, prompt, ["instruction", "response"], generator, **options)
    made = made.withColumn(
        "__pair", parse_pair(strip_fences(_raw()), "instruction", "response", exact)
    )
    pair = {"instruction": F.col("__pair.first"), "response": F.col("__pair.second")}
    return _finish(made, pair, status).drop("__pair")


def structured_output(
    df, generator, template=RECORD_TEMPLATE, keys=RECORD_KEYS, status=False, exact=True, **options
) -> DataFrame:
    """Add ``structured_json``: the reply if it is JSON, else '{}'."""
    made = _run(
        df, prompt_from_record(df, template, keys), ["structured_json"], generator, **options
    )
    made = made.withColumn("__clean", strip_fences(_raw()))
    columns = {"structured_json": json_or_default(F.col("__clean"), exact=exact)}
    return _finish(made, columns, status).drop("__clean")


AUGMENTATIONS = {
    "instruction_from_answer": instruction_from_answer,
    "text_generation": text_generation,
    "structured_output": structured_output,
}


def augment(
    df: DataFrame, kind: str | None, generator: Generator | None = None, **options
) -> DataFrame:
    """Run one kind of augmentation. None, '', 'none' and unknown kinds return
    the same frame."""
    step = AUGMENTATIONS.get(kind or "none")
    if step is None:
        return df
    if generator is None:
        raise ValueError(f"augmentation {kind!r} needs a generator")
    return step(df, generator, **options)
