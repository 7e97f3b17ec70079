"""Counts and results when tasks fail and run again. Needs a session of its own,
since only its master string allows retries in local mode."""

import os
import subprocess
import sys

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from pyspark import TaskContext
from pyspark.sql import SparkSession, functions as F

spark = (
    SparkSession.builder.master("local[4,4]")
    .config("spark.ui.enabled", "false")
    .config("spark.ui.showConsoleProgress", "false")
    .config("spark.sql.shuffle.partitions", "4")
    .getOrCreate()
)
spark.sparkContext.setLogLevel("OFF")
from tuneloom.operators.deliver import write_snappy
from tuneloom.plans import recipes as rec


def flaky(batches):
    from pyspark import TaskContext

    for pdf in batches:
        yield pdf
    context = TaskContext.get()
    if context.attemptNumber() < 1 and context.partitionId() % 3 == 0:
        raise RuntimeError("executor lost")


df = spark.range(0, 1000, 1, 8).selectExpr("id", "concat('a', id, '@b.org') AS response")
shaky = df.mapInPandas(flaky, df.schema)

counted = write_snappy(shaky, {out!r} + "/a")
assert counted == {{"n_rows": 1000}}, counted
assert spark.read.parquet({out!r} + "/a").count() == 1000

# Failures before and after a shuffle.
twice = shaky.repartition(6).mapInPandas(flaky, df.schema)
recipe = rec.replace(rec.RECIPES["text_to_sql"], columns_keep=["response"], rows=1000, min_rows_output=1000)
result = rec.run_recipe(twice, recipe, {out!r} + "/b", "now", key=["id"])
assert result["status"] == "success" and result["rows_out"] == 1000, result
assert "'email': 1000" in result["message"], result

made = rec.run_recipe(
    twice, rec.replace(recipe, id="g", augmentation="instruction_from_answer"), {out!r} + "/b", "now",
    lambda prompts: ["Instruction: x@y.org"] * len(prompts), ["id"], parallelism=5,
)
assert made["rows_out"] == 1000 and "'email': 2000" in made["message"], made
print("retries ok")
"""


def test_counts_survive_retries(tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = tmp_path / "retry.py"
    script.write_text(SCRIPT.format(repo=repo, out=str(tmp_path / "out")))
    done = subprocess.run([sys.executable, str(script)], capture_output=True, text=True, timeout=300, cwd=tmp_path)
    assert "retries ok" in done.stdout, done.stdout[-3000:] + done.stderr[-3000:]
