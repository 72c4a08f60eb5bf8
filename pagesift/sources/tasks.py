"""Evaluation tasks: JSON lines with a schema per task, projected to query and gold labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The fields each task file has.
SCHEMAS = {
    "asdiv": "body string, answer string",
    "gsm8k": "question string, cot string, answer string",
    "math": "problem string, solution string",
    "mathqa": "problem string, options string, rationale string",
    "mawps": "input string, target string",
    "mmlu_stem": "question string, options array<string>, answer string",
    "ocw": "problem string, solution string, answer string",
    "sat": "question string, options string, Answer string",
    "svamp": "Body string, Question string, Answer string",
    "aime24": "problem string, solution string",
    "aime25": "problem string, answer string",
    "amc": "problem string, answer double",
}
CHOICES = "ABCD"


def _blank_joined(*names: str) -> Column:
    return F.array_join(F.array(*[F.col(n).cast("string") for n in names]), " ", "None")


def _number_text(name: str) -> Column:
    """A floating number as in the source files: whole numbers keep ``.0`` and no exponent."""
    value = F.col(name)
    whole = (value == F.floor(value)) & (F.abs(value) < 1e16)
    text = F.when(whole, F.concat(value.cast("long").cast("string"), F.lit(".0"))).otherwise(value.cast("string"))
    return F.coalesce(text, F.lit("None"))


def _choices() -> Column:
    parts: list[Column] = []
    for i, letter in enumerate(CHOICES):
        parts += [F.lit(f"{letter}:"), F.get("options", F.lit(i))]
    return F.array_join(F.array(*parts, F.lit("Answer:"), F.col("answer")), " ", "None")


def _without_ends(name: str) -> Column:
    return F.substring(F.col(name), F.lit(2), F.greatest(F.length(name) - 2, F.lit(0)))


def projections() -> dict[str, tuple[Column, Column]]:
    """Query and label of every task."""
    j = _blank_joined
    return {
        "asdiv": (j("body"), j("answer")),
        "gsm8k": (j("question"), j("cot", "answer")),
        "math": (j("problem"), j("solution")),
        "mathqa": (j("problem", "options"), _without_ends("rationale")),
        "mawps": (j("input"), j("target")),
        "mmlu_stem": (j("question"), _choices()),
        "ocw": (j("problem"), j("solution", "answer")),
        "sat": (j("question"), j("options", "Answer")),
        "svamp": (j("Body", "Question"), j("Answer")),
        "aime24": (j("problem"), j("solution")),
        "aime25": (j("problem"), j("answer")),
        "amc": (j("problem"), _number_text("answer")),
    }


def task_projection(raw: DataFrame, task: str) -> DataFrame:
    """Rows ``(task, query, golds)`` of one task's own fields."""
    query, label = projections()[task]
    return raw.select(F.lit(task).alias("task"), query.alias("query"), F.array(label).alias("golds"))


def scan_tasks(spark: SparkSession, folder: str, tasks: list[str] | None = None) -> DataFrame:
    """Read ``<folder>/<task>.jsonl`` for every task, with its own schema."""
    out = None
    for task in tasks or list(SCHEMAS):
        raw = spark.read.schema(SCHEMAS[task]).json(f"{folder.rstrip('/')}/{task}.jsonl")
        rows = task_projection(raw, task)
        out = rows if out is None else out.unionByName(rows)
    return out
