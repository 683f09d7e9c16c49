"""Readers: chat tables by file type, result folders with their coordinates in the path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.functions.text import col


def read_table(spark: SparkSession, path: str, schema: str | None = None, split: str = "train") -> DataFrame:
    """JSON lines or Parquet by extension; local files only have a train split."""
    if split != "train":
        raise ValueError("local files only have a train split")
    reader = spark.read if schema is None else spark.read.schema(schema)
    name = path.rstrip("/").lower()
    if name.endswith((".jsonl", ".json", ".jsonl.gz", ".json.gz")):
        return reader.json(path)
    if name.endswith(".parquet"):
        return reader.parquet(path)
    raise ValueError(f"cannot tell the file type of {path}")


# Fixed value: how result folders are named (experiment, kind of evaluation, step).
RESULT_FOLDER = r"multilingual-eu-([A-Z]\d+-\d+en)-(winrate|rubric)-step(\w+)-"


def result_coordinates(path) -> dict[str, Column]:
    """experiment, mode, step (text) and step number where it is one."""
    p = col(path)
    step = F.regexp_extract(p, RESULT_FOLDER, 3)
    return {
        "experiment": F.regexp_extract(p, RESULT_FOLDER, 1), "mode": F.regexp_extract(p, RESULT_FOLDER, 2), "step": step,
        "step_number": step.try_cast("int"),
    }


def read_results(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """All result files below a folder, tagged from their path; other folders are ignored."""
    rows = spark.read.schema(schema).option("recursiveFileLookup", "true").json(root)
    tagged = rows.withColumn("_path", F.col("_metadata.file_path"))
    for name, value in result_coordinates("_path").items():
        tagged = tagged.withColumn(name, value)
    return tagged.filter("experiment <> ''").drop("_path")


# Where each evaluation keeps its summary number, and the ones on a 0-100 scale.
SUMMARY_PATHS = {
    "alpaca_eval": ["win_rate", "model-greedy-long"], "bbh_cot": ["average_exact_match"], "bbh_direct": ["average_exact_match"],
    "codex_eval_temp_0.1": ["pass@1"], "codex_eval_temp_0.8": ["pass@10"], "gsm_cot": ["exact_match"], "gsm_direct": ["exact_match"],
    "ifeval": ["loose", "Accuracy"], "mmlu_0shot": ["average_acc"], "mmlu_5shot": ["average_acc"], "toxigen": ["overall"],
    "truthfulqa": ["truth-info acc"], "tydiqa_goldp_1shot": ["average", "f1"], "tydiqa_no_context_1shot": ["average", "f1"],
    "xstest": ["gpt4_label", "refusal_prf", "f1"],
}
PERCENT_TASKS = ["tydiqa_goldp_1shot", "tydiqa_no_context_1shot", "alpaca_eval"]


def summary_metrics(df: DataFrame, task: str, metrics: str, keys: list[str] = ()) -> DataFrame:
    """(keys, place, task, metric, value) per known task: the summary number, rescaled to 0-1, four decimals."""
    value, metric, place = F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit(None).cast("int")
    for i, (name, path) in enumerate(SUMMARY_PATHS.items()):
        here = F.col(task) == name
        json_path = "$" + "".join(f"['{k}']" for k in path)
        value = F.when(here, F.get_json_object(metrics, json_path)).otherwise(value)
        metric = F.when(here, F.lit(":".join(path))).otherwise(metric)
        place = F.when(here, F.lit(i)).otherwise(place)
    number = value.try_cast("double")
    scaled = F.when(F.col(task).isin(PERCENT_TASKS), number / 100).otherwise(number)
    return df.select(*keys, place.alias("place"), F.col(task).alias("task"), metric.alias("metric"), F.round(scaled, 4).alias("value")).filter(
        "metric IS NOT NULL"
    )
