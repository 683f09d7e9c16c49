"""Plan: datasets by amount, tokenised with a loss mask, shuffled once and written as token shards with accounting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom import registry
from chatloom.functions.text import hash_key
from chatloom.operators import mixing as X
from chatloom.operators import packing as P
from chatloom.operators import statistics as S
from chatloom.sources.sinks import write_token_shards


def build_shards(
    datasets: list[tuple[str, DataFrame, str]], key: str, steps: list[tuple[str, dict]], path: str, shard_tokens: int, work: str, seed: int = 42
) -> DataFrame:
    """Write the shards below ``path`` and return the accounting per dataset.

    The tokenised rows are written once to ``work``, because the offsets, the shards and the accounting all read them;
    that table is also what a restart begins from.
    """
    mixed = X.mix(datasets, key, seed)
    unique = F.concat_ws(":", registry.SOURCE, key, "copy")
    coded = registry.run(mixed.withColumn("row_id", unique), steps).select("row_id", registry.SOURCE, "input_ids", "labels")
    coded.write.mode("overwrite").parquet(work)
    rows = mixed.sparkSession.read.parquet(work)
    masked = rows.withColumn("mask", F.transform("labels", lambda x: x != -100))
    offsets = P.document_offsets(masked.select("row_id", "input_ids", "mask"), hash_key("row_id", seed), F.size("input_ids"))
    write_token_shards(P.shard_pieces(offsets, shard_tokens, "row_id", "input_ids", "mask"), path)
    return S.pipeline_accounting(mixed, rows, registry.SOURCE, "input_ids", "labels")
