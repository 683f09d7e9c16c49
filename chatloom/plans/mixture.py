"""Plan: a language mixture from quotas to shuffled rows, with its shortfall report."""

from __future__ import annotations

from pyspark.sql import DataFrame

from chatloom.operators import mixing as X
from chatloom.operators import sampling as S


def assemble(
    df: DataFrame, mix: X.LanguageMix, total: int, key: str, language: str, source: str, priority: list[str], seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """(rows in global seeded order, report per language)."""
    quotas = X.quota_table(df.sparkSession, mix.quotas(total))
    taken = X.priority_fill(df, quotas, key, language, source, priority, seed)
    return S.shuffled(taken, key, seed), X.shortfall(taken, quotas, language)
