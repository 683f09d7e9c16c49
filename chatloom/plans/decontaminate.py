"""Plan: remove the rows that leak an evaluation set and report what is left per language."""

from __future__ import annotations

from pyspark.sql import DataFrame

from chatloom.operators import contamination as C
from chatloom.operators.statistics import language_shares


def clean_rows(documents: DataFrame, benchmark: DataFrame, n: int = 8, threshold: float = 0.5) -> DataFrame:
    bad = C.contaminated(C.ngram_matches(documents, benchmark, "doc_id", "text", "item_id", ["text"], n, threshold), "doc_id")
    return C.drop_contaminated(documents, bad, "doc_id")


def language_report(documents: DataFrame, benchmark: DataFrame, n: int = 8, threshold: float = 0.5) -> DataFrame:
    return language_shares(clean_rows(documents, benchmark, n, threshold), "lang")
