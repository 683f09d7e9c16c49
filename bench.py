"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "flagship_decontaminated_languages", "jn_exact", "jn_ngram_pairs", "jn_vector", "fl_vendor_keywords", "fl_identity",
    "fl_repetition", "fl_code_heavy", "fl_stage_retention", "tk_mask_assistant", "tk_shard_boundaries", "tk_packs",
    "mx_assembled", "mx_fraction_or_count", "ag_language_breakdown", "ag_pair_summary", "pf_best_worst", "pf_advantage",
    "cv_merge_turns", "vf_scores", "vf_simple_constraints", "ev_annotators", "tr_validate", "dd_latest_annotation",
]


def main() -> None:
    from chatloom.catalog import load
    from chatloom.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "bench")
    queries, _ = load()
    spark.read.parquet(f"{sf_dir}/documents.parquet").count()  # start-up is not measured
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").count()
    chats = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id").distinct().count()
    names = sys.argv[1:] or HEADLINE
    times = {}
    for name in names:
        start = time.time()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    rate = lambda n, q: round(n / times[q] / int(cpus), 1) if q in times else None
    extra = {
        "filter_rows_per_s_core": rate(turns, "fl_identity"), "repetition_rows_per_s_core": rate(rows, "fl_repetition"),
        "masked_chats_per_s_core": rate(chats, "tk_mask_assistant"),
    }
    print(
        json.dumps(
            {"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir), **extra}
        )
    )


if __name__ == "__main__":
    main()
