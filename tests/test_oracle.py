"""Registered queries against their SQL twins at the smallest scale. ``ORACLE=all`` runs every one."""

import os

import pytest
from oracle import DATA, compare, duck

from chatloom.catalog import load

QUERIES, ORACLES = load()
SAMPLE = [
    "jn_exact_two_fields", "jn_ngram_above", "jn_vector", "fl_identity", "fl_repetition", "fl_stages", "cv_merge_turns", "cv_transcript_pairs",
    "cv_tree_best_path", "cv_tree_top_paths", "cv_specs", "mx_priority_fill", "mx_fraction_or_count", "dd_latest_annotation", "tk_mask_assistant",
    "tk_shard_boundaries", "ag_chat_summary", "ag_quantiles_exact", "pf_majority", "pf_binarize_ratings", "pf_gae_packed", "ev_rolling_band",
    "ev_annotators", "tr_validate", "vf_scores", "vf_keyed_constraints", "io_requests", "st_rollout_groups", "plan_token_shards",
    "pf_binarize", "pf_binarize_weighted", "tk_packs", "tk_chunk_boundaries", "tk_render_tools", "vf_instructions", "vf_reward_metrics", "io_read_results",
    "cv_tree_all_paths", "ag_detect_language", "fl_ngram_repetitions", "st_latest_votes",
]
NAMES = sorted(QUERIES) if os.environ.get("ORACLE") == "all" else SAMPLE


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, name):
    sf_dir = f"{DATA}/sf0.001"
    ok, note = compare(spark, duck(sf_dir), name, QUERIES[name], ORACLES.get(name), sf_dir)
    assert ok, note


def test_contract():
    assert set(ORACLES) <= set(QUERIES)
    assert len(QUERIES) > 200
