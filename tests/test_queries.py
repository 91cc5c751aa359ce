"""Registered queries against SQL. The quick ones by default; all with ALL_QUERIES=1."""

import os

import pytest
from compare import connect, differences

from __spark_entry__ import entry, oracle_sql, queries

QUICK = (
    "read_source ground_truth ground_truth_sampled candidates_by_country merge_parts merge_parts_missing normalize_text "
    "normalize_series normalize_country blocking_text blocking_text_column source_from_prefix s1_semi_sample s1_slice "
    "tokens_ngrams char_trigrams fit_sample vocabulary idf tfidf_weights degenerate_country rare_terms exact_name "
    "stratified_sample entity_holdout check_malformed check_duplicate_rows check_duplicate_ids check_self_match "
    "check_prefix check_unknown_ids check_missing_s1 check_extra_s1 list_summary source_ids truth_profile volume_profile "
    "block_all pair_features link_lists threshold_sweep validation_report"
).split()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(oracle_sql()) if os.environ.get("ALL_QUERIES") else QUICK)
def test_query(spark, sf, con, name):
    assert not differences(queries()[name](spark, sf), con, oracle_sql()[name])


def test_contract(spark):
    assert set(oracle_sql()) <= set(queries())
    assert entry(spark).columns == ["source1_entity_id", "matched_entity_ids"]
