"""Counting the terms of a key moves texts, not terms."""

import pytest

from kinmatch.plans.queries import QUERIES


@pytest.mark.parametrize("name", ["tokens_ngrams", "char_trigrams"])
def test_terms_are_counted_where_their_text_lies(spark, sf, name):
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(entity_id" in plan
    assert not any("hashpartitioning(" in line and "term" in line for line in plan.splitlines())


def test_weights_move_texts(spark, sf):
    plan = QUERIES["tfidf_weights"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not any("hashpartitioning(" in line and "term" in line and "BroadcastHashJoin" not in line for line in plan.splitlines())
