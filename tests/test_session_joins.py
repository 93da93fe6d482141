"""Session helpers and the size-checked broadcast."""

from __future__ import annotations

import pytest

from hemotab.operators.joins import dim_lookup
from hemotab.session import checkpoint_dir


def test_checkpoint_dir_is_read_from_session(spark):
    path = checkpoint_dir(spark)
    assert path and checkpoint_dir(spark) == path
    assert spark.sparkContext.getCheckpointDir()


def test_code_list_is_broadcast_only_if_known_to_be_small(spark, small_tables, monkeypatch):
    from hemotab.operators import joins

    fact = small_tables["Donation"].select("id", "venue_id")
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        hinted = dim_lookup(small_tables, fact, "Location", "venue_id", {"name": "venue"})
        assert "BroadcastHashJoin" in hinted._jdf.queryExecution().executedPlan().toString()
        monkeypatch.setattr(joins, "CODE_TABLE_BYTES", 10)   # below the list's size: joined by shuffle
        shuffled = dim_lookup(small_tables, fact, "Location", "venue_id", {"name": "venue"})
        plan = shuffled._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
        assert shuffled.count() == hinted.count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


def test_only_code_lists_are_looked_up(small_tables):
    with pytest.raises(ValueError):
        dim_lookup(small_tables, small_tables["Donation"], "Donor", "donor_id", {"gender": "gender"})
