"""Baseline choice, rollback target, freshness gate over a run log."""

import datetime as dt

import pytest

from tallgrass.operators import dataops as D

SCHEMA = ("run_id string, pipeline string, dataset string, group_name string, status string, row_count bigint, "
          "max_year bigint, finished_at timestamp_ntz, source_uri string, git_sha string")


def runs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


T = dt.datetime


def test_baseline_is_latest_success_with_rows_and_ties_go_to_larger_run_id(spark):
    r = runs(spark, [
        ("a", "p", "d", "monthly", "success", 10, 2020, T(2024, 1, 1), "u", "s1"),
        ("b", "p", "d", "monthly", "success", 11, 2020, T(2024, 1, 2), "u", "s1"),
        ("c", "p", "d", "monthly", "success", 12, 2020, T(2024, 1, 2), "u", "s1"),
        ("d", "p", "d", "monthly", "failed", None, None, T(2024, 1, 3), None, "s1"),
        ("e", "p", "d", "monthly", "success_limited", 5, 2020, T(2024, 1, 4), None, "s1"),
        ("f", "p", "d", "monthly", "success_no_change", None, None, T(2024, 1, 5), None, "s1"),
    ])
    assert D.previous_successful(r).first()["run_id"] == "c"


def test_rollback_target_is_second_newest_or_only(spark):
    r = runs(spark, [
        ("a", "p", "d1", "monthly", "success", 10, 2020, T(2024, 1, 1), "u1", "s"),
        ("b", "p", "d1", "monthly", "success", 11, 2020, T(2024, 1, 2), "u2", "s"),
        ("c", "p", "d2", "monthly", "success", 11, 2020, T(2024, 1, 2), "u3", "s"),
        ("d", "p", "d2", "monthly", "success", 11, 2020, T(2024, 1, 3), None, "s"),
    ])
    got = {x["dataset"]: x["run_id"] for x in D.rollback_targets(r).collect()}
    assert got == {"d1": "a", "d2": "c"}
    assert D.rollback_targets(r, run_id="b").first()["run_id"] == "b"


def test_freshness_uses_newest_row_even_when_null(spark):
    r = runs(spark, [
        ("a", "labour_market", "d", "monthly", "success", 10, 2020, T(2024, 1, 1), "u", "s1"),
        ("b", "labour_market", "d", "monthly", "success_no_change", None, None, T(2024, 1, 10), None, "s2"),
    ])
    f = D.dataset_freshness(r, T(2024, 1, 20, 12)).first()
    assert (f["days_since_success"], f["last_row_count"], f["last_git_sha"]) == (10, None, "s2")


def test_freshness_gate_message_and_raise(spark):
    r = runs(spark, [
        ("a", "labour_market", "d1", "monthly", "success", 10, 2020, T(2024, 1, 1), "u", "s"),
        ("b", "labour_market", "d2", "yearly", "success", 10, 2020, T(2024, 1, 1), "u", "s"),
        ("c", "enrollment", "d3", "monthly", "success", 10, 2020, T(2024, 1, 25), "u", "s"),
        ("d", "labour_market", "never", "monthly", "failed", None, None, T(2024, 1, 1), None, "s"),
    ])
    now = T(2024, 2, 5)  # 35 days after Jan 1: 840 h > 792 h for monthly
    stale = D.stale_datasets(r, D.thresholds_frame(spark), now)
    assert [x["dataset"] for x in stale.collect()] == ["d1"]
    msg = D.freshness_message(stale).first()["message"]
    assert msg == "STALE: 1 past their limit, the oldest: labour_market/d1, monthly: 840 hours of 792"
    with pytest.raises(D.FreshnessError, match="STALE"):
        D.raise_if_stale(D.freshness_message(stale))
    fresh = D.stale_datasets(r, D.thresholds_frame(spark), T(2024, 1, 20))
    assert D.freshness_message(fresh).first()["message"] is None
    D.raise_if_stale(D.freshness_message(fresh))


def test_recent_listing_clips_error(spark):
    r = spark.createDataFrame([
        ("a", "p", "d", "failed", None, T(2024, 1, 1, 10), 1.26, "e" * 100),
        ("b", "p", "d", "success", 5, T(2023, 12, 1), 2.0, None),
    ], "run_id string, pipeline string, dataset string, status string, row_count bigint, "
       "started_at timestamp_ntz, duration_seconds double, error string")
    out = D.manifest_last_day(r, T(2024, 1, 1, 12)).collect()
    assert len(out) == 1 and len(out[0]["error"]) == 60 and out[0]["secs"] == 1.3
