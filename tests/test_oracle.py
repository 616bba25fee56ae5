"""Every registered query against its DuckDB oracle on the smallest test tables."""

import os

import pytest

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_all_queries_match_oracle(spark):
    import compare
    assert compare.main(SF, sorted(compare.LIBRARY)) == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_results_are_not_empty(spark, monkeypatch):
    """Columns of nothing but nulls, at the size of the correctness check."""
    import compare
    monkeypatch.setattr(compare, "EMPTY_IS_BAD", True)
    names = ["running_backlog", "dashboard_backlog", "production_summary", "supply_vs_standard", "supply_mean_ratio",
             "monthly_cube", "hospital_gap", "gap_projected", "cohort_gap", "wait_mean_median"]
    assert compare.main("/root/testdata/sf0.01", names) == 0


def test_every_query_has_an_oracle():
    from oracle.queries import ORACLE_SQL
    from waitlens.registry import QUERIES
    assert set(QUERIES) == set(ORACLE_SQL)
