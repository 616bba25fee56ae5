"""The joins of the test tables: each is written by the first query that needs it, with few moves of lines."""

import os
from contextlib import contextmanager

from waitlens.registry import QUERIES, _staging
from waitlens.sources.testviews import DriverViews

SF = "/root/testdata/sf0.001"


@contextmanager
def sort_merge(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    old = {k: spark.conf.get(k) for k in names}
    spark.conf.set(names[0], "-1")
    spark.conf.set(names[1], "false")
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_queries_write_only_the_joins_they_read(spark, tmp_path):
    link = str(tmp_path / "sf")  # a scale factor of its own, so that no other test has staged it
    os.symlink(SF, link)
    folder = _staging(spark, link).removeprefix("file:")
    for name, there in (("establishments", set()), ("choices_specialties", {"referral_base", "list_statistics"}),
                        ("misrouted_by_pattern", {"referral_base", "list_statistics"}),
                        ("programming_union", {"referral_base", "list_statistics", "line_sites", "programming_plan"})):
        rows = QUERIES[name](spark, link).count()
        assert rows == QUERIES[name](spark, SF).count()
        assert (set(os.listdir(folder)) if os.path.isdir(folder) else set()) == there, name


def test_lines_are_not_moved_by_customer(spark):
    with sort_merge(spark):
        plan = DriverViews(spark, SF)._referral_base()._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = [len(line) - len(line.lstrip(" :+-*")) for line in plan]
    at = next(i for i, line in enumerate(plan) if "Exchange hashpartitioning(o_custkey" in line)
    below = []
    for line, d in zip(plan[at + 1:], depth[at + 1:], strict=True):
        if d <= depth[at]:
            break
        below.append(line)
    assert any("o_orderkey" in line for line in below) and not any("l_orderkey" in line for line in below)


def test_staged_rows_are_the_joins_rows(spark, tmp_path):
    lazy, plain = DriverViews(spark, SF, str(tmp_path / "kept")), DriverViews(spark, SF)
    for name in DriverViews.STAGED:
        kept, rows = getattr(lazy, name)(), getattr(plain, name)()
        kept = kept.select(*rows.columns)
        assert kept.exceptAll(rows).isEmpty() and rows.exceptAll(kept).isEmpty(), name
