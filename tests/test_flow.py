"""The reference's cube-to-dashboard flow on the smallest test tables: the
cube, starting demand and production are published (S12), read back (S13),
and the dashboard's running backlog from the published tables equals the one
computed directly."""

import os

import pytest

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_published_cube_feeds_the_dashboard(spark, tmp_path):
    from waitlens.plans import cube
    from waitlens.registry import PLANS, TEST, Context
    from waitlens.sources.catalog import Tables

    ctx = Context(Tables.from_driver(spark, SF, staging=str(tmp_path / "staging")), TEST)
    out = str(tmp_path / "published")
    cube.publish_results(cube_df=ctx.cube, starting=ctx.starting, production=ctx.production, path=out)
    cube_back, starting_back, _ = cube.read_results(spark, out)
    assert cube_back.count() == ctx.cube.count()
    from_published = cube.running_backlog(cube_back, starting_back, start_keys=["abreviacion", "desc_esp"],
                                          start_value="demanda_acumulada")
    direct = PLANS["dashboard_backlog"](ctx)
    cols = sorted(direct.columns)

    def rows(df):
        return sorted(tuple(str(r[c]) for c in cols) for r in df.select(*cols).collect())

    assert rows(from_published) == rows(direct)
    choices = {r.abreviacion for r in cube.choices(starting_back, "abreviacion").collect()}
    assert choices == {r.abreviacion for r in PLANS["choices_sites"](ctx).collect()}


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_materialized_shared_facts_give_the_same_results(spark, tmp_path):
    from waitlens.registry import PLANS, TEST, Context
    from waitlens.sources.catalog import Tables

    lazy = Context(Tables.from_driver(spark, SF, staging=str(tmp_path / "s1")), TEST)
    kept = Context(Tables.from_driver(spark, SF, staging=str(tmp_path / "s2")), TEST)
    kept.materialize(str(tmp_path / "facts"))
    for name in ("np_rate_all_years", "monthly_cube", "hospital_gap", "enrolled_cohort", "programming_yearly"):
        a, b = PLANS[name](lazy), PLANS[name](kept)
        cols = sorted(a.columns)
        assert sorted(b.columns) == cols

        def rows(df):
            return sorted(tuple(str(r[c]) for c in cols) for r in df.select(*cols).collect())

        assert rows(a) == rows(b), name


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_workflow_writes_every_requested_analysis(spark, tmp_path):
    from waitlens import workflow
    from dataclasses import replace

    from waitlens.registry import TEST
    from waitlens.sources.catalog import Tables
    from waitlens.sources.readers import read_published

    tables = Tables.from_driver(spark, SF, staging=str(tmp_path / "staging"))
    params = replace(TEST, np_min_total=1, cube_year=1998)
    written = workflow.run(spark, tables, str(tmp_path / "out"), params=params,
                           names=["np_rate", "monthly_cube", "hospital_gap"], fmt="csv")
    assert set(written) == {"np_rate", "monthly_cube", "hospital_gap"}
    np_rows = spark.read.option("header", True).csv(written["np_rate"]).count()
    assert np_rows > 0
    assert read_published is not None


def test_workflow_config_file(tmp_path):
    import json

    from waitlens.workflow import load_config
    cfg = {"inputs": {"establishments": {"path": "/x/estab.csv", "fmt": "csv", "skip_lines": 1},
                      "abbreviations": "/x/abbrev", "specialties": "/x/specs", "exit_reasons": "/x/reasons",
                      "open_list": "/x/open", "closed_list": "/x/closed", "production": "/x/rem",
                      "registry": "/x/registry", "referral_map": {"path": "/x/map.csv", "fmt": "csv",
                                                                  "encoding": "ISO-8859-1"},
                      "programming_folder": "/x/prog", "programming_files": {"H1": "h1.csv"},
                      "programming_format": "csv", "extras": {"sigte": "/x/sigte"}},
           "params": {"site": "113100", "cube_year": 2024, "named_sites": ["A", "B"]}}
    p = tmp_path / "cfg.json"
    p.write_text(json.dumps(cfg))
    paths, params = load_config(str(p))
    assert paths.establishments.skip_lines == 1 and paths.referral_map.encoding == "ISO-8859-1"
    assert paths.programming_paths() == {"H1": "/x/prog/h1.csv"} and paths.extras["sigte"].path == "/x/sigte"
    assert (params.site, params.cube_year, params.named_sites) == ("113100", 2024, ("A", "B"))
