"""Run the analyses on one's own inputs and publish every result.

    from waitlens.sources.config import InputPaths, Source
    from waitlens.registry import Params
    from waitlens import workflow

    paths = InputPaths(...)                       # where the extracts are
    params = Params(site="...", cube_year=2024, ...)  # sites, years, code lists
    workflow.run(spark, Tables.from_paths(spark, paths), "/shared/out", params=params)

This is the reference's workflow (set the paths, run the loads, run the
analyses, export the tables) as one Spark application: the load step writes
the shared facts once, each analysis is then one job writing its own folder.
"""

from __future__ import annotations

import os
from collections.abc import Iterable

from pyspark.sql import SparkSession

from waitlens.registry import DEFAULT, PLANS, Context, Params
from waitlens.sources.catalog import Tables, check_keys
from waitlens.sources.writers import write_table


def run(spark: SparkSession, tables: Tables, out_dir: str, *, params: Params = DEFAULT,
        names: Iterable[str] | None = None, fmt: str = "parquet", keys: bool = True) -> dict[str, str]:
    """Check the dimension keys (``keys``), materialize the shared facts under ``out_dir/_facts`` and write each
    named analysis (all by default) to ``out_dir/<name>``. Returns the paths."""
    if keys:
        check_keys(tables)
    ctx = Context(tables, params, os.path.join(out_dir, "_published"))
    ctx.materialize(os.path.join(out_dir, "_facts"))
    written = {}
    for name in names or PLANS:
        target = os.path.join(out_dir, name)
        write_table(PLANS[name](ctx), target, fmt=fmt)
        written[name] = target
    return written


def load_config(path: str):
    """Read ``{"inputs": {...}, "params": {...}}`` from a JSON file into
    ``InputPaths`` and ``Params``. Each input is a path or an object with
    ``path``, ``fmt``, ``sep``, ``encoding``, ``skip_lines``."""
    import json

    from waitlens.sources.config import InputPaths, Source

    with open(path, encoding="utf-8") as fh:
        cfg = json.load(fh)

    def source(value) -> Source:
        return Source(value) if isinstance(value, str) else Source(**value)

    inputs = dict(cfg["inputs"])
    extras = {k: source(v) for k, v in inputs.pop("extras", {}).items()}
    plain = {k: inputs.pop(k) for k in list(inputs) if k.startswith("programming_")}
    renames = plain.get("programming_renames", {})  # places are text in JSON
    plain["programming_renames"] = {site: {int(i): name for i, name in places.items()} for site, places in renames.items()}
    paths = InputPaths(**{k: source(v) for k, v in inputs.items()}, extras=extras, **plain)
    params = Params(**{k: (tuple(v) if isinstance(v, list) else v) for k, v in cfg.get("params", {}).items()})
    return paths, params


def main(argv: list[str] | None = None) -> None:
    """``python -m waitlens.workflow config.json out_dir [analysis ...]``"""
    import sys

    from waitlens.session import get_session

    args = list(sys.argv[1:] if argv is None else argv)
    if len(args) < 2:
        raise SystemExit("usage: python -m waitlens.workflow config.json out_dir [analysis ...]")
    paths, params = load_config(args[0])
    spark = get_session(app_name="waitlens-workflow")
    for name, target in run(spark, Tables.from_paths(spark, paths), args[1], params=params,
                            names=args[2:] or None).items():
        print(f"{name}\t{target}")


if __name__ == "__main__":
    main()
