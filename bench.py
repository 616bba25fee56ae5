"""Benchmark: load step + every registered query on one scale factor.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8), ``BENCH_EVENT_LOG`` (optional folder for Spark's event log).
Prints one JSON line.

The load step derives the domain tables from the test tables and publishes
them as Parquet, then writes the shared facts (enriched lists, combined
production, programming) once, as the reference's load scripts do; each
query then runs from those tables to completion (``noop`` sink: the whole
plan executes, nothing is collected).
"""

from __future__ import annotations

import json
import os
import sys
import uuid
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from waitlens.registry import PLANS, TEST, Context  # noqa: E402
from waitlens.session import ensure_checkpoint_dir, get_session  # noqa: E402
from waitlens.sources.catalog import Tables, publish  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    extra = {}
    if os.environ.get("BENCH_EVENT_LOG"):  # stage and task times, read offline from this folder
        os.makedirs(os.environ["BENCH_EVENT_LOG"], exist_ok=True)
        extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG"]}
    spark = get_session(f"local[{cpus}]", app_name="waitlens-bench", shuffle_partitions=cpus * 2,
                        driver_memory=os.environ.get("BENCH_DRIVER_MEMORY", "8g"), extra_conf=extra)
    spark.sparkContext.setLogLevel("ERROR")
    # Written tables go under the session's shared checkpoint folder (set by
    # the cluster; a local scratch folder only when it is unset).
    base = ensure_checkpoint_dir(spark).replace("file:", "")
    scratch = os.path.join(base, f"bench-{uuid.uuid4().hex[:8]}")
    times: dict[str, float] = {}

    sc = spark.sparkContext
    t0 = time.time()
    sc.setJobDescription("load")  # labels the jobs in the event log
    published = os.path.join(scratch, "tables")
    publish(Tables.from_driver(spark, sf_dir, staging=os.path.join(scratch, "staging")), published)
    ctx = Context(Tables.from_dir(spark, published), TEST, os.path.join(scratch, "published"))
    ctx.materialize(os.path.join(scratch, "facts"))
    times["load"] = round(time.time() - t0, 3)

    names = sys.argv[1:] or list(PLANS)
    for name in names:
        sc.setJobDescription(name)
        t = time.time()
        PLANS[name](ctx).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t, 3)

    sf = os.path.basename(sf_dir).replace("sf", "")
    query_sec = round(sum(v for k, v in times.items() if k != "load"), 3)
    print(json.dumps({"metric": "load_plus_queries_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "load_sec": times["load"], "queries_sec": query_sec, "cpus": cpus, "n_queries": len(names)}))
    spark.stop()


if __name__ == "__main__":
    main()
