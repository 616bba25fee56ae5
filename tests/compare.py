"""Run every registered query in Spark and its oracle SQL in DuckDB on one
scale factor and compare row counts, column names and values (order-insensitive)."""

from __future__ import annotations

import math
import sys
import time

import duckdb

sys.path.insert(0, "/root/repo")
import __spark_entry__ as E  # noqa: E402
import waitlens.registry as R  # noqa: E402

SPARK_TO_DUCK = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "date": "DATE",
                 "boolean": "BOOLEAN"}
LIBRARY = set(R.QUERIES)
# A green row on empty results proves nothing: at sf0.01 no column of a library
# query may hold nulls only, but for these (open referrals have no exit).
EMPTY_IS_BAD = False
OPEN = ("f_salida", "c_salida", "causal")
EMPTY = {"referrals_enriched": OPEN, "referrals_v2": OPEN, "specialty_extract": OPEN, "under15_open": OPEN, "misrouted_by_pattern": OPEN, "misrouted_by_regex": OPEN,
         "production_grain_report": ("codigosigte",)}
EXACT = True  # floats must agree to the last bit

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v) if EXACT else round(v, 9)
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10]
    return v


def rows_key(rows):
    return sorted((tuple(norm(x) for x in r) for r in rows), key=lambda t: tuple((x is None, str(x)) for x in t))


def main(sf_dir: str, names: list[str]) -> int:
    import os
    if os.environ.get("PLAIN_SESSION"):
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
                 .config("spark.ui.enabled", "false").getOrCreate())
    else:
        from waitlens.session import get_session
        spark = get_session("local[8]", shuffle_partitions=8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            cols = df.columns
            srows = [tuple(r) for r in df.collect()]
            if name not in sqls:
                print(f"{name:30s} spark-only rows={len(srows)}")
                continue
            res = con.execute(sqls[name])
            dcols = [d[0] for d in res.description]
            dtypes = {d[0]: str(d[1]) for d in res.description}
            drows = res.fetchall()
            stypes = {f.name: f.dataType.simpleString() for f in df.schema.fields}
            type_bad = {c: (stypes[c], dtypes.get(c)) for c in stypes
                        if c in dtypes and SPARK_TO_DUCK.get(stypes[c], stypes[c]) != dtypes[c]}
            order = sorted(range(len(cols)), key=lambda i: cols[i])
            dorder = sorted(range(len(dcols)), key=lambda i: dcols[i])
            same_cols = sorted(cols) == sorted(dcols)
            a = rows_key([tuple(r[i] for i in order) for r in srows])
            b = rows_key([tuple(r[i] for i in dorder) for r in drows]) if same_cols else None
            ok = same_cols and a == b and not type_bad
            status = "OK " if ok else "BAD"
            if not ok:
                bad += 1
            print(f"{name:30s} {status} spark={len(srows)} duck={len(drows)} {time.time() - t0:5.1f}s", flush=True)
            empty = [c for i, c in enumerate(cols) if c not in EMPTY.get(name, ()) and all(r[i] is None for r in srows)]
            if EMPTY_IS_BAD and (empty or not srows) and name in LIBRARY:
                bad += 1
                print("   nothing but nulls:", empty or "no rows")
            if type_bad:
                print("   types spark/duck:", type_bad)
            if not same_cols:
                print("   cols spark-duck:", sorted(set(cols) - set(dcols)), "duck-spark:", sorted(set(dcols) - set(cols)))
            elif not ok:
                diff_a = [r for r in a if r not in set(b)][:3]
                diff_b = [r for r in b if r not in set(a)][:3]
                print("   spark only:", diff_a, "\n   duck only:", diff_b)
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"{name:30s} ERR {type(e).__name__}: {str(e)[:300]}", flush=True)
    return bad


if __name__ == "__main__":
    EMPTY_IS_BAD = "0.001" not in " ".join(sys.argv)
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    sys.exit(1 if main(sf, sys.argv[2:]) else 0)
