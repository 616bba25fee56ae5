"""Dated snapshots of the waiting lists.

The lists arrive as extracts of a cut-off date and a state (open, closed). They are kept as one table
with folders by date and state: publishing a date again replaces only its own folders (dynamic
partition overwrite), and a reader of some dates opens only theirs.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waitlens.sources.catalog import folder_names

DATE, STATE = "fecha_corte", "estado"
OPEN, CLOSED = "abierta", "cerrada"


def publish_snapshot(rows: DataFrame, path: str, *, date: str | dt.date, state: str,
                     sort_by: Sequence[str] = ("estab_dest", "presta_min")) -> None:
    """Write the list of one date and state, in place of an earlier one of that date and state."""
    date = dt.date.fromisoformat(str(date))
    place = f"{path.rstrip('/')}/{DATE}={date}/{STATE}={state}"
    if rows.isEmpty():  # dynamic overwrite touches no folder without rows
        rows.write.mode("overwrite").parquet(place)
        return
    dated = rows.withColumns({DATE: F.lit(date), STATE: F.lit(state)}).sortWithinPartitions(*sort_by)
    (dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DATE, STATE).parquet(path))


def snapshot_dates(spark: SparkSession, path: str) -> list[dt.date]:
    """Dates with a snapshot, from the folder names."""
    mark = f"{DATE}="
    return sorted(dt.date.fromisoformat(n.removeprefix(mark)) for n in folder_names(spark, path) if n.startswith(mark))


def read_snapshots(spark: SparkSession, path: str, *, dates: Sequence[str | dt.date] | None = None,
                   state: str | None = None) -> DataFrame:
    """Snapshots of some dates (all by default) and one state (both by default), with their date and
    state as columns. The filters are on folders, so no other folder is opened."""
    df = spark.read.parquet(path)
    if dates is not None:
        df = df.where(F.col(DATE).isin([dt.date.fromisoformat(str(d)) for d in dates]))
    return df if state is None else df.where(F.col(STATE) == state)


def snapshot_at(spark: SparkSession, path: str, at: str | dt.date, state: str = OPEN) -> DataFrame:
    """The latest snapshot taken on ``at`` or before it, without date and state columns."""
    day = dt.date.fromisoformat(str(at))
    earlier = [d for d in snapshot_dates(spark, path) if d <= day]
    if not earlier:
        raise ValueError(f"no snapshot on or before {day} in {path}")
    return read_snapshots(spark, path, dates=[earlier[-1]], state=state).drop(DATE, STATE)
