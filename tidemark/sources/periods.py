"""Period-by-period load into a partitioned table, resumable after a failure.

Periods lie on one grid from the start date on, each is written as its own
partition by overwriting it, and the load resumes at the period that holds the
newest loaded row. A period that was cut off is therefore written again in full.
The newest timestamp of every loaded period is kept beside the table, in a small
map that is replaced after each job, so that resuming reads no row.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import as_timestamp, check_part, dateadd, datediff, moment
from ..session import child_paths, matching_paths, path_exists, read_text, remove_path, write_text

PERIOD_COLUMN = "period_start"
#: The folder of the map; Spark does not read folders that begin like this.
ZONES = "_zones"


@dataclass(frozen=True)
class Boundaries:
    """``count`` periods from ``start``; rows at or after ``stop`` are left out."""

    start: datetime
    stop: datetime
    period: str
    count: int

    def edge(self, index: int) -> Column:
        return dateadd(self.period, index, moment(self.start))


def boundaries(
    spark: SparkSession,
    period: str,
    start_date,
    stop_date=None,
    target: DataFrame | None = None,
    timestamp_field: str | None = None,
) -> Boundaries:
    """Where a load starts, where it stops and how many periods lie between.

    It starts at the newest row of ``target``, or at ``start_date`` when there
    is none; it stops a millisecond before ``stop_date``, or now.
    """
    row = boundary_row(spark, period, start_date, stop_date, target, timestamp_field).first()
    return Boundaries(row["start"], row["stop"], check_part(period), max(row["num_periods"], 0))


def boundary_row(
    spark: SparkSession,
    period: str,
    start_date,
    stop_date=None,
    target: DataFrame | None = None,
    timestamp_field: str | None = None,
) -> DataFrame:
    """(period, start, stop, num_periods) as a plan of one row."""
    period = check_part(period)
    start = moment(start_date)
    if target is None:
        edges = spark.range(1).select(start.alias("start"))
    else:
        edges = target.agg(F.coalesce(F.max(as_timestamp(timestamp_field)), start).alias("start"))
    stop = F.localtimestamp() if stop_date is None else dateadd("millisecond", -1, moment(stop_date))
    edges = edges.withColumn("stop", stop)
    return edges.select(
        F.lit(period).alias("period"), "start", "stop", (datediff("start", "stop", period) + 1).alias("num_periods")
    )


def in_period(
    timestamp_field: str, limits: Boundaries, index: int, end: int | None = None
) -> Column:
    """Rows after the start of period ``index``, up to the start of ``end``, before the stop."""
    ts, end = F.col(timestamp_field), index + 1 if end is None else end
    # periods end where the next one starts, so clipped month ends leave no gap
    return (ts > limits.edge(index)) & (ts <= limits.edge(end)) & (
        ts < moment(limits.stop)
    )


def period_index(timestamp_field, limits: Boundaries) -> Column:
    """The number of the period a row falls into; negative up to the start."""
    ts = as_timestamp(timestamp_field)
    # the edge that many units after the start lies in the same unit as the row
    units = datediff(moment(limits.start), ts, limits.period)
    return units - (ts <= dateadd(limits.period, units, moment(limits.start))).cast("long")


def insert_by_period(
    source: DataFrame,
    path: str,
    timestamp_field: str,
    start_date,
    stop_date=None,
    period: str = "week",
    model: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    full_refresh: bool = False,
    max_periods: int | None = None,
    periods_per_job: int = 1,
) -> dict[int, int]:
    """Load ``model(slice)`` period by period; returns rows written per job.

    The keys are the first period of each job. ``periods_per_job`` loads that
    many periods from one scan, each still into its own partition, for sources
    that are not clustered by time. The model must then keep the timestamp.
    ``max_periods`` ends the run early; the next run goes on from there.
    """
    spark = source.sparkSession
    limits = boundaries(spark, period, start_date, stop_date)
    zones = {} if full_refresh else _zones(spark, path, timestamp_field)
    first = _resume_index(spark, limits, zones)
    if first is None:
        first, zones = 0, {}
        empty = model(source.where(F.lit(False)))
        (
            empty.withColumn(PERIOD_COLUMN, F.lit(None).cast("timestamp_ntz"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .partitionBy(PERIOD_COLUMN)
            .parquet(path)
        )
    written: dict[int, int] = {}
    last = limits.count if max_periods is None else min(limits.count, first + max_periods)
    for index in range(first, last, periods_per_job):
        end = min(index + periods_per_job, last)
        rows = model(source.where(in_period(timestamp_field, limits, index, end)))
        if end - index > 1:
            number = period_index(timestamp_field, limits)
            rows = rows.withColumn(PERIOD_COLUMN, dateadd(period, number, moment(limits.start)))
            # whole files per period instead of one per task and period; Spark splits
            # a period that is much larger than the others
            rows = rows.hint("rebalance", F.col(PERIOD_COLUMN))
        else:
            rows = rows.withColumn(PERIOD_COLUMN, limits.edge(index))
        edges = _edges(spark, limits, index, end)
        before = _files(spark, path, edges)
        seen, newest = Observation(), []
        if timestamp_field in rows.columns:
            ts = as_timestamp(timestamp_field)
            newest = [
                F.max(F.when(F.col(PERIOD_COLUMN) == F.lit(edge).cast("timestamp_ntz"), ts)).cast("string").alias(f"n{i}")
                for i, edge in enumerate(edges)
            ]
        (
            rows.observe(seen, F.count(F.lit(1)).alias("rows"), *newest)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(PERIOD_COLUMN)
            .parquet(path)
        )
        written[index] = seen.get["rows"]
        # dynamic overwrite leaves a period alone that has no rows any more
        kept = set(before) & set(_files(spark, path, edges))
        for folder in {before[file] for file in kept}:
            remove_path(spark, folder)
        found = {edge: seen.get.get(f"n{i}") for i, edge in enumerate(edges)}
        zones = {edge: time for edge, time in (zones | found).items() if time is not None}
        _write_zones(spark, path, zones)
    return written


def _edges(spark: SparkSession, limits: Boundaries, index: int, end: int) -> list[str]:
    """The starts of some periods, as their folders are named."""
    edges = [limits.edge(i).cast("string").alias(f"e{i}") for i in range(index, end)]
    return list(spark.range(1).select(*edges).first())


def _zones(spark: SparkSession, path: str, timestamp_field: str) -> dict[str, str]:
    """The newest timestamp of each loaded period that has rows."""
    maps = matching_paths(spark, f"{path}/{ZONES}/*.json")
    if maps:
        return json.loads(read_text(spark, maps[-1]))
    return _zones_of_table(spark, path, timestamp_field) if path_exists(spark, path) else {}


def _zones_of_table(spark: SparkSession, path: str, timestamp_field: str) -> dict[str, str]:
    """The map of a table that has none, from its timestamp column and nothing else."""
    loaded = spark.read.schema(f"`{timestamp_field}` timestamp_ntz, {PERIOD_COLUMN} timestamp_ntz").parquet(path)
    newest = loaded.groupBy(F.col(PERIOD_COLUMN).cast("string").alias("edge")).agg(F.max(timestamp_field).cast("string").alias("t"))
    return {r["edge"]: r["t"] for r in newest.where("t is not null").collect()}


def _write_zones(spark: SparkSession, path: str, zones: dict[str, str]) -> None:
    """The map, after the rows that it tells of. The newest file counts."""
    maps = matching_paths(spark, f"{path}/{ZONES}/*.json")
    number = int(maps[-1].rsplit("/", 1)[1].split(".")[0]) + 1 if maps else 0
    write_text(spark, f"{path}/{ZONES}/{number:09d}.json", json.dumps(zones))
    for old in maps:
        remove_path(spark, old)


def _files(spark: SparkSession, path: str, edges: list[str]) -> dict[str, str]:
    """The files of some periods, each with its folder."""
    wanted = set(edges)
    folders = matching_paths(spark, f"{path}/{PERIOD_COLUMN}=*")
    own = [f for f in folders if unquote(f.rsplit(f"{PERIOD_COLUMN}=", 1)[1]) in wanted]
    return {file: folder for folder in own for file in child_paths(spark, folder)}


def read_loaded(spark: SparkSession, path: str, schema) -> DataFrame:
    """The loaded rows without the period column."""
    return spark.read.schema(schema).parquet(path).drop(PERIOD_COLUMN)


def _resume_index(spark: SparkSession, limits: Boundaries, zones: dict[str, str]) -> int | None:
    """The period holding the newest loaded row; None if nothing is loaded."""
    if not zones:
        return None
    newest = spark.range(1).select(F.lit(max(zones.values())).cast("timestamp_ntz").alias("t"))
    return max(newest.select(period_index("t", limits).alias("n")).first()["n"], 0)
