"""Period jobs over the events."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_trunc
from ..session import new_folder
from ..sources import catalog, periods
from ..sources.tables import write_table
from .registry import Tables, registrar, rows_counted

QUERIES: dict = {}
ORACLES: dict = {}
job = registrar(QUERIES, ORACLES)

START, STOP = "2023-12-27 12:00:00", "2024-02-05 00:00:00"


@job("""WITH edges AS (SELECT max(ts) AS start, TIMESTAMP '2024-02-04 23:59:59.999' AS stop
  FROM events WHERE ts < TIMESTAMP '2024-01-16')
SELECT p.period, start, stop, CASE p.period
    WHEN 'week' THEN date_diff('day', date_trunc('week', start + INTERVAL 1 DAY), date_trunc('week', stop + INTERVAL 1 DAY)) // 7
    WHEN 'hour' THEN date_diff('hour', start, stop) WHEN 'day' THEN date_diff('day', start, stop)
    ELSE date_diff('month', start, stop) END + 1 AS num_periods
FROM edges, (VALUES ('hour'), ('day'), ('week'), ('month')) AS p(period)""")
def period_boundaries(t: Tables) -> DataFrame:
    """Where a resumed load goes on, and how many periods are left, per period length."""
    loaded = t.events.where("ts < timestamp_ntz'2024-01-16 00:00:00'")
    rows = [
        periods.boundary_row(t.spark, period, START, STOP, loaded, "ts") for period in ("hour", "day", "week", "month")
    ]
    return reduce(DataFrame.unionAll, rows)


@job("""SELECT period, event_type, count(*) AS num_rows FROM (
  SELECT event_type, CAST(ceil(epoch_us(ts) / 604800000000.0 - epoch_us(TIMESTAMP '2023-12-27 12:00:00') / 604800000000.0) AS BIGINT) - 1 AS period
  FROM events WHERE ts > TIMESTAMP '2023-12-27 12:00:00' AND ts < TIMESTAMP '2024-02-04 23:59:59.999')
GROUP BY 1, 2""")
def period_slice(t: Tables) -> DataFrame:
    """Each week's slice on its own, counted per type."""
    limits = periods.boundaries(t.spark, "week", START, STOP)
    slices = [
        t.events.where(periods.in_period("ts", limits, i))
        .groupBy("event_type")
        .agg(rows_counted())
        .withColumn("period", F.lit(i).cast("long"))
        for i in range(limits.count)
    ]
    return reduce(DataFrame.unionByName, slices)


_WINDOW = "SELECT * FROM events WHERE ts > TIMESTAMP '2023-12-27 12:00:00' AND ts < TIMESTAMP '2024-02-04 23:59:59.999'"


@job(_WINDOW)
def period_backfill(t: Tables) -> DataFrame:
    """A daily load that stops after sixteen days, is resumed, and ends up whole."""
    path, events = new_folder(t.spark, "backfill"), t.events
    load = {"source": events, "path": path, "timestamp_field": "ts",
            "start_date": START, "stop_date": STOP, "period": "day"}
    periods.insert_by_period(**load, max_periods=16, periods_per_job=8)
    periods.insert_by_period(**load, periods_per_job=12)
    return periods.read_loaded(t.spark, path, events.schema)


@job(f"SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, event_type, count(*) AS num_rows FROM ({_WINDOW}) GROUP BY ALL")
def period_rollup_load(t: Tables) -> DataFrame:
    """A model that aggregates, loaded week by week; days cut by a week edge are added up."""
    path, events = new_folder(t.spark, "rollup"), t.events

    def daily(rows: DataFrame) -> DataFrame:
        day = date_trunc("day", "ts").alias("day")
        return rows.groupBy(day, "event_type").agg(rows_counted("n"), F.max("ts").alias("ts"))

    periods.insert_by_period(events, path, "ts", START, STOP, "week", model=daily)
    loaded = periods.read_loaded(t.spark, path, "day timestamp_ntz, event_type string, n long")
    return loaded.groupBy("day", "event_type").agg(F.sum("n").alias("num_rows"))


@job("""SELECT o_orderstatus, o_orderpriority, count(*) AS num_rows, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total,
min(CAST(o_orderdate AS DATE)) AS first_day FROM orders GROUP BY 1, 2""")
def typed_csv_load(t: Tables) -> DataFrame:
    """Orders through a CSV file, read back under a declared schema with two overrides."""
    path = new_folder(t.spark, "csv")
    t.orders.write.csv(path, header=True)
    declared = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in t.orders.schema.fields)
    loaded = catalog.read_typed_csv(
        t.spark, path, declared, {"o_totalprice": "decimal(18,2)", "o_custkey": "string"}
    )
    return loaded.groupBy("o_orderstatus", "o_orderpriority").agg(
        rows_counted(),
        F.sum("o_totalprice").cast("decimal(28,2)").alias("total"),
        F.min(F.col("o_orderdate").cast("date")).alias("first_day"),
    )


@job("""SELECT c_nationkey, count(*) AS num_orders, max(o_orderdate) AS last_order
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
def rebuild(t: Tables) -> DataFrame:
    """A table written, then replaced as a whole."""
    path = new_folder(t.spark, "rebuild")
    write_table(t.customer.groupBy("c_nationkey").agg(rows_counted("num_customers")), path)
    orders = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    write_table(
        orders.groupBy("c_nationkey").agg(
            rows_counted("num_orders"), F.max("o_orderdate").alias("last_order")
        ),
        path,
    )
    return t.spark.read.parquet(path)
