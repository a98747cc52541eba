"""SCD2 jobs: a change feed made from ``events`` and one made from orders.

Feed ``events``: source = user_id mod 5, key = user_id * 31 + event_id mod 31,
attributes = event_type and value, changed at ts, deleted at ts for 'error'.
The target holds what was known before 2024-01-16.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.lookups import as_of_join, lookup_left_join, value_spans
from ..plans import scd2
from ..plans.warehouse import DIM_USAGERS, SOURCES
from ..session import new_folder, written
from ..sources.history import HistoryStore
from ..sources.tables import sync_schema, upsert_by_key, write_table
from ..streaming.microbatch import scd2_stream
from .registry import Tables, exact_sum, registrar, rows_counted

QUERIES: dict = {}
ORACLES: dict = {}
job = registrar(QUERIES, ORACLES)

EVENTS = scd2.Spec(
    name="event_history",
    entity="events",
    sources=("R0", "R1", "R2", "R3", "R4"),
    id_column="id",
    columns={"id": "id", "event_type": "event_type", "value": "value"},
    tracked=("event_type", "value"),
)
SPLIT = "timestamp_ntz'2024-01-16 00:00:00'"


def event_feed(t: Tables) -> DataFrame:
    """All sources in one scan, before keys are built."""
    return t.events.select(
        "event_id",
        (F.col("user_id") * 31 + F.col("event_id") % 31).alias("id"),
        "event_type",
        "value",
        F.concat(F.lit("R"), (F.col("user_id") % 5).cast("string")).alias("src"),
        F.col("ts").alias(scd2.UPDATED),
        F.when(F.col("event_type") == "error", F.col("ts")).alias(scd2.DELETED),
    )


def event_rows(t: Tables) -> DataFrame:
    return scd2.with_keys(event_feed(t), EVENTS)


def before_split(rows: DataFrame) -> DataFrame:
    return rows.where(F.col(scd2.UPDATED) < F.expr(SPLIT))


def event_target(t: Tables) -> DataFrame:
    """The history after the first load, as a written table."""
    path = new_folder(t.spark, "event-target")
    write_table(scd2.initial(before_split(event_rows(t)), EVENTS), path)
    return t.spark.read.parquet(path)


_ROWS = """
WITH change_rows AS (
  SELECT 'R' || (user_id % 5) || '_' || (user_id * 31 + event_id % 31) AS src_id,
         user_id * 31 + event_id % 31 AS id, event_type, value, 'R' || (user_id % 5) AS src,
         ts AS _ab_cdc_updated_at,
         CASE WHEN event_type = 'error' THEN ts END AS _ab_cdc_deleted_at
  FROM events)"""
_NEWEST = """QUALIFY row_number() OVER (PARTITION BY src_id ORDER BY _ab_cdc_updated_at DESC
  NULLS FIRST, id, event_type, value, src, _ab_cdc_deleted_at) = 1"""
_OPENED = """md5(src_id || '-' || CAST(_ab_cdc_updated_at AS VARCHAR)) AS surrogate_key, src_id,
  id, event_type, value, src, _ab_cdc_updated_at, _ab_cdc_updated_at AS valid_from,
  CAST(NULL AS TIMESTAMP) AS valid_to, TRUE AS is_current"""
_TARGET = f"""{_ROWS},
first_rows AS (
  SELECT * FROM change_rows WHERE _ab_cdc_updated_at < TIMESTAMP '2024-01-16' {_NEWEST}),
target AS (SELECT {_OPENED} FROM first_rows)"""


def _steps(delete_rows: str = "change_rows") -> str:
    return f"""{_TARGET},
batch AS (
  SELECT * FROM change_rows
  WHERE _ab_cdc_updated_at > (SELECT max(_ab_cdc_updated_at) FROM target) {_NEWEST}),
changed_keys AS (
  SELECT s.* FROM batch s JOIN target t ON s.src_id = t.src_id AND t.is_current
  WHERE s.event_type IS DISTINCT FROM t.event_type OR s.value IS DISTINCT FROM t.value),
new_keys AS (
  SELECT * FROM batch s WHERE _ab_cdc_deleted_at IS NULL
  AND NOT EXISTS (SELECT 1 FROM target t WHERE t.src_id = s.src_id)),
deletes AS (
  SELECT t.src_id, min(r._ab_cdc_deleted_at) FILTER (r._ab_cdc_deleted_at >= t.valid_from) AS after,
         max(r._ab_cdc_deleted_at) AS latest
  FROM target t JOIN {delete_rows} r ON t.src_id = r.src_id
  WHERE t.is_current AND r._ab_cdc_deleted_at IS NOT NULL GROUP BY t.src_id),
inserted AS (
  SELECT {_OPENED} FROM (SELECT * FROM new_keys UNION ALL SELECT * FROM changed_keys)),
closed AS (
  SELECT t.* REPLACE (
      CASE WHEN c.src_id IS NOT NULL THEN least(c._ab_cdc_updated_at, d.after)
           ELSE coalesce(d.after, d.latest) END AS valid_to,
      FALSE AS is_current)
  FROM target t LEFT JOIN changed_keys c ON t.src_id = c.src_id
  LEFT JOIN deletes d ON t.src_id = d.src_id
  WHERE c.src_id IS NOT NULL OR d.src_id IS NOT NULL),
delta AS (SELECT * FROM closed UNION ALL SELECT * FROM inserted),
history AS (
  SELECT * FROM target WHERE surrogate_key NOT IN (SELECT surrogate_key FROM delta)
  UNION ALL SELECT * FROM delta)
"""


@job(f"{_ROWS} SELECT * EXCLUDE (src_id) FROM change_rows")
def scd2_collect(t: Tables) -> DataFrame:
    """Five source tables renamed and stacked from the spec."""
    feed = event_feed(t)
    return scd2.collect(EVENTS, lambda table: feed.where(F.col("src") == table[:2].upper()))


@job(f"{_ROWS}, newest AS (SELECT * FROM change_rows {_NEWEST}) SELECT {_OPENED} FROM newest")
def scd2_initial(t: Tables) -> DataFrame:
    return scd2.initial(event_rows(t), EVENTS)


@job(f"{_ROWS} SELECT * FROM change_rows {_NEWEST}")
def latest_per_key(t: Tables) -> DataFrame:
    return scd2.latest_per_key(event_rows(t))


@job(f"""{_TARGET} SELECT src, count(*) AS num_rows FROM change_rows
WHERE _ab_cdc_updated_at > (SELECT max(_ab_cdc_updated_at) FROM target) GROUP BY src""")
def watermark_filter(t: Tables) -> DataFrame:
    fresh = scd2.newer_than_target(event_rows(t), event_target(t))
    return fresh.groupBy("src").agg(rows_counted())


@job(f"{_steps()} SELECT * FROM changed_keys")
def scd2_changed(t: Tables) -> DataFrame:
    return scd2.changed(event_rows(t), event_target(t), EVENTS)


@job(f"""{_steps()} SELECT t.* REPLACE (c._ab_cdc_updated_at AS valid_to, FALSE AS is_current)
FROM target t JOIN changed_keys c ON t.src_id = c.src_id WHERE t.is_current""")
def scd2_expired(t: Tables) -> DataFrame:
    return scd2.expired(event_rows(t), event_target(t), EVENTS)


@job(f"{_steps()} SELECT * FROM new_keys")
def scd2_new(t: Tables) -> DataFrame:
    return scd2.new(event_rows(t), event_target(t), EVENTS)


@job(f"""{_steps()} SELECT t.* REPLACE (coalesce(d.after, d.latest) AS valid_to, FALSE AS is_current)
FROM target t JOIN deletes d ON t.src_id = d.src_id WHERE t.is_current""")
def scd2_deleted(t: Tables) -> DataFrame:
    return scd2.deleted(event_rows(t), event_target(t), EVENTS)


@job(f"{_steps()} SELECT * FROM inserted")
def scd2_inserts(t: Tables) -> DataFrame:
    return scd2.inserts(event_rows(t), event_target(t), EVENTS)


@job(f"{_steps()} SELECT * FROM delta")
def scd2_delta(t: Tables) -> DataFrame:
    return scd2.delta(event_rows(t), event_target(t), EVENTS)


@job(f"{_steps()} SELECT * FROM history")
def scd2_apply(t: Tables) -> DataFrame:
    """First load, then one incremental run, read back from the store."""
    store = HistoryStore(t.spark, new_folder(t.spark, "event-history"))
    rows = event_rows(t)
    store.load(before_split(rows), EVENTS)
    store.load(rows, EVENTS)
    return store.read()


@job("""SELECT 'R' || (user_id % 5) AS src, count(*) AS num_rows FROM events WHERE event_id % 17 = 0 GROUP BY 1""")
def scd2_rejected(t: Tables) -> DataFrame:
    """Rows without an id, as the store keeps them apart, per source."""
    store = HistoryStore(t.spark, new_folder(t.spark, "event-rejects"))
    known = event_feed(t).withColumn("id", F.when(F.col("event_id") % 17 != 0, F.col("id")))
    store.load(scd2.with_keys(known, EVENTS), EVENTS)
    return store.rejected().groupBy("src").agg(rows_counted())


# micro-batches: the days up to each edge, but a seventh of the rows comes a batch later, and
# of the last days a batch too early: rows are late, and deletes come before what they delete
_EDGES = ("2024-01-11", "2024-01-21", "2024-02-15")


def _batch_of(time: str, kind: str) -> str:
    """The batch of a row. ``kind`` is what an engine calls a timestamp without a zone."""
    day = f"CASE WHEN {time} < {kind} '{_EDGES[0]}' THEN 0 WHEN {time} < {kind} '{_EDGES[1]}' THEN 1 ELSE 2 END"
    return f"CASE WHEN event_id % 7 = 0 THEN ({day} + 1) % 3 ELSE {day} END"


def _stream_step(k: int) -> str:
    """The table and what is remembered of keys after one more batch."""
    return f""",
rows{k} AS (SELECT * EXCLUDE (batch) FROM change_rows WHERE batch = {k - 1}),
newest{k} AS (SELECT * FROM rows{k} {_NEWEST}),
leave{k} AS (
  SELECT src_id, max(greatest(_ab_cdc_deleted_at, _ab_cdc_updated_at)) AS gone FROM rows{k}
  WHERE _ab_cdc_deleted_at IS NOT NULL GROUP BY src_id),
open{k} AS (
  SELECT t.*, greatest(t._ab_cdc_updated_at, m.seen) AS known, greatest(t.valid_from, m.seen) AS since
  FROM history{k - 1} t LEFT JOIN memory{k - 1} m ON t.src_id = m.src_id WHERE t.is_current),
after{k} AS (
  SELECT t.src_id, min(r._ab_cdc_deleted_at) AS after FROM open{k} t
  JOIN rows{k} r ON t.src_id = r.src_id AND r._ab_cdc_deleted_at >= t.since GROUP BY t.src_id),
judged{k} AS (
  SELECT s.*, t.src_id IS NOT NULL AS is_open, l.gone AS left_at, greatest(l.gone, m.gone) AS gone, a.after,
         t.src_id IS NULL OR s._ab_cdc_updated_at > t.known AS fresh,
         coalesce(l.gone >= t.known, FALSE) AS is_deleted,
         t.src_id IS NOT NULL AND s._ab_cdc_updated_at > t.known AND (
           s.event_type IS DISTINCT FROM t.event_type OR s.value IS DISTINCT FROM t.value
           OR s._ab_cdc_deleted_at IS NOT NULL) AS is_changed
  FROM newest{k} s LEFT JOIN open{k} t ON s.src_id = t.src_id LEFT JOIN leave{k} l ON s.src_id = l.src_id
  LEFT JOIN memory{k - 1} m ON s.src_id = m.src_id LEFT JOIN after{k} a ON s.src_id = a.src_id),
closed{k} AS (
  SELECT t.* REPLACE (
      CASE WHEN is_changed THEN least(s._ab_cdc_updated_at, after) ELSE coalesce(after, left_at) END AS valid_to,
      FALSE AS is_current)
  FROM history{k - 1} t JOIN judged{k} s ON s.src_id = t.src_id
  WHERE t.is_current AND (is_changed OR is_deleted)),
opened{k} AS (
  SELECT * FROM judged{k} WHERE _ab_cdc_deleted_at IS NULL AND fresh
    AND (gone IS NULL OR gone < _ab_cdc_updated_at) AND (NOT is_open OR is_changed OR is_deleted)),
history{k} AS (
  SELECT * FROM history{k - 1} WHERE surrogate_key NOT IN (SELECT surrogate_key FROM closed{k})
  UNION ALL SELECT * FROM closed{k} UNION ALL SELECT {_OPENED} FROM opened{k}),
memory{k} AS (
  SELECT src_id, max(seen) AS seen, max(gone) AS gone FROM (
    SELECT * FROM memory{k - 1} UNION ALL SELECT src_id, NULL, gone FROM leave{k}
    UNION ALL SELECT src_id, _ab_cdc_updated_at, NULL FROM judged{k}
      WHERE is_open AND fresh AND NOT is_changed AND NOT is_deleted AND _ab_cdc_deleted_at IS NULL)
  GROUP BY src_id)"""


_BATCH = _batch_of("ts", "TIMESTAMP")
_STREAM = f"""{_ROWS.replace("SELECT", f"SELECT {_BATCH} AS batch,", 1)},
history0 AS (SELECT {_OPENED} FROM change_rows WHERE FALSE),
memory0 AS (SELECT src_id, _ab_cdc_updated_at AS seen, _ab_cdc_updated_at AS gone FROM change_rows WHERE FALSE)"""
_STREAM += "".join(map(_stream_step, (1, 2, 3)))


@job(f"{_STREAM} SELECT * FROM history3", name="scd2_stream")
def scd2_stream_batches(t: Tables) -> DataFrame:
    """The feed as micro-batches of a file stream, some rows late and some early."""
    feed, table = new_folder(t.spark, "event-feed"), new_folder(t.spark, "event-stream")
    store, rows = HistoryStore(t.spark, f"{table}/history"), event_feed(t)
    number = F.expr(_batch_of(scd2.UPDATED, "timestamp_ntz"))
    for batch in range(3):
        arrived = scd2.with_keys(rows.where(number == batch), EVENTS)
        arrived.write.mode("append").parquet(feed)
        stream = t.spark.readStream.schema(arrived.schema).parquet(feed)
        scd2_stream(stream, store, EVENTS, f"{table}/checkpoint").awaitTermination()
    return store.read()


# ------------------------------------------------------------ orders as a feed

ORDERS = scd2.Spec(
    name="order_history",
    entity="orders",
    sources=("R0", "R1", "R2", "R3", "R4"),
    id_column="o_orderkey",
    columns={
        "o_orderkey": "o_orderkey",
        "o_custkey": "o_custkey",
        "status": "status",
        "total": "total",
    },
    foreign_keys={"src_custkey": "o_custkey"},
    tracked=("src_custkey", "status", "total"),
)
ORDER_SPLIT = "timestamp_ntz'1998-06-01 00:00:00'"


def order_rows(t: Tables) -> DataFrame:
    """Orders as placed, and again as shipped: last ship date, status S, line total."""
    shipped = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("shipped_total"),
        F.max("l_shipdate").alias("shipped_at"),
    )
    regions = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("o_custkey"),
        F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("src"),
    )
    orders = t.orders.join(regions, "o_custkey").join(shipped, "o_orderkey", "left")
    states = F.array(
        F.struct(
            F.col("o_orderstatus").alias("status"),
            F.col("o_totalprice").alias("total"),
            F.col("o_orderdate").alias(scd2.UPDATED),
        ),
        F.struct(
            F.lit("S").alias("status"),
            F.col("shipped_total").alias("total"),
            F.col("shipped_at").alias(scd2.UPDATED),
        ),
    )
    known = F.filter(states, lambda s: s[scd2.UPDATED].isNotNull())
    feed = orders.select("o_orderkey", "o_custkey", "src", F.inline(known)).withColumn(
        scd2.DELETED, F.lit(None).cast("timestamp_ntz")
    )
    return scd2.with_keys(feed, ORDERS)


_ORDER_NEWEST = """QUALIFY row_number() OVER (PARTITION BY src_id ORDER BY _ab_cdc_updated_at DESC
  NULLS FIRST, o_orderkey, src_custkey, status, total, src) = 1"""
_ORDER_OPENED = _OPENED.replace("id, event_type, value,", "o_orderkey, src_custkey, status, total,")
_ORDER_ROWS = f"""
WITH shipped AS (
  SELECT l_orderkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
         max(l_shipdate) AS at FROM lineitem GROUP BY l_orderkey),
placed AS (
  SELECT o.*, 'R' || n_regionkey AS src FROM orders o
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
states AS (
  SELECT o_orderkey, o_custkey, src, o_orderstatus AS status, o_totalprice AS total,
         o_orderdate AS _ab_cdc_updated_at FROM placed
  UNION ALL
  SELECT o_orderkey, o_custkey, src, 'S', s.total, s.at FROM placed JOIN shipped s ON l_orderkey = o_orderkey),
change_rows AS (
  SELECT src || '_' || o_orderkey AS src_id, o_orderkey, src || '_' || o_custkey AS src_custkey,
         status, total, src, _ab_cdc_updated_at FROM states)"""
_ORDER_TARGET = f"""{_ORDER_ROWS},
first_rows AS (
  SELECT * FROM change_rows WHERE _ab_cdc_updated_at < TIMESTAMP '1998-06-01' {_ORDER_NEWEST}),
target AS (SELECT {_ORDER_OPENED} FROM first_rows)"""


@job(f"{_ORDER_ROWS}, newest AS (SELECT * FROM change_rows {_ORDER_NEWEST}) SELECT {_ORDER_OPENED} FROM newest")
def scd2_orders_initial(t: Tables) -> DataFrame:
    return scd2.initial(order_rows(t), ORDERS)


@job(f"""{_ORDER_TARGET},
batch AS (
  SELECT * FROM change_rows
  WHERE _ab_cdc_updated_at > (SELECT max(_ab_cdc_updated_at) FROM target) {_ORDER_NEWEST}),
changed_keys AS (
  SELECT s.* FROM batch s JOIN target t ON s.src_id = t.src_id
  WHERE s.src_custkey IS DISTINCT FROM t.src_custkey OR s.status IS DISTINCT FROM t.status
     OR s.total IS DISTINCT FROM t.total),
new_keys AS (SELECT * FROM batch WHERE src_id NOT IN (SELECT src_id FROM target))
SELECT t.* REPLACE (c._ab_cdc_updated_at AS valid_to, FALSE AS is_current)
FROM target t JOIN changed_keys c ON t.src_id = c.src_id
UNION ALL SELECT {_ORDER_OPENED} FROM (SELECT * FROM changed_keys UNION ALL SELECT * FROM new_keys)""")
def scd2_orders_delta(t: Tables) -> DataFrame:
    path, rows = new_folder(t.spark, "order-target"), order_rows(t)
    early = rows.where(F.col(scd2.UPDATED) < F.expr(ORDER_SPLIT))
    write_table(scd2.initial(early, ORDERS), path)
    return scd2.delta(rows, t.spark.read.parquet(path), ORDERS)


# ------------------------------------------------------------- building blocks


@job("""
SELECT n_regionkey AS source, unified_code, count(*) AS num_rows FROM (
  SELECT n_regionkey, CAST(CASE
    WHEN n_regionkey = 0 AND code = 5 THEN 7
    WHEN n_regionkey = 1 AND code = 4 THEN 10 WHEN n_regionkey = 1 AND code = 5 THEN 8
    WHEN n_regionkey = 2 AND code = 4 THEN 6 WHEN n_regionkey = 2 AND code = 5 THEN 12
    WHEN n_regionkey = 3 AND code = 4 THEN 5 WHEN n_regionkey = 3 AND code = 5 THEN 11
    WHEN n_regionkey = 4 AND code = 5 THEN 9 ELSE code END AS INTEGER) AS unified_code
  FROM (SELECT n_regionkey, CAST(split_part(o_orderpriority, '-', 1) AS INTEGER) AS code
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey))
GROUP BY ALL""")
def code_harmonise(t: Tables) -> DataFrame:
    """Order priorities as codes each region spells differently, unified and counted."""
    customers = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    orders = t.orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    code = F.split_part("o_orderpriority", F.lit("-"), F.lit(1)).cast("int")
    unified = F.lit(None).cast("int")
    for number, source in enumerate(SOURCES):
        remap = DIM_USAGERS.remaps[source]["type_usagers_id"]
        unified = F.when(F.col("n_regionkey") == number, remap.apply(code)).otherwise(unified)
    return (
        orders.select(F.col("n_regionkey").alias("source"), unified.alias("unified_code"))
        .groupBy("source", "unified_code")
        .agg(rows_counted())
    )


@job(
    """SELECT c_mktsegment, count(*) AS num_orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal >= 0) ON o_custkey = c_custkey
GROUP BY c_mktsegment""",
    name="lookup_left_join",
)
def orders_by_segment(t: Tables) -> DataFrame:
    """Orders with the segment of customers in credit; the others' orders get null."""
    lookup = t.customer.where("c_acctbal >= 0").select(
        F.col("c_custkey").alias("o_custkey"), "c_mktsegment"
    )
    joined = lookup_left_join(t.orders, lookup, "o_custkey", broadcast_rows=100_000)
    return joined.groupBy("c_mktsegment").agg(
        rows_counted("num_orders"), exact_sum("o_totalprice", "total")
    )


# A lookup that changes: every signup sets the label of a group of its source.
_LABELS = """
labels AS (
  SELECT 'R' || (user_id % 5) AS lookup_src, event_id % 23 AS lookup_key, ts AS since, max(value) AS label
  FROM events WHERE event_type = 'signup' GROUP BY ALL),
states AS (
  SELECT * FROM labels WINDOW w AS (PARTITION BY lookup_src, lookup_key ORDER BY since)
  QUALIFY row_number() OVER w = 1 OR label IS DISTINCT FROM lag(label) OVER w),
spans AS (
  SELECT *, lead(since) OVER (PARTITION BY lookup_src, lookup_key ORDER BY since) AS until FROM states)"""
_GROUPED = """
grouped AS (
  SELECT 'R' || (user_id % 5) || '_' || (user_id * 31 + event_id % 31) AS src_id,
         user_id * 31 + event_id % 31 AS id, event_type, 'R' || (user_id % 5) AS src, event_id % 23 AS group_id,
         ts AS at_time, CASE WHEN event_type = 'error' THEN ts END AS gone, event_id
  FROM events)"""
_HOLDS = """LEFT JOIN spans ON src = lookup_src AND group_id = lookup_key
  AND since <= at_time AND (until IS NULL OR at_time < until)"""
_FOLLOWED = f"""
WITH {_LABELS},{_GROUPED},
lasting AS (
  SELECT *, lead(at_time) OVER (PARTITION BY src_id ORDER BY at_time, event_id) AS next_at FROM grouped),
moments AS (
  SELECT * EXCLUDE (next_at) FROM lasting
  UNION ALL
  SELECT l.* EXCLUDE (next_at) REPLACE (since AS at_time) FROM lasting l
  JOIN spans ON src = lookup_src AND group_id = lookup_key
    AND since > at_time AND (next_at IS NULL OR since < next_at)
  WHERE gone IS NULL),
change_rows AS (
  SELECT src_id, id, event_type, label AS value, src, at_time AS _ab_cdc_updated_at, gone AS _ab_cdc_deleted_at
  FROM moments {_HOLDS})"""

LABELLED = scd2.Spec(
    name="labelled_events",
    entity="events",
    sources=EVENTS.sources,
    id_column="id",
    columns=EVENTS.columns,
    tracked=EVENTS.tracked,
    lookups={"value": scd2.Lookup("groups", on="group_id", key="ID", value="label")},
)


def _labels(t: Tables) -> DataFrame:
    return t.events.where("event_type = 'signup'").select(
        F.concat(F.lit("R"), (F.col("user_id") % 5).cast("string")).alias("src"),
        (F.col("event_id") % 23).alias("ID"),
        F.col("value").alias("label"),
        F.col("ts").alias(scd2.UPDATED),
    )


def labelled_rows(t: Tables, loads: list[Column] | None = None) -> DataFrame:
    """The event feed with the labels of its groups, whose changes it follows; ``loads`` as for ``collect_following``."""
    raw = {
        "events": event_feed(t).withColumn("group_id", F.col("event_id") % 23),
        "groups": _labels(t),
    }

    def read(table: str) -> DataFrame:
        source, entity = table.split("_", 1)
        return raw[entity].where(F.col("src") == source.upper())

    return scd2.with_keys(scd2.collect_following(LABELLED, read, loads, keyed=True), LABELLED)


@job(f"WITH {_LABELS},{_GROUPED} SELECT event_id, src, group_id, at_time, label FROM grouped {_HOLDS}")
def lookup_as_of(t: Tables) -> DataFrame:
    """Every event with the label its group had at that time."""
    spans = value_spans(_labels(t), ["src", "ID"], scd2.UPDATED, ["label"])
    events = event_feed(t).select("event_id", "src", (F.col("event_id") % 23).alias("group_id"), F.col(scd2.UPDATED).alias("at_time"))
    return as_of_join(events, spans, {"src": "src", "group_id": "ID"}, "at_time", {"label": "label"}, since=scd2.UPDATED)


@job(f"{_FOLLOWED} SELECT * FROM change_rows")
def scd2_lookup_changes(t: Tables) -> DataFrame:
    """The events, and a copy of each for every change of its label while it was the newest."""
    return labelled_rows(t)


@job(f"{_steps().replace(_ROWS, _FOLLOWED)} SELECT * FROM history")
def scd2_lookup_history(t: Tables) -> DataFrame:
    """First load and one incremental run, where changed labels make new versions."""
    store = HistoryStore(t.spark, new_folder(t.spark, "labelled-history"))
    rows = written(labelled_rows(t, [F.expr(SPLIT)]), "labelled-rows")
    store.load(before_split(rows), LABELLED)
    store.load(rows, LABELLED)
    return store.read()


_UPSERT_PARTS = """
WITH target AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'),
delta AS (SELECT * REPLACE ('U' AS o_orderstatus) FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01')
"""


def _upsert_parts(t: Tables) -> tuple[DataFrame, DataFrame]:
    target = t.orders.where("o_orderdate < timestamp_ntz'1999-01-01'")
    late = t.orders.where("o_orderdate >= timestamp_ntz'1997-01-01'")
    return target, late.withColumn("o_orderstatus", F.lit("U"))


@job(f"""{_UPSERT_PARTS} SELECT * FROM target WHERE o_orderkey NOT IN (SELECT o_orderkey FROM delta)
UNION ALL SELECT * FROM delta""", name="upsert_by_key")
def upsert_orders(t: Tables) -> DataFrame:
    """Two overlapping halves of orders: the overlap is replaced, the rest appended."""
    path = new_folder(t.spark, "upsert")
    target, delta = _upsert_parts(t)
    write_table(upsert_by_key(target, delta, "o_orderkey"), path)
    return t.spark.read.parquet(path)


@job(f"""{_UPSERT_PARTS}, wide AS (
  SELECT * EXCLUDE (o_orderpriority), o_totalprice >= 250000 AS is_large FROM delta)
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, CAST(NULL AS BOOLEAN) AS is_large
FROM target WHERE o_orderkey NOT IN (SELECT o_orderkey FROM delta) UNION ALL SELECT * FROM wide""")
def schema_sync(t: Tables) -> DataFrame:
    """The delta brings one column and lacks another; the table follows."""
    target, delta = _upsert_parts(t)
    delta = delta.drop("o_orderpriority").withColumn("is_large", F.col("o_totalprice") >= 250000)
    return upsert_by_key(sync_schema(target, delta), delta, "o_orderkey")
