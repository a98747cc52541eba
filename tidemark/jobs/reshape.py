"""Reshaping jobs: star, unions, deduplication, pivots, unpivots, series, keys."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import keys, text
from ..functions.numbers import safe_add
from ..operators import columns, reshape, series, sets
from ..session import new_folder
from ..sources import catalog
from .registry import Tables, exact_sum, registrar, rows_counted

QUERIES: dict = {}
ORACLES: dict = {}
job = registrar(QUERIES, ORACLES)


@job("""SELECT c_custkey AS cust_c_custkey_v, c_nationkey AS cust_c_nationkey_v,
c_acctbal AS cust_c_acctbal_v FROM customer""")
def star_select(t: Tables) -> DataFrame:
    customer = t.customer
    return customer.select(
        *columns.star(customer, except_=["c_name", "C_MKTSEGMENT"], prefix="cust_", suffix="_v")
    )


@job("""SELECT page_id, nullif(split_part(url, '?', 2), '') AS query,
nullif(split_part(url, '#', 2), '') AS fragment FROM pages""")
def nullcheck_table(t: Tables) -> DataFrame:
    parts = t.pages.select(
        "page_id",
        text.split_part("url", "?", 2).alias("query"),
        text.split_part("url", "#", 2).alias("fragment"),
    )
    return columns.nullcheck_table(parts)


@job(
    """SELECT l_returnflag, CAST(sum(coalesce(d, 0) + coalesce(x, 0) + coalesce(q, 0)) AS DOUBLE) AS total
FROM (SELECT l_returnflag, CAST(nullif(l_discount, 0) AS DECIMAL(18,2)) AS d,
  CAST(nullif(l_tax, 0) AS DECIMAL(18,2)) AS x, CAST(l_quantity AS DECIMAL(18,2)) AS q FROM lineitem)
GROUP BY l_returnflag""",
    name="safe_add",
)
def safe_add_measures(t: Tables) -> DataFrame:
    def amount(name: str, nulled: bool):
        value = F.nullif(F.col(name), F.lit(0.0)) if nulled else F.col(name)
        return value.cast("decimal(18,2)")

    total = safe_add(amount("l_discount", True), amount("l_tax", True), amount("l_quantity", False))
    return (
        t.lineitem.select("l_returnflag", total.alias("total"))
        .groupBy("l_returnflag")
        .agg(F.sum("total").cast("double").alias("total"))
    )


@job("""SELECT o_orderstatus, o_orderpriority, count(*) AS num_rows,
CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders GROUP BY 1, 2""")
def group_by_ordinal(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderstatus", "o_orderpriority", "o_totalprice")
    return columns.group_by_ordinal(orders, 2).agg(rows_counted(), exact_sum("o_totalprice", "total"))


# -------------------------------------------------------------------- unions


def _parties(t: Tables) -> dict[str, DataFrame]:
    return {
        "customer": t.customer.select(
            F.col("c_custkey").alias("id"),
            F.col("c_name").alias("name"),
            F.col("c_acctbal").alias("balance"),
            F.col("c_mktsegment").alias("segment"),
        ),
        "supplier": t.supplier.select(
            F.col("s_suppkey").cast("int").alias("id"),
            F.col("s_nationkey").alias("nation"),
            F.col("s_name").alias("name"),
            F.col("s_acctbal").alias("balance"),
        ),
    }


_PARTIES = """
WITH parties AS (
  SELECT 'customer' AS _source_relation, c_custkey AS id, c_name AS name, c_acctbal AS balance,
         c_mktsegment AS segment, CAST(NULL AS INTEGER) AS nation FROM customer
  UNION ALL
  SELECT 'supplier', s_suppkey, s_name, s_acctbal, NULL, s_nationkey FROM supplier)
"""


@job(f"{_PARTIES} SELECT * FROM parties")
def union_relations(t: Tables) -> DataFrame:
    return sets.union_relations(_parties(t))


@job(f"{_PARTIES} SELECT _source_relation, id, segment FROM parties")
def union_include(t: Tables) -> DataFrame:
    return sets.union_relations(_parties(t), include=["id", "segment"])


@job(f"{_PARTIES} SELECT _source_relation AS origin, id, name, segment FROM parties")
def union_exclude(t: Tables) -> DataFrame:
    return sets.union_relations(
        _parties(t), exclude=["balance", "nation"], source_column_name="origin"
    )


@job(f"{_PARTIES} SELECT * REPLACE (CAST(id AS VARCHAR) AS id, CAST(balance AS DECIMAL(12,2)) AS balance) FROM parties")
def union_override(t: Tables) -> DataFrame:
    return sets.union_relations(
        _parties(t), column_override={"id": "string", "balance": "decimal(12,2)"}
    )


@job(f"{_PARTIES} SELECT * FROM parties WHERE balance < 0")
def union_where(t: Tables) -> DataFrame:
    return sets.union_relations(_parties(t), where="balance < 0")


def _event_slices(t: Tables) -> None:
    """Three time slices that make up the events, as temporary views."""
    first, second = "timestamp_ntz'2024-01-11 00:00:00'", "timestamp_ntz'2024-01-21 00:00:00'"
    slices = {
        "events_20240101": f"ts < {first}",
        "events_20240111": f"ts >= {first} and ts < {second}",
        "events_20240121": f"ts >= {second}",
    }
    for name, condition in slices.items():
        t.events.where(condition).createOrReplaceTempView(name)


_SLICES = """
SELECT 'events_' || CASE WHEN ts < TIMESTAMP '2024-01-11' THEN '20240101'
    WHEN ts < TIMESTAMP '2024-01-21' THEN '20240111' ELSE '20240121' END AS _source_relation,
  event_type, count(*) AS num_rows FROM events {} GROUP BY 1, 2"""


@job(_SLICES.format(""))
def union_by_pattern(t: Tables) -> DataFrame:
    _event_slices(t)
    found = catalog.relations_by_pattern(t.spark, "%", "EVENTS_2024%")
    stacked = sets.union_relations(catalog.read_relations(t.spark, found))
    return stacked.groupBy("_source_relation", "event_type").agg(rows_counted())


@job(_SLICES.format("WHERE ts < TIMESTAMP '2024-01-11' OR ts >= TIMESTAMP '2024-01-21'"))
def union_by_prefix(t: Tables) -> DataFrame:
    _event_slices(t)
    found = catalog.relations_by_prefix(t.spark, "%", "events_", exclude="%0111")
    stacked = sets.union_relations(catalog.read_relations(t.spark, found))
    return stacked.groupBy("_source_relation", "event_type").agg(rows_counted())


# ------------------------------------------------------ one row per group, pivots


@job("""SELECT 'listed_nation' AS name, 'table' AS kind, count(*) AS num_rows FROM nation
UNION ALL SELECT 'listed_orders', 'external', count(*) FROM orders
UNION ALL SELECT 'listed_placed', 'view', count(*) FROM orders WHERE o_orderstatus = 'O'""")
def relations_listing(t: Tables) -> DataFrame:
    """Saved tables, external tables and views, found by pattern and read, with their kind."""
    spark, schema = t.spark, "tidemark_listing"
    spark.sql(f"DROP DATABASE IF EXISTS {schema} CASCADE")
    # the managed table lies in the shared folder too
    spark.sql(f"CREATE DATABASE {schema} LOCATION '{new_folder(spark, schema)}'")
    t.nation.write.saveAsTable(f"{schema}.listed_nation")
    spark.catalog.createTable(f"{schema}.listed_orders", t.path("orders"), "parquet")
    spark.sql(f"CREATE VIEW {schema}.listed_placed AS SELECT * FROM {schema}.listed_orders WHERE o_orderstatus = 'O'")
    spark.sql(f"CREATE VIEW {schema}.other AS SELECT 1 AS x")
    found = catalog.relations_by_pattern(spark, "tidemark_list%", "LISTED%")
    counts = [
        spark.table(r.full_name).select(F.lit(r.name).alias("name"), F.lit(r.kind).alias("kind")).groupBy("name", "kind").agg(rows_counted())
        for r in found
    ]
    return reduce(DataFrame.unionAll, counts)



@job("""SELECT * FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) = 1""")
def deduplicate(t: Tables) -> DataFrame:
    return reshape.deduplicate(t.events, ["user_id", "event_type"], "ts desc")


@job("""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
  PARTITION BY l_partkey, l_suppkey % 7
  ORDER BY nullif(l_returnflag, 'N') DESC NULLS LAST, l_quantity DESC, l_shipdate, l_orderkey, l_linenumber) AS rn
FROM lineitem) WHERE rn = 1""")
def deduplicate_two_orders(t: Tables) -> DataFrame:
    """Several keys, directions, expressions and null placements."""
    return reshape.deduplicate(
        t.lineitem,
        "l_partkey, l_suppkey % 7",
        "nullif(l_returnflag, 'N') desc nulls last, l_quantity desc, l_shipdate, l_orderkey, l_linenumber",
    )


@job("""SELECT user_id, count(*) FILTER (event_type = 'click') AS click,
count(*) FILTER (event_type = 'error') AS error, count(*) FILTER (event_type = 'purchase') AS purchase,
count(*) FILTER (event_type = 'signup') AS signup, count(*) FILTER (event_type = 'view') AS "view"
FROM events GROUP BY user_id""")
def pivot_sum(t: Tables) -> DataFrame:
    events = t.events
    kinds = reshape.column_value_list(events, "event_type")
    return reshape.pivot(events, "user_id", "event_type", kinds)


@job("""SELECT CAST(ts AS DATE) AS day, count(DISTINCT CASE WHEN event_type = 'click' THEN user_id END) AS users_click,
count(DISTINCT CASE WHEN event_type = 'purchase' THEN user_id END) AS users_purchase
FROM events GROUP BY 1""")
def pivot_distinct(t: Tables) -> DataFrame:
    days = t.events.withColumn("day", F.col("ts").cast("date"))
    return reshape.pivot(
        days, "day", "event_type", ["click", "purchase"], agg="count", prefix="users_",
        then_value=F.col("user_id"), else_value=F.lit(None), distinct=True,
    )


@job("""SELECT o_orderpriority, count(*) FILTER (o_totalprice >= 100000) AS ge_100000,
count(*) FILTER (o_totalprice >= 250000) AS ge_250000, count(*) FILTER (o_totalprice >= 400000) AS ge_400000
FROM orders GROUP BY 1""")
def pivot_cmp(t: Tables) -> DataFrame:
    return reshape.pivot(
        t.orders, "o_orderpriority", "o_totalprice", [100000, 250000, 400000], cmp=">=", prefix="ge_"
    )


@job("""SELECT o_orderstatus, max(CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice ELSE 0 END) AS top_1_urgent,
max(CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN o_totalprice ELSE 0 END) AS top_4_not_specified
FROM orders GROUP BY 1""")
def pivot_slug(t: Tables) -> DataFrame:
    return reshape.pivot(
        t.orders, "o_orderstatus", "o_orderpriority", ["1-URGENT", "4-NOT SPECIFIED"],
        agg="max", prefix="Top ", then_value=F.col("o_totalprice"), else_value=F.lit(0.0),
        quote_identifiers=False,
    )


@job("""SELECT o_orderkey, 'o_custkey' AS prop, CAST(o_custkey AS VARCHAR) AS val FROM orders
UNION ALL SELECT o_orderkey, 'o_orderstatus', nullif(o_orderstatus, 'P') FROM orders
UNION ALL SELECT o_orderkey, 'o_orderpriority', o_orderpriority FROM orders""")
def unpivot(t: Tables) -> DataFrame:
    """Null values (status P) stay in the result."""
    orders = t.orders.withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("P")))
    return reshape.unpivot(
        orders, "string", exclude=["O_ORDERKEY"], remove=["o_totalprice", "o_orderdate"],
        field_name="prop", value_name="val",
    )


@job("""WITH flags AS (SELECT o_orderkey, o_totalprice >= 250000 AS is_large,
  CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority = '1-URGENT' END AS is_urgent FROM orders)
SELECT o_orderkey, 'is_large' AS field_name, CASE WHEN is_large THEN 'true' ELSE 'false' END AS value FROM flags
UNION ALL SELECT o_orderkey, 'is_urgent',
  CASE WHEN is_urgent THEN 'true' WHEN NOT is_urgent THEN 'false' END FROM flags""")
def unpivot_bool(t: Tables) -> DataFrame:
    urgent = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority") == "1-URGENT")
    flags = t.orders.select(
        "o_orderkey",
        (F.col("o_totalprice") >= 250000).alias("is_large"),
        text.cast_bool_to_text(urgent).alias("is_urgent"),
    )
    return reshape.unpivot(flags, exclude=["o_orderkey"])


# ------------------------------------------------------------- series and keys


@job("""WITH numbers AS (SELECT unnest(generate_series(1, (SELECT max(o_orderkey) FROM orders))) AS n)
SELECT num_lines, count(*) AS num_orders FROM (
  SELECT n, count(l_orderkey) AS num_lines FROM numbers LEFT JOIN lineitem ON n = l_orderkey GROUP BY n)
GROUP BY num_lines""")
def generate_series(t: Tables) -> DataFrame:
    """How many numbers of the order key series have how many lines, none included."""
    last = t.orders.agg(F.max("o_orderkey").alias("k")).first()["k"]
    numbers = series.generate_series(t.spark, last, "l_orderkey")
    lines = t.lineitem.groupBy("l_orderkey").agg(rows_counted("num_lines"))
    return (
        numbers.join(lines, "l_orderkey", "left")
        .groupBy(F.coalesce("num_lines", F.lit(0).cast("long")).alias("num_lines"))
        .agg(rows_counted("num_orders"))
    )


@job("""SELECT low + to_weeks(CAST(k AS INTEGER)) AS date_week FROM (
  SELECT low, unnest(generate_series(0, date_diff('day', date_trunc('week', low + INTERVAL 1 DAY),
      date_trunc('week', high + INTERVAL 1 DAY)) // 7 - 1)) AS k
  FROM (SELECT min(o_orderdate) AS low, max(o_orderdate) AS high FROM orders))""")
def date_spine(t: Tables) -> DataFrame:
    low, high = series.date_bounds(t.orders, "o_orderdate")
    return series.date_spine(t.spark, "week", low, high)


@job("""WITH days AS (
  SELECT low + to_days(CAST(k AS INTEGER)) AS date_day FROM (
    SELECT low, unnest(generate_series(0, date_diff('day', low, high) - 1)) AS k
    FROM (SELECT min(l_shipdate) AS low, max(l_shipdate) AS high FROM lineitem))),
totals AS (SELECT date_trunc('day', o_orderdate) AS day, count(*) AS n,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders GROUP BY 1)
SELECT date_day, coalesce(n, 0) AS num_orders, coalesce(total, 0) AS total
FROM days LEFT JOIN totals ON date_day = day""")
def date_spine_fill(t: Tables) -> DataFrame:
    """Daily order totals over the shipping period, days without orders as zero."""
    low, high = series.date_bounds(t.lineitem, "l_shipdate")
    totals = t.orders.groupBy(F.col("o_orderdate").alias("date_day")).agg(
        rows_counted("num_orders"), exact_sum("o_totalprice", "total")
    )
    spine = series.date_spine(t.spark, "day", low, high)
    return spine.join(totals, "date_day", "left").na.fill(0, ["num_orders", "total"])


@job("""SELECT o_orderkey, md5(CAST(o_orderkey AS VARCHAR) || '-' || coalesce(nullif(o_orderstatus, 'P'), '') || '-'
  || CAST(o_orderdate AS VARCHAR) || '-' || o_orderpriority) AS order_key,
md5(nullif(o_orderstatus, 'P')) AS status_hash,
CAST(o_custkey AS VARCHAR) || nullif(o_orderstatus, 'P') AS label FROM orders""")
def surrogate_key(t: Tables) -> DataFrame:
    status = F.nullif("o_orderstatus", F.lit("P"))
    return t.orders.select(
        "o_orderkey",
        keys.surrogate_key("o_orderkey", status, "o_orderdate", "o_orderpriority").alias("order_key"),
        keys.md5_hash(status).alias("status_hash"),
        keys.concat("o_custkey", status).alias("label"),
    )
