"""Aggregate and set-operation jobs."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.aggregates import any_value, bool_or
from ..functions.numbers import width_bucket
from ..operators import reshape, sets
from ..operators.frequent import most_frequent
from .registry import Tables, exact_sum, registrar, rows_counted

QUERIES: dict = {}
ORACLES: dict = {}
job = registrar(QUERIES, ORACLES)


@job("""SELECT l_orderkey, min(l_shipdate) AS some_shipdate, min(l_returnflag) AS some_flag,
count(*) AS num_rows FROM lineitem GROUP BY 1""")
def any_value_agg(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_orderkey").agg(
        any_value("l_shipdate").alias("some_shipdate"),
        any_value("l_returnflag").alias("some_flag"),
        rows_counted(),
    )


@job("""SELECT l_orderkey, bool_or(l_returnflag = 'R') AS any_returned,
bool_or(CASE WHEN l_linestatus = 'O' THEN l_quantity > 45 END) AS any_large_open FROM lineitem GROUP BY 1""")
def bool_or_agg(t: Tables) -> DataFrame:
    large = F.when(F.col("l_linestatus") == "O", F.col("l_quantity") > 45)
    return t.lineitem.groupBy("l_orderkey").agg(
        bool_or(F.col("l_returnflag") == "R").alias("any_returned"),
        bool_or(large).alias("any_large_open"),
    )


@job("""SELECT l_orderkey, string_agg(CAST(l_linenumber AS VARCHAR), '_|_'
ORDER BY l_shipdate, CAST(l_linenumber AS VARCHAR)) AS lines FROM lineitem GROUP BY 1""")
def listagg_ordered(t: Tables) -> DataFrame:
    return reshape.listagg_by(
        t.lineitem, "l_orderkey", "l_linenumber", "_|_", order_by="l_shipdate", alias="lines"
    )


@job("""SELECT o_custkey, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderdate, CAST(o_orderkey AS VARCHAR))
AS first_orders FROM (SELECT * FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) <= 3) GROUP BY 1""")
def listagg_limited(t: Tables) -> DataFrame:
    """The first three orders of each customer; the others are never collected."""
    return reshape.listagg_by(
        t.orders, "o_custkey", "o_orderkey", order_by="o_orderdate", limit=3, alias="first_orders"
    )


@job("""SELECT l_suppkey, string_agg(DISTINCT l_returnflag, '/' ORDER BY l_returnflag) AS flags
FROM lineitem GROUP BY 1""")
def listagg_distinct(t: Tables) -> DataFrame:
    return reshape.listagg_by(
        t.lineitem, "l_suppkey", "l_returnflag", "/", distinct=True, alias="flags"
    )


@job("""SELECT l_orderkey, string_agg(CAST(l_linenumber AS VARCHAR), ','
ORDER BY nullif(l_returnflag, 'N') NULLS LAST, l_shipdate DESC, CAST(l_linenumber AS VARCHAR)) AS lines
FROM lineitem GROUP BY 1""")
def listagg_nulls(t: Tables) -> DataFrame:
    """Lines by return flag, those that were not returned last, newest shipment first."""
    return reshape.listagg_by(
        t.lineitem, "l_orderkey", "l_linenumber", order_by="nullif(l_returnflag, 'N'), l_shipdate desc", alias="lines"
    )


@job("""SELECT o_custkey, string_agg(CAST(o_orderkey AS VARCHAR), ','
ORDER BY nullif(o_orderpriority, '3-MEDIUM') DESC NULLS FIRST, CAST(o_orderkey AS VARCHAR)) AS last_orders
FROM (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey
  ORDER BY nullif(o_orderpriority, '3-MEDIUM') DESC NULLS FIRST, o_orderkey) <= 4) GROUP BY 1""")
def listagg_desc(t: Tables) -> DataFrame:
    """Four orders of each customer in descending order; null is the largest value."""
    return reshape.listagg_by(
        t.orders, "o_custkey", "o_orderkey", order_by="nullif(o_orderpriority, '3-MEDIUM') desc", limit=4,
        alias="last_orders",
    )


@job("""SELECT p_brand AS value, count(*) AS num_rows FROM part
GROUP BY 1 ORDER BY max(CASE WHEN p_size < 40 THEN p_size END) DESC NULLS LAST, min(p_partkey), p_brand LIMIT 12""")
def column_values_by_max(t: Tables) -> DataFrame:
    """Values ordered by aggregates of their rows."""
    return reshape.column_values(
        t.part, "p_brand", "max(case when p_size < 40 then p_size end) desc nulls last, min(p_partkey)", max_records=12
    )


@job("""SELECT p_brand AS value, count(*) AS num_rows FROM part WHERE p_size >= 10
GROUP BY 1 ORDER BY count(*) DESC, p_brand LIMIT 10""")
def column_values_topk(t: Tables) -> DataFrame:
    return reshape.column_values(t.part, "p_brand", max_records=10, where="p_size >= 10")


@job("""SELECT bucket, count(*) AS num_rows, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM (SELECT o_totalprice, CAST(CASE WHEN o_totalprice < 50000 THEN 0 WHEN o_totalprice >= 450000 THEN 9
  ELSE floor(8 * (o_totalprice - 50000) / 400000) + 1 END AS BIGINT) AS bucket FROM orders)
GROUP BY bucket""")
def histogram(t: Tables) -> DataFrame:
    """Eight buckets over 50k..450k, and the two outside."""
    bucket = width_bucket("o_totalprice", 50_000, 450_000, 8).alias("bucket")
    return (
        t.orders.select(bucket, "o_totalprice")
        .groupBy("bucket")
        .agg(rows_counted(), exact_sum("o_totalprice", "total"))
    )


@job("""SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R'
EXCEPT SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag <> 'R'""")
def except_distinct(t: Tables) -> DataFrame:
    """Part-supplier pairs that only ever came back."""
    pairs = t.lineitem.select("l_partkey", "l_suppkey", "l_returnflag")
    returned = pairs.where("l_returnflag = 'R'").drop("l_returnflag")
    return sets.except_distinct(returned, pairs.where("l_returnflag <> 'R'").drop("l_returnflag"))


@job("""SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R'
INTERSECT SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag <> 'R'""")
def intersect_distinct(t: Tables) -> DataFrame:
    pairs = t.lineitem.select("l_partkey", "l_suppkey", "l_returnflag")
    returned = pairs.where("l_returnflag = 'R'").drop("l_returnflag")
    return sets.intersect_distinct(
        returned, pairs.where("l_returnflag <> 'R'").drop("l_returnflag")
    )


@job("""SELECT word AS value, count(*) AS num_rows FROM (
  SELECT unnest(string_split(coalesce(text, ''), ' ')) AS word FROM documents)
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 100""")
def frequent_words(t: Tables) -> DataFrame:
    """The hundred most frequent words of all documents, most of whose words occur once."""
    words = t.documents.select(F.explode(F.split(F.coalesce("text", F.lit("")), " ")).alias("word"))
    return most_frequent(words, "word", 100)


@job("""SELECT l_extendedprice AS value, count(*) AS num_rows FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 50""")
def frequent_prices(t: Tables) -> DataFrame:
    """The fifty most frequent line prices, with many ties."""
    return most_frequent(t.lineitem, "l_extendedprice", 50)


@job("""SELECT l_linestatus, md5(string_agg(l_orderkey || '-' || l_linenumber, ',' ORDER BY l_shipdate DESC, l_orderkey || '-' || l_linenumber)) AS digest
FROM lineitem GROUP BY 1""")
def listagg_runs(t: Tables) -> DataFrame:
    """All lines by shipping date in two lists, each put together from sorted runs."""
    lines = t.lineitem.select("l_linestatus", "l_shipdate", F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line"))
    lists = reshape.listagg_by(lines, "l_linestatus", "line", order_by="l_shipdate desc", runs=16)
    return lists.select("l_linestatus", F.md5("listagg").alias("digest"))
