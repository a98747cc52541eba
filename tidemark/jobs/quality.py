"""Data-quality jobs: failing rows, or failure counts, over whole tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates, text, urls
from ..operators import quality
from ..plans import checks
from . import history
from .registry import Tables, registrar

QUERIES: dict = {}
ORACLES: dict = {}
job = registrar(QUERIES, ORACLES)


@job("""SELECT a AS count_a, b AS count_b, abs(a - b) AS diff_count
FROM (SELECT count(*) AS a FROM lineitem), (SELECT count(*) AS b FROM orders)""")
def dq_equal_rowcount(t: Tables) -> DataFrame:
    return quality.equal_rowcount(t.lineitem, t.orders)


@job("""SELECT a AS count_our_model, b AS count_comparison_model,
CASE WHEN a > b THEN a - b WHEN a = b THEN 1 ELSE 0 END AS row_count_delta
FROM (SELECT count(*) AS a FROM lineitem), (SELECT count(*) AS b FROM orders)""")
def dq_fewer_rows(t: Tables) -> DataFrame:
    return quality.fewer_rows_than(t.lineitem, t.orders)


_ORDER_SIDES = """
WITH lines AS (SELECT l_orderkey AS order_id, l_linestatus AS status FROM lineitem),
heads AS (SELECT o_orderkey AS order_id, o_orderstatus AS status FROM orders)
"""


def _order_sides(t: Tables) -> tuple[DataFrame, DataFrame]:
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linestatus").alias("status")
    )
    heads = t.orders.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("status")
    )
    return lines, heads


@job(f"""{_ORDER_SIDES}
SELECT 'a_minus_b' AS which_diff, * FROM (SELECT * FROM lines EXCEPT SELECT * FROM heads)
UNION ALL SELECT 'b_minus_a', * FROM (SELECT * FROM heads EXCEPT SELECT * FROM lines)""")
def dq_equality(t: Tables) -> DataFrame:
    return quality.equality(*_order_sides(t))


@job(f"""{_ORDER_SIDES}
SELECT 'a_minus_b' AS which_diff, * FROM (SELECT * FROM lines EXCEPT ALL SELECT * FROM heads)
UNION ALL SELECT 'b_minus_a', * FROM (SELECT * FROM heads EXCEPT ALL SELECT * FROM lines)""")
def dq_equality_multiset(t: Tables) -> DataFrame:
    return quality.equality(*_order_sides(t), multiset=True)


@job(f"""{_ORDER_SIDES}, diffs AS (
SELECT 1 AS a, 0 AS b FROM (SELECT order_id FROM lines EXCEPT SELECT order_id FROM heads)
UNION ALL SELECT 0, 1 FROM (SELECT order_id FROM heads EXCEPT SELECT order_id FROM lines))
SELECT CAST(count(*) + coalesce(abs(sum(a) - sum(b)), 0) AS BIGINT) AS failures FROM diffs""")
def dq_equality_failures(t: Tables) -> DataFrame:
    differences = quality.equality(*_order_sides(t), compare_columns=["order_id"])
    return quality.equality_failures(differences)


@job("SELECT * FROM orders WHERE o_orderstatus <> 'P' AND NOT (o_totalprice > 20000)")
def dq_expression(t: Tables) -> DataFrame:
    return quality.expression_is_true(
        t.orders, "> 20000", column_name="o_totalprice", condition="o_orderstatus <> 'P'"
    )


@job("""SELECT max(ts) AS most_recent, TIMESTAMP '2024-02-08' AS threshold FROM events
HAVING max(ts) < TIMESTAMP '2024-02-08'""")
def dq_recency(t: Tables) -> DataFrame:
    return quality.recency(t.events, "ts", "day", 7, now="2024-02-15 00:00:00")


@job("""SELECT count(large) AS filled FROM (
  SELECT CASE WHEN o_totalprice > 1000000 THEN o_totalprice END AS large FROM orders) HAVING count(large) = 0""")
def dq_at_least_one(t: Tables) -> DataFrame:
    large = F.when(F.col("o_totalprice") > 1000000, F.col("o_totalprice"))
    return quality.at_least_one(t.orders.withColumn("large", large), "large")


@job("""SELECT min(kind) AS lowest, max(kind) AS highest FROM (SELECT CAST(sign(l_quantity) AS INTEGER) AS kind FROM lineitem)
HAVING count(DISTINCT kind) = 1""")
def dq_not_constant(t: Tables) -> DataFrame:
    lines = t.lineitem.select(F.signum("l_quantity").cast("int").alias("kind"))
    return quality.not_constant(lines, "kind")


@job("""WITH a AS (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY 1),
b AS (SELECT o_orderkey AS k, count(*) AS n FROM orders GROUP BY 1)
SELECT k AS l_orderkey, n AS num_rows FROM (
  (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL (SELECT * FROM b EXCEPT SELECT * FROM a))""")
def dq_cardinality(t: Tables) -> DataFrame:
    return quality.cardinality_equality(t.lineitem, "l_orderkey", t.orders, "o_orderkey")


@job("""SELECT o_custkey AS unique_field, count(*) AS n_records FROM orders
WHERE o_orderstatus = 'F' GROUP BY 1 HAVING count(*) > 1""")
def dq_unique(t: Tables) -> DataFrame:
    return quality.unique_where(t.orders, "o_custkey", "o_orderstatus = 'F'")


@job("""SELECT page_id, url, CAST(NULL AS VARCHAR) AS page FROM pages
WHERE url LIKE 'https%' AND nullif(split_part(split_part(url, 'page=', 2), '&', 1), '') IS NULL""")
def dq_not_null(t: Tables) -> DataFrame:
    pages = t.pages.select("page_id", "url", urls.get_url_parameter("url", "page").alias("page"))
    return quality.not_null_where(pages, "page", "url like 'https%'")


@job("""SELECT count(q) / count(*) AS not_null_proportion
FROM (SELECT nullif(split_part(url, '?', 2), '') AS q FROM pages) HAVING count(q) / count(*) < 0.9""")
def dq_not_null_proportion(t: Tables) -> DataFrame:
    pages = t.pages.select(text.nullcheck(text.split_part("url", "?", 2)).alias("q"))
    return quality.not_null_proportion(pages, "q", at_least=0.9)


@job("SELECT DISTINCT event_type AS value_field FROM events WHERE event_type IN ('error', 'refund', 'signup')")
def dq_not_accepted(t: Tables) -> DataFrame:
    return quality.not_accepted_values(t.events, "event_type", ["error", "refund", "signup"])


@job("""SELECT event_type AS value_field, count(*) AS n_records FROM events
WHERE event_type NOT IN ('click', 'view', 'purchase') GROUP BY 1""")
def dq_accepted_values(t: Tables) -> DataFrame:
    return quality.accepted_values(t.events, "event_type", ["click", "view", "purchase"])


@job("""SELECT l_orderkey AS id, CAST(NULL AS BIGINT) AS right_id FROM lineitem
WHERE l_returnflag = 'R' AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')""")
def dq_relationships(t: Tables) -> DataFrame:
    return quality.relationships_where(
        t.lineitem, "l_orderkey", t.orders, "o_orderkey",
        from_condition="l_returnflag = 'R'", to_condition="o_orderstatus <> 'P'",
    )


# ------------------------------------------------------------- ranges, sequences


def _ranges_sql(model: str, gap: str, gap_name: str, length: str, length_name: str, keyed: bool = True) -> str:
    part, key = ("PARTITION BY k", "k AS partition_by_col, ") if keyed else ("", "")
    return f"""WITH linked AS (
  SELECT {key}lo AS lower_bound, hi AS upper_bound, lead(lo) OVER w AS next_lower_bound,
         lead(1) OVER w IS NULL AS is_last_record
  FROM ({model}) WINDOW w AS ({part} ORDER BY lo NULLS LAST, hi NULLS FIRST)),
checked AS (
  SELECT *, coalesce(lower_bound {length} upper_bound, FALSE) AS lower_bound_{length_name}_upper_bound,
         coalesce(upper_bound {gap} next_lower_bound, is_last_record) AS upper_bound_{gap_name}_next_lower_bound
  FROM linked)
SELECT * FROM checked
WHERE NOT (lower_bound_{length_name}_upper_bound AND upper_bound_{gap_name}_next_lower_bound)"""


_ORDER_RANGES = """SELECT o_custkey AS k, o_orderdate AS lo, max(l_shipdate) AS hi
  FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey, o_custkey, o_orderdate"""


def _order_ranges(t: Tables) -> DataFrame:
    """Per customer: each order from its date to its last shipment (null if none)."""
    shipped = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max("l_shipdate").alias("hi")
    )
    return t.orders.join(shipped, "o_orderkey", "left").select(
        F.col("o_custkey").alias("k"), F.col("o_orderdate").alias("lo"), "hi"
    )


@job(_ranges_sql(_ORDER_RANGES, "<=", "less_than_or_equal_to", "<", "less_than"))
def dq_ranges_allowed(t: Tables) -> DataFrame:
    return quality.mutually_exclusive_ranges(_order_ranges(t), "lo", "hi", "k")


@job(_ranges_sql(
    f"{history._steps()} SELECT src_id AS k, valid_from AS lo, coalesce(valid_to, TIMESTAMP '2099-01-01') AS hi FROM history",
    "=", "equal_to", "<=", "less_than_or_equal_to"))
def dq_ranges_not_allowed(t: Tables) -> DataFrame:
    """Versions of a key that do not join up: keys closed before they were seen again."""
    versions = history.scd2_apply(t).withColumn(
        "valid_to", F.coalesce("valid_to", F.lit("2099-01-01").cast("timestamp_ntz"))
    )
    return quality.mutually_exclusive_ranges(
        versions, "valid_from", "valid_to", "src_id",
        gaps="not_allowed", zero_length_range_allowed=True,
    )


@job(_ranges_sql(_ORDER_RANGES, "<", "less_than", "<", "less_than"))
def dq_ranges_required(t: Tables) -> DataFrame:
    """The same ranges through the plan made of aggregates, whatever the group sizes."""
    return quality.mutually_exclusive_ranges(
        _order_ranges(t), "lo", "hi", "k", gaps="required", max_partition_rows=0
    )


@job(_ranges_sql(
    "SELECT ts AS lo, ts + to_microseconds(CAST(round(value * 1000000) AS BIGINT)) AS hi FROM events",
    "<=", "less_than_or_equal_to", "<", "less_than", keyed=False))
def dq_ranges_global(t: Tables) -> DataFrame:
    """Events as one timeline: each lasts its value in seconds and must not overlap the next."""
    micros = F.round(F.col("value") * 1000000).cast("long")
    spans = t.events.select(
        F.col("ts").alias("lo"), dates.dateadd("microsecond", micros, "ts").alias("hi")
    )
    return quality.mutually_exclusive_ranges(spans, "lo", "hi")


@job(_ranges_sql("SELECT p_name AS lo, p_brand || p_name AS hi FROM part", "<=", "less_than_or_equal_to", "<", "less_than", keyed=False))
def dq_ranges_text(t: Tables) -> DataFrame:
    """Ranges between texts, without a partition column."""
    spans = t.part.select(F.col("p_name").alias("lo"), F.concat("p_brand", "p_name").alias("hi"))
    return quality.mutually_exclusive_ranges(spans, "lo", "hi")


@job("""SELECT l_orderkey, previous_l_orderkey FROM (
  SELECT l_orderkey, lag(l_orderkey) OVER (ORDER BY l_orderkey) AS previous_l_orderkey FROM lineitem)
WHERE NOT (l_orderkey = previous_l_orderkey + 1)""")
def dq_sequential(t: Tables) -> DataFrame:
    """Order keys of the lines: repeats and gaps."""
    return quality.sequential_values(t.lineitem, "l_orderkey")


@job("""SELECT line, previous_line FROM (
  SELECT line, lag(line) OVER (ORDER BY line) AS previous_line
  FROM (SELECT lpad(CAST(l_orderkey AS VARCHAR), 12, '0') AS line FROM lineitem))
WHERE NOT (CAST(line AS BIGINT) = CAST(previous_line AS BIGINT) + 1)""")
def dq_sequential_text(t: Tables) -> DataFrame:
    """The same keys as text that begins alike, so that no short prefix tells them apart."""
    lines = t.lineitem.select(F.lpad(F.col("l_orderkey").cast("string"), 12, "0").alias("line"))
    return quality.sequential_values(lines, "line")


@job("""SELECT minute, previous_minute FROM (
  SELECT minute, lag(minute) OVER (ORDER BY minute) AS previous_minute
  FROM (SELECT date_trunc('minute', ts) AS minute FROM events))
WHERE NOT (minute = previous_minute + INTERVAL 1 MINUTE)""")
def dq_sequential_ts(t: Tables) -> DataFrame:
    minutes = t.events.select(dates.date_trunc("minute", "ts").alias("minute"))
    return quality.sequential_values(minutes, "minute", 1, "minute")


@job("SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def dq_unique_combination(t: Tables) -> DataFrame:
    return quality.unique_combination_of_columns(t.lineitem, ["l_orderkey", "l_linenumber"])


@job("SELECT * FROM lineitem WHERE NOT (l_discount > 0.0) OR NOT (l_discount < 0.09)")
def dq_accepted_range(t: Tables) -> DataFrame:
    return quality.accepted_range(t.lineitem, "l_discount", 0.0, 0.09, inclusive=False)


@job("SELECT page_id, split_part(url, '?', 2) AS query FROM pages WHERE split_part(url, '?', 2) = ''")
def dq_not_empty_string(t: Tables) -> DataFrame:
    pages = t.pages.select("page_id", text.split_part("url", "?", 2).alias("query"))
    return quality.not_empty_string(pages, "query")


@job("""SELECT o_orderkey, first_line, num_lines FROM (
  SELECT l_orderkey AS o_orderkey, CAST(min(l_linenumber) AS BIGINT) AS first_line, count(*) AS num_lines
  FROM lineitem GROUP BY 1) WHERE first_line <> num_lines""")
def dq_assert_equal(t: Tables) -> DataFrame:
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.min("l_linenumber").cast("long").alias("first_line"), F.count(F.lit(1)).alias("num_lines")
    )
    return quality.assert_equal(lines, "first_line", "num_lines")


@job("""WITH o AS (SELECT * FROM orders)
SELECT 'not_null_o_custkey' AS check_name, count(*) FILTER (o_custkey IS NULL) AS failures FROM o
UNION ALL SELECT 'not_empty_string_o_orderpriority', count(*) FILTER (o_orderpriority = '') FROM o
UNION ALL SELECT 'accepted_values_o_orderstatus', count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) FROM o
UNION ALL SELECT 'accepted_range_o_totalprice', count(*) FILTER (o_totalprice < 5000 OR o_totalprice > 490000) FROM o
UNION ALL SELECT 'expression_priority_set', count(*) FILTER (NOT (o_orderpriority <> '4-NOT SPECIFIED')) FROM o
UNION ALL SELECT 'at_least_one_o_totalprice', CAST(count(o_totalprice) = 0 AS BIGINT) FROM o
UNION ALL SELECT 'not_constant_o_orderstatus', CAST(min(o_orderstatus) = max(o_orderstatus) AS BIGINT) FROM o
UNION ALL SELECT 'not_null_proportion_o_custkey', CAST(avg(CAST(o_custkey IS NOT NULL AS INTEGER)) < 1 AS BIGINT) FROM o
UNION ALL SELECT 'recency_o_orderdate', CAST(max(o_orderdate) < TIMESTAMP '2001-12-01' AS BIGINT) FROM o
UNION ALL SELECT 'unique_o_custkey', (SELECT count(*) FROM (SELECT o_custkey FROM o GROUP BY 1 HAVING count(*) > 1))
UNION ALL SELECT 'customer_exists', count(*) FILTER (o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)) FROM o""")
def dq_suite(t: Tables) -> DataFrame:
    """Nine single-aggregate checks in one pass over orders, and two of a key that share one grouping."""
    orders = t.orders
    return (
        quality.Suite(orders)
        .not_null("o_custkey")
        .not_empty_string("o_orderpriority")
        .accepted_values("o_orderstatus", ["F", "O"])
        .accepted_range("o_totalprice", 5000, 490000)
        .expression_is_true("priority_set", "o_orderpriority <> '4-NOT SPECIFIED'")
        .at_least_one("o_totalprice")
        .not_constant("o_orderstatus")
        .not_null_proportion("o_custkey", 1.0)
        .recency("o_orderdate", "month", 1, "2002-01-01")
        .unique("o_custkey")
        .relationships("customer_exists", "o_custkey", t.customer, "c_custkey", to_condition="c_acctbal >= 0")
        .run()
    )


@job(f"""{history._steps()}
SELECT 'not_null_src_id' AS check_name, count(*) FILTER (src_id IS NULL) AS failures FROM history
UNION ALL SELECT 'not_null_surrogate_key', count(*) FILTER (surrogate_key IS NULL) FROM history
UNION ALL SELECT 'expression_open_iff_current', count(*) FILTER (is_current <> (valid_to IS NULL)) FROM history
UNION ALL SELECT 'expression_ends_after_start', count(*) FILTER (valid_to < valid_from) FROM history
UNION ALL SELECT 'unique_surrogate_key',
  (SELECT count(*) FROM (SELECT surrogate_key FROM history GROUP BY 1 HAVING count(*) > 1))
UNION ALL SELECT 'unique_current_src_id',
  (SELECT count(*) FROM (SELECT src_id FROM history WHERE is_current GROUP BY 1 HAVING count(*) > 1))
UNION ALL SELECT 'versions_do_not_overlap', (SELECT count(*) FROM (
  SELECT coalesce(valid_to, TIMESTAMP '9999-12-31') AS hi, valid_from AS lo,
    lead(valid_from) OVER (PARTITION BY src_id ORDER BY valid_from, coalesce(valid_to, TIMESTAMP '9999-12-31')) AS nxt
  FROM history) WHERE lo > hi OR hi > nxt)""")
def dq_history(t: Tables) -> DataFrame:
    """The checks every history table must pass, on the event history."""
    return checks.history_checks(history.scd2_apply(t)).run()


@job("""SELECT 'unique_l_orderkey' AS check_name, count(*) AS failures
FROM (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'one_returned_line', count(*) FROM (
  SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'order_exists', count(*) FROM lineitem
  WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')
UNION ALL SELECT 'shipped_order_exists', count(*) FROM lineitem
  WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_totalprice > 50000)
UNION ALL SELECT 'unique_l_orderkey_l_linenumber', count(*) FROM (
  SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)""")
def dq_suite_keys(t: Tables) -> DataFrame:
    """Four checks of the order key from one grouping of the lines, and one of key and number."""
    return (
        quality.Suite(t.lineitem)
        .unique("l_orderkey")
        .unique("l_orderkey", "l_returnflag = 'R'", "one_returned_line")
        .relationships("order_exists", "l_orderkey", t.orders, "o_orderkey", to_condition="o_orderstatus <> 'P'")
        .relationships(
            "shipped_order_exists", "l_orderkey", t.orders, "o_orderkey",
            "l_shipdate >= timestamp_ntz'1997-01-01'", "o_totalprice > 50000",
        )
        .unique_combination(["l_orderkey", "l_linenumber"])
        .run()
    )
