"""Column helpers at work on whole tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import arrays, dates, text, urls
from ..functions.numbers import haversine_distance
from ..operators.nearest import nearest
from .registry import Tables, exact_sum, registrar, rows_counted

QUERIES: dict = {}
ORACLES: dict = {}
job = registrar(QUERIES, ORACLES)


@job("""WITH endings AS (
  SELECT * FROM (SELECT lang, right(text, 3) AS ending, count(*) AS n FROM documents GROUP BY 1, 2)
  QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, ending) = 1)
SELECT d.lang, count(*) AS num_docs, CAST(sum(length(text)) AS BIGINT) AS chars,
  count(*) FILTER (position('the' IN text) > 0) AS with_the,
  CAST(sum(length(text) - length(replace(text, ' ', ''))) AS BIGINT) AS blanks,
  any_value(ending) AS top_ending
FROM documents d JOIN endings e ON d.lang = e.lang GROUP BY d.lang""")
def text_profile(t: Tables) -> DataFrame:
    """Per language: lengths, a word's spread, blanks, the most frequent ending.

    Documents are counted per (language, ending) first; what follows works on
    those few rows, whatever a language's share of the documents is.
    """
    length = text.length("text")
    per_ending = t.documents.groupBy("lang", text.right("text", 3).alias("ending")).agg(
        rows_counted("n"),
        F.sum(length).alias("chars"),
        F.count_if(text.position("the", "text") > 0).alias("with_the"),
        F.sum(length - text.length(text.replace("text", " ", ""))).alias("blanks"),
    )
    return (
        per_ending.groupBy("lang")
        .agg(
            F.sum("n").alias("num_docs"),
            F.sum("chars").alias("chars"),
            F.sum("with_the").alias("with_the"),
            F.sum("blanks").alias("blanks"),
            F.min(F.struct((-F.col("n")).alias("n"), "ending")).alias("top"),
        )
        .select("lang", "num_docs", "chars", "with_the", "blanks", F.col("top.ending").alias("top_ending"))
    )


_HOST = "split_part(split_part(replace(replace(replace(url, 'android-app://', ''), 'http://', ''), 'https://', ''), '/', 1), '?', 1)"


@job(f"""SELECT split_part({_HOST}, '.', -1) AS top_label, split_part({_HOST}, '.', 1) AS first_label,
count(*) AS num_pages FROM pages GROUP BY 1, 2""")
def split_part_rollup(t: Tables) -> DataFrame:
    host = urls.get_url_host("url")
    return t.pages.groupBy(
        text.split_part(host, ".", -1).alias("top_label"),
        text.split_part(host, ".", 1).alias("first_label"),
    ).agg(rows_counted("num_pages"))


@job(f"""SELECT {_HOST} AS host, count(*) AS num_pages,
count(TRY_CAST(split_part(split_part(url, '/', -1), '?', 1) AS INTEGER)) AS numeric_pages
FROM pages GROUP BY 1""")
def safe_cast_quality(t: Tables) -> DataFrame:
    """How many pages per host end in a plain number."""
    last = text.split_part(text.split_part("url", "/", -1), "?", 1)
    return t.pages.groupBy(urls.get_url_host("url").alias("host")).agg(
        rows_counted("num_pages"),
        F.count(text.safe_cast(last, "int")).alias("numeric_pages"),
    )


@job(f"SELECT {_HOST} AS host, count(*) AS num_pages FROM pages GROUP BY 1")
def pages_by_host(t: Tables) -> DataFrame:
    return t.pages.groupBy(urls.get_url_host("url").alias("host")).agg(rows_counted("num_pages"))


@job("""SELECT path, count(*) AS num_pages FROM (
  SELECT CASE WHEN position('/' IN bare) > 0 THEN split_part(substr(bare, position('/' IN bare) + 1), '?', 1)
              WHEN position('?' IN bare) > 0 THEN '' ELSE bare END AS path
  FROM (SELECT replace(replace(url, 'http://', ''), 'https://', '') AS bare FROM pages)) GROUP BY 1""")
def pages_by_path(t: Tables) -> DataFrame:
    return t.pages.groupBy(urls.get_url_path("url").alias("path")).agg(rows_counted("num_pages"))


@job("""SELECT nullif(split_part(split_part(url, 'utm_source=', 2), '&', 1), '') AS campaign,
nullif(split_part(split_part(url, 'page=', 2), '&', 1), '') AS page, count(*) AS num_pages FROM pages GROUP BY 1, 2""")
def pages_by_campaign(t: Tables) -> DataFrame:
    return t.pages.groupBy(
        urls.get_url_parameter("url", "utm_source").alias("campaign"),
        urls.get_url_parameter("url", "page").alias("page"),
    ).agg(rows_counted("num_pages"))


# --------------------------------------------------------------------- dates

_CALENDAR_PARTS = ("year", "quarter", "month", "day", "hour")


@job(f"""SELECT o_orderpriority, {', '.join(f"CAST(sum(date_diff('{p}', o_orderdate, l_shipdate)) AS BIGINT) AS {p}s" for p in _CALENDAR_PARTS)}
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def datediff_units(t: Tables) -> DataFrame:
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return lines.groupBy("o_orderpriority").agg(
        *[
            F.sum(dates.datediff("o_orderdate", "l_shipdate", part)).alias(f"{part}s")
            for part in _CALENDAR_PARTS
        ]
    )


_CLOCK_PARTS = ("minute", "second", "millisecond", "microsecond")


@job(f"""SELECT event_type, {', '.join(f"CAST(sum(date_diff('{p}', ts, done)) AS BIGINT) AS {p}s" for p in _CLOCK_PARTS)}
FROM (SELECT event_type, ts, ts + to_microseconds(CAST(round(value * 1000000) AS BIGINT)) AS done FROM events) GROUP BY 1""")
def datediff_clock(t: Tables) -> DataFrame:
    """Boundaries crossed between an event and its value, read as seconds, later."""
    done = dates.dateadd("microsecond", F.round(F.col("value") * 1000000).cast("long"), "ts")
    return (
        t.events.select("event_type", "ts", done.alias("done"))
        .groupBy("event_type")
        .agg(
            *[F.sum(dates.datediff("ts", "done", part)).alias(f"{part}s") for part in _CLOCK_PARTS]
        )
    )


@job("""SELECT o_orderpriority, CAST(sum(date_diff('day', date_trunc('week', o_orderdate + INTERVAL 1 DAY),
  date_trunc('week', l_shipdate + INTERVAL 1 DAY)) // 7) AS BIGINT) AS weeks
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def datediff_week(t: Tables) -> DataFrame:
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    weeks = dates.datediff("o_orderdate", "l_shipdate", "week")
    return lines.groupBy("o_orderpriority").agg(F.sum(weeks).alias("weeks"))


_TRUNC_PARTS = ("hour", "day", "week", "month")


@job(" UNION ALL ".join(
    f"SELECT '{p}' AS part, CAST(date_trunc('{p}', ts) AS TIMESTAMP) AS period, event_type, count(*) AS num_rows FROM events GROUP BY ALL"
    for p in _TRUNC_PARTS
))
def events_by_period(t: Tables) -> DataFrame:
    """Counts per hour; days, weeks and months are added up from the hours."""
    hours = t.events.groupBy(
        "event_type", dates.date_trunc("hour", "ts").alias("hour")
    ).agg(rows_counted("n"))
    starts = [
        F.struct(F.lit(p).alias("part"), dates.date_trunc(p, "hour").alias("period"))
        for p in _TRUNC_PARTS
    ]
    return (
        hours.select("event_type", "n", F.inline(F.array(*starts)))
        .groupBy("part", "period", "event_type")
        .agg(F.sum("n").alias("num_rows"))
    )


@job("""WITH ends AS (SELECT o_totalprice, last_day(o_orderdate) AS month_end,
  CAST(date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS quarter_end,
  CAST(date_trunc('year', o_orderdate) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE) AS year_end FROM orders)
SELECT month_end, quarter_end, year_end, count(*) AS num_orders,
CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM ends GROUP BY ALL""")
def last_day_rollup(t: Tables) -> DataFrame:
    return t.orders.groupBy(
        *[
            dates.last_day("o_orderdate", part).alias(f"{part}_end")
            for part in ("month", "quarter", "year")
        ]
    ).agg(rows_counted("num_orders"), exact_sum("o_totalprice", "total"))


# ----------------------------------------------------------- arrays, geography

_KINDS = ("click", "error", "purchase", "signup", "view")


@job(f"""SELECT *, len(string_split(profile, ',')) AS num_elements FROM (
SELECT user_id, '[' || {" || ',' || ".join(f"count(*) FILTER (event_type = '{k}')" for k in _KINDS)}
  || ',' || count(*) || ',' || min(event_id) || ',' || max(event_id) || ']' AS profile
FROM events GROUP BY user_id)""")
def array_build(t: Tables) -> DataFrame:
    """Per user: counts by type, the total appended, first and last id concatenated."""
    per_user = t.events.groupBy("user_id").agg(
        *[F.count_if(F.col("event_type") == k).alias(k) for k in _KINDS],
        rows_counted("total"),
        F.min("event_id").alias("first"),
        F.max("event_id").alias("last"),
    )
    counts = arrays.array_append(arrays.array_construct(*_KINDS), F.col("total"))
    profile = arrays.array_concat(counts, arrays.array_construct("first", "last"))
    return per_user.select(
        "user_id",
        arrays.cast_array_to_string(profile).alias("profile"),
        F.size(profile).cast("long").alias("num_elements"),
    )


@job("""WITH pairs AS (
  SELECT DISTINCT o_custkey, l_suppkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
distances AS (
  SELECT o_custkey, l_suppkey, 2 * 3961 * asin(sqrt(
      pow(sin(radians((l_suppkey * 11 % 120 - 60) - (o_custkey * 7 % 120 - 60)) / 2), 2)
      + cos(radians(o_custkey * 7 % 120 - 60)) * cos(radians(l_suppkey * 11 % 120 - 60))
      * pow(sin(radians((l_suppkey * 29 % 360 - 180) - (o_custkey * 13 % 360 - 180)) / 2), 2))) AS miles FROM pairs)
SELECT o_custkey AS custkey, count(*) AS num_sites, round(min(miles), 3) AS nearest_mi,
round(min(miles) * 1.60934, 3) AS nearest_km FROM distances GROUP BY 1""")
def nearest_site(t: Tables) -> DataFrame:
    """Per customer, how near the nearest of its suppliers is.

    Sites get a point from their key. Only customer-supplier pairs that traded
    are compared, so the join is on order keys and copies collapse early.
    """
    pairs = (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select("o_custkey", "l_suppkey")
        .distinct()
    )

    def point(key: str, a: int, b: int):
        return (
            (F.col(key) * a % 120 - 60).cast("double"),
            (F.col(key) * b % 360 - 180).cast("double"),
        )

    spots = (*point("o_custkey", 7, 13), *point("l_suppkey", 11, 29))
    return (
        pairs.select(
            F.col("o_custkey").alias("custkey"),
            haversine_distance(*spots).alias("mi"),
            haversine_distance(*spots, unit="km").alias("km"),
        )
        .groupBy("custkey")
        .agg(
            rows_counted("num_sites"),
            F.round(F.min("mi"), 3).alias("nearest_mi"),
            F.round(F.min("km"), 3).alias("nearest_km"),
        )
    )


# fixed values: multiples of these fractions of a turn spread keys over the globe, poles included
_SPREAD = {"c_custkey": (0.6180339887498949, 0.4142135623730951), "s_suppkey": (0.7320508075688772, 0.23606797749978969)}


def _spot(key: str) -> tuple[str, str]:
    """Latitude and longitude from a key, as SQL that both engines read."""
    north, east = (f"({key} * CAST({part} AS DOUBLE) - floor({key} * CAST({part} AS DOUBLE)))" for part in _SPREAD[key])
    return f"180 * {north} - 90 AS lat", f"360 * {east} - 180 AS lon"


@job(f"""WITH points AS (SELECT c_custkey, {", ".join(_spot("c_custkey"))} FROM customer),
sites AS (SELECT s_suppkey, {", ".join(_spot("s_suppkey"))} FROM supplier),
measured AS (
  SELECT c_custkey, s_suppkey, 2 * 3961 * asin(sqrt(least(1.0,
      pow(sin(radians(s.lat - p.lat) / 2), 2)
      + cos(radians(p.lat)) * cos(radians(s.lat)) * pow(sin(radians(s.lon - p.lon) / 2), 2)))) AS miles
  FROM points p CROSS JOIN sites s)
SELECT c_custkey AS custkey, CAST(row_number() OVER (PARTITION BY c_custkey ORDER BY miles, s_suppkey) AS INTEGER) AS place,
       s_suppkey AS suppkey, round(miles, 3) AS miles
FROM measured QUALIFY place <= 3""")
def nearest_suppliers(t: Tables) -> DataFrame:
    """The three nearest of all suppliers for every customer."""
    points = t.customer.selectExpr("c_custkey", *_spot("c_custkey"))
    sites = t.supplier.selectExpr("s_suppkey", *_spot("s_suppkey"))
    found = nearest(points, sites, 3, ("c_custkey", "lat", "lon"), ("s_suppkey", "lat", "lon"))
    return found.select(
        F.col("point_id").alias("custkey"), "place", F.col("site_id").alias("suppkey"), F.round("distance", 3).alias("miles")
    )


@job("""SELECT o_orderstatus, count(*) FILTER (o_orderdate < CAST(now() AS TIMESTAMP)) AS num_past,
count(*) FILTER (o_orderdate >= CAST(now() AS TIMESTAMP) - INTERVAL 1 DAY) AS num_recent, TRUE AS is_utc_near FROM orders GROUP BY 1""")
def clock_now(t: Tables) -> DataFrame:
    """Orders held against the current time, in the session's zone and in UTC."""
    now, utc = dates.current_timestamp(), dates.current_timestamp_in_utc()
    recent = F.col("o_orderdate") >= dates.dateadd("day", -1, now)
    near = dates.datediff(now, utc, "hour").between(-14, 14)
    return t.orders.groupBy("o_orderstatus").agg(
        F.count_if(F.col("o_orderdate") < now).alias("num_past"), F.count_if(recent).alias("num_recent"),
        F.bool_and(near).alias("is_utc_near"),
    )
