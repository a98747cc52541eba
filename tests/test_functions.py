import datetime as dt

import pytest
from frames import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.functions import aggregates, arrays, dates, keys, numbers, text, urls

TS = "timestamp_ntz"


def moment(value):
    return F.lit(value).cast(TS)


@pytest.mark.parametrize(
    "row, expected",
    [
        (("a", "b", "c"), "7b193b3d33184464106f41ddf733783b"),
        (("a", None, "c"), "c5fd1b92380c6222ab0ef67839208624"),
        ((None, None, "c"), "267743defab4558f1940311b66274e26"),
        ((None, None, None), "cfab1ba8c67c7c838db98d666f02a132"),
    ],
)
def test_surrogate_key(one, row, expected):
    assert one(keys.surrogate_key(*[F.lit(v).cast("string") for v in row])) == expected


def test_surrogate_key_of_one_field(one):
    assert one(keys.surrogate_key(F.lit("a"))) == "0cc175b9c0f1b6a831c399e269772661"
    assert one(keys.surrogate_key(F.lit(None).cast("string"))) == "d41d8cd98f00b204e9800998ecf8427e"


def test_surrogate_key_does_not_depend_on_the_session_zone(spark, one):
    key = keys.surrogate_key(F.lit("R0_1"), moment("2024-03-10 02:30:00.12"))
    before = one(key)
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert one(key) == before
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_concat_hash_and_natural_key(one):
    null = F.lit(None).cast("string")
    assert one(keys.concat(F.lit("a"), F.lit(1))) == "a1"
    assert one(keys.concat(F.lit("a"), null)) is None
    assert one(keys.md5_hash(F.lit("ab"))) == "187ef4436122d1cc2f40dc2b92f0eba0"
    assert one(keys.natural_key(F.lit("AHS"), F.lit(7))) == "AHS_7"
    assert one(keys.natural_key(F.lit("AHS"), F.lit(None).cast("int"))) is None


def test_text_helpers(one):
    assert one(text.length(F.lit("www.google.com/path"))) == 19
    assert one(text.position("def", F.lit("abcdef"))) == 4
    assert one(text.position("land", F.lit("earth"))) == 0
    assert one(text.replace(F.lit("http://google.com"), "http://", "")) == "google.com"
    assert one(text.right(F.lit("december"), 5)) == "ember"
    assert one(text.right(F.lit("december"), 0)) == ""
    assert one(text.right(F.lit("december"), 20)) == "december"
    assert one(text.right(F.lit("december"), -2)) == "cember"
    assert one(text.split_part(F.lit("a|b|c"), "|", 2)) == "b"
    assert one(text.split_part(F.lit("a|b|c"), "|", 9)) == ""
    assert one(text.split_part(F.lit("a, b, c"), ", ", -1)) == "c"
    assert one(text.safe_cast(F.lit("123"), "int")) == 123
    assert one(text.safe_cast(F.lit("abc"), "int")) is None
    assert one(text.cast_bool_to_text(F.lit(0) == 1)) == "false"
    assert one(text.nullcheck(F.lit(""))) is None
    assert one(text.nullcheck(F.lit("x"))) == "x"
    assert text.slugify("!Hell0 world-hi") == "hell0_world_hi"
    assert one(text.slugify_column(F.lit("!Hell0 world-hi"))) == "hell0_world_hi"


def test_split_part_refuses_part_zero(one):
    with pytest.raises(PySparkException):
        one(text.split_part(F.lit("a|b"), "|", 0))


@pytest.mark.parametrize(
    "first, second, part, expected",
    [
        ("2018-01-01 01:00:00", "2018-01-02 01:00:00", "day", 1),
        ("2018-01-01 01:00:00", "2018-02-01 01:00:00", "month", 1),
        ("2018-01-01 01:00:00", "2019-01-01 01:00:00", "year", 1),
        ("2018-01-01 01:00:00", "2018-01-01 02:00:00", "hour", 1),
        ("2018-01-01 01:00:00", "2018-01-01 02:01:00", "minute", 61),
        ("2018-01-01 01:00:00", "2018-01-01 02:00:01", "second", 3601),
        ("2019-12-31", "2019-12-27", "week", -1),
        ("2019-12-31", "2019-12-30", "week", 0),
        ("2019-12-31", "2020-01-02", "week", 0),
        ("2019-12-31", "2020-01-06 02:00:00", "week", 1),
        ("2019-12-31", "2019-12-24", "week", -1),
        ("2024-01-01 23:00:00", "2024-01-02 01:00:00", "day", 1),
        ("1960-05-01 00:00:30", "1960-04-30 23:59:30", "hour", -1),
        (None, "2018-01-01", "hour", None),
    ],
)
def test_datediff_counts_boundaries(one, first, second, part, expected):
    assert one(dates.datediff(moment(first), moment(second), part)) == expected


@pytest.mark.parametrize("part", dates.DATE_PARTS)
def test_one_microsecond_over_new_year_crosses_every_boundary(one, part):
    last, first = moment("1999-12-31 23:59:59.999999"), moment("2000-01-01 00:00:00")
    # 2000-01-01 is a Saturday, so the week does not change there
    assert one(dates.datediff(last, first, part)) == (0 if part == "week" else 1)


def test_week_boundary_is_sunday(one):
    assert one(dates.datediff(moment("2005-12-31 23:59:59.999999"), moment("2006-01-01"), "week")) == 1


@settings(max_examples=15, deadline=None)
@given(st.data())
def test_datediff_and_dateadd_agree(spark, data):
    part = data.draw(st.sampled_from(["second", "minute", "hour", "day", "week", "month", "quarter", "year"]))
    count = data.draw(st.integers(-400, 400))
    start = data.draw(st.datetimes(dt.datetime(1900, 1, 1), dt.datetime(2100, 1, 1)))
    begin = dates.moment(start)
    moved = dates.dateadd(part, count, begin)
    assert spark.range(1).select(dates.datediff(begin, moved, part)).first()[0] == count


@pytest.mark.parametrize(
    "count, part, expected",
    [
        (1, "day", "2018-01-02 01:00:00"),
        (1, "month", "2018-02-01 01:00:00"),
        (1, "year", "2019-01-01 01:00:00"),
        (1, "hour", "2018-01-01 02:00:00"),
        (-1, "quarter", "2017-10-01 01:00:00"),
        (5_000_000_000, "microsecond", "2018-01-01 02:23:20"),
    ],
)
def test_dateadd(one, count, part, expected):
    assert one(dates.dateadd(part, count, moment("2018-01-01 01:00:00")).cast("string")) == expected


def test_dateadd_clips_month_ends(one):
    assert one(dates.dateadd("month", 1, moment("2023-01-31")).cast("string")) == "2023-02-28 00:00:00"


def test_date_trunc(one):
    ts = moment("2018-02-07 12:34:56.789")
    expected = {
        "second": "2018-02-07 12:34:56", "minute": "2018-02-07 12:34:00",
        "hour": "2018-02-07 12:00:00", "day": "2018-02-07 00:00:00",
        "week": "2018-02-05 00:00:00", "month": "2018-02-01 00:00:00",
        "quarter": "2018-01-01 00:00:00", "year": "2018-01-01 00:00:00",
    }
    for part, text_ in expected.items():
        assert one(dates.date_trunc(part, ts).cast("string")) == text_, part


def test_date_trunc_is_zone_free(spark, one):
    """02:30 does not exist on that day in New York."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert one(dates.date_trunc("hour", moment("2024-03-10 02:30:00")).cast("string")) == "2024-03-10 02:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_last_day(one):
    day = F.lit("2018-01-02").cast("date")
    for part, expected in {"month": "2018-01-31", "quarter": "2018-03-31", "year": "2018-12-31", "week": "2018-01-07", "day": "2018-01-02"}.items():
        assert str(one(dates.last_day(day, part))) == expected
    with pytest.raises(ValueError):
        dates.last_day(day, "hour")
    with pytest.raises(ValueError):
        dates.datediff(day, day, "fortnight")


def test_current_timestamps_are_zone_less(spark):
    df = spark.range(1).select(
        dates.current_timestamp().alias("a"), dates.current_timestamp_in_utc().alias("b")
    )
    assert [f.dataType.simpleString() for f in df.schema] == [TS, TS]


@pytest.mark.parametrize(
    "amount, bucket",
    [(190000, 0), (290000, 1), (320000, 2), (399999.99, 2), (400000, 3), (470000, 3), (510000, 4),
     (610000, 5), (50000, 0), (700000, 5), (600000, 5), (200000, 1)],
)
def test_width_bucket(one, amount, bucket):
    assert one(numbers.width_bucket(F.lit(float(amount)), 200000, 600000, 4)) == bucket


def test_haversine(one):
    spots = [F.lit(v) for v in (48.864716, 2.349014, 52.379189, 4.899431)]
    assert round(one(numbers.haversine_distance(*spots))) == 267
    assert round(one(numbers.haversine_distance(*spots, unit="km"))) == 430
    poles = [F.lit(v) for v in (90.0, 0.0, -90.0, 0.0)]
    assert round(one(numbers.haversine_distance(*poles))) == 12444
    with pytest.raises(ValueError):
        numbers.haversine_distance(*spots, unit="ly")


@pytest.mark.parametrize("fields, total", [((1, 2, 3), 6), ((1, None, 3), 4), ((None, None, 2), 2), ((None, None, None), 0)])
def test_safe_add(one, fields, total):
    assert one(numbers.safe_add(*[F.lit(v).cast("int") for v in fields])) == total


def test_arrays(one):
    made = arrays.array_construct(F.lit(1), F.lit(2))
    assert one(arrays.cast_array_to_string(made)) == "[1,2]"
    assert one(arrays.cast_array_to_string(arrays.array_append(made, F.lit(3)))) == "[1,2,3]"
    assert one(arrays.cast_array_to_string(arrays.array_concat(made, made))) == "[1,2,1,2]"
    assert one(arrays.cast_array_to_string(arrays.array_construct())) == "[]"
    assert one(arrays.cast_array_to_string(F.array(F.lit(1), F.lit(None).cast("int")))) == "[1,NULL]"


@pytest.mark.parametrize(
    "url, host, path",
    [
        ("www.google.co.uk?utm_source=google&utm_medium=cpc", "www.google.co.uk", ""),
        ("http://example.com/2018/01/tips/", "example.com", "2018/01/tips/"),
        ("https://www.example.net/2018/01/01/blog", "www.example.net", "2018/01/01/blog"),
        ("docs.example.net/2021/index.js?utm_source=x", "docs.example.net", "2021/index.js"),
        ("http://example.com/2018/?a=b/c", "example.com", "2018/"),
        ("example.com", "example.com", "example.com"),
        ("example.com?next=/home", "example.com", "home"),
    ],
)
def test_url_parts(one, url, host, path):
    assert one(urls.get_url_host(F.lit(url))) == host
    assert one(urls.get_url_path(F.lit(url))) == path


def test_url_special_cases(one):
    assert one(urls.get_url_host(F.lit("android-app://m.facebook.com/"))) == "m.facebook.com"
    assert one(urls.get_url_path(F.lit("https://example.com"), host_as_path=False)) == ""
    assert one(urls.get_url_path(F.lit(None).cast("string"))) is None
    url = F.lit("http://example.com/milky?utm_medium=organic&utm_source=github")
    assert one(urls.get_url_parameter(url, "utm_medium")) == "organic"
    assert one(urls.get_url_parameter(url, "source")) == "github"
    assert one(urls.get_url_parameter(url, "utm_campaign")) is None
    assert one(urls.get_url_parameter(F.lit("http://a.b/?x=&y=1"), "x")) is None


def test_listagg_variants(spark):
    data = [(1, "a", 1), (1, "b", 2), (1, "c", 3), (2, "a", 2), (2, "1", 1), (2, "p", 3), (3, "g", 1), (3, "g", 2), (3, "g", 3)]
    df = spark.createDataFrame(data, "g int, s string, o int")

    def run(**options):
        return rows(df.groupBy("g").agg(aggregates.listagg("s", **options)))

    assert run(delimiter="_|_", order_by="o") == [(1, "a_|_b_|_c"), (2, "1_|_a_|_p"), (3, "g_|_g_|_g")]
    assert run(delimiter="_|_", order_by="o", limit=2) == [(1, "a_|_b"), (2, "1_|_a"), (3, "g_|_g")]
    assert run(order_by="o", descending=True)[0] == (1, "c,b,a")
    assert run()[2] == (3, "g,g,g")
    empty = spark.createDataFrame([(1, None)], "g int, s string")
    assert rows(empty.groupBy("g").agg(aggregates.listagg("s"))) == [(1, None)]


def test_any_value_and_bool_or(spark):
    data = [("abc", 1, 1), ("abc", 1, 0), ("def", 1, 0), ("hij", 1, 1), ("hij", 1, None), ("klm", 1, 0), ("klm", 1, None)]
    df = spark.createDataFrame(data, "key string, val1 int, val2 int")
    got = df.groupBy("key").agg(aggregates.bool_or(F.col("val1") == F.col("val2")), aggregates.any_value("val1"))
    assert rows(got) == [("abc", True, 1), ("def", False, 1), ("hij", True, 1), ("klm", False, 1)]
