import datetime as dt
import random
from collections import Counter

import pytest
from frames import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import columns, frequent, lookups, neighbours, reshape, series, sets
from tidemark.session import small_enough_to_broadcast


def test_star(spark):
    df = spark.createDataFrame([("a", "b", "c")], "field_1 string, field_2 string, field_3 string")
    assert df.select(*columns.star(df, except_=["FIELD_3"])).columns == ["field_1", "field_2"]
    renamed = df.select(*columns.star(df, prefix="prefix_", suffix="_suffix"))
    assert renamed.columns == [f"prefix_field_{i}_suffix" for i in (1, 2, 3)]
    assert columns.filtered_columns(df, ["field_1"]) == ["field_2", "field_3"]
    aliased = df.alias("x")
    assert aliased.select(*columns.star(df, relation_alias="x")).first() == ("a", "b", "c")
    with pytest.raises(ValueError):
        columns.star(df, except_=df.columns)


def test_nullcheck_table(spark):
    df = spark.createDataFrame([("a", "", 1), ("", "b", 2), ("", "", 3)], "x string, y string, z int")
    assert rows(columns.nullcheck_table(df)) == [("a", None, 1), (None, "b", 2), (None, None, 3)]


def test_group_by_ordinal(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 1, 6), ("b", 2, 7)], "x string, y int, v int")
    assert rows(columns.group_by_ordinal(df, 2).agg(F.sum("v"))) == [("a", 1, 11), ("b", 2, 7)]
    with pytest.raises(ValueError):
        columns.group_by_ordinal(df, 4)


@pytest.fixture
def parties(spark):
    one = spark.createDataFrame([(1, "ann", "pi"), (2, "bo", "e"), (3, "cy", "4")], "id int, name string, favorite_number string")
    two = spark.createDataFrame([(1, "green", 7), (2, "pink", 13)], "id int, favorite_color string, favorite_number int")
    return {"t1": one, "t2": two}


def test_union_relations(parties):
    got = sets.union_relations(parties)
    assert got.columns == ["_source_relation", "id", "name", "favorite_number", "favorite_color"]
    assert rows(got.select("id", "name", "favorite_color", "favorite_number")) == sorted(
        [(1, "ann", None, "pi"), (2, "bo", None, "e"), (3, "cy", None, "4"), (1, None, "green", "7"), (2, None, "pink", "13")],
        key=repr,
    )


def test_union_options(parties):
    assert sets.union_relations(parties, include=["id", "name"]).columns == ["_source_relation", "id", "name"]
    assert sets.union_relations(parties, exclude=["name"], source_column_name=None).columns == ["id", "favorite_number", "favorite_color"]
    # names are matched with their case
    assert "name" in sets.union_relations(parties, exclude=["NAME"]).columns
    assert dict(sets.union_relations(parties, column_override={"id": "string"}).dtypes)["id"] == "string"
    filtered = sets.union_relations(parties, include=["favorite_number"], where="id = 1")
    assert rows(filtered) == [("t1", "pi"), ("t2", "7")]
    with pytest.raises(ValueError):
        sets.union_relations(parties, include=["id"], exclude=["name"])
    with pytest.raises(ValueError):
        sets.union_relations(parties, include=["missing"])


def test_set_operations_treat_nulls_as_equal_and_drop_copies(spark):
    a = spark.createDataFrame([(1,), (2,), (3,), (3,), (None,)], "id int")
    b = spark.createDataFrame([(3,), (4,), (5,), (None,)], "other int")
    assert rows(sets.except_distinct(a, b)) == [(1,), (2,)]
    assert rows(sets.except_distinct(b, a)) == [(4,), (5,)]
    assert rows(sets.intersect_distinct(a, b)) == [(3,), (None,)]


def test_replicate_splits_large_counts(spark):
    df = spark.createDataFrame([("a", 1), ("b", 25), ("c", 10), ("d", 0)], "k string, n long")
    got = sets.replicate(df, "n", chunk=10)
    assert got.columns == ["k"]
    assert rows(got.groupBy("k").count()) == [("a", 1), ("b", 25), ("c", 10)]
    assert got.rdd.getNumPartitions() > 1


def test_deduplicate(spark):
    df = spark.createDataFrame([(1, "play", 1), (1, "play", 2), (2, "pause", 1)], "user_id int, event string, version int")
    assert rows(reshape.deduplicate(df, "user_id", "version desc")) == [(1, "play", 2), (2, "pause", 1)]
    # nulls count as the largest value, in both directions
    df = spark.createDataFrame([(1, None), (1, 5)], "k int, v int")
    assert rows(reshape.deduplicate(df, ["k"], "v desc")) == [(1, None)]
    assert rows(reshape.deduplicate(df, ["k"], "v")) == [(1, 5)]


def test_deduplicate_breaks_ties_by_the_other_columns(spark):
    data = [(1, 1, c) for c in "zyxwabc"]
    for seed in range(3):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "k int, v int, c string").repartition(4)
        assert rows(reshape.deduplicate(df, ["k"], ["v"])) == [(1, 1, "a")]


@pytest.fixture
def colors(spark):
    return spark.createDataFrame([("S", "red"), ("S", "blue"), ("S", "blue's"), ("M", "red")], "size string, color string")


def test_pivot(colors):
    assert rows(reshape.pivot(colors, "size", "color", ["red", "blue"])) == [("M", 1, 0), ("S", 1, 1)]
    slugged = reshape.pivot(colors, "size", "color", ["red", "blue", "blue's"], quote_identifiers=False)
    assert slugged.columns == ["size", "red", "blue", "blues"]
    assert rows(slugged) == [("M", 1, 0, 0), ("S", 1, 1, 1)]
    named = reshape.pivot(colors, "size", "color", ["red"], prefix="p_", suffix="_s", cmp="<>", agg="count", else_value=None)
    assert named.columns == ["size", "p_red_s"]
    assert rows(named) == [("M", 0), ("S", 2)]
    with pytest.raises(ValueError):
        reshape.pivot(colors, "size", "color", ["red"], cmp="~")


@pytest.mark.parametrize("agg", ["sum", "count", "min", "max", "avg"])
def test_pivot_distinct_matches_plain_distinct(spark, agg):
    data = [(g, c, v) for g in "ab" for c in "xy" for v in (1, 1, 2, 5, 5)]
    df = spark.createDataFrame(data, "g string, c string, v int")
    got = reshape.pivot(df, "g", "c", ["x", "y"], agg=agg, then_value=F.col("v"), else_value=F.lit(None), distinct=True)
    expected = {"sum": 8, "count": 3, "min": 1, "max": 5, "avg": 8 / 3}[agg]
    assert rows(got) == [("a", expected, expected), ("b", expected, expected)]


def test_unpivot_keeps_nulls_and_booleans(spark):
    df = spark.createDataFrame(
        [(123, "active", "tier 1", True), (567, "churned", "tier 2", None)],
        "customer_id int, status string, segment string, is_updated boolean",
    )
    got = reshape.unpivot(df, exclude=["CUSTOMER_ID"], remove=["segment"], field_name="prop", value_name="val")
    assert rows(got) == sorted([(123, "status", "active"), (123, "is_updated", "true"), (567, "status", "churned"), (567, "is_updated", None)], key=repr)
    assert got.columns == ["customer_id", "prop", "val"]
    with pytest.raises(ValueError):
        reshape.unpivot(df, exclude=df.columns)


def test_listagg_by(spark):
    df = spark.createDataFrame([(1, "a", 3), (1, "b", 1), (1, "b", 2), (2, "c", 1)], "g int, s string, o int")
    assert rows(reshape.listagg_by(df, "g", "s", order_by="o")) == [(1, "b,b,a"), (2, "c")]
    assert rows(reshape.listagg_by(df, "g", "s", order_by="o", limit=2)) == [(1, "b,b"), (2, "c")]
    assert rows(reshape.listagg_by(df, "g", "s", distinct=True)) == [(1, "a,b"), (2, "c")]
    with pytest.raises(ValueError):
        reshape.listagg_by(df, "g", "s", order_by="o", distinct=True)


def test_column_values(spark):
    df = spark.createDataFrame([(c,) for c in "abcdefggggg"], "field string")
    assert reshape.column_value_list(df, "field") == list("gabcdef")
    assert reshape.column_value_list(df, "field", max_records=2) == ["g", "a"]
    assert reshape.column_value_list(df, "field", order_by="value desc", max_records=2) == ["g", "f"]
    assert reshape.column_value_list(df, "field", where="field < 'c'") == ["a", "b"]
    assert reshape.column_value_list(None, "field", default=["x"]) == ["x"]
    with pytest.raises(ValueError):
        reshape.column_value_list(None, "field")
    with pytest.raises(ValueError):
        reshape.column_value_list(df, "field", bound=3)


def test_series_and_spines(spark):
    assert rows(series.generate_series(spark, 10)) == sorted([(i,) for i in range(1, 11)], key=repr)
    with pytest.raises(ValueError):
        series.generate_series(spark, 0)
    days = [r[0] for r in series.date_spine(spark, "day", "2018-01-01", "2018-01-10").orderBy("date_day").collect()]
    assert days[0] == dt.datetime(2018, 1, 1) and days[-1] == dt.datetime(2018, 1, 9) and len(days) == 9
    months = rows(series.date_spine(spark, "month", dt.datetime(2018, 1, 31), dt.datetime(2018, 4, 1)))
    assert [m[0].day for m in months] == [31, 28, 31]
    assert series.intervals_between(spark, "hour", "2024-01-01 00:59:00", "2024-01-01 03:00:00") == 3
    with pytest.raises(ValueError):
        series.date_spine(spark, "day", "2018-01-01", "2018-01-01")


def test_broadcast_check_counts_rows_and_bytes(spark):
    df = spark.createDataFrame([(1, "x" * 1000), (2, None)], "k int, v string")
    assert small_enough_to_broadcast(df, 2)
    assert not small_enough_to_broadcast(df, 1)
    assert not small_enough_to_broadcast(df, 2, max_bytes=1000)
    assert small_enough_to_broadcast(df.limit(0), 0, max_bytes=0)


def test_lookup_join_keeps_unmatched_and_broadcasts_only_small_tables(spark):
    facts = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    lookup = spark.createDataFrame([(1, "one"), (3, "three")], "k int, name string")
    got = lookups.lookup_left_join(facts, lookup, "k", broadcast_rows=10)
    assert rows(got) == [(1, "one"), (2, None), (None, None)]
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        big = lookups.lookup_left_join(facts, lookup, "k", broadcast_rows=1)
        small = lookups.lookup_left_join(facts, lookup, "k", broadcast_rows=2)
        plans = [d._jdf.queryExecution().executedPlan().toString() for d in (big, small)]
        assert "BroadcastHashJoin" not in plans[0] and "BroadcastHashJoin" in plans[1]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


@pytest.mark.parametrize("kind", ["long", "double", "date", "timestamp_ntz", "decimal(10,2)", "string", "binary", "array"])
@pytest.mark.parametrize("direction", ["previous", "next"])
def test_neighbours_match_a_single_window(spark, kind, direction):
    rng = random.Random(7)
    values = {("p" if rng.random() < 0.8 else "q", rng.choice([rng.randrange(40), rng.randrange(20000)])) for _ in range(300)}
    df = spark.createDataFrame([*values, ("q", None), ("r", 5)], "p string, n long")
    cast = {
        "date": F.date_add(F.lit("2000-01-01").cast("date"), F.col("n").cast("int")),
        "string": F.concat(F.when(F.col("n") % 2 == 0, F.lit("éa common beginning ")).otherwise(F.lit("")), F.col("n").cast("string")),
        "binary": F.col("n").cast("string").cast("binary"),
        "array": F.when(F.col("n").isNotNull(), F.array(F.col("n") % 3, "n")),
        "timestamp_ntz": F.timestamp_add("SECOND", F.col("n"), F.lit("1969-12-31").cast("timestamp_ntz")),
    }
    cast = cast[kind] if kind in cast else F.col("n").cast(kind)
    df = df.select("p", cast.alias("v"))
    for keys in ([], ["p"]):
        distinct = df if keys else df.select("v").distinct()
        shift = F.lag if direction == "previous" else F.lead
        window = Window.partitionBy(*keys).orderBy(F.col("v").asc_nulls_last())
        expected = distinct.withColumns({"x": shift("v").over(window), "m": shift(F.lit(1)).over(window).isNull()})
        got = neighbours.with_neighbour(distinct, "v", keys, direction, "x", "m", ranges=9)
        assert rows(got) == rows(expected)


def test_range_id_counts_bounds(spark):
    bounds = [1.0, 4.0, 4.5, 9.0, 12.0]
    df = spark.range(-3, 15).select(F.col("id").cast("double").alias("v"))
    got = df.select("v", neighbours.range_id(F.col("v"), bounds)).collect()
    assert all(n == sum(b <= v for b in bounds) for v, n in got)


def test_as_many_ranges_as_asked_for(spark):
    df = spark.range(60_000).select(F.col("id").alias("v"))
    assert len(neighbours.range_bounds(df, "v", 20_000)) > 19_000
    got = neighbours.with_neighbour(df, "v", name="x", ranges=20_000)
    assert got.where("x <> v - 1 or (x is null) <> (v = 0)").count() == 0


@pytest.mark.parametrize("kind", ["url", "struct", "array"])
def test_values_that_begin_alike_are_split_evenly(spark, kind):
    number = (F.col("id") * 7919) % 20_000
    value = {
        "url": F.concat(F.lit("https://www.example.org/a/very/long/common/path?item="), number.cast("string")),
        "struct": F.struct(F.lit("same").alias("a"), number.alias("b")),
        "array": F.array(F.lit(0), F.lit(0), number),
    }[kind]
    df = spark.range(20_000).select(value.alias("v"), F.lit(1).alias("_range"), F.lit(2).alias("_edge"), F.lit(3).alias("_planted"))
    cut = neighbours.ranged(df, "v", 8, "number")
    assert neighbours.largest_group(cut, ["number"]) < 2 * 20_000 / 8
    edges = cut.groupBy("number").agg(F.min("v").alias("low"), F.max("v").alias("high")).orderBy("number").collect()
    assert len(edges) == 8 and all(a.high < b.low for a, b in zip(edges, edges[1:], strict=False))
    got = neighbours.with_neighbour(df, "v", name="x", ranges=8)
    assert got.columns == [*df.columns, "x"] and got.where("_range <> 1 or _edge <> 2 or _planted <> 3").count() == 0
    expected = df.withColumn("x", F.lag("v").over(Window.orderBy("v")))
    assert got.exceptAll(expected).count() == 0 and got.where("x is null").count() == 1


@pytest.mark.parametrize("shape", ["skewed", "flat", "few", "empty"])
def test_most_frequent_values_are_exact(spark, shape):
    rng = random.Random(5)
    values = {
        "skewed": [f"v{int(rng.paretovariate(0.6)) % 50_000}" for _ in range(20_000)] + [None] * 300 + [""] * 40,
        "flat": [f"v{i}" for i in range(500)] * 2,
        "few": ["a", "b", "a", None],
        "empty": [],
    }[shape]
    df = spark.createDataFrame([(v, 1) for v in values], "v string, _hash_bucket int")
    for k, buckets in ((1, 1 << 12), (20, 1 << 12), (20, 16)):
        order = sorted(Counter(values).items(), key=lambda c: (-c[1], c[0] is None, c[0]))
        got = [tuple(r) for r in frequent.most_frequent(df, "v", k, buckets).collect()]
        assert got == order[:k]


def test_most_frequent_values_shuffle_few_of_the_others(spark):
    rng = random.Random(6)
    values = [f"v{int(rng.paretovariate(0.5)) % 1_000_000}" for _ in range(60_000)]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    counted = frequent.candidate_rows(df, "v", 10, 1 << 12).distinct().count()
    assert counted < len(set(values)) / 20
    text = frequent.most_frequent(df, "v", 10)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "Cartesian" not in text


def test_order_lists(spark):
    from pyspark.errors import AnalysisException, ParseException

    df = spark.createDataFrame(
        [(1, "old", 1, None), (1, "new", 2, "b"), (1, "newer", 2, "a"), (2, "x", None, "c"), (2, "y", 5, "d")],
        "k int, `the name` string, ts int, `a,b` string",
    )

    def first(order, keys="k"):
        return [r[1] for r in reshape.deduplicate(df, keys, order).orderBy("k").collect()]

    assert first("ts desc, `a,b`") == ["newer", "x"]
    assert first("ts desc nulls last, `a,b` desc") == ["new", "y"]
    assert first("ts NULLS FIRST") == ["old", "x"]
    assert first("a,b") == ["newer", "x"]  # a column's name as it is
    assert first("the name") == ["new", "x"]
    assert first(["coalesce(ts, 9) desc", "upper(`the name`) desc"]) == ["newer", "x"]
    assert first(F.col("ts").desc_nulls_last()) in (["new", "y"], ["newer", "y"])
    assert reshape.deduplicate(df, "k, ts % 2", "ts").count() == 4
    for wrong in ("ts descending", "ts desc desc", "ts nulls middle", "ts,,k"):
        with pytest.raises((AnalysisException, ParseException, ValueError)):
            first(wrong)


def test_listagg_puts_null_keys_last(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, None, "n"), (1, 1, "a"), (1, 2, "b"), (1, 2, "a")], "g int, o int, s string")

    def text(**options):
        return reshape.listagg_by(df, "g", "s", **options).first()["listagg"]

    assert text(order_by="o") == "a,a,b,c,n" and text(order_by="o", limit=2) == "a,a"
    assert text(order_by="o desc") == "n,c,a,b,a" and text(order_by="o desc nulls last") == "c,a,b,a,n"
    assert text(order_by="o desc", limit=3) == "n,c,a"
    assert text(order_by="s desc, o nulls first") == "n,c,b,a,a"
    assert text(order_by="s desc", distinct=True) == "n,c,b,a"


def test_listagg_in_runs_is_the_list_of_the_whole(spark):
    """One group holds nearly all rows; nulls in order and measure, ties, and columns named like the runs."""
    rng = random.Random(8)
    data = [("big" if rng.random() < 0.95 else "small", rng.choice([None, *range(400)]), rng.choice([None, "x", "y", f"v{i}"])) for i in range(8000)]
    df = spark.createDataFrame([*data, ("none", 1, None)], "_run string, o int, _piece string")
    for order in (None, "o", "o desc nulls last", "o nulls first, length(_piece) desc"):
        whole = rows(reshape.listagg_by(df, "_run", "_piece", order_by=order))
        assert rows(reshape.listagg_by(df, "_run", "_piece", order_by=order, runs=7)) == whole
    assert rows(reshape.listagg_by(df, "_run", "_piece", distinct=True, runs=3)) == rows(reshape.listagg_by(df, "_run", "_piece", distinct=True))
    assert reshape.listagg_by(df.limit(0), "_run", "_piece", runs=3).count() == 0


def test_value_lists_of_empty_tables(spark):
    df = spark.createDataFrame([("a", 1), ("b", 9), ("a", 5)], "v string, n int")
    assert reshape.column_value_list(df, "v", "max(n) desc") == ["b", "a"]
    assert reshape.column_value_list(df, "v", "v desc, num_rows") == ["b", "a"]
    assert reshape.column_value_list(df.limit(0), "v", default=["z"]) == ["z"]
    assert reshape.column_value_list(df.limit(0), "v") == []
    with pytest.raises(ValueError, match="bound"):
        reshape.column_value_list(df, "v", bound=1)
