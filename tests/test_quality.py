"""Each check on data that passes and on data that fails."""

import random

import pytest
from frames import rows
from pyspark.sql import functions as F

from tidemark.operators import quality


def frame(spark, schema, *data):
    return spark.createDataFrame([d if isinstance(d, tuple) else (d,) for d in data], schema)


def test_row_counts(spark):
    three, four = frame(spark, "f int", 1, 1, 2), frame(spark, "f int", 1, 2, 3, 4)
    assert rows(quality.equal_rowcount(three, three)) == [(3, 3, 0)]
    assert rows(quality.equal_rowcount(three, four)) == [(3, 4, 1)]
    assert rows(quality.fewer_rows_than(three, four)) == [(3, 4, 0)]
    assert rows(quality.fewer_rows_than(four, three)) == [(4, 3, 1)]
    assert rows(quality.fewer_rows_than(three, three)) == [(3, 3, 1)]
    assert rows(quality.equal_rowcount(three.limit(0), three)) == [(0, 3, 3)]


def test_equality(spark):
    a = frame(spark, "id int, v string", (1, "x"), (2, None), (2, None), (3, "z"))
    b = frame(spark, "id int, v string", (1, "x"), (2, None), (4, "w"))
    assert rows(quality.equality(a, b)) == [("a_minus_b", 3, "z"), ("b_minus_a", 4, "w")]
    assert rows(quality.equality(a, b, multiset=True)) == [("a_minus_b", 2, None), ("a_minus_b", 3, "z"), ("b_minus_a", 4, "w")]
    assert quality.equality(a, a).count() == 0
    assert rows(quality.equality(a, b, compare_columns=["v"])) == [("a_minus_b", "z"), ("b_minus_a", "w")]
    assert quality.equality_failures(quality.equality(a, b)).first()[0] == 2
    assert quality.equality_failures(quality.equality(a, b.limit(0))).first()[0] == 6
    assert quality.equality_failures(quality.equality(a, a)).first()[0] == 0


def test_expression_is_true(spark):
    df = frame(spark, "col_a double, col_b double", (0.0, 1.0), (1.0, 0.0), (0.5, 0.5), (None, 1.0))
    assert quality.expression_is_true(df, "col_a + col_b = 1").count() == 0
    assert rows(quality.expression_is_true(df, "col_a = 0.5")) == [(0.0, 1.0), (1.0, 0.0)]
    assert quality.expression_is_true(df, "col_a = 0.5", condition="col_b = 0.5").count() == 0
    assert quality.expression_is_true(df, "+ col_b = 1", column_name="col_a").count() == 0


def test_recency(spark):
    df = spark.sql("select timestamp_ntz'2024-01-10 00:00:00' as t")
    assert quality.recency(df, "t", "day", 1, now="2024-01-11 00:00:00").count() == 0
    assert quality.recency(df, "t", "day", 1, now="2024-01-11 00:00:01").count() == 1
    assert quality.recency(df.limit(0), "t", "day", 1).count() == 0
    assert quality.recency(df, "t", "year", 1).count() == 1


def test_at_least_one_and_not_constant(spark):
    df = frame(spark, "a string, b int, c int", ("x", 1, None), (None, 1, None))
    assert quality.at_least_one(df, "a").count() == 0
    assert quality.at_least_one(df, "c").count() == 1
    assert quality.not_constant(df, "b").count() == 1
    assert quality.not_constant(frame(spark, "b int", 1, 2), "b").count() == 0
    assert quality.not_constant(df, "c").count() == 0
    assert quality.not_constant(df.limit(0), "b").count() == 0


def test_cardinality_equality(spark):
    a = frame(spark, "v int", 1, 2, 3)
    b = frame(spark, "w int", 3, 1, 2)
    assert quality.cardinality_equality(a, "v", b, "w").count() == 0
    c = frame(spark, "w int", 1, 1, 2, None)
    assert rows(quality.cardinality_equality(a, "v", c, "w")) == [(1, 1), (1, 2), (3, 1), (None, 1)]


def test_unique_and_not_null(spark):
    df = frame(spark, "id int, gone boolean", (1, False), (2, False), (2, True), (None, True), (None, True))
    assert rows(quality.unique(df, "id")) == [(2, 2)]
    assert quality.unique_where(df, "id", "not gone").count() == 0
    assert quality.not_null(df, "id").count() == 2
    assert quality.not_null_where(df, "id", "not gone").count() == 0


def test_not_null_proportion(spark):
    half = frame(spark, "v int", 1, None)
    assert quality.not_null_proportion(half, "v", 0.5, 0.5).count() == 0
    assert rows(quality.not_null_proportion(half, "v", 0.9)) == [(0.5,)]
    assert quality.not_null_proportion(half, "v", 0.1, 0.4).count() == 1
    assert quality.not_null_proportion(half.limit(0), "v", 0.5).count() == 0


def test_accepted_and_forbidden_values(spark):
    df = frame(spark, "city string", "Paris", "Paris", "Rome", None)
    assert quality.not_accepted_values(df, "city", ["Madrid"]).count() == 0
    assert rows(quality.not_accepted_values(df, "city", ["Paris", "Oslo"])) == [("Paris",)]
    assert rows(quality.accepted_values(df, "city", ["Rome"])) == [("Paris", 2)]


def test_relationships(spark):
    child = frame(spark, "id int", 1, 2, 4, 4, None)
    parent = frame(spark, "pid int, ok boolean", (1, True), (2, False), (3, True), (None, True))
    assert rows(quality.relationships(child, "id", parent, "pid")) == [(4, None), (4, None)]
    assert rows(quality.relationships_where(child, "id", parent, "pid", "id <> 4", "ok")) == [(2, None)]


def test_unique_combination_counts_nulls_as_equal(spark):
    df = frame(spark, "m int, p string", (1, "a"), (1, "b"), (2, None), (2, None))
    assert rows(quality.unique_combination_of_columns(df, ["m", "p"])) == [(2, None)]


def test_accepted_range(spark):
    df = frame(spark, "id int", -1, 11, None)
    assert quality.accepted_range(df, "id", -1, 11).count() == 0
    assert quality.accepted_range(df, "id", -2, 11.1, inclusive=False).count() == 0
    assert rows(quality.accepted_range(df, "id", -1, 11, inclusive=False)) == [(-1,), (11,)]
    assert rows(quality.accepted_range(df, "id", min_value=0)) == [(-1,)]
    with pytest.raises(ValueError):
        quality.accepted_range(df, "id")


def test_strings_and_assert_equal(spark):
    df = frame(spark, "a string, b string", ("", "x"), ("y", "y"), (None, "z"))
    assert quality.not_empty_string(df, "a").count() == 1
    assert rows(quality.assert_equal(df, "a", "b")) == [("", "x")]


def test_sequential_values(spark):
    even = frame(spark, "n int", 2, 4, 6, 8, 10)
    assert quality.sequential_values(even, "n", 2).count() == 0
    assert quality.sequential_values(even, "n").count() == 4
    messy = frame(spark, "n int", 1, 2, 2, 2, 5, None)
    assert rows(quality.sequential_values(messy, "n", ranges=3)) == [(2, 2), (2, 2), (5, 2)]
    hours = spark.sql("select explode(sequence(timestamp_ntz'2021-01-01 00:00:00', timestamp_ntz'2021-01-01 05:00:00', interval 1 hour)) as t")
    assert quality.sequential_values(hours, "t", 1, "hour").count() == 0
    assert quality.sequential_values(hours.where("hour(t) <> 3"), "t", 1, "hour").count() == 1
    assert quality.sequential_values(hours, "t", 2, "hour").columns == ["t", "previous_t"]


def test_sequential_values_on_one_value_only(spark):
    same = spark.range(1000).select(F.lit(7).alias("n"))
    assert quality.sequential_values(same, "n").count() == 999
    assert quality.sequential_values(same, "n", interval=0).count() == 0


def test_ranges(spark):
    joined = frame(spark, "lo int, hi int", (0, 1), (1, 2), (2, 4))
    assert quality.mutually_exclusive_ranges(joined, "lo", "hi", gaps="not_allowed").count() == 0
    assert quality.mutually_exclusive_ranges(joined, "lo", "hi", gaps="required").count() == 2
    spaced = spark.sql("""select * from values (1, date'2019-01-01', date'2019-02-01'), (1, date'2019-03-03', date'2019-04-01'),
        (2, date'2019-05-06', date'2019-07-02'), (2, date'2019-07-03', null) t(k, lo, hi)""")
    upper = "coalesce(hi, date'2099-01-01')"
    for gaps, failures in (("allowed", 0), ("required", 0), ("not_allowed", 2)):
        for most in (0, 1000):
            got = quality.mutually_exclusive_ranges(spaced, "lo", upper, "k", gaps, max_partition_rows=most)
            assert got.count() == failures, gaps
    # an open end fails without the coalesce
    assert quality.mutually_exclusive_ranges(spaced, "lo", "hi", "k").count() == 1
    empty = frame(spark, "k int, lo int, hi int", (3, 1, 2), (3, 3, 3), (3, 5, 6))
    assert quality.mutually_exclusive_ranges(empty, "lo", "hi", "k").count() == 1
    assert quality.mutually_exclusive_ranges(empty, "lo", "hi", "k", zero_length_range_allowed=True).count() == 0
    with pytest.raises(ValueError):
        quality.mutually_exclusive_ranges(joined, "lo", "hi", gaps="maybe")


@pytest.mark.parametrize("gaps", ["allowed", "not_allowed", "required"])
@pytest.mark.parametrize("zero", [False, True])
@pytest.mark.parametrize("kind", ["int", "string", "date"])
def test_all_range_plans_agree(spark, gaps, zero, kind):
    """Random ranges with repeats, nulls, hot bounds and one dominant partition."""
    rng = random.Random(11)
    data = []
    for _ in range(250):
        lo = rng.choice([None, 5, rng.randrange(60), rng.randrange(60)])
        hi = rng.choice([None, lo, (lo or 0) + rng.randrange(-1, 4), rng.randrange(60)])
        data.append((rng.choice(["hot", "hot", "b", None]), lo, hi))
    df = spark.createDataFrame(data, "k string, lo int, hi int")
    if kind == "string":
        df = df.selectExpr("k", "lpad(lo, 9, 'a long beginning') as lo", "lpad(hi, 9, 'a long beginning') as hi")
    if kind == "date":
        df = df.selectExpr("k", "date_add(date'2020-01-01', lo) as lo", "date_add(date'2020-01-01', hi) as hi")
    # 1000 rows: a window per partition; 110: a window per range; 0: aggregates
    by_window, by_ranges, by_aggregates = (
        rows(quality.mutually_exclusive_ranges(df, "lo", "hi", "k", gaps, zero, most)) for most in (1000, 110, 0)
    )
    assert by_window == by_ranges == by_aggregates and by_window
    whole = [rows(quality.mutually_exclusive_ranges(df, "lo", "hi", None, gaps, zero, most)) for most in (1000, 0)]
    assert whole[0] == whole[1]


def test_range_plans_are_chosen_by_size(spark):
    df = spark.range(200).select(F.lit("p").alias("k"), F.col("id").alias("lo"), (F.col("id") + 1).alias("hi"))

    def plan(most):
        got = quality.mutually_exclusive_ranges(df, "lo", "hi", "k", max_partition_rows=most)
        return got._jdf.queryExecution().optimizedPlan().toString()

    assert "Union" not in plan(200) and "_range" not in plan(200)
    assert "Union" in plan(199) and "Join" not in plan(199)
    assert "Join" in plan(10)


def test_suite(spark):
    df = frame(spark, "id int, v string, n double", (1, "a", 0.5), (2, "", 3.0), (2, None, None))
    suite = (
        quality.Suite(df)
        .not_null("v").not_empty_string("v").accepted_values("v", ["a"]).accepted_range("n", 0, 1)
        .expression_is_true("positive", "n > 1").at_least_one("v").not_constant("id")
        .not_null_proportion("n", 0.9)
        .failing_rows("unique_id", quality.unique(df, "id"))
    )
    got = {r.check_name: r.failures for r in suite.run().collect()}
    assert got == {
        "not_null_v": 1, "not_empty_string_v": 1, "accepted_values_v": 1, "accepted_range_n": 1,
        "expression_positive": 1, "at_least_one_v": 0, "not_constant_id": 0,
        "not_null_proportion_n": 1, "unique_id": 1,
    }
    on_nothing = quality.Suite(df.limit(0)).not_null("v").not_constant("id").not_null_proportion("n", 0.9).run()
    assert all(r.failures == 0 for r in on_nothing.collect())
    with pytest.raises(ValueError):
        quality.Suite(df).run()


def test_suite_reads_the_table_once_for_all_aggregate_checks(spark, tmp_path):
    path = str(tmp_path / "t")
    frame(spark, "id int, v string", (1, "a")).write.parquet(path)
    run = quality.Suite(spark.read.parquet(path)).not_null("id").not_null("v").not_constant("id").run()
    assert run._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_checks_of_one_key_share_one_exchange(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    children = spark.createDataFrame(
        [(1, "a", True), (1, "b", False), (2, "a", True), (None, "a", True), (None, "a", True), (7, "z", True), (7, "z", False), (7, "z", True)],
        "k int, v string, ok boolean",
    )
    parents = spark.createDataFrame([(1, 5), (1, 5), (2, 0), (None, 9)], "id int, w int")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        by_key = (
            quality.Suite(children).unique("k").unique("k", "ok", "ok_once")
            .relationships("has_parent", "k", parents, "id").relationships("has_light", "k", parents, "id", "ok", "w < 5")
        )
        report = by_key.run()
        plan = report._jdf.queryExecution().executedPlan().toString()
        # one for the children, one for each parent's keys, one for the final sums
        assert plan.count("Exchange hashpartitioning(key0") == 1 and plan.count("Exchange hashpartitioning(parent") == 2
        assert {tuple(r) for r in report.collect()} == {("unique_k", 2), ("ok_once", 1), ("has_parent", 3), ("has_light", 3)}
        assert quality.unique(children, "k").count() == 2 and quality.relationships(children, "k", parents, "id").count() == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    pairs = quality.Suite(children).unique_combination(["k", "v"]).unique_combination(["v"], name="v_once").run()
    assert {tuple(r) for r in pairs.collect()} == {("unique_k_v", 2), ("v_once", 2)}
    assert {tuple(r) for r in quality.Suite(children.limit(0)).unique("k").relationships("p", "k", parents, "id").run().collect()} == {
        ("unique_k", 0), ("p", 0)}
