"""Lookup values as of a time, and histories that follow them, against a plain Python replay."""

import datetime as dt
import random
import re
import threading

import pytest
from frames import rows
from pyspark.sql import functions as F

from tidemark.jobs import declared, warehouse
from tidemark.jobs.registry import Tables
from tidemark.operators.lookups import as_of_join, value_spans
from tidemark.plans import checks, scd2
from tidemark.plans import warehouse as plans_warehouse
from tidemark.session import new_folder, written
from tidemark.sources.history import HistoryStore

SPEC = scd2.Spec(
    name="things", entity="things", sources=("A", "B"), id_column="id",
    columns={"id": "id", "x": "x", "place": "place", "tax": "tax"}, tracked=("x", "place", "tax"),
    remaps={"B": {"place": scd2.Remap({1: 100})}},
    lookups={
        "place": scd2.Lookup("places", on="place_id", key="ID", value="name"),
        "tax": scd2.Lookup("rates", on="rate_id", key="ID", value="rate"),
    },
)
THINGS = f"src string, id int, x int, place_id int, rate_id int, {scd2.UPDATED} timestamp_ntz, {scd2.DELETED} timestamp_ntz"
PLACES = f"src string, ID int, name int, {scd2.UPDATED} timestamp_ntz"
RATES = f"src string, ID int, rate int, {scd2.UPDATED} timestamp_ntz"


def at(day):
    return None if day is None else dt.datetime(2024, 1, 1) + dt.timedelta(days=day)


def reader(spark, things, places, rates=()):
    raw = {
        "things": spark.createDataFrame([(*r[:5], at(r[5]), at(r[6])) for r in things], THINGS),
        "places": spark.createDataFrame([(*r[:3], at(r[3])) for r in places], PLACES),
        "rates": spark.createDataFrame([(*r[:3], at(r[3])) for r in rates], RATES),
    }
    return lambda table: raw[table.split("_")[1]].where(F.col("src") == table[0].upper())


def followed(spark, *tables):
    got = scd2.collect_following(SPEC, reader(spark, *tables))
    return got.withColumn("day", F.datediff(scd2.UPDATED, F.lit("2024-01-01")))


def short(df):
    """(src, id, x, place, tax, day), sorted, without copies."""
    return sorted(set(rows(df.select("src", "id", "x", "place", "tax", "day"))), key=repr)


def test_spans_hold_between_changes_only(spark):
    states = spark.createDataFrame(
        [(1, at(5), "b"), (1, at(2), "a"), (1, at(3), "a"), (1, at(5), "c"), (2, None, "z"), (2, at(1), None), (None, at(1), "n")],
        "k int, t timestamp_ntz, v string",
    )
    got = rows(value_spans(states, ["k"], "t", ["v"]).withColumn("t", F.year("t")).select("k", "t", "until", "v"))
    assert got == [(1, 2024, None, "c"), (1, 2024, at(5), "a"), (2, 1, at(1), "z"), (2, 2024, None, None)]


def test_as_of_join_keeps_every_fact_once(spark):
    states = spark.createDataFrame([(1, at(2), "a"), (1, at(5), "b"), (2, None, "z")], "k int, t timestamp_ntz, v string")
    facts = [(1, at(1)), (1, at(2)), (1, at(4)), (1, at(5)), (1, None), (2, at(0)), (3, at(9)), (None, at(9)), (1, at(4))]
    left = spark.createDataFrame(facts, "f int, _since timestamp_ntz")
    got = as_of_join(left, value_spans(states, ["k"], "t", ["v"]), {"f": "k"}, "_since", {"value": "v"}, since="t")
    assert got.columns == ["f", "_since", "value"]
    wanted = [None, "a", "a", "b", "b", "z", None, None, "a"]
    assert rows(got) == sorted([(*f, v) for f, v in zip(facts, wanted, strict=True)], key=repr)
    with pytest.raises(ValueError):
        as_of_join(left, value_spans(states, ["k"], "t", ["v"]), {"f": "k"}, "_since", {"F": "v"}, since="t")


def test_empty_tables(spark):
    assert rows(followed(spark, [], [("A", 1, 7, 1)])) == []
    assert short(followed(spark, [("A", 1, 5, 1, 1, 3, None)], [])) == [("A", 1, 5, None, None, 3)]


def test_a_changed_code_reaches_the_rows_that_use_it(spark):
    things = [("A", 1, 5, 10, None, 1, None), ("A", 1, 6, 20, None, 4, None), ("A", 2, 9, 10, 3, 1, None), ("B", 1, 5, 10, None, 1, None)]
    places = [("A", 10, 1, 0), ("A", 10, 2, 3), ("A", 10, 3, 5), ("A", 20, 8, None), ("B", 10, 1, 0)]
    rates = [("A", 3, 50, 3), ("A", 3, 60, 6), ("A", 3, 60, 7)]
    assert short(followed(spark, things, places, rates)) == [
        ("A", 1, 5, 1, None, 1), ("A", 1, 5, 2, None, 3), ("A", 1, 6, 8, None, 4),
        ("A", 2, 9, 1, None, 1), ("A", 2, 9, 2, 50, 3), ("A", 2, 9, 3, 50, 5), ("A", 2, 9, 3, 60, 6),
        ("B", 1, 5, 100, None, 1),
    ]


def test_deleted_rows_and_unknown_times_follow_nothing(spark):
    things = [
        ("A", 1, 5, 10, None, 1, 1), ("A", 2, 5, 10, None, None, None),
        ("A", 3, 5, 10, None, 1, None), ("A", 3, 6, 10, None, None, None),
    ]
    places = [("A", 10, 1, 0), ("A", 10, 2, 3)]
    assert short(followed(spark, things, places)) == [
        ("A", 1, 5, 1, None, 1), ("A", 2, 5, 2, None, None), ("A", 3, 5, 1, None, 1), ("A", 3, 6, 2, None, None),
    ]


def replay(things, places):
    """All moments by the definition, for one lookup."""

    def value(src, key, day):
        best = max(((d, v) for s, k, v, d in places if (s, k) == (src, key) and d <= day), default=(0, None))
        return {1: 100}.get(best[1], best[1]) if src == "B" else best[1]

    found = set()
    for src, i, x, place, _, day, gone in things:
        found.add((src, i, x, value(src, place, day), None, day))
        later = [t[5] for t in things if t[:2] == (src, i) and t[5] > day]
        if gone is None:
            for s, k, _, d in places:
                if (s, k) == (src, place) and day < d < min(later, default=1000) and value(s, k, d) != value(s, k, d - 0.5):
                    found.add((src, i, x, value(s, k, d), None, d))
    return sorted(found, key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_random_feeds_equal_the_replay(spark, seed):
    rng = random.Random(seed)
    # one id and one place hold a third of all rows
    things = {
        (src, i, day): (src, i, rng.randrange(3), rng.choice([1, 1, 2, 3, None]), None, day, rng.choice([None, None, day]))
        for src in "AB" for day in range(40) for i in [0, rng.randrange(1, 4)] if rng.random() < 0.6
    }
    places = {
        (src, k, day): (src, k, rng.randrange(3), day)
        for src in "AB" for day in range(0, 60) for k in [1, rng.randrange(1, 4)] if rng.random() < 0.3
    }
    things, places = list(things.values()), list(places.values())
    assert short(followed(spark, things, places)) == replay(things, places)


def test_history_gets_a_version_for_a_changed_code(spark):
    things = [("A", 1, 5, 10, None, 1, None), ("A", 2, 5, 20, None, 2, None)]
    before, after = [("A", 10, 1, 0)], [("A", 10, 1, 0), ("A", 10, 2, 7), ("A", 20, 4, 7)]
    store = HistoryStore(spark, new_folder(spark, "followed"))
    for places in (before, after):
        store.load(scd2.with_keys(scd2.collect_following(SPEC, reader(spark, things, places)), SPEC), SPEC)
    got = rows(store.read().select(scd2.KEY, "place", "valid_from", "valid_to", "is_current"))
    assert got == sorted(
        [("A_1", 1, at(1), at(7), False), ("A_1", 2, at(7), None, True),
         ("A_2", None, at(2), at(7), False), ("A_2", 4, at(7), None, True)], key=repr,
    )


def test_time_limits_reach_both_scans(spark):
    folder = new_folder(spark, "raw")
    read = reader(spark, [("A", 1, 5, 10, None, 1, None)], [("A", 10, 1, 0)])
    for table in ("a_things", "a_places", "a_rates"):
        read(table).write.parquet(f"{folder}/{table}")
    spec = scd2.Spec(**{**SPEC.__dict__, "sources": ("A",)})
    got = scd2.collect_following(spec, lambda table: spark.read.parquet(f"{folder}/{table}"))
    plan = got.where(F.col(scd2.UPDATED) > F.lit(at(5)))._jdf.queryExecution().executedPlan().toString()
    assert f"GreaterThan({scd2.UPDATED}," in plan
    assert "CartesianProduct" not in plan


def test_copies_are_not_shuffled_for_the_value_they_are_made_for(spark):
    spec = scd2.Spec(**{**SPEC.__dict__, "lookups": {"place": SPEC.lookups["place"]}, "columns": {"id": "id", "place": "place"}})
    things = [("A", i, 5, 10, None, i % 7, None) for i in range(300)]
    places = [("A", 10, i % 2, 10 + i) for i in range(100)]
    got = scd2.collect_following(spec, reader(spark, things, places))
    seen = got.count()
    assert seen == 300 * 101
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    # base rows once and copies once: no join above the union that stacks them
    assert plan.index("Union") < plan.index("Join")


def test_histories_need_few_copies(spark):
    rng = random.Random(5)
    things = [("A", rng.randrange(5), rng.randrange(3), rng.choice([1, 2]), 3, d, rng.choice([None, None, d])) for d in range(0, 80, 2)]
    places = [("A", k, d % 7, d) for d in range(100) for k in (1, 2)]
    rates = [("A", 3, d, d) for d in range(0, 100, 3)]
    read = reader(spark, things, places, rates)
    split, got, sizes = F.lit(at(41)), [], []
    for loads in (None, [split]):
        fed = written(scd2.with_keys(scd2.collect_following(SPEC, read, loads), SPEC), "fed")
        store = HistoryStore(spark, new_folder(spark, "followed"))
        store.load(fed.where(F.col(scd2.UPDATED) < split), SPEC)
        store.load(fed, SPEC)
        got.append(rows(store.read()))
        sizes.append(fed.count())
    assert got[0] == got[1] and any(not r[-1] for r in got[0])
    # each row, and for each lookup a copy before the limit and one of all
    assert sizes[1] <= len(things) * 5 < sizes[0]


def test_as_of_join_holds_a_fact_against_few_spans(spark):
    # every key has a state on each of 400 days; a fact meets the spans of its range of time only
    states = spark.range(1200).selectExpr("id % 3 as k", "timestamp_ntz'2024-01-01' + make_dt_interval(cast(id / 3 as int)) as t", "id as v")
    spans = written(value_spans(states, ["k"], "t", ["v"]), "spans")
    facts = spark.range(900).selectExpr("id", "id % 4 as f", "timestamp_ntz'2023-12-30' + make_dt_interval(cast(id / 2 as int), 5) as time")
    facts = facts.withColumn("time", F.when(F.col("id") % 50 != 0, F.col("time")))
    got = as_of_join(facts, spans, {"f": "k"}, "time", {"v": "v"}, since="t")
    plain = facts.join(spans, (F.col("f") == F.col("k")) & F.expr("if(time is null, until is null, t <= time and (until is null or time < until))"), "left")
    assert rows(got) == rows(plain.select(*facts.columns, "v"))
    keys = re.findall(r"Join(?: LeftOuter)?, \((.*)", got._jdf.queryExecution().optimizedPlan().toString())
    assert any("_asked" in found and "_met" in found for found in keys)


def test_a_delta_dealt_by_key_is_not_dealt_again(spark):
    read = reader(spark, [("A", 1, 5, 10, None, 1, None), ("A", 1, 6, 10, None, 4, None)], [("A", 10, 1, 0)])
    fed = scd2.with_keys(scd2.collect_following(SPEC, read), SPEC)
    target = scd2.initial(fed.where(F.col(scd2.UPDATED) < F.lit(at(3))), SPEC)
    found = scd2.changes(fed, target, SPEC).localCheckpoint().repartition(3, scd2.KEY)
    plan = scd2.delta_of(found, SPEC).repartition(3, scd2.KEY)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 1
    assert rows(scd2.delta_of(found, SPEC).select(scd2.KEY, "x", "is_current")) == [("A_1", 5, False), ("A_1", 6, True)]


def test_a_load_deals_neither_its_changes_nor_its_delta_again(spark, monkeypatch):
    read = reader(
        spark, [("A", i, 5 + day, 10, None, day, 6 if i == 2 and day == 4 else None) for i in range(40) for day in (1, 4) if i % 4 or day == 1], [("A", 10, 1, 0)]
    )
    fed = written(scd2.with_keys(scd2.collect_following(SPEC, read), SPEC), "fed")
    exchanges, decided, write = {}, scd2.decided, HistoryStore._write_buckets

    def planned(name, df):
        exchanges[name] = df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
        return df

    def write_buckets(store, rows, kind, run, buckets):
        return write(store, planned(f"{kind} {run}", rows), kind, run, buckets)

    monkeypatch.setattr(scd2, "decided", lambda *args: planned("changes", decided(*args)))
    monkeypatch.setattr(HistoryStore, "_write_buckets", write_buckets)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, buckets in (("as-shuffled", None), ("of-its-own", 3)):
            store = HistoryStore(spark, new_folder(spark, name), buckets)
            store.load(fed.where(F.col(scd2.UPDATED) < F.lit(at(3))), SPEC)
            store.load(fed, SPEC)
            # the keys closed before, here none, are dealt to the changes
            assert exchanges["changes"] == 1 and exchanges["current 1"] == 0
            assert len(store.files()) == len(store.commit().current)  # a bucket stays one file
            found = store.read()
            assert rows(found.select(scd2.KEY, "x")) == sorted(((f"A_{i}", x) for i in range(40) for x in (6, 9) if i % 4 or x == 6), key=repr)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("dealt_")]


def test_raw_tables_of_one_feed_are_joined_once(spark, monkeypatch):
    root, asked = new_folder(spark, "tables"), []
    days = "timestamp_ntz'2024-01-01' + make_dt_interval(cast(id as int))"
    tables = {
        "nation": spark.range(10).selectExpr("id n_nationkey", "id % 5 n_regionkey", "concat('N', id) n_name"),
        "customer": spark.range(12).selectExpr("id c_custkey", "concat('C', id) c_name", "id % 10 c_nationkey", "'M' c_mktsegment"),
        "orders": spark.range(30).selectExpr(
            "id o_orderkey", "nullif(id % 12, 7) o_custkey", "substr('FOP', cast(id % 3 as int) + 1, 1) o_orderstatus", "id * 1.5D o_totalprice",
            f"{days} o_orderdate", "concat(id % 5 + 1, '-X') o_orderpriority"),
        "lineitem": spark.range(90).selectExpr(
            "id % 30 l_orderkey", "id % 7 l_partkey", "id % 4 l_suppkey", "id % 3 l_linenumber", "nullif(id, 8) * 1D l_quantity", "id * 2D l_extendedprice",
            "0.1D l_discount", "0.02D l_tax", "if(id % 2 = 0, 'R', 'N') l_returnflag", "if(id % 5 = 0, 'O', 'F') l_linestatus", f"{days} l_shipdate"),
    }
    for name, df in tables.items():
        df.write.parquet(f"{root}/{name}.parquet")
    look = Tables.__getattr__
    monkeypatch.setattr(Tables, "__getattr__", lambda t, name: (asked.append(name), look(t, name))[1])
    read = warehouse.raw_from_feeds(Tables(spark, root))
    assert asked.count("lineitem") == 1 and asked.count("orders") == 2
    entities = list(warehouse._raw_columns())
    warehouse.write_raw(Tables(spark, root), f"{root}/raw", entities)
    for entity in entities:
        for source in plans_warehouse.SOURCES:
            apart = spark.read.parquet(f"{root}/raw/{entity}/src={source}")
            assert rows(read(f"{source.lower()}_{entity}").select(apart.columns)) == rows(apart)
            assert read(f"{source.lower()}_{entity}").columns == apart.columns


def test_copies_are_made_from_blocks_of_changes(spark):
    """A key with 900 changes, among them null values, and rows that live for any number of them."""
    states = spark.range(1000).selectExpr(
        "'A' as src", "if(id < 900, 1, 2) as _key", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, cast(id as int)) as _since", "if(id % 9 = 0, null, id) as _value"
    )
    spans = written(states, "spans")
    blocks = scd2._span_blocks(spans)
    assert blocks.agg(F.sum(F.size("_times")), F.max(F.size("_times")) <= scd2._BLOCK, F.count_if(F.size("_times") != F.size("_values"))).first() == (1000, True, 0)
    followed = spark.range(200).selectExpr(
        "'A' as src", "id", "cast(id % 3 as int) as _on_v", f"timestamp_ntz'2023-12-31 23:00:00' + make_dt_interval(0, 0, cast(id * 7 as int), 5) as {scd2.UPDATED}",
        f"if(id % 5 = 0, null, {scd2.UPDATED} + make_dt_interval(0, 0, cast(id * 3 as int))) as _next", "id % 5 = 0 as _last",
    )
    followed = written(followed.unionByName(followed.where("id = 1")), "followed")
    got = scd2._all_copies(followed, spans, "_on_v", "v").select("id", "v", scd2.UPDATED)
    plain = followed.join(spans, F.expr(f"_on_v = _key and _since > {scd2.UPDATED} and (_last or _since < _next)"))
    wanted = rows(plain.select("id", F.col("_value").alias("v"), F.col("_since")))
    assert len(wanted) > 10_000 and rows(got) == wanted


def test_the_key_of_a_copy_is_made_before_the_copy(spark):
    spec = scd2.Spec(**{**SPEC.__dict__, "lookups": {"place": SPEC.lookups["place"]}, "columns": {"id": "id", "place": "place"}})
    read = reader(spark, [("A", i, 5, 10, None, i % 7, None) for i in range(30)] + [("A", None, 5, 10, None, 3, None)], [("A", 10, i % 2, 10 + i) for i in range(100)])
    keyed, plain = (scd2.with_keys(scd2.collect_following(spec, read, keyed=k), spec) for k in (True, False))
    assert keyed.columns == plain.columns and rows(keyed) == rows(plain)
    plan = keyed._jdf.queryExecution().optimizedPlan().toString()
    copies = plan.split("\n+- ")[-1]  # the last branch of the union, from the top down
    assert "concat" not in copies[: copies.index("posexplode")] and "concat" in copies
    # the rows of one lookup key are in several tasks, whatever their bytes
    assert "_deal" in plan and "RepartitionByExpression" in plan


def test_tables_of_the_warehouse_are_loaded_side_by_side(spark, monkeypatch):
    begun, second, waited = [], threading.Event(), []

    def load(t, spec, read):
        begun.append(spec.name)
        if len(begun) > 1:
            second.set()
        waited.append(second.wait(60))
        kinds = {"is_current": "boolean", "valid_from": "timestamp_ntz", "valid_to": "timestamp_ntz", checks.CALENDAR_COLUMNS.get(spec.name): "date"}
        known = {"is_current": True, "valid_from": "2024-01-01", scd2.KEY: "k", scd2.VERSION_KEY: "v"}
        return spark.range(1).select(*[F.lit(known.get(c)).cast(kinds.get(c, "string")).alias(c) for c in scd2.version_columns(spec)])

    monkeypatch.setattr(declared, "load_history", load)
    monkeypatch.setattr(declared, "raw_from_feeds", lambda t: None)
    got = declared.dq_warehouse(Tables(spark, "unused")).collect()
    assert all(waited) and sorted(begun) == sorted(plans_warehouse.SPECS)
    # every table's checks, in the order of the tables; ids and no others are null here
    assert list(dict.fromkeys(r["table_name"] for r in got)) == list(plans_warehouse.SPECS)
    assert {r["check_name"] for r in got if r["failures"]} == {f"not_null_{s.id_column}" for s in plans_warehouse.SPECS.values()}


def test_versions_leave_a_delta_without_an_interpreted_step(spark):
    read = reader(spark, [("A", 1, 5, 10, None, 1, None), ("A", 1, 6, 10, None, 4, None), ("A", 2, 6, 10, None, 5, None)], [("A", 10, 1, 0)])
    fed = written(scd2.with_keys(scd2.collect_following(SPEC, read), SPEC), "fed")
    target = written(scd2.initial(fed.where(F.col(scd2.UPDATED) < F.lit(at(3))), SPEC), "target")
    found = scd2.delta(fed, target, SPEC)
    assert rows(found.select(scd2.KEY, "x", "is_current")) == [("A_1", 5, False), ("A_1", 6, True), ("A_2", 6, True)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "explode" in plan and "lambda" not in plan
