"""SCD2 behaviour on small feeds, and against a plain Python replay of the rules."""

import datetime as dt
import random

import pytest
from frames import rows
from pyspark.sql import functions as F

from tidemark.plans import checks, scd2, warehouse
from tidemark.session import matching_paths, new_folder
from tidemark.sources.history import HistoryStore
from tidemark.sources.key_filter import filter_pages, merged_pages, pages_for, perhaps
from tidemark.sources.tables import sync_schema, upsert_by_key, write_table

SPEC = scd2.Spec(
    name="things", entity="things", sources=("A", "B"), id_column="id",
    columns={"id": "id", "x": "x", "note": "note"}, tracked=("x",),
)
SCHEMA = f"id int, x string, note string, src string, {scd2.UPDATED} timestamp_ntz, {scd2.DELETED} timestamp_ntz"


def at(day):
    return None if day is None else dt.datetime(2024, 1, 1) + dt.timedelta(days=day)


def feed(spark, *changes):
    """(src, id, x, updated day, deleted day or None)."""
    data = [(i, x, f"n{u}", s, at(u), at(d)) for s, i, x, u, d in changes]
    return scd2.with_keys(spark.createDataFrame(data, SCHEMA), SPEC)


def saved(spark, df):
    path = new_folder(spark, "test")
    write_table(df, path)
    return spark.read.parquet(path)


def short(df):
    """(src_id, x, from day, to day, current), sorted."""
    def day(t):
        return None if t is None else (t - dt.datetime(2024, 1, 1)).days

    return sorted(
        ((r.src_id, r.x, day(r.valid_from), day(r.valid_to), r.is_current) for r in df.collect()),
        key=repr,
    )


def run(spark, first, then, **options):
    """History after a first load of ``first`` and one run over everything."""
    options = scd2.Options(**options)
    target = saved(spark, scd2.initial(feed(spark, *first), SPEC, options))
    delta = scd2.delta(feed(spark, *first, *then), target, SPEC, options)
    keys = [r[0] for r in delta.select(scd2.VERSION_KEY).collect()]
    assert len(keys) == len(set(keys)), "one row per version key"
    return short(upsert_by_key(target, delta, scd2.VERSION_KEY))


def test_initial_load_keeps_the_newest_row_even_if_deleted(spark):
    loaded = feed(spark, ("A", 1, "a", 0, None), ("A", 1, "b", 2, None), ("B", 1, "c", 1, 1))
    assert short(scd2.initial(loaded, SPEC)) == [("A_1", "b", 2, None, True), ("B_1", "c", 1, None, True)]
    kept = scd2.initial(loaded, SPEC, scd2.Options(skip_deleted_on_initial=True))
    assert short(kept) == [("A_1", "b", 2, None, True)]
    assert scd2.initial(loaded, SPEC).columns == scd2.version_columns(SPEC)


def test_unchanged_changed_and_new_keys(spark):
    got = run(
        spark,
        [("A", 1, "a", 0, None), ("A", 2, "b", 0, None), ("A", 3, None, 0, None), ("A", 4, "d", 0, None)],
        [("A", 1, "a", 5, None), ("A", 2, "B", 5, None), ("A", 3, "c", 5, None), ("A", 4, None, 5, None),
         ("B", 1, "new", 5, None), ("B", 2, "stillborn", 5, 5)],
    )
    assert got == sorted([
        ("A_1", "a", 0, None, True),
        ("A_2", "b", 0, 5, False), ("A_2", "B", 5, None, True),
        ("A_3", None, 0, 5, False), ("A_3", "c", 5, None, True),
        ("A_4", "d", 0, 5, False), ("A_4", None, 5, None, True),
        ("B_1", "new", 5, None, True),
    ], key=repr)


def test_untracked_columns_open_no_version(spark):
    """``note`` differs in every row and is not tracked."""
    assert run(spark, [("A", 1, "a", 0, None)], [("A", 1, "a", 1, None)]) == [("A_1", "a", 0, None, True)]


def test_several_changes_in_one_batch_collapse_to_the_newest(spark):
    got = run(spark, [("A", 1, "a", 0, None)], [("A", 1, "b", 1, None), ("A", 1, "c", 2, None)])
    assert got == [("A_1", "a", 0, 2, False), ("A_1", "c", 2, None, True)]


def test_deleted_key_is_closed_at_the_delete(spark):
    got = run(spark, [("A", 1, "a", 0, None), ("A", 2, "b", 0, None)], [("A", 1, "a", 3, 4)])
    assert got == [("A_1", "a", 0, 4, False), ("A_2", "b", 0, None, True)]


def test_key_deleted_before_the_first_load_is_closed_by_the_next_run(spark):
    assert run(spark, [("A", 1, "a", 0, 0)], [("A", 2, "b", 1, None)]) == [
        ("A_1", "a", 0, 0, False), ("A_2", "b", 1, None, True)]


def test_changed_and_deleted_in_one_run(spark):
    changes = [("A", 1, "a", 0, None)], [("A", 1, "b", 3, 3)]
    assert run(spark, *changes) == [("A_1", "a", 0, 3, False), ("A_1", "b", 3, None, True)]
    assert run(spark, *changes, delete_wins=True) == [("A_1", "a", 0, 3, False)]


def test_earliest_delete_inside_the_validity_ends_the_version(spark):
    got = run(
        spark, [("A", 1, "a", 2, None)],
        [("A", 1, "a", 4, 4), ("A", 1, "a", 5, 5), ("A", 1, "a", 1, 1), ("A", 1, "a", 6, None)],
    )
    assert got == [("A_1", "a", 2, 4, False)]


def test_old_delete_row_closes_a_live_key_unless_only_newest_rows_count(spark):
    first = [("A", 1, "a", 0, 0), ("A", 1, "a", 2, None)]
    then = [("A", 9, "z", 3, None)]
    assert run(spark, first, then)[0] == ("A_1", "a", 2, 0, False)
    assert run(spark, first, then, delete_from_latest_only=True)[0] == ("A_1", "a", 2, None, True)


def test_reappearing_key_is_lost_unless_reopened(spark):
    target = saved(spark, scd2.initial(feed(spark, ("A", 1, "a", 0, 0)), SPEC))
    seen = [("A", 1, "a", 0, 0), ("A", 2, "b", 1, None)]
    closed = saved(spark, upsert_by_key(target, scd2.delta(feed(spark, *seen), target, SPEC), scd2.VERSION_KEY))
    seen += [("A", 1, "back", 2, None)]
    again = scd2.delta(feed(spark, *seen), closed, SPEC)
    assert short(again) == []
    opened = scd2.delta(feed(spark, *seen), closed, SPEC, scd2.Options(reopen_deleted=True))
    assert short(opened) == [("A_1", "back", 2, None, True)]


def test_one_watermark_skips_a_late_source(spark):
    first = [("A", 1, "a", 5, None), ("B", 1, "b", 2, None)]
    late = [("B", 2, "late", 3, None), ("A", 2, "tie", 5, None)]
    assert run(spark, first, late) == [("A_1", "a", 5, None, True), ("B_1", "b", 2, None, True)]
    per_source = run(spark, first, late, watermark_per_source=True)
    assert per_source == [("A_1", "a", 5, None, True), ("B_1", "b", 2, None, True), ("B_2", "late", 3, None, True)]


def test_empty_target_passes_nothing(spark):
    target = saved(spark, scd2.initial(feed(spark, ("A", 1, "a", 0, None)), SPEC).limit(0))
    assert scd2.delta(feed(spark, ("A", 1, "a", 0, None)), target, SPEC).count() == 0


def test_null_ids_stay_out_and_can_be_counted(spark):
    loaded = feed(spark, ("A", None, "a", 0, None), ("A", None, "b", 1, 1), ("A", 1, "c", 0, None))
    assert scd2.null_key_rows(loaded).count() == 2
    assert short(scd2.initial(loaded, SPEC)) == [("A_1", "c", 0, None, True)]


def test_null_change_time_counts_as_newest_and_ties_are_settled(spark):
    loaded = feed(spark, ("A", 1, "a", None, None), ("A", 1, "b", 3, None), ("A", 2, "z", 3, None), ("A", 2, "y", 3, None))
    got = {r.src_id: r.x for r in scd2.latest_per_key(loaded).collect()}
    assert got == {"A_1": "a", "A_2": "y"}


def test_parts_add_up_to_the_delta(spark):
    first = [("A", i, "a", 0, None) for i in range(6)]
    then = [("A", 0, "b", 2, None), ("A", 1, "a", 2, 2), ("A", 2, "b", 2, 2), ("B", 0, "n", 2, None)]
    target = saved(spark, scd2.initial(feed(spark, *first), SPEC))
    loaded = feed(spark, *first, *then)
    assert [r[0] for r in short(scd2.expired(loaded, target, SPEC))] == ["A_0", "A_2"]
    assert [r[0] for r in short(scd2.deleted(loaded, target, SPEC))] == ["A_1", "A_2"]
    assert [r[0] for r in short(scd2.inserts(loaded, target, SPEC))] == ["A_0", "A_2", "B_0"]
    assert sorted(r.src_id for r in scd2.changed(loaded, target, SPEC).collect()) == ["A_0", "A_2"]
    assert [r.src_id for r in scd2.new(loaded, target, SPEC).collect()] == ["B_0"]
    assert scd2.delta(loaded, target, SPEC).count() == 6


# ------------------------------------------------------- random histories


def replay(history, seen, watermark=None):
    """The rules of one run, written as loops. ``history``: {version: [src_id, x, from, to, current]}."""
    if not history:
        newest = {}
        for c in sorted(seen, key=lambda c: c[3]):
            newest[f"{c[0]}_{c[1]}"] = c
        return {(k, c[3]): [k, c[2], c[3], None, True] for k, c in newest.items()}
    limit = max(v[2] for v in history.values())
    out = {k: list(v) for k, v in history.items()}
    newest = {}
    for c in sorted((c for c in seen if c[3] > limit), key=lambda c: c[3]):
        newest[f"{c[0]}_{c[1]}"] = c
    open_now = {v[0]: k for k, v in history.items() if v[4]}
    known = {v[0] for v in history.values()}
    for key in known | set(newest):
        c, version = newest.get(key), open_now.get(key)
        ends = [d for s, i, _, _, d in seen if d is not None and f"{s}_{i}" == key]
        is_changed = c is not None and version is not None and history[version][1] != c[2]
        if version is not None and (is_changed or ends):
            start = history[version][2]
            after = min((d for d in ends if d >= start), default=None)
            if is_changed:
                end = min(t for t in (c[3], after) if t is not None)
            else:
                end = after if after is not None else max(ends)
            out[version][3:] = [end, False]
        if c is not None and (is_changed or (key not in known and c[4] is None)):
            out[(key, c[3])] = [key, c[2], c[3], None, True]
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_histories_match_the_replay_and_pass_the_checks(spark, seed):
    rng = random.Random(seed)
    changes = []
    for day in rng.sample(range(200), 120):
        deleted = day if rng.random() < 0.2 else None
        changes.append((rng.choice("AB"), rng.randrange(8), rng.choice("pqr"), day, deleted))
    store = HistoryStore(spark, new_folder(spark, "random"))
    history = {}
    for limit in (50, 90, 140, 200):
        seen = [c for c in changes if c[3] < limit]
        store.load(feed(spark, *seen), SPEC)
        history = replay(history, seen)
        assert short(store.read()) == sorted((tuple(v) for v in history.values()), key=repr)
    found = {r.check_name: r.failures for r in checks.history_checks(store.read()).run().collect()}
    for name in ("not_null_src_id", "expression_open_iff_current", "unique_surrogate_key", "unique_current_src_id"):
        assert found[name] == 0, name


def test_batches_replayed_together_or_apart_agree_without_deletes(spark):
    rng = random.Random(5)
    changes = [(rng.choice("AB"), rng.randrange(5), f"v{d}", d, None) for d in rng.sample(range(100), 60)]
    apart = HistoryStore(spark, new_folder(spark, "apart"))
    for limit in range(10, 101, 30):
        apart.load(feed(spark, *[c for c in changes if c[3] < limit]), SPEC)
    current = {r.src_id: (r.x, r.valid_from) for r in apart.read_current().collect()}
    whole = {r.src_id: (r.x, r.valid_from) for r in scd2.initial(feed(spark, *changes), SPEC).collect()}
    assert current == whole


# ----------------------------------------------------------- skew and plans


def test_hot_key_gives_one_row_per_task_before_the_shuffle(spark):
    df = feed(spark, *[("A", 1, f"v{i}", i, None) for i in range(40)], ("A", 2, "x", 0, None))
    plan = scd2.latest_per_key(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_target_scan_reads_current_and_closed_separately_and_pushes_the_watermark(spark):
    first, then = [("A", 1, "a", 0, 0)], [("A", 2, "b", 1, None)]
    store = HistoryStore(spark, new_folder(spark, "plan"))
    store.load(saved(spark, feed(spark, *first)), SPEC)
    store.load(saved(spark, feed(spark, *first, *then)), SPEC)
    loaded = saved(spark, feed(spark, *first, *then))
    plan = scd2.delta(loaded, store.read(), SPEC)._jdf.queryExecution().executedPlan().toString()
    assert f"GreaterThan({scd2.UPDATED}" in plan
    # current versions: once as versions, once as narrow keys, and for the watermark; closed: keys, watermark
    assert plan.count("current/batch") <= 4


# -------------------------------------------------------------------- store


def test_failed_run_leaves_the_table_and_is_repeated(spark):
    store = HistoryStore(spark, new_folder(spark, "store"))
    first, then = [("A", 1, "a", 0, None)], [("A", 1, "b", 1, None)]
    store.load(feed(spark, *first), SPEC)
    before = short(store.read())
    # a run that wrote its delta but not the current versions
    write_table(scd2.initial(feed(spark, ("A", 7, "junk", 0, None)), SPEC), f"{store.path}/runs/batch=000001")
    assert short(store.read()) == before and store.runs() == [0]
    store.load(feed(spark, *first, *then), SPEC)
    assert store.runs() == [0, 1]
    assert short(store.read()) == [("A_1", "a", 0, 1, False), ("A_1", "b", 1, None, True)]
    with pytest.raises(ValueError):
        store.start(scd2.initial(feed(spark, *first), SPEC))


def test_leftovers_go_under_any_overwrite_mode(spark):
    """A failed run closed A_1; its repeat closes nothing."""
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        store = HistoryStore(spark, new_folder(spark, "dynamic"))
        store.load(feed(spark, ("A", 1, "a", 0, None)), SPEC)
        failed = scd2.delta(feed(spark, ("A", 1, "x", 1, None)), store.read(), SPEC)
        failed.write.partitionBy("is_current").parquet(f"{store.path}/runs/batch=000001")
        store.load(feed(spark, ("A", 2, "b", 1, None)), SPEC)
        assert short(store.read()) == [("A_1", "a", 0, None, True), ("A_2", "b", 1, None, True)]
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_store_follows_the_columns_of_the_newest_run(spark):
    store = HistoryStore(spark, new_folder(spark, "evolve"))
    store.load(feed(spark, ("A", 1, "a", 0, None), ("A", 2, "b", 0, None)), SPEC)
    store.load(feed(spark, ("A", 1, "c", 1, None)), SPEC)
    wider = scd2.delta(feed(spark, ("A", 2, "d", 2, None)), store.read(), SPEC)
    store.apply(wider.drop("note").withColumn("extra", F.lit(1)))
    got = store.read()
    assert "note" not in got.columns and "extra" in got.columns
    assert rows(got.groupBy("extra", "is_current").count()) == sorted(
        [(1, True, 1), (1, False, 1), (None, True, 1), (None, False, 1)], key=repr)


def test_a_column_added_to_the_spec_reaches_the_table(spark):
    wider = scd2.Spec(
        name="things", entity="things", sources=("A", "B"), id_column="id",
        columns={"id": "id", "x": "x", "z": "z"}, tracked=("x", "z"),
    )

    def wide(*changes):
        narrow = [(i, x, None, s, at(u), at(d)) for s, i, x, u, d in changes]
        frame = spark.createDataFrame(narrow, SCHEMA).withColumn("z", F.col("x"))
        return scd2.with_keys(frame, wider)

    store = HistoryStore(spark, new_folder(spark, "wider"))
    store.load(feed(spark, ("A", 1, "a", 0, None), ("A", 2, "b", 0, None)), SPEC)
    store.load(wide(("A", 1, "a", 1, None), ("A", 2, None, 1, None), ("A", 3, "c", 1, None)), wider)
    got = store.read()
    assert got.columns == scd2.version_columns(wider)
    assert sorted(((r.src_id, r.x, r.z, r.is_current) for r in got.collect()), key=repr) == sorted(
        [("A_1", "a", None, False), ("A_1", "a", "a", True), ("A_2", "b", None, False),
         ("A_2", None, None, True), ("A_3", "c", "c", True)], key=repr)


def test_upsert_and_schema_sync(spark):
    target = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (None, "n", 0.0)], "k int, v string, old double")
    delta = spark.createDataFrame([(2, "B", True), (3, "C", False)], "k int, v string, added boolean")
    assert sync_schema(target, delta).columns == ["k", "v", "added"]
    assert rows(upsert_by_key(target, delta, "k")) == sorted(
        [(1, "a", None), (None, "n", None), (2, "B", True), (3, "C", False)], key=repr)


# --------------------------------------------------------------- warehouse


def test_warehouse_specs_are_consistent():
    assert len(warehouse.SPECS) == 9
    for spec in warehouse.SPECS.values():
        assert set(spec.tracked) <= set(spec.business_columns), spec.name
        assert spec.id_column in spec.columns
        assert set(spec.foreign_keys.values()) <= set(spec.columns)
    assert "src_usagers_id" in warehouse.FACT_FACTURES.business_columns
    assert "date_fact" not in warehouse.FACT_FACTURES.tracked


@pytest.mark.parametrize(
    "spec, column, source, codes",
    [
        ("dim_usagers", "type_usagers_id", "AHS", {4: 4, 5: 7}),
        ("dim_usagers", "type_usagers_id", "CSM", {4: 10, 5: 8, 1: 1}),
        ("dim_usagers", "type_usagers_id", "OCC", {4: 6, 5: 12}),
        ("dim_usagers", "type_usagers_id", "CZ", {4: 5, 5: 11}),
        ("dim_usagers", "type_usagers_id", "SAHARA", {4: 4, 5: 9}),
        ("dim_p_eau", "nature_p_eau_id", "OCC", {5: 7, 7: 7, 1: 1}),
        ("fact_encaissement", "type_paie_id", "CZ", {4: 1, 0: 0, 1: 2, 7: 8, None: None}),
    ],
)
def test_code_remaps(spark, spec, column, source, codes):
    remap = warehouse.SPECS[spec].remaps[source][column]
    df = spark.createDataFrame([(k,) for k in codes], "code int")
    assert {r[0]: r[1] for r in df.select("code", remap.apply(F.col("code"))).collect()} == codes


def test_usagers_fetch_the_wilaya_code_of_their_own_source(spark):
    spec = warehouse.DIM_USAGERS
    stamp = "cast('2024-01-01' as timestamp_ntz)"

    def read(table):
        source, _, entity = table.partition("_")
        if entity == "wilaya":
            return spark.sql(f"select 1 as ID, 'W-{source}' as code_wilaya")
        raw = {v: "cast(null as string)" for v in spec.columns.values() if v != "code_wilaya"}
        raw.update({"Id": "1", "type_unite_id": "5", "commune_id": "3", "wilaya_id": "1"})
        listed = ", ".join(f"{v} as `{k}`" for k, v in raw.items())
        return spark.sql(f"select {listed}, {stamp} as {scd2.UPDATED}, cast(null as timestamp_ntz) as {scd2.DELETED}")

    keyed = scd2.with_keys(scd2.collect(spec, read), spec)
    got = {r.src: (r.src_id, r.src_commune_id, r.code_wilaya, r.type_usagers_id) for r in keyed.collect()}
    assert got["CSM"] == ("CSM_1", "CSM_3", "W-csm", 8)
    assert got["SAHARA"] == ("SAHARA_1", "SAHARA_3", "W-sahara", 9)
    assert len(got) == 5


def test_repeated_lookup_keys(spark):
    def read(table):
        twice = "union all select 1, 'again'" if table == "cz_wilaya" else ""
        return spark.sql(f"select 1 as ID, 'w' as code_wilaya union all select 2, 'x' {twice}")

    assert rows(checks.repeated_lookup_keys(warehouse.DIM_USAGERS, read)) == [("CZ", "wilaya", "1", 2)]
    with pytest.raises(ValueError):
        checks.repeated_lookup_keys(SPEC, read)


def test_table_checks_look_dates_up_in_the_calendar(spark):
    spec = warehouse.FACT_FACTURES
    base = scd2.initial(feed(spark, ("A", 1, "a", 0, None), ("A", 2, "b", 1, None)), SPEC)
    versions = base.withColumns({"facture_id": F.col("id"), "date_fact": F.col("valid_from").cast("date")})
    calendar = spark.sql("select date'2024-01-01' as full_date")
    found = {r.check_name: r.failures for r in checks.table_checks(versions, spec, calendar).run().collect()}
    assert found["calendar_date_fact"] == 1 and found["not_null_facture_id"] == 0


# ------------------------------------------------------- shuffles and skew


@pytest.fixture
def without_broadcasts(spark):
    """Plans as for tables too large to broadcast, with tiny limits for skew."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_current_versions_are_not_exchanged(spark, without_broadcasts):
    store = HistoryStore(spark, new_folder(spark, "bucketed"))
    store.load(feed(spark, *[("A", i, "a", 0, None) for i in range(50)]), SPEC)
    loaded = saved(spark, feed(spark, ("A", 1, "b", 2, None), ("A", 2, "a", 3, 3)))
    plan = scd2.delta(loaded, store.read(), SPEC)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    wide = [i for i, line in enumerate(lines) if "FileScan" in line and "history_" in line and "note" in line]
    assert len(wide) == 1
    depth = lines[wide[0]].index("FileScan")
    above = []
    for line in reversed(lines[: wide[0]]):
        at_ = len(line) - len(line.lstrip(" :+-*(0123456789)"))
        if at_ < depth:
            depth = at_
            above.append(line)
        if "Join" in line and line is above[-1]:
            break
    assert "Join" in above[-1] and not any("Exchange" in line for line in above)


def test_hot_key_with_most_delete_rows_is_split(spark, without_broadcasts):
    hot = F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("k"), (F.col("id") % 500).cast("string")))
    stamp = F.timestamp_add("SECOND", F.col("id"), F.lit("2024-01-01").cast("timestamp_ntz"))
    loaded = saved(spark, spark.range(0, 120_000, 1, 8).select(hot.alias(scd2.KEY), stamp.alias(scd2.UPDATED), stamp.alias(scd2.DELETED)))
    # the hot version starts late, so most of its delete rows precede it
    starts = F.when(F.col(scd2.KEY) == "HOT", F.max(scd2.UPDATED) - F.expr("interval 10 seconds")).otherwise(F.min(scd2.UPDATED))
    target = saved(spark, loaded.groupBy(scd2.KEY).agg(starts.alias("valid_from")).select(
        F.md5(scd2.KEY).alias(scd2.VERSION_KEY), scd2.KEY, "valid_from", F.lit(True).alias("is_current")))
    closing = scd2.closing_times(loaded, target)
    assert "SortMergeJoin(skew=true)" in final_plan(closing)
    expected = loaded.join(target, scd2.KEY).where(f"{scd2.DELETED} >= valid_from").groupBy(scd2.KEY).agg(F.min(scd2.DELETED))
    assert rows(closing.select(scd2.KEY, "_closed_after")) == rows(expected)


def test_store_path_may_hold_a_quote(spark):
    store = HistoryStore(spark, new_folder(spark, "it's"))
    store.load(feed(spark, ("A", 1, "a", 0, None)), SPEC)
    store.load(feed(spark, ("A", 1, "b", 1, None)), SPEC)
    assert len(short(store.read())) == 2


def test_a_store_without_buckets_gives_the_same_table(spark):
    changes = [("A", 1, "a", 0, None), ("A", 2, "b", 0, None)], [("A", 1, "c", 1, None), ("A", 2, "b", 2, 2)]
    tables = []
    for buckets in (0, 3):
        store = HistoryStore(spark, new_folder(spark, "buckets"), buckets)
        store.load(feed(spark, *changes[0]), SPEC)
        store.load(feed(spark, *changes[0], *changes[1]), SPEC)
        # another reader does not need to know the number of buckets
        tables.append(short(HistoryStore(spark, store.path).read()))
    assert tables[0] == tables[1] and len(tables[0]) == 3


def test_small_runs_leave_one_file_per_bucket_and_few_snapshots(spark):
    store = HistoryStore(spark, new_folder(spark, "small-runs"), 4)
    store.load(feed(spark, *[("A", i, "a", 0, None) for i in range(400)]), SPEC)
    for day in range(1, 12):
        store.load(feed(spark, *[("A", i, f"x{day}", day, None) for i in (day, day + 50)]), SPEC)
        assert len(store.files()) == 4
        there = set(matching_paths(spark, f"{store.path}/current/batch=*/_bucket=*/part-*"))
        kept = [store.commit(run) for run in store.runs()[-store.snapshots :]]
        assert len(there) == len({(b, r) for c in kept for b, r in c.current.items()})
        assert len(store.commit().closed) <= store.merge_after
    assert store.runs() == list(range(12)) and store.read_current().count() == 400
    assert store.read().count() == 400 + 22
    assert len(matching_paths(spark, f"{store.path}/runs/batch=*/is_current=false/_bucket=*/part-*")) <= 2 * 5


# --------------------------------------------------- copy on write, marks, filter


def test_one_changed_key_writes_one_file(spark):
    store = HistoryStore(spark, new_folder(spark, "one-key"), 200)
    first = [("A", i, "a", 0, None) for i in range(2000)]
    store.load(feed(spark, *first), SPEC)
    before = set(store.files())
    assert len(before) == 200
    store.load(feed(spark, *first, ("A", 77, "b", 1, None)), SPEC)
    written = matching_paths(spark, f"{store.path}/current/batch=000001/_bucket=*/part-*")
    assert len(written) == 1 and len(set(store.files()) - before) == 1 and len(set(store.files()) & before) == 199
    assert short(store.read().where("src_id = 'A_77'")) == [("A_77", "a", 0, 1, False), ("A_77", "b", 1, None, True)]
    assert store.read_current().count() == 2000
    # a run without a change writes no bucket
    store.load(feed(spark, *first), SPEC)
    assert matching_paths(spark, f"{store.path}/current/batch=000002/*") == [] and store.runs() == [0, 1, 2]


def test_a_reader_of_an_older_manifest_is_not_disturbed(spark):
    store = HistoryStore(spark, new_folder(spark, "readers"), 4)
    first = [("A", i, "a", 0, None) for i in range(40)]
    store.load(feed(spark, *first), SPEC)
    reading = store.read()
    store.load(feed(spark, *first, ("A", 1, "b", 1, None)), SPEC)
    store.load(feed(spark, *first, ("A", 2, "b", 2, None)), SPEC)
    assert reading.count() == 40 and reading.where("x = 'b'").count() == 0
    assert store.read().count() == 42


def test_another_number_of_buckets_deals_the_table_anew(spark):
    path = new_folder(spark, "deal")
    first = [("A", i, "a", 0, None) for i in range(60)]
    HistoryStore(spark, path, 4).load(feed(spark, *first), SPEC)
    HistoryStore(spark, path).load(feed(spark, *first, ("A", 1, "a", 1, 1)), SPEC)
    wider = HistoryStore(spark, path, 16)
    wider.load(feed(spark, *first, ("A", 1, "z", 2, None), ("A", 2, "b", 2, None)), SPEC)
    assert wider.commit().buckets == 16 and len(wider.files()) > 4
    assert short(wider.read().where("src_id in ('A_1', 'A_2')")) == [
        ("A_1", "a", 0, 1, False), ("A_2", "a", 0, 2, False), ("A_2", "b", 2, None, True)]
    wider.load(feed(spark, *first, ("A", 1, "y", 3, None), ("A", 2, "c", 3, None)), SPEC)
    assert wider.read_current().where("src_id = 'A_2'").first().x == "c" and wider.read_current().count() == 59


class Watched(HistoryStore):
    """A store that tells how its runs read the table."""

    def __init__(self, *args, **kw):
        super().__init__(*args, **kw)
        self.closed_reads, self.plans = [], []

    def _scan_closed(self, commit, only=None):
        self.closed_reads.append(only)
        return super()._scan_closed(commit, only)

    def _apply(self, last, delta, *more):
        self.plans.append(delta._jdf.queryExecution().executedPlan().toString())
        super()._apply(last, delta, *more)

    def _staged(self, rows, *more):
        self.plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return super()._staged(rows, *more)


def test_a_delta_reads_no_change_time_and_only_buckets_with_known_keys(spark):
    store = Watched(spark, new_folder(spark, "watched"), 50)
    first = [("A", i, "a", 0, 0 if i < 5 else None) for i in range(100)]
    seen = [*first, ("A", 50, "b", 1, None)]
    store.load(feed(spark, *first), SPEC)
    store.load(feed(spark, *seen), SPEC)  # closes keys 0 to 4
    assert store.read().where("not is_current").count() == 6
    store.closed_reads.clear()
    seen += [("A", i, "n", 2, None) for i in range(1000, 1020)]
    store.load(feed(spark, *seen), SPEC)
    hits = [len(only) for only in store.closed_reads if only is not None]
    assert None not in store.closed_reads and sum(hits) <= 2  # new keys: at most a false hit or two
    seen += [("A", 3, "again", 3, None), ("A", 2000, "new", 3, None)]
    store.closed_reads.clear()
    store.load(feed(spark, *seen), SPEC)
    assert [len(only) for only in store.closed_reads] in ([1], [2])
    assert short(store.read().where("src_id = 'A_3'")) == [("A_3", "a", 0, 0, False)]
    assert store.commit().marks == {"A": str(at(3))}
    # what finds the changes knows its limit; of the history it reads neither change times nor wide rows
    scans = [line for line in store.plans[-2].splitlines() if "FileScan" in line and "history_" in line]
    assert scans and all("_ab_cdc_updated_at" not in line and "note" not in line for line in scans)
    assert "Subquery" not in store.plans[-2] and "2024-01-03 00:00:00" in store.plans[-2]


@pytest.mark.parametrize("bits, merge_after", [(0, 2), (1, 3)])
def test_any_filter_gives_the_same_table(spark, bits, merge_after):
    """Without bits every bucket is looked up; few bits give false hits; many runs merge closed versions."""
    rng = random.Random(11)
    changes = []
    for day in rng.sample(range(200), 100):
        changes.append((rng.choice("AB"), rng.randrange(12), rng.choice("pqr"), day, day if rng.random() < 0.3 else None))
    store = HistoryStore(spark, new_folder(spark, "filters"), 4, filter_bits=bits, merge_after=merge_after)
    history = {}
    for limit in (40, 80, 120, 160, 200):
        seen = [c for c in changes if c[3] < limit]
        store.load(feed(spark, *seen), SPEC)
        history = replay(history, seen)
    assert short(store.read()) == sorted((tuple(v) for v in history.values()), key=repr)
    assert len(store.commit().closed) < 5


def test_key_filter_rules_out_what_it_does_not_hold(spark):
    keys = spark.range(30_000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"), (F.col("id") % 5).cast("int").alias("b"))
    pages = pages_for(30_000, 5, 12)
    parts = [filter_pages(keys.where(f"pmod(hash(key), 2) = {i}"), "key", "b", pages) for i in (0, 1)]
    filters = merged_pages(parts[0].unionByName(parts[1]), "b")
    assert filters.count() == 5 * pages
    assert perhaps(keys, "key", "b", filters, pages).count() == 30_000
    others = spark.range(30_000).select(F.concat(F.lit("other"), F.col("id").cast("string")).alias("key"), (F.col("id") % 5).cast("int").alias("b"))
    assert perhaps(others, "key", "b", filters, pages).count() < 300


# ------------------------------------------------------------- rows in any order


def stream_batches(spark, batches):
    store = HistoryStore(spark, new_folder(spark, "arrivals"), 2)
    options = scd2.Options(use_watermark=False)
    for number, batch in enumerate(batches):
        store.load(feed(spark, *batch), SPEC, options, token=str(number))
    return store


def open_keys(changes):
    """Keys that are current once all rows are there: newest row live, and no delete as new."""
    out = {}
    for key in {(s, i) for s, i, *_ in changes}:
        own = [c for c in changes if c[:2] == key]
        newest = max(own, key=lambda c: c[3])
        gone = max((max(c[3], c[4]) for c in own if c[4] is not None), default=-1)
        if newest[4] is None and gone < newest[3]:
            out["_".join(map(str, key))] = newest[2]
    return out


def test_delete_of_an_unknown_key_before_its_older_row(spark):
    store = stream_batches(spark, [[("A", 2, "b", 0, None)], [("A", 1, "x", 5, 5)], [("A", 1, "a", 3, None)], [("A", 2, "b", 4, None)],
                                   [("A", 2, "b", 2, 2)], [("A", 1, "again", 7, None)]])
    assert short(store.read()) == [("A_1", "again", 7, None, True), ("A_2", "b", 0, None, True)]


@pytest.mark.parametrize("seed", range(4))
def test_any_order_and_split_gives_the_same_current_versions(spark, seed):
    rng = random.Random(seed)
    changes = []
    for day in range(24):
        deleted = day if rng.random() < 0.35 else None
        changes.append(("A", rng.randrange(4), rng.choice("pq") if seed % 2 else f"v{day}", day, deleted))
    rng.shuffle(changes)
    cuts = sorted(rng.sample(range(1, 24), rng.choice([0, 2, 5])))
    batches = [changes[a:b] for a, b in zip([0, *cuts], [*cuts, 24], strict=True)]
    store = stream_batches(spark, batches)
    got = store.read_current().collect()
    assert {r.src_id: r.x for r in got} == open_keys(changes) and len(got) == len(open_keys(changes))
    versions = store.read()
    assert versions.where("not is_current and valid_to < valid_from").count() == 0
    assert versions.groupBy(scd2.VERSION_KEY).count().where("count > 1").count() == 0
    if not seed % 2:  # with other values in each row, the start is that of the newest row too
        whole = {r.src_id: r.valid_from for r in stream_batches(spark, [changes]).read_current().collect()}
        assert {r.src_id: r.valid_from for r in got} == whole
