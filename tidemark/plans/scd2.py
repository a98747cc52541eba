"""Slowly-changing dimension, type 2, from change-data-capture feeds.

A ``Spec`` says how the raw tables of several sources become one stream of
versions; ``collect``, ``initial`` and ``delta`` turn that into lazy plans.

The delta brings every side down to one row per key (newest change, first delete,
current version, old key), joins them once, and decides per key what is closed
and what is opened.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.keys import natural_key, surrogate_key
from ..operators.columns import quoted
from ..operators.lookups import as_of_join, value_spans
from ..operators.neighbours import default_ranges, ranged, with_neighbour
from ..operators.reshape import tie_breakers
from ..session import written

UPDATED = "_ab_cdc_updated_at"
DELETED = "_ab_cdc_deleted_at"
KEY = "src_id"
VERSION_KEY = "surrogate_key"

#: Changes of a lookup key that travel together, and the tasks that share the rows of a key.
_BLOCK, _DEALS = 64, 8


@dataclass(frozen=True)
class Remap:
    """Codes one source spells differently; others move by ``shift``."""

    codes: Mapping[int, int]
    shift: int = 0

    def apply(self, column: Column) -> Column:
        other = column + self.shift if self.shift else column
        chain = F
        for old, new in self.codes.items():
            chain = chain.when(column == old, F.lit(new))
        return chain.otherwise(other)


@dataclass(frozen=True)
class Lookup:
    """A column fetched per source: raw ``on`` -> ``<src>_<entity>.key`` -> ``value``."""

    entity: str
    on: str
    key: str
    value: str


@dataclass(frozen=True)
class Spec:
    """One history table.

    columns       output name -> raw name, in output order
    foreign_keys  output names turned into ``<src>_<id>`` text, given as
                  {output name: name of the column that holds the plain id}
    tracked       columns whose change opens a new version
    remaps        {source: {output name: Remap}}
    """

    name: str
    entity: str
    sources: Sequence[str]
    id_column: str
    columns: Mapping[str, str]
    tracked: Sequence[str]
    foreign_keys: Mapping[str, str] = field(default_factory=dict)
    remaps: Mapping[str, Mapping[str, Remap]] = field(default_factory=dict)
    lookups: Mapping[str, Lookup] = field(default_factory=dict)

    @property
    def business_columns(self) -> list[str]:
        """The columns between the key and the source tag, foreign keys in place."""
        keyed = {plain: name for name, plain in self.foreign_keys.items()}
        return [keyed.get(c, c) for c in self.columns]


@dataclass(frozen=True)
class Options:
    """Deliberate departures from the default behaviour.

    use_watermark            False: take every given row as fresh (stream batches) and
                             ignore those older than the version they meet
    watermark_per_source     one limit per source, so a late source is not skipped
    skip_deleted_on_initial  no current versions for keys already deleted
    delete_wins              a key changed and deleted in one run stays closed
    reopen_deleted           a closed key seen again gets a new version
    delete_from_latest_only  a delete row followed by a live row closes nothing
    """

    use_watermark: bool = True
    skip_deleted_on_initial: bool = False
    delete_wins: bool = False
    reopen_deleted: bool = False
    watermark_per_source: bool = False
    delete_from_latest_only: bool = False


DEFAULTS = Options()


# ---------------------------------------------------------------- collecting


def collect(spec: Spec, read: Callable[[str], DataFrame]) -> DataFrame:
    """All sources under one schema, with ``src`` and both change times.

    ``read`` maps a raw table name (``<src>_<entity>``) to a DataFrame.
    """

    def one(source: str) -> DataFrame:
        rows = read(f"{source.lower()}_{spec.entity}")
        fetched = {}
        for output, lookup in spec.lookups.items():
            other = read(f"{source.lower()}_{lookup.entity}").select(
                F.col(quoted(lookup.key)).alias(f"_{output}_key"),
                F.col(quoted(lookup.value)).alias(f"_{output}"),
            )
            rows = rows.join(other, F.col(quoted(lookup.on)) == F.col(f"_{output}_key"), "left")
            fetched[output] = F.col(f"_{output}")
        remaps = spec.remaps.get(source, {})

        def value(output: str, raw: str) -> Column:
            column = fetched.get(output, F.col(quoted(raw)))
            return remaps[output].apply(column) if output in remaps else column

        return rows.select(
            *[value(output, raw).alias(output) for output, raw in spec.columns.items()],
            F.lit(source).alias("src"),
            F.col(UPDATED).cast("timestamp_ntz").alias(UPDATED),
            F.col(DELETED).cast("timestamp_ntz").alias(DELETED),
        )

    return reduce(DataFrame.unionByName, [one(s) for s in spec.sources])


def collect_following(
    spec: Spec, read: Callable[[str], DataFrame], loads: Sequence[Column] | None = None, keyed: bool = False
) -> DataFrame:
    """``collect`` where a changed lookup value changes the rows that use it.

    The raw lookup tables carry change times and may hold several states of a
    key. A row gets the values as of its own change time. While it is the newest
    of its id and not deleted, every change of a value it uses adds a copy of it,
    changed at the time of the lookup's row, with the values as of then; the delta
    makes a new version of it, like of any change. Deleted lookup rows keep their
    value. A row of unknown time, and one that such a row
    follows, get no copies, since nobody knows how long they were the newest.

    The copies are found by joins on source and lookup key, with the change times
    as a range condition. When the values held is written once; a limit on the change
    time reaches the raw rows that are not copied. With ``keyed`` the natural key is
    made for a row before it is copied, and ``with_keys`` takes it as it is.

    All copies are as many as rows times changes of their lookup. A load takes the
    newest row of a key only, so histories need fewer: ``loads`` are the rising times
    that loads end before, followed by one of everything. Then each lookup adds to a row
    its last copy before each of these times and its last of all, and there
    are at most as many copies as rows for every load and lookup.
    """
    used = {output: f"_on_{output}" for output in spec.lookups}
    spans = {output: written(_lookup_spans(spec, read, output), "spans") for output in spec.lookups}

    def one(source: str) -> DataFrame:
        remaps = spec.remaps.get(source, {})
        columns = [
            (remaps[output].apply(F.col(quoted(raw))) if output in remaps else F.col(quoted(raw))).alias(output)
            for output, raw in spec.columns.items()
            if output not in spec.lookups
        ]
        return read(f"{source.lower()}_{spec.entity}").select(
            *columns,
            F.lit(source).alias("src"),
            F.col(UPDATED).cast("timestamp_ntz").alias(UPDATED),
            F.col(DELETED).cast("timestamp_ntz").alias(DELETED),
            *[F.col(quoted(spec.lookups[output].on)).alias(name) for output, name in used.items()],
        )

    rows = reduce(DataFrame.unionByName, [one(s) for s in spec.sources])
    # of rows of one id and time, the one that latest_per_key prefers comes last
    order = [
        F.col(quoted(f.name)).desc_nulls_first() for f in rows.schema.fields if f.name not in (spec.id_column, UPDATED)
    ]
    if keyed:
        rows = rows.withColumn(KEY, natural_key("src", quoted(spec.id_column)))
    followed = with_neighbour(
        rows, UPDATED, ["src", spec.id_column], "next", "_next", missing="_last", then_by=order
    ).where(F.col(DELETED).isNull() & F.col(UPDATED).isNotNull() & (F.col("_last") | F.col("_next").isNotNull()))

    def as_then(moments: DataFrame, outputs) -> DataFrame:
        for output in outputs:
            on = {"src": "src", used[output]: "_key"}
            moments = as_of_join(moments, spans[output], on, UPDATED, {output: "_value"}, "_since", "_until")
        return moments

    moments = as_then(rows, used)
    for output, name in used.items():
        if loads is None:
            copies = _all_copies(followed, spans[output], name, output)
        else:
            copies = _last_copies(followed, spans[output], name, output, loads)
        # a copy has the value it is made for, so that only other values have to be joined to it
        copies = copies.select(*rows.columns, quoted(output))
        moments = moments.unionByName(as_then(copies, [o for o in used if o != output]))
    keys = [KEY] if keyed else []
    return moments.select(*keys, *[F.col(quoted(c)) for c in spec.columns], "src", UPDATED, DELETED)


def _all_copies(followed: DataFrame, spans: DataFrame, on: str, output: str) -> DataFrame:
    """A copy for every change of a row's value while it was the newest.

    There may be far more copies than rows and changes, so the changes of a key travel in blocks. A row is
    held against the ends of blocks, and only blocks that meet its time are taken apart. The work
    is in the copies, not in the bytes shuffled for them, so the rows of a key are dealt to several
    tasks, and the number of tasks does not follow the bytes.
    """
    deal = F.pmod(F.hash(*[F.col(quoted(c)) for c in followed.columns if c not in ("src", on)]), F.lit(_DEALS))
    dealt = followed.withColumn("_deal", deal).repartition(default_ranges(followed), "src", on, "_deal")
    blocks = _span_blocks(spans).withColumn("_to", F.explode(F.sequence(F.lit(0), F.lit(_DEALS - 1))))
    alike = (F.col("src") == F.col("_src")) & (F.col(on) == F.col("_key")) & (F.col("_deal") == F.col("_to"))
    meets = (F.col("_end") > F.col(UPDATED)) & (F.col("_last") | (F.col("_begin") < F.col("_next")))
    met = dealt.join(blocks, alike & meets)
    taken = met.select(*[F.col(quoted(c)) for c in followed.columns], "_values", F.posexplode("_times").alias("_at", "_since"))
    copies = taken.where((F.col("_since") > F.col(UPDATED)) & (F.col("_last") | (F.col("_since") < F.col("_next"))))
    return copies.withColumns({output: F.get("_values", F.col("_at")), UPDATED: F.col("_since")})


def _span_blocks(spans: DataFrame) -> DataFrame:
    """The changes of a key in blocks of times and values: (_src, _key, _begin, _end, _times, _values)."""
    cut = ranged(spans, "_since", default_ranges(spans), "_range")
    place = F.row_number().over(Window.partitionBy("src", "_key", "_range").orderBy("_since"))
    changes = F.sort_array(F.collect_list(F.struct("_since", "_value"))).alias("_changes")
    blocks = cut.withColumn("_block", F.floor((place - 1) / _BLOCK)).groupBy("src", "_key", "_range", "_block").agg(
        F.min("_since").alias("_begin"), F.max("_since").alias("_end"), changes
    )
    times, values = F.col("_changes._since").alias("_times"), F.col("_changes._value").alias("_values")
    return blocks.select(F.col("src").alias("_src"), "_key", "_begin", "_end", times, values)


def _last_copies(followed: DataFrame, spans: DataFrame, on: str, output: str, loads: Sequence[Column]) -> DataFrame:
    """Of these, the last before each of the given times, and the last of all."""
    # times have microseconds: the span that holds just before an end began before it
    ends = F.array(*[F.least("_next", time) for time in loads], F.col("_next"))
    asked = followed.withColumn("_at", F.explode(F.array_distinct(ends)))
    asked = asked.withColumn("_at", F.col("_at") - F.expr("interval 1 microsecond"))
    asked = asked.where(F.col("_at").isNull() | (F.col("_at") > F.col(UPDATED)))
    values = {"_changed": "_since", output: "_value"}
    found = as_of_join(asked, spans, {"src": "src", on: "_key"}, "_at", values, "_since", "_until")
    return found.where(F.col("_changed") > F.col(UPDATED)).withColumn(UPDATED, F.col("_changed"))


def _lookup_spans(spec: Spec, read: Callable[[str], DataFrame], output: str) -> DataFrame:
    """(src, _key, _value, _since, _until) of one lookup over all sources."""
    lookup = spec.lookups[output]

    def one(source: str) -> DataFrame:
        remap = spec.remaps.get(source, {}).get(output)
        value = F.col(quoted(lookup.value))
        return read(f"{source.lower()}_{lookup.entity}").select(
            F.lit(source).alias("src"),
            F.col(quoted(lookup.key)).alias("_key"),
            (remap.apply(value) if remap else value).alias("_value"),
            F.col(UPDATED).cast("timestamp_ntz").alias("_since"),
        )

    states = reduce(DataFrame.unionByName, [one(s) for s in spec.sources])
    return value_spans(states, ["src", "_key"], "_since", ["_value"], "_until")


def with_keys(collected: DataFrame, spec: Spec) -> DataFrame:
    """Add the natural key, unless the rows have it, and turn plain ids into foreign keys."""
    keyed = {plain: name for name, plain in spec.foreign_keys.items()}
    business = [
        natural_key("src", quoted(c)).alias(keyed[c]) if c in keyed else F.col(quoted(c))
        for c in spec.columns
    ]
    key = F.col(KEY) if KEY in collected.columns else natural_key("src", quoted(spec.id_column)).alias(KEY)
    return collected.select(key, *business, "src", UPDATED, DELETED)


def null_key_rows(rows: DataFrame) -> DataFrame:
    """Rows without an id. They can match nothing, so they are kept out of the history."""
    return rows.where(F.col(KEY).isNull())


def latest_per_key(rows: DataFrame) -> DataFrame:
    """The newest row per key; an unknown change time counts as newest.

    The ranking keeps one row per key in every task before the shuffle.
    """
    newest = Window.partitionBy(KEY).orderBy(
        F.col(UPDATED).desc_nulls_first(), *tie_breakers(rows, (KEY, UPDATED))
    )
    return rows.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")


# ------------------------------------------------------------------ versions


def _opened(spec: Spec) -> list[Column]:
    """A new current version made from a change row."""
    return [
        surrogate_key(KEY, UPDATED).alias(VERSION_KEY),
        F.col(KEY),
        *[F.col(quoted(c)) for c in spec.business_columns],
        F.col("src"),
        F.col(UPDATED),
        F.col(UPDATED).alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        F.lit(True).alias("is_current"),
    ]


def version_columns(spec: Spec) -> list[str]:
    return [
        VERSION_KEY, KEY, *spec.business_columns, "src", UPDATED,
        "valid_from", "valid_to", "is_current",
    ]


def initial(rows: DataFrame, spec: Spec, options: Options = DEFAULTS) -> DataFrame:
    """First load: the newest row of every key is current, deleted ones included."""
    newest = latest_per_key(rows.where(F.col(KEY).isNotNull()))
    if options.skip_deleted_on_initial:
        newest = newest.where(F.col(DELETED).isNull())
    return newest.select(*_opened(spec))


def high_water_marks(versions: DataFrame) -> dict[str, str]:
    """The newest change time of each source, as text; sources whose times are all unknown are left out."""
    found = versions.groupBy("src").agg(F.max(UPDATED).cast("string").alias("mark")).collect()
    return {r["src"] or "": r["mark"] for r in found if r["mark"] is not None}


def newer_than_marks(
    rows: DataFrame, marks: Mapping[str, str], per_source: Sequence[str] = ()
) -> DataFrame:
    """``newer_than_target`` for a target whose newest change times are known."""
    passed = {source: F.col(UPDATED) > F.lit(mark).cast("timestamp_ntz") for source, mark in marks.items()}
    if not per_source:
        newest = max(marks, key=marks.get, default=None)
        return rows.where(F.lit(False) if newest is None else passed[newest])
    fresh = F.lit(True)
    for source in per_source:
        if source in passed:
            fresh = F.when(F.col("src") == source, passed[source]).otherwise(fresh)
    return rows.where(fresh)


def newer_than_target(
    rows: DataFrame, target: DataFrame, per_source: Sequence[str] = ()
) -> DataFrame:
    """Rows past the newest change time in the target (none if the target is empty).

    The limit is a scalar subquery: computed once and pushed into the scans.
    With ``per_source``, each named source has a limit of its own, and a source
    the target does not know has none.
    """
    if not per_source:
        return rows.where(F.col(UPDATED) > target.agg(F.max(UPDATED)).scalar())
    # at most one row per named source, so its size is known before it is broadcast
    known = target.where(F.col("src").isin(list(per_source)))
    seen = known.groupBy("src").agg(F.max(UPDATED).alias("_seen"))
    joined = rows.join(F.broadcast(seen), "src", "left")
    fresh = F.col("_seen").isNull() | (F.col(UPDATED) > F.col("_seen"))
    return joined.where(fresh).select(*rows.columns)


def closing_times(
    rows: DataFrame, target: DataFrame, options: Options = DEFAULTS
) -> DataFrame:
    """(src_id, _closed_after, _closed_any) for current keys that have a delete row.

    ``_closed_after`` is the first delete at or after the version's start. Where
    all deletes precede it the key is closed as well, at ``_closed_any``, the
    last of them. ``delete_from_latest_only`` looks at newest rows only.
    """
    known = rows.where(F.col(KEY).isNotNull())
    if options.delete_from_latest_only:
        known = latest_per_key(known)
    # This is the one join where a key may be hot: it can have any number of delete
    # rows. Spark splits a skewed join if both sides are exchanged and nothing later
    # relies on its partitioning. So the join key is a struct, which a target
    # bucketed by key has to exchange too (three narrow columns), and the groups,
    # another struct, get an exchange of their own after partial aggregation.
    key = F.struct(KEY).alias("_key")
    deletes = known.where(F.col(DELETED).isNotNull()).select(key, DELETED)
    current = target.where("is_current").select(
        key, F.struct(KEY, VERSION_KEY).alias("_version"), "valid_from"
    )
    return (
        deletes.join(current, "_key")
        .groupBy("_version")
        .agg(
            F.min(F.when(F.col(DELETED) >= F.col("valid_from"), F.col(DELETED))).alias("_closed_after"),
            F.max(DELETED).alias("_closed_any"),
        )
        .select(F.col(f"_version.{KEY}").alias(KEY), "_closed_after", "_closed_any")
    )


def changes(
    rows: DataFrame, target: DataFrame, spec: Spec, options: Options = DEFAULTS
) -> DataFrame:
    """Per touched key: the new row ``s``, the current version ``t`` and what follows.

    Flags: is_new, is_changed, is_deleted, is_reopened. Each side of the joins
    has one row per key, so no key can be hot; the target is read in two disjoint
    parts, the current versions and the bare keys of the closed ones. A column
    the target does not have yet counts as null there.
    """
    valid = rows.where(F.col(KEY).isNotNull())
    if options.use_watermark:
        own_limits = spec.sources if options.watermark_per_source else ()
        fresh = newer_than_target(valid, target, own_limits)
    else:
        fresh = valid
    return decided(
        touching_keys(fresh, closing_times(rows, target, options)),
        target.where("is_current"),
        target.where(~F.col("is_current")).select(KEY).distinct(),
        spec,
        options,
    )


def touching_keys(fresh: DataFrame, closing: DataFrame) -> DataFrame:
    """One row per key that a run may change: its newest fresh row ``s`` and what ``closing_times`` gives."""
    batch = latest_per_key(fresh)
    return batch.select(KEY, F.struct(*batch.columns).alias("s")).join(closing, KEY, "full")


def decided(
    touching: DataFrame,
    current: DataFrame,
    old_keys: DataFrame,
    spec: Spec,
    options: Options = DEFAULTS,
) -> DataFrame:
    """``changes`` from its parts, each of which has one row per key.

    touching  what ``touching_keys`` gives
    current   the current versions, at least those of the touching keys
    old_keys  keys with closed versions, at least those of the fresh rows that have some
    """
    versions = _packed_versions(current, touching.schema["s"].dataType, spec)
    known = old_keys.select(KEY).withColumn("_old", F.lit(True))
    joined = touching.join(versions, KEY, "left").join(known, KEY, "left")

    has_row, alive = F.col("s").isNotNull(), F.col(f"s.{DELETED}").isNull()
    is_open = F.col("t").isNotNull()
    in_target = is_open | F.col("_old").isNotNull()
    differs = _differs(spec)
    is_deleted = is_open & F.col("_closed_any").isNotNull()
    if not options.use_watermark:
        older = F.col(f"s.{UPDATED}") <= F.col(f"t.{UPDATED}")
        differs = differs & ~F.coalesce(older, F.lit(False))
        is_deleted = is_open & F.col("_closed_after").isNotNull()
    return joined.withColumns(
        {
            "is_new": has_row & ~in_target & alive,
            "is_changed": has_row & is_open & differs,
            "is_deleted": is_deleted,
            "is_reopened": F.lit(options.reopen_deleted) & has_row & in_target & ~is_open & alive,
        }
    )


def _packed_versions(current: DataFrame, fresh: StructType, spec: Spec) -> DataFrame:
    """Key and version ``t``; a column that the versions do not have yet counts as null."""
    added = {
        c: F.lit(None).cast(fresh[c].dataType)
        for c in spec.business_columns
        if c not in current.columns
    }
    return current.withColumns(added).select(KEY, F.struct(*version_columns(spec)).alias("t"))


def _differs(spec: Spec) -> Column:
    """Whether a tracked column of the new row differs from the version's."""
    return reduce(
        lambda a, b: a | b,
        [~F.col(f"s.{quoted(c)}").eqNullSafe(F.col(f"t.{quoted(c)}")) for c in spec.tracked],
    )


# ------------------------------------------------------------ rows in any order

#: What a stream remembers of a key beside its versions.
SEEN, GONE = "seen", "gone"
SIGHTINGS = f"{KEY} string, {SEEN} timestamp_ntz, {GONE} timestamp_ntz"


def arrivals(
    rows: DataFrame, current: DataFrame, sightings: DataFrame, closed_ends: DataFrame, spec: Spec
) -> DataFrame:
    """Per key of ``rows``: new row ``s``, version ``t``, and what follows from all rows so far.

    Rows may come in any order and split into batches in any way: a key is current
    if its newest row is live and no delete so far is as new, whichever came first.
    ``sightings`` has per key the last delete (``gone``), known before or
    after the rows it concerns, and the newest live row that opened no version
    because nothing tracked differed (``seen``). ``closed_ends`` has the last
    ``gone`` of keys closed by other loads. Flags: closes, opens, is_changed.
    The new values of seen and gone, null where they are to stay, are
    ``_seen_now`` and ``_gone_now``.
    """
    valid = rows.where(F.col(KEY).isNotNull())
    newest = latest_per_key(valid)
    # a delete counts from its own time or its row's change time, whichever is later
    left = F.when(F.col(DELETED).isNotNull(), F.greatest(DELETED, UPDATED))
    leaving = valid.groupBy(KEY).agg(F.max(left).alias("_gone_now"))
    before = sightings.select(KEY, F.col(SEEN).alias("_seen"), F.col(GONE).alias("_gone"))
    ends = closed_ends.select(KEY, F.col(GONE).alias("_end"))
    versions = _packed_versions(current, newest.schema, spec)
    # deletes close a version from its start, or from its last sighting, on
    since = current.join(before, KEY, "left").withColumn("valid_from", F.greatest("valid_from", "_seen"))
    closing = closing_times(valid, since.withColumn("is_current", F.lit(True)))
    joined = (
        newest.select(KEY, F.struct(*newest.columns).alias("s"))
        .join(leaving, KEY)
        .join(versions, KEY, "left")
        .join(closing, KEY, "left")
        .join(before, KEY, "left")
        .join(ends, KEY, "left")
    )
    updated = F.col(f"s.{UPDATED}")
    is_open = F.col("t").isNotNull()
    alive = F.col(f"s.{DELETED}").isNull()
    known = F.greatest(F.col(f"t.{UPDATED}"), F.col("_seen"))
    gone = F.greatest("_gone", "_gone_now", F.when(~is_open, F.col("_end")))
    fresh = ~is_open | ~F.coalesce(updated <= known, F.lit(False))
    is_changed = is_open & fresh & (_differs(spec) | ~alive)
    is_deleted = is_open & F.coalesce(F.col("_gone_now") >= known, F.lit(False))
    survives = gone.isNull() | F.coalesce(gone < updated, F.lit(False))
    opens = alive & fresh & survives & (~is_open | is_changed | is_deleted)
    sighted = is_open & alive & fresh & ~is_changed & ~is_deleted
    return joined.withColumns(
        {
            "is_changed": is_changed,
            "closes": is_changed | is_deleted,
            "opens": opens,
            "_closed_any": F.coalesce("_closed_any", "_gone_now"),
            "_seen_now": F.when(sighted, updated),
        }
    )


def arrived(found: DataFrame, spec: Spec) -> DataFrame:
    """The versions that ``arrivals`` close and open."""
    out = F.array(
        F.when(F.col("closes"), _closed(spec, end_of_version())),
        F.when(F.col("opens"), _inserted(spec)),
    )
    return _unpacked(found, out, spec)


def is_sighted() -> Column:
    """Whether ``arrivals`` add something to the sightings of a key."""
    return F.col("_seen_now").isNotNull() | F.col("_gone_now").isNotNull()


def sighting() -> list[Column]:
    """What they add."""
    return [F.col(KEY), F.col("_seen_now").alias(SEEN), F.col("_gone_now").alias(GONE)]


def _closed(spec: Spec, valid_to: Column) -> Column:
    """The known version with its end set."""
    kept = [c for c in version_columns(spec) if c not in ("valid_to", "is_current")]
    return F.struct(
        *[F.col(f"t.{quoted(c)}").alias(c) for c in kept],
        valid_to.alias("valid_to"),
        F.lit(False).alias("is_current"),
    )


def _inserted(spec: Spec) -> Column:
    row = [F.col(f"s.{quoted(c)}").alias(c) for c in (KEY, *spec.business_columns, "src", UPDATED)]
    return F.struct(
        surrogate_key(F.col(f"s.{KEY}"), F.col(f"s.{UPDATED}")).alias(VERSION_KEY),
        *row,
        F.col(f"s.{UPDATED}").alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


def end_of_version() -> Column:
    """When a key's current version ends.

    A change ends it at the new row's time, or at an earlier delete that lies
    inside its validity; without a change, the delete alone decides.
    """
    updated = F.col(f"s.{UPDATED}")
    return F.when(F.col("is_changed"), F.least(updated, F.col("_closed_after"))).otherwise(
        F.coalesce(F.col("_closed_after"), F.col("_closed_any"))
    )


def delta(
    rows: DataFrame, target: DataFrame, spec: Spec, options: Options = DEFAULTS
) -> DataFrame:
    """Closed and newly opened versions, one row per version key.

    ``rows`` is the keyed collect of all sources. Both kinds come out of one
    pass over the joined changes.
    """
    return delta_of(changes(rows, target, spec, options), spec, options)


def delta_of(decided: DataFrame, spec: Spec, options: Options = DEFAULTS) -> DataFrame:
    """What ``changes`` or ``decided`` close and open."""
    closes = F.col("is_changed") | F.col("is_deleted")
    opens = F.col("is_new") | F.col("is_changed") | F.col("is_reopened")
    if options.delete_wins:
        # a key deleted at or after its new row's time stays closed
        gone = F.col(f"s.{DELETED}").isNotNull() | (
            F.col("_closed_any") >= F.col(f"s.{UPDATED}")
        )
        opens = opens & ~F.coalesce(gone, F.lit(False))
    out = F.array(
        F.when(closes, _closed(spec, end_of_version())),
        F.when(opens, _inserted(spec)),
    )
    return _unpacked(decided, out, spec)


def _unpacked(found: DataFrame, out: Column, spec: Spec) -> DataFrame:
    """The versions in ``out``. The key stays the column it was, so that rows dealt by it need not be dealt again."""
    # nulls go after the explode: a filter inside the array would be interpreted for each row
    versions = found.select(KEY, F.explode(out).alias("_version")).where(F.col("_version").isNotNull())
    return versions.select(
        *[F.col(c) if c == KEY else F.col(f"_version.{quoted(c)}").alias(c) for c in version_columns(spec)]
    )


# --------------------------------------------- the delta's parts, on their own


def expired(rows, target, spec, options: Options = DEFAULTS) -> DataFrame:
    """Current versions ended by a changed row."""
    found = changes(rows, target, spec, options).where("is_changed")
    return found.select(F.inline(F.array(_closed(spec, F.col(f"s.{UPDATED}")))))


def deleted(rows, target, spec, options: Options = DEFAULTS) -> DataFrame:
    """Current versions ended by a delete row."""
    found = changes(rows, target, spec, options).where("is_deleted")
    end = F.coalesce(F.col("_closed_after"), F.col("_closed_any"))
    return found.select(F.inline(F.array(_closed(spec, end))))


def changed(rows, target, spec, options: Options = DEFAULTS) -> DataFrame:
    """New rows whose tracked columns differ from the current version."""
    return changes(rows, target, spec, options).where("is_changed").select("s.*")


def new(rows, target, spec, options: Options = DEFAULTS) -> DataFrame:
    """New rows of keys the target has never held, unless already deleted."""
    return changes(rows, target, spec, options).where("is_new").select("s.*")


def inserts(rows, target, spec, options: Options = DEFAULTS) -> DataFrame:
    """The versions opened by the delta."""
    found = changes(rows, target, spec, options).where("is_new or is_changed or is_reopened")
    return found.select(F.inline(F.array(_inserted(spec))))
