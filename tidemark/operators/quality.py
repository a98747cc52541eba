"""Data-quality tests. Each returns the failing rows, or one row with a failure count.

Tests that only need one aggregate over a table can be bundled with ``Suite``,
which computes all of them in a single pass.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import as_timestamp, dateadd, moment
from ..functions.text import slugify
from ..session import written
from .columns import quoted
from .neighbours import default_ranges, largest_group, ranged, with_neighbour
from .sets import replicate, tagged_counts


def _expression(value: str | Column) -> Column:
    """A Column, or SQL text such as a column name or ``coalesce(valid_to, ...)``."""
    return F.expr(value) if isinstance(value, str) else value


def _filtered(df: DataFrame, where) -> DataFrame:
    return df if where is None else df.where(where)


def _one_row_counts(a: DataFrame, b: DataFrame, name_a: str, name_b: str) -> DataFrame:
    """Both row counts side by side; each input is one aggregated row."""
    count_a = a.agg(F.count(F.lit(1)).alias(name_a))
    count_b = b.agg(F.count(F.lit(1)).alias(name_b))
    return count_a.select(name_a, count_b.scalar().alias(name_b))


def equal_rowcount(model: DataFrame, compare_model: DataFrame) -> DataFrame:
    counts = _one_row_counts(model, compare_model, "count_a", "count_b")
    return counts.withColumn("diff_count", F.abs(F.col("count_a") - F.col("count_b")))


def fewer_rows_than(model: DataFrame, compare_model: DataFrame) -> DataFrame:
    """Fails by the surplus, or by 1 when both have the same number of rows."""
    counts = _one_row_counts(model, compare_model, "count_our_model", "count_comparison_model")
    surplus = F.col("count_our_model") - F.col("count_comparison_model")
    delta = F.when(surplus == 0, F.lit(1)).otherwise(F.greatest(surplus, F.lit(0)))
    return counts.withColumn("row_count_delta", delta.cast("long"))


def equality(
    model: DataFrame,
    compare_model: DataFrame,
    compare_columns: Sequence[str] | None = None,
    multiset: bool = False,
) -> DataFrame:
    """Distinct rows found on one side only, tagged ``which_diff``.

    ``multiset=True`` also reports rows whose number of copies differs, as many
    times as there are surplus copies.
    """
    both = tagged_counts(model, compare_model, compare_columns)
    if multiset:
        surplus = F.col("_count_a") - F.col("_count_b")
        rows = both.where(surplus != 0).withColumn("_copies", F.abs(surplus))
        only_a = surplus > 0
    else:
        rows = both.where("_count_a = 0 or _count_b = 0")
        only_a = F.col("_count_b") == 0
    side = F.when(only_a, F.lit("a_minus_b")).otherwise(F.lit("b_minus_a"))
    columns = [quoted(c) for c in (compare_columns or model.columns)]
    if not multiset:
        return rows.select(side.alias("which_diff"), *columns)
    return replicate(rows.select(side.alias("which_diff"), *columns, "_copies"), "_copies")


def equality_failures(differences: DataFrame) -> DataFrame:
    """The failure number of ``equality``: rows, plus the imbalance of both sides."""
    a = F.count_if(F.col("which_diff") == "a_minus_b")
    b = F.count_if(F.col("which_diff") == "b_minus_a")
    return differences.agg((a + b + F.abs(a - b)).alias("failures"))


def expression_is_true(
    model: DataFrame, expression: str | Column, column_name: str | None = None, condition=None
) -> DataFrame:
    """Rows for which the expression is false; unknown passes.

    With ``column_name``, the expression is the text that follows the column.
    """
    if column_name is not None:
        expression = f"{quoted(column_name)} {expression}"
    return _filtered(model, condition).where(~_expression(expression))


def recency(model: DataFrame, field: str, datepart: str, interval: int, now=None) -> DataFrame:
    """One row when the newest value is older than ``now`` minus the interval."""
    now = F.localtimestamp() if now is None else moment(now)
    threshold = dateadd(datepart, -interval, now)
    newest = model.agg(F.max(field).alias("most_recent"))
    return newest.withColumn("threshold", threshold).where("most_recent < threshold")


def at_least_one(model: DataFrame, column_name: str) -> DataFrame:
    values = model.agg(F.count(column_name).alias("filled"))
    return values.where("filled = 0")


def not_constant(model: DataFrame, column_name: str) -> DataFrame:
    """Fails when exactly one distinct value exists; needs no shuffle of the values."""
    ends = model.agg(F.min(column_name).alias("lowest"), F.max(column_name).alias("highest"))
    return ends.where("lowest = highest")


def cardinality_equality(
    model: DataFrame, column_name: str, to: DataFrame, field: str
) -> DataFrame:
    """Values whose number of rows differs, once per side that has them."""
    both = tagged_counts(
        model.select(F.col(column_name).alias(column_name)),
        to.select(F.col(field).alias(column_name)),
    )
    sides = F.array("_count_a", "_count_b")
    return (
        both.where("_count_a <> _count_b")
        .select(quoted(column_name), F.explode(sides).alias("num_rows"))
        .where("num_rows > 0")
    )


def not_null(model: DataFrame, column_name: str, where=None) -> DataFrame:
    return _filtered(model, where).where(F.col(column_name).isNull())


def unique(model: DataFrame, column_name: str, where=None) -> DataFrame:
    """Non-null values that occur more than once, with their count."""
    return (
        _filtered(model, where)
        .where(F.col(column_name).isNotNull())
        .groupBy(F.col(column_name).alias("unique_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where("n_records > 1")
    )


def unique_where(model: DataFrame, column_name: str, where) -> DataFrame:
    return unique(model, column_name, where)


def not_null_where(model: DataFrame, column_name: str, where) -> DataFrame:
    return not_null(model, column_name, where)


def not_null_proportion(
    model: DataFrame, column_name: str, at_least: float, at_most: float = 1.0
) -> DataFrame:
    share = model.agg(
        F.avg(F.col(column_name).isNotNull().cast("int")).alias("not_null_proportion")
    )
    return share.where(
        (F.col("not_null_proportion") < at_least) | (F.col("not_null_proportion") > at_most)
    )


def accepted_values(model: DataFrame, column_name: str, values: Sequence) -> DataFrame:
    """Values outside the list, with their count; null passes."""
    return (
        model.groupBy(F.col(column_name).alias("value_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where(~F.col("value_field").isin(list(values)))
    )


def not_accepted_values(model: DataFrame, column_name: str, values: Sequence) -> DataFrame:
    """Forbidden values that do occur, once each."""
    return (
        model.where(F.col(column_name).isin(list(values)))
        .select(F.col(column_name).alias("value_field"))
        .distinct()
    )


def relationships(
    model: DataFrame,
    column_name: str,
    to: DataFrame,
    field: str,
    from_condition=None,
    to_condition=None,
) -> DataFrame:
    """Non-null keys without a parent: one row (id, null) per offending row.

    Children are counted per key first, so a hot key is one row in the join.
    """
    children = (
        _filtered(model, from_condition)
        .where(F.col(column_name).isNotNull())
        .groupBy(F.col(column_name).alias("id"))
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    parents = _filtered(to, to_condition).select(F.col(field).alias("id"))
    orphans = children.join(parents, "id", "left_anti")
    missing = F.lit(None).cast(parents.schema["id"].dataType).alias("right_id")
    return replicate(orphans, "_rows").select("id", missing)


def relationships_where(
    model: DataFrame, column_name: str, to: DataFrame, field: str,
    from_condition=None, to_condition=None,
) -> DataFrame:
    return relationships(model, column_name, to, field, from_condition, to_condition)


def unique_combination_of_columns(model: DataFrame, combination: Sequence[str]) -> DataFrame:
    """Combinations held by several rows; nulls count as equal."""
    return (
        model.groupBy(*[quoted(c) for c in combination])
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where("n_records > 1")
        .drop("n_records")
    )


def accepted_range(
    model: DataFrame, column_name: str, min_value=None, max_value=None, inclusive: bool = True
) -> DataFrame:
    """Rows outside the range; null passes. Bounds are literals or Columns."""
    if min_value is None and max_value is None:
        raise ValueError("give min_value, max_value or both")
    value, broken = F.col(column_name), []
    if min_value is not None:
        broken.append(value < min_value if inclusive else value <= min_value)
    if max_value is not None:
        broken.append(value > max_value if inclusive else value >= max_value)
    return model.where(reduce(lambda a, b: a | b, broken))


def not_empty_string(model: DataFrame, column_name: str) -> DataFrame:
    return model.where(F.col(column_name) == "")


def assert_equal(model: DataFrame, actual: str, expected: str) -> DataFrame:
    """Rows where both sides are known and differ."""
    return model.where(F.col(actual) != F.col(expected))


def sequential_values(
    model: DataFrame,
    column_name: str,
    interval: int = 1,
    datepart: str | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Values that are not their predecessor plus the interval.

    Copies of a value are counted, neighbours are found among the distinct
    values, and failing copies are written out again at the end.
    """
    previous = f"previous_{slugify(column_name)}"
    counted = model.groupBy(F.col(column_name).alias("_value")).agg(
        F.count(F.lit(1)).alias("_rows")
    )
    # cuts, edges, rows and copies all read it: the table itself is read once
    counted = written(counted, "counted-values")
    linked = with_neighbour(
        counted.select("_value"), "_value", direction="previous", name="_previous", ranges=ranges
    )

    def failing(rows: DataFrame, before: str, *more: Column) -> DataFrame:
        if datepart is None:
            follows = F.col("_value") == F.col(before) + interval
        else:
            follows = as_timestamp("_value") == dateadd(datepart, interval, before)
        return rows.where(~follows).select(
            F.col("_value").alias(column_name), F.col(before).alias(previous), *more
        )

    later = failing(counted.where("_rows > 1"), "_value", (F.col("_rows") - 1).alias("_rows"))
    return failing(linked, "_previous").unionByName(replicate(later, "_rows"))


# How the upper bound must relate to the next lower bound.
_GAP_RULES = {
    "not_allowed": ("equal_to", lambda upper, following: upper == following),
    "allowed": ("less_than_or_equal_to", lambda upper, following: upper <= following),
    "required": ("less_than", lambda upper, following: upper < following),
}


def mutually_exclusive_ranges(
    model: DataFrame,
    lower_bound_column: str | Column,
    upper_bound_column: str | Column,
    partition_by: str | Column | None = None,
    gaps: str = "allowed",
    zero_length_range_allowed: bool = False,
    max_partition_rows: int = 10_000_000,
) -> DataFrame:
    """Ranges that are empty, overlap the next one or break the gap rule.

    Bounds may have any sortable type, and all plans give the same rows. One
    window per partition does when the largest partition is known to have at
    most ``max_partition_rows`` rows. Beyond that, or without a partition
    column, partitions are cut into ranges of the lower bound with a window
    each. Where even a range is larger, because one lower bound is repeated too
    often, the next lower bound comes from aggregates.
    """
    if gaps not in _GAP_RULES:
        raise ValueError(f"gaps must be one of {sorted(_GAP_RULES)}, not {gaps!r}")
    keys = [] if partition_by is None else ["partition_by_col"]

    ranges = model.select(
        *([_expression(partition_by).alias("partition_by_col")] if keys else []),
        _expression(lower_bound_column).alias("lower_bound"),
        _expression(upper_bound_column).alias("upper_bound"),
    )
    linked = _next_bounds(ranges, keys, max_partition_rows)
    gap_name, gap_rule = _GAP_RULES[gaps]
    lower, upper, following = F.col("lower_bound"), F.col("upper_bound"), F.col("next_lower_bound")
    length_name = "less_than_or_equal_to" if zero_length_range_allowed else "less_than"
    length_ok = (lower <= upper) if zero_length_range_allowed else (lower < upper)
    length_column = f"lower_bound_{length_name}_upper_bound"
    gap_column = f"upper_bound_{gap_name}_next_lower_bound"
    checked = linked.withColumns(
        {
            length_column: F.coalesce(length_ok, F.lit(False)),
            gap_column: F.coalesce(gap_rule(upper, following), F.col("is_last_record")),
        }
    )
    failing = checked.where(~(F.col(length_column) & F.col(gap_column)))
    return replicate(failing, "_rows") if "_rows" in failing.columns else failing


def _next_bounds(ranges: DataFrame, keys: list[str], max_rows: int) -> DataFrame:
    """Add next_lower_bound and is_last_record, choosing the plan by counted sizes."""
    then_by = F.col("upper_bound").asc_nulls_first()
    if keys and largest_group(ranges, keys) <= max_rows:
        order = Window.partitionBy(*keys).orderBy(F.col("lower_bound").asc_nulls_last(), then_by)
        return ranges.withColumns(
            {
                "next_lower_bound": F.lead("lower_bound").over(order),
                "is_last_record": F.lead(F.lit(1)).over(order).isNull(),
            }
        )
    cut = ranged(ranges, "lower_bound", default_ranges(ranges), "_range")
    if largest_group(cut, [*keys, "_range"]) <= max_rows:
        return with_neighbour(
            cut, "lower_bound", keys, "next", "next_lower_bound", "is_last_record",
            range_column="_range", then_by=[then_by],
        )
    return _next_bounds_from_aggregates(ranges, keys)


def _next_bounds_from_aggregates(ranges: DataFrame, keys: list[str]) -> DataFrame:
    """The same two columns without a window over rows, for ``_rows`` equal rows at a time.

    Rows sharing a lower bound follow each other, so only the one with the
    largest upper bound looks at the next distinct lower bound; for the others
    the next lower bound is their own. No window sees more than the distinct
    lower bounds of one range.
    """
    per_row = ranges.groupBy(*keys, "lower_bound", "upper_bound").agg(
        F.count(F.lit(1)).alias("_rows")
    )
    per_bound = per_row.groupBy(*keys, "lower_bound").agg(F.max("upper_bound").alias("_top"))
    following = with_neighbour(per_bound, "lower_bound", keys, "next", "_following", "_is_last")
    tops = following.select(
        *[F.col(k).alias(f"_{k}") for k in keys],
        F.col("lower_bound").alias("_lower"),
        "_top",
        "_following",
        "_is_last",
        F.lit(True).alias("_is_top"),
    )
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys] + [
        F.col("lower_bound").eqNullSafe(F.col("_lower")),
        F.col("upper_bound").eqNullSafe(F.col("_top")),
    ]
    is_top = F.coalesce("_is_top", F.lit(False))
    both = F.array(
        F.struct(
            F.col("_following").alias("next_lower_bound"),
            F.col("_is_last").alias("is_last_record"),
            is_top.cast("long").alias("_rows"),
        ),
        F.struct(
            F.col("lower_bound").alias("next_lower_bound"),
            F.lit(False).alias("is_last_record"),
            (F.col("_rows") - is_top.cast("long")).alias("_rows"),
        ),
    )
    joined = per_row.join(tops, same, "left")
    return joined.select(*keys, "lower_bound", "upper_bound", F.inline(both)).where("_rows > 0")


@dataclass(frozen=True)
class _KeyCheck:
    """A check that looks at the rows of one key value, or combination, together."""

    name: str
    where: str | Column | None
    parents: DataFrame | None = None
    nulls: bool = False


class Suite:
    """Several checks of one table, reported as (check_name, failures) rows.

    Checks that are a single aggregate share one pass over the table, and checks of one
    key (unique, relationships) share one grouping by it; the rest
    contribute the number of their failing rows.
    """

    def __init__(self, df: DataFrame):
        self.df = df
        self._aggregates: dict[str, Column] = {}
        self._frames: dict[str, DataFrame] = {}
        self._keyed: dict[tuple[str, ...], list[_KeyCheck]] = {}

    def aggregate(self, name: str, failures: Column) -> Suite:
        """``failures``: any aggregate giving the number of failures."""
        self._aggregates[name] = F.coalesce(failures.cast("long"), F.lit(0).cast("long"))
        return self

    def not_null(self, column: str) -> Suite:
        return self.aggregate(f"not_null_{column}", F.count_if(F.col(column).isNull()))

    def not_empty_string(self, column: str) -> Suite:
        return self.aggregate(f"not_empty_string_{column}", F.count_if(F.col(column) == ""))

    def accepted_values(self, column: str, values: Iterable) -> Suite:
        return self.aggregate(
            f"accepted_values_{column}", F.count_if(~F.col(column).isin(list(values)))
        )

    def accepted_range(self, column: str, low, high) -> Suite:
        value = F.col(column)
        return self.aggregate(f"accepted_range_{column}", F.count_if((value < low) | (value > high)))

    def expression_is_true(self, name: str, expression: str | Column) -> Suite:
        return self.aggregate(f"expression_{name}", F.count_if(~_expression(expression)))

    def at_least_one(self, column: str) -> Suite:
        return self.aggregate(f"at_least_one_{column}", (F.count(column) == 0).cast("int"))

    def not_constant(self, column: str) -> Suite:
        return self.aggregate(
            f"not_constant_{column}", (F.min(column) == F.max(column)).cast("int")
        )

    def not_null_proportion(self, column: str, at_least: float, at_most: float = 1.0) -> Suite:
        share = F.avg(F.col(column).isNotNull().cast("int"))
        return self.aggregate(
            f"not_null_proportion_{column}", ((share < at_least) | (share > at_most)).cast("int")
        )

    def recency(self, column: str, datepart: str, interval: int, now) -> Suite:
        threshold = dateadd(datepart, -interval, moment(now))
        return self.aggregate(f"recency_{column}", (F.max(column) < threshold).cast("int"))

    def unique(self, column: str, where=None, name: str | None = None) -> Suite:
        """Counts non-null values that occur more than once among the rows that meet the condition."""
        return self._by_key((column,), _KeyCheck(name or f"unique_{column}", where))

    def unique_combination(self, columns: Sequence[str], where=None, name: str | None = None) -> Suite:
        """Counts combinations held by several rows; nulls count as equal."""
        check = _KeyCheck(name or f"unique_{'_'.join(columns)}", where, nulls=True)
        return self._by_key(tuple(columns), check)

    def relationships(
        self, name: str, column: str, to: DataFrame, field: str, from_condition=None, to_condition=None
    ) -> Suite:
        """Counts rows with a non-null key that has no parent."""
        parents = _filtered(to, to_condition).select(F.col(field).alias("parent")).distinct()
        return self._by_key((column,), _KeyCheck(name, from_condition, parents))

    def _by_key(self, columns: tuple[str, ...], check: _KeyCheck) -> Suite:
        self._keyed.setdefault(columns, []).append(check)
        return self

    def _key_report(self, columns: tuple[str, ...], checks: list[_KeyCheck]) -> DataFrame:
        """All checks of one key from one grouping of the table.

        Rows are counted per key value and check before they move, so a hot value is one
        row per task; parents are joined to the groups where they lie.
        """
        keys = [f"key{i}" for i in range(len(columns))]
        rows = self.df.select(
            *[F.col(quoted(c)).alias(k) for c, k in zip(columns, keys, strict=True)],
            *[
                (F.lit(True) if c.where is None else _expression(c.where)).alias(f"meets{i}")
                for i, c in enumerate(checks)
            ],
        )
        groups = rows.groupBy(*keys).agg(*[F.count_if(F.col(f"meets{i}")).alias(f"n{i}") for i in range(len(checks))])
        known = F.col(keys[0]).isNotNull()
        failures = []
        for i, check in enumerate(checks):
            if check.parents is None:
                failures.append(F.count_if((F.col(f"n{i}") > 1) & (F.lit(True) if check.nulls else known)))
                continue
            found = check.parents.select(F.col("parent").alias(f"parent{i}"))
            groups = groups.join(found, groups[keys[0]] == found[f"parent{i}"], "left")
            orphan = known & F.col(f"parent{i}").isNull()
            failures.append(F.coalesce(F.sum(F.when(orphan, F.col(f"n{i}"))), F.lit(0).cast("long")))
        one = groups.agg(*[f.cast("long").alias(f"c{i}") for i, f in enumerate(failures)])
        pairs = [
            F.struct(F.lit(c.name).alias("check_name"), F.col(f"c{i}").alias("failures"))
            for i, c in enumerate(checks)
        ]
        return one.select(F.inline(F.array(*pairs)))

    def failing_rows(self, name: str, failing: DataFrame) -> Suite:
        self._frames[name] = failing
        return self

    def run(self) -> DataFrame:
        parts = []
        if self._aggregates:
            names = list(self._aggregates)
            one = self.df.agg(*[e.alias(f"c{i}") for i, e in enumerate(self._aggregates.values())])
            pairs = [
                F.struct(F.lit(n).alias("check_name"), F.col(f"c{i}").alias("failures"))
                for i, n in enumerate(names)
            ]
            parts.append(one.select(F.inline(F.array(*pairs))))
        parts += [self._key_report(columns, checks) for columns, checks in self._keyed.items()]
        for name, failing in self._frames.items():
            parts.append(
                failing.agg(F.count(F.lit(1)).alias("failures")).select(
                    F.lit(name).alias("check_name"), "failures"
                )
            )
        if not parts:
            raise ValueError("the suite has no checks")
        return reduce(DataFrame.unionAll, parts)
