"""Deduplication, pivot, unpivot, ordered text aggregation, value lists."""

from collections.abc import Iterable, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import orders
from ..functions.aggregates import aggregate, compare, listagg
from ..functions.text import slugify
from ..session import written
from .columns import filtered_columns, quoted, unused


def tie_breakers(df: DataFrame, used: Iterable[str] = ()) -> list[Column]:
    """Every sortable column not in ``used``, to make an order total."""
    used = set(used)
    return [
        F.col(quoted(f.name)).asc_nulls_last()
        for f in df.schema.fields
        if f.name not in used and not isinstance(f.dataType, (T.MapType, T.VariantType))
    ]


def deduplicate(df: DataFrame, partition_by, order_by) -> DataFrame:
    """The first row of each partition under ``order_by``.

    Both are comma-separated lists of columns or expressions, Columns, or lists
    of either; an order item may end in ``asc``, ``desc``, ``nulls first`` or
    ``nulls last``, and null is the largest value by default. Ties fall to the
    remaining columns. Each task keeps one row per key before the shuffle, so a
    hot key does not travel.
    """
    given = [partition_by] if isinstance(partition_by, (str, Column)) else list(partition_by)
    keys = [
        c for k in given
        for c in ([k] if isinstance(k, Column) else [orders.expression(p, df.columns) for p in listed(k, df.columns)])
    ]
    taken = {p for k in given if isinstance(k, str) for p in listed(k, df.columns)}
    taken |= orders.names(order_by, df.columns)
    window = Window.partitionBy(*keys).orderBy(
        *orders.order_list(order_by, df.columns), *tie_breakers(df, taken)
    )
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def listed(text: str, columns: Iterable[str]) -> list[str]:
    """A column's name as it is, else the items of a list."""
    return [text] if text in set(columns) else orders.split_list(text)


def pivot_columns(
    column,
    values: Sequence,
    agg: str = "sum",
    cmp: str = "=",
    prefix: str = "",
    suffix: str = "",
    then_value=1,
    else_value=0,
    quote_identifiers: bool = True,
    distinct: bool = False,
) -> list[Column]:
    """One conditional aggregate per value, for ``groupBy(...).agg(*...)``."""
    column = column if isinstance(column, Column) else F.col(column)
    then_value, else_value = [
        v if isinstance(v, Column) else F.lit(v) for v in (then_value, else_value)
    ]

    def name(value) -> str:
        text = f"{prefix}{value}{suffix}"
        return text if quote_identifiers else slugify(text)

    return [
        aggregate(
            agg,
            F.when(compare(column, cmp, value), then_value).otherwise(else_value),
            distinct,
        ).alias(name(value))
        for value in values
    ]


def pivot(df: DataFrame, group_by, column: str, values: Sequence, **options) -> DataFrame:
    """Rows to columns in one aggregation.

    A distinct aggregate is fed from the distinct (group, column, value) rows:
    it sees the same values, and Spark's expansion by the number of aggregates
    then works on that much smaller input.
    """
    groups = [group_by] if isinstance(group_by, str) else list(group_by)
    if options.get("distinct"):
        parts = [v for v in (options.get("then_value"), options.get("else_value")) if isinstance(v, Column)]
        named = [p.alias(f"_part{i}") for i, p in enumerate(parts)]
        df = df.select(*groups, column, *named).distinct()
        renamed = iter(F.col(f"_part{i}") for i in range(len(parts)))
        for key in ("then_value", "else_value"):
            if isinstance(options.get(key), Column):
                options[key] = next(renamed)
    return df.groupBy(*groups).agg(*pivot_columns(column, values, **options))


def unpivot(
    df: DataFrame,
    cast_to: str = "string",
    exclude: Iterable[str] = (),
    remove: Iterable[str] = (),
    field_name: str = "field_name",
    value_name: str = "value",
) -> DataFrame:
    """One row per value column, null values included, from a single scan.

    ``exclude`` columns stay as ids, ``remove`` columns vanish; the others are
    cast to ``cast_to``.
    """
    kept_as_id = {c.lower() for c in exclude}
    ids = [c for c in filtered_columns(df, remove) if c.lower() in kept_as_id]
    values = filtered_columns(df, (*exclude, *remove))
    if not values:
        raise ValueError("no columns left to unpivot")
    cast = df.select(
        *[quoted(c) for c in ids], *[F.col(quoted(c)).cast(cast_to).alias(c) for c in values]
    )
    return cast.unpivot(
        [F.col(quoted(c)) for c in ids], [F.col(quoted(c)) for c in values], field_name, value_name
    )


def listagg_by(
    df: DataFrame,
    group_by,
    measure: str,
    delimiter: str = ",",
    order_by=None,
    limit: int | None = None,
    distinct: bool = False,
    alias: str = "listagg",
    runs: int | None = None,
) -> DataFrame:
    """Text aggregation that collects only the rows it prints.

    ``order_by`` is an order list as in ``deduplicate``; ties fall to the values.
    Copies (``distinct``) and rows past ``limit`` are dropped by partial
    aggregation or a ranked window before any group is gathered.

    ``runs`` is for groups too large for a task to sort: rows are dealt by their
    place in the order to that many runs, each run's text is made on its own, and a group's
    texts are put one after the other. Then no task holds more of a group
    than a run, or its finished text.
    """
    groups = [group_by] if isinstance(group_by, str) else list(group_by)
    items = [] if order_by is None else [order_by] if isinstance(order_by, str) else list(order_by)
    order = [k for item in items for k in orders.keys(item, df.columns)]
    if distinct and {k.what for k in order} - {measure, *groups}:
        raise ValueError("a distinct list can only be ordered by its own values")
    sorting = [k.column(df.columns).alias(f"_order{i}") for i, k in enumerate(order)]
    rows = df.select(*groups, measure, *sorting)
    if distinct:
        rows = rows.distinct()
    if limit is not None:
        ranked = [k.sorted(F.col(f"_order{i}")) for i, k in enumerate(order)]
        rank = Window.partitionBy(*groups).orderBy(*ranked, F.col(quoted(measure)).asc_nulls_last())
        rows = rows.withColumn("_rank", F.row_number().over(rank)).where(F.col("_rank") <= limit)
    by = [replace(k, what=f"_order{i}") for i, k in enumerate(order)]
    if runs is None or limit is not None:
        return rows.groupBy(*groups).agg(listagg(measure, delimiter, by or None, limit).alias(alias))
    ranked = [k.sorted(F.col(f"_order{i}")) for i, k in enumerate(order)]
    run, piece = unused(rows, "_run"), unused(rows, "_piece")
    dealt = rows.repartitionByRange(runs, *ranked, F.col(quoted(measure)).cast("string").asc_nulls_last())
    # the sampled edges differ from one evaluation to the next, so the numbers are kept
    dealt = written(dealt.withColumn(run, F.spark_partition_id()), "runs")
    pieces = dealt.groupBy(*groups, run).agg(listagg(measure, delimiter, by or None).alias(piece))
    return pieces.groupBy(*groups).agg(listagg(piece, delimiter, run).alias(alias))


def column_values(
    df: DataFrame, column: str, order_by=None, max_records: int | None = None, where=None
) -> DataFrame:
    """Distinct values of a column, the most frequent first, ties by value.

    ``order_by`` is an order list over ``value`` (or the column's name),
    ``num_rows`` and aggregates of the value's rows, as in ``"max(ts) desc"``.
    """
    rows = df if where is None else df.where(where)
    order = [] if isinstance(order_by, Column) else orders.keys(order_by or "num_rows desc")
    known = {"value": "value", column: "value", "num_rows": "num_rows"}
    extra = {k.what: f"_order{i}" for i, k in enumerate(order) if k.what not in known}
    counted = rows.groupBy(F.col(column).alias("value")).agg(
        F.count(F.lit(1)).alias("num_rows"),
        *[orders.expression(what).alias(name) for what, name in extra.items()],
    )
    by = [k.sorted(F.col({**known, **extra}[k.what])) for k in order] or [order_by]
    ranked = counted.orderBy(*by, F.col("value").asc_nulls_last()).drop(*extra.values())
    return ranked if max_records is None else ranked.limit(max_records)


def column_value_list(
    df: DataFrame | None,
    column: str,
    order_by=None,
    max_records: int | None = None,
    where=None,
    default: list | None = None,
    bound: int = 10_000,
) -> list:
    """The values as a Python list, for building pivots.

    ``default`` is returned, if given, where the table does not exist (``df`` is
    None) or has no value. More than ``bound`` values raise, rather than fill the
    driver.
    """
    if df is None:
        if default is None:
            raise ValueError("the table does not exist and no default was given")
        return default
    want = bound + 1 if max_records is None else max_records
    rows = column_values(df, column, order_by, want, where).select("value").take(want)
    if max_records is None and len(rows) > bound:
        raise ValueError(f"{column} has more than {bound} distinct values; pass a larger bound to get them")
    if not rows and default is not None:
        return default
    return [r["value"] for r in rows]
