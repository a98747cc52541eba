"""Aggregate expressions for ``groupBy(...).agg(...)``."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import orders
from .keys import as_column
from .orders import Key


def any_value(field) -> Column:
    """Some value of the group; the smallest one, so that results repeat."""
    return F.min(as_column(field))


def bool_or(field) -> Column:
    """True when any row is true; null rows do not count."""
    return F.bool_or(as_column(field))


def listagg(
    measure, delimiter: str = ",", order_by=None, limit: int | None = None, descending: bool = False
) -> Column:
    """The group's values as one text, by default in the order of the values.

    ``order_by`` is an order list (``"o desc, p nulls first"``), a Column, or a
    list of either; ``descending`` turns the keys that name no direction. Null is
    the largest value by default. Ties fall to the values. The whole group ends
    up in one cell. Where only the first ``limit`` values of large groups are
    wanted, use ``operators.reshape.listagg_by``, which drops the others before
    anything is collected.
    """
    measure = as_column(measure).cast("string")
    keys = [(measure, Key("", descending, descending))] if order_by is None else _keys(order_by, descending)
    fields = [c.alias(f"k{i}") for i, (c, _) in enumerate(keys)] + [measure.alias("m")]
    ways = [(f"k{i}", k) for i, (_, k) in enumerate(keys)] + [("m", Key(""))]

    def before(a: Column, b: Column) -> Column:
        """-1, 0 or 1, key by key."""
        out = F.lit(0)
        for name, key in reversed(ways):
            x, y = a[name], b[name]
            first, last = (-1, 1) if key.nulls_first else (1, -1)
            less, more = (1, -1) if key.descending else (-1, 1)
            out = (
                F.when(x.isNull() & y.isNull(), out).when(x.isNull(), first).when(y.isNull(), last)
                .when(x < y, less).when(x > y, more).otherwise(out)
            )
        return out

    if any(k.descending or k.nulls_first for _, k in keys):
        rows = F.array_sort(F.collect_list(F.struct(*fields)), before)
    else:
        # the natural order of structs, with a flag before each key that puts nulls last
        flagged = [f for c, way in zip([*[c for c, _ in keys], measure], ways, strict=True)
                   for f in (c.isNull().alias(f"{way[0]}_null"), c.alias(way[0]))]
        rows = F.sort_array(F.collect_list(F.struct(*flagged)))
    values = F.transform(rows, lambda r: r["m"])
    if limit is not None:
        return F.array_join(F.slice(values, 1, limit), delimiter)
    return F.when(F.count(measure) > 0, F.array_join(values, delimiter))


def _keys(order_by, descending: bool) -> list[tuple[Column, Key]]:
    if isinstance(order_by, Column):
        return [(order_by, Key("", descending, descending))]
    if isinstance(order_by, Key):
        return [(order_by.column(), order_by)]
    if isinstance(order_by, str):
        found = [(k.column(), k) for k in orders.keys(order_by)]
        return [(c, Key(k.what, True, True) if descending and k == Key(k.what) else k) for c, k in found]
    return [k for part in order_by for k in _keys(part, descending)]


# Comparison spellings accepted by ``pivot``.
_COMPARE = {
    "=": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
    "<>": lambda c, v: c != v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "like": lambda c, v: c.like(v),
    "ilike": lambda c, v: c.ilike(v),
}


def compare(column: Column, cmp: str, value) -> Column:
    try:
        test = _COMPARE[cmp.lower()]
    except KeyError:
        raise ValueError(f"unknown comparison {cmp!r}; use one of {list(_COMPARE)}") from None
    return test(column, value if cmp.lower() in ("like", "ilike") else F.lit(value))


def aggregate(agg: str, expression: Column, distinct: bool = False) -> Column:
    agg = agg.lower()
    if not distinct or agg in ("min", "max"):
        return F.call_function(agg, expression)
    if agg == "sum":
        return F.sum_distinct(expression)
    if agg == "count":
        return F.count_distinct(expression)
    if agg in ("avg", "mean"):
        return F.sum_distinct(expression) / F.count_distinct(expression)
    raise ValueError(f"no distinct form of {agg!r}")
