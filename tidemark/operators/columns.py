"""Column selection: star, filtered names, null checks, ordinal grouping."""

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import nullcheck


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def filtered_columns(df: DataFrame, except_: Iterable[str] = ()) -> list[str]:
    """Column names other than ``except_``, compared without regard to case."""
    dropped = {name.lower() for name in except_}
    return [c for c in df.columns if c.lower() not in dropped]


def star(
    df: DataFrame,
    except_: Iterable[str] = (),
    prefix: str = "",
    suffix: str = "",
    relation_alias: str | None = None,
) -> list[Column]:
    """The columns of ``df`` but ``except_``, optionally renamed, for ``select``."""
    kept = filtered_columns(df, except_)
    if not kept:
        raise ValueError("no columns left to select")
    qualifier = f"{quoted(relation_alias)}." if relation_alias else ""
    return [F.col(qualifier + quoted(c)).alias(f"{prefix}{c}{suffix}") for c in kept]


def nullcheck_table(df: DataFrame) -> DataFrame:
    """Empty text becomes null in every string column."""
    return df.select(
        *[
            nullcheck(quoted(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(quoted(f.name))
            for f in df.schema.fields
        ]
    )


def group_by_ordinal(df: DataFrame, n: int) -> GroupedData:
    """Group by the first ``n`` columns."""
    if not 0 < n <= len(df.columns):
        raise ValueError(f"cannot group by the first {n} of {len(df.columns)} columns")
    return df.groupBy(*[quoted(c) for c in df.columns[:n]])


def unused(df: DataFrame, name: str) -> str:
    """The name, with underscores before it until no column has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
