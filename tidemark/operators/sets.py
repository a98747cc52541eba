"""Set operations: schema-aligning union, difference, intersection, replication.

Difference and intersection are one aggregation over the tagged union. Copies of
a row collapse before the shuffle, so a row that makes up a third of a table
costs one record per task, which a join on all columns would not give.
"""

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import quoted


def union_relations(
    relations: Mapping[str, DataFrame],
    column_override: Mapping[str, str] | None = None,
    include: Iterable[str] = (),
    exclude: Iterable[str] = (),
    source_column_name: str | None = "_source_relation",
    where: str | Column | None = None,
) -> DataFrame:
    """Stack tables over the superset of their columns.

    Columns come in first-seen order and keep their first-seen type unless
    ``column_override`` names another; a table without a column gives null.
    Names are matched case-sensitively. ``where`` is applied to each input.
    """
    include, exclude, override = set(include), set(exclude), dict(column_override or {})
    if include and exclude:
        raise ValueError("give either include or exclude, not both")
    if not relations:
        raise ValueError("no relations to union")

    def wanted(name: str) -> bool:
        return name in include if include else name not in exclude

    types: dict[str, str] = {}
    for df in relations.values():
        for field in df.schema.fields:
            if wanted(field.name):
                types.setdefault(field.name, field.dataType.simpleString())
    if not types:
        raise ValueError(f"no columns found to union for {list(relations)}")
    types.update({name: t for name, t in override.items() if name in types})

    def aligned(name: str, df: DataFrame) -> DataFrame:
        rows = df if where is None else df.where(where)
        present = set(df.columns)
        columns = [
            (F.col(quoted(c)) if c in present else F.lit(None)).cast(t).alias(c)
            for c, t in types.items()
        ]
        if source_column_name:
            columns.insert(0, F.lit(name).cast("string").alias(source_column_name))
        return rows.select(*columns)

    return reduce(DataFrame.unionAll, [aligned(n, df) for n, df in relations.items()])


def tagged_counts(a: DataFrame, b: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per distinct row of either table, with its count in each."""
    columns = list(columns or a.columns)
    names = [quoted(c) for c in columns]

    def tag(df: DataFrame, in_a: int) -> DataFrame:
        return df.select(
            *names, F.lit(in_a).cast("long").alias("_a"), F.lit(1 - in_a).cast("long").alias("_b")
        )

    return (
        tag(a, 1)
        .unionAll(tag(b, 0))
        .groupBy(*names)
        .agg(F.sum("_a").alias("_count_a"), F.sum("_b").alias("_count_b"))
    )


def except_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of ``a`` that ``b`` does not hold; nulls equal each other."""
    both = tagged_counts(a, b.toDF(*a.columns))
    return both.where("_count_a > 0 and _count_b = 0").drop("_count_a", "_count_b")


def intersect_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows found in both tables; nulls equal each other."""
    both = tagged_counts(a, b.toDF(*a.columns))
    return both.where("_count_a > 0 and _count_b > 0").drop("_count_a", "_count_b")


def replicate(df: DataFrame, count_column: str, chunk: int = 100_000) -> DataFrame:
    """Turn each row with a count n into n rows and drop the count.

    Counts are first cut into pieces of at most ``chunk``, and the pieces are
    spread over the tasks before they are written out: no task expands one huge
    group and no array grows with n.
    """
    n = F.col(quoted(count_column))
    rest = [quoted(c) for c in df.columns if c != count_column]
    last = F.call_function("div", n - 1, F.lit(chunk)).cast("int")
    left = n - F.col("_piece").cast("long") * chunk
    # a stated number of partitions keeps the few, small pieces from being coalesced
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = (
        df.where(n > 0)
        .withColumn("_piece", F.explode(F.sequence(F.lit(0), last)))
        .select(*rest, "_piece", F.least(F.lit(chunk).cast("long"), left).alias("_size"))
        .repartition(tasks, *rest, "_piece")
    )
    copies = F.array_repeat(F.lit(True), F.col("_size").cast("int"))
    return pieces.select(*rest, F.explode(copies).alias("_copy")).drop("_copy")
