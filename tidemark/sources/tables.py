"""Table sinks: overwrite, schema sync and keyed upsert."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.columns import quoted


def write_table(df: DataFrame, path: str) -> None:
    """Replace the table at ``path`` with ``df``, which must not read from there."""
    df.write.mode("overwrite").parquet(path)


def sync_schema(target: DataFrame, delta: DataFrame) -> DataFrame:
    """``target`` with exactly the columns of ``delta``: new ones null, others dropped."""
    present = {c.lower() for c in target.columns}
    return target.select(
        *[
            F.col(quoted(f.name)).cast(f.dataType).alias(f.name)
            if f.name.lower() in present
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in delta.schema.fields
        ]
    )


def upsert_by_key(target: DataFrame, delta: DataFrame, key: str) -> DataFrame:
    """``delta`` plus the target rows whose key it does not hold."""
    kept = target.join(delta.select(key), key, "left_anti")
    return sync_schema(kept, delta).unionByName(delta)
