"""The most frequent values of a column, without a shuffle of all its distinct values.

Values are counted by hash bucket first: a count per bucket and task is all that
moves. The values of the fullest buckets are counted exactly, and the k-th of these counts
is a threshold: a value that reaches it lies in a bucket that does. Only the rows
of such buckets are counted by value. The result is exact; where frequencies are so even
that most buckets reach the threshold, it costs what the plain count does.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .columns import quoted, unused

#: Buckets, and so the rows that are ever broadcast (16 bytes each), and fullest ones looked at per value asked for.
BUCKETS, FULLEST = 1 << 16, 2


def _bucket(column: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(quoted(column))), F.lit(buckets).cast("bigint"))


def candidate_rows(df: DataFrame, column: str, k: int, buckets: int = BUCKETS) -> DataFrame:
    """The rows, and some others, of the k most frequent values."""
    name = unused(df, "_hash_bucket")
    rows = df.withColumn(name, _bucket(column, buckets))
    # read three times: kept, so that the table is counted once
    sizes = written(rows.groupBy(name).agg(F.count(F.lit(1)).alias("n")), "bucket-sizes")
    fullest = sizes.orderBy(F.desc("n"), name).limit(FULLEST * k)
    known = rows.join(F.broadcast(fullest.select(name)), name, "left_semi")
    counts = known.groupBy(quoted(column)).agg(F.count(F.lit(1)).alias("n"))
    # the k-th largest count; with fewer values than k there is no threshold
    largest = [r["n"] for r in counts.orderBy(F.desc("n")).limit(k).select("n").collect()]
    least = largest[-1] if len(largest) == k else 0
    full = sizes.where(F.col("n") >= least).select(name)
    return rows.join(F.broadcast(full), name, "left_semi").drop(name)


def most_frequent(df: DataFrame, column: str, k: int, buckets: int = BUCKETS) -> DataFrame:
    """``value`` and ``num_rows`` of the k most frequent values, null among them; ties go to the smaller value, null last."""
    if k < 1:
        raise ValueError("k must be at least 1")
    rows = df.select(F.col(quoted(column)).alias("value"))
    counted = candidate_rows(rows, "value", k, buckets).groupBy("value").agg(F.count(F.lit(1)).alias("num_rows"))
    return counted.orderBy(F.desc("num_rows"), F.col("value").asc_nulls_last()).limit(k)
