"""Intermediate tables in the shared folder, and joins that spread hot keys."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.columns import unused
from ..session import new_folder


def saved(df: DataFrame, label: str) -> DataFrame:
    """The rows, written once to the cluster's shared folder and read from there.

    Cuts the lineage: what reads it survives lost executors without a recomputation.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def salted_join(rows: DataFrame, by_key: DataFrame, key: str, spread: str, salts: int = 16) -> DataFrame:
    """Join rows with a table that has one row per key; a hot key's rows go to ``salts`` tasks.

    ``spread`` is the column of ``rows`` by which a key's rows are dealt out.
    """
    left = rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)))
    numbers = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint")))
    right = by_key.withColumn("_salt", numbers)
    return left.join(right, [key, "_salt"]).drop("_salt")


def numbered(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str, bool]:
    """The rows with a number that orders documents as their ids do, its name, and whether rows may share one.

    The name is one that the table does not have. Where ids are whole numbers,
    unique and never null, the number is the id. Else null
    ids come last, different texts of one id are ordered by their hash, and rows
    equal in id and text share a number.
    """
    number, own, text_hash = (unused(docs, name) for name in ("_d", "_id", "_h"))
    whole = docs.schema[id_col].dataType.simpleString() in ("bigint", "int", "smallint", "tinyint")
    counts = docs.groupBy(F.col(id_col).alias("id")).agg(F.count(F.lit(1)).alias("n"))
    if whole and counts.where((F.col("n") > 1) | F.col("id").isNull()).isEmpty():
        return docs.withColumn(number, F.col(id_col).cast("bigint")), number, False
    rows = docs.withColumns({own: F.col(id_col), text_hash: F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))})
    keys = rows.select(F.col(own).alias("id"), F.col(text_hash).alias("h")).distinct().withColumn("none", F.col("id").isNull())
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = keys.repartitionByRange(parts, "none", "id", "h").sortWithinPartitions("none", "id", "h")
    # ranges are numbered in their order
    keys = saved(keys.select("id", "h", F.monotonically_increasing_id().alias("d")), "document-numbers")
    keys = keys.select(F.col("id").alias(f"{own}k"), F.col("h").alias(f"{text_hash}k"), F.col("d").alias(number))
    same = rows[own].eqNullSafe(keys[f"{own}k"]) & (rows[text_hash] == keys[f"{text_hash}k"])
    return rows.join(keys, same).drop(own, text_hash, f"{own}k", f"{text_hash}k"), number, True
