"""Session settings and shared scratch space."""

import atexit
import shutil
import tempfile
import uuid
from functools import reduce
from operator import add

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings the operators count on; a cluster would set them in its defaults.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def build_session(app: str = "tidemark", master: str | None = None, **extra) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``.

    A local master without one gets a temporary folder, removed when Python ends.
    On a cluster the setting is required: a folder on one machine would lose data.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all machines of {master} share")
        folder = tempfile.mkdtemp(prefix="tidemark-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows, written once to the shared folder and read from there."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_scratch: list[str] = []


def new_folder(spark: SparkSession, label: str) -> str:
    """A path not used before, inside the shared folder."""
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


def remove_scratch(spark: SparkSession, since: int = 0) -> None:
    """Remove the folders handed out by ``new_folder``, from the given one on.

    For the end of a run: results that were read from them are lost.
    """
    for path in _scratch[since:]:
        remove_path(spark, path)
    del _scratch[since:]


def scratch_count() -> int:
    return len(_scratch)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder on the file system it names, if it is there."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the path exists on the file system it names."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    return target.getFileSystem(hadoop).exists(target)


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern, sorted."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    found = target.getFileSystem(hadoop).globStatus(target)
    return sorted(status.getPath().toString() for status in found or [])


def child_paths(spark: SparkSession, folder: str) -> list[str]:
    """What lies directly in a folder, whose name may hold any characters."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    found = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(target)
    return sorted(status.getPath().toString() for status in found)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there as a whole or not at all, on the file system its path names."""
    jvm, hadoop = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target, part = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{path}.{uuid.uuid4().hex}.part"))
    system = target.getFileSystem(hadoop)
    stream = system.create(part, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not system.rename(part, target):
        system.delete(part, False)
        raise FileExistsError(path)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(target)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def small_enough_to_broadcast(
    df: DataFrame, max_rows: int, max_bytes: int = 64 * 1024 * 1024
) -> bool:
    """Whether the table has at most that many rows and bytes (of its values as text).

    The rows are counted first, without reading a column; bytes are only added
    up for a table that passes.
    """
    if df.count() > max_rows:
        return False
    sizes = [F.coalesce(F.octet_length(df[c].cast("string")), F.lit(0)) + 8 for c in df.columns]
    total = df.agg(F.sum(reduce(add, sizes).cast("long")).alias("bytes")).first()["bytes"]
    return (total or 0) <= max_bytes
