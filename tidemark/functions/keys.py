"""Text keys: concatenation, md5 and the version key built from them."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def concat(*fields) -> Column:
    """Fields joined without a separator; any null makes the result null."""
    return F.concat(*[as_column(f).cast("string") for f in fields])


def md5_hash(field) -> Column:
    return F.md5(as_column(field).cast("string"))


def surrogate_key(*fields) -> Column:
    """md5 over the text of the fields joined by '-'; null counts as empty text.

    Timestamps must be ``timestamp_ntz``: the text of a zoned timestamp, and so
    the key, would change with the session time zone.
    """
    parts = [F.coalesce(as_column(f).cast("string"), F.lit("")) for f in fields]
    return F.md5(F.concat_ws("-", *parts))


def natural_key(source, id_column) -> Column:
    """``<source>_<id>``; a null id gives a null key."""
    return F.concat(as_column(source), F.lit("_"), as_column(id_column).cast("string"))
