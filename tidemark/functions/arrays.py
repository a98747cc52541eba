"""Array construction, growth and rendering."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from .keys import as_column


def array_construct(*inputs, data_type: str = "int") -> Column:
    """Array of the inputs; with none, an empty array of ``data_type``."""
    if inputs:
        return F.array(*[as_column(i) for i in inputs])
    return F.array().cast(f"array<{data_type}>")


def array_append(array, element) -> Column:
    return F.array_append(as_column(array), element)


def array_concat(first, second) -> Column:
    return F.concat(as_column(first), as_column(second))


def cast_array_to_string(array) -> Column:
    """``[1,2,3]``: no blanks, null elements as NULL."""
    parts = F.transform(as_column(array), lambda x: x.cast("string"))
    return F.concat(F.lit("["), F.array_join(parts, ",", "NULL"), F.lit("]"))
