"""String helpers. Positions count from 1, as in SQL."""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .keys import as_column


def _lit_or_col(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def length(text) -> Column:
    return F.length(as_column(text))


def position(substring, text) -> Column:
    """Where ``substring`` first occurs in ``text``; 0 when it does not."""
    return F.position(_lit_or_col(substring), as_column(text))


def replace(text, old, new) -> Column:
    return F.replace(as_column(text), _lit_or_col(old), _lit_or_col(new))


def right(text, count) -> Column:
    """The last ``count`` characters; a negative count drops that many from the front."""
    text, count = as_column(text), _lit_or_col(count)
    return F.when(count >= 0, F.right(text, count)).otherwise(
        F.substr(text, (1 - count).cast("int"))
    )


def split_part(text, delimiter, part) -> Column:
    """The part-th piece; '' past the end; negative parts count from the end."""
    return F.split_part(as_column(text), _lit_or_col(delimiter), _lit_or_col(part))


def safe_cast(field, data_type: str) -> Column:
    """Cast that gives null where the text does not parse."""
    return as_column(field).try_cast(data_type)


def cast_bool_to_text(field) -> Column:
    return as_column(field).cast("boolean").cast("string")


def nullcheck(field) -> Column:
    """Empty text becomes null."""
    return F.nullif(as_column(field), F.lit(""))


# The characters a slug keeps or turns into underscores.
_SLUG_BREAKS = "[ -]+"
_SLUG_DROPS = "[^a-z0-9_]+"


def slugify(name: str) -> str:
    """A column-name-safe form of ``name``, computed while the plan is built."""
    return re.sub(_SLUG_DROPS, "", re.sub(_SLUG_BREAKS, "_", name.lower()))


def slugify_column(field) -> Column:
    lowered = F.lower(as_column(field))
    return F.regexp_replace(F.regexp_replace(lowered, _SLUG_BREAKS, "_"), _SLUG_DROPS, "")
