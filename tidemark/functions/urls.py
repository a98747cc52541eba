"""URL parts cut from text; inputs may lack a scheme, so no URL parser is used."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .keys import as_column
from .text import position, split_part

# The schemes removed before a URL is cut.
WEB_SCHEMES = ("http://", "https://")
APP_SCHEMES = ("android-app://",)


def _without(url, schemes) -> Column:
    return reduce(lambda c, s: F.replace(c, F.lit(s), F.lit("")), schemes, as_column(url))


def get_url_host(url) -> Column:
    """Text up to the first '/', then up to the first '?'; a '#' is kept."""
    bare = _without(url, APP_SCHEMES + WEB_SCHEMES)
    return split_part(split_part(bare, "/", 1), "?", 1)


def get_url_path(url, host_as_path: bool = True) -> Column:
    """Text after the first '/', up to the following '?'.

    A URL with neither '/' nor '?' returns its host; pass ``host_as_path=False``
    to get '' instead.
    """
    bare = _without(url, WEB_SCHEMES)
    slash, query = position("/", bare), position("?", bare)
    no_path = bare if host_as_path else F.lit("")
    return (
        F.when(slash > 0, split_part(F.substr(bare, slash + 1), "?", 1))
        .when(query > 0, F.lit(""))
        .when(bare.isNotNull(), no_path)
    )


def get_url_parameter(url, name: str) -> Column:
    """Text between ``name=`` and the next '&'; null when absent or empty.

    The name is found as a plain substring: ``source`` also finds ``utm_source``.
    """
    tail = split_part(as_column(url), f"{name}=", 2)
    return F.nullif(split_part(tail, "&", 1), F.lit(""))
