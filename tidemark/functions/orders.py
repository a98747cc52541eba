"""Order lists as text: ``"ts desc, upper(name), id nulls first"``."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

_ITEM = re.compile(
    r"(?P<what>.+?)(?:\s+(?P<way>asc|desc))?(?:\s+nulls\s+(?P<nulls>first|last))?", re.I | re.S
)
_QUOTES = {"'": "'", '"': '"', "`": "`"}


def split_list(text: str) -> list[str]:
    """The parts between commas that are in no bracket and no quotes."""
    parts, depth, quote, start = [], 0, None, 0
    for at, ch in enumerate(text):
        if quote:
            quote = None if ch == quote else quote
        elif ch in _QUOTES:
            quote = ch
        elif ch in "([{":
            depth += 1
        elif ch in ")]}":
            depth -= 1
        elif ch == "," and depth == 0:
            parts.append(text[start:at].strip())
            start = at + 1
    parts.append(text[start:].strip())
    if not all(parts):
        raise ValueError(f"an empty item in the list {text!r}")
    return parts


@dataclass(frozen=True)
class Key:
    """One order key. Unless said otherwise, null counts as the largest value."""

    what: str
    descending: bool = False
    nulls_first: bool = False

    def column(self, columns: Iterable[str] = ()) -> Column:
        return expression(self.what, columns)

    def sorted(self, value: Column) -> Column:
        if self.descending:
            return value.desc_nulls_first() if self.nulls_first else value.desc_nulls_last()
        return value.asc_nulls_first() if self.nulls_first else value.asc_nulls_last()


def expression(text: str, columns: Iterable[str] = ()) -> Column:
    """A column of that name, blanks and all, else the expression. Anything else raises."""
    if text in set(columns):
        return F.col("`" + text.replace("`", "``") + "`")
    # in brackets, so that trailing words can't pass as an alias
    return F.expr(f"({text})")


def keys(text: str, columns: Iterable[str] = ()) -> list[Key]:
    """The keys of an order list; a name in ``columns`` is taken as it is."""
    columns, found = set(columns), []
    if text in columns:
        return [Key(text)]
    for item in split_list(text):
        part = _ITEM.fullmatch(item)
        if item in columns or part is None:
            found.append(Key(item))
            continue
        descending = (part["way"] or "").lower() == "desc"
        nulls = (part["nulls"] or ("first" if descending else "last")).lower()
        found.append(Key(part["what"], descending, nulls == "first"))
    return found


def order_list(order, columns: Iterable[str] = ()) -> list[Column]:
    """Sort columns of an order given as text, Column, or a list of either."""
    columns = list(columns)
    if isinstance(order, Column):
        return [order]
    if isinstance(order, str):
        return [k.sorted(k.column(columns)) for k in keys(order, columns)]
    return [c for part in order for c in order_list(part, columns)]


def names(order, columns: Iterable[str] = ()) -> set[str]:
    """The columns that an order names plainly."""
    columns = set(columns)
    if isinstance(order, Column):
        return set()
    if isinstance(order, str):
        return {k.what for k in keys(order, columns)} & columns
    return set().union(*(names(part, columns) for part in order))
