"""ORDER BY items: NULLs come last ascending and first descending."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_ITEM = re.compile(r"(?is)^(.*?)(?:\s+(asc|desc))?(?:\s+nulls\s+(first|last))?\s*$")


class Item:
    """One sort expression with its direction."""

    def __init__(self, item):
        if isinstance(item, tuple):
            self.expr, direction = item
            self.desc, nulls = direction.lower() == "desc", None
        elif isinstance(item, Column):
            self.expr, self.desc, nulls = item, False, None
        else:
            text, direction, nulls = _ITEM.match(item).groups()
            self.expr, self.desc = F.expr(text), (direction or "").lower() == "desc"
        self.nulls_first = nulls.lower() == "first" if nulls else self.desc

    def of(self, c: Column) -> Column:
        """``c`` sorted the way this item asks for."""
        if self.desc:
            return c.desc_nulls_first() if self.nulls_first else c.desc_nulls_last()
        return c.asc_nulls_first() if self.nulls_first else c.asc_nulls_last()

    def column(self) -> Column:
        return self.of(self.expr)

    def sql(self, name: str) -> str:
        return f"`{name}` {'DESC' if self.desc else 'ASC'} NULLS {'FIRST' if self.nulls_first else 'LAST'}"


def items(order) -> list[Item]:
    """``order`` is one item or a list: ``"price desc"``, a Column, or ``(Column, "desc")``."""
    if order is None:
        return []
    return [Item(o) for o in (order if isinstance(order, list) else [order])]


def columns(order) -> list[Column]:
    return [i.column() for i in items(order)]
