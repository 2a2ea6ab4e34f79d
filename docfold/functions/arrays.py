"""Row-local helpers over arrays: they keep work inside one row, so no shuffle is needed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once and use it many times inside `body` (a lambda variable is a cheap read)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def non_empty(array: Column) -> Column:
    """The array, or NULL when it is empty."""
    return F.get(F.filter(F.array(array), lambda a: F.size(a) > 0), F.lit(0))


def present(array: Column) -> Column:
    """The array without its null elements."""
    return F.filter(array, lambda x: x.isNotNull())


def group_entries(entries: Column) -> Column:
    """array<struct<name, value>> -> map<name, array<value>>, keeping order inside a name.

    Null values are dropped; a name that has only nulls maps to NULL. Sort based: n log n in the
    number of entries of the row, however many distinct names it has.
    """
    ranked = F.array_sort(F.transform(entries, lambda e, i: F.struct(
        e["name"].alias("name"), i.alias("at"), e["value"].alias("value"))))

    def starts(s: Column) -> Column:
        marked = F.transform(s, lambda e, i: F.struct(e["name"].alias("name"), i.alias("at")))
        return F.filter(marked, lambda m: (m["at"] == 0) | (F.get(s, m["at"] - 1)["name"] != m["name"]))

    def cut(s: Column, b: Column) -> Column:
        def one(m: Column, j: Column) -> Column:
            end = F.coalesce(F.get(b, j + 1)["at"], F.size(s))
            values = F.transform(F.slice(s, m["at"] + 1, end - m["at"]), lambda e: e["value"])
            return F.struct(m["name"].alias("key"), non_empty(present(values)).alias("value"))

        return F.map_from_entries(F.transform(b, one))

    return let(ranked, lambda s: let(starts(s), lambda b: cut(s, b)))
