"""Search over document tables (Q1-Q20): predicates, sorts and pages as plain columns, so Catalyst pushes
them into the scan. Every page is `orderBy().limit()`, which plans as a per-task top-K and one small merge.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from docfold.functions.geo import parse_latlon, within_km

# --- predicates --------------------------------------------------------------------------------

def term(col: Column, value) -> Column:
    """Q1. A quoted number is still a number on a numeric column: the literal takes the column's type."""
    return col == F.lit(value)


def any_of(col: Column, values: Iterable) -> Column:
    """Q3."""
    return col.isin(list(values))


def in_range(col: Column, low=None, high=None, low_open: bool = False, high_open: bool = False) -> Column:
    """Q4. A missing bound is open; a document without the field never matches."""
    out = None
    if low is not None:
        out = col > low if low_open else col >= low
    if high is not None:
        upper = col < high if high_open else col <= high
        out = upper if out is None else out & upper
    return col.isNotNull() if out is None else out


def matches_ignoring_case(col: Column, value: str, limit: int | None = None) -> Column:
    """Q5: whole-value match without case. With a `limit`, text of more characters has no term."""
    same = F.lower(col) == value.lower()
    return same if limit is None else same & (F.length(col) <= limit)


def has_element(col: Column, value) -> Column:
    """Q7."""
    return F.array_contains(col, value)


def exists(col: Column) -> Column:
    """Q8."""
    return col.isNotNull()


def starts_with(col: Column, prefix: str) -> Column:
    """Q8."""
    return col.startswith(prefix)


def negate(condition: Column) -> Column:
    """Q9: a document without the field matches the negation."""
    return ~F.coalesce(condition, F.lit(False))


def search_anything(text: Column, words: str, limit: int | None = None) -> Column:
    """Q6: every word is a substring of some value of the catch-all list; special characters are literal.

    With a `limit`, values of more characters have no term and never match.
    """
    def hit(x: Column, word: str) -> Column:
        found = F.contains(F.lower(x), F.lit(word))
        return found if limit is None else found & (F.length(x) <= limit)

    out = F.lit(True)
    for word in words.lower().split():
        out = out & F.exists(text, lambda x: hit(x, word))
    return F.coalesce(out, F.lit(False))


def near(location: Column, lat: float, lon: float, km: float) -> Column:
    """Q10 on a 'lat,lon' text column. Keep latitude and longitude as columns and use `within_km` to prune files."""
    y, x = parse_latlon(location)
    return within_km(y, x, lat, lon, km)


def term_in(df: DataFrame, name: str, value) -> Column:
    """Q1 with the column's type at hand: the literal is cast to it, never the column, so the filter reaches the scan
    and a number against a text column compares as text."""
    return F.col(f"`{name}`") == F.lit(value).cast(df.schema[name].dataType)


def find(df: DataFrame, *filters: Column) -> DataFrame:
    """Q2: all filters hold."""
    for f in filters:
        df = df.where(f)
    return df


# --- sorts and pages ---------------------------------------------------------------------------

def sort_keys(sort: Sequence[tuple[str, str]]) -> list[Column]:
    """Q11, Q12: [(field, asc|desc), ...]; a missing value is last in both directions."""
    out = []
    for name, direction in sort:
        col = F.col(f"`{name}`")
        if direction not in ("asc", "desc"):
            raise ValueError(f"sort direction must be asc or desc, got {direction!r}")
        out.append(col.asc_nulls_last() if direction == "asc" else col.desc_nulls_last())
    return out


def page(df: DataFrame, sort: Sequence[tuple[str, str]], rows: int, fields: Sequence[str] | None = None,
         position: str | None = None) -> DataFrame:
    """Q13: the first `rows` documents of the sort; `position` adds the 1-based place on the page."""
    keys = sort_keys(sort)
    top = df.orderBy(*keys).limit(rows)
    if position:
        # The window sees the page only, `rows` rows at most.
        top = top.withColumn(position, F.row_number().over(Window.orderBy(*keys)))
    if fields is None:
        return top
    return top.select(*[F.col(f"`{c}`") for c in fields], *([position] if position else []))


def cursor_page(df: DataFrame, key: str, after, rows: int, fields: Sequence[str] | None = None) -> DataFrame:
    """Q15: the next `rows` documents strictly after the last key returned."""
    if after is not None:
        df = df.where(F.col(f"`{key}`") > F.lit(after))
    return page(df, [(key, "asc")], rows, fields)


def hits(df: DataFrame, *filters: Column, name: str = "num_found") -> DataFrame:
    """Q16."""
    return find(df, *filters).agg(F.count(F.lit(1)).alias(name))


# --- children ----------------------------------------------------------------------------------

def latest_actionable(children: Column, status: str, when: str, actionable: Sequence) -> Column:
    """Q19: latest `when` over children in an actionable status; NULL when there is none."""
    return F.array_max(F.transform(
        F.filter(children, lambda c: c[status].isin(list(actionable))), lambda c: c[when]))


def recent_children(docs: DataFrame, latest: str, source: str, children: str, child_schema: str,
                    status: str, when: str, actionable: Sequence, rows: int, tiebreak: Sequence[tuple[str, str]],
                    parent_tiebreak: str) -> DataFrame:
    """Q17: newest `rows` actionable children, read from the source JSON of the `rows` newest parents only.

    The parents are a sorted top-K on the derived key `latest`; only their JSON is parsed.
    """
    # Parents without the key sort last, so dropping them from the page is the same as before it, and cheaper.
    parents = page(docs, [(latest, "desc"), (parent_tiebreak, "asc")], rows, [source, latest]).where(exists(F.col(latest)))
    parsed = F.from_json(F.col(source), f"struct<{children}:array<{child_schema}>>")[children]
    found = parents.select(F.explode(F.filter(parsed, lambda c: c[status].isin(list(actionable)))).alias("c")).select("c.*")
    return page(found, [(when, "desc"), *tiebreak], rows)


def top_children(docs: DataFrame, children: Column, status: str, when: str, actionable: Sequence, rows: int,
                 tiebreak: Sequence[tuple[str, str]]) -> DataFrame:
    """Q18: the same page over all parents, without the derived key."""
    found = docs.select(F.explode(F.filter(children, lambda c: c[status].isin(list(actionable)))).alias("c")).select("c.*")
    return page(found, [(when, "desc"), *tiebreak], rows)
