"""Existence and lookup joins. Catalyst and AQE choose between broadcast, shuffle and skew splits."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _condition(left: DataFrame, right: DataFrame, pairs, null_safe: bool) -> Column:
    tests = [
        left[a].eqNullSafe(right[b]) if null_safe else left[a] == right[b] for a, b in pairs
    ]
    return reduce(lambda x, y: x & y, tests)


def absent_from(
    rows: DataFrame, table: DataFrame, on: Iterable[str], null_safe: bool = False, buckets: int | None = None
) -> DataFrame:
    """Rows whose `on` values do not occur in `table`.

    Where the table is stored in `buckets` by `on`, rows are dealt out to as many. Both sides
    then agree as they are; without that, Spark would rather move a table of few buckets too.
    """
    on = list(on)
    if buckets:
        rows = rows.repartition(buckets, *on)
    known = table.select(*[F.col(c).alias(f"_known_{c}") for c in on])
    pairs = [(c, f"_known_{c}") for c in on]
    return rows.join(known, _condition(rows, known, pairs, null_safe), "left_anti")


def present_in(rows: DataFrame, table: DataFrame, on: Iterable[str], null_safe: bool = False) -> DataFrame:
    """Rows whose `on` values occur in `table`."""
    on = list(on)
    known = table.select(*[F.col(c).alias(f"_known_{c}") for c in on])
    pairs = [(c, f"_known_{c}") for c in on]
    return rows.join(known, _condition(rows, known, pairs, null_safe), "left_semi")


def with_lookup(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    on: Iterable[str],
    alias: str | None = None,
    null_safe: bool = False,
    required: bool = False,
) -> DataFrame:
    """Add `key` of the `table` row that agrees on the `on` columns.

    Unmatched rows get NULL, or are dropped where `required`. No size hint is given:
    a small table is broadcast by its measured size, a large one is shuffled, and a hot
    value (one place, or NULL) is split over several tasks by AQE's skew join.
    """
    on = list(on)
    side = table.select(F.col(key).alias(alias or key), *[F.col(c).alias(f"_on_{c}") for c in on])
    pairs = [(c, f"_on_{c}") for c in on]
    joined = rows.join(side, _condition(rows, side, pairs, null_safe), "inner" if required else "left")
    return joined.drop(*[f"_on_{c}" for c in on])


def insert_ignore(new: DataFrame, table: DataFrame | None, key: Iterable[str]) -> DataFrame:
    """The rows of `new` an insert with 'on conflict do nothing' would add."""
    key = list(key)
    once = new.dropDuplicates(key)
    return once if table is None else absent_from(once, table, key)
