"""Helpers that shape the query plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def compute_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add ``columns`` so that later filters reuse their values.

    Catalyst pushes a filter below a projection by copying the projected
    expression into it, which would run a costly regex chain once per filter.
    It does not copy through a generator, so a one-element ``inline`` keeps every
    expression evaluated once while filters on other columns still move down.
    """
    keep = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select(*keep, F.inline(F.array(row)))


def keep_columns(df: DataFrame) -> DataFrame:
    """``df`` protected from column pruning.

    Two branches of a plan share a shuffle only if they read the same columns from it;
    pruning each branch by itself would compute its input twice.
    """
    return df.select(F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in df.columns]))))


def broadcast_if_small(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows, which are counted no further.

    The count reads ``df``: give it a stored table, or one that is cheap to compute.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def sql_string(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _listed(values) -> str:
    return ", ".join(map(sql_string, values))


# Lists are passed as one SQL text each: building them from a column object per element
# takes a call to the JVM per element, seconds for a query with many lists.

def literals(values) -> Column:
    """Array literal of strings, typed even when empty."""
    return F.expr(f"CAST(array({_listed(values)}) AS array<string>)")


def keep_listed(array: Column, values) -> Column:
    """Elements of ``array`` that are in the list, repetitions included."""
    if not values:
        return literals(())
    return F.call_function("filter", array, F.expr(f"x -> x IN ({_listed(values)})"))


def drop_listed(array: Column, values) -> Column:
    """Elements of ``array`` that are not in the list."""
    if not values:
        return array
    return F.call_function("filter", array, F.expr(f"x -> NOT x IN ({_listed(values)})"))
