"""Small helpers to shape results without cross joins or driver loops."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def one_row(parts: dict[str, DataFrame]) -> DataFrame:
    """Combine one-row, one-column aggregates into a single row.

    Each input is reduced by its own (partial + final) aggregate; the
    one-row results are unioned and folded with ``max`` per column.  This is a
    union of a handful of rows, not a cross join of anything.
    """
    names = list(parts)
    branches = []
    for name, df in parts.items():
        value = df.columns[0]
        cols = [(F.col(value) if n == name else F.lit(None)).cast(df.schema[value].dataType).alias(n)
                for n in names]
        branches.append(df.select(*cols))
    u = branches[0]
    for b in branches[1:]:
        u = u.unionByName(b)
    return u.agg(*[F.max(F.col(n)).alias(n) for n in names])


def count_of(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def stack_rows(df: DataFrame, key_name: str, specs: list[tuple[str, list[Column]]],
               value_names: list[str]) -> DataFrame:
    """Unpivot each input row into one row per spec (an ``inline`` generator
    over an array of structs; no join)."""
    return df.select(F.inline(F.array(*[
        F.struct(F.lit(key).alias(key_name), *[v.alias(n) for v, n in zip(values, value_names)])
        for key, values in specs])))
