"""Text functions with the application's SQL semantics (NULL concatenation,
LIKE without an escape character, upper-case hex hashes), built
from JVM-side column expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def lit_or_col(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def oconcat(*parts) -> Column:
    """`a || b` where a NULL operand counts as the empty string (Spark's
    concat would return NULL)."""
    return F.concat_ws("", *[lit_or_col(p) for p in parts])


def like_literal_backslash(term: Column) -> Column:
    """A LIKE pattern written without an ESCAPE clause treats `\\` as an
    ordinary character; Spark uses `\\` as its escape, so double it.
    `%` and `_` remain wildcards on purpose."""
    return F.regexp_replace(term, r"\\", r"\\\\")


def contains_ci(col: Column, term) -> Column:
    """LOWER(col) LIKE LOWER('%' || term || '%'); a NULL term gives '%%'."""
    pattern = F.lower(oconcat("%", like_literal_backslash(lit_or_col(term).cast("string")), "%"))
    return F.like(F.lower(col), pattern)


def equals_ci(col: Column, value) -> Column:
    return F.upper(col) == F.upper(lit_or_col(value))


def empty_as_null(col: Column) -> Column:
    """The application stores '' as NULL."""
    return F.nullif(col, F.lit(""))


def password_hash(plain: Column) -> Column:
    """Upper-case hex SHA-256 of the UTF-8 text."""
    return F.upper(F.sha2(plain, 256))


def starts_with(col: Column, prefix: str) -> Column:
    return F.startswith(col, F.lit(prefix))


def is_open_order(status: Column) -> Column:
    """Open order / cart: the canonical status or its legacy spelling
    (never NULL: a NULL status is not open)."""
    from ..schemas import ORDER_NEW, ORDER_NEW_LEGACY
    return F.coalesce(status.isin(ORDER_NEW, ORDER_NEW_LEGACY), F.lit(False))
