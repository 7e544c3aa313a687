"""Data-quality rules: foreign keys, reserved names, NOT NULL / length /
JSON checks, uniqueness (C10, G1, G2, G3).

Each rule is a set operation over the whole table.  Child keys are reduced
to one row per key value before the anti join against the parent, so a key
held by a third of all child rows costs one row after the map-side combine.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S


def union_all(dfs: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)


# C10 -------------------------------------------------------------------------
def fk_violations(edges: list[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """``edges``: (name, child, fk column, parent, pk column).  Returns one row
    per dangling key value: fk_name, key, n_rows."""
    parts = []
    for name, child, fk, parent, pk in edges:
        keys = (child.filter(F.col(fk).isNotNull()).groupBy(fk)
                .agg(F.count(F.lit(1)).alias("n_rows")))
        parents = parent.select(F.col(pk).alias(fk))      # anti join: duplicates harmless
        parts.append(keys.join(parents, fk, "left_anti")
                     .select(F.lit(name).alias("fk_name"), F.col(fk).cast("long").alias("key"),
                             F.col("n_rows").cast("long")))
    return union_all(parts)


def domain_fk_edges(roles, users, customers, books, orders, order_items):
    return [
        ("users.role_id->roles", users, "role_id", roles, "role_id"),
        ("customers.user_id->users", customers, "user_id", users, "user_id"),
        ("orders.customer_id->customers", orders, "customer_id", customers, "customer_id"),
        ("order_items.order_id->orders", order_items, "order_id", orders, "order_id"),
        ("order_items.book_id->books", order_items, "book_id", books, "book_id"),
    ]


# G1 --------------------------------------------------------------------------
def reserved_name() -> Column:
    """True for the reserved login (exact, case-sensitive); NULL-safe."""
    return F.col("username").eqNullSafe(S.RESERVED_USERNAME)


def reject_reserved_user(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split inserts into valid rows and rejects (with a reason)."""
    bad = reserved_name()
    valid = requests.filter(~bad)
    rejects = requests.filter(bad).withColumn("reason", F.lit("reserved username"))
    return valid, rejects


def reserved_user_report(requests: DataFrame) -> DataFrame:
    bad = reserved_name()
    return requests.select("seq", "username", (~bad).alias("accepted"),
                           F.when(bad, F.lit("reserved username")).alias("reason"))


# G2 --------------------------------------------------------------------------
def rule_checks(table: str, columns: list[str]) -> list[tuple[str, Column]]:
    """(rule name, broken?) for the columns of one domain table, from the
    schema module."""
    rules = []
    for c in S.NOT_NULL.get(table, []):
        rules.append((c, f"{c}_null", F.col(c).isNull()))
    for c, n in S.MAX_LEN.get(table, {}).items():
        rules.append((c, f"{c}_too_long", F.coalesce(F.length(F.col(c)) > n, F.lit(False))))
    jc = S.JSON_COLUMNS.get(table)
    if jc:
        rules.append((jc, f"{jc}_not_json",
                      F.col(jc).isNotNull() & F.try_parse_json(F.col(jc)).isNull()))
    return [(name, cond) for c, name, cond in rules if c in columns]


def constraint_violations(table: str, df: DataFrame, key: str) -> DataFrame:
    """One row per (row, broken rule): table_name, key, rule."""
    rules = rule_checks(table, df.columns)
    broken = F.filter(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules]),
                      lambda x: x.isNotNull())
    return (df.select(F.col(key).cast("long").alias("key"), broken.alias("_rules"))
            .filter(F.size("_rules") > 0)
            .select(F.lit(table).alias("table_name"), "key", F.explode("_rules").alias("rule")))


def split_by_rules(table: str, df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows breaking no rule, and rows breaking at least one (with the
    array of broken rule names in ``broken_rules``) — one pass, no join."""
    rules = rule_checks(table, df.columns)
    if not rules:
        return df, df.limit(0).withColumn("broken_rules", F.array().cast("array<string>"))
    broken = F.filter(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules]),
                      lambda x: x.isNotNull())
    tagged = df.withColumn("broken_rules", broken)
    return (tagged.filter(F.size("broken_rules") == 0).drop("broken_rules"),
            tagged.filter(F.size("broken_rules") > 0))


# G3 --------------------------------------------------------------------------
def duplicate_keys(table: str, df: DataFrame, key: str) -> DataFrame:
    """Non-NULL key values that occur more than once (NULLs may repeat)."""
    return (df.filter(F.col(key).isNotNull()).groupBy(key)
            .agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > 1)
            .select(F.lit(table).alias("table_name"), F.lit(key).alias("key_name"),
                    F.col(key).cast("string").alias("key_value"), F.col("n").cast("long")))
