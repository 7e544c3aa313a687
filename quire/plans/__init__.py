"""Named queries: each key pairs a Spark builder ``(spark, sf_dir) -> DataFrame``
with the equivalent DuckDB SQL over the same raw tables (None when the
result is random or not expressible in SQL; those get property tests)."""

from __future__ import annotations

import importlib
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ..sources.adapter import Domain, with_adapter


@dataclass(frozen=True)
class NamedQuery:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, NamedQuery] = {}

# Money is computed in exact decimals throughout; registered outputs present
# it as DOUBLE (converted once, at the end) so that the result compares the
# same through any client conversion (DuckDB hands DECIMAL to pandas as
# float64, Spark as Decimal objects).  Per key, the presented columns:
MONEY_COLUMNS: dict[str, tuple[str, ...]] = {
    "popular_products": ("revenue",), "order_lines": ("price", "subtotal"),
    "sales_by_title": ("revenue",), "order_totals": ("lines_total",),
    "first_rows": ("price", "discount_percent", "price_after_discount"),
    "receipt": ("price", "subtotal", "lines_total", "total_amount", "difference"),
    "order_details": ("price", "subtotal", "lines_total", "total_amount", "difference"),
    "my_history": ("total_amount",), "client_dossier": ("spend",),
    "scan_books": ("price", "discount_percent", "price_after_discount"),
    "browse_catalog": ("price",), "search_author": ("price",), "search_category": ("price",),
    "filter_author": ("price", "discount_percent", "price_after_discount"),
    "search_books": ("price",), "search_books_all": ("price",), "search_books_keyword": ("price",),
    "orders_of_customer": ("total_amount",),
    "add_books": ("price", "discount_percent", "price_after_discount"),
    "product_add_validated": ("price", "discount_percent", "price_after_discount"),
    "update_books": ("price", "discount_percent", "price_after_discount"),
    "product_edit": ("price", "discount_percent", "price_after_discount"),
    "update_order_status": ("total_amount",),
    "recategorise": ("price", "discount_percent", "price_after_discount"),
    "delete_books": ("price", "discount_percent", "price_after_discount"),
    "product_delete": ("price", "discount_percent", "price_after_discount"),
    "add_to_cart": ("price",), "place_orders": ("total_amount",),
    "order_create": ("total_amount",), "order_add_items": ("total_amount",),
    "order_remove_items": ("total_amount",), "buy_auto": ("price",), "csv_import": ("price",),
    "json_import_typed": ("price", "discount_percent", "price_after_discount"),
    "json_import_raw": ("price",), "json_export": ("price",),
    "json_import_compact": ("price", "discount_percent", "price_after_discount"),
    "json_import_rejects": ("price",), "csv_import_rejects": ("price",), "place_orders_lines": ("price",),
    "gen_catalog_basic": ("price",),
    "update_books_in_turn": ("price", "discount_percent", "price_after_discount"),
    **{f"{k}_lines": ("price",) for k in ("order_add_items", "order_remove_items", "buy_auto", "place_orders_all",
                                          "place_orders_twice")},
    **{k: ("total_amount",) for k in ("order_add_items_orders", "order_remove_items_orders", "buy_auto_orders",
                                      "place_orders_twice")},
    "json_import_split": ("price", "discount_percent", "price_after_discount"),
    "json_export_array": ("price", "discount_percent", "price_after_discount"),
    "book_sales_rollup": ("amount",), "sales_by_title_rollup": ("revenue",), "popular_products_rollup": ("revenue",),
    "search_author_indexed": ("price",), "search_books_indexed": ("price",),
    "author_layout_lookup": ("price", "discount_percent", "price_after_discount"),
    "isbn_layout_lookup": ("price", "discount_percent", "price_after_discount"),
    "version_diff": ("price", "discount_percent", "price_after_discount"),
    "recategorise_touched": ("price", "discount_percent", "price_after_discount"),
    "update_books_touched": ("price", "discount_percent", "price_after_discount"),
    "product_edit_in_turn": ("price", "discount_percent", "price_after_discount"),
    "gen_catalog_words": ("price", "discount_percent", "price_after_discount"),
}


def present(df: DataFrame) -> DataFrame:
    """Cast decimal output columns to DOUBLE (last step; order kept)."""
    if not any(isinstance(f.dataType, DecimalType) for f in df.schema.fields):
        return df
    return df.select(*[F.col(f.name).cast("double").alias(f.name)
                       if isinstance(f.dataType, DecimalType) else F.col(f.name)
                       for f in df.schema.fields])


def present_sql(name: str, sql: str) -> str:
    cols = MONEY_COLUMNS.get(name)
    if not cols:
        return sql
    casts = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({casts}) FROM (\n{sql}\n) presented"


def register(name: str, sql: str | None, extra_ctes: str = ""):
    """Register ``fn(dom: Domain) -> DataFrame`` under ``name``; ``sql`` is
    the oracle query body, prefixed with the adapter views."""
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        full = present_sql(name, with_adapter(sql, extra_ctes)) if sql is not None else None

        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            return present(fn(Domain(spark, sf_dir)))
        build.__name__ = f"q_{name}"
        build.__doc__ = fn.__doc__
        REGISTRY[name] = NamedQuery(name, build, full)
        return fn
    return deco


_MODULES = ("sales", "catalog", "accounts", "quality", "snapshots", "in_turn", "identity", "rollups", "outcomes", "changes", "files", "layout")


def load_all() -> dict[str, NamedQuery]:
    for m in _MODULES:
        try:
            importlib.import_module(f"{__name__}.{m}")
        except ModuleNotFoundError as e:
            if e.name != f"{__name__}.{m}":
                raise
    return REGISTRY
