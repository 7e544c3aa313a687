"""The adapter's domain views carry the declared domain schemas (names and
types), so snapshot jobs and stored snapshots are interchangeable."""

import pytest

from quire import schemas as S
from quire.sources.adapter import Domain

DECLARED = {
    "roles": S.ROLES_SCHEMA, "users": S.USERS_SCHEMA, "customers": S.CUSTOMERS_SCHEMA,
    "books": S.BOOKS_SCHEMA, "orders": S.ORDERS_SCHEMA, "audit_log": S.AUDIT_SCHEMA,
}


@pytest.mark.parametrize("table", sorted(DECLARED))
def test_view_matches_declared_schema(spark, small_dir, table):
    view = getattr(Domain(spark, small_dir), table)
    got = [(f.name, f.dataType) for f in view.schema.fields]
    want = [(f.name, f.dataType) for f in DECLARED[table].fields]
    assert got == want


def test_order_items_view_is_the_declared_schema_without_item_id(spark, small_dir):
    view = Domain(spark, small_dir).order_items
    want = [(f.name, f.dataType) for f in S.ORDER_ITEMS_SCHEMA.fields if f.name != "order_item_id"]
    assert [(f.name, f.dataType) for f in view.schema.fields] == want
