"""A batch with distinct keys gives the same snapshot as the same requests
applied one call at a time (the one-row procedure is the one-row batch)."""

from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quire import schemas as S
from quire.operators import snapshots as ops

SETTINGS = dict(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))


def now():
    return F.lit("2025-01-01 00:00:00").cast(S.TS)


def books_df(spark):
    rows = [(i, None, f"T{i}", "A", Decimal("10.00"), i, "C", None, None, None, None, None, 0)
            for i in range(1, 7)]
    return spark.createDataFrame(rows, S.BOOKS_SCHEMA)


@settings(**SETTINGS)
@given(ids=st.lists(st.integers(1, 8), min_size=1, max_size=4, unique=True),
       stock=st.one_of(st.none(), st.integers(0, 50)))
def test_update_books_batch_equals_single_calls(spark, ids, stock):
    ddl = "seq long, book_id long, price decimal(10,2), stock long"
    rows = [(k, b, Decimal(f"{b}.50"), stock) for k, b in enumerate(ids)]
    batch = ops.update_books(books_df(spark), spark.createDataFrame(rows, ddl)).snapshot
    seq = books_df(spark)
    for r in rows:
        seq = ops.update_books(seq, spark.createDataFrame([r], ddl)).snapshot
    assert sorted(batch.collect()) == sorted(seq.collect())


@settings(**SETTINGS)
@given(names=st.lists(st.sampled_from(["a", "b", "c", "d", "ivan", "admin"]), min_size=1,
                      max_size=4, unique=True))
def test_add_users_batch_equals_single_calls(spark, names):
    users = spark.createDataFrame([(1, "ivan", "h", 1, "ACTIVE", None)], S.USERS_SCHEMA)
    roles = spark.createDataFrame(S.ROLES, S.ROLES_SCHEMA)
    ddl = "seq long, username string, password_hash string, role_name string"
    rows = [(k, n, "h", S.ROLE_SELLER) for k, n in enumerate(names)]
    batch = ops.add_users(users, roles, spark.createDataFrame(rows, ddl), now()).snapshot
    seq = users
    for r in rows:
        seq = ops.add_users(seq, roles, spark.createDataFrame([r], ddl), now()).snapshot
    assert sorted(batch.collect()) == sorted(seq.collect())
