"""Batches in which one key may be changed several times.

The one-row procedures apply every call to what the call before left.  Here a
request is a function on the row: per column it sets a value or keeps what is
there.  Such functions compose (the later set value wins, column by column), and
composing is associative, so all requests of a key fold into one change in a
grouped aggregate: ``max_by(value, position)`` over the requests that set the
column.  Partial folds run before the shuffle, so a key with a third of all
requests costs one row per map task, and the snapshot is joined with one change
per key.

Position in a batch: ``seq``, a NULL one after all numbers, ties by the other
columns.  Only requests that break a rule go to rejects; there are no duplicates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.joins import left_join_spread, restrict_to
from .snapshots import (CONTACT_FIELDS, Applied, discounted, resolved_contacts, set_where_matched,
                        split_by_reason, union_all)


def position(requests: DataFrame, seq: str = "seq") -> Column:
    """When a request is applied: larger is later."""
    return F.struct(F.col(seq).isNull().alias("no_seq"), F.col(seq),
                    *[F.col(c) for c in requests.columns if c != seq])


def fold(requests: DataFrame, key: str, overwrite: tuple[str, ...] = (), keep_null: tuple[str, ...] = ()) -> DataFrame:
    """One change per key: ``key`` and a column ``_new_<c>`` for each column.
    ``overwrite`` columns are set by every request, NULL or not; a NULL in a
    ``keep_null`` column sets nothing."""
    at = position(requests)
    # one array slot, so that an overwritten NULL is a value
    last = [F.max_by(F.array(F.col(c)), at).getItem(0).alias(f"_new_{c}") for c in overwrite]
    last += [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), at)).alias(f"_new_{c}") for c in keep_null]
    return requests.groupBy(key).agg(*last)


def _known(current: DataFrame, requests: DataFrame, key: str):
    """Requests whose key the table has, and the refused ones."""
    known = restrict_to(current.select(key), requests, key).distinct().withColumn("_known", F.lit(True))
    reason = F.when(F.col(key).isNull(), F.lit("key missing")).when(F.col("_known").isNull(), F.lit("not found"))
    ok, rej = split_by_reason(requests.join(known, key, "left"), reason, ["seq", key])
    return ok.select(*requests.columns), rej


def update_books(books: DataFrame, requests: DataFrame) -> Applied:
    """F5 in turn: UpdateBook(id, price, stock); a NULL overwrites, so the
    last request of a book decides both columns."""
    ok, rej = _known(books, requests.select("seq", "book_id", F.col("price").cast(S.PRICE).alias("price"),
                                            F.col("stock").cast("long").alias("stock")), "book_id")
    changes = fold(ok, "book_id", overwrite=("price", "stock"))
    return Applied(set_where_matched(books, changes, "book_id", {c: F.col(f"_new_{c}") for c in ("price", "stock")},
                                     keep_null=False), rej)


def update_order_status(orders: DataFrame, requests: DataFrame) -> Applied:
    """F6 / I15 in turn: the last status requested for an order stays."""
    ok, rej = _known(orders, requests.select("seq", "order_id", "status"), "order_id")
    changes = fold(ok, "order_id", overwrite=("status",))
    return Applied(set_where_matched(orders, changes, "order_id", {"status": F.col("_new_status")}, keep_null=False), rej)


EDIT_FIELDS = ("title", "author", "price", "stock", "category")


def product_edit(books: DataFrame, requests: DataFrame) -> Applied:
    """I10 in turn: each edit sets the columns that it names (NULL keeps); the
    discounted price follows the final price of an edited book."""
    named = requests.select("seq", "book_id", *[F.col(f"new_{c}").alias(c) for c in EDIT_FIELDS])
    ok, rej = _known(books, named, "book_id")
    values = {c: F.col(f"_new_{c}") for c in EDIT_FIELDS}
    values["price_after_discount"] = discounted(F.coalesce(F.col("_new_price"), F.col("price")), F.col("discount_percent"))
    snap = set_where_matched(books, fold(ok, "book_id", keep_null=EDIT_FIELDS), "book_id", values, keep_null=True)
    return Applied(snap, rej)


def contact_update(users: DataFrame, customers: DataFrame, requests: DataFrame) -> Applied:
    """I18 in turn: each request sets the fields that it names (NULL keeps).
    An e-mail that another customer has at the start of the batch, or was the
    first to take in the batch, is refused together with its request; one that
    is given up during the batch becomes free for the next batch."""
    keys = ["seq", "username"]
    ok, rej = resolved_contacts(users, customers, requests, keys)
    at = F.struct(F.col("seq").isNull().alias("no_seq"), F.col("seq"), F.col("customer_id"))
    taker = (ok.filter(F.col("new_email").isNotNull()).groupBy("new_email")
             .agg(F.min_by("customer_id", at).alias("_taker")))
    raced, lost = split_by_reason(left_join_spread(ok, taker, "new_email"),
                                  F.when(F.col("_taker") != F.col("customer_id"), F.lit("email exists")), keys)
    named = raced.select("seq", "customer_id", *[F.col(f"new_{c}").alias(c) for c in CONTACT_FIELDS])
    snap = set_where_matched(customers, fold(named, "customer_id", keep_null=CONTACT_FIELDS), "customer_id",
                             {c: F.col(f"_new_{c}") for c in CONTACT_FIELDS}, keep_null=True)
    return Applied(snap, union_all([rej, lost]))


def toggle_status(users: DataFrame, requests: DataFrame) -> Applied:
    """I17 in turn without its audit rows (``audit.captured`` writes those from
    the snapshots): the last status requested for a user stays."""
    ok, rej = _known(users, requests.select("seq", "user_id", F.col("new_status").alias("status")), "user_id")
    changes = fold(ok, "user_id", overwrite=("status",))
    return Applied(set_where_matched(users, changes, "user_id", {"status": F.col("_new_status")}, keep_null=False), rej)
