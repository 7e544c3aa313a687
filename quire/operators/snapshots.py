"""Row-change procedures re-aimed as whole-table snapshot transforms.

Pattern: ``apply(current, requests) -> Applied(snapshot, rejects, added)``.
Parquet tables have no UPDATE/DELETE, so every change is a join that writes
a new snapshot; a job publishes it to a new version path.

Batch rules (the same for every job):
* requests that break a rule are refused first; of those that are left the
  lowest ``seq`` of a key wins, later ones are rejected with reason
  ``duplicate request`` (a batch sees the snapshot as of its start, not its own
  earlier rows; ``in_turn`` has the jobs that apply all changes of a key);
* new ids follow ``seq`` order and start after the current maximum (F2);
* "now" is a parameter, so a re-run produces the same rows.

Scale: each check is a boolean flag from a left join against the lookup
table restricted to the request keys (``flag_present``: the large table is
streamed against the key set, which AQE broadcasts when it is small), and
one ``reason`` column splits accepted rows from rejects, so a job's plan
grows linearly with its checks.  The snapshot itself is rewritten with one
join on its key (``set_where_matched``, changes on the broadcastable right
side).  Lines are reduced per key before they meet orders or books.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions.ids import assign_ids, max_ids
from ..functions.joins import dealt, hashed, left_join_spread, parts_for, restrict_to
from ..functions.text import is_open_order, password_hash, starts_with
from .accounts import first_by_seq, roles_dim
from .quality import reserved_name

@dataclass
class Applied:
    """Result of a change job.  ``snapshot``: the new table; ``rejects``:
    refused requests with a ``reason``; ``added``: the new rows.  Jobs that
    change a second table return it too (``customers`` for registrations,
    ``order_items`` for line changes, ``new_orders`` and ``lines`` for
    purchases)."""
    snapshot: DataFrame | None
    rejects: DataFrame
    added: DataFrame | None = None
    customers: DataFrame | None = None
    order_items: DataFrame | None = None
    new_orders: DataFrame | None = None
    lines: DataFrame | None = None


# ---------------------------------------------------------------------------
# helpers
# ---------------------------------------------------------------------------
def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns in schema order and type; absent columns become NULL."""
    cols = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in cols else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema.fields])


def apply_defaults(df: DataFrame, table: str, now: Column) -> DataFrame:
    """DEFAULT values for columns *absent* from the insert; a column
    given as NULL stays NULL."""
    for col, v in S.DEFAULTS.get(table, {}).items():
        if col not in df.columns:
            df = df.withColumn(col, now if v == "now" else F.lit(v))
    return df


def rejected(df: DataFrame, reason: str, key_cols: list[str]) -> DataFrame:
    return df.select(*[F.col(c) for c in key_cols], F.lit(reason).alias("reason"))


def union_all(dfs: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def dedupe(requests: DataFrame, key, key_cols: list[str]):
    """First request per key (lowest seq); later ones are duplicates and a
    request without a key is refused as such."""
    keys = [key] if isinstance(key, str) else list(key)
    has_key = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    winners, losers = first_by_seq(requests.filter(has_key), key)
    return winners, union_all([rejected(losers, "duplicate request", key_cols),
                               rejected(requests.filter(~has_key), "key missing", key_cols)])


def flag_present(df: DataFrame, lookup: DataFrame, on, flag: str,
                 keys_from: DataFrame) -> DataFrame:
    """Add a boolean ``flag``: does ``lookup`` hold the row's key?

    The lookup is first restricted to the keys of ``keys_from`` (the
    original request table), so the large table is streamed against a
    broadcastable key set, and chaining several flags keeps the plan linear
    (each check reads the base requests once instead of the previous
    check's output)."""
    cols = [on] if isinstance(on, str) else list(on)
    hits = (restrict_to(lookup.select(*cols), keys_from, cols).distinct()
            .withColumn(flag, F.lit(True)))
    return (df.join(hits, cols, "left")
              .withColumn(flag, F.coalesce(F.col(flag), F.lit(False))))


def split_by_reason(df: DataFrame, reason: Column, key_cols: list[str]):
    """``reason`` is NULL for accepted rows: (accepted rows, rejects)."""
    tagged = df.withColumn("_reason", reason)
    ok = tagged.filter(F.col("_reason").isNull()).drop("_reason")
    rej = tagged.filter(F.col("_reason").isNotNull()).select(
        *[F.col(c) for c in key_cols], F.col("_reason").alias("reason"))
    return ok, rej


def set_where_matched(current: DataFrame, changes: DataFrame, key: str,
                      new_values: dict[str, Column], keep_null: bool) -> DataFrame:
    """UPDATE current SET col = new WHERE key matches.

    ``changes`` carries ``key`` and one ``_new_<col>`` column per updated
    column.  With ``keep_null`` a NULL new value keeps the old one
    (partial edit); otherwise a NULL overwrites (plain UPDATE).  Matching
    is by key presence (a marker column), never by NULL tests on values."""
    c = changes.withColumn("_hit", F.lit(True))
    j = current.join(c, key, "left")
    out = []
    for f in current.columns:
        if f in new_values:
            new = new_values[f]
            if keep_null:
                out.append(F.when(F.col("_hit") & new.isNotNull(), new).otherwise(F.col(f)).alias(f))
            else:
                out.append(F.when(F.col("_hit"), new).otherwise(F.col(f)).alias(f))
        else:
            out.append(F.col(f))
    return j.select(*out)


def lines_total(order_items: DataFrame) -> DataFrame:
    return (order_items.filter(F.col("order_id").isNotNull()).groupBy("order_id")
            .agg(F.sum(F.col("qty") * F.col("price")).alias("_t")))


# ---------------------------------------------------------------------------
# F2 / F13
# ---------------------------------------------------------------------------
def assign_new_ids(new_rows: DataFrame, current: DataFrame, id_col: str,
                   order_cols=("seq",)) -> DataFrame:
    return assign_ids(new_rows, list(order_cols), id_col, base_from=(current, id_col))


def line_columns(order_items: DataFrame) -> list[str]:
    """The line table's columns; ``order_item_id`` only where it has one."""
    return [f.name for f in S.ORDER_ITEMS_SCHEMA.fields if f.name != "order_item_id" or f.name in order_items.columns]


def with_item_ids(lines: DataFrame, order_items: DataFrame | None) -> DataFrame:
    """New lines numbered in request order after the line table's last
    ``order_item_id``; a table without that column leaves them as they are."""
    if order_items is None or "order_item_id" not in order_items.columns:
        return lines
    return assign_new_ids(lines, order_items, "order_item_id",
                          [c for c in ("seq", "order_id", "book_id", "qty") if c in lines.columns])


# ---------------------------------------------------------------------------
# Users and roles, insert if absent
# ---------------------------------------------------------------------------
def add_users(users: DataFrame, roles: DataFrame, requests: DataFrame, now: Column) -> Applied:
    """AddUser for a batch: the role must resolve, the reserved name is
    refused, existing usernames are skipped (in that order of reasons)."""
    keys = ["seq", "username"]
    w = requests.join(roles_dim(roles), "role_name", "left")
    w = flag_present(w, users, "username", "_exists", keys_from=requests)
    reason = (F.when(F.col("username").isNull(), F.lit("key missing"))
              .when(F.col("role_id").isNull(), F.lit("unknown role"))
              .when(reserved_name(), F.lit("reserved username"))
              .when(F.col("_exists"), F.lit("exists")))
    ok, rej = split_by_reason(w, reason, keys)
    ok, dups = dedupe(ok.drop("_exists"), "username", keys)
    new = assign_new_ids(ok, users, "user_id")
    added = conform(apply_defaults(new.select("user_id", "username", "password_hash", "role_id"),
                                   "users", now), S.USERS_SCHEMA)
    return Applied(users.unionByName(added), union_all([dups, rej]), added)


def add_roles(roles: DataFrame, requests: DataFrame) -> Applied:
    """AddRole for a batch: NULL names refused, existing names skipped."""
    keys = ["seq", "role_name"]
    null_name = rejected(requests.filter(F.col("role_name").isNull()), "role_name null", keys)
    winners, dups = dedupe(requests.filter(F.col("role_name").isNotNull()), "role_name", keys)
    w = flag_present(winners, roles, "role_name", "_exists", keys_from=requests)
    ok, rej = split_by_reason(w, F.when(F.col("_exists"), F.lit("exists")), keys)
    new = assign_new_ids(ok, roles, "role_id")
    added = new.select(F.col("role_id").cast("long"), "role_name")
    return Applied(roles.unionByName(added), union_all([null_name, dups, rej]), added)


# ---------------------------------------------------------------------------
# Client registration
# ---------------------------------------------------------------------------
def register_clients(users: DataFrame, customers: DataFrame, roles: DataFrame,
                     requests: DataFrame, now: Column) -> Applied:
    """Register(username, hash, full_name, email) for a batch.  Creates a
    user with the Customer role and a profile.  Refused, in this order: the
    reserved name, a taken username, a taken email (email is UNIQUE on
    profiles), a missing Customer role; then all but the first request per
    username; of several of the rest with one email only the first is kept."""
    keys = ["seq", "username"]
    w = flag_present(requests, users, "username", "_exists", keys_from=requests)
    w = flag_present(w, customers.filter(F.col("email").isNotNull()), "email", "_email_taken",
                     keys_from=requests)
    # every registration asks for the Customer role (an equi-join on the
    # constant name against the broadcast role table)
    w = (w.drop("role_id", "role_name").withColumn("role_name", F.lit(S.ROLE_CUSTOMER))
         .join(roles_dim(roles), "role_name", "left").drop("role_name"))
    reason = (F.when(F.col("username").isNull(), F.lit("key missing"))
              .when(reserved_name(), F.lit("reserved username"))
              .when(F.col("_exists"), F.lit("exists"))
              .when(F.col("_email_taken"), F.lit("email exists"))
              .when(F.col("role_id").isNull(), F.lit("role missing")))
    ok, rej = split_by_reason(w, reason, keys)
    ok, dups = dedupe(ok.drop("_exists", "_email_taken"), "username", keys)
    email_first, email_dups = first_by_seq(ok.filter(F.col("email").isNotNull()), "email")
    ok = email_first.unionByName(ok.filter(F.col("email").isNull()))
    ranked = assign_ids(ok, ["seq"], "_rank", base=0)
    base_u, base_c = max_ids([(users, "user_id"), (customers, "customer_id")])
    ranked = (ranked.withColumn("user_id", F.col("_rank") + F.lit(base_u))
                    .withColumn("customer_id", F.col("_rank") + F.lit(base_c)))
    new_users = conform(apply_defaults(ranked.select("user_id", "username", "password_hash",
                                                     "role_id"), "users", now), S.USERS_SCHEMA)
    phone = ["phone"] if "phone" in ranked.columns else []
    new_customers = conform(apply_defaults(
        ranked.select("customer_id", "user_id", "full_name", "email", *phone), "customers", now),
        S.CUSTOMERS_SCHEMA)
    added = ranked.select("user_id", "customer_id", "username", "role_id", "full_name", "email",
                          *phone)
    rejects = union_all([dups, rej, rejected(email_dups, "email exists", keys)])
    return Applied(users.unionByName(new_users), rejects, added,
                   customers=customers.unionByName(new_customers))


EMAIL_RULE = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"
PHONE_RULE = r"^\+?[0-9][0-9 -]{6,19}$"


def customer_add_validated(users: DataFrame, customers: DataFrame, roles: DataFrame,
                           requests: DataFrame, now: Column) -> Applied:
    """Registration with a plain password (stored hashed) and our own
    email / phone rules (the application's rules are not visible)."""
    keys = ["seq", "username"]
    bad_email = ~F.coalesce(F.col("email").rlike(EMAIL_RULE), F.lit(False))
    bad_phone = F.col("phone").isNotNull() & ~F.col("phone").rlike(PHONE_RULE)
    r1 = rejected(requests.filter(bad_email), "bad email", keys)
    r2 = rejected(requests.filter(~bad_email & bad_phone), "bad phone", keys)
    good = (requests.filter(~bad_email & ~bad_phone)
            .withColumn("password_hash", password_hash(F.col("password"))).drop("password"))
    reg = register_clients(users, customers, roles, good, now)
    reg.rejects = union_all([r1, r2, reg.rejects])
    return reg


# ---------------------------------------------------------------------------
# MERGE INTO users
# ---------------------------------------------------------------------------
def upsert_users(users: DataFrame, requests: DataFrame, now: Column) -> Applied:
    """Matched usernames get role_id and status from the request; others
    are inserted (through the reserved-name rule)."""
    keys = ["seq", "username"]
    w = flag_present(requests, users, "username", "_exists", keys_from=requests)
    ok, rej = split_by_reason(w, F.when(~F.col("_exists") & reserved_name(), F.lit("reserved username")), keys)
    w, dups = dedupe(ok, "username", keys)
    changes = w.filter(F.col("_exists")).select(
        "username", F.col("role_id").alias("_new_role_id"), F.col("status").alias("_new_status"))
    updated = set_where_matched(users, changes, "username",
                                {"role_id": F.col("_new_role_id"), "status": F.col("_new_status")},
                                keep_null=False)
    inserts = assign_new_ids(w.filter(~F.col("_exists")), users, "user_id")
    added = conform(apply_defaults(inserts.select("user_id", "username", "password_hash",
                                                  "role_id", "status"), "users", now),
                    S.USERS_SCHEMA)
    return Applied(updated.unionByName(added), union_all([dups, rej]), added)


# ---------------------------------------------------------------------------
# Catalogue add
# ---------------------------------------------------------------------------
def add_books(books: DataFrame, requests: DataFrame, now: Column) -> Applied:
    """AddBook for a batch: no validation, ids in seq order, defaults."""
    new = assign_new_ids(requests, books, "book_id")
    cols = [c for c in requests.columns if c in S.BOOKS_SCHEMA.fieldNames()]
    added = conform(apply_defaults(new.select("book_id", *cols), "books", now), S.BOOKS_SCHEMA)
    empty = rejected(requests.limit(0), "none", ["seq"])
    return Applied(books.unionByName(added), empty, added)


def product_add_validated(books: DataFrame, requests: DataFrame, now: Column) -> Applied:
    """Title present, price > 0, stock >= 0, isbn not in the catalogue and
    not earlier in the batch; the rest is added like F4."""
    keys = ["seq", "isbn"]
    w = flag_present(requests, books.filter(F.col("isbn").isNotNull()), "isbn", "_seen",
                     keys_from=requests)
    reason = (F.when(F.col("title").isNull() | (F.trim(F.col("title")) == ""), F.lit("title missing"))
              .when(~F.coalesce(F.col("price") > 0, F.lit(False)), F.lit("bad price"))
              .when(~F.coalesce(F.col("stock") >= 0, F.lit(False)), F.lit("bad stock"))
              .when(F.col("_seen"), F.lit("isbn exists")))
    ok, rej = split_by_reason(w, reason, keys)
    with_isbn, dups = first_by_seq(ok.filter(F.col("isbn").isNotNull()), "isbn")
    ok = with_isbn.unionByName(ok.filter(F.col("isbn").isNull())).drop("_seen")
    res = add_books(books, ok, now)
    res.rejects = union_all([rej, rejected(dups, "isbn exists", keys)])
    return res


# ---------------------------------------------------------------------------
# price/stock update and partial edit
# ---------------------------------------------------------------------------
def update_books(books: DataFrame, requests: DataFrame) -> Applied:
    """UpdateBook(id, price, stock): a NULL in the request overwrites."""
    keys = ["seq", "book_id"]
    winners, dups = dedupe(requests, "book_id", keys)
    missing = rejected(winners.join(restrict_to(books.select("book_id"), requests, "book_id"),
                                    "book_id", "left_anti"), "not found", keys)
    ch = winners.select("book_id", F.col("price").cast(S.PRICE).alias("_new_price"),
                        F.col("stock").cast("long").alias("_new_stock"))
    snap = set_where_matched(books, ch, "book_id",
                             {"price": F.col("_new_price"), "stock": F.col("_new_stock")},
                             keep_null=False)
    return Applied(snap, union_all([dups, missing]))


def discounted(price: Column, discount: Column) -> Column:
    return (price * (F.lit(100) - discount) * F.lit(0.01).cast("decimal(2,2)")).cast(S.PRICE)


def product_edit(books: DataFrame, requests: DataFrame) -> Applied:
    """NULL keeps the old value; price_after_discount is recomputed
    from the (new) price and the book's discount."""
    keys = ["seq", "book_id"]
    winners, dups = dedupe(requests, "book_id", keys)
    missing = rejected(winners.join(restrict_to(books.select("book_id"), requests, "book_id"),
                                    "book_id", "left_anti"), "not found", keys)
    ch = winners.select("book_id",
                        *[F.col(f"new_{c}").alias(f"_new_{c}")
                          for c in ("title", "author", "price", "stock", "category")])
    values = {c: F.col(f"_new_{c}") for c in ("title", "author", "price", "stock", "category")}
    # edited rows get the discounted price recomputed from their new price
    # (a book without a discount keeps its stored value: NULL keeps)
    values["price_after_discount"] = discounted(
        F.coalesce(F.col("_new_price"), F.col("price")), F.col("discount_percent"))
    snap = set_where_matched(books, ch, "book_id", values, keep_null=True)
    return Applied(conform(snap, S.BOOKS_SCHEMA), union_all([dups, missing]))


# ---------------------------------------------------------------------------
# Order status
# ---------------------------------------------------------------------------
def update_order_status(orders: DataFrame, requests: DataFrame) -> Applied:
    keys = ["seq", "order_id"]
    winners, dups = dedupe(requests, "order_id", keys)
    missing = rejected(winners.join(restrict_to(orders.select("order_id"), requests, "order_id"),
                                    "order_id", "left_anti"), "not found", keys)
    ch = winners.select("order_id", F.col("status").alias("_new_status"))
    snap = set_where_matched(orders, ch, "order_id", {"status": F.col("_new_status")},
                             keep_null=False)
    return Applied(snap, union_all([dups, missing]))


# ---------------------------------------------------------------------------
# bulk update by predicate
# ---------------------------------------------------------------------------
def recategorise(books: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """UPDATE books SET category = new WHERE category = old, for a small
    literal mapping: a projection, no join and no shuffle."""
    expr = None
    for old, new in mapping.items():
        expr = (F.when(F.col("category") == old, F.lit(new)) if expr is None
                else expr.when(F.col("category") == old, F.lit(new)))
    if expr is None:
        return books
    return books.withColumn("category", expr.otherwise(F.col("category")))


def recategorise_by_table(books: DataFrame, mapping: DataFrame) -> DataFrame:
    """The same for a mapping table (old_category, new_category): one left
    join on category.  No broadcast hint: the mapping's size is not known
    in advance, so AQE broadcasts it only when its measured size is small.
    Several rows for one old category are not allowed (the first new name
    by value is used, so the result never multiplies books)."""
    m = (mapping.groupBy("old_category").agg(F.min("new_category").alias("_new"))
         .withColumnRenamed("old_category", "category"))
    j = books.join(m, "category", "left")
    return j.select(*[F.coalesce(F.col("_new"), F.col("category")).alias("category")
                      if c == "category" else F.col(c) for c in books.columns])


# ---------------------------------------------------------------------------
# deletes
# ---------------------------------------------------------------------------
def delete_by_key(current: DataFrame, key: str, requests: DataFrame,
                  referencing: list[tuple[DataFrame, str]]) -> Applied:
    """DELETE by key; a key still referenced by a child table is refused
    (the foreign key has no cascade), an unknown key is reported.  Each
    check streams its table against the requested keys (flag_present)."""
    keys = requests.select(key).distinct()
    w = flag_present(keys, current, key, "_present", keys_from=keys)
    reason = F.when(~F.col("_present"), F.lit("not found"))
    for i, (child, fk) in enumerate(referencing):
        w = flag_present(w, child.select(F.col(fk).alias(key)), key, f"_ref{i}", keys_from=keys)
        reason = reason.when(F.col(f"_ref{i}"), F.lit("referenced"))
    deletable, rej = split_by_reason(w, reason, [key])
    deletable = deletable.select(key)
    return Applied(current.join(deletable, key, "left_anti"), rej, deletable)


@dataclass
class Cascade:
    customers: DataFrame
    orders: DataFrame
    order_items: DataFrame
    deleted: DataFrame


def cascade_delete(customers: DataFrame, orders: DataFrame, order_items: DataFrame,
                   requests: DataFrame) -> Cascade:
    """Delete customers; ON DELETE CASCADE removes their orders and those
    orders' lines.  Each level is an anti join keyed on the previous level's
    deleted ids."""
    gone_c = restrict_to(customers.select("customer_id"), requests, "customer_id").distinct()
    gone_o = orders.select("order_id", "customer_id").join(gone_c, "customer_id", "left_semi") \
        .select("order_id")
    gone_i = (order_items.join(gone_o, "order_id", "left_semi")
              .groupBy("order_id").agg(F.count(F.lit(1)).alias("n_rows")))
    deleted = union_all([
        gone_c.select(F.lit("customers").alias("table_name"), F.col("customer_id").alias("key"),
                      F.lit(1).cast("long").alias("n_rows")),
        gone_o.select(F.lit("orders").alias("table_name"), F.col("order_id").alias("key"),
                      F.lit(1).cast("long").alias("n_rows")),
        gone_i.select(F.lit("order_items").alias("table_name"), F.col("order_id").alias("key"),
                      F.col("n_rows").cast("long")),
    ])
    return Cascade(customers.join(gone_c, "customer_id", "left_anti"),
                   orders.join(gone_o, "order_id", "left_anti"),
                   order_items.join(gone_o, "order_id", "left_anti"),
                   deleted)


# ---------------------------------------------------------------------------
# Product delete = hard delete or archive
# ---------------------------------------------------------------------------
def product_delete(books: DataFrame, order_items: DataFrame, requests: DataFrame) -> Applied:
    """A book no order line references is removed; a referenced one is
    archived (title prefix, stock 0, flag 1), since the line's foreign key
    would block the delete."""
    keys = requests.select("book_id").distinct()
    w = flag_present(keys, books, "book_id", "_present", keys_from=keys)
    w = flag_present(w, order_items, "book_id", "_sold", keys_from=keys)
    missing = rejected(w.filter(~F.col("_present")), "not found", ["book_id"])
    act = w.filter(F.col("_present")).select("book_id", "_sold")
    remove = act.filter(~F.col("_sold")).select("book_id")
    # one join on the catalogue: no match keeps the row, unsold drops it, sold archives it
    kept = books.join(act, "book_id", "left").filter(F.coalesce(F.col("_sold"), F.lit(True)))
    hit = F.coalesce(F.col("_sold"), F.lit(False))
    title = F.when(hit & ~F.coalesce(starts_with(F.col("title"), S.ARCHIVE_PREFIX), F.lit(False)),
                   F.concat_ws(" ", F.lit(S.ARCHIVE_PREFIX), F.col("title"))) \
        .otherwise(F.col("title"))
    snap = kept.select(*[
        title.alias(c) if c == "title" else
        F.when(hit, F.lit(0).cast("long")).otherwise(F.col(c)).alias(c) if c == "stock" else
        F.when(hit, F.lit(1)).otherwise(F.col(c)).alias(c) if c == "is_archived" else
        F.col(c) for c in books.columns])
    return Applied(snap, missing, remove)


# ---------------------------------------------------------------------------
# Carts and orders
# ---------------------------------------------------------------------------
def add_to_cart(books: DataFrame, requests: DataFrame, order_items: DataFrame | None = None) -> Applied:
    """AddToCart: the current price is captured; lines have no order yet.
    With ``order_items`` (all lines so far) the snapshot is the whole line
    table and new lines are numbered; without it the cart starts empty."""
    keys = ["seq", "book_id"]
    prices = restrict_to(books.select("book_id", "price"), requests, "book_id")
    lines = (requests.join(prices, "book_id")
             .select("seq", "customer_id", "book_id", F.col("qty").cast("long").alias("qty"),
                     "price", F.lit(None).cast("long").alias("order_id")))
    lines = with_item_ids(lines, order_items)
    missing = rejected(requests.join(prices, "book_id", "left_anti"), "book not found", keys)
    whole = lines if order_items is None else order_items.unionByName(lines.drop("seq"), allowMissingColumns=True)
    return Applied(whole, missing, lines)


def place_orders(orders: DataFrame, customers: DataFrame, cart: DataFrame, requests: DataFrame,
                 now: Column) -> Applied:
    """PlaceOrder per requested customer: one new open order each (empty
    cart → total 0).  ``cart`` may be the whole line table: only the customer's
    lines without an order move and are summed, lines placed before keep theirs."""
    keys = ["seq", "customer_id"]
    known = restrict_to(customers.select("customer_id"), requests, "customer_id")
    missing = rejected(requests.join(known, "customer_id", "left_anti"), "unknown customer", keys)
    who = (requests.join(known, "customer_id", "left_semi")
           .groupBy("customer_id").agg(F.min("seq").alias("seq")))
    if "order_id" not in cart.columns:
        cart = cart.withColumn("order_id", F.lit(None).cast("long"))
    per_cart = (cart.filter(F.col("order_id").isNull()).groupBy("customer_id")
                .agg(F.sum(F.col("qty") * F.col("price")).alias("_t")))
    new = assign_new_ids(who, orders, "order_id", order_cols=("seq", "customer_id"))
    new_orders = (new.join(per_cart, "customer_id", "left")
                  .select("order_id", "customer_id", now.alias("order_date"),
                          F.lit(S.ORDER_NEW).alias("status"),
                          F.coalesce(F.col("_t"), F.lit(0)).cast(S.TOTAL).alias("total_amount")))
    # the whole line table: open lines of these customers move, all others stay as they are
    target = new.select("customer_id", F.col("order_id").alias("_placed"))
    lines = (cart.join(target, "customer_id", "left")
             .withColumn("_moves", F.col("order_id").isNull() & F.col("_placed").isNotNull())
             .withColumn("order_id", F.coalesce("order_id", "_placed")))
    res = Applied(orders.unionByName(new_orders), missing, new_orders)
    res.order_items = lines.select(*cart.columns)
    res.lines = lines.filter("_moves").select(*cart.columns)
    return res


def order_create(orders: DataFrame, customers: DataFrame, requests: DataFrame,
                 now: Column) -> Applied:
    """An empty open order per request (unknown customers refused)."""
    keys = ["seq", "customer_id"]
    known = restrict_to(customers.select("customer_id"), requests, "customer_id")
    missing = rejected(requests.join(known, "customer_id", "left_anti"), "unknown customer", keys)
    ok = requests.join(known, "customer_id", "left_semi")
    new = assign_new_ids(ok, orders, "order_id")
    added = new.select("order_id", "customer_id", now.alias("order_date"),
                       F.lit(S.ORDER_NEW).alias("status"),
                       F.lit(0).cast(S.TOTAL).alias("total_amount"))
    return Applied(orders.unionByName(added), missing, added)


def _guard_open(orders: DataFrame, requests: DataFrame, keys: list[str]):
    """Requests on unknown or closed orders are refused (paid and shipped
    orders never change)."""
    o = (restrict_to(orders.select("order_id", "status"), requests, "order_id")
         .withColumn("_found", F.lit(True)))
    j = requests.join(o, "order_id", "left")
    reason = (F.when(F.col("_found").isNull(), F.lit("order not found"))
              .when(~is_open_order(F.col("status")), F.lit("order not open")))
    ok, rej = split_by_reason(j, reason, keys)
    return ok.drop("status", "_found"), [rej]


def _touched_totals(order_items: DataFrame, touched: DataFrame, parts: int | None):
    """Ids of ``touched``, and the sums of their lines."""
    t = dealt(touched.select("order_id"), "order_id", parts).distinct()
    t = hashed(t, parts)
    lines = order_items.filter(F.col("order_id").isNotNull()).select("order_id", "qty", "price")
    return t, hashed(lines_total(dealt(lines, "order_id", parts).join(t, "order_id", "left_semi")), parts)


def refresh_totals(orders: DataFrame, order_items: DataFrame, touched: DataFrame,
                   parts: int | None = None) -> DataFrame:
    """Touched orders with total_amount = Σ qty × price of their lines."""
    t, lt = _touched_totals(order_items, touched, parts)
    return (dealt(orders, "order_id", parts).join(t, "order_id", "left_semi").join(lt, "order_id", "left")
            .select("order_id", "customer_id", "status",
                    F.coalesce(F.col("_t"), F.lit(0)).cast(S.TOTAL).alias("total_amount")))


def with_refreshed_totals(orders: DataFrame, order_items: DataFrame, touched: DataFrame,
                          parts: int | None = None) -> DataFrame:
    """All orders; those of ``touched`` with total_amount = Σ qty × price."""
    t, lt = _touched_totals(order_items, touched, parts)
    total = F.when(F.col("_touched"), F.coalesce(F.col("_t"), F.lit(0))).otherwise(F.col("total_amount"))
    return (dealt(orders, "order_id", parts).join(hashed(t.withColumn("_touched", F.lit(True)), parts), "order_id", "left")
            .join(lt, "order_id", "left")
            .withColumn("total_amount", total.cast(S.TOTAL)).select(*orders.columns))


def order_add_items(orders: DataFrame, books: DataFrame, order_items: DataFrame,
                    requests: DataFrame) -> Applied:
    """Only open orders accept lines; price captured from the book;
    totals of touched orders refreshed.  Paid/shipped orders are unchanged."""
    keys = ["seq", "order_id"]
    parts = parts_for(order_items, requests)
    ok, rej = _guard_open(orders, requests, keys)
    prices = (restrict_to(books.select("book_id", "price"), requests, "book_id")
              .withColumn("_book", F.lit(True)))
    j = ok.join(prices, "book_id", "left")
    found, no_book = split_by_reason(j, F.when(F.col("_book").isNull(), F.lit("book not found")),
                                     keys)
    new_lines = with_item_ids(found.select("seq", "order_id", "book_id", F.col("qty").cast("long").alias("qty"),
                                           "price"), order_items).drop("seq")
    items = order_items.select(*line_columns(order_items)).unionByName(new_lines)
    touched = refresh_totals(orders, items, new_lines, parts)
    res = Applied(with_refreshed_totals(orders, items, new_lines, parts), union_all(rej + [no_book]), new_lines)
    res.touched = touched
    res.order_items = items
    return res


def order_remove_items(orders: DataFrame, order_items: DataFrame, requests: DataFrame) -> Applied:
    """Lower the quantity of the order's lines of that book (requests
    for one line are summed), drop lines at <= 0, refresh totals.  Several
    lines of one book give up the quantity one after the other, cheapest
    first (running sum over the order's lines of the book), never each in
    full.  ``removed`` and ``lowered`` are the asked lines before and after."""
    keys = ["order_id", "book_id"]
    parts = parts_for(order_items, requests)
    req = requests.groupBy("order_id", "book_id").agg(F.sum("qty").alias("_minus"))
    ok, rej = _guard_open(orders, req, keys)
    columns = line_columns(order_items)
    li = order_items.select(*columns)
    w = flag_present(ok, li, keys, "_line", keys_from=req)
    rej.append(rejected(w.filter(~F.col("_line")), "line not found", keys))
    # asked lines and the others have the same two sides, so that each is shuffled
    # once; a line without one of the keys is never asked for and not moved
    has_keys = F.col("order_id").isNotNull() & F.col("book_id").isNotNull()
    asked = (li.filter(has_keys)
             .join(ok.select("order_id", "book_id", "_minus", F.lit(True).alias("_asked")), keys, "left"))
    hit = asked.filter(F.col("_asked").isNotNull())
    ids = [c for c in columns if c == "order_item_id"]
    before = (Window.partitionBy(*keys).orderBy("price", "qty", *ids)
              .rowsBetween(Window.unboundedPreceding, -1))
    left_over = F.greatest(F.col("_minus") - F.coalesce(F.sum("qty").over(before), F.lit(0)), F.lit(0))
    lowered = (hit.withColumn("_take", left_over)
               .select(*[(F.col("qty") - F.col("_take")).alias("qty") if c == "qty" else c for c in columns])
               .filter(F.col("qty").isNull() | (F.col("qty") > 0)))
    new_items = (asked.filter(F.col("_asked").isNull()).select(*columns)
                 .unionByName(li.filter(~has_keys)).unionByName(lowered))
    touched = refresh_totals(orders, new_items, ok, parts)
    res = Applied(with_refreshed_totals(orders, new_items, ok, parts), union_all(rej), None)
    res.touched = touched
    res.lowered = lowered
    res.removed = restrict_to(li.filter(has_keys), ok, keys)
    res.order_items = new_items
    return res


def buy_auto(users: DataFrame, customers: DataFrame, orders: DataFrame, books: DataFrame,
             order_items: DataFrame, requests: DataFrame, now: Column) -> Applied:
    """I16: resolve the login to its customer, use the lowest open order or
    open a new one, then add the line with the current price and refresh the
    totals.  The order is opened before the book is looked up (an unknown book
    still opens it).  ``snapshot`` is all orders, ``order_items`` all lines."""
    keys = ["seq", "username"]
    who = (restrict_to(users.select("user_id", "username"), requests, "username")
           .join(customers.select("user_id", "customer_id"), "user_id").drop("user_id"))
    r = requests.join(who, "username", "left")
    not_customer = rejected(r.filter(F.col("customer_id").isNull()), "not a customer", keys)
    r = r.filter(F.col("customer_id").isNotNull())
    open_o = (restrict_to(orders.filter(is_open_order(F.col("status")))
                          .select("order_id", "customer_id"), who, "customer_id")
              .groupBy("customer_id").agg(F.min("order_id").alias("open_order")))
    r = r.join(open_o, "customer_id", "left")
    needs = (r.filter(F.col("open_order").isNull()).groupBy("customer_id")
             .agg(F.min("seq").alias("seq")))
    opened = assign_new_ids(needs, orders, "order_id").select(
        "customer_id", F.col("order_id").alias("new_order"))
    r = r.join(opened, "customer_id", "left")
    prices = (restrict_to(books.select("book_id", "price"), requests, "book_id")
              .withColumn("_book", F.lit(True)))
    found, no_book = split_by_reason(r.join(prices, "book_id", "left"),
                                     F.when(F.col("_book").isNull(), F.lit("book not found")), keys)
    lines = found.select("seq", "username", "customer_id",
                         F.coalesce("open_order", "new_order").alias("order_id"), "book_id",
                         F.col("qty").cast("long").alias("qty"), "price",
                         F.col("new_order").isNotNull().alias("new_order"))
    new_orders = opened.select(F.col("new_order").alias("order_id"), "customer_id",
                               now.alias("order_date"), F.lit(S.ORDER_NEW).alias("status"),
                               F.lit(0).cast(S.TOTAL).alias("total_amount"))
    lines = with_item_ids(lines, order_items)
    columns = line_columns(order_items)
    items = order_items.select(*columns).unionByName(lines.select(*columns))
    res = Applied(with_refreshed_totals(orders.unionByName(new_orders), items, lines, parts_for(order_items, requests)),
                  union_all([not_customer, no_book]), lines)
    res.new_orders = new_orders
    res.order_items = items
    return res


# ---------------------------------------------------------------------------
# Account changes
# ---------------------------------------------------------------------------
def toggle_status(users: DataFrame, audit_log: DataFrame, requests: DataFrame, now: Column,
                  actor: str = "admin") -> Applied:
    """Set a user's status and log the reason: one audit row per applied
    request, with old and new status as JSON details."""
    keys = ["seq", "user_id"]
    winners, dups = dedupe(requests, "user_id", keys)
    cur = (restrict_to(users.select("user_id", F.col("status").alias("old_status")), requests,
                       "user_id").withColumn("_found", F.lit(True)))
    ok, missing = split_by_reason(winners.join(cur, "user_id", "left"),
                                  F.when(F.col("_found").isNull(), F.lit("not found")), keys)
    snap = set_where_matched(users, ok.select("user_id", F.col("new_status").alias("_new")),
                             "user_id", {"status": F.col("_new")}, keep_null=False)
    logged = assign_new_ids(ok, audit_log, "log_id")
    details = F.to_json(F.struct("user_id", "old_status", "new_status", "reason"),
                        {"ignoreNullFields": "false"})
    audit = logged.select("log_id", F.lit(actor).alias("who"), F.lit("users").alias("what_table"),
                          F.lit("STATUS_CHANGE").alias("action"), details.alias("details_json"),
                          now.alias("ts"))
    return Applied(snap, union_all([dups, missing]), audit)


def contact_update(users: DataFrame, customers: DataFrame, requests: DataFrame) -> Applied:
    """Profile fields by login; NULL keeps the old value.  Refused: a
    login without a profile, an e-mail that another customer has (e-mail is
    UNIQUE); of the rest the first request per login counts, and of several that
    ask for one e-mail the first gets it."""
    keys = ["seq", "username"]
    ok, rej = resolved_contacts(users, customers, requests, keys)
    ok, dups = dedupe(ok, "username", keys)
    asks, lost = first_by_seq(ok.filter(F.col("new_email").isNotNull()), "new_email")
    ok = asks.unionByName(ok.filter(F.col("new_email").isNull()))
    ch = ok.select("customer_id", *[F.col(f"new_{c}").alias(f"_new_{c}") for c in CONTACT_FIELDS])
    snap = set_where_matched(customers, ch, "customer_id",
                             {c: F.col(f"_new_{c}") for c in CONTACT_FIELDS}, keep_null=True)
    return Applied(snap, union_all([rej, dups, rejected(lost, "email exists", keys)]))


CONTACT_FIELDS = ("address", "phone", "full_name", "email")


def resolved_contacts(users: DataFrame, customers: DataFrame, requests: DataFrame, keys: list[str]):
    """Contact requests with their customer_id, and the refused ones: no
    login, no profile, or an e-mail that another customer has."""
    who = (restrict_to(users.select("user_id", "username"), requests, "username")
           .join(customers.select("user_id", "customer_id"), "user_id").select("username", "customer_id"))
    holder = (restrict_to(customers.filter(F.col("email").isNotNull())
                          .select(F.col("email").alias("new_email"), "customer_id"), requests, "new_email")
              .groupBy("new_email").agg(F.min("customer_id").alias("_holder")))
    j = left_join_spread(requests.join(who, "username", "left"), holder, "new_email")
    reason = (F.when(F.col("username").isNull(), F.lit("key missing"))
              .when(F.col("customer_id").isNull(), F.lit("no profile"))
              .when(F.col("_holder") != F.col("customer_id"), F.lit("email exists")))
    ok, rej = split_by_reason(j, reason, keys)
    return ok.drop("_holder"), rej


def security_update(users: DataFrame, roles: DataFrame, requests: DataFrame) -> Applied:
    """New hash / status; only an Admin or the user themself may change
    it; NULL keeps the old value.  A refused request does not use up its key."""
    keys = ["seq", "username"]
    admins = (restrict_to(users.select(F.col("username").alias("viewer"), "role_id"), requests,
                          "viewer")
              .join(roles_dim(roles), "role_id")
              .select("viewer", (F.col("role_name") == S.ROLE_ADMIN).alias("_admin")))
    w = flag_present(requests.join(admins, "viewer", "left"), users, "username", "_exists",
                     keys_from=requests)
    allowed = (F.coalesce(F.col("_admin"), F.lit(False))
               | F.col("viewer").eqNullSafe(F.col("username")))
    reason = (F.when(F.col("username").isNull(), F.lit("key missing"))
              .when(~allowed, F.lit("not allowed"))
              .when(~F.col("_exists"), F.lit("not found")))
    ok, rej = split_by_reason(w, reason, keys)
    ok, dups = dedupe(ok.drop("_admin", "_exists"), "username", keys)
    ch = ok.select("username", F.col("new_password_hash").alias("_new_hash"),
                   F.col("new_status").alias("_new_status"))
    snap = set_where_matched(users, ch, "username",
                             {"password_hash": F.col("_new_hash"), "status": F.col("_new_status")},
                             keep_null=True)
    return Applied(snap, union_all([dups, rej]))

