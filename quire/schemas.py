"""Domain schema, value vocabularies and defaults (one place for all of them)."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the application's vocabulary.
# ---------------------------------------------------------------------------
ROLE_CUSTOMER = "Customer"
ROLE_SELLER = "Seller"
ROLE_ADMIN = "Admin"
ROLES = [(1, ROLE_CUSTOMER), (2, ROLE_SELLER), (3, ROLE_ADMIN)]

STATUS_ACTIVE = "ACTIVE"
STATUS_BLOCKED = "BLOCKED"

ORDER_NEW = "Новый"          # canonical open order / cart status
ORDER_NEW_LEGACY = "NEW"     # older spelling, normalised to ORDER_NEW
ORDER_PAID = "Оплачен"
ORDER_SHIPPED = "Отправлен"

ARCHIVE_PREFIX = "[АРХИВ]"
RESERVED_USERNAME = "admin"  # case-sensitive: "Admin" is allowed

JSON_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"

# ---------------------------------------------------------------------------
# Types
# ---------------------------------------------------------------------------
ID = T.LongType()
PRICE = T.DecimalType(10, 2)
TOTAL = T.DecimalType(12, 2)
DISCOUNT = T.DecimalType(5, 2)
MONEY_SUM = T.DecimalType(38, 2)   # every money aggregate is cast to this
TS = T.TimestampNTZType()


def _s(*fields):
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


ROLES_SCHEMA = _s(("role_id", ID, False), ("role_name", T.StringType(), False))

USERS_SCHEMA = _s(
    ("user_id", ID, False), ("username", T.StringType(), False),
    ("password_hash", T.StringType(), False), ("role_id", ID, False),
    ("status", T.StringType(), True), ("created_at", TS, True))

CUSTOMERS_SCHEMA = _s(
    ("customer_id", ID, False), ("user_id", ID, True), ("full_name", T.StringType(), True),
    ("email", T.StringType(), True), ("phone", T.StringType(), True),
    ("address", T.StringType(), True), ("status", T.StringType(), True),
    ("created_at", TS, True))

BOOKS_SCHEMA = _s(
    ("book_id", ID, False), ("isbn", T.StringType(), True), ("title", T.StringType(), True),
    ("author", T.StringType(), True), ("price", PRICE, True), ("stock", T.LongType(), True),
    ("category", T.StringType(), True), ("attributes_json", T.StringType(), True),
    ("created_at", TS, True), ("image_url", T.StringType(), True),
    ("discount_percent", DISCOUNT, True), ("price_after_discount", PRICE, True),
    ("is_archived", T.IntegerType(), True))

ORDERS_SCHEMA = _s(
    ("order_id", ID, False), ("customer_id", ID, True), ("order_date", TS, True),
    ("status", T.StringType(), True), ("total_amount", TOTAL, True))

ORDER_ITEMS_SCHEMA = _s(
    ("order_item_id", ID, True), ("order_id", ID, True), ("book_id", ID, True),
    ("qty", T.LongType(), True), ("price", PRICE, True))

AUDIT_SCHEMA = _s(
    ("log_id", ID, False), ("who", T.StringType(), True), ("what_table", T.StringType(), True),
    ("action", T.StringType(), True), ("details_json", T.StringType(), True), ("ts", TS, True))

# Column defaults applied when a column is absent from an insert.
DEFAULTS = {
    "users": {"status": STATUS_ACTIVE, "created_at": "now"},
    "customers": {"status": STATUS_ACTIVE, "created_at": "now"},
    "books": {"stock": 0, "created_at": "now", "is_archived": 0},
    "orders": {"order_date": "now"},
    "audit_log": {"ts": "now"},
}

# Maximum lengths of the text columns (VARCHAR2(n)) and NOT NULL columns, used
# by the constraint checks.
MAX_LEN = {
    "roles": {"role_name": 50},
    "users": {"username": 100, "password_hash": 200, "status": 20},
    "customers": {"full_name": 200, "email": 200, "phone": 50, "status": 20},
    "books": {"isbn": 20, "title": 400, "author": 200, "category": 100},
    "orders": {"status": 50},
    "audit_log": {"who": 200, "what_table": 200, "action": 50},
}
NOT_NULL = {
    "roles": ["role_id", "role_name"],
    "users": ["user_id", "username", "password_hash", "role_id"],
    "customers": ["customer_id"], "books": ["book_id"], "orders": ["order_id"], "audit_log": ["log_id"],
}
JSON_COLUMNS = {"books": "attributes_json", "audit_log": "details_json"}
PRIMARY_KEYS = {
    "roles": "role_id", "users": "user_id", "customers": "customer_id",
    "books": "book_id", "orders": "order_id", "audit_log": "log_id",
}
UNIQUE_KEYS = {"roles": ["role_name"], "users": ["username"], "customers": ["email"]}
