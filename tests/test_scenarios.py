"""The application's own scripted flows, replayed call by call on literal
tables: each procedure call is a one-row request and each job's new
snapshot is the input of the next call."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quire import schemas as S
from quire.operators import accounts as acc
from quire.operators import catalog as cat
from quire.operators import sales
from quire.operators import snapshots as ops

D = Decimal

# The inputs of the application's test scripts.
IVAN = ("ivan", "pass123", "Иван Иванов", "ivan@mail.com")
ANNA = ("anna", "pass456")
BOOK = ("Гарри Поттер", "Джоан Роулинг", D("500"), 10)
GATSBY = ("978-0-6432-7356-3", "Великий Гэтсби", "Ф. Скотт Фицджеральд", D("480.00"), 80,
          "Классика", "https://myshop.com/img/photo_book.jpg")
GATSBY_EDIT = ("Великий Гэтсби: Юбилейное издание", "Ф. Скотт Фицджеральд, ред. 2025",
               D("3725.50"), 30, "Классика XX века")


def now():
    return F.lit("2025-01-01 00:00:00").cast(S.TS)


@pytest.fixture
def empty(spark):
    def make(schema):
        return spark.createDataFrame([], schema)
    return make


def one(spark, row, ddl):
    return spark.createDataFrame([row], ddl)


def test_client_flow(spark, empty):
    roles = spark.createDataFrame([(1, S.ROLE_CUSTOMER)], S.ROLES_SCHEMA)
    users, customers = empty(S.USERS_SCHEMA), empty(S.CUSTOMERS_SCHEMA)
    books, orders = empty(S.BOOKS_SCHEMA), empty(S.ORDERS_SCHEMA)

    # Register('ivan', 'pass123', 'Иван Иванов', 'ivan@mail.com')
    reg = ops.register_clients(users, customers, roles, one(
        spark, (1,) + IVAN, "seq long, username string, password_hash string, "
                            "full_name string, email string"), now())
    users, customers = reg.snapshot, reg.customers
    assert [(r.user_id, r.username, r.role_id, r.status) for r in users.collect()] == \
        [(1, "ivan", 1, "ACTIVE")]
    assert [(r.customer_id, r.user_id, r.full_name) for r in customers.collect()] == \
        [(1, 1, "Иван Иванов")]
    # registering the same name again is skipped
    again = ops.register_clients(users, customers, roles, one(
        spark, (2,) + IVAN, "seq long, username string, password_hash string, "
                            "full_name string, email string"), now())
    assert [r.reason for r in again.rejects.collect()] == ["exists"]

    # Login('ivan', 'pass123') → 1; a wrong password → NULL
    attempts = spark.createDataFrame([(1, "ivan", "pass123"), (2, "ivan", "nope")],
                                     "seq long, username string, password_hash string")
    assert {r.seq: r.user_id for r in acc.match_credentials(attempts, users).collect()} == \
        {1: 1, 2: None}

    # AddBook('Гарри Поттер', 'Джоан Роулинг', 500, 10)
    books = ops.add_books(books, one(spark, (1,) + BOOK,
                                     "seq long, title string, author string, price decimal(10,2), "
                                     "stock long"), now()).snapshot
    # BrowseCatalog, SearchByAuthor('Джоан Роулинг'), SearchByCategory('Фэнтези')
    assert cat.browse_catalog(books).count() == 1
    assert [r.title for r in cat.search_author(books, "Джоан Роулинг").collect()] == [BOOK[0]]
    assert cat.search_author(books, "джоан").count() == 1
    assert cat.search_category(books, "Фэнтези").count() == 0      # category never set

    # AddToCart(1, 1, 2), PlaceOrder(1), ViewOrders(1)
    cart = ops.add_to_cart(books, one(spark, (1, 1, 1, 2),
                                      "seq long, customer_id long, book_id long, qty long")).added
    assert [(r.price, r.order_id) for r in cart.collect()] == [(D("500.00"), None)]
    placed = ops.place_orders(orders, customers, cart, one(spark, (1, 1),
                                                           "seq long, customer_id long"), now())
    o = placed.added.first()
    assert (o.order_id, o.customer_id, o.status, o.total_amount) == \
        (1, 1, S.ORDER_NEW, D("1000.00"))
    mine = acc.orders_of_customers(placed.snapshot, one(spark, (1,), "customer_id long"))
    assert [r.order_id for r in mine.collect()] == [1]


def test_seller_flow(spark):
    customers = spark.createDataFrame([(1, 1, "Иван Иванов", "ivan@mail.com", "123456789", None,
                                        "ACTIVE", None)], S.CUSTOMERS_SCHEMA)
    books = spark.createDataFrame([(1, None, BOOK[0], BOOK[1], D("500.00"), 10, None, None, None,
                                    None, None, None, 0)], S.BOOKS_SCHEMA)
    orders = spark.createDataFrame([(1, 1, None, "Новый", D("500.00"))], S.ORDERS_SCHEMA)
    items = spark.createDataFrame([(1, 1, 1, 1, D("500.00"))], S.ORDER_ITEMS_SCHEMA)

    # UpdateBook(1, 600, 12)
    books = ops.update_books(books, one(spark, (1, 1, D("600"), 12),
                                        "seq long, book_id long, price decimal(10,2), "
                                        "stock long")).snapshot
    assert [(r.price, r.stock) for r in books.collect()] == [(D("600.00"), 12)]
    # ViewOrders
    view = sales.seller_view_orders(orders, customers, items, books).collect()
    assert [(r.order_id, r.client, r.title, r.qty, r.status) for r in view] == \
        [(1, "Иван Иванов", BOOK[0], 1, "Новый")]
    # UpdateOrderStatus(1, 'Отправлен')
    orders = ops.update_order_status(orders, one(spark, (1, 1, S.ORDER_SHIPPED),
                                                 "seq long, order_id long, status string")).snapshot
    assert sales.seller_view_orders(orders, customers, items, books).first().status == \
        S.ORDER_SHIPPED
    # DeleteBook(1): the order line still references it → refused, kept
    res = ops.delete_by_key(books, "book_id", one(spark, (1,), "book_id long"),
                            [(items, "book_id")])
    assert res.snapshot.count() == 1 and [r.reason for r in res.rejects.collect()] == ["referenced"]


def test_admin_flow(spark):
    roles = spark.createDataFrame([(1, S.ROLE_CUSTOMER)], S.ROLES_SCHEMA)
    users = spark.createDataFrame([(1, "ivan", "h", 1, "ACTIVE", None)], S.USERS_SCHEMA)
    customers = spark.createDataFrame([(1, 1, "Иван Иванов", None, None, None, "ACTIVE", None)],
                                      S.CUSTOMERS_SCHEMA)
    # AddRole('Seller'), AddRole('Admin')
    roles = ops.add_roles(roles, spark.createDataFrame(
        [(1, S.ROLE_SELLER), (2, S.ROLE_ADMIN)], "seq long, role_name string")).snapshot
    assert sorted((r.role_id, r.role_name) for r in roles.collect()) == \
        [(1, S.ROLE_CUSTOMER), (2, S.ROLE_SELLER), (3, S.ROLE_ADMIN)]
    # AddUser('ivan', ..., 'Customer') skipped; AddUser('anna', 'pass456', 'Seller') added;
    # the reserved name is refused by the insert rule
    req = spark.createDataFrame(
        [(1, "ivan", "pass123", S.ROLE_CUSTOMER), (2, ANNA[0], ANNA[1], S.ROLE_SELLER),
         (3, "admin", "x", S.ROLE_ADMIN)],
        "seq long, username string, password_hash string, role_name string")
    res = ops.add_users(users, roles, req, now())
    assert [(r.user_id, r.username, r.role_id) for r in res.added.collect()] == [(2, "anna", 2)]
    assert {r.username: r.reason for r in res.rejects.collect()} == \
        {"ivan": "exists", "admin": "reserved username"}
    users = res.snapshot
    # ViewStatistics
    books = spark.createDataFrame([], S.BOOKS_SCHEMA)
    orders = spark.createDataFrame([], S.ORDERS_SCHEMA)
    st = sales.view_statistics(books, users, orders).first()
    assert (st.books, st.users, st.orders) == (0, 2, 0)
    # DeleteUser(1): still has a profile → refused; DeleteRole(3): nobody holds it → deleted
    du = ops.delete_by_key(users, "user_id", one(spark, (1,), "user_id long"),
                           [(customers, "user_id")])
    assert du.snapshot.count() == 2
    dr = ops.delete_by_key(roles, "role_id", one(spark, (3,), "role_id long"), [(users, "role_id")])
    assert sorted(r.role_id for r in dr.snapshot.collect()) == [1, 2]


def test_product_management_flow(spark):
    books = spark.createDataFrame([(5, "978-3-004106", "Old", "A", D("100.00"), 7, "C", None, None,
                                    None, D("10.00"), D("90.00"), 0)], S.BOOKS_SCHEMA)
    items = spark.createDataFrame([(1, 1, 5, 1, D("100.00"))], S.ORDER_ITEMS_SCHEMA)
    # MANAGE_PRODUCT_ADD(...)
    add = spark.createDataFrame([(1,) + GATSBY], "seq long, isbn string, title string, "
                                "author string, price decimal(10,2), stock long, category string, "
                                "image_url string")
    res = ops.product_add_validated(books, add, now())
    new = res.added.first()
    assert (new.book_id, new.isbn, new.title, new.stock, new.is_archived) == \
        (6, GATSBY[0], GATSBY[1], 80, 0)
    books = res.snapshot
    # adding the same isbn again is refused
    again = ops.product_add_validated(books, add, now())
    assert [r.reason for r in again.rejects.collect()] == ["isbn exists"]
    # MANAGE_PRODUCT_EDIT on book 5 (has a 10 % discount): discounted price follows the price
    edit = spark.createDataFrame([(1, 5) + GATSBY_EDIT],
                                 "seq long, book_id long, new_title string, new_author string, "
                                 "new_price decimal(10,2), new_stock long, new_category string")
    e = ops.product_edit(books, edit).snapshot.filter("book_id = 5").first()
    assert (e.title, e.price, e.stock, e.category, e.price_after_discount) == \
        (GATSBY_EDIT[0], D("3725.50"), 30, GATSBY_EDIT[4], D("3352.95"))
    # MANAGE_PRODUCT_DELETE: 6 has no order lines (removed), 5 has one (archived)
    snap = ops.product_delete(books, items, spark.createDataFrame([(5,), (6,)], "book_id long")) \
        .snapshot
    arch = cat.archived_check(snap).collect()
    assert [(r.book_id, r.archived) for r in arch] == [(5, True)]


def test_popular_and_general_stats(spark):
    books = spark.createDataFrame(
        [(i, None, f"T{i}", f"A{i}", D("10.00"), 1, None, None, None, None, None, None, 0)
         for i in range(1, 8)], S.BOOKS_SCHEMA)
    items = spark.createDataFrame(
        [(None, 1, 1, 5, D("10.00")), (None, 1, 2, 5, D("20.00")), (None, 2, 3, 9, D("1.00")),
         (None, None, 4, 50, D("1.00"))] +
        [(None, 3, b, 1, D("1.00")) for b in (5, 6, 7)], S.ORDER_ITEMS_SCHEMA)
    top = sales.popular_products(items, books, 5).collect()
    # cart lines (order NULL) are not sold; ties on quantity go to revenue, then id
    assert [r.book_id for r in top] == [3, 2, 1, 5, 6]
    orders = spark.createDataFrame([(1, 1, None, "Новый", D("0")), (2, 1, None, "Оплачен", D("0")),
                                    (3, 2, None, "Новый", D("0"))], S.ORDERS_SCHEMA)
    customers = spark.createDataFrame([(1, 1, "x", None, None, None, "ACTIVE", None)],
                                      S.CUSTOMERS_SCHEMA)
    g = sales.general_stats(orders, customers, books, items).first()
    assert (g.orders, g.customers, g.books, g.items_sold) == (3, 1, 7, 22)
