"""File formats: BOM/CRLF CSV, JSON arrays and lines, round trips, NULLs,
malformed elements, empty arrays."""

import os
import uuid
from datetime import datetime
from decimal import Decimal

import pytest

from quire import schemas as S
from quire.session import scratch_dir
from quire.sources import files as io


def local(path):
    return path[len("file:"):] if path.startswith("file:") else path


@pytest.fixture
def fresh(spark):
    def make(name):
        p = local(scratch_dir(spark, name))
        os.makedirs(p, exist_ok=True)
        return p
    return make


def test_csv_bom_crlf_cyrillic(spark, fresh):
    d = fresh("csv-bom")
    text = ("978-5-000-00001-1,Книга первая,Автор Один,500,10,Фэнтези\r\n"
            "978-5-000-00002-2,Книга вторая,Автор Два,400,15,Детская литература\r\n"
            "978-5-000-00003-3,Книга третья,Автор Три,300,20,Фэнтези\r\n")
    with open(os.path.join(d, "books.csv"), "wb") as f:
        f.write(b"\xef\xbb\xbf" + text.encode("utf-8"))
    rows = io.read_catalog_csv(spark, d).orderBy("isbn").collect()
    assert [r.isbn for r in rows] == ["978-5-000-00001-1", "978-5-000-00002-2", "978-5-000-00003-3"]
    assert [r.price for r in rows] == [Decimal("500.00"), Decimal("400.00"), Decimal("300.00")]
    assert [r.stock for r in rows] == [10, 15, 20]
    assert rows[1].category == "Детская литература"           # no trailing CR


def _books(spark, rows):
    return spark.createDataFrame(rows, S.BOOKS_SCHEMA)


def test_json_round_trip_array_and_lines(spark):
    ts = datetime(2024, 5, 6, 7, 8, 9, 123456)
    rows = [(1, "i1", "T1", "A", Decimal("10.50"), 3, "C", '{"pages": 120, "format": "x"}', ts,
             None, Decimal("5.00"), Decimal("9.98"), 0),
            (2, None, "T2", None, None, None, None, None, None, None, None, None, 0)]
    books = _books(spark, rows)
    for as_array in (True, False):
        path = scratch_dir(spark, f"rt-{as_array}")
        io.export_books_json(books, path, as_array=as_array)
        back = {r.book_id: r for r in io.read_books_json(spark, path, multiline=as_array).collect()}
        assert back[1].created_at == datetime(2024, 5, 6, 7, 8, 9)   # seconds kept, fraction lost
        assert back[1].price == Decimal("10.50")
        assert back[1].attributes_json in ('{"format":"x","pages":120}',
                                           '{"pages":120,"format":"x"}')
        assert back[2].isbn is None and back[2].price is None
        raw = io.read_books_json_raw(spark, path, arrays=as_array).collect()
        assert len(raw) == 2 and all(r.attributes_json.startswith("{") for r in raw)


def test_export_keeps_nulls_and_nested_object(spark):
    books = _books(spark, [(1, None, "T", None, None, None, None, '{"pages": 5}', None, None,
                            None, None, 0)])
    line = io.export_objects(books).first().value
    assert '"isbn":null' in line and '"attributes_json":{"pages":5}' in line


def test_empty_array_and_malformed_element(spark, fresh):
    d = fresh("json-bad")
    with open(os.path.join(d, "a.json"), "w") as f:
        f.write("[\n]\n")
    with open(os.path.join(d, "b.json"), "w") as f:
        f.write('[\n{"book_id": 1, "price": 5}\n,\n{"book_id": "x", "price": 7}\n]\n')
    got = {(r.book_id, r.price) for r in io.read_books_json(spark, d, multiline=True).collect()}
    assert got == {(1, Decimal("5.00")), (None, Decimal("7.00"))}   # bad field → NULL, row kept


def test_arrays_of_any_layout(spark, fresh):
    d = fresh("json-layouts")
    with open(os.path.join(d, "compact.json"), "w") as f:
        f.write('[{"book_id": 1, "price": 5}, {"book_id": 2, "price": 6}]')
    with open(os.path.join(d, "pretty.json"), "w") as f:
        f.write('[\n  {\n    "book_id": 3,\n    "price": 7\n  },\n  {\n    "book_id": 4\n  }\n]\n')
    assert {r.book_id for r in io.read_books_json(spark, d, multiline=True).collect()} == {1, 2, 3, 4}
    raw = io.read_books_json_raw(spark, d, arrays=True).collect()
    assert len(raw) == 4 and all('"book_id"' in r.attributes_json for r in raw)
    # the line mode refuses what it does not understand
    with pytest.raises(Exception, match="not one element per line"):
        io.read_books_json(spark, d, multiline=True, one_element_per_line=True).collect()


def test_truncate_then_reload_counts(spark):
    books = _books(spark, [(i, f"i{i}", f"T{i}", "A", Decimal("1.00"), 1, "C", None, None, None,
                            None, None, 0) for i in range(5)])
    emptied = spark.createDataFrame([], books.schema)
    assert emptied.count() == 0 and emptied.schema == books.schema
    path = scratch_dir(spark, f"reload-{uuid.uuid4().hex[:6]}")
    io.export_books_json(books, path, as_array=True)
    assert io.read_books_json(spark, path, multiline=True).count() == 5


def test_checked_import_publishes_valid_rows_and_returns_rejects(spark, fresh):
    from quire.sources import snapshot_store as store
    d = fresh("json-checked")
    long_title = "x" * 401
    with open(os.path.join(d, "a.json"), "w") as f:
        f.write('[\n{"book_id": 1, "title": "ok", "attributes_json": {"pages": 3}}\n,\n'
                f'{{"book_id": 2, "title": "{long_title}"}}\n,\n'
                '{"book_id": 3, "title": "bad json", "attributes_json": "{\\"pages\\": 3"}\n]\n')
    root = scratch_dir(spark, "books-root")
    path, rejects = io.import_books_checked(spark, d, root, version=7)
    assert path.endswith("version=7")
    assert [r.book_id for r in store.read_version(spark, root, 7).collect()] == [1]
    got = {r.book_id: list(r.broken_rules) for r in rejects.collect()}
    assert got == {2: ["title_too_long"], 3: ["attributes_json_not_json"]}


def test_json_rejects(spark, fresh):
    d = fresh("json-rejects")
    with open(os.path.join(d, "a.json"), "w") as f:
        f.write('[{"book_id": 1, "price": 5}, {"book_id": "x", "price": 7}, 3, null, {"book_id": 2, "title": ""}]')
    with open(os.path.join(d, "b.json"), "w") as f:
        f.write('\ufeff[\n {"book_id": 4,\n "created_at": "2020-01-02 03:04:05"}\n]')
    with open(os.path.join(d, "cut.json"), "w") as f:
        f.write('[{"book_id": 5}, {"book_id": 6')
    rows, rejects = io.read_books_json_checked(spark, d, multiline=True)
    got = {r.book_id: (r.price, r.title, str(r.created_at)) for r in rows.collect()}
    assert got == {1: (Decimal("5.00"), None, "None"), 2: (None, None, "None"), 4: (None, None, "2020-01-02 03:04:05")}
    bad = sorted((r.raw or "", r.reason) for r in rejects.collect())
    assert [x[1] for x in bad] == ["malformed", "malformed", "not a JSON array", "malformed"]
    assert bad[2][0] == '[{"book_id": 5}, {"book_id": 6' and "x" in bad[3][0]


def test_json_lines_rejects_keep_every_line(spark, fresh):
    d = fresh("json-line-rejects")
    with open(os.path.join(d, "a.json"), "w") as f:
        f.write('{"book_id": 1}\n{"book_id": 2\n\nnot json\n{"book_id": 3, "price": "n/a"}\n')
    rows, rejects = io.read_books_json_checked(spark, d)
    assert [r.book_id for r in rows.collect()] == [1]
    assert rejects.count() == 3 and rejects.select("raw").collect()


def test_csv_rejects(spark, fresh):
    d = fresh("csv-rejects")
    with open(os.path.join(d, "a.csv"), "w", newline="") as f:
        f.write('\ufeffi1,"T, 1",A,5.00,1,C\r\ni2,T,A,abc,1,C\r\ni3,T,A,5.00,xx,C\ni4,T,A\n\ni5,T,A,5,1,C,extra\n'
                'i6,,A,,2,C\n')
    rows, rejects = io.read_catalog_csv_checked(spark, d)
    assert {(r.isbn, r.title, r.price) for r in rows.collect()} == {
        ("i1", "T, 1", Decimal("5.00")), ("i6", None, None)}
    assert sorted(r.raw[:2] for r in rejects.collect()) == ["i2", "i3", "i4", "i5"]
    assert rows.select("isbn").count() == 2 and rows.select("stock").distinct().count() == 2


def test_checked_import_never_publishes_a_cut_off_element(spark, fresh):
    from quire.sources import snapshot_store as store
    d = fresh("json-cut")
    with open(os.path.join(d, "a.json"), "w") as f:
        f.write('[{"book_id": 1, "title": "ok"}, {"title": "no key"}, {"book_id": 2, "stock": "many"}]')
    root = scratch_dir(spark, "books-cut")
    _, rejects = io.import_books_checked(spark, d, root, version=1)
    assert [r.book_id for r in store.read_version(spark, root, 1).collect()] == [1]
    assert sorted(list(r.broken_rules)[0] for r in rejects.collect()) == ["book_id_null", "malformed"]


def test_raw_import_of_pretty_printed_array_reads_files_whole(spark, fresh):
    d = fresh("json-pretty")
    with open(os.path.join(d, "a.json"), "w") as f:
        f.write('[\n  {\n    "isbn": "x1",\n    "price": 5\n  },\n  {\n    "isbn": "x2"\n  }\n]\n')
    rows = io.read_books_json_raw(spark, d, arrays=True, one_element_per_line=False).collect()
    assert sorted(r.isbn for r in rows) == ["x1", "x2"]
    assert all(r.attributes_json.startswith("{") for r in rows)
    typed = io.read_books_json(spark, d, multiline=True, one_element_per_line=False).collect()
    assert sorted((r.isbn, r.price) for r in typed) == [("x1", Decimal("5.00")), ("x2", None)]


def test_stored_domain_runs_operators_on_published_snapshots(spark, small_dir):
    from quire.operators import sales
    from quire.sources import snapshot_store as store
    from quire.sources.adapter import Domain, StoredDomain
    d = Domain(spark, small_dir)
    root = scratch_dir(spark, "stored-domain")
    paths = {t: store.publish(getattr(d, t), f"{root}/{t}", 1)
             for t in ("books", "order_items")}
    sd = StoredDomain(spark, paths)
    got = sales.popular_products(sd.order_items, sd.books, 5).collect()
    assert got == sales.popular_products(d.order_items, d.books, 5).collect()
    with pytest.raises(KeyError):
        sd.users


def test_array_file_is_read_once(spark, fresh):
    """No second reads of the file for the text of nested objects, which stays
    as it was written."""
    d = fresh("json-once")
    attributes = '{"pages": 10,  "x":[1, 2.50, "\\u00e9"]}'
    text = "[" + ",\n".join(f'{{"book_id":{i},"attributes_json":{attributes}}}' for i in range(3000)) + "]"
    with open(os.path.join(d, "books.json"), "w", encoding="utf-8") as f:
        f.write(text)

    def bytes_read():
        return sum(s.getBytesRead() for s in spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics())

    before = bytes_read()
    rows = io.read_books_json(spark, d, multiline=True).select("book_id", "attributes_json").collect()
    assert bytes_read() - before < 3 * len(text)
    assert sorted(r.book_id for r in rows) == list(range(3000))
    assert {r.attributes_json for r in rows} == {attributes}
