"""Physical-plan shape: pruning, pushdown, top-k, partition pruning."""

from quire.operators import layout
from quire.plans import load_all
from quire.session import scratch_dir
from quire.sources.adapter import Domain

REG = load_all()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_popular_products_is_top_k_with_partial_aggregation(spark, small_dir):
    p = plan(REG["popular_products"].build(spark, small_dir))
    assert "TakeOrderedAndProject" in p
    assert "partial_sum" in p


def test_equality_filter_pushed_and_columns_pruned(spark, small_dir):
    df = REG["filter_category_title"].build(spark, small_dir)
    p = plan(df)
    assert "PushedFilters: [IsNotNull(p_type), EqualTo(p_type,ECONOMY)]" in p
    assert "ReadSchema: struct<p_name:string,p_type:string>" in p


def test_category_layout_prunes_partitions(spark, small_dir):
    d = Domain(spark, small_dir)
    path = scratch_dir(spark, "layout-test")
    layout.write_category_layout(d.books, path)
    df = layout.lookup_category(spark, path, "SMALL")
    p = plan(df)
    assert "PartitionFilters: [isnotnull(category" in p and "(category#" in p
    assert df.count() == d.books.filter("category = 'SMALL'").count()


def test_receipt_totals_are_aggregates_not_windows(spark, small_dir):
    p = plan(REG["receipt"].build(spark, small_dir))
    assert "Window" not in p


def test_bucketed_orders_and_lines_join_without_shuffle(spark, small_dir):
    import uuid

    from quire.operators import sales
    from quire.sources import snapshot_store as store
    d = Domain(spark, small_dir)
    tag = uuid.uuid4().hex[:8]
    o = store.publish_bucketed(d.orders, f"orders_{tag}", "order_id", 8,
                               scratch_dir(spark, f"orders-{tag}"))
    li = store.publish_bucketed(d.order_items, f"items_{tag}", "order_id", 8,
                                scratch_dir(spark, f"items-{tag}"))
    with_b = sales.order_totals(spark.table(o), spark.table(li))
    plan = with_b._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(order_id" not in plan
    plain = sales.order_totals(d.orders, d.order_items)
    assert sorted(with_b.collect()) == sorted(plain.collect())


def test_author_lookup_on_layout_pushes_filter_to_row_groups(spark, small_dir):
    from pyspark.sql import functions as F
    d = Domain(spark, small_dir)
    path = scratch_dir(spark, "layout-author")
    layout.write_category_layout(d.books, path)
    df = spark.read.parquet(path).filter(F.col("author") == "Brand#10").select("title")
    p = plan(df)
    assert "PushedFilters: [IsNotNull(author), EqualTo(author,Brand#10)]" in p
    assert df.count() == d.books.filter("author = 'Brand#10'").count()


def logical(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_product_delete_joins_the_catalogue_without_an_anti_join(spark, small_dir):
    d = Domain(spark, small_dir)
    from quire.operators import snapshots
    books = d.books
    res = snapshots.product_delete(books, d.order_items, books.select("book_id"))
    assert "LeftAnti" not in logical(res.snapshot)


def test_change_log_joins_published_versions(spark, small_dir):
    text = logical(REG["snapshot_changes"].build(spark, small_dir))
    assert text.count("Join ") == 1 and "FullOuter" in text


def test_layout_writes_few_files_per_category(spark, small_dir):
    import glob
    d = Domain(spark, small_dir)
    path = scratch_dir(spark, "layout-files")
    layout.write_category_layout(d.books.repartition(16), path)
    local = path.removeprefix("file:")
    folders = glob.glob(f"{local}/category=*")
    assert folders and all(len(glob.glob(f"{f}/*.parquet")) == 1 for f in folders)
