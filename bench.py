"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query runs to completion through the ``noop`` sink (full execution, no
collect), twice; ``queries`` and ``value`` report the faster (warm) run and
``cold_total`` the sum of the first runs (JIT warm-up, first Python worker).
Besides the registered queries, two items mirror the published
baseline: generating a 100,000-row catalogue (row-by-row inserts took about
20–30 s), the category lookup on it (0.38–0.56 s), and the bulk category
update of 10,000 of those rows (no time published); the category layout of
the catalogue stands in for the index build (0.13–0.30 s).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from quire.session import build_session, scratch_dir  # noqa: E402

HEADLINE = [
    "popular_products", "sales_by_title", "seller_view_orders", "receipt", "order_totals",
    "client_dossier", "my_history", "search_books", "search_author", "filter_category_title",
    "masked_profile", "resolve_book", "fk_violations", "constraint_violations",
    "upsert_users", "register_clients", "update_books", "product_delete", "buy_auto",
    "order_add_items", "cascade_delete", "snapshot_changes", "column_profile",
    "category_layout_lookup", "json_import_typed", "csv_import",
]
GEN_ROWS = 100_000


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    spark = build_session(f"local[{cpus}]", "quire-bench", shuffle_partitions=int(cpus) * 2)

    from quire.plans import load_all
    from quire.sources import generate as gen
    from quire.sources import partitioned
    from quire.operators import layout, snapshots
    from quire.sources import snapshot_store as store

    reg = load_all()
    run(spark.range(1000).selectExpr("sum(id)"))          # JVM warm-up
    times: dict[str, float] = {}
    errors: dict[str, str] = {}
    cold = 0.0
    for name in HEADLINE:
        q = reg[name]
        runs = []
        try:
            for _ in range(2):
                t0 = time.perf_counter()
                run(q.build(spark, sf_dir))
                runs.append(time.perf_counter() - t0)
        except Exception as e:          # report and go on: one failure keeps the rest
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
            continue
        cold += runs[0]
        times[name] = round(min(runs), 3)

    # Baseline mirror: generate 100k catalogue rows, publish by category,
    # then look one category up (pruned to its folder).
    # Bulk update mirror: the basic catalogue (category = 'Category ' || i % 10)
    # gets one category renamed (10,000 of 100,000 rows) and is published as
    # a new version.
    # The same update on a catalogue partitioned by category rewrites that
    # category's partition only.
    gen_runs, look_runs, upd_runs, lay_runs, part_runs = [], [], [], [], []
    for _ in range(2):
        path = scratch_dir(spark, "bench-gen")
        t0 = time.perf_counter()
        ids = spark.range(1, GEN_ROWS + 1).select(F.col("id").alias("i"))
        gen.write_generated(gen.words_catalog(ids), path)
        gen_runs.append(time.perf_counter() - t0)
        t0 = time.perf_counter()
        run(layout.lookup_category(spark, path, gen.CATEGORIES[2]))
        look_runs.append(time.perf_counter() - t0)
        root = scratch_dir(spark, "bench-basic")
        store.publish(gen.basic_catalog(ids), root, 1)
        t0 = time.perf_counter()
        layout.write_category_layout(store.read_version(spark, root, 1),
                                     scratch_dir(spark, "bench-layout"))
        lay_runs.append(time.perf_counter() - t0)
        t0 = time.perf_counter()
        store.publish(snapshots.recategorise(store.read_version(spark, root, 1),
                                             {"Category 3": "Учебная литература"}), root, 2)
        upd_runs.append(time.perf_counter() - t0)
        table = f"bench_{uuid.uuid4().hex[:12]}"
        partitioned.publish_partitioned(store.read_version(spark, root, 1), table,
                                        scratch_dir(spark, "bench-partitioned"), "category")
        t0 = time.perf_counter()
        partitioned.rename_values(spark, table, "category", {"Category 3": "Учебная литература"})
        part_runs.append(time.perf_counter() - t0)
    cold += gen_runs[0] + look_runs[0] + upd_runs[0] + lay_runs[0] + part_runs[0]
    times["generate_100k"] = round(min(gen_runs), 3)
    times["category_lookup_100k"] = round(min(look_runs), 3)
    times["bulk_category_update_100k"] = round(min(upd_runs), 3)
    times["category_update_touched_100k"] = round(min(part_runs), 3)
    times["category_layout_100k"] = round(min(lay_runs), 3)

    total = round(sum(times.values()), 3)
    out = {"metric": "total_sec", "value": total, "unit": "sec", "queries": times, "sf": sf,
           "cold_total": round(cold, 3), "spark": spark.version, "cpus": int(cpus)}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
