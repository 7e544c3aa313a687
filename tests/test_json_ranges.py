"""Array files read in byte ranges, and the array export."""

import json
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.session import scratch_dir
from quire.sources import files as io
from quire.sources import json_ranges as ranges


def elements(n, seed):
    r = random.Random(seed)
    kinds = [lambda i: {"a": i, "t": '}{][",\\' * r.randrange(4), "n": {"x": [1, {"y": "}"}]}}, lambda i: [i, [2, "]"]], lambda i: i,
             lambda i: "s,}]", lambda i: None, lambda i: {"e": "\\" * r.randrange(5) + '"'}, lambda i: {"u": "Жя" * r.randrange(9)},
             lambda i: {}, lambda i: ""]
    return [r.choice(kinds)(i) for i in range(n)]


@pytest.fixture
def folder(spark, tmp_path):
    yield tmp_path
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("size", ["60", "900", "1m"])
def test_arrays_of_any_layout_in_ranges(spark, folder, size):
    one, two = elements(150, 1), elements(80, 2)
    (folder / "compact.json").write_text(json.dumps(one, separators=(",", ":"), ensure_ascii=False), "utf-8")
    (folder / "pretty.json").write_text(json.dumps(two, indent=3) + "\n\n", "utf-8-sig")
    (folder / "empty.json").write_text(" [ \n] ")
    bad = {"cut.json": '[{"a":1},{"a":', "after.json": '[{"a":1}] {"x":2}', "object.json": '{"a":[1]}', "two.json": "[1][2]",
           "string.json": '["abc', "scalar.json": "17", "after_object.json": "{\"a\":1} [1]"}
    for name, text in bad.items():
        (folder / name).write_text(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    rows, files = ranges.array_elements(spark, str(folder))
    key = lambda x: json.dumps(x, sort_keys=True)                              # noqa: E731
    assert sorted(key(json.loads(r.raw)) for r in rows.collect()) == sorted(map(key, one + two))
    assert {os.path.basename(r.file) for r in files.collect()} == set(bad)


def test_one_file_is_read_by_several_tasks(spark, folder):
    (folder / "big.json").write_text(json.dumps(elements(500, 3), separators=(",", ":")))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    starts = ranges.starts_of(ranges._pieces(spark, str(folder))).collect()
    assert len(starts) > 8 and {s.state for s in starts} >= {0}
    tasks = ranges._pieces(spark, str(folder)).select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks > 8


def test_scan_equals_a_walk_over_the_bytes():
    r = random.Random(4)
    for _ in range(200):
        raw = bytes(r.choice(b'"\\{}[],ab') for _ in range(r.randrange(1, 60)))
        for state in (ranges.OUTSIDE, ranges.INSIDE, ranges.ESCAPED):
            inside, deep, end = ranges.scan(np.frombuffer(raw, np.uint8), state, 2)
            s, d = state, 2
            for k, c in enumerate(raw):
                assert inside[k] == (s != ranges.OUTSIDE) and deep[k] == d
                if s == ranges.ESCAPED:
                    s = ranges.INSIDE
                elif s == ranges.INSIDE:
                    s = {34: ranges.OUTSIDE, 92: ranges.ESCAPED}.get(c, s)
                elif c == 34:
                    s = ranges.INSIDE
                elif c == 92:
                    break                                                       # no JSON text
                else:
                    d += (c in b"{[") - (c in b"}]")
            else:
                assert (end, deep[-1]) == (s, d)


def test_typed_split_import_has_rejects(spark, folder):
    good = {"book_id": 1, "isbn": "i", "title": "}, {", "price": 1.5, "stock": 3, "attributes_json": {"pages": 4},
            "created_at": "2024-01-02 03:04:05"}
    (folder / "a.json").write_text(json.dumps([good, {"book_id": "x"}, 5, {"price": "n/a"}]))
    (folder / "b.json").write_text("[{")
    rows, rejects = io.read_books_json_split(spark, str(folder))
    got = rows.collect()
    assert [(r.book_id, r.title, r.attributes_json) for r in got] == [(1, "}, {", '{"pages": 4}')] or \
        [(r.book_id, r.title, json.loads(r.attributes_json)) for r in got] == [(1, "}, {", {"pages": 4})]
    assert sorted(r.reason for r in rejects.collect()) == sorted([io.MALFORMED] * 3 + [ranges.NOT_ARRAY])


def test_array_export_without_python_workers(spark):
    objects = spark.range(500).select(F.to_json(F.struct("id")).alias("value"))
    lines = io.array_lines(objects, 7)
    assert "Python" not in lines._jdf.queryExecution().executedPlan().toString()
    path = scratch_dir(spark, "t-arrays")
    lines.write.text(path)
    folder = path.removeprefix("file:")
    arrays = [json.load(open(f"{folder}/{f}")) for f in os.listdir(folder) if f.endswith(".txt")]
    assert len(arrays) == 7 and sorted(x["id"] for a in arrays for x in a) == list(range(500))
    empty = scratch_dir(spark, "t-arrays")
    io.array_lines(objects.limit(0), 2).write.text(empty)
    folder = empty.removeprefix("file:")
    assert [json.load(open(f"{folder}/{f}")) for f in os.listdir(folder) if f.endswith(".txt")] == [[], []]
