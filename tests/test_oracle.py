"""Every registered key against its DuckDB oracle on the smallest tables
(the driver repeats this at sf0.01)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from oracle_check import compare, duck  # noqa: E402

from quire.plans import load_all  # noqa: E402

REG = load_all()


@pytest.fixture(scope="module")
def con(small_dir):
    return duck(small_dir)


@pytest.mark.parametrize("name", sorted(REG))
def test_matches_oracle(spark, con, small_dir, name):
    status, n, _, msg = compare(spark, con, name, REG[name], small_dir)
    assert status == "ok", msg
    assert n >= 0


def test_entry_contract(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["book_id", "title", "author", "qty", "revenue"]
    q, sql = e.queries(), e.oracle_sql()
    assert set(sql) <= set(q)
    assert set(REG) <= set(q)
    assert set(REG) <= set(sql)


def test_money_columns_declared(spark, small_dir):
    """Registered outputs carry no DECIMAL columns (money is presented as
    DOUBLE) and every presented column is declared for the SQL side."""
    from pyspark.sql.types import DecimalType, DoubleType
    from quire.plans import MONEY_COLUMNS
    for name, cols in MONEY_COLUMNS.items():
        df = REG[name].build(spark, small_dir)
        types = {f.name: f.dataType for f in df.schema.fields}
        assert all(isinstance(types[c], DoubleType) for c in cols), name
        assert not any(isinstance(t, DecimalType) for t in types.values()), name


def test_cli_lists_every_key(capsys):
    from quire.__main__ import main
    assert main(["--list"]) == 0
    out = capsys.readouterr().out.splitlines()
    assert {line.split()[0] for line in out} == set(REG)
