"""Identity columns whose values are never used twice (F2).

An identity hands out each number once, even when the newest row is deleted
before the next insert.  ``max(id) + 1`` over the present rows cannot do that,
so a table carries a high-water mark: ``marks/`` under the table root holds one
small row per reservation (version, column, mark), written when a batch takes its
numbers, before its version is published.  The mark of a table is the largest one
there; it never falls.  Reading it is one aggregate over a few rows per version
instead of one over the table.

* A batch that takes numbers and then fails leaves a gap, as an identity does.
* Rows loaded with ids of their own (an import) do not move an identity by
  themselves; ``raise_mark`` moves it past them, so that later numbers are free.
* Two batches that start from one version reserve for the same next version:
  the folder of that reservation exists already and the second one fails, as its
  publication would.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import assign_ids
from . import snapshot_store as store

_SCHEMA = "id_col string, mark long"


def _marks_root(root: str) -> str:
    return f"{root.rstrip('/')}/marks"


def current_mark(spark: SparkSession, root: str, id_col: str) -> int:
    """The largest number that was ever handed out or raised to."""
    marks = spark.read.schema(f"{_SCHEMA}, version long").parquet(_marks_root(root))
    return int(marks.filter(F.col("id_col") == id_col).agg(F.max("mark")).first()[0] or 0)


def write_mark(spark: SparkSession, root: str, version: int, marks: dict[str, int]) -> None:
    """Reserve up to ``marks`` for version ``version`` (once per version)."""
    rows = spark.createDataFrame(sorted(marks.items()), _SCHEMA).coalesce(1)
    rows.write.mode("errorifexists").parquet(store.version_path(_marks_root(root), version))


def publish_first(df: DataFrame, root: str, id_cols: list[str], version: int = 1) -> DataFrame:
    """Publish the first version of a table; its marks start at the largest ids."""
    spark = df.sparkSession
    path = store.publish(df, root, version)
    out = spark.read.parquet(path)
    top = out.agg(*[F.max(F.col(c)).cast("long").alias(c) for c in id_cols]).first()
    write_mark(spark, root, version, {c: int(top[c] or 0) for c in id_cols})
    return out


def raise_mark(spark: SparkSession, root: str, version: int, loaded: DataFrame, id_col: str) -> int:
    """Move the mark past the ids that came with loaded rows."""
    top = loaded.agg(F.max(F.col(id_col)).cast("long")).first()[0] or 0
    mark = max(int(top), current_mark(spark, root, id_col))
    write_mark(spark, root, version, {id_col: mark})
    return mark


def take_ids(new_rows: DataFrame, order_cols: list, root: str, version: int, id_col: str) -> DataFrame:
    """``new_rows`` with the next numbers of the identity in the order of
    ``order_cols``; the numbers are reserved for version ``version``."""
    spark = new_rows.sparkSession
    mark = current_mark(spark, root, id_col)
    numbered = assign_ids(new_rows, order_cols, id_col, base=mark)
    taken = numbered.agg(F.max(id_col)).first()[0]          # the checkpointed rows, one column
    write_mark(spark, root, version, {id_col: int(taken) if taken is not None else mark})
    return numbered
