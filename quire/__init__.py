"""quire: retail catalogue and order analytics expressed as Spark DataFrame jobs.

Every public function takes DataFrames (or a SparkSession plus a data
directory) and returns DataFrames.  Nothing is collected to the driver except
bounded scalars (a max id, one count per partition).
"""

__all__ = ["schemas", "session"]
