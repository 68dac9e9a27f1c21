"""Dictionary joins: the known-airport semi join and the code -> name lookup.

Dictionaries are small in practice (a few hundred airports, a few dozen
airlines), but they are inputs, so nothing is hinted.  A run writes them once as
a small table (``StateStore.write_dictionaries``) and reads that: its file size is
exact, so Catalyst broadcasts it below ``spark.sql.autoBroadcastJoinThreshold`` and
shuffles it above, and AQE looks again at run time.  No job runs to find out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_known(df: DataFrame, column: str, codes: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``column`` is a code of the dictionary (left semi join)."""
    keys = codes.select(F.col("code").alias(column))
    return df.join(keys, on=column, how="left_semi")


def lookup_name(df: DataFrame, dictionary: DataFrame, code_col: str, name_col: str) -> DataFrame:
    """Add ``name_col`` = name of ``code_col``; rows with an unknown code are dropped.

    ``dictionary`` is ``(code, name)`` with unique codes.
    """
    d = dictionary.select(F.col("code").alias(code_col), F.col("name").alias(name_col))
    return df.join(d, on=code_col, how="inner")
