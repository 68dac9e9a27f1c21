"""Text sinks: metric files in the original line format, and text inputs.

The original job writes every metric as plain lines ``value,value,...``
(no header, no quoting).  ``write_metric_lines`` writes the same lines
with Spark's text writer, ordered by the given columns across part files;
``read_metric_lines`` reads such a folder back into typed columns.

``write_text_with_header`` writes a one-column frame of lines as text
files that start with a header line, the layout the input readers
expect (flights and dictionary files).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_WHOLE_LINE_SEP = "\u001f"


def write_metric_lines(df: DataFrame, path: str, columns: list[str], order_by: list[str]) -> None:
    """``columns`` joined by ',' per row, globally ordered by ``order_by``."""
    line = F.concat_ws(",", *[F.col(c).cast("string") for c in columns]).alias("value")
    df.orderBy(*order_by).select(line).write.mode("errorifexists").text(path)


def read_metric_lines(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Lines written by ``write_metric_lines`` back into the typed ``schema``."""
    st = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    parts = F.split(F.col("value"), ",", -1)
    return spark.read.text(path).select(
        *[F.get(parts, i).cast(f.dataType).alias(f.name) for i, f in enumerate(st.fields)]
    )


def write_text_with_header(lines: DataFrame, path: str, header: str = "line") -> None:
    """Write the single string column of ``lines`` as text files, each
    beginning with the header line ``header``.

    Uses the CSV writer with a separator that never occurs in the lines,
    so no value is quoted or trimmed and every part file gets the header.
    """
    col = lines.columns[0]
    (
        lines.select(F.col(col).alias(header))
        .write.mode("errorifexists")
        .option("header", True)
        .option("sep", _WHOLE_LINE_SEP)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("emptyValue", "")
        .csv(path)
    )
