"""Delimited-text sources: the flights file and the two code dictionaries.

The original input is comma-separated text without quoting: a line is
split on every ',' and empty fields are kept.  Spark's CSV reader maps
empty fields to NULL and cannot tell a short row from one with empty
trailing fields once columns are pruned, so the lines are read whole
and split with ``split(line, ',', -1)``, which has exactly the wanted
semantics.  Reading goes through the CSV source in single-column mode
so that the header line of every file is dropped by the reader itself
(``header=true``), blank lines are skipped and files are split across
tasks as usual.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import FIELD_POSITIONS, FLIGHT_COLUMNS, MIN_FIELDS
from ..functions import strict_date

# A control character that never appears in comma-separated text.  It is the
# column separator of the single-column read, so a line is one value; a line
# that does contain it spills into a second column and is reported.
_WHOLE_LINE_SEP = "\u001f"
LINE_SCHEMA = "line STRING, _spill STRING"


def _line_reader(spark: SparkSession):
    return (
        spark.read.schema(LINE_SCHEMA)
        .option("header", True)
        .option("sep", _WHOLE_LINE_SEP)
        .option("quote", "")
        .option("escape", "")
        .option("mode", "PERMISSIVE")
    )


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of one or more text files, the first line of each file dropped."""
    return _line_reader(spark).csv(path)


# Longer than any file's age: the source's default skips files a week older than the newest.
MAX_FILE_AGE = "36500d"


def stream_lines(spark: SparkSession, path: str, archive: str | None = None, forget_after: str = MAX_FILE_AGE) -> DataFrame:
    """The same line source as a streaming DataFrame over a directory.

    All files that have arrived form one micro-batch: cutting an arrival into
    several would move the mark after the first, and flights of the same date
    in the others would count as late.

    Without ``archive`` files stay, each is read once whatever its modification
    time, and the source remembers their names for good.  With ``archive``, files of
    a finished batch are moved below that folder (with their whole path), so the
    inbox stays short to list; names older than ``forget_after`` before the newest
    file are forgotten then, and files of such an age that only arrive now are not read.
    """
    moved = {"cleanSource": "archive", "sourceArchiveDir": archive} if archive else {}
    return (
        spark.readStream.schema(LINE_SCHEMA).option("header", True)
        .option("sep", _WHOLE_LINE_SEP).option("quote", "").option("escape", "")
        .option("maxFileAge", forget_after).options(**moved).csv(path)
    )


def _field(fields: Column, name: str) -> Column:
    # ``get`` is NULL past the end of the array (element_at would raise under
    # ANSI); short rows are rejected through ``_problem`` anyway.
    return F.coalesce(F.get(fields, FIELD_POSITIONS[name]), F.lit(""))


def parse_flight_lines(lines: DataFrame) -> DataFrame:
    """Raw flight lines -> the 12 flight columns plus ``_problem``.

    ``_problem`` is NULL for a good row and a message for a row that must
    abort the run: fewer than 31 fields, or year/month/day that do not
    form a real date.  Single-digit months and days get a leading zero
    first.  Surplus fields are ignored.

    Each line is split, and its fields and date are taken from it, exactly once.
    Both steps sit in generators (of one-element arrays): Catalyst neither
    pushes filters below a generator nor merges the projections above it into
    it, so the row check, the date cut and the counts further up read finished
    columns instead of parsing the line again wherever they mention one (filters
    get no common-subexpression elimination).
    """
    split = lines.select(
        "line", "_spill", F.explode(F.array(F.split(F.col("line"), ",", -1))).alias("fields")
    )
    fields = F.col("fields")
    flight_date = strict_date(_field(fields, "year"), _field(fields, "month"), _field(fields, "day"))
    parsed = split.select("line", "_spill", F.inline(F.array(F.struct(
        F.size(fields).alias("_n_fields"),
        flight_date.alias("flight_date"),
        *[_field(fields, c).alias(c) for c in FLIGHT_COLUMNS[1:]],
    ))))
    n_fields = F.col("_n_fields")
    problem = (
        F.when(F.col("_spill").isNotNull(), F.lit("line contains a U+001F character"))
        .when(n_fields < MIN_FIELDS,
              F.concat(F.lit(f"expected at least {MIN_FIELDS} fields, found "), n_fields.cast("string")))
        .when(F.col("flight_date").isNull(), F.lit("year, month and day do not form a date"))
    )
    return parsed.select(
        *FLIGHT_COLUMNS,
        F.when(problem.isNotNull(), F.concat(problem, F.lit(": "), F.col("line"))).alias("_problem"),
    )


def read_flights_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Flights CSV (header line, >= 31 comma-separated fields per row)."""
    return parse_flight_lines(read_lines(spark, path))


def parse_dictionary_lines(lines: DataFrame) -> DataFrame:
    """Dictionary lines ``code,name[,...]`` -> ``(code, name)``, one row per code.

    Fields are split like Java's ``String.split(",")``: trailing empty
    fields are dropped, so a line needs a non-empty field after the code
    (or anything after an empty name).  A line without a name fails the
    query.  When a code occurs twice the later line wins; "later" is the
    order (file path, block offset, position in the block).
    """
    tokens = F.split(F.regexp_replace(F.col("line"), ",+$", ""), ",", -1)
    code = F.when(
        (F.size(tokens) < 2) | (F.col("line") == F.lit("")) | F.col("_spill").isNotNull(),
        F.raise_error(F.concat(F.lit("dictionary line without a name: '"), F.col("line"), F.lit("'"))),
    ).otherwise(F.get(tokens, 0))
    order = F.struct(
        F.col("_metadata.file_path"),
        F.col("_metadata.file_block_start"),
        F.monotonically_increasing_id(),
    )
    return (
        lines.select(code.cast("string").alias("code"), F.get(tokens, 1).alias("name"), order.alias("_pos"))
        .groupBy("code")
        .agg(F.max_by("name", "_pos").alias("name"))
    )


def read_dictionary_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Code dictionary file(s) (airlines.csv / airports.csv)."""
    return parse_dictionary_lines(read_lines(spark, path))
