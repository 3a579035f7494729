"""Delimited text sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.calendar import parse_timestamp
from quayside.operators.projections import blanks_to_null
from quayside.sources.quoted import place, quoted_rows

DAY_FIRST = ("dd/MM/yyyy HH:mm:ss", "dd/MM/yyyy HH:mm", "dd/MM/yyyy")


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: str,
    columns: Sequence[str] | None = None,
    sep: str = ",",
    encoding: str = "ISO-8859-1",
) -> DataFrame:
    """Delimited file with a header; only the named columns are parsed."""
    df = (
        spark.read.schema(schema)
        .option("header", True)
        .option("sep", sep)
        .option("encoding", encoding)
        .option("escape", '"')
        .option("enforceSchema", True)
        .csv(path)
    )
    return df.select(*columns) if columns else df


def read_booking_export(
    spark: SparkSession, path: str, schema: str, skip_rejects: bool = False
) -> DataFrame:
    """Export with title and header lines above the data and line breaks inside quotes.

    The header is the first row of a file whose first cell is the name of the schema's first column, in any
    case. It and the rows above it are dropped, and so are rows of which only the first cell holds
    anything (a title in a file of its own). Any other row whose first column is no day-first date is an
    error, or with `skip_rejects` left out and listed by `booking_rejects`. Large files are read by many tasks.
    """
    raw = _booking_rows(spark, path, schema)
    first = _names(raw)[0]
    date = F.to_date(parse_timestamp(first, ["dd/MM/yyyy"]))
    if not skip_rejects:
        fault = F.raise_error(F.concat(F.lit("a booking has no day-first date but: "), F.coalesce(first, F.lit("nothing"))))
        date = F.when(_is_reject(raw), fault.cast("date")).otherwise(date)
    return raw.withColumn(first, date).filter(F.col(first).isNotNull() & ~F.col("_above")).drop("_above")


def booking_rejects(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of data in an export whose first column is no day-first date, as text."""
    raw = _booking_rows(spark, path, schema)
    return raw.filter(_is_reject(raw)).drop("_above")


def _names(raw: DataFrame) -> list[str]:
    return [c for c in raw.columns if c != "_above"]


def _is_reject(raw: DataFrame) -> Column:
    """No date, below the header, and with further cells."""
    first, *rest = _names(raw)
    further = F.coalesce(*(F.nullif(F.trim(c), F.lit("")) for c in rest)).isNotNull()
    no_date = F.to_date(parse_timestamp(first, ["dd/MM/yyyy"])).isNull()
    return no_date & further & ~F.col("_above")


def _booking_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All rows of an export; `_above` marks headers and what stands above one in its file."""
    rows = quoted_rows(spark, path, schema)
    first = rows.columns[3]
    is_header = F.lower(F.trim(first)) == first.lower()
    # One row per file that has a header.
    headers = rows.filter(is_header).groupBy("file").agg(F.min(place()).alias("_header"))
    above = F.coalesce(place() <= F.col("_header"), F.lit(False)) | F.coalesce(is_header, F.lit(False))
    return rows.join(headers, "file", "left").withColumn("_above", above).drop("file", "block", "line", "_header")


def read_state_file(
    spark: SparkSession, path: str, schema: str, date_cols: Sequence[str] = ()
) -> DataFrame:
    """`;`-separated state file with day-first dates; unparsable dates become NULL."""
    df = read_delimited(spark, path, schema, sep=";", encoding="UTF-8")
    return df.withColumns({c: parse_timestamp(c, DAY_FIRST) for c in date_cols})


def read_sheet(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """All-text sheet, first row header, blank means missing.

    An empty or header-only sheet gives an empty frame of the same schema.
    """
    schema = ", ".join(f"{c} string" for c in columns)
    return blanks_to_null(read_delimited(spark, path, schema, encoding="UTF-8"))
