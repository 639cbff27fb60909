"""CSV files: configured columns only, everything as text, stamped with technical columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The last yyyyMM that stands alone in a path: .../datos_202601.zip, .../202601/Proveedores.csv
PERIOD_IN_PATH = r"^.*(?<![0-9A-Za-z])(20\d{2}(?:0[1-9]|1[0-2]))(?![0-9A-Za-z])"
# The reader's stand-in for a quoted empty field, which it would otherwise merge with a missing one.
QUOTED_EMPTY = "\u0001"


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def csv_options(multiline: bool = False, sep: str = ",", encoding: str = "UTF-8") -> dict[str, str]:
    """Quotes are doubled, and a broken row stops the load.

    ``multiline`` allows line breaks inside quotes, but such a file can no longer be split.
    """
    return {
        "header": "true",
        "enforceSchema": "false",
        "mode": "FAILFAST",
        "columnPruning": "false",  # a pruned parser would not notice rows that are too short
        "quote": '"',
        "escape": '"',
        "emptyValue": QUOTED_EMPTY,
        "sep": sep,
        "encoding": encoding,
        "multiLine": str(multiline).lower(),
    }


def match_columns(available: Sequence[str], wanted: Sequence[str]) -> list[Column]:
    """Wanted columns picked from a header, whatever its letter case.

    An unquoted empty field is NULL and a quoted one is empty text.
    """
    by_name = {name.strip().lower(): name for name in available}
    missing = [w for w in wanted if w.lower() not in by_name]
    if missing:
        raise ValueError(f"columns {missing} are not in the header {list(available)}")
    fields = {w: F.col(f"`{by_name[w.lower()]}`") for w in wanted}
    return [F.when(f == QUOTED_EMPTY, "").otherwise(f).alias(w) for w, f in fields.items()]


def scan_csv(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    header: Sequence[str] | None = None,
    **options,
) -> DataFrame:
    """The configured columns of all CSV files under ``path``.

    ``header`` lists every column of the files; left out, it is read from the first file.  Each
    file's own header is checked against it, so files with another column order fail loudly.
    """
    if header is None:
        header = spark.read.options(**csv_options(**options)).csv(path).columns
    rows = spark.read.schema(text_schema(header)).options(**csv_options(**options)).csv(path)
    return rows.select(*match_columns(header, columns))


def stamp(
    df: DataFrame, batch_id: str, period: str | None = None, period_pattern: str = PERIOD_IN_PATH
) -> DataFrame:
    """Adds etl_period, source_file, loaded_at and batch_id to rows read from files.

    The period is the caller's, or is found in the file path by ``period_pattern``; a path without
    one stops the load.  One batch id marks the whole load.
    """
    etl_period = F.lit(period) if period else period_of(F.col("_metadata.file_path"), period_pattern)
    return df.select("*", *technical_columns(etl_period, F.col("_metadata.file_name"), batch_id))


def period_of(path: Column, pattern: str = PERIOD_IN_PATH) -> Column:
    found = F.nullif(F.regexp_extract(path, pattern, 1), F.lit(""))
    return F.coalesce(found, F.raise_error(F.concat(F.lit("no period in "), path)))


def technical_columns(etl_period: Column, source_file: Column, batch_id: str) -> list[Column]:
    return [
        etl_period.alias("etl_period"),
        source_file.alias("source_file"),
        F.current_timestamp().cast("timestamp_ntz").alias("loaded_at"),
        F.lit(batch_id).alias("batch_id"),
    ]
