"""CSV and stored-table readers.

Blank fields and NaN become NULL; a field that does not fit its type raises
(FAILFAST).  Schemas are explicit, so no file is read to guess one, and only the
listed columns are parsed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import nan_to_null
from .tables import require_columns

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"
GENERATION_SCHEMA = "ts TIMESTAMP_NTZ, fuel_type STRING, volume DOUBLE, unit_id BIGINT"


def _clean(df: DataFrame) -> DataFrame:
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: nan_to_null(c) for c in floats}) if floats else df


def read_csv(spark: SparkSession, path, schema, time_format: str = TIME_FORMAT) -> DataFrame:
    """``path`` is a file, a folder, a glob or a list of them, all of one schema."""
    return (spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").option("nullValue", "")
                 .option("timestampNTZFormat", time_format).option("enforceSchema", False).csv(path))


def read_price(spark: SparkSession, path, schema, columns: Sequence[str], ts_col: str = "ts", **how) -> DataFrame:
    """Wide table; ``ts_col`` (renamed ts) and ``columns`` only."""
    df = require_columns(read_csv(spark, path, schema, **how), [ts_col, *columns])
    return _clean(df.select(F.col(ts_col).alias("ts"), *columns))


def read_generation(spark: SparkSession, path, schema=GENERATION_SCHEMA, **how) -> DataFrame:
    """Many files of one schema; ``file`` keeps the file that a row came from."""
    df = read_csv(spark, path, schema, **how)
    return _clean(df.select("*", F.col("_metadata.file_path").alias("file")))


def file_counts(readings: DataFrame) -> DataFrame:
    """Rows of each input file."""
    return readings.groupBy("file").agg(F.count(F.lit(1)).alias("rows_in_file"))


def load_hourly(spark: SparkSession, path, schema, required: Sequence[str], ts_col: str = "ts", **how) -> DataFrame:
    """Stored merged table, required columns checked, in time order."""
    return read_price(spark, path, schema, required, ts_col, **how).orderBy("ts")


def write_csv(df: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    out = df.write.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    (out.partitionBy(*by) if by else out).csv(path)
