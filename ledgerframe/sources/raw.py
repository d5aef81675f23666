"""Raw payload tables: reading them in batch or as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: A decoded payload, or an error, of one request.
RAW_SCHEMA = "cursor bigint, method string, result string, error string, meta string"


def read_raw(spark: SparkSession, path: str, format: str = "parquet", stream: bool = False, max_files: int | None = None) -> DataFrame:
    """raw(cursor, method, result, error, meta) under path, with its fixed schema; as a stream, max_files limits a micro-batch."""
    reader = (spark.readStream if stream else spark.read).schema(RAW_SCHEMA)
    if stream and max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.format(format).load(path)
