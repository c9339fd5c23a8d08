"""Reading paths that may not exist yet."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

# Error conditions of a path without any table in it.
_ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def read_if_present(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """The Parquet table at ``path``, or None when there is none.

    Any other failure is raised: taking an unreadable table for an absent one
    would make a load start over.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in _ABSENT:
            raise
        return None
