"""Literal row sources (small, driver-held lists of records)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

METADATA_SCHEMA = T.StructType([
    T.StructField("coin_id", T.StringType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("categories", T.StringType()),
    T.StructField("genesis_date", T.StringType()),
    T.StructField("hashing_algorithm", T.StringType()),
    T.StructField("extracted_at", T.StringType()),
])

def metadata_rows(spark: SparkSession, rows: Sequence[dict],
                  extracted_at: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Records -> silver metadata table; a missing ``extracted_at`` gets
    the load timestamp (text ``yyyy-MM-ddTHH:mm:ssZ``)."""
    data = [tuple(r.get(f.name, extracted_at if f.name == "extracted_at" else None)
                  for f in METADATA_SCHEMA.fields) for r in rows]
    return spark.createDataFrame(data, METADATA_SCHEMA)
