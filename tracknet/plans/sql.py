"""Questions as Spark SQL over the graph tables."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tracknet.operators.model import GraphTables


def run_query(spark: SparkSession, g: GraphTables, sql: str,
              args: dict[str, Any] | None = None, prefix: str = "") -> DataFrame:
    """Run ``sql`` with ``nodes`` and ``relationships`` registered as views.
    Named parameters (``:name``) are bound from ``args``, never pasted into
    the text."""
    g.views(prefix)
    return spark.sql(sql, args=args or {})
