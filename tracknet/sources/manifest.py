"""Landing-folder manifest: which CSV files are there, how big, how many rows."""

from __future__ import annotations

import warnings

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST_SCHEMA = "file string, path string, bytes long, rows long"


def _decoded(name: str) -> Column:
    """A path of the metadata column as it is spelled in the file system."""
    return F.url_decode(F.replace(F.col(name), F.lit("+"), F.lit("%2B")))


def ingest_manifest(spark: SparkSession, folder: str, pattern: str = "*.csv",
                    recursive: bool = True) -> DataFrame:
    """One row per matching file: base name, full path, size in bytes and data
    rows (header excluded), in path order; files are told apart by their path. A missing folder gives an empty
    result and a warning instead of an error.

    File listing and row counts are both distributed reads; the file
    contents are never selected from the binary source, so only metadata is
    read there.
    """
    try:
        files = (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
                 .option("recursiveFileLookup", str(recursive).lower()).load(folder)
                 .select(_decoded("_metadata.file_path").alias("path"), _decoded("_metadata.file_name").alias("file"),
                         F.col("length").alias("bytes")))
        one_col = T.StructType([T.StructField("_c0", T.StringType())])
        rows = (spark.read.schema(one_col).option("header", True)
                .option("pathGlobFilter", pattern)
                .option("recursiveFileLookup", str(recursive).lower()).csv(folder)
                .select(_decoded("_metadata.file_path").alias("path"))
                .groupBy("path").agg(F.count(F.lit(1)).alias("rows")))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            warnings.warn(f"landing folder {folder} not found; nothing to ingest")
            return spark.createDataFrame([], MANIFEST_SCHEMA)
        raise
    return (files.join(rows, "path", "left")
            .select("file", "path", "bytes", F.coalesce("rows", F.lit(0)).cast("long").alias("rows"))
            .orderBy("path"))
