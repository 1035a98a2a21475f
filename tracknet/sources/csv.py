"""Raw CSV readers for the two source files.

Both readers take an explicit schema by default so that the scan needs no
inference pass over the data; ``infer=True`` keeps the inferring form for
files whose layout is unknown.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column names of the two source files.
STATION_COLUMNS = ["ID", "Station_Name", "Latitude", "Longitude", "Zone", "Postcode"]
CONNECTION_COLUMNS = ["Tube_Line", "From_Station", "To_Station"]

# Stations are read as text and cast afterwards (``clean_stations``), so a bad
# value turns into NULL instead of failing the whole scan.
RAW_STATION_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType(), True) for c in STATION_COLUMNS])
CONNECTION_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType(), True) for c in CONNECTION_COLUMNS])


def read_stations(spark: SparkSession, path: str, infer: bool = False) -> DataFrame:
    """Stations file with a header row."""
    reader = spark.read.option("header", True)
    if infer:
        reader = reader.option("inferSchema", True)
    else:
        reader = reader.schema(RAW_STATION_SCHEMA)
    return reader.csv(path)


def read_connections(spark: SparkSession, path: str) -> DataFrame:
    """Connections file with a header row; every column is a string."""
    return spark.read.option("header", True).schema(CONNECTION_SCHEMA).csv(path)


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Attach a row counter that is filled by whichever action runs ``df``.

    Used to report source counts without a separate counting job.
    """
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def write_csv(df: DataFrame, path: str, *parts: str) -> None:
    """CSV with a header; a folder for each value of the columns ``parts``."""
    w = df.write.mode("overwrite").option("header", True)
    (w.partitionBy(*parts) if parts else w).csv(path)
