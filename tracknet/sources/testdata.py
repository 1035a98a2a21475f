"""Projections of the shared test tables onto the station/connection model.

The test folders hold order-entry tables, not a railway, so the network is
derived from them (and grows with them):

* stations: one per customer; the zone is the customer's region + 1, and a
  customer with a negative balance has no zone; the postcode is ``N<nation>``.
* connections: the customer of order ``k`` is connected to the customer of
  order ``k + 1``, on the line named after order ``k``'s priority with ``-``
  written as `` & `` (``1-URGENT`` -> ``1 & URGENT``). This is an equi-join on
  the unique order key, so no group of rows is funnelled into a single task.

The extended network adds a station per supplier, sorted by its balance into
the cases that a clean projection lacks (``SUPPLIER_CASES``): depots, two of
which may share a name, stations without any connection, with one, with one on a line without a
name, and with one to a station that is not there.

The same projections are written in DuckDB SQL in ``__spark_entry__``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def station_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations in the cleaned layout (``station_id long, name, latitude,
    longitude, zone int, postcode``)."""
    customer = _table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal")
    nation = _table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    j = customer.join(nation, customer.c_nationkey == nation.n_nationkey)
    key = F.col("c_custkey")
    return j.select(
        key.cast("long").alias("station_id"),
        F.col("c_name").alias("name"),
        (F.lit(51.0) + (key % 1000).cast("double") / F.lit(1000.0)).alias("latitude"),
        (F.lit(-0.5) + (key % 700).cast("double") / F.lit(1000.0)).alias("longitude"),
        F.when(F.col("c_acctbal") < 0, F.lit(None).cast("int"))
        .otherwise(F.col("n_regionkey") + 1).cast("int").alias("zone"),
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("postcode"),
    )


def raw_station_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations in the raw file layout, every value as text."""
    return as_raw_stations(station_rows(spark, sf_dir))


def as_raw_stations(s: DataFrame) -> DataFrame:
    """Cleaned stations in the raw file layout."""
    return s.select(
        F.col("station_id").cast("string").alias("ID"),
        F.col("name").alias("Station_Name"),
        F.col("latitude").cast("string").alias("Latitude"),
        F.col("longitude").cast("string").alias("Longitude"),
        F.col("zone").cast("string").alias("Zone"),
        F.col("postcode").alias("Postcode"),
    )


def connection_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Connections in the raw layout (``Tube_Line, From_Station, To_Station``)."""
    orders = _table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority")
    customer = _table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    a = orders.alias("a")
    b = orders.select(F.col("o_orderkey").alias("b_key"),
                      F.col("o_custkey").alias("b_cust"))
    pairs = a.join(b, F.col("b_key") == F.col("a.o_orderkey") + 1)
    ca = customer.select(F.col("c_custkey").alias("ca_key"), F.col("c_name").alias("From_Station"))
    cb = customer.select(F.col("c_custkey").alias("cb_key"), F.col("c_name").alias("To_Station"))
    out = (pairs.join(ca, F.col("ca_key") == F.col("a.o_custkey"))
           .join(cb, F.col("cb_key") == F.col("b_cust")))
    return out.select(
        F.replace(F.col("o_orderpriority"), F.lit("-"), F.lit(" & ")).alias("Tube_Line"),
        "From_Station", "To_Station")


#: Least balance of each case, from the greatest down; below all of them a depot.
SUPPLIER_CASES = [("unknown", 8000), ("no_line", 6500), ("feeder", 4500), ("isolated", 3000)]
#: Suppliers' ids start behind those of all customers.
SUPPLIER_BASE = 10**12


def _suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = _table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    nation = _table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    case = F.lit("depot")
    for name, least in reversed(SUPPLIER_CASES):
        case = F.when(F.col("s_acctbal") >= least, F.lit(name)).otherwise(case)
    depot = case == "depot"
    return supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey", "n_nationkey", "n_regionkey", case.alias("case"),
        F.when(depot, F.concat(F.lit("Depot "), F.floor(F.col("s_suppkey") / 2).cast("string"))).otherwise(F.col("s_name")).alias("name"))


def supplier_station_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stations that the extended network adds, in the cleaned layout."""
    return _suppliers(spark, sf_dir).select(
        (F.lit(SUPPLIER_BASE) + F.col("s_suppkey")).cast("long").alias("station_id"), "name",
        F.lit(52.0).alias("latitude"), F.lit(0.5).alias("longitude"),
        F.when(F.col("case") != "depot", F.col("n_regionkey") + 1).cast("int").alias("zone"),
        F.concat(F.lit("S"), F.col("n_nationkey").cast("string")).alias("postcode"))


def supplier_connection_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The connections that the extended network adds, in the raw layout: each
    to the customer of the supplier's number, or to nowhere."""
    customer = _table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    s = _suppliers(spark, sf_dir).filter("case <> 'isolated'")
    return s.join(customer, F.col("c_custkey") == F.col("s_suppkey")).select(
        F.when(F.col("case") == "feeder", F.lit("Feeder")).when(F.col("case") == "depot", F.lit("Depot & Yard"))
        .when(F.col("case") == "unknown", F.lit("Feeder")).alias("Tube_Line"),
        F.col("name").alias("From_Station"),
        F.when(F.col("case") == "unknown", F.concat(F.lit("Nowhere "), F.col("s_suppkey").cast("string"))).otherwise(F.col("c_name")).alias("To_Station"))


def load_graph(spark: SparkSession, sf_dir: str, extended: bool = False):
    """The graph built from the projections, through the normal build path."""
    from tracknet.operators.model import build_graph

    stations = station_rows(spark, sf_dir)
    if extended:
        stations = stations.unionByName(supplier_station_rows(spark, sf_dir))
    return build_graph(stations, load_connections(spark, sf_dir, extended))


def load_connections(spark: SparkSession, sf_dir: str, extended: bool = False) -> DataFrame:
    from tracknet.operators.model import clean_connections

    raw = connection_rows(spark, sf_dir)
    return clean_connections(raw.unionByName(supplier_connection_rows(spark, sf_dir)) if extended else raw)
