"""From the two raw tables to the graph tables.

``nodes``: one row per station (``label, station_id, name, latitude, longitude,
zone, postcode``). ``relationships``: ``src_id, dst_id, rel_type``; every
connection is stored in both directions, one type per line, so two stations
joined by k lines have k relationships each way. Endpoints are matched by
station *name*: an unknown name leaves the connection out of the graph and in
``quarantine`` instead, a name shared by two stations fans the edge out.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracknet.functions.names import rel_type_name

NODE_LABEL = "Station"
NODE_COLUMNS = ["station_id", "name", "latitude", "longitude", "zone", "postcode"]
REL_COLUMNS = ["src_id", "dst_id", "rel_type"]


@dataclass
class GraphTables:
    nodes: DataFrame
    relationships: DataFrame
    quarantine: DataFrame | None = None

    def views(self, prefix: str = "") -> None:
        """Register ``nodes`` and ``relationships`` as temporary views."""
        self.nodes.createOrReplaceTempView(prefix + "nodes")
        self.relationships.createOrReplaceTempView(prefix + "relationships")


def clean_stations(raw: DataFrame) -> DataFrame:
    """Rename and type the raw station columns.

    ``try_cast`` gives NULL for a value that does not parse (the behaviour of a
    non-ANSI cast), so one bad cell does not fail the load. ``zone`` is an
    integer; a value such as ``2,3`` becomes NULL. :func:`rejected_stations`
    reports what is lost that way.
    """
    return raw.select(
        F.col("ID").try_cast("bigint").alias("station_id"),
        F.col("Station_Name").cast("string").alias("name"),
        F.col("Latitude").try_cast("double").alias("latitude"),
        F.col("Longitude").try_cast("double").alias("longitude"),
        F.col("Zone").try_cast("int").alias("zone"),
        F.col("Postcode").cast("string").alias("postcode"),
    )


def rejected_stations(raw: DataFrame) -> DataFrame:
    """Raw station rows that lose something in :func:`clean_stations`, with the
    reason: ``no_key`` and ``bad_key`` rows cannot be nodes, ``bad_zone`` rows
    become nodes without a zone. The text of the cells is kept."""
    key, zone = F.col("ID").cast("string"), F.col("Zone").cast("string")
    reason = (F.when(key.isNull() | (F.trim(key) == ""), F.lit("no_key"))
              .when(F.col("ID").try_cast("bigint").isNull(), F.lit("bad_key"))
              .when(zone.isNotNull() & (F.trim(zone) != "") & F.col("Zone").try_cast("int").isNull(), F.lit("bad_zone")))
    return (raw.select(key.alias("id_text"), F.col("Station_Name").cast("string").alias("name"), zone.alias("zone_text"), reason.alias("reason"))
            .filter(F.col("reason").isNotNull()))


def clean_connections(raw: DataFrame) -> DataFrame:
    """Lower-case the connection columns; values stay as they are."""
    return raw.select(
        F.col("Tube_Line").alias("tube_line"),
        F.col("From_Station").alias("from_station"),
        F.col("To_Station").alias("to_station"),
    )


def station_nodes(stations: DataFrame) -> DataFrame:
    """Nodes from cleaned stations; a row without a key cannot be a node."""
    return stations.filter(F.col("station_id").isNotNull()).select(
        F.lit(NODE_LABEL).alias("label"), *NODE_COLUMNS)


def resolve_connections(connections: DataFrame, nodes: DataFrame) -> DataFrame:
    """Connections with both endpoint names matched to station ids.

    Two equi-joins on the name. The physical join is left to the optimizer:
    with AQE a station table below the broadcast threshold (measured at run
    time, not guessed) is broadcast, a larger one is shuffled; a name that
    carries a large share of connections is split by the skew-join rule.
    """
    names = nodes.select("name", "station_id")
    src = names.select(F.col("name").alias("_sn"), F.col("station_id").alias("src_id"))
    dst = names.select(F.col("name").alias("_dn"), F.col("station_id").alias("dst_id"))
    return (
        connections.filter(F.col("tube_line").isNotNull())
        .join(src, F.col("from_station") == F.col("_sn"))
        .join(dst, F.col("to_station") == F.col("_dn"))
        .select("src_id", "dst_id", rel_type_name("tube_line").alias("rel_type"))
    )


def both_directions(resolved: DataFrame) -> DataFrame:
    """Each resolved connection as a forward and a reverse relationship.

    A generator over a two-element array doubles the rows in the same scan,
    rather than a union that would evaluate the joins twice.
    """
    pair = F.array(
        F.struct(F.col("src_id").alias("a"), F.col("dst_id").alias("b")),
        F.struct(F.col("dst_id").alias("a"), F.col("src_id").alias("b")),
    )
    return (resolved.select(F.explode(pair).alias("_e"), "rel_type")
            .select(F.col("_e.a").alias("src_id"), F.col("_e.b").alias("dst_id"), "rel_type"))


def unmatched_connections(connections: DataFrame, nodes: DataFrame) -> DataFrame:
    """Connections left out of the graph, with the reason.

    Left joins against the *distinct* names, so a duplicated name does not
    repeat the row; each raw row appears at most once.
    """
    known = nodes.select("name").distinct()
    f_ok = known.select(F.col("name").alias("_fk"), F.lit(True).alias("_from_ok"))
    t_ok = known.select(F.col("name").alias("_tk"), F.lit(True).alias("_to_ok"))
    flagged = (connections
               .join(f_ok, F.col("from_station") == F.col("_fk"), "left")
               .join(t_ok, F.col("to_station") == F.col("_tk"), "left"))
    reason = (F.when(F.col("tube_line").isNull(), F.lit("null_line"))
              .when(F.col("_from_ok").isNull() & F.col("_to_ok").isNull(), F.lit("unknown_both"))
              .when(F.col("_from_ok").isNull(), F.lit("unknown_from"))
              .when(F.col("_to_ok").isNull(), F.lit("unknown_to")))
    return (flagged.withColumn("reason", reason)
            .filter(F.col("reason").isNotNull())
            .select("tube_line", "from_station", "to_station", "reason"))


def build_relationships(connections: DataFrame, nodes: DataFrame) -> DataFrame:
    return both_directions(resolve_connections(connections, nodes))


def build_graph(stations: DataFrame, connections: DataFrame) -> GraphTables:
    """Cleaned stations and cleaned connections to the graph tables."""
    nodes = station_nodes(stations)
    return GraphTables(
        nodes=nodes,
        relationships=build_relationships(connections, nodes),
        quarantine=unmatched_connections(connections, nodes),
    )


def upsert_nodes(existing: DataFrame, incoming: DataFrame, key: str = "station_id") -> DataFrame:
    """Keyed overwrite: one node per key, incoming properties win, existing
    nodes whose key is not in ``incoming`` stay.

    Duplicate keys inside ``incoming`` are reduced with a grouped ``max`` of
    the row as a struct: a partial (map-side) aggregate, so a key repeated
    in a large share of the rows is combined before the shuffle instead of
    being gathered in one task. The result is deterministic.
    """
    cols = [c for c in incoming.columns if c != key]
    best = (incoming.filter(F.col(key).isNotNull())
            .groupBy(key).agg(F.max(F.struct(*cols)).alias("_row"))
            .select(key, *[F.col("_row." + c).alias(c) for c in cols]))
    keep = existing.join(best.select(key), key, "left_anti")
    return keep.unionByName(best.select(*existing.columns))


def append_relationships(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Append without de-duplication: loading the same edges twice gives
    parallel relationships, as an append into the graph does."""
    return existing.unionByName(incoming.select(*existing.columns))
