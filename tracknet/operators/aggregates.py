"""Counting questions over the graph tables.

All grouped counts are hash aggregates with a partial (map-side) step, so a
station that touches a large share of the relationships is reduced to one
row per input partition before anything is shuffled. Whole-set statistics
(min, max, totals) are uncorrelated scalar subqueries, not joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracknet.operators.model import GraphTables


def station_count(g: GraphTables) -> DataFrame:
    return g.nodes.agg(F.count(F.lit(1)).alias("stations"))


def rel_counts(g: GraphTables) -> DataFrame:
    """Relationships per type (each stored direction counts)."""
    return g.relationships.groupBy("rel_type").agg(F.count(F.lit(1)).alias("relationships"))


def rel_counts_ordered(g: GraphTables) -> DataFrame:
    """:func:`rel_counts` with a rank, most relationships first (ties by type).
    The window holds one row per type."""
    rank = F.row_number().over(Window.orderBy(F.col("relationships").desc(), F.col("rel_type").asc_nulls_last()))
    return rel_counts(g).withColumn("rank", rank).orderBy("rank")


def rel_counts_rollup(g: GraphTables) -> DataFrame:
    """Per-type counts and the grand total in one pass. The total row has
    ``rel_type = 'ALL'`` and ``is_total = 1`` (a NULL type stays a group)."""
    return (g.relationships.rollup("rel_type")
            .agg(F.count(F.lit(1)).alias("relationships"),
                 F.grouping_id().cast("int").alias("is_total"))
            .select(F.when(F.col("is_total") == 1, F.lit("ALL"))
                    .otherwise(F.col("rel_type")).alias("rel_type"),
                    "relationships", "is_total"))


def line_connection_counts(connections: DataFrame) -> DataFrame:
    """Raw connections per line, before resolution and doubling."""
    return connections.groupBy("tube_line").agg(F.count(F.lit(1)).alias("connections"))


def distinct_lines(connections: DataFrame) -> DataFrame:
    return connections.select("tube_line").distinct()


def zone_counts(g: GraphTables) -> DataFrame:
    return (g.nodes.filter(F.col("zone").isNotNull())
            .groupBy("zone").agg(F.count(F.lit(1)).alias("stations")))


def zone_counts_ordered(g: GraphTables) -> DataFrame:
    """:func:`zone_counts` in order of the zones, with the place of each. The
    window holds one row per zone."""
    return zone_counts(g).withColumn("rank", F.row_number().over(Window.orderBy("zone"))).orderBy("rank")


def zone_count_lookup(g: GraphTables, zones: DataFrame) -> DataFrame:
    """Station count for each requested zone; a zone without stations gets 0.
    ``zones`` has one column ``zone``."""
    counts = zone_counts(g)
    return (zones.select(F.col("zone").cast("int").alias("zone")).distinct()
            .join(counts, "zone", "left")
            .select("zone", F.coalesce("stations", F.lit(0)).alias("stations")))


def presence_check(g: GraphTables) -> DataFrame:
    """Station and relationship counts in one row, also when both are empty."""
    rels = g.relationships.agg(F.count(F.lit(1))).scalar()
    return g.nodes.agg(F.count(F.lit(1)).alias("stations"),
                       rels.alias("relationships"))


def presence_check_grouped(g: GraphTables) -> DataFrame:
    """The grouped form: counts relationships grouped by the station count,
    so a graph without relationships gives no row at all."""
    stations = g.nodes.agg(F.count(F.lit(1))).scalar()
    return (g.relationships.groupBy(stations.alias("stations"))
            .agg(F.count(F.lit(1)).alias("relationships")))


def _incident_ends(rels: DataFrame) -> DataFrame:
    """One row per (station, relationship end); a self-loop counts once."""
    ends = F.when(F.col("src_id") == F.col("dst_id"), F.array("src_id")) \
            .otherwise(F.array("src_id", "dst_id"))
    return rels.select(F.explode(ends).alias("station_id"), "rel_type")


def degrees(g: GraphTables) -> DataFrame:
    """Undirected degree of every station that has a relationship."""
    return (_incident_ends(g.relationships).groupBy("station_id")
            .agg(F.count(F.lit(1)).alias("connections")))


def degree_all(g: GraphTables) -> DataFrame:
    """Undirected degree per station, stations without relationships at 0."""
    return (g.nodes.select("station_id", "name")
            .join(degrees(g), "station_id", "left")
            .select("station_id", "name",
                    F.coalesce("connections", F.lit(0)).cast("long").alias("connections")))


def degree_matched(g: GraphTables) -> DataFrame:
    """Degree by pattern: stations without relationships do not appear."""
    return (g.nodes.select("station_id", "name")
            .join(degrees(g), "station_id")
            .select("station_id", "name", "connections"))


def out_degree(g: GraphTables) -> DataFrame:
    return (g.relationships.groupBy(F.col("src_id").alias("station_id"))
            .agg(F.count(F.lit(1)).alias("out_degree")))


def degree_lookup(g: GraphTables, names: DataFrame) -> DataFrame:
    """Degree of each station named in ``names`` (column ``name``); an unknown
    name gives a row with NULLs."""
    return (names.select("name").distinct()
            .join(degree_all(g), "name", "left")
            .select("name", "station_id", "connections"))


def top_busiest(degree: DataFrame, n: int = 10) -> DataFrame:
    """The n most connected stations, ties broken by the smaller id.
    Planned as a per-partition top-n followed by a merge of n rows each."""
    return degree.orderBy(F.desc("connections"), F.asc("station_id")).limit(n)


def low_degree(g: GraphTables, below: int = 4) -> DataFrame:
    return degree_all(g).filter(F.col("connections") < below)


def interchanges(g: GraphTables, at_least: int = 6) -> DataFrame:
    """Stations with ``at_least`` connections, with the number of lines."""
    return (_incident_ends(g.relationships).groupBy("station_id")
            .agg(F.count(F.lit(1)).alias("connections"),
                 F.countDistinct("rel_type").alias("lines"))
            .filter(F.col("connections") >= at_least)
            .join(g.nodes.select("station_id", "name"), "station_id")
            .select("station_id", "name", "connections", "lines"))


def distinct_neighbours(rels: DataFrame) -> DataFrame:
    """Undirected simple adjacency: distinct (station, neighbour), no loops,
    both orientations."""
    r = rels.filter(F.col("src_id") != F.col("dst_id"))
    pair = F.array(F.struct(F.col("src_id").alias("a"), F.col("dst_id").alias("b")),
                   F.struct(F.col("dst_id").alias("a"), F.col("src_id").alias("b")))
    return (r.select(F.explode(pair).alias("_p"))
            .select(F.col("_p.a").alias("station_id"), F.col("_p.b").alias("neighbour_id"))
            .distinct())


def peripheral_stations(g: GraphTables) -> DataFrame:
    """Ends of line: exactly one distinct neighbour (self-loops ignored)."""
    return (distinct_neighbours(g.relationships).groupBy("station_id")
            .agg(F.count(F.lit(1)).alias("neighbours"))
            .filter(F.col("neighbours") == 1)
            .join(g.nodes.select("station_id", "name"), "station_id")
            .select("station_id", "name"))


def degree_table(g: GraphTables) -> DataFrame:
    """``degree_all`` written once to the shared checkpoint folder.

    Operators that need a whole-set statistic of the degree (min, max, total,
    histogram) and then the degrees themselves read this table several
    times; materialising it (one row per station, far smaller than the
    relationships) keeps the relationship scan and its shuffle to one pass.
    """
    from tracknet.plans.iterate import cut

    return cut(degree_all(g))


def _top_degrees(deg: DataFrame, threshold: float) -> DataFrame:
    """``(connections, cume_dist)`` of the degrees whose cumulative share of
    stations is at least ``threshold``. The window runs over the histogram of
    degrees, one row per distinct value."""
    hist = deg.groupBy("connections").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("connections").rowsBetween(Window.unboundedPreceding, 0)
    total = deg.agg(F.count(F.lit(1))).scalar()
    return (hist.select("connections", (F.sum("_n").over(w) / total).alias("cume_dist"))
            .filter(F.col("cume_dist") >= threshold))


def busy_stations(g: GraphTables, threshold: float = 0.9) -> DataFrame:
    """Stations whose degree is in the top decile: cumulative share of
    stations with a degree no higher than theirs is at least ``threshold``.

    The share grows with the degree, so being busy is a cut-off: the smallest
    such degree. Stations are filtered by it before they meet the few
    histogram rows above it, so the common degrees are not joined at all.
    """
    deg = degree_table(g)
    top = _top_degrees(deg, threshold)
    cut_off = top.agg(F.min("connections")).scalar()
    return (deg.filter(F.col("connections") >= cut_off).join(top, "connections")
            .select("station_id", "name", "connections",
                    F.round("cume_dist", 6).alias("cume_dist")))


def quiet_alternatives(g: GraphTables, per_hub: int = 3, threshold: float = 0.9) -> DataFrame:
    """For every busy station, up to ``per_hub`` direct neighbours that are not
    busy, least connected first (ties by id).

    Busy and quiet are told apart by the cut-off degree alone.
    ``row_number() <= k`` is planned with a partial group limit before the
    shuffle, so even a hub with a huge neighbour list ships at most k rows
    per map task.
    """
    deg = degree_table(g)
    cut_off = _top_degrees(deg, threshold).agg(F.min("connections")).scalar()
    busy = deg.filter(F.col("connections") >= cut_off).select(F.col("station_id").alias("hub_id"), F.col("name").alias("hub_name"))
    nb = distinct_neighbours(g.relationships).select(
        F.col("station_id").alias("hub_id"), F.col("neighbour_id").alias("station_id"))
    cand = nb.join(busy, "hub_id").join(deg.filter(F.col("connections") < cut_off), "station_id")
    w = Window.partitionBy("hub_id").orderBy(F.asc("connections"), F.asc("station_id"))
    return (cand.withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= per_hub)
            .select("hub_id", "hub_name", "station_id", "name", "connections",
                    F.col("rank").cast("int").alias("rank")))


def degree_scaled(g: GraphTables, buckets: int = 5) -> DataFrame:
    """Degree min-max scaled to [0, 1] and cut into ``buckets`` equal-width
    classes (the top value falls in the last class)."""
    deg = degree_table(g)
    lo = deg.agg(F.min("connections")).scalar()
    hi = deg.agg(F.max("connections")).scalar()
    span = hi - lo
    scaled = F.when(span == 0, F.lit(0.0)).otherwise(
        (F.col("connections") - lo).cast("double") / span)
    bucket = F.least(F.floor(scaled * buckets), F.lit(buckets - 1)).cast("int")
    return deg.select("station_id", "name", "connections",
                      F.round(scaled, 6).alias("scaled"), bucket.alias("bucket"))


def lines_through_station(g: GraphTables) -> DataFrame:
    """Long form: one row per (station, line) the station is on."""
    return (_incident_ends(g.relationships).distinct()
            .join(g.nodes.select("station_id", "name"), "station_id")
            .select("station_id", "name", "rel_type"))


def load_report(g: GraphTables, connections: DataFrame) -> DataFrame:
    """Per line: raw connections and relationships (two for each resolved
    connection); plus a total row (``rel_type = 'ALL'``)."""
    from tracknet.functions.names import rel_type_name

    raw = (connections.filter(F.col("tube_line").isNotNull())
           .groupBy(rel_type_name("tube_line").alias("rel_type"))
           .agg(F.count(F.lit(1)).alias("raw_connections")))
    rel = rel_counts(g)
    per = raw.join(rel, "rel_type", "full").select(
        "rel_type",
        F.coalesce("raw_connections", F.lit(0)).alias("raw_connections"),
        F.coalesce("relationships", F.lit(0)).alias("relationships"))
    return (per.rollup("rel_type")
            .agg(F.sum("raw_connections").cast("long").alias("raw_connections"),
                 F.sum("relationships").cast("long").alias("relationships"),
                 F.grouping_id().cast("int").alias("is_total"))
            .select(F.when(F.col("is_total") == 1, F.lit("ALL"))
                    .otherwise(F.col("rel_type")).alias("rel_type"),
                    "raw_connections", "relationships", "is_total"))
