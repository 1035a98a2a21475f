"""

Every query reads the shared test tables of ``sf_dir`` and works on the
station/connection projection of them (``tracknet.sources.testdata``); the
oracle SQL writes the same projection as common table expressions, so both
engines compute each answer from the raw parquet independently.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from importlib import import_module
from importlib.util import find_spec

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracknet.operators import aggregates as A
from tracknet.operators import centrality as C
from tracknet.operators import community as CM
from tracknet.operators import lookup as L
from tracknet.operators import paths as P
from tracknet.operators import schema as S
from tracknet.functions.names import catalog_from_path, rel_type_name, schema_from_path, user_identifier
from tracknet.operators import model as M
from tracknet.plans.iterate import cut
from tracknet.plans.pipeline import run_pipeline
from tracknet.plans.session import scratch_path
from tracknet.plans.sql import run_query
from tracknet.sources import csv as CSV
from tracknet.sources import manifest as MF
from tracknet.sources import store as ST
from tracknet.sources import testdata as T

# The text operators and their pipeline may be absent; errors inside them are raised.
def _optional(package: str, module: str):
    spec = find_spec(package)
    return import_module(module) if spec is not None and spec.origin else None


LLM = _optional("tracknet.llm", "tracknet.llm.queries")
PIPELINE = _optional("corpus_pipeline", "corpus_pipeline") if LLM else None

SMOKE_DIR = "/root/testdata/sf0.001"

# Parameters of the sample questions (fixed values of the registered queries).
ZONE = 1
LOOKUP_ZONES = [1, 2, 9]
SEARCH_TERMS = ["customer#0000001", "99"]
POSTCODE = "N5"
LINE = "1_AND_URGENT"
LINE_B = "2_AND_HIGH"
RAW_LINE = "5 & LOW"
NAMED_STATION = "Customer#000000001"
HUBS = 50           # journeys start at the fifty busiest stations
BOUND = 5           # hop bound of the bounded shortest path
NAMED_PAIRS = [("Customer#000000001", "Customer#000000002"), ("Customer#000000004", "Customer#000000149"),
               ("Customer#000000130", "Customer#000000010"), ("Customer#000000001", "Customer#000000010")]
K_HOPS = 2          # neighbourhood expansion depth
ID_PREFIX = "tracknet"


def _g(spark: SparkSession, sf: str):
    return T.load_graph(spark, sf)


def _x(spark: SparkSession, sf: str):
    """The extended network: with unconnected, one-neighbour and like-named stations."""
    return T.load_graph(spark, sf, extended=True)


def busiest_top10(spark: SparkSession, sf: str) -> DataFrame:
    return A.top_busiest(A.degree_all(_g(spark, sf)), 10)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the ten busiest stations by undirected connection count."""
    return busiest_top10(spark, SMOKE_DIR)


def _names_on_raw_line(spark, sf, side):
    c = T.load_connections(spark, sf)
    return c.filter(F.col("tube_line") == RAW_LINE).select(F.col(side).alias("name"))


def _search_terms(s, sf) -> DataFrame:
    """About a thousand terms: name endings of three, nation names, and beginnings of two and one."""
    names = T.station_rows(s, sf).select("name")
    nations = s.read.parquet(f"{sf}/nation.parquet").select("n_name")
    last = names.select(F.substring("name", -3, 3).alias("term"))
    return last.unionByName(nations.select(F.lower("n_name").alias("term"))).unionByName(nations.select(F.substring("n_name", 1, 2).alias("term"))) \
        .unionByName(nations.select(F.substring("n_name", 2, 1).alias("term"))).distinct()


def _queries_basic() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    q["busiest_top10"] = busiest_top10
    q["busiest_top10_matched"] = lambda s, sf: A.top_busiest(A.degree_matched(_g(s, sf)), 10)
    q["degree_all"] = lambda s, sf: A.degree_all(_x(s, sf))
    q["degree_matched"] = lambda s, sf: A.degree_matched(_x(s, sf))
    q["out_degree"] = lambda s, sf: A.out_degree(_g(s, sf))
    q["station_count"] = lambda s, sf: A.station_count(_g(s, sf))
    q["rel_counts"] = lambda s, sf: A.rel_counts(_g(s, sf))
    q["rel_counts_ordered"] = lambda s, sf: A.rel_counts_ordered(_g(s, sf))
    q["zone_counts_ordered"] = lambda s, sf: A.zone_counts_ordered(_g(s, sf))
    q["stations_with"] = lambda s, sf: L.stations_with(_g(s, sf), postcode=POSTCODE, zone=ZONE)
    q["rel_counts_rollup"] = lambda s, sf: A.rel_counts_rollup(_g(s, sf))
    q["line_connection_counts"] = lambda s, sf: A.line_connection_counts(T.load_connections(s, sf))
    q["distinct_lines"] = lambda s, sf: A.distinct_lines(T.load_connections(s, sf))
    q["rel_type_names"] = lambda s, sf: L.rel_type_names(T.load_connections(s, sf))
    q["zone_counts"] = lambda s, sf: A.zone_counts(_g(s, sf))
    q["zone_count_lookup"] = lambda s, sf: A.zone_count_lookup(
        _g(s, sf), s.createDataFrame([(z,) for z in LOOKUP_ZONES], "zone int"))
    q["presence_check"] = lambda s, sf: A.presence_check(_g(s, sf))
    q["presence_check_grouped"] = lambda s, sf: A.presence_check_grouped(_g(s, sf))
    q["degree_lookup"] = lambda s, sf: A.degree_lookup(
        _g(s, sf), _names_on_raw_line(s, sf, "from_station"))
    q["low_degree"] = lambda s, sf: A.low_degree(_x(s, sf), 4)
    q["interchanges"] = lambda s, sf: A.interchanges(_g(s, sf), 6)
    q["peripheral_stations"] = lambda s, sf: A.peripheral_stations(_x(s, sf))
    q["busy_stations"] = lambda s, sf: A.busy_stations(_g(s, sf))
    q["quiet_alternatives"] = lambda s, sf: A.quiet_alternatives(_g(s, sf))
    q["degree_scaled"] = lambda s, sf: A.degree_scaled(_g(s, sf))
    q["lines_through_station"] = lambda s, sf: A.lines_through_station(_g(s, sf))
    q["load_report"] = lambda s, sf: A.load_report(_g(s, sf), T.load_connections(s, sf))
    q["stations_in_zone"] = lambda s, sf: L.stations_in_zone(_g(s, sf), ZONE)
    q["name_search"] = lambda s, sf: L.name_search(_g(s, sf), SEARCH_TERMS)
    q["name_search_many"] = lambda s, sf: L.name_search(_x(s, sf), _search_terms(s, sf))
    q["station_lookup"] = lambda s, sf: L.station_lookup(
        _g(s, sf), _names_on_raw_line(s, sf, "to_station"))
    q["station_sample"] = lambda s, sf: L.station_sample(_g(s, sf), 10)
    q["triples"] = lambda s, sf: L.triples(_g(s, sf))
    q["line_connections"] = lambda s, sf: L.line_connections(_g(s, sf), LINE)
    q["neighbours_of"] = lambda s, sf: L.neighbours_of(_g(s, sf), [NAMED_STATION])
    q["stations_on_line"] = lambda s, sf: L.stations_on_line(_g(s, sf), LINE_B)
    q["relationship_build"] = lambda s, sf: _g(s, sf).relationships
    q["graph_schema"] = lambda s, sf: S.graph_schema(_g(s, sf))
    q["graph_properties"] = lambda s, sf: S.graph_properties(_g(s, sf))
    q["validate_graph"] = lambda s, sf: S.validate_graph(_g(s, sf))
    return q


def _hubs(g) -> DataFrame:
    return A.top_busiest(A.degree_all(g), HUBS).select("station_id")


def _reach(s, sf, max_hops=None, paths=False):
    g = _g(s, sf)
    g = replace(g, relationships=cut(g.relationships))      # for the hubs and for the search
    r = P.reach_from(g, _hubs(g), max_hops, paths)
    return r.select("src_id", "dst_id", "hops", *(_spelled() if paths else []))


def _spelled() -> list:
    """Route and lines of a path as strings."""
    return [F.array_join(F.col("stations").cast("array<string>"), ">").alias("route"), F.array_join("lines", ">").alias("lines")]


def shortest_path_pairs(s: SparkSession, sf: str) -> DataFrame:
    """Route from one named station to every station of a zone, by name pairs; some cannot be reached."""
    g = _x(s, sf)
    pairs = g.nodes.filter(F.col("zone") == ZONE).select(
        F.lit(NAMED_STATION).alias("from_name"), F.col("name").alias("to_name"))
    return P.shortest_paths(g, pairs).select("from_name", "to_name", "hops", *_spelled())


def shortest_path_named(s: SparkSession, sf: str) -> DataFrame:
    """Route and lines, as lists, between named stations, at most ``BOUND`` hops."""
    pairs = s.createDataFrame(NAMED_PAIRS, "from_name string, to_name string")
    return P.shortest_paths(_g(s, sf), pairs, max_hops=BOUND).select("from_name", "to_name", "hops", "stations", "lines")


def _zone_partition(g) -> DataFrame:
    return g.nodes.select("station_id", F.col("zone").alias("community"))


def _queries_graph() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    q["shortest_path_hops"] = lambda s, sf: _reach(s, sf)
    q["shortest_path_bounded"] = lambda s, sf: _reach(s, sf, BOUND)
    q["shortest_path_pairs"] = shortest_path_pairs
    q["shortest_path_named"] = shortest_path_named
    q["path_lines_used"] = lambda s, sf: _reach(s, sf, None, True)
    q["k_hop_neighbourhood"] = lambda s, sf: P.k_hop_neighbourhood(_g(s, sf), [NAMED_STATION], K_HOPS)
    q["trace_line"] = lambda s, sf: P.trace_line(_g(s, sf))
    q["pagerank"] = lambda s, sf: C.pagerank(_g(s, sf), 20)
    q["betweenness"] = lambda s, sf: C.betweenness(_g(s, sf))
    q["modularity"] = lambda s, sf: CM.modularity(_g(s, sf), _zone_partition(_g(s, sf)))
    q["louvain"] = lambda s, sf: CM.louvain(_g(s, sf))
    return q


def _landing(s: SparkSession, sf: str, *files: str) -> str:
    """Write the asked projected source files as CSV into a fresh landing
    folder under the shared checkpoint directory and return the folder."""
    root = scratch_path(s, "landing")
    if "stations" in files:
        CSV.write_csv(T.raw_station_rows(s, sf), f"{root}/stations")
    if "connections" in files:
        CSV.write_csv(T.connection_rows(s, sf), f"{root}/connections")
    return root


def csv_stations(s: SparkSession, sf: str) -> DataFrame:
    root = _landing(s, sf, "stations")
    return M.clean_stations(CSV.read_stations(s, f"{root}/stations"))


def csv_connections(s: SparkSession, sf: str) -> DataFrame:
    root = _landing(s, sf, "connections")
    return M.clean_connections(CSV.read_connections(s, f"{root}/connections"))


def ingest_manifest(s: SparkSession, sf: str) -> DataFrame:
    """A row per landed file: one file for each line's connections and each zone's stations."""
    root = scratch_path(s, "landing")
    CSV.write_csv(T.raw_station_rows(s, sf).withColumn("part", F.coalesce("Zone", F.lit("none"))).repartition("part"), f"{root}/stations", "part")
    CSV.write_csv(T.connection_rows(s, sf).withColumn("part", rel_type_name("Tube_Line")).repartition("part"), f"{root}/connections", "part")
    files = MF.ingest_manifest(s, root)
    return files.select(F.regexp_extract("path", "/(stations|connections)/", 1).alias("dataset"), F.regexp_extract("path", "part=([^/]*)/", 1).alias("part"),
                        "rows", (F.col("bytes") > 0).alias("has_bytes"))


def node_upsert(s: SparkSession, sf: str) -> DataFrame:
    g = _g(s, sf)
    existing = g.nodes.drop("label")
    incoming = existing.filter(F.col("zone") == ZONE).withColumn(
        "postcode", F.concat(F.lit("Z"), F.col("postcode")))
    return M.upsert_nodes(existing, incoming)


def clear_counts(s: SparkSession, sf: str) -> DataFrame:
    g = _g(s, sf)
    root = scratch_path(s, "graph")
    ST.write_path(g.nodes, f"{root}/nodes")
    ST.write_path(g.relationships, f"{root}/relationships", partition_by=["rel_type"])
    return ST.clear_paths(s, f"{root}/nodes", f"{root}/relationships")


def unmatched_connections(s: SparkSession, sf: str) -> DataFrame:
    """Connections touching a station outside the fare zones (no zone) or one
    that is not there, or without a line."""
    g = _x(s, sf)
    zoned = g.nodes.filter(F.col("zone").isNotNull())
    return M.unmatched_connections(T.load_connections(s, sf, extended=True), zoned)


def _land(s: SparkSession, stations: DataFrame, connections: DataFrame) -> tuple[str, str]:
    root = scratch_path(s, "landing")
    CSV.write_csv(T.as_raw_stations(stations), f"{root}/stations")
    CSV.write_csv(connections, f"{root}/connections")
    return f"{root}/stations", f"{root}/connections"


def _counted(s: SparkSession, loads: list) -> DataFrame:
    """Counts of each load, observed while it wrote, and of what its tables hold when read back."""
    told = ["source_stations", "source_connections", "nodes", "relationships", "quarantined", "deleted_nodes", "deleted_relationships"]
    rows = [(k, m, r.counts.get(m, 0)) for k, r in enumerate(loads, 1) for m in told]
    names = loads[-1].tables
    held = [s.table(names[t]).agg(F.lit(len(loads)).alias("load"), F.lit(f"held_{t}").alias("metric"), F.count(F.lit(1)).alias("value"))
            for t in ("stations", "tube_lines", "nodes", "relationships", "quarantine")]
    out = s.createDataFrame(rows, "load int, metric string, value long")
    for h in held:
        out = out.unionByName(h)
    return out


def pipeline_load(s: SparkSession, sf: str) -> DataFrame:
    """The load pipeline over the extended network's files, twice: the second load replaces the first."""
    files = _land(s, T.station_rows(s, sf).unionByName(T.supplier_station_rows(s, sf)),
                  T.connection_rows(s, sf).unionByName(T.supplier_connection_rows(s, sf)))
    database = "tracknet_load_" + uuid.uuid4().hex[:12]
    return _counted(s, [run_pipeline(s, *files, database) for _ in range(2)])


def pipeline_incremental(s: SparkSession, sf: str) -> DataFrame:
    """A full load, then an incremental one with the extension's files: the
    stored graph, read back by type and station zone."""
    database = "tracknet_load_" + uuid.uuid4().hex[:12]
    run_pipeline(s, *_land(s, T.station_rows(s, sf), T.connection_rows(s, sf)), database)
    res = run_pipeline(s, *_land(s, T.supplier_station_rows(s, sf), T.supplier_connection_rows(s, sf)), database, clear_first=False)
    nodes = s.table(res.tables["nodes"]).select(F.col("station_id").alias("src_id"), "zone")
    return s.table(res.tables["relationships"]).join(nodes, "src_id").groupBy("rel_type", "zone").agg(
        F.count(F.lit(1)).alias("relationships"), F.countDistinct("src_id").alias("stations"))


def _stored(s: SparkSession, sf: str):
    """The extended graph, written in the stored layout and read back as one version."""
    from tracknet.sources.snapshots import GraphStore

    g = _x(s, sf)
    graphs = GraphStore(s, "tracknet_store_" + uuid.uuid4().hex[:12])
    graphs.write_nodes(g.nodes, "first")
    graphs.write_relationships(g.relationships, "first")
    return graphs.graph(graphs.publish("first", "first", ["first"]))


def stored_departures(s: SparkSession, sf: str) -> DataFrame:
    """Relationships that leave each station, with its name: joined on the bucketed key."""
    g = _stored(s, sf)
    out = g.relationships.groupBy(F.col("src_id").alias("station_id")).agg(F.count(F.lit(1)).alias("departures"))
    return g.nodes.join(out, "station_id").select("station_id", "name", "departures")


def stored_line_share(s: SparkSession, sf: str) -> DataFrame:
    """Stations on the lines that have more connections than the mean line: only
    those lines' folders are read (the list is found when the query runs)."""
    g = _stored(s, sf)
    lines = T.load_connections(s, sf, extended=True).filter("tube_line IS NOT NULL").groupBy("tube_line").agg(F.count(F.lit(1)).alias("n"))
    mean = lines.agg(F.avg("n")).scalar()
    busy = lines.filter(F.col("n") > mean).select(rel_type_name("tube_line").alias("rel_type"))
    return g.relationships.join(busy, "rel_type").groupBy("rel_type").agg(F.countDistinct("src_id").alias("stations"))


def derived_names(s: SparkSession, sf: str) -> DataFrame:
    n = _g(s, sf).nodes
    user = F.concat(F.lower(F.replace(F.col("name"), F.lit("#"), F.lit("."))), F.lit("-x@"),
                    F.lower(F.col("postcode")), F.lit(".example"))
    path = F.concat(F.lit("/landing/zone_"), F.coalesce(F.col("zone").cast("string"), F.lit("none")),
                    F.lit("/"), F.lower(F.col("postcode")), F.lit("/raw/"))
    return n.select("station_id",
                    user_identifier(user, ID_PREFIX).alias("catalog_name"),
                    catalog_from_path(path).alias("path_catalog"),
                    schema_from_path(path).alias("path_schema"))


SQL_LINE_COUNT = ("SELECT rel_type, count(*) AS relationships, count(DISTINCT src_id) AS stations "
                  "FROM relationships WHERE rel_type = :line GROUP BY rel_type")


def _queries_etl() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    q["csv_stations"] = csv_stations
    q["csv_connections"] = csv_connections
    q["ingest_manifest"] = ingest_manifest
    q["node_upsert"] = node_upsert
    q["relationship_append_twice"] = lambda s, sf: M.append_relationships(
        _g(s, sf).relationships, _g(s, sf).relationships)
    q["clear_counts"] = clear_counts
    q["unmatched_connections"] = unmatched_connections
    q["pipeline_load"] = pipeline_load
    q["pipeline_incremental"] = pipeline_incremental
    q["stored_departures"] = stored_departures
    q["stored_line_share"] = stored_line_share
    q["derived_names"] = derived_names
    q["sql_line_count"] = lambda s, sf: run_query(s, _g(s, sf), SQL_LINE_COUNT, {"line": LINE})
    return q


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q = _queries_basic()
    q.update(_queries_etl())
    q.update(_queries_graph())
    if LLM:
        q.update(LLM.queries())
    if PIPELINE:
        q["pipeline"] = PIPELINE.run
    return q


# ---------------------------------------------------------------- oracles

GRAPH_CTES = """
stations AS (
  SELECT CAST(c_custkey AS BIGINT) AS station_id, c_name AS name,
         CAST(51.0 AS DOUBLE) + CAST(c_custkey % 1000 AS DOUBLE) / CAST(1000.0 AS DOUBLE) AS latitude,
         CAST(-0.5 AS DOUBLE) + CAST(c_custkey % 700 AS DOUBLE) / CAST(1000.0 AS DOUBLE) AS longitude,
         CASE WHEN c_acctbal < 0 THEN NULL ELSE CAST(n_regionkey + 1 AS INTEGER) END AS zone,
         'N' || CAST(n_nationkey AS VARCHAR) AS postcode
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
connections AS (
  SELECT replace(a.o_orderpriority, '-', ' & ') AS tube_line,
         ca.c_name AS from_station, cb.c_name AS to_station
  FROM orders a JOIN orders b ON b.o_orderkey = a.o_orderkey + 1
  JOIN customer ca ON ca.c_custkey = a.o_custkey
  JOIN customer cb ON cb.c_custkey = b.o_custkey),
nodes AS (SELECT 'Station' AS label, * FROM stations WHERE station_id IS NOT NULL),
resolved AS (
  SELECT s.station_id AS src_id, d.station_id AS dst_id,
         replace(replace(upper(c.tube_line), ' ', '_'), '&', 'AND') AS rel_type
  FROM connections c JOIN nodes s ON s.name = c.from_station
  JOIN nodes d ON d.name = c.to_station
  WHERE c.tube_line IS NOT NULL),
relationships AS (
  SELECT src_id, dst_id, rel_type FROM resolved
  UNION ALL SELECT dst_id, src_id, rel_type FROM resolved),
ends AS (
  SELECT src_id AS station_id, rel_type FROM relationships
  UNION ALL SELECT dst_id, rel_type FROM relationships WHERE src_id <> dst_id),
degree AS (
  SELECT n.station_id, n.name, CAST(COALESCE(d.c, 0) AS BIGINT) AS connections
  FROM nodes n LEFT JOIN (SELECT station_id, count(*) AS c FROM ends GROUP BY station_id) d
    ON d.station_id = n.station_id),
nbr AS (
  SELECT DISTINCT src_id AS station_id, dst_id AS neighbour_id FROM relationships WHERE src_id <> dst_id
  UNION SELECT DISTINCT dst_id, src_id FROM relationships WHERE src_id <> dst_id),
hist AS (SELECT connections, count(*) AS n FROM degree GROUP BY connections),
cdf AS (
  SELECT connections,
         SUM(n) OVER (ORDER BY connections ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
           / (SELECT count(*) FROM degree) AS cume_dist
  FROM hist),
busy AS (
  SELECT d.station_id, d.name, d.connections, round(c.cume_dist, 6) AS cume_dist
  FROM degree d JOIN cdf c ON c.connections = d.connections WHERE c.cume_dist >= 0.9)
"""


_CASE = "CASE " + " ".join(f"WHEN s_acctbal >= {least} THEN '{name}'" for name, least in T.SUPPLIER_CASES) + " ELSE 'depot' END"
SUPPLIER_CTES = f"""
suppliers AS (
  SELECT s_suppkey, n_nationkey, n_regionkey, {_CASE} AS kind,
         CASE WHEN {_CASE} = 'depot' THEN 'Depot ' || CAST(s_suppkey // 2 AS VARCHAR) ELSE s_name END AS name
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
more_stations AS (
  SELECT {T.SUPPLIER_BASE} + s_suppkey AS station_id, name, CAST(52.0 AS DOUBLE) AS latitude, CAST(0.5 AS DOUBLE) AS longitude,
         CASE WHEN kind <> 'depot' THEN CAST(n_regionkey + 1 AS INTEGER) END AS zone, 'S' || CAST(n_nationkey AS VARCHAR) AS postcode
  FROM suppliers),
more_connections AS (
  SELECT CASE kind WHEN 'feeder' THEN 'Feeder' WHEN 'unknown' THEN 'Feeder' WHEN 'depot' THEN 'Depot & Yard' END AS tube_line, name AS from_station,
         CASE WHEN kind = 'unknown' THEN 'Nowhere ' || CAST(s_suppkey AS VARCHAR) ELSE c_name END AS to_station
  FROM suppliers JOIN customer ON c_custkey = s_suppkey WHERE kind <> 'isolated'),
"""


def _w(body: str) -> str:
    return "WITH " + GRAPH_CTES + body


def _wx(body: str) -> str:
    """Over the extended network."""
    wide = GRAPH_CTES.replace("stations AS (", "base_stations AS (", 1).replace("connections AS (", "base_connections AS (", 1).replace(
        "nodes AS (", "stations AS (SELECT * FROM base_stations UNION ALL SELECT * FROM more_stations),\n"
        "connections AS (SELECT * FROM base_connections UNION ALL SELECT * FROM more_connections),\nnodes AS (", 1)
    return "WITH " + SUPPLIER_CTES + wide + body


def _oracles_basic() -> dict[str, str]:
    o: dict[str, str] = {}
    o["busiest_top10"] = _w(
        "SELECT station_id, name, connections FROM degree "
        "ORDER BY connections DESC, station_id LIMIT 10")
    o["busiest_top10_matched"] = _w(
        "SELECT station_id, name, connections FROM degree WHERE connections > 0 "
        "ORDER BY connections DESC, station_id LIMIT 10")
    o["degree_all"] = _wx("SELECT station_id, name, connections FROM degree")
    o["degree_matched"] = _wx("SELECT station_id, name, connections FROM degree WHERE connections > 0")
    o["out_degree"] = _w(
        "SELECT src_id AS station_id, count(*) AS out_degree FROM relationships GROUP BY src_id")
    o["station_count"] = _w("SELECT count(*) AS stations FROM nodes")
    o["rel_counts"] = _w(
        "SELECT rel_type, count(*) AS relationships FROM relationships GROUP BY rel_type")
    o["rel_counts_ordered"] = _w(
        "SELECT rel_type, relationships, row_number() OVER (ORDER BY relationships DESC, rel_type NULLS LAST) AS rank "
        "FROM (SELECT rel_type, count(*) AS relationships FROM relationships GROUP BY rel_type)")
    o["zone_counts_ordered"] = _w(
        "SELECT zone, stations, row_number() OVER (ORDER BY zone) AS rank "
        "FROM (SELECT zone, count(*) AS stations FROM nodes WHERE zone IS NOT NULL GROUP BY zone)")
    o["stations_with"] = _w(
        f"SELECT station_id, name, zone, postcode FROM nodes WHERE postcode = '{POSTCODE}' AND zone = {ZONE}")
    o["rel_counts_rollup"] = _w(
        "SELECT rel_type, count(*) AS relationships, 0 AS is_total FROM relationships GROUP BY rel_type "
        "UNION ALL SELECT 'ALL', count(*), 1 FROM relationships")
    o["line_connection_counts"] = _w(
        "SELECT tube_line, count(*) AS connections FROM connections GROUP BY tube_line")
    o["distinct_lines"] = _w("SELECT DISTINCT tube_line FROM connections")
    o["rel_type_names"] = _w(
        "SELECT DISTINCT tube_line, replace(replace(upper(tube_line), ' ', '_'), '&', 'AND') AS rel_type "
        "FROM connections WHERE tube_line IS NOT NULL")
    o["zone_counts"] = _w(
        "SELECT zone, count(*) AS stations FROM nodes WHERE zone IS NOT NULL GROUP BY zone")
    zl = ", ".join(f"({z})" for z in LOOKUP_ZONES)
    o["zone_count_lookup"] = _w(
        f"SELECT z.zone, COALESCE(c.n, 0) AS stations FROM (SELECT DISTINCT CAST(zone AS INTEGER) AS zone "
        f"FROM (VALUES {zl}) t(zone)) z LEFT JOIN (SELECT zone, count(*) AS n FROM nodes "
        "WHERE zone IS NOT NULL GROUP BY zone) c ON c.zone = z.zone")
    o["presence_check"] = _w(
        "SELECT (SELECT count(*) FROM nodes) AS stations, (SELECT count(*) FROM relationships) AS relationships")
    o["presence_check_grouped"] = _w(
        "SELECT (SELECT count(*) FROM nodes) AS stations, count(*) AS relationships "
        "FROM relationships GROUP BY 1")
    o["degree_lookup"] = _w(
        "SELECT q.name, d.station_id, d.connections FROM (SELECT DISTINCT from_station AS name "
        f"FROM connections WHERE tube_line = '{RAW_LINE}') q LEFT JOIN degree d ON d.name = q.name")
    o["low_degree"] = _wx("SELECT station_id, name, connections FROM degree WHERE connections < 4")
    o["interchanges"] = _w(
        "SELECT e.station_id, n.name, count(*) AS connections, count(DISTINCT e.rel_type) AS lines "
        "FROM ends e JOIN nodes n ON n.station_id = e.station_id GROUP BY e.station_id, n.name "
        "HAVING count(*) >= 6")
    o["peripheral_stations"] = _wx(
        "SELECT b.station_id, n.name FROM (SELECT station_id FROM nbr GROUP BY station_id "
        "HAVING count(*) = 1) b JOIN nodes n ON n.station_id = b.station_id")
    o["busy_stations"] = _w("SELECT station_id, name, connections, cume_dist FROM busy")
    o["quiet_alternatives"] = _w(
        "SELECT hub_id, hub_name, station_id, name, connections, CAST(rank AS INTEGER) AS rank FROM ("
        " SELECT b.station_id AS hub_id, b.name AS hub_name, d.station_id, d.name, d.connections,"
        "  row_number() OVER (PARTITION BY b.station_id ORDER BY d.connections, d.station_id) AS rank"
        " FROM busy b JOIN nbr x ON x.station_id = b.station_id"
        " JOIN degree d ON d.station_id = x.neighbour_id"
        " WHERE d.station_id NOT IN (SELECT station_id FROM busy)) t WHERE rank <= 3")
    o["degree_scaled"] = _w(
        "SELECT station_id, name, connections, round(scaled, 6) AS scaled,"
        " CAST(least(floor(scaled * 5), 4) AS INTEGER) AS bucket FROM ("
        " SELECT station_id, name, connections,"
        "  CASE WHEN mx = mn THEN 0.0 ELSE CAST(connections - mn AS DOUBLE) / (mx - mn) END AS scaled"
        " FROM degree, (SELECT min(connections) AS mn, max(connections) AS mx FROM degree) s) t")
    o["lines_through_station"] = _w(
        "SELECT DISTINCT e.station_id, n.name, e.rel_type FROM ends e JOIN nodes n ON n.station_id = e.station_id")
    o["load_report"] = _w(
        "SELECT coalesce(r.rel_type, c.rel_type) AS rel_type, CAST(coalesce(r.n, 0) AS BIGINT) AS raw_connections,"
        " CAST(coalesce(c.n, 0) AS BIGINT) AS relationships, 0 AS is_total FROM"
        " (SELECT replace(replace(upper(tube_line), ' ', '_'), '&', 'AND') AS rel_type, count(*) AS n"
        "  FROM connections WHERE tube_line IS NOT NULL GROUP BY 1) r"
        " FULL JOIN (SELECT rel_type, count(*) AS n FROM relationships GROUP BY 1) c ON c.rel_type = r.rel_type"
        " UNION ALL SELECT 'ALL', (SELECT count(*) FROM connections WHERE tube_line IS NOT NULL),"
        " (SELECT count(*) FROM relationships), 1")
    o["stations_in_zone"] = _w(f"SELECT station_id, name, zone FROM nodes WHERE zone = {ZONE}")
    terms = ", ".join(f"('{t}')" for t in SEARCH_TERMS)
    o["name_search"] = _w(
        f"SELECT t.term, n.station_id, n.name FROM nodes n, (VALUES {terms}) t(term) "
        "WHERE contains(lower(n.name), lower(t.term))")
    o["name_search_many"] = _wx(
        ", terms AS (SELECT right(name, 3) AS term FROM base_stations UNION SELECT lower(n_name) FROM nation"
        " UNION SELECT left(n_name, 2) FROM nation UNION SELECT substr(n_name, 2, 1) FROM nation)"
        " SELECT term, station_id, name FROM nodes JOIN terms ON contains(lower(name), lower(term))")
    o["station_lookup"] = _w(
        "SELECT q.name, n.station_id, n.zone, n.postcode FROM (SELECT DISTINCT to_station AS name "
        f"FROM connections WHERE tube_line = '{RAW_LINE}') q LEFT JOIN nodes n ON n.name = q.name")
    o["station_sample"] = _w(
        "SELECT station_id, name, zone, postcode FROM nodes ORDER BY station_id LIMIT 10")
    named = ("SELECT r.src_id, a.name AS src_name, r.rel_type, r.dst_id, b.name AS dst_name "
             "FROM relationships r JOIN nodes a ON a.station_id = r.src_id "
             "JOIN nodes b ON b.station_id = r.dst_id")
    o["triples"] = _w(named)
    o["line_connections"] = _w(named + f" WHERE r.rel_type = '{LINE}'")
    o["neighbours_of"] = _w(
        "SELECT s.name AS station, r.rel_type, r.dst_id AS neighbour_id, m.name AS neighbour"
        " FROM nodes s JOIN relationships r ON r.src_id = s.station_id JOIN nodes m ON m.station_id = r.dst_id"
        f" WHERE s.name = '{NAMED_STATION}'"
        " UNION ALL SELECT s.name, r.rel_type, r.src_id, m.name"
        " FROM nodes s JOIN relationships r ON r.dst_id = s.station_id AND r.src_id <> r.dst_id"
        f" JOIN nodes m ON m.station_id = r.src_id WHERE s.name = '{NAMED_STATION}'")
    o["stations_on_line"] = _w(
        "SELECT station_id, name FROM nodes WHERE station_id IN (SELECT src_id FROM relationships"
        f" WHERE rel_type = '{LINE_B}' UNION SELECT dst_id FROM relationships WHERE rel_type = '{LINE_B}')")
    o["relationship_build"] = _w("SELECT src_id, dst_id, rel_type FROM relationships")
    o["graph_schema"] = _w(
        "SELECT a.label AS src_label, r.rel_type, b.label AS dst_label, count(*) AS relationships"
        " FROM relationships r JOIN nodes a ON a.station_id = r.src_id JOIN nodes b ON b.station_id = r.dst_id"
        " GROUP BY 1, 2, 3")
    o["graph_properties"] = _w(
        "SELECT 'Station' AS entity, p.property, p.type, p.non_null FROM (SELECT"
        " count(station_id) AS a, count(name) AS b, count(latitude) AS c, count(longitude) AS d,"
        " count(zone) AS e, count(postcode) AS f FROM nodes) c, LATERAL (VALUES"
        " ('station_id', 'bigint', c.a), ('name', 'string', c.b), ('latitude', 'double', c.c),"
        " ('longitude', 'double', c.d), ('zone', 'int', c.e), ('postcode', 'string', c.f))"
        " p(property, type, non_null)"
        " UNION ALL SELECT 'relationship', p.property, p.type, p.non_null FROM (SELECT"
        " count(src_id) AS a, count(dst_id) AS b, count(rel_type) AS c FROM relationships) c,"
        " LATERAL (VALUES ('src_id', 'bigint', c.a), ('dst_id', 'bigint', c.b), ('rel_type', 'string', c.c))"
        " p(property, type, non_null)")
    o["validate_graph"] = _w(
        "SELECT 'stations' AS section, 'Station' AS item, count(*) AS value FROM nodes"
        " UNION ALL SELECT 'relationships', rel_type, count(*) FROM relationships GROUP BY rel_type"
        " UNION ALL SELECT 'total', 'ALL', count(*) FROM relationships"
        " UNION ALL SELECT * FROM (SELECT 'busiest', name, connections FROM degree"
        "  ORDER BY connections DESC, station_id LIMIT 10)")
    return o


ADJ_CTES = """,
adj AS (
  SELECT a, b, min(rel_type) AS line FROM (
    SELECT src_id AS a, dst_id AS b, rel_type FROM relationships WHERE src_id <> dst_id
    UNION ALL SELECT dst_id, src_id, rel_type FROM relationships WHERE src_id <> dst_id) t
  GROUP BY a, b)
"""

# walks of length <= WALK_CAP are enough: the test graphs are at most 8 hops deep
WALK_CAP = 16


def _fails(condition: str, of: str) -> str:
    """A filter that raises where the unrolled SQL ends before its walk does."""
    return f"(SELECT CASE WHEN {condition} THEN error('the walk is longer than this SQL') ELSE TRUE END FROM {of})"


def _walk_ctes(sources_sql: str, cap: int = WALK_CAP) -> str:
    """Distances by a recursive walk with set semantics: a (source, station,
    length) row exists for every walk length up to ``cap``; the distance is
    the smallest length. An unbounded walk that reaches something new with its
    last step raises."""
    end = f" WHERE {_fails(f'max(hops) >= {cap}', 'reached')}" if cap == WALK_CAP else ""
    return f""",
srcs AS ({sources_sql}),
walk(s, v, h) AS (
  SELECT station_id, station_id, 0 FROM srcs
  UNION
  SELECT w.s, x.b, w.h + 1 FROM walk w JOIN adj x ON x.a = w.v WHERE w.h < {cap}),
reached AS MATERIALIZED (SELECT s, v, min(h) AS hops FROM walk GROUP BY s, v),
dist AS (SELECT s, v, hops FROM reached{end})
"""


HUB_SQL = f"SELECT station_id FROM degree ORDER BY connections DESC, station_id LIMIT {HUBS}"


def _wr(body: str) -> str:
    return "WITH RECURSIVE " + GRAPH_CTES + body


def _wxr(body: str) -> str:
    return _wx(body).replace("WITH ", "WITH RECURSIVE ", 1)


def _oracles_graph() -> dict[str, str]:
    o: dict[str, str] = {}
    walk = ADJ_CTES + _walk_ctes(HUB_SQL)
    o["shortest_path_hops"] = _wr(walk + "SELECT s AS src_id, v AS dst_id, hops FROM dist WHERE hops > 0")
    o["shortest_path_bounded"] = _wr(
        walk + f"SELECT s AS src_id, v AS dst_id, hops FROM dist WHERE hops > 0 AND hops <= {BOUND}")
    o["path_lines_used"] = _wr(walk + """,
pred AS (
  SELECT d.s, d.v, min(x.a) AS p FROM dist d JOIN adj x ON x.b = d.v
  JOIN dist e ON e.s = d.s AND e.v = x.a AND e.hops = d.hops - 1
  WHERE d.hops > 0 GROUP BY d.s, d.v),
tree AS (SELECT p.s, p.v, p.p, x.line FROM pred p JOIN adj x ON x.a = p.p AND x.b = p.v),
paths(s, v, hops, route, lines) AS (
  SELECT station_id, station_id, 0, CAST(station_id AS VARCHAR), '' FROM srcs
  UNION ALL
  SELECT t.s, t.v, p.hops + 1, p.route || '>' || CAST(t.v AS VARCHAR),
         CASE WHEN p.lines = '' THEN t.line ELSE p.lines || '>' || t.line END
  FROM paths p JOIN tree t ON t.s = p.s AND t.p = p.v)
SELECT s AS src_id, v AS dst_id, hops, route, lines FROM paths WHERE hops > 0""")
    o["shortest_path_pairs"] = _wxr(
        ADJ_CTES + _walk_ctes(f"SELECT station_id FROM nodes WHERE name = '{NAMED_STATION}'") + """,
pred AS (
  SELECT d.s, d.v, min(x.a) AS p FROM dist d JOIN adj x ON x.b = d.v
  JOIN dist e ON e.s = d.s AND e.v = x.a AND e.hops = d.hops - 1
  WHERE d.hops > 0 GROUP BY d.s, d.v),
tree AS (SELECT p.s, p.v, p.p, x.line FROM pred p JOIN adj x ON x.a = p.p AND x.b = p.v),
paths(s, v, hops, route, lines) AS (
  SELECT station_id, station_id, 0, CAST(station_id AS VARCHAR), '' FROM srcs
  UNION ALL
  SELECT t.s, t.v, p.hops + 1, p.route || '>' || CAST(t.v AS VARCHAR),
         CASE WHEN p.lines = '' THEN t.line ELSE p.lines || '>' || t.line END
  FROM paths p JOIN tree t ON t.s = p.s AND t.p = p.v)"""
        f" SELECT a.name AS from_name, b.name AS to_name, p.hops, p.route, p.lines FROM paths p"
        f" JOIN nodes a ON a.station_id = p.s JOIN nodes b ON b.station_id = p.v"
        f" WHERE p.hops > 0 AND b.zone = {ZONE}")
    named = ", ".join(f"('{a}', '{b}')" for a, b in NAMED_PAIRS)
    starts = ", ".join(f"'{a}'" for a, _ in NAMED_PAIRS)
    o["shortest_path_named"] = _wr(
        ADJ_CTES + _walk_ctes(f"SELECT station_id FROM nodes WHERE name IN ({starts})", BOUND) + """,
pred AS (
  SELECT d.s, d.v, min(x.a) AS p FROM dist d JOIN adj x ON x.b = d.v
  JOIN dist e ON e.s = d.s AND e.v = x.a AND e.hops = d.hops - 1
  WHERE d.hops > 0 GROUP BY d.s, d.v),
tree AS (SELECT p.s, p.v, p.p, x.line FROM pred p JOIN adj x ON x.a = p.p AND x.b = p.v),
paths(s, v, hops, stations, lines) AS (
  SELECT station_id, station_id, 0, [station_id], CAST([] AS VARCHAR[]) FROM srcs
  UNION ALL
  SELECT t.s, t.v, p.hops + 1, list_append(p.stations, t.v), list_append(p.lines, t.line)
  FROM paths p JOIN tree t ON t.s = p.s AND t.p = p.v)"""
        f" SELECT a.name AS from_name, b.name AS to_name, p.hops, p.stations, p.lines FROM paths p"
        f" JOIN nodes a ON a.station_id = p.s JOIN nodes b ON b.station_id = p.v"
        f" JOIN (VALUES {named}) w(from_name, to_name) ON w.from_name = a.name AND w.to_name = b.name"
        f" WHERE p.hops > 0")
    o["k_hop_neighbourhood"] = _wr(
        ADJ_CTES + _walk_ctes(f"SELECT station_id FROM nodes WHERE name = '{NAMED_STATION}'", K_HOPS)
        + "SELECT d.s AS src_id, d.v AS station_id, n.name, d.hops FROM dist d"
        " JOIN nodes n ON n.station_id = d.v WHERE d.hops > 0")
    o["trace_line"] = _wr(f""",
ladj AS (
  SELECT DISTINCT rel_type, a, b FROM (
    SELECT rel_type, src_id AS a, dst_id AS b FROM relationships WHERE src_id <> dst_id
    UNION ALL SELECT rel_type, dst_id, src_id FROM relationships WHERE src_id <> dst_id) t),
lnodes AS (SELECT rel_type, a AS node, count(*) AS deg FROM ladj GROUP BY rel_type, a),
reach(rel_type, a, b) AS (
  SELECT rel_type, node, node FROM lnodes
  UNION
  SELECT r.rel_type, r.a, x.b FROM reach r JOIN ladj x ON x.rel_type = r.rel_type AND x.a = r.b),
comp AS (SELECT rel_type, a AS node, min(b) AS component FROM reach GROUP BY rel_type, a),
start AS (
  SELECT c.rel_type, c.component,
         coalesce(min(CASE WHEN n.deg = 1 THEN c.node END), min(c.node)) AS src
  FROM comp c JOIN lnodes n ON n.rel_type = c.rel_type AND n.node = c.node
  GROUP BY c.rel_type, c.component),
lwalk(rel_type, component, v, h) AS (
  SELECT rel_type, component, src, 0 FROM start
  UNION
  SELECT w.rel_type, w.component, x.b, w.h + 1 FROM lwalk w
  JOIN ladj x ON x.rel_type = w.rel_type AND x.a = w.v WHERE w.h < {WALK_CAP * 4})
,
stops AS MATERIALIZED (SELECT rel_type, component, v, min(h) AS stop FROM lwalk GROUP BY rel_type, component, v)
SELECT w.rel_type, w.component, w.v AS station_id, n.name, w.stop
FROM stops w JOIN nodes n ON n.station_id = w.v WHERE {_fails(f'max(stop) >= {WALK_CAP * 4}', 'stops')}""")
    pr = ["""ids AS (SELECT DISTINCT station_id FROM nodes),
outd AS (SELECT src_id, count(*) AS o FROM relationships GROUP BY src_id),
pe AS (
  SELECT r.src_id, r.dst_id, CAST(count(*) AS DOUBLE) / max(o.o) AS w
  FROM relationships r JOIN outd o ON o.src_id = r.src_id GROUP BY r.src_id, r.dst_id),
pr0 AS (SELECT station_id, CAST(1.0 AS DOUBLE) AS rank FROM ids)"""]
    for i in range(1, 21):
        pr.append(f"""pr{i} AS MATERIALIZED (
  SELECT n.station_id, (CAST(1.0 AS DOUBLE) - CAST(0.85 AS DOUBLE)) + CAST(0.85 AS DOUBLE) * coalesce(t.v, 0.0) AS rank
  FROM ids n LEFT JOIN (SELECT e.dst_id, sum(p.rank * e.w) AS v FROM pe e
    JOIN pr{i - 1} p ON p.station_id = e.src_id GROUP BY e.dst_id) t ON t.dst_id = n.station_id)""")
    o["pagerank"] = _w(",\n" + ",\n".join(pr) + "\nSELECT station_id, round(rank, 6) AS pagerank FROM pr20")
    o["betweenness"] = _w(_brandes_sql(BRANDES_LEVELS))
    o["modularity"] = _w(""",
wt AS (SELECT src_id AS i, dst_id AS j, CAST(count(*) AS DOUBLE) AS w FROM relationships GROUP BY 1, 2),
cm AS (SELECT station_id AS node, coalesce(CAST(zone AS VARCHAR), '<null>') AS c FROM nodes),
e AS (SELECT wt.w, a.c AS ci, b.c AS cj FROM wt JOIN cm a ON a.node = wt.i JOIN cm b ON b.node = wt.j),
per AS (SELECT ci, sum(w) AS tot, sum(CASE WHEN ci = cj THEN w ELSE 0.0 END) AS inn FROM e GROUP BY ci)
SELECT round(coalesce(sum(inn / (SELECT sum(w) FROM wt) - pow(tot / (SELECT sum(w) FROM wt), 2)), 0.0), 6)
  AS modularity FROM per""")
    return o


# deepest BFS level the generated betweenness SQL unrolls (test graphs: 8)
BRANDES_LEVELS = 12


def _brandes_sql(levels: int) -> str:
    parts = [""",
sadj AS (
  SELECT DISTINCT a, b FROM (
    SELECT src_id AS a, dst_id AS b FROM relationships WHERE src_id <> dst_id
    UNION ALL SELECT dst_id, src_id FROM relationships WHERE src_id <> dst_id) t),
l0 AS MATERIALIZED (SELECT station_id AS s, station_id AS v, CAST(1.0 AS DOUBLE) AS sigma FROM nodes)"""]
    for k in range(1, levels + 1):
        older = f"NOT EXISTS (SELECT 1 FROM l{k - 1} p WHERE p.s = c.s AND p.v = x.b)"
        if k >= 2:
            older += f" AND NOT EXISTS (SELECT 1 FROM l{k - 2} p WHERE p.s = c.s AND p.v = x.b)"
        parts.append(f"""l{k} AS MATERIALIZED (
  SELECT c.s, x.b AS v, sum(c.sigma) AS sigma FROM l{k - 1} c JOIN sadj x ON x.a = c.v
  WHERE {older} GROUP BY c.s, x.b)""")
    parts.append(f"d{levels} AS MATERIALIZED (SELECT s, v, sigma, CAST(0.0 AS DOUBLE) AS delta FROM l{levels})")
    for k in range(levels - 1, 0, -1):
        parts.append(f"""d{k} AS MATERIALIZED (
  SELECT p.s, p.v, p.sigma, p.sigma * coalesce(t.acc, 0.0) AS delta FROM l{k} p
  LEFT JOIN (SELECT q.s, x.b AS v, sum((1.0 + q.delta) / q.sigma) AS acc FROM d{k + 1} q
    JOIN sadj x ON x.a = q.v GROUP BY q.s, x.b) t ON t.s = p.s AND t.v = p.v)""")
    union = " UNION ALL ".join(f"SELECT v, delta FROM d{k}" for k in range(1, levels + 1))
    parts.append(f"""bc AS (SELECT v, sum(delta) AS total FROM ({union}) u GROUP BY v)
SELECT n.station_id, round(coalesce(bc.total, 0.0) / 2.0, 6) AS betweenness
FROM (SELECT DISTINCT station_id FROM nodes) n LEFT JOIN bc ON bc.v = n.station_id
WHERE {_fails('count(*) > 0', f'l{levels}')}""")
    return parts[0] + ",\n" + ",\n".join(parts[1:-1]) + ",\n" + parts[-1]


def _oracles_etl() -> dict[str, str]:
    o: dict[str, str] = {}
    o["csv_stations"] = _w("SELECT station_id, name, latitude, longitude, zone, postcode FROM stations")
    o["csv_connections"] = _w("SELECT tube_line, from_station, to_station FROM connections")
    o["ingest_manifest"] = _w(
        "SELECT 'stations' AS dataset, coalesce(CAST(zone AS VARCHAR), 'none') AS part, count(*) AS rows, TRUE AS has_bytes FROM stations GROUP BY 2"
        " UNION ALL SELECT 'connections', replace(replace(upper(tube_line), ' ', '_'), '&', 'AND'), count(*), TRUE FROM connections GROUP BY 2")
    o["node_upsert"] = _w(
        "SELECT station_id, name, latitude, longitude, zone,"
        f" CASE WHEN zone = {ZONE} THEN 'Z' || postcode ELSE postcode END AS postcode FROM nodes")
    o["relationship_append_twice"] = _w(
        "SELECT src_id, dst_id, rel_type FROM relationships"
        " UNION ALL SELECT src_id, dst_id, rel_type FROM relationships")
    o["clear_counts"] = _w(
        "SELECT (SELECT count(*) FROM nodes) AS deleted_nodes,"
        " (SELECT count(*) FROM relationships) AS deleted_relationships")
    o["unmatched_connections"] = _wx(
        "SELECT tube_line, from_station, to_station, reason FROM ("
        " SELECT c.*, CASE WHEN tube_line IS NULL THEN 'null_line'"
        "  WHEN f.name IS NULL AND t.name IS NULL THEN 'unknown_both'"
        "  WHEN f.name IS NULL THEN 'unknown_from' WHEN t.name IS NULL THEN 'unknown_to' END AS reason"
        " FROM connections c"
        " LEFT JOIN (SELECT DISTINCT name FROM nodes WHERE zone IS NOT NULL) f ON f.name = c.from_station"
        " LEFT JOIN (SELECT DISTINCT name FROM nodes WHERE zone IS NOT NULL) t ON t.name = c.to_station) x"
        " WHERE reason IS NOT NULL")
    counts = ("c AS (SELECT (SELECT count(*) FROM stations) AS s, (SELECT count(*) FROM connections) AS k, (SELECT count(*) FROM nodes) AS n,"
              " (SELECT count(*) FROM relationships) AS r, (SELECT count(*) FROM connections x WHERE tube_line IS NULL"
              " OR NOT EXISTS (SELECT 1 FROM nodes a WHERE a.name = x.from_station) OR NOT EXISTS (SELECT 1 FROM nodes a WHERE a.name = x.to_station)) AS q)")
    told = lambda k, again: [(k, "source_stations", "s"), (k, "source_connections", "k"), (k, "nodes", "n"), (k, "relationships", "r"), (k, "quarantined", "q"),
                             (k, "deleted_nodes", again.replace("x", "n")), (k, "deleted_relationships", again.replace("x", "r"))]
    rows = told(1, "0") + told(2, "x") + [(2, "held_stations", "s"), (2, "held_tube_lines", "k"), (2, "held_nodes", "n"), (2, "held_relationships", "r"),
                                          (2, "held_quarantine", "2 * q")]
    o["pipeline_load"] = _wx(", " + counts + " " + " UNION ALL ".join(f"SELECT {k} AS load, '{m}' AS metric, CAST({v} AS BIGINT) AS value FROM c" for k, m, v in rows))
    o["pipeline_incremental"] = _wx(
        "SELECT rel_type, zone, count(*) AS relationships, count(DISTINCT src_id) AS stations FROM relationships"
        " JOIN nodes ON station_id = src_id GROUP BY rel_type, zone")
    o["stored_departures"] = _wx(
        "SELECT station_id, name, count(*) AS departures FROM nodes JOIN relationships ON src_id = station_id GROUP BY station_id, name")
    o["stored_line_share"] = _wx(
        ", lines AS (SELECT replace(replace(upper(tube_line), ' ', '_'), '&', 'AND') AS rel_type, count(*) AS n FROM connections"
        " WHERE tube_line IS NOT NULL GROUP BY 1)"
        " SELECT rel_type, count(DISTINCT src_id) AS stations FROM relationships"
        " WHERE rel_type IN (SELECT rel_type FROM lines WHERE n > (SELECT avg(n) FROM lines)) GROUP BY rel_type")
    o["derived_names"] = _w(
        f"SELECT station_id, '{ID_PREFIX}_' || translate(split_part(u, '@', 1), '.-', '__') AS catalog_name,"
        " split_part(trim(p, '/'), '/', 2) AS path_catalog, split_part(trim(p, '/'), '/', 3) AS path_schema"
        " FROM (SELECT station_id, lower(replace(name, '#', '.')) || '-x@' || lower(postcode) || '.example' AS u,"
        " '/landing/zone_' || coalesce(CAST(zone AS VARCHAR), 'none') || '/' || lower(postcode) || '/raw/' AS p"
        " FROM nodes) t")
    o["sql_line_count"] = _w(
        "SELECT rel_type, count(*) AS relationships, count(DISTINCT src_id) AS stations"
        f" FROM relationships WHERE rel_type = '{LINE}' GROUP BY rel_type")
    return o


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL per query over the pre-registered parquet views. ``louvain``
    has none (its result depends on the move order); it is checked in the
    tests by the modularity it reaches."""
    o = _oracles_basic()
    o.update(_oracles_etl())
    o.update(_oracles_graph())
    if LLM:
        o.update(LLM.oracle_sql())
    if PIPELINE and PIPELINE.ORACLE_SQL:
        o["pipeline"] = PIPELINE.ORACLE_SQL
    return o
