"""The load pipeline: source files to graph tables, in a handful of jobs."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracknet.operators.model import (
    build_relationships,
    clean_connections,
    clean_stations,
    rejected_stations,
    station_nodes,
    unmatched_connections,
    upsert_nodes,
)
from tracknet.operators.schema import validate_graph
from tracknet.sources import store
from tracknet.sources.csv import observed, read_connections, read_stations
from tracknet.sources.snapshots import GraphStore


@dataclass
class LoadResult:
    load_id: str
    tables: dict[str, str]
    counts: dict[str, int]
    seconds: dict[str, float] = field(default_factory=dict)
    report: DataFrame | None = None

    def metrics(self, spark: SparkSession) -> DataFrame:
        """Counts and seconds of the load as ``(load_id, metric, value)``."""
        rows = [(self.load_id, k, float(v)) for k, v in self.counts.items()]
        rows += [(self.load_id, f"seconds_{k}", float(v)) for k, v in self.seconds.items()]
        return spark.createDataFrame(rows, "load_id string, metric string, value double")


def run_pipeline(spark: SparkSession, stations_path: str, connections_path: str,
                 database: str, clear_first: bool = True, after_step: Callable[[str], None] | None = None) -> LoadResult:
    """Load the source files into the graph of ``database``.

    Nodes are always reduced by key; connections are resolved against the
    nodes of the new version, so an incremental load (``clear_first=False``)
    links to stations of earlier loads. Everything is written and checked
    first; the version's pointer is the last write (see ``sources.snapshots``),
    so a load that fails at any step leaves the old graph whole, and an
    incremental load rewrites no old relationship. Rows that do not make it into
    the graph are appended, under the load's id, to ``quarantine`` (connections)
    and ``station_quarantine``. ``after_step`` is told each step when it is done.
    """
    secs: dict[str, float] = {}
    marks = [time.time()]

    def lap(step: str) -> None:
        marks.append(time.time())
        secs[step] = marks[-1] - marks[-2]
        if after_step:
            after_step(step)

    load_id = uuid.uuid4().hex
    graphs = GraphStore(spark, database)
    names = {k: f"{database}.{k}" for k in
             ("stations", "tube_lines", "nodes", "relationships", "quarantine", "station_quarantine")}
    for k in ("stations", "tube_lines"):
        store.recover_table(spark, names[k])
    old = graphs.current()
    held = graphs.counts() if clear_first else None
    lap("before")

    raw_st, st_obs = observed(read_stations(spark, stations_path), "stations_source")
    raw_cn, cn_obs = observed(read_connections(spark, connections_path), "connections_source")
    n_st = store.save_table(clean_stations(raw_st), names["stations"], verify=True)
    lap("stations")
    n_cn = store.save_table(raw_cn, names["tube_lines"], verify=True)
    rejected = rejected_stations(read_stations(spark, stations_path)).withColumn("load_id", F.lit(load_id))
    n_rejected = store.save_table(rejected, names["station_quarantine"], mode="append", verify=True)
    lap("tables")

    incoming = station_nodes(spark.table(names["stations"]))
    keep_old = not clear_first and old is not None and old.nodes is not None
    existing = graphs.graph(old).nodes if keep_old else incoming.limit(0)
    n_nodes = graphs.write_nodes(upsert_nodes(existing, incoming.select(*existing.columns)), load_id)
    lap("nodes")

    connections = clean_connections(spark.table(names["tube_lines"]))
    nodes = graphs.part_nodes(load_id)
    n_rel = graphs.write_relationships(build_relationships(connections, nodes), load_id)
    lap("relationships")
    unmatched = unmatched_connections(connections, nodes).withColumn("load_id", F.lit(load_id))
    n_q = store.save_table(unmatched, names["quarantine"], mode="append", verify=True)
    lap("quarantine")
    version = graphs.publish(load_id, load_id, [*(old.relationships if keep_old else ()), load_id])
    lap("published")

    counts = {
        "source_stations": st_obs.get.get("rows", n_st),
        "source_connections": cn_obs.get.get("rows", n_cn),
        "stations": n_st, "connections": n_cn, "nodes": n_nodes,
        "relationships": n_rel, "quarantined": n_q, "stations_rejected": n_rejected,
    }
    if held is not None:
        counts["deleted_nodes"], counts["deleted_relationships"] = held
    secs["total"] = marks[-1] - marks[0]
    return LoadResult(load_id, names, counts, secs, validate_graph(graphs.graph(version)))
