"""Structured Streaming ingest of new connection files.

New CSV files in the landing folder are picked up by a file source (its
checkpoint remembers which files were done, so a restart neither skips nor
repeats a file). Each micro-batch is resolved against the current station
nodes and written as relationships (both directions, partitioned by batch and type);
rows that do not resolve go to a quarantine folder.

:func:`start_graph_ingest` takes stations and connections in one stream and
resolves connections whose stations come later.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracknet.functions.names import rel_type_name
from tracknet.operators.model import (
    GraphTables,
    both_directions,
    build_relationships,
    clean_connections,
    clean_stations,
    station_nodes,
    unmatched_connections,
)
from tracknet.plans.iterate import drop_round
from tracknet.sources.csv import CONNECTION_SCHEMA, RAW_STATION_SCHEMA


def connection_stream(spark: SparkSession, landing: str, max_files: int = 100) -> DataFrame:
    return (spark.readStream.schema(CONNECTION_SCHEMA).option("header", True)
            .option("maxFilesPerTrigger", max_files).csv(landing))


def start_ingest(spark: SparkSession, landing: str, nodes_path: str, rels_path: str,
                 quarantine_path: str, checkpoint: str, available_now: bool = True):
    """Start the ingest query and return its handle. ``checkpoint`` names the
    folder that remembers which files are done; a restart must be given the
    same one. Each batch writes its own ``batch_id`` partition and overwrites
    it, so a batch that is repeated after a failure is stored once."""
    if not checkpoint:
        raise ValueError("a checkpoint folder is needed: without it a restart would load every file again")

    def load(batch: DataFrame, batch_id: int) -> None:
        nodes = spark.read.parquet(nodes_path)
        conns = clean_connections(batch).persist()
        build_relationships(conns, nodes).write.mode("overwrite") \
            .partitionBy("rel_type").parquet(f"{rels_path}/batch_id={batch_id}")
        unmatched_connections(conns, nodes).write.mode("overwrite").parquet(f"{quarantine_path}/batch_id={batch_id}")
        conns.unpersist()

    w = (connection_stream(spark, landing).writeStream.foreachBatch(load)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


# ------------------------------------------- stations and connections together

def graph_stream(spark: SparkSession, stations: str, connections: str, max_files: int = 100) -> DataFrame:
    """New rows of both landing folders as one stream: ``kind`` and the raw
    columns of either file, so that a batch sees both in one order."""
    def source(schema, folder: str) -> DataFrame:
        return spark.readStream.schema(schema).option("header", True).option("maxFilesPerTrigger", max_files).csv(folder)

    st, cn = source(RAW_STATION_SCHEMA, stations), source(CONNECTION_SCHEMA, connections)
    blank = lambda df: [F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields]
    return st.select(F.lit("station").alias("kind"), *st.columns, *blank(cn)).unionByName(
        cn.select(F.lit("connection").alias("kind"), *blank(st), *cn.columns))


class StreamedGraph:
    """A graph fed by :func:`graph_stream`, kept as one folder per batch under ``root``.

    ``nodes`` of a batch are all nodes after it: of rows with one key the
    greatest stays, whichever came first. ``names`` are the pairs of name and
    station that the batch is the first to have. ``connections`` are its raw
    connections, and ``edges`` what became resolvable with it: its own
    connections against all nodes, and earlier connections at a new pair of name
    and station (a late station, or a second one of the same name). ``pending``
    are the connections without a station so far.

    So the graph is that of one batch load of all files, in whatever order they
    come. A batch reads only folders of earlier batches and overwrites its own:
    one that is repeated after a failure adds nothing.
    """

    PARTS = ("nodes", "names", "connections", "edges", "pending")

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _batches(self, part: str, before: int | None = None) -> list[int]:
        """The batches whose folder of ``part`` is complete."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{part}/*/_SUCCESS")
        found = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(path) or []
        ids = sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found)
        return [b for b in ids if before is None or b < before]

    def _read(self, part: str, batches: list[int], schema) -> DataFrame:
        if not batches:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{part}/batch={b}" for b in batches])

    def _write(self, df: DataFrame, part: str, batch: int) -> DataFrame:
        path = f"{self.root}/{part}/batch={batch}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    _PAIR = "name string, station_id bigint"
    _EDGE = "tube_line string, from_station string, to_station string, src_id bigint, dst_id bigint"
    _RAW = "tube_line string, from_station string, to_station string"
    _PENDING = _RAW + ", reason string"
    _NODE = "label string, station_id bigint, name string, latitude double, longitude double, zone int, postcode string"

    def take(self, batch: DataFrame, batch_id: int) -> None:
        """Works one batch in. What later batches left is from a run that this
        one replaces (a restart from an earlier checkpoint), and goes first."""
        for part in reversed(self.PARTS):
            for later in self._batches(part):
                if later > batch_id:
                    drop_round(self.spark, f"{self.root}/{part}/batch={later}")
        stations = batch.filter("kind = 'station'")
        incoming = station_nodes(clean_stations(stations))
        last = self._batches("nodes", batch_id)[-1:]
        cols = [c for c in incoming.columns if c != "station_id"]
        every = self._read("nodes", last, self._NODE).unionByName(incoming)
        nodes = self._write(every.groupBy("station_id").agg(F.max(F.struct(*cols)).alias("_r")).select("_r.label", "station_id", *[f"_r.{c}" for c in cols[1:]]),
                            "nodes", batch_id)
        pairs = nodes.filter("name IS NOT NULL").select("name", "station_id")
        known = self._read("names", self._batches("names", batch_id), self._PAIR)
        fresh = self._write(pairs.join(known, ["name", "station_id"], "left_anti"), "names", batch_id)
        older = pairs.join(fresh, ["name", "station_id"], "left_anti")

        before = self._batches("connections", batch_id)
        came = self._write(clean_connections(batch.filter("kind = 'connection'")), "connections", batch_id)
        earlier = self._read("connections", before, self._RAW)

        def resolved(connections: DataFrame, sources: DataFrame, targets: DataFrame) -> DataFrame:
            return connections.filter("tube_line IS NOT NULL") \
                .join(sources.select(F.col("name").alias("from_station"), F.col("station_id").alias("src_id")), "from_station") \
                .join(targets.select(F.col("name").alias("to_station"), F.col("station_id").alias("dst_id")), "to_station") \
                .select("tube_line", "from_station", "to_station", "src_id", "dst_id")

        edges = resolved(came, pairs, pairs).unionByName(resolved(earlier, fresh, pairs)).unionByName(resolved(earlier, older, fresh))
        self._write(edges, "edges", batch_id)
        # connections of a name that no station has any more wait again
        lost = self._read("nodes", last, self._NODE).select("name").distinct().join(pairs.select("name").distinct(), "name", "left_anti")

        def touches(connections: DataFrame) -> DataFrame:
            for side in ("from", "to"):
                connections = connections.join(lost.select(F.col("name").alias(f"{side}_station"), F.lit(True).alias(f"_{side}")), f"{side}_station", "left")
            flag = F.coalesce("_from", "_to", F.lit(False))
            return connections.select("tube_line", "from_station", "to_station", flag.alias("touched"))

        pending = self._read("pending", self._batches("pending", batch_id)[-1:], self._PENDING).drop("reason")
        waiting = touches(pending).filter("NOT touched").unionByName(touches(earlier).filter("touched")).drop("touched").unionByName(came)
        self._write(unmatched_connections(waiting, nodes), "pending", batch_id)

    def graph(self) -> GraphTables:
        """Nodes, relationships and quarantine after the last complete batch."""
        done = self._batches("pending")     # written last
        nodes = self._read("nodes", done[-1:], self._NODE)
        pairs = nodes.select("name", "station_id")
        edges = self._read("edges", done, self._EDGE)
        # a station that was renamed has left its old name
        for name, key in (("from_station", "src_id"), ("to_station", "dst_id")):
            edges = edges.join(pairs.select(F.col("name").alias(name), F.col("station_id").alias(key)), [name, key], "left_semi")
        rels = both_directions(edges.select("src_id", "dst_id", rel_type_name("tube_line").alias("rel_type")))
        return GraphTables(nodes, rels, self._read("pending", done[-1:], self._PENDING))


def start_graph_ingest(spark: SparkSession, stations: str, connections: str, root: str, checkpoint: str,
                       max_files: int = 100, available_now: bool = True):
    """Starts the ingest of both landing folders into the :class:`StreamedGraph`
    at ``root`` and returns its handle. ``checkpoint`` remembers which files are done."""
    if not checkpoint:
        raise ValueError("a checkpoint folder is needed: without it a restart would load every file again")
    into = StreamedGraph(spark, root)

    def load(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        into.take(held, batch_id)
        held.unpersist()

    w = graph_stream(spark, stations, connections, max_files).writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
