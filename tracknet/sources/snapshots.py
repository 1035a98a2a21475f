"""Graph versions: complete parts first, one pointer last.

Each load writes its nodes and its relationships as new partitions (by load)
of ``node_parts`` and ``relationship_parts``. Nobody sees them until a row of
``versions`` names them: that row is one file, written by the last job of the
load, and is the only thing that changes what the graph is. So a load that
fails at any step leaves the old graph, and nodes and relationships are always
of one version. An incremental load names the old relationship parts beside its
own and rewrites none of them.

The views ``nodes`` and ``relationships`` look the pointer up when they are
read, and Spark prunes the partitions with what it finds; :meth:`GraphStore.graph`
reads it once and gives both tables of that version. Loads into one database
run one at a time. Parts of failed loads and of old versions are removed by
:meth:`GraphStore.vacuum`.

``node_parts`` is bucketed and sorted by station, so joins and lookups on the
key need no shuffle; ``relationship_parts`` has a folder per load and type, so a
question about one line reads only that line's files.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracknet.operators.model import GraphTables
from tracknet.plans.iterate import cut, rows
from tracknet.sources import store

ROWS_PER_BUCKET = 500_000
VERSIONS = "seq bigint, load_id string, nodes string, relationships array<string>, written timestamp"


@dataclass(frozen=True)
class Version:
    """What a pointer row names: the load of the nodes, the loads of the relationships."""

    seq: int
    load_id: str
    nodes: str | None
    relationships: tuple[str, ...]


class GraphStore:
    """The versions of one database's graph."""

    def __init__(self, spark: SparkSession, database: str):
        self.spark = spark
        store.ensure_database(spark, database, use=False)
        name = lambda t: f"{database}.{t}"
        self.versions, self.node_parts, self.relationship_parts = name("versions"), name("node_parts"), name("relationship_parts")
        self.nodes, self.relationships = name("nodes"), name("relationships")
        if not self._exists(self.versions):
            spark.createDataFrame([], VERSIONS).write.saveAsTable(self.versions)

    def _exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(table)

    def current(self) -> Version | None:
        """The version that the pointer names; one small row."""
        self.spark.catalog.refreshTable(self.versions)
        row = self.spark.table(self.versions).agg(F.max_by(F.struct("seq", "load_id", "nodes", "relationships"), F.struct("seq", "load_id")).alias("v")).first().v
        return Version(row.seq, row.load_id, row.nodes, tuple(row.relationships)) if row else None

    # ------------------------------------------------------------- writing

    def write_nodes(self, nodes: DataFrame, load_id: str) -> int:
        """The nodes of a load as a part of their own; rows written and read back.
        The first load fixes the number of buckets: by its rows, and not below
        the session's partitions, as a join would shuffle fewer buckets to those."""
        staged, n = cut(nodes, rows=rows())
        least = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        buckets = self._buckets() if self._exists(self.node_parts) else max(least, math.ceil(n["rows"] / ROWS_PER_BUCKET))
        part = staged.repartition(buckets, "station_id").withColumn("load_id", F.lit(load_id))
        part.write.mode("append").partitionBy("load_id").bucketBy(buckets, "station_id").sortBy("station_id").saveAsTable(self.node_parts)
        return self._checked(self.node_parts, load_id, n["rows"])

    def _buckets(self) -> int:
        told = {r.col_name: r.data_type for r in self.spark.sql(f"DESCRIBE EXTENDED {self.node_parts}").collect()}
        return int(told["Num Buckets"])

    def write_relationships(self, rels: DataFrame, load_id: str) -> int:
        """The relationships of a load as a part of their own, rebalanced so that a
        task writes few types and a type of very many rows is split into files."""
        staged, n = cut(rels, rows=rows())
        by_type = self.spark.sql("SELECT /*+ REBALANCE(rel_type) */ src_id, dst_id, rel_type FROM {r}", r=staged).withColumn("load_id", F.lit(load_id))
        by_type.select("src_id", "dst_id", "load_id", "rel_type").write.mode("append").partitionBy("load_id", "rel_type").saveAsTable(self.relationship_parts)
        return self._checked(self.relationship_parts, load_id, n["rows"])

    def _checked(self, table: str, load_id: str, written: int) -> int:
        stored = self.spark.table(table).filter(F.col("load_id") == load_id).count()
        if stored != written:
            raise RuntimeError(f"{table}: load {load_id} wrote {written} rows, but {stored} are stored")
        return written

    def publish(self, load_id: str, nodes: str | None, relationships: tuple[str, ...] | list[str]) -> Version:
        """Makes a version current. The views are there before the pointer, and
        the pointer's only file is written by one job."""
        now = self.current()
        version = Version((now.seq if now else 0) + 1, load_id, nodes, tuple(relationships))
        self._views()
        row = self.spark.createDataFrame([(version.seq, load_id, nodes, list(relationships))], "seq bigint, load_id string, nodes string, relationships array<string>")
        row.withColumn("written", F.current_timestamp()).coalesce(1).write.mode("append").saveAsTable(self.versions)
        return version

    def _views(self) -> None:
        newest = f"SELECT max_by({{}}, struct(seq, load_id)) FROM {self.versions}"
        for view, parts, columns, which in (
                (self.nodes, self.node_parts, "label, station_id, name, latitude, longitude, zone, postcode", f"load_id = ({newest.format('nodes')})"),
                (self.relationships, self.relationship_parts, "src_id, dst_id, rel_type", f"array_contains(({newest.format('relationships')}), load_id)")):
            if not self._exists(view) and self._exists(parts):
                self.spark.sql(f"CREATE VIEW {view} AS SELECT {columns} FROM {parts} WHERE {which}")

    # ------------------------------------------------------------- reading

    def part_nodes(self, load_id: str | None) -> DataFrame:
        """The nodes that one load wrote, published or not."""
        return self.spark.table(self.node_parts).filter(F.col("load_id") == F.lit(load_id)).drop("load_id")

    def graph(self, version: Version | None = None) -> GraphTables:
        """Nodes and relationships of one version (the current one if none is given)."""
        version = version or self.current()
        if version is None:
            raise ValueError("no graph has been published")
        nodes = self.part_nodes(version.nodes)
        rels = self.spark.table(self.relationship_parts).filter(F.col("load_id").isin(list(version.relationships))).select("src_id", "dst_id", "rel_type")
        return GraphTables(nodes, rels)

    def counts(self) -> tuple[int, int]:
        """Nodes and relationships of the current version; 0 without one."""
        if self.current() is None:
            return 0, 0
        g = self.graph()
        return g.nodes.count(), g.relationships.count()

    def clear(self, load_id: str) -> DataFrame:
        """Publishes an empty graph and returns how many nodes and relationships it replaced."""
        held = self.counts()
        if self.current():
            self.publish(load_id, None, [])
        return self.spark.createDataFrame([held], "deleted_nodes long, deleted_relationships long")

    def vacuum(self, keep: int = 1) -> list[str]:
        """Drops the parts that none of the last ``keep`` versions names and
        returns their loads. Not while a load is running: its parts have no version yet."""
        last = self.spark.table(self.versions).orderBy(F.desc("seq")).limit(max(1, keep)).collect()
        used = {x for v in last for x in (v.nodes, *v.relationships)}
        gone = []
        for table in filter(self._exists, (self.node_parts, self.relationship_parts)):
            held = {r.load_id for r in self.spark.sql(f"SHOW PARTITIONS {table}").select(F.regexp_extract("partition", "load_id=([^/]*)", 1).alias("load_id")).distinct().collect()}
            for load_id in sorted(held - used):
                self.spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (load_id = '{load_id}')")
                gone.append(load_id)
        return sorted(set(gone))
