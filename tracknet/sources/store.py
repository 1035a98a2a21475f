"""Writing the graph and its source tables.

Tables are either catalog tables (``save_table``) or folders of parquet files
(``write_path``). A catalog table that is replaced is a view of its newest
version: the new data is completely written as a table of its own, then the view
is pointed at it by one change of the catalog. So a failure at any step leaves
the old table or the new one, and a table can be overwritten from a frame that
reads it. (The graph's own tables share one pointer: see ``snapshots``.)
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def ensure_database(spark: SparkSession, name: str, use: bool = True) -> None:
    """Create the schema if it does not exist and make it the current one."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")
    if use:
        spark.catalog.setCurrentDatabase(name)


VERSION = "tracknet.version"


def version_of(spark: SparkSession, name: str) -> str | None:
    """The table that a replaceable table's view stands on; None for a plain table."""
    told = spark.sql(f"SHOW TBLPROPERTIES {name}").filter(F.col("key") == VERSION).collect()
    return told[0].value if told else None


def _point(spark: SparkSession, name: str, version: str) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{VERSION}' = '{version}') AS SELECT * FROM {version}")


def _versions(spark: SparkSession, name: str) -> list[str]:
    database, _, table = name.rpartition(".")
    found = spark.sql(f"SHOW TABLES {'IN ' + database if database else ''} LIKE '{table}__v*'").collect()
    return sorted(f"{database}.{r.tableName}" if database else r.tableName for r in found)


def save_table(df: DataFrame, name: str, fmt: str = "parquet", mode: str = "overwrite",
               partition_by: list[str] | None = None, bucket: tuple[int, str] | None = None,
               verify: bool = False, after_step=None) -> int:
    """Write ``df`` as table ``name`` and return the rows written.

    The row count is taken by an ``Observation`` on the write job itself, so
    no extra counting job runs. With ``verify`` the table is read back and its
    count compared (the post-write check), raising on a difference; an
    overwritten table is checked before anyone sees it.
    ``bucket = (n, column)`` lays the table out in n buckets sorted by the
    column, so later joins and lookups on it need no shuffle. ``after_step`` is
    told the name of each step of an overwrite when it is done. The version
    before is kept for those who still read it, older ones are dropped.
    """
    spark = df.sparkSession
    told = after_step or (lambda step: None)
    obs = Observation(f"write_{name.replace('.', '_')}")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    exists = spark.catalog.tableExists(name)
    held = version_of(spark, name) if exists else None
    append = mode == "append"
    # versions sort by their number, which is one more than the greatest there is
    numbers = [int(v.rsplit("__v", 1)[1].split("_")[0]) for v in _versions(spark, name)]
    target = (held or name) if append else f"{name}__v{max(numbers, default=0) + 1:08d}_{uuid.uuid4().hex[:8]}"
    before = spark.table(target).count() if verify and append and exists else 0
    w = observed.write.format(fmt).mode("append" if append else "error")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket:
        w = w.bucketBy(bucket[0], bucket[1]).sortBy(bucket[1])
    w.saveAsTable(target)
    written = obs.get.get("rows", 0)
    told("written")
    if verify:
        stored = spark.table(target).count()
        if stored != before + written:
            raise RuntimeError(f"{name}: held {before} rows and wrote {written}, but now holds {stored}")
    if append:
        return written
    if exists and held is None:
        # a plain table of this name: it becomes the version before
        spark.sql(f"ALTER TABLE {name} RENAME TO {name}__v00000000_plain")
        told("renamed")
    _point(spark, name, target)
    told("pointed")
    for old in _versions(spark, name):
        if old not in (target, held, f"{name}__v00000000_plain" if held is None else None):
            spark.sql(f"DROP TABLE IF EXISTS {old}")
    told("dropped")
    return written


def recover_table(spark: SparkSession, name: str) -> bool:
    """Points a missing table at its newest complete version; True if that was
    needed. Only the first replacement of a plain table can leave it missing."""
    left = [] if spark.catalog.tableExists(name) else _versions(spark, name)
    if left:
        _point(spark, name, left[-1])
    return bool(left)


def write_path(df: DataFrame, path: str, mode: str = "overwrite",
               partition_by: list[str] | None = None) -> int:
    """Parquet folder version of :func:`save_table` (no catalog needed)."""
    obs = Observation("write_path")
    w = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return obs.get.get("rows", 0)


def save_relationships(rels: DataFrame, name: str, mode: str = "append", verify: bool = False) -> int:
    """Relationships in one job, one folder per type (``partitionBy``), so a
    question about one line reads only that line's files. The rows are
    rebalanced by type first: a task writes few types, and a type with very
    many rows is split into files of the advisory size. Appending the same
    edges twice stores parallel relationships, as the graph load does."""
    by_type = rels.sparkSession.sql("SELECT /*+ REBALANCE(rel_type) */ src_id, dst_id, rel_type FROM {r}", r=rels)
    return save_table(by_type, name, mode=mode, partition_by=["rel_type"], verify=verify)


def table_rows(spark: SparkSession, name: str) -> int:
    """Rows of a table; 0 if there is none."""
    return spark.table(name).count() if spark.catalog.tableExists(name) else 0


def clear_graph(spark: SparkSession, nodes_table: str, rels_table: str) -> DataFrame:
    """Empty both graph tables and return how many nodes and relationships
    were deleted (one row). The counts are taken before the tables are
    truncated; a missing table counts as 0."""
    n, r = table_rows(spark, nodes_table), table_rows(spark, rels_table)
    for t in (nodes_table, rels_table):
        if spark.catalog.tableExists(t):
            spark.sql(f"TRUNCATE TABLE {version_of(spark, t) or t}")
    return spark.createDataFrame([(n, r)], "deleted_nodes long, deleted_relationships long")


def clear_paths(spark: SparkSession, nodes_path: str, rels_path: str) -> DataFrame:
    """:func:`clear_graph` for graph tables kept as parquet folders: the
    counts are taken first (one job), then each folder is overwritten with an
    empty frame of the same schema, which does not read the old files."""
    n = spark.read.parquet(nodes_path)
    r = spark.read.parquet(rels_path)
    counts = n.agg(F.count(F.lit(1)).alias("deleted_nodes"),
                   r.agg(F.count(F.lit(1))).scalar().alias("deleted_relationships")).first()
    for df, path in ((n, nodes_path), (r, rels_path)):
        spark.createDataFrame([], df.schema).write.mode("overwrite").parquet(path)
    return spark.createDataFrame([(counts[0], counts[1])],
                                 "deleted_nodes long, deleted_relationships long")
