"""Lineage control for driver loops.

Each round of an iterative operator (BFS frontier, PageRank, label
propagation, Louvain) builds on the previous round's DataFrame. Without a cut
the plan grows with every round. ``cut`` materialises a round into the shared
checkpoint folder (reliable, so a lost executor does not lose the round) and
returns a DataFrame whose plan is a plain scan of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tracknet.plans.session import ensure_checkpoint_dir, scratch_path


def cut(df: DataFrame, **metrics: Column):
    """Materialise ``df`` as a parquet table in the shared checkpoint folder
    and return a frame that reads it back, so the next round's plan starts
    from a scan instead of carrying every earlier round.

    The folder is the one the cluster names in ``spark.checkpoint.dir``, so a
    lost executor costs at most the current round. (Repeated
    ``Dataset.checkpoint`` calls were measured to slow down round after round
    in long loops; a written table does not, and its file sizes feed the
    optimizer's join choice.)

    With keyword ``metrics`` (name -> aggregate column) the aggregates are
    computed by the write job itself through an ``Observation`` and returned
    as a dict next to the frame, so a loop can test "nothing new" or "nothing
    moved" without running another job.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "round")
    if metrics:
        obs = Observation()
        df = df.observe(obs, *[c.alias(k) for k, c in metrics.items()])
    schema = df.schema
    df.write.mode("overwrite").parquet(path)
    # the schema is known: reading it back needs no footer inference
    out = spark.read.schema(schema).parquet(path)
    out._round = path
    if Rounds.scopes:
        Rounds.scopes[-1].paths.add(path)
    if not metrics:
        return out
    got = obs.get
    return out, {k: (got.get(k) or 0) for k in metrics}


class Rounds:
    """A scope whose round tables are deleted when it ends, but for those kept.

    Nothing that still has to be computed may read a deleted table: the scope's
    result is a table of its own, handed out through :meth:`keep`."""

    scopes: list[Rounds] = []

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: set[str] = set()

    def __enter__(self) -> Rounds:
        Rounds.scopes.append(self)
        return self

    def keep(self, table: DataFrame) -> DataFrame:
        """Keeps a table that :func:`cut` returned; it passes to the scope around this one, if any."""
        self.paths.discard(table._round)
        if len(Rounds.scopes) > 1:
            Rounds.scopes[-2].paths.add(table._round)
        return table

    def __exit__(self, *failure) -> None:
        Rounds.scopes.remove(self)
        for path in self.paths:
            drop_round(self.spark, path)


def drop_round(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def pin(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-partition a loop-invariant input (an adjacency list) by ``keys``
    once and checkpoint it with that partitioning, so the rounds that join
    on ``keys`` do not shuffle it again."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.repartition(*keys).checkpoint(eager=True)


def rows() -> Column:
    """Row-count metric for :func:`cut`."""
    return F.count(F.lit(1))


class LoopGuard:
    """Counts the rounds of a loop and ends it after ``limit`` of them."""

    def __init__(self, limit: int | None, name: str = "loop"):
        if limit is not None and limit < 0:
            raise ValueError(f"{name}: round limit must be non-negative")
        self.limit = limit
        self.rounds = 0

    def next_round(self) -> bool:
        if self.limit is not None and self.rounds >= self.limit:
            return False
        self.rounds += 1
        return True
