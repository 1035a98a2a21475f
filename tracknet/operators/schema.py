"""Graph schema and validation reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracknet.operators.aggregates import degree_all, rel_counts_rollup, top_busiest
from tracknet.operators.model import GraphTables
from tracknet.plans.iterate import cut


def graph_schema(g: GraphTables) -> DataFrame:
    """Which relationship types link which node labels, with counts."""
    a = g.nodes.select(F.col("station_id").alias("src_id"), F.col("label").alias("src_label"))
    b = g.nodes.select(F.col("station_id").alias("dst_id"), F.col("label").alias("dst_label"))
    return (g.relationships.join(a, "src_id").join(b, "dst_id")
            .groupBy("src_label", "rel_type", "dst_label")
            .agg(F.count(F.lit(1)).alias("relationships")))


def graph_properties(g: GraphTables) -> DataFrame:
    """Property names and types of the node label and of the relationship
    types, with the number of non-null values, in one pass over each table."""
    def props(df: DataFrame, entity: str, skip: set[str]) -> DataFrame:
        fields = [f for f in df.schema.fields if f.name not in skip]
        counts = df.agg(*[F.count(F.col(f.name)).alias(f.name) for f in fields])
        stack = ", ".join(
            f"'{f.name}', '{f.dataType.simpleString()}', `{f.name}`" for f in fields)
        return counts.selectExpr(
            f"'{entity}' AS entity",
            f"stack({len(fields)}, {stack}) AS (property, type, non_null)")
    return props(g.nodes, "Station", {"label"}).unionByName(
        props(g.relationships, "relationship", set()))


def validate_graph(g: GraphTables, top: int = 10) -> DataFrame:
    """The post-load report as rows ``(section, item, value)``, in this order:
    station count, relationships per type with the most first, their total, and
    the busiest stations, busiest first. The graph is worked out once."""
    g = GraphTables(cut(g.nodes.select("station_id", "name")), cut(g.relationships))
    stations = g.nodes.agg(F.count(F.lit(1)).alias("value")).select(
        F.lit("stations").alias("section"), F.lit("Station").alias("item"), "value")
    # per-type counts and their total from one pass over the relationships
    per_type_and_total = rel_counts_rollup(g).select(
        F.when(F.col("is_total") == 1, F.lit("total")).otherwise(F.lit("relationships"))
        .alias("section"), F.col("rel_type").alias("item"), F.col("relationships").alias("value"))
    busiest = top_busiest(degree_all(g), top).select(
        F.lit("busiest").alias("section"), F.col("name").alias("item"),
        F.col("connections").alias("value"))
    place = F.array_position(F.array(*map(F.lit, ("stations", "relationships", "total", "busiest"))), F.col("section"))
    return stations.unionByName(per_type_and_total).unionByName(busiest).orderBy(place, F.desc("value"), "item")
