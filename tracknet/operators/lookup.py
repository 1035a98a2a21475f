"""Filters, point lookups and pattern scans over the graph tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracknet.operators.hot import SALTS, find_hot, salt_edges, salt_rows
from tracknet.operators.model import GraphTables
from tracknet.plans.iterate import cut


def stations_in_zone(g: GraphTables, zone: int) -> DataFrame:
    return g.nodes.filter(F.col("zone") == zone).select("station_id", "name", "zone")


def stations_with(g: GraphTables, *, name: str | None = None, postcode: str | None = None, zone: int | None = None) -> DataFrame:
    """Stations with the given properties (all of those that are given)."""
    found = g.nodes
    for column, value in (("name", name), ("postcode", postcode), ("zone", zone)):
        if value is not None:
            found = found.filter(F.col(column) == value)
    return found.select("station_id", "name", "zone", "postcode")


GRAM = 3
FINER = 16          # frequent grams are many: their lists are dealt in parts of a 16th of a task's share


def _grams(text: Column, size: int) -> Column:
    """The distinct substrings of ``size`` characters."""
    places = F.sequence(F.lit(1), F.length(text) - (size - 1))
    return F.when(F.length(text) >= size, F.array_distinct(F.transform(places, lambda i: F.substring(text, i, F.lit(size))))).otherwise(F.array().cast("array<string>"))


def name_index(nodes: DataFrame) -> DataFrame:
    """Posting lists ``(gram, station_id, name)``: a row for each distinct
    substring of up to three characters of a name in lower case, and the empty one."""
    low = F.lower("name")
    grams = F.concat(F.array(F.lit("")), *[_grams(low, n) for n in range(1, GRAM + 1)])
    return nodes.filter("name IS NOT NULL").select(F.explode(grams).alias("gram"), "station_id", "name")


def name_search(g: GraphTables, terms: list[str] | DataFrame, index: DataFrame | None = None) -> DataFrame:
    """``(term, station_id, name)``: case-insensitive substring search for many
    terms (a list, or a DataFrame with a column ``term``).

    Every place where a term stands in a name holds all the term's trigrams.
    A term meets the names under its rarest one (a term of fewer than three
    characters is a gram itself), by an equi-join, and each such pair is
    verified. ``index`` is a stored :func:`name_index`; without it the posting
    lists are made on the way, of the asked grams only. The list of a gram that
    stands in a large share of the names is dealt over tasks by a hash of the
    station, and its terms meet every part.
    """
    if isinstance(terms, list):
        if not terms:
            raise ValueError("name_search needs at least one term")
        terms = g.nodes.sparkSession.createDataFrame([(t,) for t in terms], "term string")
    low = F.lower("term")
    of_term = F.when(F.length(low) < GRAM, F.array(low)).otherwise(_grams(low, GRAM))
    asked = terms.select("term").filter("term IS NOT NULL").distinct().select("term", F.explode(of_term).alias("gram"))
    if index is None:
        # names are few bytes, their grams many: a small file of names is dealt over tasks first
        index = name_index(cut(g.nodes.select("station_id", "name").repartition("station_id")))
    # there are few distinct grams of at most three characters: the posting lists meet them where they are made
    held = index.join(F.broadcast(asked.select("gram").distinct()), "gram", "left_semi")
    counts = held.groupBy("gram").agg(F.count(F.lit(1)).alias("names"))
    rarest = cut(asked.join(counts, "gram", "left").groupBy("term").agg(F.min(F.struct(F.coalesce("names", F.lit(0)).alias("names"), "gram")).alias("_r"))
                 .filter("_r.names > 0").select("term", "_r.gram"))
    postings = index.join(F.broadcast(rarest.select("gram").distinct()), "gram", "left_semi")
    hot = find_hot(postings, "gram", finer=FINER)
    postings = salt_edges(postings, hot, "gram", "station_id")
    return salt_rows(rarest, hot, "gram").join(postings, ["gram", *SALTS]).filter(F.contains(F.lower("name"), F.lower("term"))).select("term", "station_id", "name")


def station_lookup(g: GraphTables, names: DataFrame) -> DataFrame:
    """Properties of each named station; unknown names keep a row of NULLs."""
    return (names.select("name").distinct()
            .join(g.nodes.select("name", "station_id", "zone", "postcode"), "name", "left"))


def station_sample(g: GraphTables, n: int = 10) -> DataFrame:
    """The first n stations by id, with zone and postcode."""
    return (g.nodes.select("station_id", "name", "zone", "postcode")
            .orderBy("station_id").limit(n))


def _named(rels: DataFrame, nodes: DataFrame) -> DataFrame:
    a = nodes.select(F.col("station_id").alias("src_id"), F.col("name").alias("src_name"))
    b = nodes.select(F.col("station_id").alias("dst_id"), F.col("name").alias("dst_name"))
    return (rels.join(a, "src_id").join(b, "dst_id")
            .select("src_id", "src_name", "rel_type", "dst_id", "dst_name"))


def triples(g: GraphTables) -> DataFrame:
    """Every stored relationship with both station names."""
    return _named(g.relationships, g.nodes)


def line_connections(g: GraphTables, rel_type: str) -> DataFrame:
    """All relationships of one line (both stored directions)."""
    return _named(g.relationships.filter(F.col("rel_type") == rel_type), g.nodes)


def neighbours_of(g: GraphTables, names: list[str]) -> DataFrame:
    """Undirected one-hop pattern from named stations: a relationship leaving
    the station and one arriving at it are both matches, so with both
    directions stored each neighbour appears twice per line; a self-loop
    matches once."""
    starts = g.nodes.filter(F.col("name").isin(names)).select(
        F.col("station_id").alias("_sid"), F.col("name").alias("station"))
    r = g.relationships
    out_ = r.join(starts, F.col("src_id") == F.col("_sid")).select(
        "station", "rel_type", F.col("dst_id").alias("neighbour_id"))
    in_ = (r.filter(F.col("src_id") != F.col("dst_id"))
           .join(starts, F.col("dst_id") == F.col("_sid"))
           .select("station", "rel_type", F.col("src_id").alias("neighbour_id")))
    nb = g.nodes.select(F.col("station_id").alias("neighbour_id"), F.col("name").alias("neighbour"))
    return out_.unionByName(in_).join(nb, "neighbour_id").select(
        "station", "rel_type", "neighbour_id", "neighbour")


def stations_on_line(g: GraphTables, rel_type: str) -> DataFrame:
    """Stations touched by at least one relationship of the line (semi-join)."""
    r = g.relationships.filter(F.col("rel_type") == rel_type)
    ends = r.select(F.col("src_id").alias("station_id")).unionByName(
        r.select(F.col("dst_id").alias("station_id")))
    return g.nodes.join(ends, "station_id", "left_semi").select("station_id", "name")


def rel_type_names(connections: DataFrame) -> DataFrame:
    from tracknet.functions.names import rel_type_name

    return (connections.select("tube_line").distinct()
            .filter(F.col("tube_line").isNotNull())
            .select("tube_line", rel_type_name("tube_line").alias("rel_type")))
