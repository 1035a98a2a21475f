"""tracknet: a transport network held as Spark DataFrames.

Stations are nodes, each line between two stations is a typed relationship
stored in both directions. Every operator is a function from DataFrames to a
DataFrame; iterative graph algorithms are driver loops over DataFrame rounds
whose lineage is cut with reliable checkpoints.
"""

from tracknet.operators.model import GraphTables, build_graph  # noqa: F401

__all__ = ["GraphTables", "build_graph"]
