import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

STATIONS_CSV = """ID,Station_Name,Latitude,Longitude,Zone,Postcode
1,Alder,51.50,-0.10,1,N1
2,Birch,51.51,-0.11,1,N2
3,Cedar,51.52,-0.12,2,E1
4,Dogwood,51.53,-0.13,2,E2
5,Elm,51.54,-0.14,3,W1
6,Fir,51.55,-0.15,,W2
7,Gorse,51.56,-0.16,3,S1
8,Hazel,51.57,-0.17,x,S2
"""

CONNECTIONS_CSV = """Tube_Line,From_Station,To_Station
Red,Alder,Birch
Red,Birch,Cedar
Red,Cedar,Dogwood
Red,Dogwood,Nowhere
Blue & Gold,Birch,Cedar
Blue & Gold,Birch,Elm
Green Loop,Elm,Fir
Green Loop,Fir,Cedar
Green Loop,Elm,Elm
Grey,Fir,Hazel
"""


@pytest.fixture(scope="session")
def spark():
    from tracknet.plans.session import local_session

    os.environ.setdefault("TRACKNET_WAREHOUSE", tempfile.mkdtemp(prefix="tracknet-wh-"))
    s = local_session(4, shuffle_partitions=4, driver_memory="4g", app="tracknet-tests")
    yield s


@pytest.fixture(scope="session")
def tiny_dir():
    d = tempfile.mkdtemp(prefix="tracknet-tiny-")
    with open(os.path.join(d, "stations.csv"), "w") as f:
        f.write(STATIONS_CSV)
    with open(os.path.join(d, "connections.csv"), "w") as f:
        f.write(CONNECTIONS_CSV)
    return d


@pytest.fixture(scope="session")
def tiny(spark, tiny_dir):
    from tracknet.operators.model import build_graph, clean_connections, clean_stations
    from tracknet.sources.csv import read_connections, read_stations

    st = clean_stations(read_stations(spark, os.path.join(tiny_dir, "stations.csv")))
    cn = clean_connections(read_connections(spark, os.path.join(tiny_dir, "connections.csv")))
    g = build_graph(st, cn)
    g.nodes = g.nodes.cache()
    g.relationships = g.relationships.cache()
    g.connections = cn
    return g


NAMES = {1: "Alder", 2: "Birch", 3: "Cedar", 4: "Dogwood", 5: "Elm", 6: "Fir", 7: "Gorse", 8: "Hazel"}
