from collections import Counter

from pyspark.sql import functions as F

from tracknet.operators import aggregates as A
from tracknet.operators import model as M


def test_counts_and_quarantine(tiny):
    assert tiny.connections.count() == 10
    q = tiny.quarantine.collect()
    assert [(r.from_station, r.to_station, r.reason) for r in q] == [("Dogwood", "Nowhere", "unknown_to")]
    per = {r.rel_type: r.relationships for r in A.rel_counts(tiny).collect()}
    assert per == {"RED": 6, "BLUE_AND_GOLD": 4, "GREEN_LOOP": 6, "GREY": 2}
    assert tiny.relationships.count() == 18


def test_station_cleaning(tiny):
    rows = {r.station_id: r for r in tiny.nodes.collect()}
    assert rows[6].zone is None and rows[8].zone is None
    assert rows[1].zone == 1 and rows[1].latitude == 51.5
    assert tiny.nodes.schema["zone"].dataType.simpleString() == "int"


def test_raw_line_counts(tiny):
    got = {r.tube_line: r.connections for r in A.line_connection_counts(tiny.connections).collect()}
    assert got == {"Red": 4, "Blue & Gold": 2, "Green Loop": 3, "Grey": 1}


def test_relationships_are_symmetric(tiny):
    r = Counter((x.src_id, x.dst_id, x.rel_type) for x in tiny.relationships.collect())
    for (a, b, t), n in r.items():
        assert r[(b, a, t)] == n


def test_rel_type_name(spark):
    from tracknet.functions.names import rel_type_name
    df = spark.createDataFrame([("Blue & Gold",), ("waterloo & city",), ("Red",)], "x string")
    got = [r[0] for r in df.select(rel_type_name("x")).collect()]
    assert got == ["BLUE_AND_GOLD", "WATERLOO_AND_CITY", "RED"]


def test_derived_names(spark):
    from tracknet.functions.names import catalog_from_path, schema_from_path, user_identifier
    df = spark.createDataFrame([("first.last-x@example.com", "/landing/cat/sch/vol/")], "u string, p string")
    r = df.select(user_identifier("u", "metro").alias("c"),
                  catalog_from_path("p").alias("k"), schema_from_path("p").alias("s")).first()
    assert (r.c, r.k, r.s) == ("metro_first_last_x", "cat", "sch")


def test_duplicate_name_fans_out(spark, tiny):
    extra = spark.createDataFrame(
        [("Station", 9, "Elm", 0.0, 0.0, 3, "X")], tiny.nodes.schema)
    nodes = tiny.nodes.unionByName(extra)
    rels = M.build_relationships(tiny.connections, nodes)
    elm_edges = rels.filter(F.col("src_id").isin(5, 9)).count()
    # Elm touches Birch-Elm, Elm-Fir and the Elm-Elm loop; with two Elms the
    # loop gives 4 resolved rows, the others 2 each
    assert elm_edges == 2 + 2 + 8
    assert rels.count() == 18 + 2 + 2 + 6


def test_append_twice_doubles(tiny):
    twice = M.append_relationships(tiny.relationships, tiny.relationships)
    assert twice.count() == 36


def test_upsert_nodes_keyed(spark, tiny):
    incoming = spark.createDataFrame(
        [(1, "Alder", 9.0, 9.0, 4, "NEW"), (1, "Alder", 8.0, 8.0, 4, "NEWER"),
         (20, "Yew", 1.0, 1.0, 1, "Y")],
        "station_id int, name string, latitude double, longitude double, zone int, postcode string")
    existing = tiny.nodes.drop("label")
    out = M.upsert_nodes(existing, incoming)
    rows = {r.station_id: r for r in out.collect()}
    assert len(rows) == 9 and out.count() == 9
    assert rows[1].postcode == "NEW"  # the larger row wins, deterministically
    assert rows[20].name == "Yew" and rows[2].postcode == "N2"
    again = M.upsert_nodes(out, incoming)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, out.collect()))


def test_null_line_quarantined(spark, tiny):
    c = tiny.connections.unionByName(spark.createDataFrame(
        [(None, "Alder", "Birch")], "tube_line string, from_station string, to_station string"))
    g = M.build_graph(tiny.nodes.drop("label"), c)
    assert g.relationships.count() == 18
    assert sorted(r.reason for r in g.quarantine.collect()) == ["null_line", "unknown_to"]
