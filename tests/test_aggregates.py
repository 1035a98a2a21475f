from tracknet.operators import aggregates as A
from tracknet.operators import lookup as L
from tracknet.operators import schema as S

from conftest import NAMES


def _deg(df):
    return {r.station_id: r.connections for r in df.collect()}


def test_degree_all_and_matched(tiny):
    d = _deg(A.degree_all(tiny))
    assert d == {1: 2, 2: 8, 3: 8, 4: 2, 5: 6, 6: 6, 7: 0, 8: 2}
    assert sum(d.values()) == 34
    m = _deg(A.degree_matched(tiny))
    assert 7 not in m and len(m) == 7


def test_out_degree(tiny):
    d = {r.station_id: r.out_degree for r in A.out_degree(tiny).collect()}
    assert [d.get(i, 0) for i in range(1, 9)] == [1, 4, 4, 1, 4, 3, 0, 1]


def test_busiest_order(tiny):
    top = [NAMES[r.station_id] for r in A.top_busiest(A.degree_all(tiny), 10).collect()]
    assert top == ["Birch", "Cedar", "Elm", "Fir", "Alder", "Dogwood", "Hazel", "Gorse"]
    top_m = [NAMES[r.station_id] for r in A.top_busiest(A.degree_matched(tiny), 10).collect()]
    assert top_m == top[:-1]


def test_low_interchange_peripheral(tiny):
    assert sorted(r.name for r in A.low_degree(tiny, 4).collect()) == ["Alder", "Dogwood", "Gorse", "Hazel"]
    got = {r.name: (r.connections, r.lines) for r in A.interchanges(tiny, 6).collect()}
    assert got == {"Birch": (8, 2), "Cedar": (8, 3), "Elm": (6, 2), "Fir": (6, 2)}
    assert sorted(r.name for r in A.peripheral_stations(tiny).collect()) == ["Alder", "Dogwood", "Hazel"]


def test_zone_counts(tiny, spark):
    assert {r.zone: r.stations for r in A.zone_counts(tiny).collect()} == {1: 2, 2: 2, 3: 2}
    z = spark.createDataFrame([(1,), (5,)], "zone int")
    assert {r.zone: r.stations for r in A.zone_count_lookup(tiny, z).collect()} == {1: 2, 5: 0}


def test_presence_forms(tiny, spark):
    from tracknet.operators.model import GraphTables
    r = A.presence_check(tiny).first()
    assert (r.stations, r.relationships) == (8, 18)
    empty = GraphTables(tiny.nodes, tiny.relationships.limit(0))
    assert A.presence_check(empty).collect()[0].relationships == 0
    assert A.presence_check_grouped(empty).count() == 0
    assert A.presence_check_grouped(tiny).first().relationships == 18


def test_rollup_and_report(tiny):
    r = {x.rel_type: (x.relationships, x.is_total) for x in A.rel_counts_rollup(tiny).collect()}
    assert r["ALL"] == (18, 1) and r["RED"] == (6, 0)
    rep = {x.rel_type: (x.raw_connections, x.relationships) for x in A.load_report(tiny, tiny.connections).collect()}
    assert rep["RED"] == (4, 6) and rep["ALL"] == (10, 18)


def test_busy_and_quiet(tiny):
    busy = {r.name for r in A.busy_stations(tiny, 0.9).collect()}
    assert busy == {"Birch", "Cedar"}
    q = [(r.hub_name, r.name, r.rank) for r in A.quiet_alternatives(tiny, 3, 0.9).orderBy("hub_id", "rank").collect()]
    assert q == [("Birch", "Alder", 1), ("Birch", "Elm", 2),
                 ("Cedar", "Dogwood", 1), ("Cedar", "Fir", 2)]


def test_scaled(tiny):
    s = {r.station_id: (r.scaled, r.bucket) for r in A.degree_scaled(tiny).collect()}
    assert s[2] == (1.0, 4) and s[7] == (0.0, 0) and s[5] == (0.75, 3)


def test_lookups(tiny, spark):
    assert sorted(r.name for r in L.stations_in_zone(tiny, 1).collect()) == ["Alder", "Birch"]
    hits = sorted((r.term, r.name) for r in L.name_search(tiny, ["ER", "zz"]).collect())
    assert hits == [("ER", "Alder")]
    names = spark.createDataFrame([("Elm",), ("Nowhere",)], "name string")
    got = {r.name: r.zone for r in L.station_lookup(tiny, names).collect()}
    assert got == {"Elm": 3, "Nowhere": None}
    assert [r.station_id for r in L.station_sample(tiny, 3).collect()] == [1, 2, 3]
    nb = sorted((r.rel_type, r.neighbour) for r in L.neighbours_of(tiny, ["Elm"]).collect())
    assert nb == [("BLUE_AND_GOLD", "Birch"), ("BLUE_AND_GOLD", "Birch"),
                  ("GREEN_LOOP", "Elm"), ("GREEN_LOOP", "Elm"),
                  ("GREEN_LOOP", "Fir"), ("GREEN_LOOP", "Fir")]
    assert sorted(r.name for r in L.stations_on_line(tiny, "GREY").collect()) == ["Fir", "Hazel"]
    assert L.line_connections(tiny, "RED").count() == 6
    assert L.triples(tiny).count() == 18
    lines = {(r.name, r.rel_type) for r in A.lines_through_station(tiny).collect()}
    assert {x for x in lines if x[0] == "Cedar"} == {("Cedar", "RED"), ("Cedar", "BLUE_AND_GOLD"), ("Cedar", "GREEN_LOOP")}


def test_schema_and_validation(tiny):
    rows = {(r.src_label, r.rel_type, r.dst_label): r.relationships for r in S.graph_schema(tiny).collect()}
    assert rows[("Station", "GREY", "Station")] == 2
    props = {(r.entity, r.property): (r.type, r.non_null) for r in S.graph_properties(tiny).collect()}
    assert props[("Station", "zone")] == ("int", 6)
    v = S.validate_graph(tiny).collect()
    assert [r.value for r in v if r.section == "stations"] == [8]
    assert [r.value for r in v if r.section == "total"] == [18]
    assert [r.item for r in v if r.section == "busiest"][:2] == ["Birch", "Cedar"]


def test_name_search_takes_any_terms_and_a_stored_index(spark, tiny):
    from tracknet.operators import lookup as L

    names = [(r.station_id, r.name) for r in tiny.nodes.collect()]
    terms = ["", "a", "AR", "ced", "EDAR", "dogwood", "dogwoods", "zzz", "xy", "%", "rr", "lm"]
    want = sorted((t, i, n) for t in terms for i, n in names if t.lower() in n.lower())
    frame = spark.createDataFrame([(t,) for t in [*terms, None, "a"]], "term string")
    index = L.name_index(tiny.nodes)
    for got in (L.name_search(tiny, terms), L.name_search(tiny, frame), L.name_search(tiny, frame, index)):
        assert sorted(tuple(r) for r in got.collect()) == want
    plan = L.name_search(tiny, frame)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_postings_of_a_gram_in_all_names_are_dealt_over_tasks(spark):
    from pyspark.sql import functions as F

    from tracknet.operators import lookup as L
    from tracknet.operators.model import GraphTables

    nodes = spark.range(300).select(F.col("id").alias("station_id"), F.when(F.col("id") < 299, F.concat(F.lit("aa"), F.col("id") % 3)).alias("name"))
    terms = spark.createDataFrame([("A",), ("",), ("a2",), ("aa1",), ("b",)], "term string")
    found = L.name_search(GraphTables(nodes, None), terms)
    names = [(i, f"aa{i % 3}") for i in range(299)]
    assert sorted(tuple(r) for r in found.collect()) == sorted((t, i, n) for t in ["A", "", "a2", "aa1", "b"] for i, n in names if t.lower() in n)
    # no posting list goes whole to one task: lists meet the asked grams where they are made, or are dealt by parts
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "_salt#" in plan
    joins = [line for line in plan.splitlines() if "Join" in line and "gram#" in line]
    assert joins and not any("SortMergeJoin" in line and "_salt#" not in line for line in joins)
