import duckdb

import __spark_entry__ as E


def test_registry_and_oracles_line_up():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    own = {n for n in q if n != "pipeline" and not n.startswith("op")}
    assert own - set(o) == {"louvain"}


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["station_id", "name", "connections"]
    assert 0 < len(rows) <= 10
    counts = [r.connections for r in rows]
    assert counts == sorted(counts, reverse=True)


def test_oracle_sql_runs_on_smoke_data():
    con = duckdb.connect()
    for t in ["customer", "nation", "orders"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{E.SMOKE_DIR}/{t}.parquet')")
    got = con.execute(E.oracle_sql()["busiest_top10"]).fetchall()
    assert len(got) == 10


def test_the_extended_network_has_the_cases_that_queries_can_fail_on(spark):
    from tracknet.operators import aggregates as A

    sf = "/root/testdata/sf0.01"
    q = E.queries()
    every, matched = q["degree_all"](spark, sf), q["degree_matched"](spark, sf)
    assert every.filter("connections = 0").count() == every.count() - matched.count() > 0
    assert q["low_degree"](spark, sf).count() > 0 and q["peripheral_stations"](spark, sf).count() > 0
    reasons = {r.reason for r in q["unmatched_connections"](spark, sf).select("reason").distinct().collect()}
    assert {"null_line", "unknown_to", "unknown_both"} <= reasons
    g = E._x(spark, sf)
    assert g.nodes.groupBy("name").count().filter("count > 1").count() > 0
    # some wanted pairs have no path: stations of the zone without a connection
    zone = g.nodes.filter(f"zone = {E.ZONE}")
    assert zone.join(A.degree_all(g).filter("connections = 0").select("station_id"), "station_id").count() > 0


def test_stored_layout_joins_without_exchange_and_prunes_lines(spark):
    from tracknet.sources.snapshots import GraphStore

    graphs = GraphStore(spark, "tracknet_layout")
    g = E._x(spark, E.SMOKE_DIR)
    graphs.write_nodes(g.nodes, "a")
    graphs.write_relationships(g.relationships, "a")
    graphs.publish("a", "a", ["a"])
    stored = graphs.graph()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        out = stored.relationships.groupBy("src_id").count().withColumnRenamed("src_id", "station_id")
        plan = stored.nodes.join(out, "station_id")._jdf.queryExecution().executedPlan().toString()
        # the only exchange is that of the relationships' count
        assert plan.count("Exchange") == 1 and "Bucketed: true" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = spark.createDataFrame([("FEEDER",), ("5_AND_LOW",)], "rel_type string").filter("rel_type LIKE 'F%'")
    plan = stored.relationships.join(lines, "rel_type")._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan


def test_sql_that_ends_before_its_walk_raises():
    import duckdb
    import pytest

    con = duckdb.connect()
    for t in ["customer", "nation", "orders"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{E.SMOKE_DIR}/{t}.parquet')")
    whole = E._wr(E.ADJ_CTES + E._walk_ctes(E.HUB_SQL) + "SELECT max(hops) FROM dist")
    deepest = con.execute(whole).fetchone()[0]
    assert 2 < deepest < E.WALK_CAP
    short = whole.replace(f"w.h < {E.WALK_CAP}", "w.h < 2").replace(f">= {E.WALK_CAP}", ">= 2")
    for sql in (short, E._w(E._brandes_sql(2))):
        with pytest.raises(duckdb.Error, match="longer than this SQL"):
            con.execute(sql).fetchall()
