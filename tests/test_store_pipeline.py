import os
import shutil
import tempfile

import pytest
from pyspark.sql import functions as F

from tracknet.plans.pipeline import run_pipeline
from tracknet.plans.sql import run_query
from tracknet.sources import store
from tracknet.sources.manifest import ingest_manifest
from tracknet.sources.snapshots import GraphStore


def test_pipeline_end_to_end(spark, tiny_dir):
    st = os.path.join(tiny_dir, "stations.csv")
    cn = os.path.join(tiny_dir, "connections.csv")
    res = run_pipeline(spark, st, cn, "tracknet_test")
    c = res.counts
    assert (c["source_stations"], c["source_connections"]) == (8, 10)
    assert (c["nodes"], c["relationships"], c["quarantined"]) == (8, 18, 1)
    rels = spark.table(res.tables["relationships"])
    assert rels.count() == 18
    # one folder per type: a filter on the type prunes files
    spark.conf.set("spark.sql.maxMetadataStringLength", 1000)
    plan = rels.filter(F.col("rel_type") == "GREY")._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = plan[plan.index("PartitionFilters: ["):plan.index("PushedFilters")]
    assert "= GREY)" in scan and "load_id" in scan, scan
    # the node table is bucketed on its key: a join on it does not shuffle it
    assert "Num Buckets" in {r.col_name for r in spark.sql("DESCRIBE EXTENDED tracknet_test.node_parts").collect()}
    got = {r.metric: r.value for r in res.metrics(spark).collect()}
    assert got["nodes"] == 8 and got["stations_rejected"] == 1 and got["seconds_total"] > 0
    assert [r.reason for r in spark.table(res.tables["station_quarantine"]).collect()] == ["bad_zone"]
    # a second full run clears first, so nothing doubles
    res2 = run_pipeline(spark, st, cn, "tracknet_test")
    assert res2.counts["deleted_nodes"] == 8 and res2.counts["deleted_relationships"] == 18
    assert spark.table(res2.tables["relationships"]).count() == 18
    v = {(r.section, r.item): r.value for r in res2.report.collect()}
    assert v[("stations", "Station")] == 8 and v[("total", "ALL")] == 18


STATION_HEAD = "ID,Station_Name,Latitude,Longitude,Zone,Postcode\n"
LINE_HEAD = "Tube_Line,From_Station,To_Station\n"


def _load(spark, tmp_path, db, stations, lines, **options):
    (tmp_path / "s.csv").write_text(STATION_HEAD + stations)
    (tmp_path / "l.csv").write_text(LINE_HEAD + lines)
    return run_pipeline(spark, str(tmp_path / "s.csv"), str(tmp_path / "l.csv"), db, **options)


def test_a_first_load_reduces_nodes_by_key(spark, tmp_path):
    res = _load(spark, tmp_path, "tracknet_dup", "1,Ash,1,1,1,A\n1,Ash,1,1,1,A\n2,Box,1,1,1,B\n", "Red,Ash,Box\n")
    assert res.counts["nodes"] == 2 and res.counts["relationships"] == 2


def test_an_incremental_load_links_to_stored_stations(spark, tmp_path):
    _load(spark, tmp_path, "tracknet_inc", "1,Ash,1,1,1,A\n2,Box,1,1,1,B\n", "Red,Ash,Box\nRed,Ash,Gone\n")
    res = _load(spark, tmp_path, "tracknet_inc", "3,Cob,1,1,1,C\n2,Box,1,1,2,B\n", "Red,Cob,Ash\nRed,Cob,Lost\n", clear_first=False)
    assert res.counts["nodes"] == 3 and res.counts["relationships"] == 2
    assert {(r.src_id, r.dst_id) for r in spark.table(res.tables["relationships"]).collect()} == {(1, 2), (2, 1), (3, 1), (1, 3)}
    assert spark.table(res.tables["nodes"]).filter("station_id = 2").first().zone == 2
    kept = {(r.to_station, r.load_id == res.load_id) for r in spark.table(res.tables["quarantine"]).collect()}
    assert kept == {("Gone", False), ("Lost", True)}


def test_stations_without_a_usable_key_are_reported(spark, tmp_path):
    big = 2**40
    res = _load(spark, tmp_path, "tracknet_keys", f"1,Ash,1,1,\"2,3\",A\n,Box,1,1,1,B\nx7,Cob,1,1,1,C\n{big},Dow,1,1,1,D\n", "Red,Ash,Dow\n")
    assert {r.station_id for r in spark.table(res.tables["nodes"]).collect()} == {1, big}
    got = {(r.name, r.reason, r.zone_text) for r in spark.table(res.tables["station_quarantine"]).collect()}
    assert got == {("Ash", "bad_zone", "2,3"), ("Box", "no_key", "1"), ("Cob", "bad_key", "1")}


def test_a_second_full_load_replaces_everything_and_a_failed_one_nothing(spark, tmp_path):
    _load(spark, tmp_path, "tracknet_again", "1,Ash,1,1,1,A\n2,Box,1,1,1,B\n", "Red,Ash,Box\n")
    res = _load(spark, tmp_path, "tracknet_again", "7,Gum,1,1,1,A\n8,Hop,1,1,1,B\n9,Ivy,1,1,1,C\n", "Red,Gum,Hop\n")
    assert sorted(r.station_id for r in spark.table(res.tables["nodes"]).collect()) == [7, 8, 9]
    assert (res.counts["deleted_nodes"], res.counts["deleted_relationships"]) == (2, 2)
    with pytest.raises(Exception):
        run_pipeline(spark, str(tmp_path / "s.csv"), str(tmp_path / "missing.csv"), "tracknet_again")
    assert spark.table(res.tables["nodes"]).count() == 3 and spark.table(res.tables["relationships"]).count() == 2


STEPS = ["before", "stations", "tables", "nodes", "relationships", "quarantine", "published"]


@pytest.mark.parametrize("clear_first", [True, False])
def test_a_load_that_fails_after_any_step_leaves_one_whole_graph(spark, tmp_path, clear_first):
    db = f"tracknet_fail_{clear_first}"
    old = ("1,Ash,1,1,1,A\n2,Box,1,1,1,B\n", "Red,Ash,Box\n")
    new = ("2,Box,1,1,2,B\n7,Gum,1,1,1,A\n8,Hop,1,1,1,B\n", "Blue,Gum,Hop\nBlue,Box,Hop\n")
    read = lambda: (sorted((r.station_id, r.zone) for r in spark.table(f"{db}.nodes").collect()),
                    sorted((r.src_id, r.dst_id, r.rel_type) for r in spark.table(f"{db}.relationships").collect()))
    first = ([(1, 1), (2, 1)], [(1, 2, "RED"), (2, 1, "RED")])
    blue = [(2, 8, "BLUE"), (7, 8, "BLUE"), (8, 2, "BLUE"), (8, 7, "BLUE")]
    second = ([(2, 2), (7, 1), (8, 1)], blue) if clear_first else ([(1, 1), (2, 2), (7, 1), (8, 1)], sorted(first[1] + blue))
    _load(spark, tmp_path, db, *old)
    graphs = GraphStore(spark, db)
    pinned = graphs.graph()
    for step in STEPS:
        def fail(done, step=step):
            if done == step:
                raise RuntimeError(f"lost after {step}")

        with pytest.raises(RuntimeError, match=f"lost after {step}"):
            _load(spark, tmp_path, db, *new, clear_first=clear_first, after_step=fail)
        assert read() == (second if step == "published" else first), step
    # a frame of the old version still reads it; leftovers go, what is published stays
    assert pinned.nodes.count() == 2 and pinned.relationships.count() == 2
    assert len(graphs.vacuum()) >= 3 and read() == second
    _load(spark, tmp_path, db, *old)
    assert read() == first
    assert graphs.clear("emptied").first() == (2, 2) and read() == ([], []) and graphs.counts() == (0, 0)
    _load(spark, tmp_path, db, *old, clear_first=False)
    assert read() == first


def test_a_replacement_that_fails_leaves_the_old_or_the_new_table(spark):
    store.ensure_database(spark, "tracknet_point", use=False)
    name = "tracknet_point.t"
    spark.range(3).write.saveAsTable(name)          # a plain table of before
    for k, step in enumerate(["written", "renamed", "pointed", "dropped", "written", "pointed"]):
        def fail(done, step=step):
            if done == step:
                raise RuntimeError(step)

        store.recover_table(spark, name)
        held = spark.table(name).count()
        with pytest.raises(RuntimeError, match=step):
            store.save_table(spark.range(10 + k), name, verify=True, after_step=fail)
            raise RuntimeError(step)                # a step that does not occur any more
        store.recover_table(spark, name)
        assert spark.table(name).count() in (held, 10 + k)
    assert store.save_table(spark.table(name).filter("id < 5"), name, verify=True) == 5
    assert store.save_table(spark.range(2), name, mode="append", verify=True) == 2 and spark.table(name).count() == 7


def test_append_without_clear_doubles(spark, tiny):
    store.ensure_database(spark, "tracknet_append")
    store.save_relationships(tiny.relationships, "tracknet_append.rels", mode="append")
    store.save_relationships(tiny.relationships, "tracknet_append.rels", mode="append")
    assert spark.table("tracknet_append.rels").count() == 36
    out = store.clear_graph(spark, "tracknet_append.none", "tracknet_append.rels").first()
    assert (out.deleted_nodes, out.deleted_relationships) == (0, 36)
    assert spark.table("tracknet_append.rels").count() == 0


def test_save_table_verify_and_swap(spark, tiny):
    store.ensure_database(spark, "tracknet_swap")
    n = store.save_table(tiny.nodes, "tracknet_swap.nodes", verify=True)
    assert n == 8
    # overwrite a table from a frame that reads it: goes through staging
    again = spark.table("tracknet_swap.nodes").filter(F.col("zone").isNotNull())
    assert store.save_table(again, "tracknet_swap.nodes", verify=True) == 6
    assert spark.table("tracknet_swap.nodes").count() == 6


def test_manifest(spark, tiny_dir):
    got = {r.file: r.rows for r in ingest_manifest(spark, tiny_dir, recursive=False).collect()}
    assert got == {"stations.csv": 8, "connections.csv": 10}
    for d, n in (("a", 2), ("b", 3)):
        os.makedirs(os.path.join(tiny_dir, "same", d), exist_ok=True)
        with open(os.path.join(tiny_dir, "same", d, "x y.csv"), "w") as f:
            f.write("h\n" + "1\n" * n)
    two = ingest_manifest(spark, os.path.join(tiny_dir, "same")).collect()
    assert [(r.file, r.rows) for r in two] == [("x y.csv", 2), ("x y.csv", 3)] and "/a/" in two[0].path
    missing = ingest_manifest(spark, os.path.join(tiny_dir, "nope"))
    assert missing.count() == 0


def test_run_query_binds_args(spark, tiny):
    df = run_query(spark, tiny, "SELECT count(*) AS n FROM relationships WHERE rel_type = :t", {"t": "RED"})
    assert df.first().n == 6


def test_landing_stream(spark, tiny, tiny_dir):
    from tracknet.streaming.landing import start_ingest

    root = tempfile.mkdtemp(prefix="tracknet-stream-")
    landing = os.path.join(root, "landing")
    os.makedirs(landing)
    shutil.copy(os.path.join(tiny_dir, "connections.csv"), os.path.join(landing, "a.csv"))
    nodes_path = os.path.join(root, "nodes")
    tiny.nodes.write.parquet(nodes_path)
    q = start_ingest(spark, landing, nodes_path, os.path.join(root, "rels"),
                     os.path.join(root, "quarantine"), checkpoint=os.path.join(root, "ckpt"))
    q.awaitTermination(120)
    assert spark.read.parquet(os.path.join(root, "rels")).count() == 18
    assert spark.read.parquet(os.path.join(root, "quarantine")).count() == 1
    # a restart with no new file adds nothing
    q = start_ingest(spark, landing, nodes_path, os.path.join(root, "rels"),
                     os.path.join(root, "quarantine"), checkpoint=os.path.join(root, "ckpt"))
    q.awaitTermination(120)
    assert spark.read.parquet(os.path.join(root, "rels")).count() == 18


def test_a_repeated_batch_adds_nothing(spark, tiny, tiny_dir):
    from tracknet.streaming.landing import start_ingest

    root = tempfile.mkdtemp(prefix="tracknet-stream-")
    os.makedirs(os.path.join(root, "landing"))
    shutil.copy(os.path.join(tiny_dir, "connections.csv"), os.path.join(root, "landing", "a.csv"))
    tiny.nodes.write.parquet(os.path.join(root, "nodes"))
    args = [os.path.join(root, d) for d in ("landing", "nodes", "rels", "quarantine")]
    for attempt in ("one", "two"):      # a fresh checkpoint replays batch 0, as after a failure before its commit
        start_ingest(spark, *args, checkpoint=os.path.join(root, attempt)).awaitTermination(120)
        assert spark.read.parquet(args[2]).count() == 18 and spark.read.parquet(args[3]).count() == 1
    with pytest.raises(ValueError):
        start_ingest(spark, *args, checkpoint="")


STATION_FILES = ["1,Ash,1,1,1,A\n2,Box,1,1,1,B\n", "3,Cob,1,1,2,C\n2,Box,1,1,3,B\n", "4,Box,1,1,1,D\n5,Elm,1,1,1,E\n", "1,Asp,1,1,1,A\n,Nokey,1,1,1,X\n"]
LINE_FILES = ["Red,Ash,Box\nRed,Cob,Elm\n", "Blue,Box,Elm\n,Box,Cob\nBlue,Asp,Box\n", "Red,Gone,Ash\nRed,Elm,Elm\nRed,Cob,Elm\n"]


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_any_order_of_files_gives_the_batch_graph_and_replay_adds_nothing(spark, seed):
    import random

    from tracknet.operators.model import build_graph, clean_connections, clean_stations, upsert_nodes
    from tracknet.sources.csv import read_connections, read_stations
    from tracknet.streaming.landing import StreamedGraph, start_graph_ingest

    root = tempfile.mkdtemp(prefix="tracknet-stream-")
    files = [("stations", STATION_HEAD, t) for t in STATION_FILES] + [("lines", LINE_HEAD, t) for t in LINE_FILES]
    random.Random(seed).shuffle(files)
    for d in ("stations", "lines"):
        os.makedirs(f"{root}/{d}")
    args = [f"{root}/{d}" for d in ("stations", "lines", "graph")]

    def seen():
        g = StreamedGraph(spark, args[2]).graph()
        return [sorted(map(str, (tuple(r) for r in df.collect()))) for df in (g.nodes, g.relationships, g.quarantine)]

    for k, (folder, head, text) in enumerate(files):      # a batch or two for each pair of files
        with open(f"{root}/{folder}/{k}.csv", "w") as f:
            f.write(head + text)
        if k % 2 or k == len(files) - 1:
            start_graph_ingest(spark, *args, checkpoint=f"{root}/ckpt", max_files=1).awaitTermination(120)
    all_nodes = clean_stations(read_stations(spark, args[0]))
    g = build_graph(all_nodes, clean_connections(read_connections(spark, args[1])))
    nodes = upsert_nodes(g.nodes.limit(0), g.nodes)
    g = build_graph(nodes.drop("label"), clean_connections(read_connections(spark, args[1])))
    want = [sorted(map(str, (tuple(r) for r in df.collect()))) for df in (g.nodes, g.relationships, g.quarantine)]
    assert seen() == want and len(want[1]) > 8 and len(want[2]) >= 2
    # a replay of all batches from the start, and a restart without new files
    start_graph_ingest(spark, *args, checkpoint=f"{root}/again", max_files=1).awaitTermination(120)
    assert seen() == want
    start_graph_ingest(spark, *args, checkpoint=f"{root}/again").awaitTermination(120)
    assert seen() == want


def test_no_python_udf_in_plans(spark, tiny):
    from tracknet.operators import aggregates as A
    from tracknet.operators import lookup as L

    for df in (A.degree_all(tiny), A.busy_stations(tiny), A.quiet_alternatives(tiny),
               L.name_search(tiny, ["a"]), A.interchanges(tiny)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
        assert "CartesianProduct" not in plan


def test_filters_and_columns_reach_the_scan(spark, tiny):
    from tracknet.operators import lookup as L
    from tracknet.operators.model import GraphTables

    path = tempfile.mkdtemp(prefix="tracknet-nodes-") + "/nodes"
    tiny.nodes.write.parquet(path)
    g = GraphTables(spark.read.parquet(path), tiny.relationships)
    plan = L.stations_in_zone(g, 1)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(zone), EqualTo(zone,1)]" in plan
    assert "ReadSchema: struct<station_id:bigint,name:string,zone:int>" in plan


def test_quiet_alternatives_limits_before_shuffle(tiny):
    from tracknet.operators import aggregates as A

    plan = A.quiet_alternatives(tiny)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
